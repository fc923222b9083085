"""Merging batches into the history."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripmeter.plans.history import REFRESHED, history_as_of, upsert_history
from tripmeter.sources import tables, versions
from tripmeter.sources.tables import read_table

DS = "2024-01-15"
FIRST, SECOND = dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 16)


def snapshot(spark, rows):
    base = spark.createDataFrame(
        rows, "delivery_trip_uuid string, driver_uuid string, territory string, atd double"
    )
    return base.selectExpr(
        "territory", "'X' AS country_name", "'w' AS workflow_uuid", "driver_uuid",
        "delivery_trip_uuid", "'f' AS courier_flow",
        "timestamp'2024-01-10 12:00:00' AS restaurant_offered_timestamp_utc",
        "timestamp_ntz'2024-01-10 12:30:00' AS order_final_state_timestamp_local",
        "timestamp_ntz'2024-01-10 11:55:00' AS eater_request_timestamp_local",
        "'g' AS geo_archetype", "'m' AS merchant_surface",
        "cast(1.2345 AS decimal(15,6)) AS pickup_distance_km",
        "cast(2.5 AS decimal(16,6)) AS dropoff_distance", "atd",
    )


def by_trip(df):
    return {r["delivery_trip_uuid"]: r for r in df.collect()}


def test_new_known_and_absent_trips(spark, path):
    table = f"{path}/history"
    upsert_history(spark, table, snapshot(spark, [("a", "d1", "n", 1.0), ("b", "d1", "n", 2.0)]), DS, FIRST)
    second = snapshot(spark, [("b", "d2", None, 9.0), ("c", "d3", "s", 3.0)])
    got = by_trip(upsert_history(spark, table, second, DS, SECOND))
    assert sorted(got) == ["a", "b", "c"]
    b = got["b"]
    assert (b["driver_uuid"], b["territory"], float(b["atd"])) == ("d1", None, 9.0)
    assert (b["inserted_at"], b["updated_at"]) == (FIRST, SECOND)
    assert got["a"]["updated_at"] == FIRST
    assert got["c"]["inserted_at"] == SECOND
    assert str(b["pickup_distance_km"]) == "1.235"
    assert (b["week_start"], b["week_end"]) == (dt.date(2024, 1, 8), dt.date(2024, 1, 15))


def test_same_batch_twice_changes_only_the_update_time(spark, path):
    table = f"{path}/history"
    rows = snapshot(spark, [("a", "d1", "n", 1.0)])
    before = by_trip(upsert_history(spark, table, rows, DS, FIRST))
    after = by_trip(upsert_history(spark, table, rows, DS, SECOND))
    changed = [c for c in before["a"].asDict() if before["a"][c] != after["a"][c]]
    assert changed == ["updated_at"]
    assert "driver_uuid" not in REFRESHED


def test_other_batches_stay(spark, path):
    table = f"{path}/history"
    rows = snapshot(spark, [("a", "d1", "n", 1.0)])
    upsert_history(spark, table, rows, DS, FIRST)
    upsert_history(spark, table, rows, "2024-01-22", FIRST)
    changed = snapshot(spark, [("a", "d1", "n", 5.0)])
    whole = upsert_history(spark, table, changed, "2024-01-22", SECOND)
    got = {str(r["batch_date"]): float(r["atd"]) for r in whole.collect()}
    assert got == {DS: 1.0, "2024-01-22": 5.0}  # the trip is in both batches
    assert history_as_of(whole, DS).count() == 1


def test_repeated_trip_fails(spark, path):
    with pytest.raises(ValueError):
        upsert_history(
            spark, f"{path}/history", snapshot(spark, [("a", "d", "n", 1.0), ("a", "d", "n", 2.0)]), DS
        )


def test_as_of_reads_only_needed_partitions(spark, path):
    table = f"{path}/history"
    rows = snapshot(spark, [("a", "d1", "n", 1.0)])
    for ds in (DS, "2024-01-22", "2024-01-29"):
        upsert_history(spark, table, rows, ds, FIRST)
    plan = history_as_of(read_table(spark, table), DS).groupBy().agg(F.sum("atd"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_date" in text


class Killed(Exception):
    pass


def die(*_, **__):
    raise Killed


@pytest.mark.parametrize("step", ["write_data", "commit"])
def test_a_killed_upsert_leaves_the_old_rows(spark, path, monkeypatch, step):
    table = f"{path}/history"
    upsert_history(spark, table, snapshot(spark, [("a", "d1", "n", 1.0)]), DS, FIRST)
    changed = snapshot(spark, [("a", "d1", "n", 5.0), ("b", "d1", "n", 2.0)])
    with monkeypatch.context() as patch:
        patch.setattr(versions, step, die)
        with pytest.raises(Killed):
            upsert_history(spark, table, changed, DS, SECOND)
    assert {r["delivery_trip_uuid"]: float(r["atd"]) for r in read_table(spark, table).collect()} == {"a": 1.0}
    got = by_trip(upsert_history(spark, table, changed, DS, SECOND))
    assert {k: float(v["atd"]) for k, v in got.items()} == {"a": 5.0, "b": 2.0}


def test_a_draft_of_a_manifest_is_no_version(spark, path):
    """A run that dies between draft and rename: the draft is never read."""
    rows = spark.range(3)
    tables.replace_table(rows, path)
    open(f"{path}/manifests/.left", "w").close()
    assert versions.version(spark, path) == 1 and read_table(spark, path).count() == 3


def test_the_second_of_two_writers_is_refused(spark, path):
    tables.replace_table(spark.range(3), path)
    base = versions.version(spark, path)
    late = versions.write_data(spark.range(9), path)
    tables.replace_table(spark.range(5), path)
    with pytest.raises(versions.Conflict):
        versions.commit(spark, path, base, late)
    assert read_table(spark, path).count() == 5
    assert not [n for n in versions._children(spark, f"{path}/manifests") if n.startswith(".") and not n.endswith(".crc")]


def test_a_table_can_be_replaced_by_what_it_holds(spark, path):
    tables.replace_table(spark.range(4), path)
    tables.replace_table(read_table(spark, path).where("id > 0"), path)
    tables.append_rows(spark.range(10, 12), path)
    tables.create_if_absent(spark.range(100), path)
    assert sorted(r[0] for r in read_table(spark, path).collect()) == [1, 2, 3, 10, 11]
    assert versions.read(spark, path, number=1).count() == 4
    assert len(versions.expire(spark, path, 1)) == 3
    assert read_table(spark, path).count() == 5
    with pytest.raises(Exception):
        versions.read(spark, path, number=1).count()
