"""Cases that once gave wrong results or lost rows."""

from __future__ import annotations

import datetime as dt
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tripmeter import schemas
from tripmeter.functions import clock
from tripmeter.models import features as feats
from tripmeter.models.preprocess import fit_preprocessing
from tripmeter.models.training import score
from tripmeter.operators import cleaning, profile, summaries
from tripmeter.operators.quantiles import SLICES_OF_RANGE, _slice, exact_quantiles
from tripmeter.plans import history
from tripmeter.sources import tables, versions
from workload import queries, testbed

FOLDER = "/root/testdata/sf0.001"


def test_csv_as_pandas_writes_it(spark, path):
    frame = pd.DataFrame({name: [None, None] for name in schemas.CLEAN_TRIPS.fieldNames()})
    frame["eater_request_timestamp_local"] = pd.to_datetime(["2024-01-05 10:30:00", "2024-01-06 00:00:01.5"], format="ISO8601")
    frame["order_final_state_timestamp_local"] = ["2024-01-05T11:00:00.000250", "yesterday"]
    frame["ATD"] = [30.0, None]
    frame.to_csv(f"{path}/trips.csv", index=False)
    rows = tables.load_trips(spark, f"{path}/trips.csv").orderBy("eater_request_timestamp_local").collect()
    assert [r.eater_request_timestamp_local for r in rows] == [
        dt.datetime(2024, 1, 5, 10, 30), dt.datetime(2024, 1, 6, 0, 0, 1, 500_000)
    ]
    assert rows[0].order_final_state_timestamp_local == dt.datetime(2024, 1, 5, 11, 0, 0, 250)
    assert (rows[0].hour, rows[0].day_of_week) == (10, 4)
    bad = {r.column: r.n for r in tables.unreadable(spark, f"{path}/trips.csv", schemas.CLEAN_TRIPS).collect()}
    assert bad == {
        "eater_request_timestamp_local": 0, "order_final_state_timestamp_local": 1,
        "restaurant_offered_timestamp_local": 0,
    }


def test_flags_are_numbers(spark):
    trips = queries.clean(spark, FOLDER)
    assert profile.numeric_columns(trips) == [
        "pickup_distance", "dropoff_distance", "ATD", "missing_distance", "offered_equals_request"
    ]


def test_density_of_a_constant(spark):
    frame = spark.createDataFrame([("a", 2.0), ("a", 2.0), ("b", 2.0)], "c string, x double")
    got = {r.c: (r.bin, r["count"], r.density) for r in summaries.density_by(frame, "x", "c", 10).collect()}
    assert got == {"a": (0, 2, 1.0), "b": (0, 1, 1.0)}


def test_another_zone_fails_at_once(spark):
    kept = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Mexico_City")
        with pytest.raises(RuntimeError, match="UTC"):
            clock.elapsed_minutes(F.col("a"), F.col("b"))
        with pytest.raises(RuntimeError, match="UTC"):
            clock.utc_to_local(F.col("a"), 6)
    finally:
        spark.conf.set("spark.sql.session.timeZone", kept)


def test_stored_trips_follow_their_table(spark, path):
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    events.write.parquet(f"{path}/events.parquet")
    before = queries.clean(spark, path).count()
    time.sleep(0.01)
    events.where("event_id % 2 = 0").write.mode("overwrite").parquet(f"{path}/events.parquet")
    assert queries.clean(spark, path).count() < 0.7 * before


def test_no_batch_is_left_out(spark):
    first, last = spark.read.parquet(f"{FOLDER}/events.parquet").agg(F.min("ts"), F.max("ts")).first()
    got = testbed.event_history(spark, FOLDER).agg(F.min("batch_date"), F.max("batch_date")).first()
    assert got[0] <= first.date() + dt.timedelta(7) and got[1] >= last.date()


def test_a_crash_in_the_middle_of_an_upsert_loses_nothing(spark, path, monkeypatch):
    rows = queries.snapshot(spark, FOLDER, None).limit(20)
    table, day = f"{path}/history", testbed.DS
    history.upsert_history(spark, table, rows, day, dt.datetime(2024, 1, 1))
    stored = tables.read_table(spark, table).count()

    def crash(*_, **__):
        raise OSError("lost")

    changed = rows.withColumn("atd", F.lit(1.0))
    with monkeypatch.context() as patch:
        patch.setattr(versions, "commit", crash)
        with pytest.raises(OSError):
            history.upsert_history(spark, table, changed, day, dt.datetime(2024, 1, 2))
    assert tables.read_table(spark, table).where("atd <> 1").count() > 0
    again = history.upsert_history(spark, table, changed, day, dt.datetime(2024, 1, 2))
    assert again.count() == stored > 0
    assert again.where("inserted_at <> TIMESTAMP '2024-01-01'").count() == 0


def test_every_trip_is_scored_or_null(spark, path):
    trained, _ = queries.published(spark, FOLDER, "pre_assign")
    rows = queries.frame(spark, FOLDER, "pre_assign")
    got = score(trained.preprocessing, trained.best_model, rows)
    assert got.count() == rows.count()
    lacking = F.col("total_distance").isNull()
    assert rows.where(lacking).count() > 0
    assert got.where(F.col("prediction").isNull() != lacking).count() == 0
    assert fit_preprocessing(rows, feats.PRE_ASSIGN).transform(rows).count() < rows.count()


def test_slices_spread_timestamps_and_survive_a_dominating_value(spark):
    seconds = spark.range(200_000).select((F.col("id") * 13 + 1_704_067_200).cast("double").alias("x"))
    low, high = F.lit(1_704_067_200.0), F.lit(1_704_067_200.0 + 13 * 199_999)
    most = seconds.groupBy(_slice(F.col("x"), low, high).alias("s")).count().agg(F.max("count")).first()[0]
    assert most <= 0.01 * 200_000 and SLICES_OF_RANGE >= 1000
    mixed = seconds.unionByName(spark.range(300_000).select(F.lit(0.0).alias("x")))
    got = exact_quantiles(mixed, "x", [0.5, 0.8]).first()
    assert got.q[0] == 0.0
    exact = 1_704_067_200 + 13 * (0.8 * 499_999 - 300_000)
    assert abs(got.q[1] - exact) < 1e-3


def test_labels_without_a_limit(spark, path):
    frame = spark.range(9000).select(F.col("id"), F.format_string("v%05d", F.col("id") % 6000).alias("a"), F.lit("z").alias("b"))
    got = feats.sparse_dummies(frame, ["a", "b"], f"{path}/labels")
    rows = {r.id: r.indices for r in got.where("id in (0, 1, 5999, 6001)").collect()}
    assert rows == {0: [], 1: [0], 5999: [5998], 6001: [0]}


def test_scratch_is_cleared(spark, tmp_path, monkeypatch):
    from tripmeter import session

    monkeypatch.setattr(session, "_made", {})
    path = session.scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    session.clear_scratch(spark)
    assert not tables.table_exists(spark, path)


def test_copies_come_back_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(cleaning, "REPEAT_BLOCK", 3)
    frame = spark.createDataFrame([(1, None)] * 8 + [(2, "x")] + [(3, "y")] * 2, "k int, v string")
    got = cleaning.duplicate_members(frame).groupBy("k").agg(F.count("*").alias("n"), F.max("copies").alias("c"))
    assert {r.k: (r.n, r.c) for r in got.collect()} == {1: (8, 8), 3: (2, 2)}
