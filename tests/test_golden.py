"""Small hand-computed tables, one for each trap in the semantics."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tripmeter.functions import clock, values
from tripmeter.operators import anomalies, cleaning, errors, profile, quality, sampling, summaries
from tripmeter.operators.quantiles import exact_quantiles, named_quantiles, quantile_bin, quantile_trim
from tripmeter.operators.skew import keep_frequent
from tripmeter.plans.weekly import weekly_snapshot
from tripmeter.sources import tables


def numbers(spark, *xs):
    return spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "id int, x double")


def test_group_median_empties_rows_without_group(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", None), ("a", 4.0), (None, 5.0), ("b", None)], "territory string, x double"
    )
    got = cleaning.impute_group_median(df, "territory", ["x"]).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(
        map(str, [("a", 1.0), ("a", 2.5), ("a", 4.0), (None, None), ("b", None)])
    )


def test_log1p_is_null_at_and_below_minus_one(spark):
    rows = numbers(spark, -2.0, -1.0, -0.5, 0.0).orderBy("id")
    got = [r[0] for r in rows.select(values.log1p_or_null(F.col("x"))).collect()]
    assert got[:2] == [None, None]
    assert got[2:] == pytest.approx([-0.693147, 0.0], abs=1e-6)


def test_quantiles(spark):
    row = exact_quantiles(numbers(spark, 1.0, 2.0, 3.0, 4.0, None), "x", [0.5, 0.9]).first()
    assert row["n"] == 4
    assert row["q"] == pytest.approx([2.5, 3.7])
    std = profile.profile_numeric(numbers(spark, 1.0, 2.0, 3.0, 4.0), ["x"]).first()["std"]
    assert std == pytest.approx(1.290994, abs=1e-6)


def test_quantiles_of_extreme_values(spark):
    xs = [-1e300, -5.0, -5.0, 0.0, 1e-300, 7.0, 1e300, float("nan"), None]
    row = exact_quantiles(numbers(spark, *xs), "x", [0.0, 0.5, 1.0]).first()
    assert row["n"] == 7 and row["q"] == [-1e300, 0.0, 1e300]


def test_quantiles_of_nothing(spark):
    empty = numbers(spark, 1.0).where("x > 5")
    assert exact_quantiles(empty, "x", [0.5]).count() == 0
    row = summaries.kpis(empty, "x").first()
    assert (row["avg_atd"], row["median_atd"], row["p90_atd"], row["n_trips"]) == (None,) * 3 + (0,)


def test_named_quantiles(spark):
    got = {r["quantile"]: r["value"] for r in named_quantiles(numbers(spark, 0.0, 10.0), "x", [0.1, 0.9]).collect()}
    assert got == pytest.approx({0.1: 1.0, 0.9: 9.0})


def test_quantile_bins_are_right_closed(spark):
    binned = quantile_bin(numbers(spark, 1.0, 2.0, 3.0, 4.0, None, 10.0), "x", 2).orderBy("id")
    assert [r["bin"] for r in binned.collect()] == [0, 0, 0, 1, None, 1]


def test_quantile_bins_need_unique_edges(spark):
    with pytest.raises(Exception, match="must be unique"):
        quantile_bin(numbers(spark, 1.0, 1.0, 1.0, 2.0), "x", 4).collect()


def test_quantile_trim_includes_both_ends(spark):
    kept = quantile_trim(numbers(spark, *[float(i) for i in range(101)]), "x")
    assert kept.agg(F.min("x"), F.max("x")).first()[:] == (2.0, 98.0)


def test_literal_and_corrected_duration(spark):
    row = spark.sql(
        "SELECT timestamp_ntz'2024-01-01 12:30:00' AS e, timestamp'2024-01-01 18:00:00' AS s"
    )
    got = row.select(
        clock.elapsed_minutes(F.col("e"), F.col("s")),
        clock.elapsed_minutes(F.col("e"), F.col("s"), 6),
    ).first()
    assert got[:] == (-330.0, 30.0)


def test_stored_km_rounds_halves_away_from_zero(spark):
    row = spark.sql("SELECT cast(1234.5 AS decimal(10,1)) AS a, cast(-1234.5 AS decimal(10,1)) AS b")
    got = row.select(values.stored_km(F.col("a")), values.stored_km(F.col("b"))).first()
    assert [str(x) for x in got] == ["1.235", "-1.235"]


def test_snapshot_window_joins_and_distances(spark):
    ntz = "timestamp_ntz"
    trips = spark.createDataFrame(
        [(k, k, k, "f", dt.datetime(2024, 1, 1, 18), dt.datetime(2024, 1, 1, 12, 30),
          dt.datetime(2024, 1, 1, 12), "g", "m") for k in "abcdef"],
        "delivery_trip_uuid string, workflow_uuid string, driver_uuid string, courier_flow string, "
        f"restaurant_offered_timestamp_utc timestamp, order_final_state_timestamp_local {ntz}, "
        f"eater_request_timestamp_local {ntz}, geo_archetype string, merchant_surface string",
    )
    day = {"a": dt.datetime(2024, 1, 8), "b": dt.datetime(2024, 1, 15, 23, 59),
           "c": dt.datetime(2024, 1, 16), "d": dt.datetime(2024, 1, 7, 23), "e": dt.datetime(2024, 1, 9)}
    city = {"a": 1, "b": 2, "c": 1, "d": 1, "e": 3}
    jobs = spark.createDataFrame(
        [(k, city[k], day[k]) for k in day], f"job_uuid string, city_id int, date_str {ntz}"
    ).selectExpr(
        "*", "cast(1234.5 AS decimal(10,1)) AS pickup_distance",
        "cast(1.235 AS decimal(10,3)) AS pickup_distance_km",
        "cast(2000.0 AS decimal(10,1)) AS travel_distance",
    )
    cities = spark.createDataFrame([(1, "X"), (2, "X"), (3, "Y")], "city_id int, country_name string")
    regions = spark.createDataFrame([(1, "north"), (3, "south")], "city_id int, territory string")
    got = {r["delivery_trip_uuid"]: r for r in
           weekly_snapshot(trips, jobs, cities, regions, "2024-01-15", "X").collect()}
    assert sorted(got) == ["a", "b"]  # both ends of the eight days, other country out
    assert (got["a"]["territory"], got["b"]["territory"]) == ("north", None)
    assert float(got["a"]["pickup_distance_km"]) == 1.2345  # not rounded
    assert float(got["a"]["dropoff_distance"]) == 3.235  # uses the stored three decimals
    assert got["a"]["atd"] == -330.0
    everyone = weekly_snapshot(trips, jobs, cities, regions, "2024-01-15")
    assert everyone.count() == 3


def test_marker_and_missing_text(spark):
    df = spark.createDataFrame([(r"\N", 1), (None, 2), ("x", 3)], "flow string, hour int")
    got = df.orderBy("hour").select(
        values.replace_marker(F.col("flow")), values.text_key(F.col("flow"), F.col("hour"))
    ).collect()
    assert [r[0] for r in got] == ["Unespecified", None, "x"]
    assert [r[1] for r in got] == [r"\N_1", "nan_2", "x_3"]


def test_comparisons_with_missing_times_are_false(spark):
    df = spark.sql(
        "SELECT cast(null AS timestamp_ntz) AS restaurant_offered_timestamp_local,"
        " timestamp_ntz'2024-01-01 00:00:00' AS eater_request_timestamp_local,"
        " timestamp_ntz'2024-01-01 00:00:00' AS order_final_state_timestamp_local"
    )
    assert anomalies.time_flags(df).first()[-2:] == (0, 0)
    assert anomalies.valid_offer(df).first()["valid_offered"] is False


def test_lenient_parsing(spark):
    df = spark.createDataFrame([("1.5",), ("x",), ("NaN",), (None,)], "s string")
    got = [r[0] for r in df.select(values.to_number(F.col("s"))).collect()]
    assert got == [1.5, None, None, None]
    stamps = [r[0] for r in df.select(clock.parse_wall_clock(F.col("s"))).collect()]
    assert stamps == [None] * 4


def test_weekday_numbers_and_labels(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 05:00:00' AS mon, timestamp_ntz'2024-01-07 23:00:00' AS sun")
    got = df.select(
        clock.weekday_number(F.col("mon")), clock.weekday_number(F.col("sun")),
        clock.weekday_label(clock.weekday_number(F.col("sun"))),
        clock.weekend_flag(F.col("mon")), clock.weekend_flag(F.col("sun")),
        clock.three_hour_slot(clock.hour_of_day(F.col("sun"))),
    ).first()
    assert got[:] == (0, 6, "Sun", 0, 1, 7)


def test_rare_groups(spark):
    df = spark.createDataFrame([("ten",)] * 10 + [("eleven",)] * 11 + [(None,)] * 12, "k string")
    kept = keep_frequent(df, ["k"], 10).groupBy("k").count().collect()
    assert {r["k"]: r["count"] for r in kept} == {"eleven": 11, None: 12}


def test_correlation_with_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0, 3.0), (1.0, 2.0, 5.0)], "a double, b double, c double")
    got = {(r["a"], r["b"]): r["corr"] for r in profile.correlations(df, ["a", "b", "c"]).collect()}
    assert got[("b", "a")] is None
    assert got[("c", "b")] == pytest.approx(1.0)


def test_duplicates_treat_missing_as_equal(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "x int")
    assert cleaning.drop_exact_duplicates(df).count() == 2
    assert cleaning.duplicate_members(df).collect()[0][:] == (None, 2)
    assert cleaning.duplicate_members(df).count() == 2
    assert quality.duplicate_report(df).first()[:] == (2, False)


def test_empty_choice_selects_nothing(spark):
    df = spark.createDataFrame([("a", 3), (None, 4)], "territory string, hour int")
    assert cleaning.slice_rows(df, {"territory": []}).columns == df.columns
    assert cleaning.slice_rows(df, {"territory": []}).count() == 0
    assert cleaning.slice_rows(df, {"territory": ["a"]}, (3, 3)).count() == 1


def test_histogram_keeps_maximum_in_last_bin_and_empty_bins(spark):
    got = summaries.histogram(numbers(spark, 0.0, 1.0, 9.0, 10.0), "x", 5).collect()
    assert [r["count"] for r in got] == [2, 0, 0, 0, 2]
    flat = summaries.histogram(numbers(spark, 3.0, 3.0), "x", 2).collect()
    assert [r["count"] for r in flat] == [2, 0]


def test_box_whiskers_leave_out_outliers(spark):
    df = spark.createDataFrame([("a", float(x)) for x in [1, 2, 3, 4, 100]], "k string, x double")
    row = summaries.box_stats(df, "x", "k").first()
    assert (row["q1"], row["median"], row["q3"]) == (2.0, 3.0, 4.0)
    assert (row["whisker_low"], row["whisker_high"]) == (1.0, 4.0)


def test_error_sign_and_metrics(spark):
    df = spark.createDataFrame([(10.0, 8.0), (20.0, 24.0)], "ATD double, prediction double")
    assert [r["error"] for r in errors.with_errors(df).orderBy("ATD").collect()] == [2.0, -4.0]
    row = errors.regression_metrics(df).first()
    assert row["mae"] == 3.0
    assert row["rmse"] == pytest.approx(math.sqrt(10))
    assert row["r2"] == pytest.approx(1 - 20 / 50)
    assert errors.error_metrics(df).first()["p50_abs_error"] == 3.0
    limits = errors.axis_limits(df).first()
    assert limits["axis_limit"] == pytest.approx(25.2)


def test_quotas_add_up(spark):
    sizes = spark.createDataFrame([("a", 11), ("b", 12), ("c", 13), ("d", 20)], "s string, n bigint")
    got = {r["s"]: r["_quota"] for r in sampling.split_quotas(sizes, "s", "n", 0.2).collect()}
    assert got == {"a": 2, "b": 3, "c": 3, "d": 4}  # 12 = ceil(0.2 * 56)


def test_quality_findings(spark):
    df = spark.createDataFrame(
        [(0.0, 1.0, "a"), (5.0, None, None)], "ATD double, pickup_distance double, territory string"
    )
    got = {(r["check"], r["column"]): r["n"] for r in quality.dq_report(df).collect()}
    assert got == {
        ("missing_values", "pickup_distance"): 1, ("missing_values", "territory"): 1,
        ("missing_column", "dropoff_distance"): 2, ("non_positive", "ATD"): 1,
    }


def test_csv_keeps_marker_and_missing(spark, path):
    schema = "a string, t timestamp_ntz"
    df = spark.createDataFrame([(r"\N", dt.datetime(2024, 1, 1, 1, 2, 3, 456789)), (None, None), ('q"x', None)], schema)
    tables.write_csv(df, f"{path}/c")
    back = tables.read_csv(spark, f"{path}/c", df.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_catalog_schema_and_tables(spark, path):
    tables.ensure_schema(spark, "stage_test", f"{path}/db")
    tables.ensure_schema(spark, "stage_test", f"{path}/db")
    numbers(spark, 1.0).write.mode("ignore").saveAsTable("stage_test.t")
    numbers(spark, 1.0, 2.0).write.mode("ignore").saveAsTable("stage_test.t")
    assert spark.table("stage_test.t").count() == 1
    assert not tables.table_exists(spark, f"{path}/nothing")
