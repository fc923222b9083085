"""Physical plans: pushdown, pruning, no products, no Python in the hot path."""

from __future__ import annotations

import datetime as dt

import pytest

from tripmeter.plans.pipeline import run_weekly
from tripmeter.models.training import Hyperparameters
from tripmeter.plans import pipeline
from workload import queries, testbed

FOLDER = "/root/testdata/sf0.01"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_job_dates_reach_the_scan(spark, path):
    jobs = testbed.jobs(spark, FOLDER)
    jobs.write.parquet(f"{path}/jobs")
    from tripmeter.plans.weekly import weekly_snapshot

    text = plan(weekly_snapshot(
        testbed.trips(spark, FOLDER), spark.read.parquet(f"{path}/jobs"),
        testbed.city(spark, FOLDER), testbed.city_region(spark, FOLDER), testbed.DS, "EUROPE",
    ))
    assert "GreaterThanOrEqual(date_str,1996-03-04T00:00)" in text
    assert "LessThan(date_str,1996-03-12T00:00)" in text


def test_columns_are_pruned(spark):
    text = plan(queries.QUERIES["avg_by_hour"](spark, FOLDER))
    schema = text.split("ReadSchema: struct<")[1]
    assert "pickup_distance" not in schema and "batch_date" not in schema


@pytest.mark.parametrize("name", ["kpi", "box_stats", "quantile_trim", "strat_split", "clean_trips",
                                  "duplicate_rows", "sample_points", "weekly_snapshot"])
def test_no_products_and_no_python(spark, name):
    text = plan(queries.QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert "Python" not in text and "InPandas" not in text


def test_both_weekly_jobs(spark, path):
    """Snapshot to history to published models, on the relational tables of one country."""
    inputs = {
        "trips": testbed.trips(spark, FOLDER), "jobs": testbed.jobs(spark, FOLDER),
        "city": testbed.city(spark, FOLDER), "region": testbed.city_region(spark, FOLDER),
    }
    now = dt.datetime(2024, 1, 1)
    table = run_weekly(spark, inputs, path, "stage", "eu", "EUROPE", testbed.DS, now)
    assert table.count() == 12


def test_training_job(spark, path):
    """History of event trips under the history schema, trained and published."""
    from pyspark.sql import functions as F

    from tripmeter import schemas
    from tripmeter.models.artifacts import artifact_dir, load_artifacts
    from tripmeter.plans.history import write_partitions
    from tripmeter.sources.tables import HISTORY_TABLE, table_path

    rows = testbed.event_history(spark, FOLDER, copies=False).withColumns({
        "week_start": F.date_sub("batch_date", 7), "week_end": F.col("batch_date"),
        "country_name": F.lit("X"), "workflow_uuid": F.lit("w"), "driver_uuid": F.lit("d"),
        "inserted_at": F.lit("2024-01-01").cast("timestamp"),
        "updated_at": F.lit("2024-01-01").cast("timestamp"),
    })
    rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.TRIP_HISTORY])
    write_partitions(rows, table_path(path, "stage", HISTORY_TABLE.format(country="x")))
    quick = Hyperparameters(forest_trees=2, forest_depth=2, boosted_rounds=2, deep_rounds=2, deep_depth=2)
    done = pipeline.run_training(spark, path, "stage", "x", "2024-02-05", 6, f"{path}/models", quick)
    assert set(done) == {"pre_assign", "post_assign"}
    for variant in done:
        assert load_artifacts(spark, artifact_dir(f"{path}/models", "x", "2024-02-05"), variant)


def final_plan(df) -> str:
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name,scans", [("group_medians", 1), ("median_by_category", 1),
                                        ("kpi_by_territory", 2), ("impute_group_median", 3)])
def test_quantiles_share_their_shuffle(spark, name, scans):
    text = final_plan(queries.QUERIES[name](spark, FOLDER))
    assert text.count("FileScan") == scans


def scans(df) -> int:
    return plan(df).count("FileScan")


def test_bins_do_not_multiply_the_input(spark):
    from tripmeter.operators.quantiles import quantile_bin

    events = spark.read.parquet(f"{FOLDER}/events.parquet").select("event_id", "value")
    assert len({scans(quantile_bin(events, "value", bins)) for bins in (5, 10, 40)}) == 1


@pytest.mark.parametrize("name,most", [("error_by_quintile", 15), ("error_metrics", 6),
                                       ("rate_and_count", 1), ("duplicate_rows", 2)])
def test_few_scans_are_planned(spark, name, most):
    assert scans(queries.QUERIES[name](spark, FOLDER)) <= most


