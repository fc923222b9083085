"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Every query runs twice and the second, warm run counts; results go to the noop sink, so all rows
and columns are computed.  Three things are done once and have lines of their own: ``staging`` is
the cleaning job that stores the trips which ``kpi`` and most later queries read, ``predictions``
stores the rows that the error queries read, and ``train_select_pre`` trains all models with the
default settings (left out with BENCH_TRAIN=0).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from tripmeter.session import clear_scratch  # noqa: E402
from workload import queries  # noqa: E402

HEADLINE = [
    "weekly_snapshot", "snapshot_kpi_by_territory", "weekly_snapshot_all_countries",
    "upsert_history", "clean_trips", "clean_table_job", "stage_counts", "impute_group_median",
    "dedup_exact", "duplicate_rows", "duplicate_keys", "uniqueness_report", "quantile_trim",
    "kpi", "kpi_by_territory", "median_by_category", "avg_by_hour", "profile_numeric",
    "profile_categorical", "null_rates", "missing_rate_by_dim", "corr_matrix", "histogram",
    "density_by_category", "box_stats", "ols_trend", "decile_means", "rate_and_count",
    "features_post", "strat_split", "sample_points", "encoded_features", "error_metrics",
    "error_by_quintile", "worst_trips",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> None:
        queries.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

    queries.prepare(spark)
    run("weekly_snapshot")  # starts the session's workers and code generation
    seconds = {
        "staging": timed(lambda: queries.staged(spark, folder)),
        "predictions": timed(lambda: queries.predicted(spark, folder)),
    }
    for name in sys.argv[1:] or HEADLINE:
        run(name)
        seconds[name] = timed(lambda name=name: run(name))
    if os.environ.get("BENCH_TRAIN", "1") != "0" and not sys.argv[1:]:
        seconds["train_select_pre"] = timed(lambda: run("train_select_pre"))
    print(json.dumps({
        "metric": "total time of the headline queries, training included",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
        "cpus": int(cpus),
    }))
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
