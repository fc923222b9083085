"""Data-quality reports: missing and non-positive values, keys, declared constraints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns whose gaps are reported, allowed job states, alert level.
CRITICAL_COLUMNS = ["ATD", "pickup_distance", "dropoff_distance", "territory"]
JOB_STATES = ["completed", "pending"]
DUPLICATE_ALERT = 10


def _checks(df: DataFrame, checks: list[tuple[str, str, Column]]) -> DataFrame:
    """Count the rows that violate each ``(check, column, violation)``, in one pass."""
    counts = [
        F.count_if(F.coalesce(bad, F.lit(False))).alias(f"c{i}")
        for i, (_, _, bad) in enumerate(checks)
    ]
    row = df.agg(F.count("*").alias("rows"), *counts)
    entries = F.array(*[
        F.struct(
            F.lit(check).alias("check"), F.lit(column).alias("column"), F.col(f"c{i}").alias("n")
        )
        for i, (check, column, _) in enumerate(checks)
    ])
    pct = F.try_divide(100 * F.col("r.n").cast("double"), F.col("rows").cast("double"))
    return row.select(F.explode(entries).alias("r"), "rows").select(
        "r.check", "r.column", "r.n", pct.alias("pct")
    )


def dq_report(df: DataFrame, columns: Sequence[str] = CRITICAL_COLUMNS) -> DataFrame:
    """Findings only: absent columns (all rows), missing values, targets at or below zero."""
    checks = [
        ("missing_values", c, F.col(c).isNull())
        if c in df.columns
        else ("missing_column", c, F.lit(True))
        for c in columns
    ]
    if "ATD" in df.columns:
        checks.append(("non_positive", "ATD", F.col("ATD") <= 0))
    return _checks(df, checks).where((F.col("n") > 0) | (F.col("check") == "missing_column"))


def warning_messages(report: DataFrame) -> DataFrame:
    """The report as readable lines."""
    number = F.format_number("n", 0)
    text = (
        F.when(F.col("check") == "missing_column", F.concat(F.lit("Missing column "), "column"))
        .when(
            F.col("check") == "missing_values",
            F.concat(
                "column", F.lit(": "), number,
                F.lit(" missing ("), F.format_number("pct", 1), F.lit("%)"),
            ),
        )
        .otherwise(F.concat("column", F.lit(": "), number, F.lit(" values not above zero")))
    )
    return report.select("check", "column", text.alias("message"))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; empty when the key is unique."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def duplicate_report(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Number of rows in duplicate sets and whether that is alarming."""
    keys = list(subset or df.columns)
    counted = df.groupBy(*keys).agg(F.count("*").alias("n"))
    rows = F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))
    return counted.agg(rows.alias("duplicate_rows")).select(
        "duplicate_rows", (F.col("duplicate_rows") >= DUPLICATE_ALERT).alias("alert")
    )


def job_constraints(jobs: DataFrame) -> DataFrame:
    """Violations of the declared constraints of dispatch jobs."""
    required = ["job_uuid", "city_id", "date_str", "pickup_distance", "travel_distance"]
    required += [c for c in ["is_final_plan", "delivery_status"] if c in jobs.columns]
    checks = [("not_null", c, F.col(c).isNull()) for c in required]
    checks += [("not_negative", c, F.col(c) < 0) for c in ["pickup_distance", "travel_distance"]]
    if "delivery_status" in jobs.columns:
        unknown = ~F.col("delivery_status").isin(JOB_STATES)
        checks.append(("allowed_value", "delivery_status", unknown))
    return _checks(jobs, checks)


def trip_constraints(trips: DataFrame) -> DataFrame:
    """Violations of the declared constraints of trips."""
    required = ["delivery_trip_uuid", "workflow_uuid", "driver_uuid"]
    checks = [("not_null", c, F.col(c).isNull()) for c in required]
    if "total_distance_travelled" in trips.columns:
        bad = F.col("total_distance_travelled") < 0
        checks.append(("not_negative", "total_distance_travelled", bad))
    return _checks(trips, checks)


def history_constraints(history: DataFrame) -> DataFrame:
    required = ["batch_date", "week_start", "week_end", "delivery_trip_uuid"]
    return _checks(history, [("not_null", c, F.col(c).isNull()) for c in required])


def text_lengths(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Texts longer than their declared length."""
    return _checks(df, [("max_length", c, F.length(c) > n) for c, n in limits.items()])


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Fail when a key occurs twice (one small job)."""
    repeated = repeated_keys(df, keys).limit(1).collect()
    if repeated:
        raise ValueError(f"key {list(keys)} is not unique, for example {repeated[0].asDict()}")

