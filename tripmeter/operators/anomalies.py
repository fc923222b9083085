"""Time checks on trips: differences, consistency flags and rows that break them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmeter.functions.clock import flag, minutes_between
from tripmeter.functions.values import MISSING_MARKER

OFFERED = "restaurant_offered_timestamp_local"
FINAL = "order_final_state_timestamp_local"
REQUEST = "eater_request_timestamp_local"

# The compared time pairs (later, earlier) and the tolerance in minutes.
TIME_DIFFERENCES = {
    "diff_final_minus_offered": (FINAL, OFFERED),
    "diff_offered_minus_final": (OFFERED, FINAL),
    "diff_final_minus_request": (FINAL, REQUEST),
    "diff_offered_minus_request": (OFFERED, REQUEST),
    "diff_request_minus_offered": (REQUEST, OFFERED),
    "diff_request_minus_final": (REQUEST, FINAL),
}
MATCHED_DIFFERENCES = [
    "diff_final_minus_offered",
    "diff_offered_minus_final",
    "diff_final_minus_request",
    "diff_offered_minus_request",
]
MATCH_TOLERANCE = 0.01
EVIDENCE = [REQUEST, OFFERED, FINAL, "ATD"]


def time_differences(df: DataFrame) -> DataFrame:
    """Add all signed time differences in minutes."""
    return df.withColumns({
        name: minutes_between(F.col(later), F.col(earlier))
        for name, (later, earlier) in TIME_DIFFERENCES.items()
    })


def match_rates(df: DataFrame, target: str = "ATD") -> DataFrame:
    """Percentage of all rows on which each difference equals the target."""
    diffs = time_differences(df)
    rates = diffs.agg(*[
        (100 * F.avg(flag(F.abs(F.col(name) - F.col(target)) < MATCH_TOLERANCE))).alias(name)
        for name in MATCHED_DIFFERENCES
    ])
    return rates.unpivot([], MATCHED_DIFFERENCES, "difference", "match_pct")


def time_flags(df: DataFrame) -> DataFrame:
    """Add 0/1 flags: offered exactly at the request, offered after the final state."""
    return df.withColumns({
        "offered_equals_request": flag(F.col(OFFERED) == F.col(REQUEST)),
        "offered_after_final": flag(F.col(OFFERED) > F.col(FINAL)),
    })


def valid_offer(df: DataFrame) -> DataFrame:
    """Add ``valid_offered``: the offer does not come after the final state."""
    return df.withColumn("valid_offered", F.coalesce(F.col(OFFERED) <= F.col(FINAL), F.lit(False)))


def missing_flags(df: DataFrame) -> DataFrame:
    """Add 0/1 flags for missing distances, offer time and courier flow."""
    return df.withColumns({
        "missing_pickup": flag(F.col("pickup_distance").isNull()),
        "missing_dropoff": flag(F.col("dropoff_distance").isNull()),
        "missing_rest_ts": flag(F.col(OFFERED).isNull()),
        "missing_courier_flow": flag(F.col("courier_flow") == MISSING_MARKER),
    })


def negative_target(df: DataFrame, target: str = "ATD") -> DataFrame:
    return df.where(F.col(target) < 0)


def zero_target(df: DataFrame, target: str = "ATD") -> DataFrame:
    return df.where(F.col(target) == 0)


def marked_missing(df: DataFrame, column: str = "courier_flow") -> DataFrame:
    return df.where(F.col(column) == MISSING_MARKER)


def offered_after_final(df: DataFrame, columns: Sequence[str] = EVIDENCE) -> DataFrame:
    return df.where(F.col(OFFERED) > F.col(FINAL)).select(*columns)


def requested_after_final(df: DataFrame, columns: Sequence[str] = EVIDENCE) -> DataFrame:
    return df.where(F.col(REQUEST) > F.col(FINAL)).select(*columns)


def target_equals_difference(
    df: DataFrame, difference: str = "diff_final_minus_offered", columns: Sequence[str] = EVIDENCE
) -> DataFrame:
    """Rows whose time difference is exactly the target."""
    return time_differences(df).where(F.col(difference) == F.col("ATD")).select(*columns)
