"""Clean trips from the history: the fixed sequence of cleaning steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmeter.functions.clock import flag, parse_wall_clock, utc_to_local
from tripmeter.functions.values import MISSING_WORD, missing_flag, replace_marker, to_number
from tripmeter.operators.anomalies import time_flags
from tripmeter.operators.cleaning import drop_exact_duplicates, impute_group_median
from tripmeter.operators.quantiles import quantile_trim
from tripmeter.schemas import DISTANCES, IDENTIFIERS
from tripmeter.sources.tables import append_rows

# History columns under the names of the analysis.
RENAMES = {
    "pickup_distance_km": "pickup_distance",
    "dropoff_distance_km": "dropoff_distance",
    "atd": "ATD",
}


def typed_trips(history: DataFrame, utc_offset: int) -> DataFrame:
    """Analysis names and types; the offer time becomes local wall-clock time."""
    renamed = history.withColumnsRenamed(RENAMES)
    return renamed.withColumns({
        **{c: to_number(F.col(c)) for c in [*DISTANCES, "ATD"]},
        "order_final_state_timestamp_local": parse_wall_clock(
            F.col("order_final_state_timestamp_local")
        ),
        "eater_request_timestamp_local": parse_wall_clock(F.col("eater_request_timestamp_local")),
        "restaurant_offered_timestamp_local": utc_to_local(
            F.col("restaurant_offered_timestamp_utc"), utc_offset
        ),
    }).drop("restaurant_offered_timestamp_utc")


def prepared_trips(
    history: DataFrame, utc_offset: int, keep: Sequence[str] = ()
) -> DataFrame:
    """Typed trips without exact duplicates and without identifiers (but for ``keep``)."""
    unique = drop_exact_duplicates(typed_trips(history, utc_offset))
    return unique.drop(*[c for c in IDENTIFIERS if c not in keep])


def complete_trips(trips: DataFrame, missing_word: str = MISSING_WORD) -> DataFrame:
    """Impute distances, replace the marker, require an offer time and flag time relations."""
    marked = trips.withColumn("missing_distance", missing_flag(F.col("pickup_distance")))
    filled = impute_group_median(marked, "territory", DISTANCES)
    worded = filled.withColumn("courier_flow", replace_marker(F.col("courier_flow"), missing_word))
    return time_flags(worded.na.drop(subset=["restaurant_offered_timestamp_local"]))


def valid_trips(flagged: DataFrame) -> DataFrame:
    """Trips offered before their end and with a positive duration."""
    valid = flagged.where((F.col("offered_after_final") == 0) & (F.col("ATD") > 0))
    return valid.drop("offered_after_final")


def clean_trips(
    history: DataFrame,
    utc_offset: int,
    missing_word: str = MISSING_WORD,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The whole sequence.  ``keep`` retains identifier columns for later joins and splits.

    Duplicates are compared on all columns, batch date included: a trip that belongs to
    two batches stays twice.
    """
    return valid_trips(complete_trips(prepared_trips(history, utc_offset, keep), missing_word))


def stage_trips(
    spark: SparkSession,
    history: DataFrame,
    utc_offset: int,
    path: str,
    missing_word: str = MISSING_WORD,
    keep: Sequence[str] = (),
    metrics: str | None = None,
    run: str = "",
) -> tuple[DataFrame, DataFrame]:
    """The sequence with its two intermediate tables written below ``path``.

    Returns the distinct trips (``prepared``) and the imputed, flagged trips (``flagged``);
    ``valid_trips(flagged)`` are the clean trips.  On large data this is the way to run it:
    the rows are de-duplicated once, the medians read three columns of the written table,
    only rows with gaps are read for imputation, and all later jobs start from a plain
    scan that any executor can repeat.

    With ``metrics`` the rows at every stage are counted by the write itself and added to the table
    at that path, one row per ``run``.
    """
    prepared, counters = (
        _counted_trips(history, utc_offset, keep) if metrics else (prepared_trips(history, utc_offset, keep), None)
    )
    prepared.write.mode("overwrite").parquet(f"{path}/prepared")
    if counters:
        figures = counters.get
        schema = ", ".join(["run string", *[f"{c} bigint" for c in STAGES], "clean_total double"])
        row = (run, *[figures[c] or 0 for c in STAGES], figures["clean_total"])
        append_rows(spark.createDataFrame([row], schema), metrics)
    prepared = spark.read.schema(prepared.schema).parquet(f"{path}/prepared")
    flagged = complete_trips(prepared, missing_word)
    flagged.write.mode("overwrite").parquet(f"{path}/flagged")
    return prepared, spark.read.schema(flagged.schema).parquet(f"{path}/flagged")


def _counted_trips(history: DataFrame, utc_offset: int, keep: Sequence[str]) -> tuple[DataFrame, Observation]:
    """:func:`prepared_trips` that counts its stages while it is written.

    The counts are taken behind the last shuffle, where Spark counts each task of a write once even if
    it has to run it again.
    """
    typed = typed_trips(history, utc_offset)
    distinct = typed.groupBy(*typed.columns).agg(F.count("*").alias("_copies"))
    counters = Observation("stages")
    seen = time_flags(distinct).observe(counters, *_stage_figures())
    return seen.select(*[c for c in typed.columns if c not in IDENTIFIERS or c in keep]), counters


#: Rows read and rows left after each dropping step.
STAGES = ("rows_read", "distinct_rows", "with_offer", "in_order", "clean_rows")


def _stage_figures() -> list[Column]:
    """Rows at every stage, and the sum of clean durations, over distinct flagged trips with ``_copies``.

    Every step keeps or drops a row on its own, so one pass is enough.
    """
    offered = F.col("restaurant_offered_timestamp_local").isNotNull()
    in_order = offered & (F.col("offered_after_final") == 0)
    valid = flag(in_order & (F.col("ATD") > 0)) == 1
    counts = (F.coalesce(F.sum("_copies"), F.lit(0)), F.count("*"), F.count_if(offered), F.count_if(in_order), F.count_if(valid))
    return [*[n.alias(c) for n, c in zip(counts, STAGES)], F.sum(F.when(valid, F.col("ATD"))).alias("clean_total")]


def stage_counts(history: DataFrame, utc_offset: int) -> DataFrame:
    """Rows read and rows left after each dropping step, as one result row, from a pass of its own."""
    typed = typed_trips(history, utc_offset)
    distinct = time_flags(typed.groupBy(*typed.columns).agg(F.count("*").alias("_copies")))
    return distinct.agg(*_stage_figures()).select(*STAGES)


def trimmed_trips(clean: DataFrame, low: float = 0.02, high: float = 0.98) -> DataFrame:
    """Clean trips within two quantiles of the duration, for exploration."""
    return quantile_trim(clean, "ATD", low, high)
