"""Figures over the whole history from counts that are stored beside it.

For every batch the counted values of each figure are kept, by category: exact, and they add up over
batches.  An upsert rewrites those of its own batch, so KPIs and percentiles over years read counts,
not trips.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmeter import schemas
from tripmeter.operators.quantiles import quantiles_of_counts
from tripmeter.plans.history import upsert_history
from tripmeter.sources import versions

BATCH = "batch_date"


def partials_path(history: str) -> str:
    return f"{history.rstrip('/')}_partials"


def counted_values(trips: DataFrame, figures: Sequence[str], by: Sequence[str]) -> DataFrame:
    """``batch_date, by, figure, value, n``: how often each value occurs (NULL is a value)."""
    long = trips.select(BATCH, *by, *[F.col(c).cast("double").alias(c) for c in figures])
    long = long.unpivot([BATCH, *by], list(figures), "figure", "value")
    return long.groupBy(BATCH, *by, "figure", "value").agg(F.count("*").alias("n"))


def write_partials(trips: DataFrame, path: str, figures: Sequence[str], by: Sequence[str]) -> None:
    """Replace the partials of the batches that occur in ``trips``, which has all rows of those batches."""
    versions.replace_partitions(counted_values(trips, figures, by), path, BATCH)


def upsert_with_partials(
    spark: SparkSession, path: str, snapshot: DataFrame, ds: str, figures: Sequence[str], by: Sequence[str], now: dt.datetime | None = None
) -> DataFrame:
    """:func:`upsert_history`, and the partials of its batch made anew from the merged partition.

    A run that dies in between leaves partials of the state before; the next run of the batch, which is
    repeated until it succeeds, makes them good.
    """
    history = upsert_history(spark, path, snapshot, ds, now)
    own = history.where(F.col(BATCH) == F.lit(ds).cast("date"))
    write_partials(own, partials_path(path), figures, by)
    return history


def kpis_of_partials(partials: DataFrame, figure: str, probabilities: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """``by, n_trips, n, avg`` and the named percentiles of a figure, from counts only.

    Groups with a NULL key are left out; a group without values has NULLs.
    """
    by = list(by)
    own = partials.where(F.col("figure") == figure).dropna(subset=by) if by else partials.where(F.col("figure") == figure)
    merged = own.groupBy(*by, "value").agg(F.sum("n").alias("_c")).withColumnRenamed("value", "_x")
    valued = merged.where(F.col("_x").isNotNull())
    sums = merged.groupBy(*by).agg(
        F.sum("_c").alias("n_trips"), F.sum(F.when(F.col("_x").isNotNull(), F.col("_c"))).alias("n"),
        F.try_divide(F.sum(F.col("_x") * F.col("_c")), F.sum(F.when(F.col("_x").isNotNull(), F.col("_c")))).alias("avg"),
    )
    quantiles = quantiles_of_counts(valued, list(probabilities.values()), by).drop("n")
    if by:
        same = reduce(lambda a, b: a & b, [F.col(f"s.{c}") == F.col(f"q.{c}") for c in by])
        joined = sums.alias("s").join(quantiles.alias("q"), same, "left")
    else:
        joined = sums.alias("s").withColumn("q", quantiles.select("q").scalar())
    return joined.select(
        *[F.col(f"s.{c}") for c in by], "n_trips", F.coalesce("n", F.lit(0)).alias("n"), "avg",
        *[F.col("q")[i].alias(name) if not by else F.col("q.q")[i].alias(name) for i, name in enumerate(probabilities)],
    )


def read_partials(spark: SparkSession, path: str, ds: str | None = None) -> DataFrame:
    """All partials, or those of batches up to a day."""
    found = versions.read(spark, path)
    return found if ds is None else found.where(F.col(BATCH) <= F.lit(ds).cast("date"))


FIGURES = ("atd", *[c for c in schemas.TRIP_HISTORY.fieldNames() if c.endswith("_km")])
