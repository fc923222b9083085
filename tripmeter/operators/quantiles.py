"""Exact quantiles without holding a group in one task.

``percentile`` keeps a map of all values of a group in one buffer.  Here values are
counted first (combined before the shuffle), the line of values is cut into slices, and only
the few slices that contain a wanted rank are sorted.  A slice is at most about 0.02 % wide
relative to its values, and at most 1/4096 of the whole range: the first cuts long tails, the
second values far from zero such as timestamps.  A slice index is monotone in the value, so
ranks are exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICES_PER_UNIT = 4096  # slices per unit of ln(1+|x|): at most 2 * 710 * 4096 per group
SLICES_OF_RANGE = 4096


def _slice(value: Column, low: Column, high: Column) -> Column:
    size = F.least(F.log1p(F.abs(value)), F.lit(710.0))
    relative = F.floor(F.signum(value) * size * SLICES_PER_UNIT).cast("int")
    share = F.nanvl(F.try_divide(value - low, high - low), F.lit(0.0))
    linear = F.floor(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * SLICES_OF_RANGE).cast("int")
    # Both grow with the value, so their sum is the same for two values only if both are.
    return F.coalesce(relative, F.lit(0)) + F.coalesce(linear, F.lit(0))


def value_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """``by`` columns, each distinct value as ``_x`` and its rows as ``_c``; NULL and NaN are skipped."""
    by = list(by)
    usable = reduce(
        lambda a, b: a & b,
        [F.col(key).isNotNull() for key in by],
        F.col("_x").isNotNull() & ~F.isnan("_x"),
    )
    return (
        df.select(*by, F.col(value).cast("double").alias("_x"))
        .where(usable)
        .groupBy(*by, "_x")
        .agg(F.count("*").alias("_c"))
    )


def exact_quantiles(
    df: DataFrame, value: str, probabilities: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """One row per group: ``by`` columns, ``n`` non-null values, ``q`` array of quantiles.

    Linear interpolation between neighbours.  NULL and NaN values are skipped, groups
    with a NULL key or without values have no row.
    """
    return quantiles_of_counts(value_counts(df, value, by), probabilities, by)


def quantiles_of_counts(counted: DataFrame, probabilities: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """:func:`exact_quantiles` of rows that are counted already, as :func:`value_counts` does."""
    by = list(by)
    bounds = counted.agg(F.struct(F.min("_x").alias("low"), F.max("_x").alias("high")).alias("b")).scalar()
    counted = counted.withColumn("_b", bounds)  # referenced once, planned once
    counted = counted.withColumn("_slice", _slice(F.col("_x"), F.col("_b.low"), F.col("_b.high"))).drop("_b")

    group = Window.partitionBy(*by)
    earlier = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        counted.groupBy(*by, "_slice")
        .agg(F.sum("_c").alias("_c"))
        .select(
            *by,
            "_slice",
            F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_start"),
            F.col("_c").alias("_size"),
            F.sum("_c").over(group).alias("n"),
        )
    )

    # The ranks on both sides of every wanted position, and those that fall into a run of rows.
    positions = F.transform(
        F.array(*[F.lit(float(p)) for p in probabilities]), lambda p: p * (F.col("n") - 1)
    )
    ranks = F.array_distinct(
        F.concat(
            F.transform(positions, lambda p: F.floor(p)),
            F.transform(positions, lambda p: F.ceil(p)),
        )
    )

    def inside(start: Column, size: Column) -> Column:
        return F.filter(F.col("_ranks"), lambda r: (start <= r) & (r < start + size))

    wanted = (
        slices.withColumn("_ranks", ranks)
        .withColumn("_ranks", inside(F.col("_start"), F.col("_size")))
        .where(F.size("_ranks") > 0)
        .drop("_size")
    )
    # Without groups there are at most two slices per probability.
    wanted = wanted if by else F.broadcast(wanted)

    earlier = Window.partitionBy(*by, "_slice").orderBy("_x")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("_start") + F.coalesce(F.sum("_c").over(earlier), F.lit(0))
    picked = (
        counted.join(wanted, [*by, "_slice"])
        .withColumn("_first", first)
        .select(*by, "n", "_x", F.explode(inside(F.col("_first"), F.col("_c"))).alias("_rank"))
        .groupBy(*by)
        .agg(
            F.max("n").alias("n"),
            F.map_from_entries(F.collect_list(F.struct("_rank", "_x"))).alias("_at"),
        )
        .where(F.col("n").isNotNull())
    )

    def interpolate(position: Column) -> Column:
        low = F.element_at("_at", F.floor(position))
        high = F.element_at("_at", F.ceil(position))
        return low + (high - low) * (position - F.floor(position))

    return picked.select(*by, "n", F.transform(positions, interpolate).alias("q"))


def quantile_array(df: DataFrame, value: str, probabilities: Sequence[float]) -> Column:
    """Quantiles of a whole column as one array, to be used inside another query."""
    return exact_quantiles(df, value, probabilities).select("q").scalar()


def named_quantiles(df: DataFrame, value: str, probabilities: Sequence[float]) -> DataFrame:
    """Rows ``(quantile, value)``."""
    names = F.array(*[F.lit(float(p)) for p in probabilities])
    return (
        exact_quantiles(df, value, probabilities)
        .select(F.explode(F.arrays_zip(names.alias("quantile"), F.col("q").alias("value"))).alias("r"))
        .select("r.quantile", "r.value")
    )


def quantile_trim(df: DataFrame, value: str, low: float = 0.02, high: float = 0.98) -> DataFrame:
    """Rows whose value lies between two quantiles, both ends included."""
    edges = quantile_array(df, value, [low, high])
    return df.where((F.col(value) >= edges[0]) & (F.col(value) <= edges[1]))


def quantile_bin(df: DataFrame, value: str, bins: int, into: str = "bin") -> DataFrame:
    """Add the 0-based quantile bin: right-closed, lowest value included, NULL stays NULL.

    Equal edges are an error, as there would be fewer bins than asked for.
    """
    found = exact_quantiles(df, value, [i / bins for i in range(bins + 1)])
    repeated = F.size(F.array_distinct("q")) <= bins
    error = F.raise_error(F.lit(f"bin edges of {value} must be unique")).cast("array<double>")
    # One reference, whatever the number of bins: each further one would be planned again.
    inner = found.select(F.when(repeated, error).otherwise(F.slice("q", 2, bins - 1)).alias("q")).scalar()
    x = F.col(value).cast("double")
    above = F.size(F.filter("_edges", lambda edge: edge < x))
    return df.withColumn("_edges", inner).withColumn(into, F.when(x.isNotNull(), above)).drop("_edges")
