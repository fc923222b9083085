"""Confidence intervals by a Poisson bootstrap: every row has a weight in every replicate, from a hash of its key.

All replicates are weighted sums, so one pass over the rows gives all of them, combined before the
shuffle; the result depends on keys only, and SQL can repeat it.  A row is taken once per digest, which
holds the numbers of eight replicates: digest and numbers are worked out once, and the sums of eight
replicates are few enough for compiled code, whatever the number of replicates.  A digest is taken as
bytes: a number is a copy of four of them, where text would be walked from its start for each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Chances of at most 0, 1, 2, … of a Poisson number of mean 1, in 65,536ths.
POISSON = ["5e2d", "bc5a", "eb71", "fb23", "ff10", "ffd9", "fffa", "ffff"]
PER_HASH = 8  # a digest holds eight numbers of 16 bits


def _digest(key: Column, i: Column) -> Column:
    """The digits of a digest, as bytes."""
    return F.md5(F.concat(key.cast("string"), F.lit(":"), i.cast("string")).cast("binary")).cast("binary")


def _number(digest: Column, place: int) -> Column:
    """Four digits; bytes of digits have the order of their numbers."""
    return F.substring(digest, 1 + 4 * place, 4)


def _weight(number: Column) -> Column:
    """A Poisson number of mean 1; the small and usual ones are tried first."""
    chosen = F
    for w, least in enumerate(POISSON):
        chosen = chosen.when(number < F.lit(least.encode()), w)
    return chosen.otherwise(len(POISSON))


def weights(key: Column, replicates: int) -> list[Column]:
    """A Poisson number of mean 1 for each replicate."""
    return [_weight(_number(_digest(key, F.lit(i // PER_HASH)), i % PER_HASH)) for i in range(replicates)]


def _drawn(rows: DataFrame, key: str, replicates: int, given: Column | None = None) -> tuple[DataFrame, list[str]]:
    """Every row once per digest ``_i``, with its weights in the replicates of that digest, and their names.

    Weights are NULL where ``given`` is false, and beyond the last replicate.
    """
    places, kept = range(min(PER_HASH, replicates)), [c for c in rows.columns if c != key]
    turns = F.array(*[F.lit(i) for i in range(-(-replicates // PER_HASH))])
    # Each step is used more than once by the next, so Spark keeps them apart.
    digests = rows.select(*rows.columns, F.explode(turns).alias("_i")).select(*kept, "_i", _digest(F.col(key), F.col("_i")).alias("_digest"))
    numbers = digests.select(*kept, "_i", *[_number(F.col("_digest"), j).alias(f"_n{j}") for j in places])

    def weight(j: int) -> Column:
        there = F.col("_i") * PER_HASH + j < replicates
        return F.when(there if given is None else given & there, _weight(F.col(f"_n{j}"))).alias(f"_w{j}")

    return numbers.select(*kept, "_i", *[weight(j) for j in places]), [f"_w{j}" for j in places]


def _interval(values: Column, level: float) -> list[Column]:
    """Two quantiles of an array, with linear interpolation; NULL elements are left out."""
    ordered = F.array_sort(F.filter(values, lambda v: v.isNotNull()))

    def quantile(p: float) -> Column:
        position = p * (F.size(ordered) - 1)
        low = F.get(ordered, F.floor(position).cast("int"))
        high = F.get(ordered, F.ceil(position).cast("int"))
        return low + (high - low) * (position - F.floor(position))

    return [quantile((1 - level) / 2).alias("low"), quantile((1 + level) / 2).alias("high")]


def bootstrap_mean(
    df: DataFrame, value: str, key: str, by: Sequence[str] = (), replicates: int = 40, level: float = 0.95
) -> DataFrame:
    """``by, n, mean, low, high``: the mean of each group and its interval; a rate is the mean of a flag.

    ``key`` names the row: rows of one key are drawn together.  NULL values and keys are skipped; a group
    without values has NULLs.
    """
    rows = df.where(F.col(key).isNotNull()).select(*by, F.col(value).cast("double").alias("_x"), F.col(key).alias("_key"))
    drawn, names = _drawn(rows, "_key", replicates, F.col("_x").isNotNull())
    sums = [F.try_divide(F.sum(F.col(w) * F.col("_x")), F.sum(w)) for w in names]
    found = drawn.groupBy(*by, "_i").agg(F.count("_x").alias("n"), F.avg("_x").alias("mean"), F.array(*sums).alias("_means"))
    # One row per group and digest from here on.
    once = F.col("_i") == 0
    whole = found.groupBy(*by).agg(
        F.coalesce(F.max(F.when(once, F.col("n"))), F.lit(0)).alias("n"),
        F.max(F.when(once, F.col("mean"))).alias("mean"),
        F.flatten(F.collect_list("_means")).alias("_means"),
    )
    return whole.select(*by, "n", "mean", *_interval(F.col("_means"), level))


def bootstrap_slope(df: DataFrame, x: str, y: str, key: str, replicates: int = 40, level: float = 0.95) -> DataFrame:
    """``n, slope, low, high`` of the least-squares line of ``y`` over ``x``: five weighted sums a replicate.

    Rows that lack a value or the key are skipped; replicates without a spread of ``x`` are left out.
    """
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    whole = df.where(a.isNotNull() & b.isNotNull() & F.col(key).isNotNull())
    # Sums of differences from the means: those of large numbers would cancel.
    centre = whole.agg(F.struct(F.avg(a).alias("x"), F.avg(b).alias("y")).alias("c")).scalar()
    shifted = whole.withColumn("_c", centre).select(
        (a - F.col("_c.x")).alias("_a"), (b - F.col("_c.y")).alias("_b"), F.col(key).alias("_key")
    )
    drawn, names = _drawn(shifted, "_key", replicates)

    def slope(w: Column) -> Column:
        n, sa, sb = F.sum(w), F.sum(w * F.col("_a")), F.sum(w * F.col("_b"))
        saa, sab = F.sum(w * F.col("_a") * F.col("_a")), F.sum(w * F.col("_a") * F.col("_b"))
        spread = n * saa - sa * sa
        return F.when(spread > 0, (n * sab - sa * sb) / spread)

    found = drawn.groupBy("_i").agg(
        F.count("*").alias("n"), slope(F.lit(1)).alias("slope"), F.array(*[slope(F.col(w)) for w in names]).alias("_slopes")
    )
    # One row per digest from here on.
    once = F.col("_i") == 0
    whole = found.agg(
        F.coalesce(F.max(F.when(once, F.col("n"))), F.lit(0)).alias("n"),
        F.max(F.when(once, F.col("slope"))).alias("slope"),
        F.flatten(F.collect_list("_slopes")).alias("_slopes"),
    )
    return whole.select("n", "slope", *_interval(F.col("_slopes"), level))
