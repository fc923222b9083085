"""Smooth density curves and histograms whose bins the data choose.

Rows are only counted: a density puts each value on its two neighbours of a grid (linear binning) and
smooths the grid, so its second half works on a few hundred numbers a group, whatever the rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmeter.operators.quantiles import exact_quantiles
from tripmeter.operators.skew import join_facts


def _present(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    x = F.col(value).cast("double")
    rows = df.select(*by, x.alias("_x")).where(x.isNotNull() & ~F.isnan(x))
    return rows.dropna(subset=list(by)) if by else rows


def density_curve(df: DataFrame, value: str, by: Sequence[str] = (), points: int = 200, cut: float = 3.0) -> DataFrame:
    """``by, point, x, density``: a Gaussian kernel estimate at ``points`` + 1 places of each group.

    The bandwidth is the sample deviation times n ** -1/5; the grid reaches ``cut`` bandwidths beyond
    smallest and largest value.  NULL and NaN are skipped.  A group with fewer than two values or with
    one value only has no deviation, and no curve.
    """
    by = list(by)
    rows = _present(df, value, by)
    # Without groups all rows are one, under a key of its own.
    keys = by or ["_all"]
    rows = rows if by else rows.withColumn("_all", F.lit(0))
    bandwidth = F.col("_sd") * F.pow(F.col("_n"), F.lit(-0.2))
    facts = rows.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.stddev_samp("_x").alias("_sd"), F.min("_x").alias("_min"), F.max("_x").alias("_max")
    ).where((F.col("_n") > 1) & (F.col("_min") < F.col("_max")))
    facts = facts.withColumn("_h", bandwidth).select(
        *keys, "_n", "_h", (F.col("_min") - cut * F.col("_h")).alias("_low"),
        ((F.col("_max") - F.col("_min") + 2 * cut * F.col("_h")) / points).alias("_step"),
    )
    place = (F.col("_x") - F.col("_low")) / F.col("_step")
    at = F.least(F.floor(place), F.lit(points - 1)).cast("int")
    binned = join_facts(rows, facts, keys, "_n").select(*keys, "_n", "_h", "_low", "_step", at.alias("_at"), (place - at).alias("_part"))
    masses = binned.groupBy(*keys, "_n", "_h", "_low", "_step", "_at").agg(
        F.sum(1 - F.col("_part")).alias("_here"), F.sum("_part").alias("_next")
    )
    # At most ``points`` numbers a group from here on.
    grid = masses.groupBy(*keys, "_n", "_h", "_low", "_step").agg(F.collect_list(F.struct("_at", "_here", "_next")).alias("_masses"))
    ratio = F.col("_step") / F.col("_h")

    def kernel(distance: Column) -> Column:
        return F.exp(-0.5 * F.pow(distance * ratio, F.lit(2.0)))

    def smoothed(point: Column) -> Column:
        zero = F.lit(0.0)
        return F.aggregate("_masses", zero, lambda sum_, m: sum_ + m["_here"] * kernel(point - m["_at"]) + m["_next"] * kernel(point - m["_at"] - 1))

    curve = F.transform(F.sequence(F.lit(0), F.lit(points)), lambda p: F.struct(p.alias("point"), smoothed(p).alias("mass")))
    scale = F.col("_n") * F.col("_h") * math.sqrt(2 * math.pi)
    return grid.select(*by, "_low", "_step", scale.alias("_scale"), F.explode(curve).alias("c")).select(
        *by, F.col("c.point").alias("point"), (F.col("_low") + F.col("c.point") * F.col("_step")).alias("x"),
        (F.col("c.mass") / F.col("_scale")).alias("density"),
    )


def auto_histogram(df: DataFrame, value: str) -> DataFrame:
    """``bins, bin, bin_start, bin_end, count`` of the bins that hold rows, as many bins as the data ask for.

    The width is the smaller one of twice the quartile distance over the cube root of n, and of the
    range over log2(n) + 1; without a quartile distance the latter.  A constant column is one bin of
    width one around its value; no values give no bins.
    """
    rows = _present(df, value)
    quartiles = exact_quantiles(rows, "_x", [0.25, 0.75]).select("n", (F.col("q")[1] - F.col("q")[0]).alias("iqr"))
    bounds = rows.agg(F.min("_x").alias("low"), F.max("_x").alias("high"))
    # Both are one row.
    facts = F.struct("n", "iqr", "low", "high").alias("f")
    known = quartiles.withColumn("k", F.lit(1)).join(F.broadcast(bounds.withColumn("k", F.lit(1))), "k").select(facts).scalar()
    f = F.col("_f")
    spread = f["high"] - f["low"]
    even = spread / (F.log2(f["n"]) + 1)
    quartile_width = 2 * f["iqr"] / F.pow(f["n"], F.lit(1 / 3))
    width = F.when(quartile_width > 0, F.least(quartile_width, even)).otherwise(even)
    bins = F.when(spread > 0, F.ceil(spread / width)).otherwise(F.lit(1)).cast("long")
    start = F.when(spread > 0, f["low"]).otherwise(f["low"] - 0.5)
    size = F.when(spread > 0, spread / F.col("bins")).otherwise(F.lit(1.0))
    planned = rows.withColumn("_f", known).withColumn("bins", bins)
    index = F.least(F.floor((F.col("_x") - start) / size), F.col("bins") - 1)
    return planned.select("bins", index.cast("long").alias("bin"), start.alias("_start"), size.alias("_size")).groupBy(
        "bins", "bin", "_start", "_size"
    ).agg(F.count("*").alias("count")).select(
        "bins", "bin", (F.col("_start") + F.col("bin") * F.col("_size")).alias("bin_start"),
        (F.col("_start") + (F.col("bin") + 1) * F.col("_size")).alias("bin_end"), "count",
    )
