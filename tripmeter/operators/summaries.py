"""Small result tables for reports: KPIs, counts, means, histograms, boxes, trends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmeter.functions.clock import weekday_label, weekday_number
from tripmeter.functions.values import any_null
from tripmeter.operators.quantiles import exact_quantiles, quantile_array, quantile_bin, value_counts
from tripmeter.operators.reshape import columns_to_rows
from tripmeter.operators.skew import join_facts


def kpis(df: DataFrame, target: str = "ATD") -> DataFrame:
    """One row: mean, median and 90th percentile of the target, and the number of trips.

    Trips without a target count as trips; an empty input gives NULLs and 0.
    """
    q = quantile_array(df, target, [0.5, 0.9])
    totals = df.agg(F.avg(target).alias("avg_atd"), F.count("*").alias("n_trips"))
    return totals.select(
        "avg_atd", q[0].alias("median_atd"), q[1].alias("p90_atd"), "n_trips"
    )


def kpis_by(df: DataFrame, by: Sequence[str], target: str = "ATD") -> DataFrame:
    """The KPIs per group; groups without a key are left out."""
    by = list(by)
    for key in by:
        df = df.where(F.col(key).isNotNull())
    quantiles = exact_quantiles(df, target, [0.5, 0.9], by)
    quantiles = quantiles.select(
        *by, F.col("q")[0].alias("median_atd"), F.col("q")[1].alias("p90_atd")
    )
    totals = df.groupBy(*by).agg(F.avg(target).alias("avg_atd"), F.count("*").alias("n_trips"))
    return totals.join(quantiles, by, "left").select(
        *by, "avg_atd", "median_atd", "p90_atd", "n_trips"
    )


def counts_by(df: DataFrame, category: str) -> DataFrame:
    """Rows per category, most frequent first, then by name."""
    return (
        df.where(F.col(category).isNotNull())
        .groupBy(category)
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), category)
    )


def medians_by(df: DataFrame, categories: Sequence[str], target: str = "ATD") -> DataFrame:
    """Median per value of each category, ascending; all categories in one pass."""
    texts = [F.col(c).cast("string").alias(c) for c in categories]
    long = columns_to_rows(df.select(*texts, target), [target], categories, "category", "value")
    return (
        exact_quantiles(long, target, [0.5], ["category", "value"])
        .select("category", "value", F.col("q")[0].alias("median"))
        .orderBy("category", "median", "value")
    )


def mean_by(df: DataFrame, keys: Sequence[str], target: str = "ATD") -> DataFrame:
    """Mean and number of present values per key, in key order."""
    keys = list(keys)
    return (
        df.na.drop(subset=keys)
        .groupBy(*keys)
        .agg(F.avg(target).alias("mean"), F.count(target).alias("n"))
        .orderBy(*keys)
    )


def mean_by_weekday(df: DataFrame, ts: str, target: str = "ATD") -> DataFrame:
    return (
        df.withColumn("day_of_week", weekday_number(F.col(ts)))
        .where(F.col("day_of_week").isNotNull())
        .groupBy("day_of_week")
        .agg(F.avg(target).alias("mean"))
        .select("day_of_week", weekday_label(F.col("day_of_week")).alias("day_label"), "mean")
        .orderBy("day_of_week")
    )


def filter_options(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of each column as sorted rows ``(column, value)``."""
    return (
        df.select(*columns)
        .unpivot([], list(columns), "column", "value")
        .where(F.col("value").isNotNull())
        .distinct()
        .orderBy("column", "value")
    )


def _range(df: DataFrame, value: str) -> Column:
    """Smallest and largest value of a column, to be used inside another query."""
    bounds = F.struct(F.min(value).alias("low"), F.max(value).alias("high"))
    return df.agg(bounds.alias("range")).scalar()


def _bin_index(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based equal-width bin; the largest value belongs to the last bin."""
    index = F.floor((value - low) * bins / (high - low))
    return F.when(high == low, F.lit(0)).otherwise(F.least(index, F.lit(bins - 1))).cast("int")


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width histogram between minimum and maximum, empty bins included."""
    present = df.select(F.col(value).cast("double").alias("x")).where(F.col("x").isNotNull())
    bounds = _range(present, "x")
    low, high = bounds["low"], bounds["high"]
    counted = (
        present.select(_bin_index(F.col("x"), low, high, bins).alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("count"))
    )
    width = (high - low) / bins
    return (
        df.sparkSession.range(bins)
        .select(F.col("id").cast("int").alias("bin"))
        .join(counted, "bin", "left")
        .select(
            "bin",
            (low + F.col("bin") * width).alias("bin_start"),
            (low + (F.col("bin") + 1) * width).alias("bin_end"),
            F.coalesce("count", F.lit(0)).alias("count"),
        )
        .orderBy("bin")
    )


def density_by(df: DataFrame, value: str, category: str, bins: int = 50) -> DataFrame:
    """Histogram per category on common bins, every category normalised on its own."""
    present = df.select(category, F.col(value).cast("double").alias("x"))
    present = present.where(F.col("x").isNotNull() & F.col(category).isNotNull())
    bounds = _range(present, "x")
    low, high = bounds["low"], bounds["high"]
    counted = (
        present.select(category, _bin_index(F.col("x"), low, high, bins).alias("bin"))
        .groupBy(category, "bin")
        .agg(F.count("*").alias("count"))
    )
    # At most ``bins`` rows per category from here on.
    total = F.sum("count").over(Window.partitionBy(category))
    # A constant column is one bin of width one.
    width = F.when(high == low, F.lit(1.0)).otherwise((high - low) / bins)
    return counted.select(
        category, "bin", "count", (F.col("count") / (total * width)).alias("density")
    )


def box_stats(df: DataFrame, value: str, category: str) -> DataFrame:
    """Quartiles per category and the outermost values within 1.5 interquartile ranges."""
    quartiles = exact_quantiles(df, value, [0.25, 0.5, 0.75], [category]).select(
        category, "n", *[F.col("q")[i].alias(c) for i, c in enumerate(["q1", "median", "q3"])]
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    within = F.col("_x").between(F.col("q1") - reach, F.col("q3") + reach)
    # The whiskers are among the distinct values that the quartiles were counted from: the same shuffle.
    return (
        join_facts(value_counts(df, value, [category]), quartiles, [category], "n")
        .groupBy(category)
        .agg(
            F.max("n").alias("n"),
            F.max("q1").alias("q1"),
            F.max("median").alias("median"),
            F.max("q3").alias("q3"),
            F.min(F.when(within, F.col("_x"))).alias("whisker_low"),
            F.max(F.when(within, F.col("_x"))).alias("whisker_high"),
        )
        .orderBy("median", category)
    )


def ols_trend(df: DataFrame, x: str, y: str = "ATD") -> DataFrame:
    """Least-squares line of ``y`` on ``x`` over rows that have both."""
    both = df.where(~any_null(F.col(x), F.col(y)))
    return both.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.count("*").alias("n"),
    )


def pair_trends(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Least-squares line of each later column ``a`` on each earlier one ``b``, all in one pass.

    Pairs use the rows that have both values; a constant ``b`` gives NULLs.
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[:i]]
    figures = {"slope": F.regr_slope, "intercept": F.regr_intercept, "r2": F.regr_r2, "n": F.regr_count}
    row = df.agg(*[f(a, b).alias(f"{name}{i}") for i, (a, b) in enumerate(pairs) for name, f in figures.items()])
    lines = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), *[F.col(f"{name}{i}").alias(name) for name in figures])
        for i, (a, b) in enumerate(pairs)
    ]
    return row.select(F.inline(F.array(*lines)))


def mean_by_quantile_bin(df: DataFrame, value: str, target: str, bins: int) -> DataFrame:
    """Mean target per quantile bin of a value."""
    return (
        quantile_bin(df.select(value, target), value, bins)
        .where(F.col("bin").isNotNull())
        .groupBy("bin")
        .agg(F.avg(target).alias("mean"), F.count("*").alias("n"))
        .orderBy("bin")
    )
