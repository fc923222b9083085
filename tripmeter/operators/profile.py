"""Column profiles: numbers, categories, missing values, correlations, types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmeter.functions.values import MISSING_MARKER
from tripmeter.operators.quantiles import exact_quantiles
from tripmeter.operators.reshape import columns_to_rows

# Quantiles of a numeric profile.
QUARTILES = [0.25, 0.5, 0.75]


def numeric_columns(
    df: DataFrame, types: Sequence[str] = ("double", "float", "bigint", "int", "smallint", "tinyint")
) -> list[str]:
    """Columns that hold numbers, 0/1 flags included."""
    return [name for name, kind in df.dtypes if kind in types]


def profile_numeric(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """count, mean, std, min, quartiles and max of each column, optionally per group."""
    by, columns = list(by), list(columns)
    doubles = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    for key in by:
        doubles = doubles.where(F.col(key).isNotNull())
    long = columns_to_rows(doubles, by, columns, "column", "value")
    keys = [*by, "column"]
    moments = long.groupBy(*keys).agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(long, "value", QUARTILES, keys).select(
        *keys, *[F.col("q")[i].alias(f"q{int(p * 100)}") for i, p in enumerate(QUARTILES)]
    )
    return moments.join(quartiles, keys, "left").select(
        *keys, "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def profile_categorical(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, distinct values, most frequent value (smallest on ties) and its frequency."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    counts = (
        columns_to_rows(long, [], columns, "column", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    # One row per profiled column, so the broadcast side is as small as the column list.
    peak = counts.groupBy("column").agg(
        F.sum("n").alias("count"), F.count("*").alias("unique"), F.max("n").alias("freq")
    )
    return (
        counts.join(F.broadcast(peak), "column")
        .groupBy("column", "count", "unique", "freq")
        .agg(F.min(F.when(F.col("n") == F.col("freq"), F.col("value"))).alias("top"))
        .select("column", "count", "unique", "top", "freq")
    )


def _as_rows(one_row: DataFrame, names: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Turn one row with columns ``{name}__{field}`` into one row per name."""
    entries = F.array(*[
        F.struct(F.lit(n).alias("column"), *[F.col(f"{n}__{f}").alias(f) for f in fields])
        for n in names
    ])
    return one_row.select(F.explode(entries).alias("r")).select("r.*")


def null_rates(df: DataFrame) -> DataFrame:
    """Percentage of missing values and of missing-value markers per column, in one pass."""
    text = {name for name, kind in df.dtypes if kind == "string"}
    measures = []
    for name in df.columns:
        marker = F.col(name) == MISSING_MARKER if name in text else F.lit(False)
        measures += [
            (100 * F.avg(F.col(name).isNull().cast("int"))).alias(f"{name}__null_pct"),
            (100 * F.avg(F.coalesce(marker, F.lit(False)).cast("int"))).alias(
                f"{name}__marker_pct"
            ),
        ]
    return _as_rows(df.agg(*measures), df.columns, ["null_pct", "marker_pct"])


def column_types(df: DataFrame) -> DataFrame:
    """Name, type and number of present values of every column, in one pass."""
    counts = df.agg(*[F.count(c).alias(f"{c}__present") for c in df.columns])
    kinds = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    return _as_rows(counts, df.columns, ["present"]).select(
        "column", kinds[F.col("column")].alias("type"), "present"
    )


def _pearson(a: str, b: str) -> Column:
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    # Rounding leaves a constant a small spread, so constancy is seen at its ends.
    varied = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
    return F.when(varied, F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)))


def correlations(df: DataFrame, columns: Sequence[str], absolute: bool = False) -> DataFrame:
    """Pearson correlation of each pair (later column, earlier column), in one pass.

    Pairs use the rows that have both values; a constant column gives NULL.
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[:i]]
    row = df.agg(*[_pearson(a, b).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    entries = F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"p{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)
    ])
    long = row.select(F.explode(entries).alias("r")).select("r.*")
    if not absolute:
        return long
    return long.select("a", "b", F.abs("corr").alias("abs_corr"))


def flag_rates(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    row = df.agg(*[F.avg(f).alias(f"{f}__rate") for f in flags])
    return _as_rows(row, flags, ["rate"])


def rates_by_dimension(
    df: DataFrame, flags: Sequence[str], dimensions: Sequence[str]
) -> DataFrame:
    """Mean of each 0/1 flag per value of each dimension, with a 95 % normal interval.

    Rows are first summed per combination of dimension values; the single dimensions
    are then added up from those few combinations.
    """
    cube = df.groupBy(*dimensions).agg(
        F.count("*").alias("_n"), *[F.sum(f).alias(f) for f in flags]
    )
    values = [F.col(d).cast("string") for d in dimensions]
    entries = F.array(*[
        F.struct(F.lit(d).alias("dimension"), v.alias("value"))
        for d, v in zip(dimensions, values)
    ])
    per_value = (
        cube.select(F.explode(entries).alias("e"), "_n", *flags)
        .where(F.col("e.value").isNotNull())
        .groupBy("e.dimension", "e.value")
        .agg(F.sum("_n").alias("n"), *[F.sum(f).alias(f) for f in flags])
    )
    long = per_value.unpivot(["dimension", "value", "n"], list(flags), "flag", "_hits")
    rate = F.col("_hits") / F.col("n")
    # Sample variance of a 0/1 column is p(1-p)·n/(n-1); its mean varies by that over n.
    margin = 1.96 * F.sqrt(F.try_divide(rate * (1 - rate), (F.col("n") - 1).cast("double")))
    return long.select(
        "flag", "dimension", "value", "n",
        rate.alias("rate"), (rate - margin).alias("low"), (rate + margin).alias("high"),
    )


def rates_and_counts(
    df: DataFrame, categories: Sequence[str], flags: Sequence[str]
) -> DataFrame:
    """Per category column and value, flag and flag value: rows, the value's total, rate and place.

    Values are placed within their category and flag by the mean of their rates, then by name; a
    missing value or flag counts nowhere.  Rows are first counted per combination, and all pairs of
    category and flag are added up from those in one pass.
    """
    cube = df.groupBy(*categories, *flags).agg(F.count("*").alias("_n"))
    entries = F.array(*[
        F.struct(
            F.lit(c).alias("category"), F.col(c).cast("string").alias("value"),
            F.lit(f).alias("flag"), F.col(f).cast("int").alias("flag_value"),
        )
        for c in categories for f in flags
    ])
    keys = ["category", "value", "flag", "flag_value"]
    counts = (
        cube.select(F.explode(entries).alias("e"), "_n")
        .select("e.*", "_n")
        .where("value IS NOT NULL AND flag_value IS NOT NULL")
        .groupBy(*keys)
        .agg(F.sum("_n").alias("count"))
    )
    whole = Window.partitionBy("category", "flag", "value")
    rated = counts.withColumn("total", F.sum("count").over(whole)).withColumn(
        "rate", F.col("count") / F.col("total")
    )
    # One row per category value and flag value from here on.
    place = F.dense_rank().over(Window.partitionBy("category", "flag").orderBy("_mean", "value"))
    return rated.withColumn("_mean", F.round(F.avg("rate").over(whole), 9)).select(
        *keys, "count", "total", "rate", place.alias("place")
    )
