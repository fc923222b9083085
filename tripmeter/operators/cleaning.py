"""Row-level cleaning steps: duplicates, imputation, filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmeter.functions.values import any_null
from tripmeter.operators.quantiles import exact_quantiles
from tripmeter.operators.reshape import columns_to_rows
from tripmeter.operators.skew import join_facts, split_hot


# Copies of one row that a task writes at once.
REPEAT_BLOCK = 10_000


def drop_exact_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """One row of each set of equal rows; missing values equal each other."""
    return df.dropDuplicates(list(subset) if subset else None)


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order``, then by all other columns, so reruns agree.

    Minima are combined before the shuffle; missing values come first.
    """
    rest = [*order, *[c for c in df.columns if c not in {*keys, *order}]]
    first = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_first"))
    return first.select(*keys, "_first.*").select(*df.columns)


def duplicate_sets(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Each repeated key (default: all columns) with its number of ``copies``."""
    keys = list(subset or df.columns)
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def duplicate_members(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Every row that belongs to a duplicate set, first occurrences included, with ``copies``.

    Equal rows need no join: each set is counted and given back as often as it occurs, in blocks, so
    that a huge set is not written by one task.
    """
    if subset is None:
        blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / REPEAT_BLOCK))
        dealt = duplicate_sets(df).withColumn("_block", F.explode(blocks))
        size = F.least(F.lit(REPEAT_BLOCK), F.col("copies") - F.col("_block") * REPEAT_BLOCK)
        spread = dealt.repartition("_block", *df.columns)
        return spread.withColumn("_again", F.explode(F.array_repeat(F.lit(0), size.cast("int")))).drop(
            "_block", "_again"
        )
    keys = list(subset)
    return join_facts(df, duplicate_sets(df, keys), keys, "copies", null_safe=True)


def group_medians(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """One row per group with the median of each column (NULL if it has no value)."""
    values = df.select(by, *[F.col(c).cast("double").alias(c) for c in columns])
    values = values.where(F.col(by).isNotNull())
    long = columns_to_rows(values, [by], columns, "_column", "_value")
    medians = exact_quantiles(long, "_value", [0.5], [by, "_column"])
    return medians.groupBy(by).agg(
        *[F.max(F.when(F.col("_column") == c, F.col("q")[0])).alias(c) for c in columns]
    )


def impute_group_median(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """Fill missing values with the median of their group.

    A row without a group loses its value, a group without values stays empty: both
    follow from filling group by group.  Medians of hot groups (a bounded number) are
    broadcast to the whole stream; only rows that lack a value *and* belong to a small
    group are shuffled.
    """
    columns = list(columns)
    lacking = F.col(by).isNotNull() & any_null(*[F.col(c) for c in columns])
    sizes = df.where(lacking).groupBy(by).agg(F.count("*").alias("_lacking"))
    medians = group_medians(df, by, columns)
    facts = sizes.join(medians, by, "left").select(
        F.col(by).alias("_group"), "_lacking", *[F.col(c).alias(f"_median_{c}") for c in columns]
    )
    hot, cold = split_hot(facts, "_lacking")

    def fill(joined: DataFrame) -> DataFrame:
        filled = {
            c: F.when(F.col(by).isNotNull(), F.coalesce(F.col(c).cast("double"), f"_median_{c}"))
            for c in columns
        }
        return joined.withColumns(filled).select(*df.columns)

    same = lacking & (F.col(by) == F.col("_group"))
    stream = df.join(F.broadcast(hot), same, "left")
    stream = stream.where(F.col("_group").isNotNull() | ~lacking)
    rest = df.where(lacking).join(F.broadcast(hot), F.col(by) == F.col("_group"), "left_anti")
    rest = rest.join(cold, F.col(by) == F.col("_group"))
    return fill(stream).unionByName(fill(rest))


def slice_rows(
    df: DataFrame, choices: dict[str, Sequence[str]], hours: tuple[int, int] = (0, 23)
) -> DataFrame:
    """Rows whose categories are all among the chosen ones and whose hour is in range.

    An empty choice selects nothing, and rows without a category are never selected.
    """
    if not all(choices.values()):
        return df.where(F.lit(False))
    for column, chosen in choices.items():
        df = df.where(F.col(column).isin(list(chosen)))
    return df.where(F.col("hour").between(*hours))


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that have every one of the columns."""
    return df.na.drop(subset=list(columns))
