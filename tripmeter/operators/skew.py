"""Joining per-group facts back on to rows when one group may hold most rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A group is hot when it holds at least 1/HOT_GROUPS of all rows counted in the facts,
# so there can never be more than HOT_GROUPS hot groups: the broadcast side is bounded.
HOT_GROUPS = 1000


def split_hot(facts: DataFrame, rows_column: str) -> tuple[DataFrame, DataFrame]:
    """Facts of the (at most ``HOT_GROUPS``) hot groups, and those of all other groups."""
    total = facts.agg(F.sum(rows_column).alias("total")).scalar()
    hot = F.col(rows_column) * HOT_GROUPS >= total
    return facts.where(hot), facts.where(~hot)


def _same_keys(keys: list[str], null_safe: bool) -> Column:
    def same(key: str) -> Column:
        left, right = F.col(f"rows.{key}"), F.col(f"facts.{key}")
        return left.eqNullSafe(right) if null_safe else left == right

    return reduce(lambda a, b: a & b, [same(key) for key in keys])


def join_facts(
    rows: DataFrame,
    facts: DataFrame,
    keys: list[str],
    rows_column: str,
    null_safe: bool = False,
) -> DataFrame:
    """Inner join of ``rows`` with one fact row per key.

    ``facts[rows_column]`` is the number of rows of that key.  Rows of hot keys meet a
    bounded broadcast and are never shuffled; the rest is an ordinary shuffled join in
    which no key holds more than 1/HOT_GROUPS of the rows.
    """
    hot, cold = split_hot(facts, rows_column)
    same = _same_keys(keys, null_safe)
    columns = [F.col(f"rows.{c}") for c in rows.columns] + [
        F.col(f"facts.{c}") for c in facts.columns if c not in keys
    ]
    left = rows.alias("rows")
    hot_rows = left.join(F.broadcast(hot).alias("facts"), same).select(*columns)
    cold_rows = (
        left.join(F.broadcast(hot.select(*keys)).alias("facts"), same, "left_anti")
        .alias("rows")
        .join(cold.alias("facts"), same)
        .select(*columns)
    )
    return hot_rows.unionByName(cold_rows)


def keep_frequent(df: DataFrame, keys: list[str], more_than: int) -> DataFrame:
    """Rows whose key occurs more than ``more_than`` times."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") > more_than)
    return join_facts(df, sizes, keys, "_rows", null_safe=True).drop("_rows")
