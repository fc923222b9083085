"""Columns to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def columns_to_rows(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str
) -> DataFrame:
    """One row per row and column: the id columns, the column's name and its value.

    Written as an exploded array rather than an unpivot: filters on the id columns then
    move below it the same way wherever the frame is used, and two uses share a shuffle.
    """
    entries = F.array(*[
        F.struct(F.lit(c).alias(name), F.col(c).alias(value)) for c in columns
    ])
    rows = df.select(*ids, F.explode(entries).alias("_entry"))
    return rows.select(*ids, F.col(f"_entry.{name}"), F.col(f"_entry.{value}"))
