"""Correlations of many columns: the plan does not grow with the number of pairs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUMS = ("n", "sum_a", "sum_b", "squares_a", "squares_b", "product")
PAIR_SUMS = "a int, b int, " + ", ".join(f"{c} double" for c in SUMS)

# A spread below this share of the column's mean is what rounding leaves of a constant.
CONSTANT = 1e-13


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of one task for every pair of columns, over the rows that have both values."""
    present = values = squares = products = None
    for batch in (b for b in batches if b.num_rows):
        x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        there = (~np.isnan(x)).astype(float)
        x = np.nan_to_num(x)
        sums = there.T @ there, x.T @ there, (x * x).T @ there, x.T @ x
        if present is None:
            present, values, squares, products = sums
        else:
            present += sums[0]
            values += sums[1]
            squares += sums[2]
            products += sums[3]
    if present is not None:
        a, b = np.tril_indices(len(present), -1)
        sums = present[a, b], values[a, b], values[b, a], squares[a, b], squares[b, a], products[a, b]
        columns = [pa.array(a, pa.int32()), pa.array(b, pa.int32()), *map(pa.array, sums)]
        yield pa.RecordBatch.from_arrays(columns, names=["a", "b", *SUMS])


def correlations_wide(df: DataFrame, columns: Sequence[str], absolute: bool = False) -> DataFrame:
    """``a, b, corr``: Pearson correlation of each pair (later column, earlier column), for many columns.

    Each task multiplies its rows as matrices and returns one row per pair; these are added up by pair, so
    a task holds four squares of the number of columns and nothing that grows with the rows.  Pairs use the
    rows that have both values; NULL, NaN and infinity count as missing.  A constant column, a pair without
    two rows and an empty table give NULL or no row.  Values are centred first, so large offsets cost nothing.
    """
    numbers = [F.col(f"`{c}`").cast("double") for c in columns]
    finite = [F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x) for x in numbers]
    rows = df.select(F.array(*finite).alias("x"))
    # One array of as many numbers as there are columns.
    means = rows.agg(F.array(*[F.avg(F.col("x")[i]) for i in range(len(columns))]).alias("m")).scalar()
    centred = rows.withColumn("m", means).select(F.zip_with("x", "m", lambda x, m: x - m).alias("x"))
    parts = centred.mapInArrow(_pair_sums, PAIR_SUMS)
    total = parts.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in SUMS])

    def spread(side: str):
        left = F.col(f"squares_{side}") - F.col(f"sum_{side}") * F.col(f"sum_{side}") / F.col("n")
        noise = F.abs(means[F.col(side)]) * CONSTANT
        return F.when(left > F.col("n") * noise * noise, left)

    shared = F.col("product") - F.col("sum_a") * F.col("sum_b") / F.col("n")
    corr = F.when(F.col("n") > 1, shared / F.sqrt(spread("a") * spread("b")))
    names = F.array(*[F.lit(c) for c in columns])
    result = F.abs(corr).alias("abs_corr") if absolute else corr.alias("corr")
    return total.select(names[F.col("a")].alias("a"), names[F.col("b")].alias("b"), result)
