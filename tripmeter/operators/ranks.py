"""Positions in one order over a whole table, found without a task that sees all of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ranked(df: DataFrame, order: Sequence[str], path: str, descending: Sequence[str] = (), into: str = "rank") -> DataFrame:
    """Add the 1-based place of each row in the order of some columns, the ones in ``descending`` downwards.

    Rows are cut into sorted ranges and stored at ``path`` (which must be free) with the number of their
    range; a place is the number of rows in earlier ranges plus the place inside the row's own.  The only
    window without a key runs over one row a range.  Missing values come first (last in a downward column).
    Rows equal in all of ``order`` share a range, so the order should name its rows.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [f"k{i}" for i in range(len(order))]
    sorting = [F.desc(k) if c in descending else F.asc(k) for k, c in zip(keys, order)]
    # The caller's columns travel in one struct, so their names cannot meet the ones used here.
    rows = df.select(F.struct("*").alias("row"), *[F.col(f"`{c}`").alias(k) for k, c in zip(keys, order)])
    cut = rows.repartitionByRange(ranges, *sorting).withColumn("part", F.spark_partition_id())
    cut.write.parquet(path)
    stored = spark.read.schema(cut.schema).parquet(path)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start")
    )
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*sorting))
    # One row a range: bounded by the number of ranges.
    placed = stored.withColumn("place", inside).join(F.broadcast(starts), "part")
    return placed.select("row.*", (F.col("start") + F.col("place")).alias(into))
