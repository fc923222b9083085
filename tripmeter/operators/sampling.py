"""Repeatable order, exact samples and exact stratified splits.

Rows are ordered by ``md5(seed:key)``.  The first four hex digits cut every group into
65,536 equal buckets; bucket sizes are counted, and a row's rank is the number of rows in
earlier buckets plus its place within its own bucket.  A split needs the ranks of one bucket
of each group only: all rows of earlier buckets lie before the cut, all later ones behind it.
So no task ever sorts more than one bucket of one group, however large the group is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmeter.operators.ranks import ranked
from tripmeter.session import scratch_path

SEED = 42
BUCKET_DIGITS = 4


def shuffle_key(key: Column, seed: int = SEED) -> Column:
    """A repeatable pseudo-random text that orders rows by their unique key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def _buckets(rows: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """Per group and bucket: rows in earlier buckets (``_before``) and in the group (``_all``)."""
    group = Window.partitionBy(*by)
    earlier = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.groupBy(*by, F.substring(order, 1, BUCKET_DIGITS).alias("_bucket"))
        .agg(F.count("*").alias("_c"))
        .select(
            *by,
            "_bucket",
            F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_c").over(group).alias("_all"),
        )
    )


def sample_rows(df: DataFrame, key: Column, n: int, seed: int = SEED) -> DataFrame:
    """Exactly ``n`` rows (all rows if there are fewer), the same ones on every run.

    Only the buckets that reach rank ``n`` are read on, so the final ordering sees about
    ``n`` rows plus one bucket rather than ``n`` rows from every partition.
    """
    rows = df.withColumn("_order", shuffle_key(key, seed))
    buckets = _buckets(rows.select("_order"), [], "_order")
    last = buckets.where(F.col("_before") < n).agg(F.max("_bucket").alias("last")).scalar()
    return (
        rows.where(F.substring("_order", 1, BUCKET_DIGITS) <= last)
        .orderBy("_order")
        .limit(n)
        .drop("_order")
    )


def split_quotas(sizes: DataFrame, stratum: str, size: str, test_fraction: float) -> DataFrame:
    """Test rows per stratum: the floor of its share, then one more by largest remainder.

    The quotas add up to the rounded-up share of all rows; equal remainders are taken in
    the order of the stratum names.  Strata are ranked in sorted ranges, any number of them.
    """
    share = F.col(size) * F.lit(test_fraction)
    shares = sizes.withColumn("_floor", F.floor(F.round(share, 9))).withColumn(
        "_remainder", F.round(share - F.col("_floor"), 9)
    )
    path = scratch_path(sizes.sparkSession, "strata")
    places = ranked(shares, ["_remainder", stratum], path, descending=["_remainder"], into="_place")
    spare = places.agg(
        (F.ceil(F.round(F.sum(size) * F.lit(test_fraction), 9)) - F.sum("_floor")).alias("spare")
    ).scalar()
    return places.select(stratum, (F.col("_floor") + (F.col("_place") <= spare).cast("int")).alias("_quota"))


def stratified_split(
    df: DataFrame,
    stratum: str,
    key: Column,
    test_fraction: float = 0.2,
    more_than: int = 10,
    seed: int = SEED,
    into: str = "split",
) -> DataFrame:
    """Add ``train``/``test``; strata with at most ``more_than`` rows are left out.

    Every stratum gives its exact quota to the test part.  The bucket counts are stored in the shared
    folder, and beside them the edge of each stratum: the bucket in which its quota ends, and how many
    test rows that bucket gives.  Rows meet the edges, one row per stratum, and are sorted in edge
    buckets only.  Rows without a key are left out.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "buckets")
    rows = df.withColumn("_order", shuffle_key(key, seed))
    counted = _buckets(rows.select(stratum, "_order"), [stratum], "_order")
    counted.where(F.col("_all") > more_than).write.parquet(f"{path}/counts")
    buckets = spark.read.schema(counted.schema).parquet(f"{path}/counts")
    sizes = buckets.groupBy(stratum).agg(F.max("_all").alias("_all"))
    quotas = split_quotas(sizes, stratum, "_all", test_fraction)
    reached = F.when(F.col("_before") < F.col("_quota"), F.struct("_before", "_bucket"))
    edges = (
        buckets.join(quotas, stratum)
        .groupBy(stratum)
        .agg(F.max("_quota").alias("_quota"), F.max(reached).alias("_last"))
        .select(stratum, F.col("_last._bucket").alias("_edge"), (F.col("_quota") - F.col("_last._before")).alias("_left"))
    )
    edges.write.parquet(f"{path}/edges")
    edges = spark.read.schema(edges.schema).parquet(f"{path}/edges")

    def parted(found: DataFrame, test: Column) -> DataFrame:
        return found.select(*df.columns, F.when(test, F.lit("test")).otherwise(F.lit("train")).alias(into))

    bucket, edge = F.col("_bucket"), F.col("_edge")
    met = rows.where(key.isNotNull()).withColumn("_bucket", F.substring("_order", 1, BUCKET_DIGITS)).join(edges, stratum)
    inside = Window.partitionBy(stratum).orderBy("_order")
    # A stratum without test rows has no edge.
    return parted(met.where(~bucket.eqNullSafe(edge)), bucket < edge).unionByName(
        parted(met.where(bucket == edge), F.row_number().over(inside) <= F.col("_left"))
    )
