"""Feature sets before and after a courier is assigned."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmeter.functions.clock import (
    hour_angle,
    hour_of_day,
    minutes_between,
    three_hour_slot,
    weekday_number,
    weekend_flag,
)
from tripmeter.functions.values import text_key
from tripmeter.operators.sampling import SEED, stratified_split
from tripmeter.schemas import TARGET

KEY = "trip_key"

# Share of test rows and the size a stratum must exceed.
TEST_FRACTION = 0.2
MORE_THAN = 10


@dataclass(frozen=True)
class FeatureSet:
    """Feature columns by treatment; the assembled vector has them in this order."""

    name: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    binary: tuple[str, ...]
    cyclical: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return [*self.numeric, *self.categorical, *self.binary, *self.cyclical]


# The two feature sets.
PRE_ASSIGN = FeatureSet(
    name="pre_assign",
    numeric=("pickup_distance", "dropoff_distance", "total_distance"),
    categorical=("territory", "courier_flow", "geo_archetype", "merchant_surface"),
    binary=(),
    cyclical=("hour_sin", "hour_cos"),
)
POST_ASSIGN = FeatureSet(
    name="post_assign",
    numeric=("pickup_distance", "dropoff_distance", "total_distance", "dispatch_delay"),
    categorical=("territory", "courier_flow", "geo_archetype", "merchant_surface"),
    binary=("offered_equals_request",),
    cyclical=("hour_sin", "hour_cos"),
)
FEATURE_SETS = {s.name: s for s in (PRE_ASSIGN, POST_ASSIGN)}


def with_time_features(trips: DataFrame) -> DataFrame:
    """Calendar parts of the request time and the total distance."""
    request = F.col("eater_request_timestamp_local")
    sine, cosine = hour_angle(hour_of_day(request))
    return trips.withColumns({
        "hour": hour_of_day(request),
        "day_of_week": weekday_number(request),
        "is_weekend": weekend_flag(request),
        "hour_sin": sine,
        "hour_cos": cosine,
        "hour_bin": three_hour_slot(hour_of_day(request)),
        "total_distance": F.col("pickup_distance") + F.col("dropoff_distance"),
    })


def with_dispatch_delay(trips: DataFrame) -> DataFrame:
    """Minutes from the request to the offer."""
    offered = F.col("restaurant_offered_timestamp_local")
    requested = F.col("eater_request_timestamp_local")
    return trips.withColumn("dispatch_delay", minutes_between(offered, requested))


def with_stratum(trips: DataFrame) -> DataFrame:
    """Territory, courier flow and three-hour slot as one text."""
    parts = [F.col(c) for c in ("territory", "courier_flow", "hour_bin")]
    return trips.withColumn("strata", text_key(*parts))


def with_trip_key(trips: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One text that names the row; it orders the split and never becomes a feature."""
    return trips.withColumn(KEY, F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))


def feature_frame(trips: DataFrame, features: FeatureSet) -> DataFrame:
    """Key, feature columns, target and stratum."""
    derived = with_stratum(with_time_features(trips))
    if "dispatch_delay" in features.columns:
        derived = with_dispatch_delay(derived)
    return derived.select(KEY, *features.columns, TARGET, "strata")


def split_frame(frame: DataFrame, seed: int = SEED) -> DataFrame:
    """Add ``split``: an exact, repeatable, stratified 80/20 division without rare strata."""
    return stratified_split(
        frame, "strata", F.col(KEY), TEST_FRACTION, MORE_THAN, seed, into="split"
    )


def _labels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct ``(column, value)``, missing values left out."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return long.unpivot([], list(columns), "column", "value").where("value IS NOT NULL").distinct()


def label_index(df: DataFrame, columns: Sequence[str], path: str) -> DataFrame:
    """``column, value, index``: one position per label, the first label of each column without one.

    Any number of labels: they are sorted into ranges, stored at ``path``, and numbered from the
    sizes of the ranges before them.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    labels = _labels(df, columns).repartitionByRange(ranges, "column", "value")
    labels.withColumn("part", F.spark_partition_id()).write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)
    earlier = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored.groupBy("column", "part").agg(F.count("*").alias("n"))
    starts = sizes.withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    inside = Window.partitionBy("column", "part").orderBy("value")
    placed = stored.withColumn("place", F.row_number().over(inside) - 1).join(starts, ["column", "part"])
    # One row per column from here on: where its positions begin.
    order = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("column"))
    used = sizes.groupBy("column").agg((F.sum("n") - 1).alias("used"))
    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = used.withColumn("offset", F.coalesce(F.sum("used").over(before), F.lit(0))).drop("used")
    position = F.col("start") + F.col("place")
    index = F.when(position > 0, F.col("offset") + position - 1)
    return placed.join(F.broadcast(offsets), "column").select("column", "value", index.alias("index"))


def sparse_dummies(df: DataFrame, columns: Sequence[str], path: str) -> DataFrame:
    """Replace category columns by ``indices``: the sorted positions of their labels (all values are 1).

    The sparse form of one 0/1 column per label except each column's first; see :func:`label_index`.
    """
    index = label_index(df, columns, path)
    out = df
    for c in columns:
        own = index.where(F.col("column") == c).select(F.col("value").alias(f"_{c}"), F.col("index").alias(f"_i_{c}"))
        out = out.join(own, F.col(c).cast("string") == F.col(f"_{c}"), "left").drop(f"_{c}")
    found = F.array_sort(F.array_compact(F.array(*[F.col(f"_i_{c}") for c in columns])))
    return out.select(*[c for c in df.columns if c not in columns], found.alias("indices"))


def label_lists(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """All labels of each column, on the driver: only for columns known to have few."""
    found: dict[str, list[str]] = {c: [] for c in columns}
    for row in _labels(df, columns).collect():
        found[row["column"]].append(row["value"])
    return {c: sorted(v) for c, v in found.items()}


def drop_first_dummies(
    df: DataFrame, columns: Sequence[str], labels: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Replace category columns by one 0/1 column per label except the first of each column.

    Labels become column names, so the caller names them; :func:`sparse_dummies` needs no list.
    """
    dummies = [
        F.coalesce(F.col(c) == label, F.lit(False)).cast("int").alias(f"{c}_{label}")
        for c in columns
        for label in sorted(labels[c])[1:]
    ]
    return df.select(*[c for c in df.columns if c not in columns], *dummies)
