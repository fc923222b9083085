"""Trip history: one partition per batch, merged by trip."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmeter import schemas
from tripmeter.functions.clock import days_before
from tripmeter.operators.quality import require_unique
from tripmeter.plans.weekly import WINDOW_DAYS
from tripmeter.sources import versions
from tripmeter.sources.tables import read_table

KEY = "delivery_trip_uuid"

# Columns that a later run of the same batch refreshes.
REFRESHED = [
    "territory",
    "courier_flow",
    "order_final_state_timestamp_local",
    "geo_archetype",
    "merchant_surface",
    "pickup_distance_km",
    "dropoff_distance_km",
    "atd",
]


def batch_rows(snapshot: DataFrame, ds: str, now: Column | None = None) -> DataFrame:
    """Snapshot rows in the shape of the history table."""
    now = F.current_timestamp() if now is None else now
    day = F.lit(ds).cast("date")
    shaped = snapshot.withColumnRenamed("dropoff_distance", "dropoff_distance_km").withColumns({
        "batch_date": day,
        "week_start": days_before(day, WINDOW_DAYS),
        "week_end": day,
        "inserted_at": now,
        "updated_at": now,
    })
    return shaped.select(*[
        F.col(field.name).cast(field.dataType).alias(field.name)
        for field in schemas.TRIP_HISTORY
    ])


def merge_batch(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Stored and incoming rows of one batch, by trip.

    New trips are added.  Known trips take the refreshed columns (also a new NULL) and
    the update time from the incoming row and keep all other stored values.  Stored
    trips that do not come again stay.
    """
    old = stored.withColumn("_stored", F.lit(True)).alias("old")
    new = incoming.withColumn("_incoming", F.lit(True)).alias("new")
    both = old.join(new, F.col(f"old.{KEY}") == F.col(f"new.{KEY}"), "full_outer")
    refreshed = {*REFRESHED, "updated_at"}

    def pick(name: str) -> Column:
        prefer_new = F.col("_incoming").isNotNull()
        if name not in refreshed:
            prefer_new = F.col("_stored").isNull()
        return F.when(prefer_new, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name)

    return both.select(*[pick(field.name) for field in schemas.TRIP_HISTORY])


def write_partitions(df: DataFrame, path: str, column: str = "batch_date", base: int | None = None) -> None:
    """Replace exactly the partitions that occur in ``df``, in one step; ``df`` may read from the same table."""
    versions.replace_partitions(df, path, column, base)


def upsert_history(
    spark: SparkSession,
    path: str,
    snapshot: DataFrame,
    ds: str,
    now: dt.datetime | None = None,
) -> DataFrame:
    """Merge a snapshot into its batch of the history table and return the table.

    Only the batch's own partition is read and rewritten, and it changes in one step: a run that
    dies leaves the table as it was, and a run that another one overtook is refused.  A trip
    that occurs twice in the snapshot is an error.  Running the same batch again changes nothing but the
    update time.
    """
    base = versions.version(spark, path)
    stamp = None if now is None else F.lit(now).cast("timestamp")
    incoming = batch_rows(snapshot, ds, stamp)
    require_unique(incoming, [KEY])
    if base:
        batch = F.lit(ds).cast("date")
        stored = versions.read(spark, path, schemas.TRIP_HISTORY, base).where(F.col("batch_date") == batch)
        incoming = merge_batch(stored, incoming)
    write_partitions(incoming, path, base=base)
    return read_table(spark, path, schemas.TRIP_HISTORY)


def history_as_of(history: DataFrame, ds: str) -> DataFrame:
    """Batches up to a day; with ``batch_date`` as partition column only those are read."""
    return history.where(F.col("batch_date") <= F.lit(ds).cast("date"))
