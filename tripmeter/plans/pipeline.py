"""The two weekly jobs end to end: snapshot to history, history to models."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tripmeter import schemas
from tripmeter.models.artifacts import artifact_dir, publish
from tripmeter.models.features import FEATURE_SETS, with_trip_key
from tripmeter.models.training import Hyperparameters, Trained, train_variant
from tripmeter.plans.clean import stage_trips, valid_trips
from tripmeter.plans.history import history_as_of, upsert_history
from tripmeter.plans.weekly import weekly_snapshot
from tripmeter.session import prepare, scratch_path
from tripmeter.sources.tables import (
    HISTORY_TABLE,
    WEEKLY_TABLE,
    read_table,
    replace_table,
    table_path,
)

# Columns that name a history row; they order the split.
ROW_KEYS = ("delivery_trip_uuid", "batch_date")


def run_weekly(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    base: str,
    schema: str,
    country: str,
    country_name: str,
    ds: str,
    now: dt.datetime | None = None,
) -> DataFrame:
    """Replace the weekly table of a country and merge it into the country's history."""
    prepare(spark)
    weekly = table_path(base, schema, WEEKLY_TABLE.format(country=country))
    snapshot = weekly_snapshot(
        tables["trips"], tables["jobs"], tables["city"], tables["region"], ds, country_name
    )
    replace_table(snapshot, weekly)
    history = table_path(base, schema, HISTORY_TABLE.format(country=country))
    return upsert_history(spark, history, read_table(spark, weekly), ds, now)


def run_training(
    spark: SparkSession,
    base: str,
    schema: str,
    country: str,
    ds: str,
    utc_offset: int,
    model_base: str,
    settings: Hyperparameters = Hyperparameters(),
) -> dict[str, Trained]:
    """Train and publish both feature sets of a country from one stored table of trips."""
    prepare(spark)
    path = table_path(base, schema, HISTORY_TABLE.format(country=country))
    history = read_table(spark, path, schemas.TRIP_HISTORY)
    _, flagged = stage_trips(
        spark, history_as_of(history, ds), utc_offset, scratch_path(spark, "trips"), keep=ROW_KEYS
    )
    trips = with_trip_key(valid_trips(flagged), ROW_KEYS)
    folder = artifact_dir(model_base, country, ds)
    results = {}
    for variant in FEATURE_SETS:
        trained = train_variant(spark, trips, variant, scratch_path(spark, variant), settings)
        publish(trained, folder)
        results[variant] = trained
    return results
