"""Table sources and sinks: Parquet is the table format, CSV and JDBC are boundaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType, TimestampType

from tripmeter import schemas
from tripmeter.functions.clock import hour_of_day, weekday_label, weekday_number
from tripmeter.sources import versions

# Table names and the timestamp format of CSV files (microseconds kept).
CSV_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
WEEKLY_TABLE = "{country}_delivery_trips_info"
HISTORY_TABLE = "{country}_delivery_trips_historic_info"


def table_path(base: str, schema: str, name: str) -> str:
    return f"{base.rstrip('/')}/{schema}/{name}"


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A table, versioned (:mod:`tripmeter.sources.versions`) or a plain folder."""
    if versions.version(spark, path):
        return versions.read(spark, path, schema)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a readable table (a version, or at least one file) at the path."""
    if versions.version(spark, path):
        return True
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True


def read_country(spark: SparkSession, base: str, country: str, schema: str) -> DataFrame:
    """The whole weekly table of one country."""
    return read_table(spark, table_path(base, schema, WEEKLY_TABLE.format(country=country)))


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    split_column: str,
    lower: str,
    upper: str,
    partitions: int,
    **options: str,
) -> DataFrame:
    """A database table in parallel ranges of one column (needs a driver on the class path)."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=split_column)
        .options(lowerBound=lower, upperBound=upper, numPartitions=str(partitions), **options)
        .load()
    )


def _csv_text(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with header and declared types, but timestamps as text."""
    loose = StructType([
        StructField(f.name, StringType()) if isinstance(f.dataType, (TimestampNTZType, TimestampType)) else f
        for f in schema
    ])
    reader = spark.read.schema(loose).option("header", True).option("mode", "PERMISSIVE")
    return reader.option("nullValue", "").option("escape", '"').csv(path)


def _timestamps(schema: StructType) -> list[StructField]:
    return [f for f in schema if isinstance(f.dataType, (TimestampNTZType, TimestampType))]


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with header and declared types; empty fields are missing, ``\\N`` stays text.

    Timestamps may be written with ``T`` or a space between date and time, with or without
    fractions.  Unreadable ones are missing; :func:`unreadable` counts them.
    """
    parsed = {f.name: F.col(f.name).try_cast(f.dataType) for f in _timestamps(schema)}
    return _csv_text(spark, path, schema).withColumns(parsed).select(*schema.fieldNames())


def unreadable(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """``column, n``: fields of a CSV that are not empty and yet no timestamp."""
    fields = _timestamps(schema)
    bad = [
        F.struct(F.lit(f.name).alias("column"), F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias("n"))
        for f in fields
    ]
    return _csv_text(spark, path, schema).agg(F.array(*bad).alias("r")).select(F.inline("r"))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    writer = df.write.mode(mode).option("header", True).option("escape", '"')
    writer = writer.option("timestampNTZFormat", CSV_TIMESTAMP)
    writer.option("nullValue", "").option("emptyValue", '""').csv(path)


def enrich(trips: DataFrame) -> DataFrame:
    """Add hour, weekday, weekday label and total distance."""
    request = F.col("eater_request_timestamp_local")
    return trips.withColumns({
        "hour": hour_of_day(request),
        "day_of_week": weekday_number(request),
        "day_label": weekday_label(weekday_number(request)),
        "total_distance": F.col("pickup_distance") + F.col("dropoff_distance"),
    })


def load_trips(spark: SparkSession, path: str) -> DataFrame:
    """Clean trips from CSV with the report columns added."""
    return enrich(read_csv(spark, path, schemas.CLEAN_TRIPS))


def ensure_schema(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}'")


def replace_table(df: DataFrame, path: str) -> None:
    """Drop and create in one step: readers see the old rows or the new ones; ``df`` may read from the table."""
    versions.replace(df, path)


def create_if_absent(df: DataFrame, path: str) -> None:
    if not table_exists(df.sparkSession, path):
        versions.replace(df, path)


def append_rows(df: DataFrame, path: str) -> None:
    versions.append(df, path)


def append_union(parts: Sequence[DataFrame]) -> DataFrame:
    """Rows of all parts, columns matched by name."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
