"""Delivery tables derived from the given tables; ``oracles`` holds the same rules in SQL.

Relational side: orders are trips, one line per order is the dispatch job, suppliers are
cities, nations territories and regions countries.  Temporal side: events are trips with
real clock times.  Gaps, markers, negative values and exact copies are put in by rules on
the row's id, over whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DS = "1996-03-11"
COUNTRY = "EUROPE"
UTC_OFFSET = 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def minutes(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), n.cast("int"))


def first_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The smallest line of every order (combined before the shuffle)."""
    order = [
        "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"
    ]
    line = table(spark, sf_dir, "lineitem")
    return line.groupBy("l_orderkey").agg(F.min(F.struct(*order)).alias("line")).select(
        "l_orderkey", "line.*"
    )


def job_columns(lines: DataFrame) -> DataFrame:
    """Order lines under the names of dispatch jobs."""
    metres = (F.col("l_quantity") * 100).cast("decimal(10,1)")
    pickup = F.when(F.col("l_partkey") % 17 != 0, metres)
    travel = F.col("l_extendedprice").cast("decimal(10,1)")
    return lines.select(
        F.col("l_orderkey").alias("job_uuid"),
        F.col("l_suppkey").alias("city_id"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("date_str"),
        pickup.alias("pickup_distance"),
        (pickup / 1000).cast("decimal(10,3)").alias("pickup_distance_km"),
        travel.alias("travel_distance"),
        (travel / 1000).cast("decimal(10,3)").alias("travel_distance_km"),
    )


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One job per order, so that the job's key is unique."""
    return job_columns(first_lines(spark, sf_dir))


def all_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line as a job, for counts over whole tables."""
    return job_columns(table(spark, sf_dir, "lineitem"))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    placed = F.col("o_orderdate").cast("timestamp_ntz")
    flow = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(r"\N"))
    finals = first_lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("order_final_state_timestamp_local"),
    )
    return table(spark, sf_dir, "orders").join(finals, "o_orderkey", "left").select(
        key.alias("delivery_trip_uuid"),
        key.alias("workflow_uuid"),
        F.col("o_custkey").alias("driver_uuid"),
        flow.otherwise(F.col("o_orderpriority")).alias("courier_flow"),
        F.when(key % 29 != 0, placed).cast("timestamp").alias("restaurant_offered_timestamp_utc"),
        "order_final_state_timestamp_local",
        F.when(key % 3 == 0, placed)
        .otherwise(placed - minutes(key % 90))
        .alias("eater_request_timestamp_local"),
        F.col("o_orderstatus").alias("geo_archetype"),
        F.concat(F.lit("M"), (key % 4).cast("string")).alias("merchant_surface"),
    )


def city(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").alias("city_id"), F.col("r_name").alias("country_name"))
    )


def city_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    supplier = table(spark, sf_dir, "supplier").where("s_suppkey % 11 != 0")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("city_id"), F.col("n_name").alias("territory")
    )


def event_trips(spark: SparkSession, sf_dir: str, copies: bool = True) -> DataFrame:
    """Trips from events; rows with ``event_id % 71 = 0`` occur twice unless turned off."""
    key = F.col("event_id")
    value = F.col("value")
    ts = F.col("ts").cast("timestamp_ntz")
    pickup = F.when(key % 23 != 0, (key % 97) / F.lit(10.0))
    micros = F.round(value * 60_000_000).cast("bigint")
    events = table(spark, sf_dir, "events")
    if copies:
        again = F.array_repeat(F.lit(0), F.when(key % 71 == 0, 2).otherwise(1))
        events = events.select("*", F.explode(again).alias("copy"))
    offered = ts + F.make_dt_interval(F.lit(0), F.lit(6)) + minutes(key % 7 - 2)
    return events.select(
        key.cast("string").alias("delivery_trip_uuid"),
        F.when(F.col("user_id") % 37 != 0, F.concat(F.lit("T"), (F.col("user_id") % 5).cast("string")))
        .alias("territory"),
        F.when(F.col("event_type") == "error", F.lit(r"\N"))
        .otherwise(F.col("event_type"))
        .alias("courier_flow"),
        F.when(key % 41 != 0, offered).cast("timestamp").alias("restaurant_offered_timestamp_utc"),
        F.timestamp_micros(F.unix_micros(ts.cast("timestamp")) + micros)
        .cast("timestamp_ntz")
        .alias("order_final_state_timestamp_local"),
        ts.alias("eater_request_timestamp_local"),
        F.concat(F.lit("G"), (F.col("user_id") % 3).cast("string")).alias("geo_archetype"),
        F.concat(F.lit("M"), (key % 4).cast("string")).alias("merchant_surface"),
        pickup.alias("pickup_distance_km"),
        F.round(pickup + value / 20, 4).alias("dropoff_distance_km"),
        F.when(key % 53 == 0, -value).when(key % 101 == 0, 0.0).otherwise(value).alias("atd"),
    )


def event_history(spark: SparkSession, sf_dir: str, copies: bool = True) -> DataFrame:
    """Event trips in Monday batches of eight days: a Monday belongs to two batches."""
    day = F.to_date("eater_request_timestamp_local")
    coming = F.date_add(day, (7 - F.weekday(day)) % 7)
    batches = F.when(coming == day, F.array(day, F.date_add(day, 7))).otherwise(F.array(coming))
    return event_trips(spark, sf_dir, copies).select(F.explode(batches).alias("batch_date"), "*")
