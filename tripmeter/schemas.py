"""Declared schemas and the column lists the jobs share."""

from __future__ import annotations

from pyspark.sql import types as T

# Columns, types and nullability of the declared tables, in declared order.
TRIPS = T.StructType([
    T.StructField("delivery_trip_uuid", T.StringType(), False),
    T.StructField("workflow_uuid", T.StringType(), False),
    T.StructField("driver_uuid", T.StringType(), False),
    T.StructField("courier_flow", T.StringType()),
    T.StructField("restaurant_offered_timestamp_utc", T.TimestampType()),
    T.StructField("order_final_state_timestamp_local", T.TimestampNTZType()),
    T.StructField("eater_request_timestamp_local", T.TimestampNTZType()),
    T.StructField("geo_archetype", T.StringType()),
    T.StructField("merchant_surface", T.StringType()),
    T.StructField("total_distance_travelled", T.DecimalType(10, 3)),
])

DISPATCH_JOBS = T.StructType([
    T.StructField("job_uuid", T.StringType(), False),
    T.StructField("city_id", T.IntegerType(), False),
    T.StructField("date_str", T.TimestampNTZType(), False),
    T.StructField("pickup_distance_km", T.DecimalType(10, 3), False),
    T.StructField("pickup_distance", T.DecimalType(10, 1), False),
    T.StructField("travel_distance_km", T.DecimalType(10, 3), False),
    T.StructField("travel_distance", T.DecimalType(10, 1), False),
    T.StructField("is_final_plan", T.BooleanType(), False),
    T.StructField("estimated_delivery_time", T.DayTimeIntervalType()),
    T.StructField("delivery_status", T.StringType(), False),
])

CITY = T.StructType([
    T.StructField("city_id", T.IntegerType(), False),
    T.StructField("city_name", T.StringType(), False),
    T.StructField("country_name", T.StringType(), False),
    T.StructField("mega_region", T.StringType(), False),
    T.StructField("currency_code", T.StringType(), False),
    T.StructField("population_size", T.LongType()),
    T.StructField("average_income", T.DecimalType(12, 2)),
])

CITY_REGION = T.StructType([
    T.StructField("city_id", T.IntegerType(), False),
    T.StructField("region", T.StringType(), False),
    T.StructField("territory", T.StringType(), False),
    T.StructField("population_size", T.LongType()),
    T.StructField("market_demand", T.DecimalType(15, 2)),
])

# Columns of the history and of the clean table.
TRIP_HISTORY = T.StructType([
    T.StructField("batch_date", T.DateType(), False),
    T.StructField("week_start", T.DateType(), False),
    T.StructField("week_end", T.DateType(), False),
    T.StructField("territory", T.StringType()),
    T.StructField("country_name", T.StringType()),
    T.StructField("workflow_uuid", T.StringType()),
    T.StructField("driver_uuid", T.StringType()),
    T.StructField("delivery_trip_uuid", T.StringType(), False),
    T.StructField("courier_flow", T.StringType()),
    T.StructField("restaurant_offered_timestamp_utc", T.TimestampType()),
    T.StructField("order_final_state_timestamp_local", T.TimestampNTZType()),
    T.StructField("eater_request_timestamp_local", T.TimestampNTZType()),
    T.StructField("geo_archetype", T.StringType()),
    T.StructField("merchant_surface", T.StringType()),
    T.StructField("pickup_distance_km", T.DecimalType(10, 3)),
    T.StructField("dropoff_distance_km", T.DecimalType(10, 3)),
    T.StructField("atd", T.DecimalType(10, 2)),
    T.StructField("inserted_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

CLEAN_TRIPS = T.StructType([
    T.StructField("territory", T.StringType()),
    T.StructField("courier_flow", T.StringType()),
    T.StructField("order_final_state_timestamp_local", T.TimestampNTZType()),
    T.StructField("eater_request_timestamp_local", T.TimestampNTZType()),
    T.StructField("geo_archetype", T.StringType()),
    T.StructField("merchant_surface", T.StringType()),
    T.StructField("pickup_distance", T.DoubleType()),
    T.StructField("dropoff_distance", T.DoubleType()),
    T.StructField("ATD", T.DoubleType()),
    T.StructField("restaurant_offered_timestamp_local", T.TimestampNTZType()),
    T.StructField("missing_distance", T.IntegerType()),
    T.StructField("offered_equals_request", T.IntegerType()),
])

# Identifiers and batch columns that do not enter the analysis.
IDENTIFIERS = [
    "region", "country_name", "workflow_uuid", "driver_uuid", "delivery_trip_uuid",
    "batch_date", "week_start", "week_end", "inserted_at", "updated_at",
]

# The category columns of a trip.
CATEGORIES = ["territory", "courier_flow", "geo_archetype", "merchant_surface"]
DISTANCES = ["pickup_distance", "dropoff_distance"]
TARGET = "ATD"
