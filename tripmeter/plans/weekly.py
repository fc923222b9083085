"""Weekly snapshot: trips joined with their dispatch job, city and region."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmeter.functions.clock import days_before, elapsed_minutes
from tripmeter.functions.values import metres_to_km

# Trip columns copied into the snapshot, length of the window in days.
TRIP_COLUMNS = [
    "workflow_uuid",
    "driver_uuid",
    "delivery_trip_uuid",
    "courier_flow",
    "restaurant_offered_timestamp_utc",
    "order_final_state_timestamp_local",
    "eater_request_timestamp_local",
    "geo_archetype",
    "merchant_surface",
]
WINDOW_DAYS = 7


def weekly_snapshot(
    trips: DataFrame,
    jobs: DataFrame,
    city: DataFrame,
    region: DataFrame,
    ds: str,
    countries: str | Sequence[str] | None = None,
    local_offset_hours: int = 0,
) -> DataFrame:
    """Trips whose job falls on ``ds`` or one of the seven days before it.

    Both ends count, so consecutive weeks share a day.  The country and date filters
    drop trips without a job or city; a city without region keeps a NULL territory.
    ``countries`` may name one, several or (None) all countries: one job serves them all.
    The date range is a plain comparison on the job timestamp, so it reaches the scan.
    Dimension joins carry no hint: Spark broadcasts them while they are small enough.
    """
    day = F.lit(ds).cast("date")
    start = days_before(day, WINDOW_DAYS).cast("timestamp_ntz")
    end = F.date_add(day, 1).cast("timestamp_ntz")
    recent = jobs.where((F.col("date_str") >= start) & (F.col("date_str") < end))

    places = city.select("city_id", "country_name")
    if countries is not None:
        names = [countries] if isinstance(countries, str) else list(countries)
        places = places.where(F.col("country_name").isin(names))
    # City and region meet first, so the jobs are joined with one dimension only.
    places = places.join(region.select("city_id", "territory"), "city_id", "left")

    located = recent.select(
        "job_uuid",
        "city_id",
        "pickup_distance",
        F.col("pickup_distance_km").alias("stored_pickup_km"),
        "travel_distance",
    ).join(places, "city_id")
    joined = trips.join(located, F.col("delivery_trip_uuid") == F.col("job_uuid"))

    # The drop-off distance adds the job's stored three-decimal kilometres.
    dropoff = F.col("stored_pickup_km") + metres_to_km(F.col("travel_distance"))
    duration = elapsed_minutes(
        F.col("order_final_state_timestamp_local"),
        F.col("restaurant_offered_timestamp_utc"),
        local_offset_hours,
    )
    return joined.select(
        "territory",
        "country_name",
        *TRIP_COLUMNS,
        metres_to_km(F.col("pickup_distance")).alias("pickup_distance_km"),
        dropoff.alias("dropoff_distance"),
        duration.alias("atd"),
    )
