"""From trips to the zone x hour model table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions import calendar as cal
from tidewheel.functions import geo
from tidewheel.operators import clean, grid, joins, splits
from tidewheel.plans import views as v

N_ZONES = 10
WEATHER = ["temperature_c", "precipitation_mm", "wind_kmh", "humidity_pct", "snow_depth_cm"]


def zoned_departures(spark: SparkSession, sf: str) -> DataFrame:
    """Departures with the zone of their start station."""
    trips = clean.departures(v.trips_ev(spark, sf))
    return trips.withColumn("zone", (F.col("start_station_id").cast("int") % N_ZONES).cast("int"))


def zone_counts(spark: SparkSession, sf: str) -> DataFrame:
    return grid.station_hour_counts(zoned_departures(spark, sf), "zone")


def zone_hour(spark: SparkSession, sf: str) -> DataFrame:
    return grid.dense_hours(zone_counts(spark, sf), spark, N_ZONES)


def model_table(spark: SparkSession, sf: str, exclude_days: Sequence[str] = ()) -> DataFrame:
    """Dense counts with supply, weather and split label. Hours before a zone had any active station and
    excluded days are dropped: no supply says nothing about demand."""
    trips = zoned_departures(spark, sf)
    active = grid.active_locations(trips, "zone", geo.location_key(F.col("start_lat"), F.col("start_lng")))
    table = grid.join_active(zone_hour(spark, sf), active).where("active_stations > 0")
    if exclude_days:
        days = spark.createDataFrame([(d,) for d in exclude_days], "day string").select(F.col("day").cast("timestamp_ntz").alias("_day"))
        table = table.join(days, cal.day_floor(F.col("time")) == F.col("_day"), "left_anti")
    table = joins.join_hourly(table, v.weather(spark, sf), "time", "time", WEATHER)
    return table.withColumn("split", splits.last_week_label(F.col("time")))


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Two models' predictions on the dense table."""
    return zone_hour(spark, sf).selectExpr(
        "zone", "time", "trips", "trips * 0.9D + 0.5D as pred_a", "cast(trips + (zone % 3) - 1 as double) as pred_b"
    )
