"""Feature columns in the order the models expect."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions import calendar as cal
from tidewheel.functions import geo

# Names and order of the model inputs.
DURATION_CATEGORIES = ["rideable_type", "member_casual", "start_station_id", "end_station_id"]
WEATHER_DURATION = ["temperature_2m", "relative_humidity_2m", "precipitation", "wind_speed_10m"]
HISTORY_FEATURES = ["route_typical_minutes", "route_history_log_count", "start_typical_minutes", "end_typical_minutes"]
DURATION_FEATURES = [
    *DURATION_CATEGORIES,
    "start_lat", "start_lng", "end_lat", "end_lng", "direct_distance_km", "grid_distance_km", "delta_lat", "delta_lng",
    "bearing_sin", "bearing_cos",
    *HISTORY_FEATURES,
    "start_hour_sin", "start_hour_cos", "weekday_sin", "weekday_cos", "month_sin", "month_cos", "is_weekend", "is_holiday",
    *WEATHER_DURATION,
]
DEMAND_FEATURES_SHORT = [
    "zone", "hour", "weekday", "month", "is_weekend", "is_holiday", "temperature_c", "precipitation_mm", "wind_kmh",
]
DEMAND_FEATURES = [*DEMAND_FEATURES_SHORT, "year", "active_stations", "snow_depth_cm"]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MAX_MINUTES = 180.0
# What each weather scenario does to temperature, rain and snow depth.
SCENARIOS = {
    "actual": {},
    "dry": {"precipitation_mm": ("set", 0.0)},
    "rain": {"precipitation_mm": ("at least", 2.0)},
    "heavy": {"precipitation_mm": ("at least", 8.0)},
    "snow": {"temperature_c": ("at most", 0.0), "precipitation_mm": ("set", 0.0), "snow_depth_cm": ("at least", 15.0)},
    "storm": {"temperature_c": ("at most", -2.0), "precipitation_mm": ("at least", 1.5), "snow_depth_cm": ("at least", 25.0)},
}


def minutes_between(start: Column, end: Column) -> Column:
    """Minutes with their fraction."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(60e6)


def clip(value: Column, low, high) -> Column:
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return F.least(F.greatest(value, low), high)


def inverse_log(value: Column, top: float = MAX_MINUTES) -> Column:
    """``expm1`` inside the documented target range."""
    return F.expm1(clip(value, 0.0, math.log1p(top)))


def duration_weather(weather: DataFrame) -> DataFrame:
    """The four weather measures of the duration model under their own names."""
    return weather.select(
        "time",
        F.col("temperature_c").alias("temperature_2m"),
        F.col("humidity_pct").alias("relative_humidity_2m"),
        F.col("precipitation_mm").alias("precipitation"),
        F.col("wind_kmh").alias("wind_speed_10m"),
    )


def duration_features(trips: DataFrame) -> DataFrame:
    """All duration features plus the input columns; nothing after departure is read."""
    path = [F.col(c) for c in ("start_lat", "start_lng", "end_lat", "end_lng")]
    sine, cosine = geo.bearing_parts(*path)
    made = {
        **{c: F.coalesce(F.col(c).cast("string"), F.lit("unknown")) for c in DURATION_CATEGORIES},
        "direct_distance_km": geo.haversine_km(*path),
        "grid_distance_km": geo.grid_distance_km(*path),
        "delta_lat": path[2] - path[0],
        "delta_lng": path[3] - path[1],
        "bearing_sin": sine,
        "bearing_cos": cosine,
        **cal.cyclic_time(F.col("started_at")),
        "is_weekend": cal.is_weekend(F.col("started_at")),
        "is_holiday": cal.is_federal_holiday(F.col("started_at")),
    }
    absent = {c: F.lit(None).cast("double") for c in (*WEATHER_DURATION, *HISTORY_FEATURES) if c not in trips.columns}
    return trips.withColumns({**made, **absent})


def demand_features(table: DataFrame) -> DataFrame:
    ts = F.col("time")
    return table.withColumns({
        "hour": F.hour(ts), "weekday": cal.weekday(ts), "month": F.month(ts), "is_weekend": cal.is_weekend(ts),
        "is_holiday": cal.is_federal_holiday(ts), "year": F.year(ts),
    })


def iqr_bounds(quartiles: DataFrame) -> DataFrame:
    """Rows with q1 and q3 to rows with the usual fences."""
    spread = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    return quartiles.withColumns({"low": F.col("q1") - spread, "high": F.col("q3") + spread}).drop("n", "q1", "q3")


def shape_features(df: DataFrame, cap: str, stem_width: str, stem_height: str, watched: Sequence[str]) -> DataFrame:
    width, height, head = F.col(stem_width), F.col(stem_height), F.col(cap)
    missing = sum((F.col(c).isNull().cast("int") for c in watched[1:]), F.col(watched[0]).isNull().cast("int"))
    return df.withColumns({
        "stem_volume": F.lit(math.pi) * (width / 2) * (width / 2) * height,
        "stem_product": height * width,
        "cap_sq": head * head,
        "cap_stem_ratio": head * 10 / (width + 1),
        "slenderness": height * 10 / (width + 1),
        "n_missing": missing,
    })


def weather_scenarios(weather: DataFrame) -> DataFrame:
    """Every hour under every scenario: a six-fold expansion inside the projection, no join."""
    out = weather.withColumn("scenario", F.explode(F.array(*[F.lit(s) for s in SCENARIOS])))
    changed = {}
    for column in ("temperature_c", "precipitation_mm", "snow_depth_cm"):
        value = F.col(column)
        pick = F.when(F.lit(False), value)
        for scenario, rules in SCENARIOS.items():
            if column in rules:
                kind, amount = rules[column]
                new = {"set": F.lit(amount), "at least": F.greatest(value, F.lit(amount)), "at most": F.least(value, F.lit(amount))}[kind]
                pick = pick.when(F.col("scenario") == scenario, new)
        changed[column] = pick.otherwise(value)
    return out.withColumns(changed)


def wet_class(rain: Column) -> Column:
    return F.when(rain == 0, "dry").when(rain >= 0.5, "wet").otherwise("drizzle")


def morning(ts: Column) -> Column:
    return F.hour(ts).between(7, 9).cast("int")


def daytype(ts: Column) -> Column:
    return F.when(F.weekday(ts) >= 5, "weekend").otherwise("weekday")
