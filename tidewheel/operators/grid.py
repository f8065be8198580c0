"""Counts, dense grids and time-series shaping.

Everything after the first aggregate has at most (zones x hours) or (days) rows; windows there run per
zone, per year or over the day series, never over trips.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewheel.functions import calendar as cal

_FIRST, _LAST = Window.unboundedPreceding, Window.unboundedFollowing


def station_hour_counts(trips: DataFrame, place: str = "start_station_id") -> DataFrame:
    """Departures, members and electric rides per place and hour; one shuffle of partial sums."""
    return trips.groupBy(place, cal.hour_floor(F.col("started_at")).alias("time")).agg(
        F.count(F.lit(1)).alias("trips"),
        F.count_if(F.coalesce(F.col("member_casual") == "member", F.lit(False))).alias("members"),
        F.count_if(F.coalesce(F.col("rideable_type") == "electric_bike", F.lit(False))).alias("electric"),
    )


def merge_counts(parts: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Add up stored partial counts."""
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def dense_hours(counts: DataFrame, spark: SparkSession, n_zones: int, sums: Sequence[str] = ("trips", "members", "electric")) -> DataFrame:
    """All zones x all hours of the covered days; hours without a departure count zero."""
    span = counts.select(F.struct(
        cal.day_floor(F.min("time")).alias("first"), F.timestamp_add("HOUR", F.lit(23), cal.day_floor(F.max("time"))).alias("last")).alias("s")).scalar()
    hours = F.sequence(span["first"], span["last"], F.expr("interval 1 hour"))
    grid = spark.range(n_zones).select(F.col("id").cast("int").alias("zone"), F.explode(hours).alias("time"))
    return grid.join(counts, ["zone", "time"], "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in sums})


def dense_days(daily: DataFrame, spark: SparkSession, day: str = "day", sums: Sequence[str] = ("trips",)) -> DataFrame:
    span = daily.select(F.struct(F.min(day).alias("first"), F.max(day).alias("last")).alias("s")).scalar()
    grid = spark.range(1).select(F.explode(F.sequence(span["first"], span["last"], F.expr("interval 1 day"))).alias(day))
    return grid.join(daily, day, "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in sums})


def active_locations(trips: DataFrame, zone: str, location: Column) -> DataFrame:
    """Distinct places with a departure per zone and month: a renamed station counts once."""
    return trips.groupBy(zone, cal.month_floor(F.col("started_at")).alias("month_start")).agg(
        F.countDistinct(location).alias("active_stations")
    )


def join_active(grid: DataFrame, active: DataFrame) -> DataFrame:
    """Supply per zone and month; zero where nothing was active."""
    out = grid.withColumn("month_start", cal.month_floor(F.col("time"))).join(active, ["zone", "month_start"], "left")
    return out.withColumn("active_stations", F.coalesce("active_stations", F.lit(0))).drop("month_start")


def dedupe_hour(hourly: DataFrame, hour: str, order: Sequence[str]) -> DataFrame:
    """First row per hour in the given order. ``min`` over a struct is combined before the shuffle."""
    rest = [c for c in hourly.columns if c != hour]
    ordered = [*order, *[c for c in rest if c not in order]]
    picked = hourly.groupBy(hour).agg(F.min(F.struct(*ordered)).alias("_row"))
    return picked.select(hour, *[F.col(f"_row.{c}").alias(c) for c in rest])


def interpolate_limit(hourly: DataFrame, column: str, limit: int = 2, hour: str = "time") -> DataFrame:
    """Fill at most ``limit`` hours after a known value, on the line to the next known value; a trailing
    gap repeats the last value and a leading gap stays empty. Runs per calendar year (8,784 rows)."""
    per_year = Window.partitionBy(F.year(hour)).orderBy(hour)
    value = F.col(column)
    known = F.when(value.isNotNull(), F.struct(F.col(hour).alias("t"), value.alias("v")))
    before = F.last(known, ignorenulls=True).over(per_year.rowsBetween(_FIRST, 0))
    after = F.first(known, ignorenulls=True).over(per_year.rowsBetween(0, _LAST))
    rows = hourly.withColumns({"_before": before, "_after": after})
    step = F.timestamp_diff("HOUR", F.col("_before.t"), F.col(hour))
    gap = F.timestamp_diff("HOUR", F.col("_before.t"), F.col("_after.t"))
    line = F.when(
        F.col("_after").isNull(), F.col("_before.v")
    ).otherwise(F.col("_before.v") + (F.col("_after.v") - F.col("_before.v")) * step / gap)
    filled = F.when(value.isNotNull(), value).when(F.col("_before").isNotNull() & (step <= limit), line)
    return rows.withColumn(column, filled).drop("_before", "_after")


def lags(table: DataFrame, value: str, steps: dict[str, int], zone: str = "zone") -> DataFrame:
    """Values some rows earlier in the same zone of a dense table."""
    w = Window.partitionBy(zone).orderBy("time")
    return table.withColumns({name: F.lag(value, n).over(w) for name, n in steps.items()})


def centered_median(daily: DataFrame, value: str, day: str = "day", reach: int = 14, at_least: int = 10) -> DataFrame:
    """Median of the days around each day and the ratio to it. Every day is sent to the days it can
    influence, so no ordered pass over the whole series is needed."""
    near = daily.select(F.col(day).alias("_d"), F.col(value).cast("double").alias("_v")).withColumn(
        "_off", F.explode(F.sequence(F.lit(-reach), F.lit(reach)))
    )
    sent = near.select(F.timestamp_add("DAY", F.col("_off"), F.col("_d")).alias(day), "_v")
    stat = sent.groupBy(day).agg(F.percentile("_v", 0.5).alias("_m"), F.count("_v").alias("_n"))
    out = daily.join(stat, day).withColumn("median_around", F.when(F.col("_n") >= at_least, F.col("_m")))
    return out.withColumn("ratio", F.col(value) / F.col("median_around")).drop("_m", "_n")


def centered_mean(daily: DataFrame, value: str, before: int, after: int, name: str, day: str = "day") -> DataFrame:
    """Mean over a full window of days; null at the edges."""
    sent = daily.select(F.col(day).alias("_d"), F.col(value).cast("double").alias("_v")).withColumn(
        "_off", F.explode(F.sequence(F.lit(-after), F.lit(before)))
    ).select(F.timestamp_add("DAY", F.col("_off"), F.col("_d")).alias(day), "_v")
    stat = sent.groupBy(day).agg(F.avg("_v").alias("_m"), F.count("_v").alias("_n"))
    out = daily.join(stat, day).withColumn(name, F.when(F.col("_n") == before + after + 1, F.col("_m")))
    return out.drop("_m", "_n")


def year_over_year(monthly: DataFrame, value: str, month: str = "month") -> DataFrame:
    """The month as a percentage of the same month a year earlier, by an equality join."""
    last = monthly.select(F.timestamp_add("MONTH", F.lit(12), F.col(month)).alias(month), F.col(value).alias("_last"))
    out = monthly.join(last, month, "left")
    return out.withColumn("pct_of_last_year", F.try_divide(F.col(value) * F.lit(100.0), F.col("_last"))).drop("_last")


def rank_zones(stations: DataFrame, raw_zone: str = "raw_zone") -> DataFrame:
    """Zones renumbered from busy (0) to quiet, named after their busiest station. One row per zone
    reaches the window."""
    busiest = F.struct(F.col("trips"), F.col("start_station_id"))
    zones = stations.groupBy(raw_zone).agg(
        F.max_by("name", F.when(F.col("name").isNotNull(), busiest)).alias("name"),
        F.count(F.lit(1)).alias("n_stations"),
        F.sum("trips").alias("trips"),
        F.avg("lat").alias("lat"),
        F.avg("lng").alias("lng"),
    )
    order = Window.orderBy(F.desc("trips"), F.col(raw_zone))
    return zones.withColumn("zone", (F.row_number().over(order) - 1).cast("int"))


def station_dimension(trips: DataFrame) -> DataFrame:
    """Per station: last known name, mean position, trips, first and last hour."""
    time = cal.hour_floor(F.col("started_at"))
    latest = F.when(F.col("start_station_name").isNotNull(), F.struct(time, F.col("start_station_name")))
    return trips.groupBy("start_station_id").agg(
        F.max_by("start_station_name", latest).alias("name"),
        (F.sum("start_lat") / F.count(F.lit(1))).alias("lat"),
        (F.sum("start_lng") / F.count(F.lit(1))).alias("lng"),
        F.count(F.lit(1)).alias("trips"),
        F.min(time).alias("first_time"),
        F.max(time).alias("last_time"),
    )


def table_checks(table: DataFrame, expected_total: Column, keys: Sequence[str] = ("zone", "time"), value: str = "trips") -> DataFrame:
    """One row per invariant of the dense table: name, measured value, passed."""
    nulls = F.count_if(F.greatest(*[F.col(c).isNull() for c in table.columns]))
    per_key = table.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_c"), nulls.alias("_nulls"), F.sum(value).alias("_v"), F.count_if(F.col(value) < 0).alias("_neg")
    )
    one = per_key.agg(
        F.count_if(F.col("_c") > 1).alias("duplicate_keys"),
        F.sum("_nulls").alias("rows_with_null"),
        (F.sum("_v") - expected_total).alias("trips_lost"),
        F.sum("_neg").alias("negative_counts"),
    )
    long = one.unpivot([], one.columns, "check_name", "value")
    return long.withColumn("passed", F.col("value") == 0)
