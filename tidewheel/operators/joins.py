"""Lookups and joins.

No broadcast hint is given for a table that may grow: Spark broadcasts a side whose measured size is
under its threshold and otherwise shuffles both, splitting hot keys. Hinted are tables with a fixed row
bound, where the bound is known, and hourly tables whose rows have been counted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.functions import calendar as cal
from tidewheel.session import stage


#: Most hours that are sent to every task (a century has 876,600); beyond that Spark chooses.
BROADCAST_HOURS = 1_000_000


def hourly_side(hourly: DataFrame, copies: str | None = None) -> DataFrame:
    """A table of one row per hour, written once so that its size is known before a join with it is planned. More than
    one in the column ``copies`` is an error."""
    side = stage(hourly, "hourly")
    seen = side.agg(F.count(F.lit(1)).alias("n"), F.max(copies or F.lit(1)).alias("copies")).first()
    if (seen["copies"] or 1) > 1:
        raise ValueError("more than one row for an hour")
    return F.broadcast(side) if seen["n"] <= BROADCAST_HOURS else side


def join_hourly(
    rows: DataFrame, hourly: DataFrame | None, ts: str, hour: str = "time", columns: Sequence[str] = ()
) -> DataFrame:
    """Left join on the started hour. ``hourly`` must have one row per hour: a repeated hour is an error. Without a
    table the columns are null. Below BROADCAST_HOURS measured hours ``rows`` are not shuffled."""
    if hourly is None:
        return rows.withColumns({c: F.lit(None).cast("double") for c in columns})
    one = hourly.groupBy(F.col(hour).alias("_hour")).agg(
        F.count(F.lit(1)).alias("_copies"), *[F.max(c).alias(c) for c in columns]
    )
    side = hourly_side(one, "_copies")
    return rows.withColumn("_hour", cal.hour_floor(F.col(ts))).join(side.drop("_copies"), "_hour", "left").drop("_hour")


def lookup(rows: DataFrame, table: DataFrame, on: Sequence[str], defaults: Mapping[str, object]) -> DataFrame:
    """Left join with a default for keys the table does not know."""
    joined = rows.join(table, list(on), "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(d)) for c, d in defaults.items()})


def salted_semi(rows: DataFrame, keys: DataFrame, on: Sequence[str], salts: int = 16, anti: bool = False) -> DataFrame:
    """Semi or anti join in which a hot key of ``rows`` is spread over ``salts`` tasks. ``keys`` holds
    distinct keys and is repeated once per salt; ``rows`` is a scan or a staged table, whose row order does
    not change when a task is repeated."""
    left = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    right = keys.select(*on).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, "_salt"], "left_anti" if anti else "left_semi").drop("_salt")


def nearest_hour(requests: DataFrame, hourly: DataFrame, ts: str, id_col: str, hour: str, columns: Sequence[str]) -> DataFrame:
    """The closest available hour within one hour of the floored request; ``in_reach`` is false and the
    columns are null when there is none. One row comes out for every request, repeated ids included.

    The answer depends on the floored hour alone: each available hour offers itself to three hours, the earliest of
    equally near ones wins, and requests look their hour up once.
    """
    off = F.col("_off")
    offers = hourly.where(F.col(columns[0]).isNotNull()).select(F.col(hour).alias("weather_hour"), *columns).withColumn(
        "_off", F.explode(F.array(F.lit(0), F.lit(-1), F.lit(1))))
    # an hour that lies _off hours from the request's serves the request's hour
    offers = offers.withColumn("_at", F.timestamp_add("HOUR", -off, F.col("weather_hour")))
    rank = F.struct(F.abs(off).alias("d"), off.alias("o"))
    best = offers.groupBy("_at").agg(*[F.min_by(c, rank).alias(c) for c in ("weather_hour", *columns)])
    asked = requests.select(id_col, cal.hour_floor(F.col(ts)).alias("_at")).join(hourly_side(best), "_at", "left")
    return asked.select(id_col, F.col("weather_hour").isNotNull().alias("in_reach"), "weather_hour", *columns)
