"""Stand-in inputs derived from the supplied tables, once in Spark and once as SQL text.

Every view reads its whole table, so the work of a query grows with the data. Repeatable picks use
integer arithmetic instead of an engine's own hash function, so that both engines agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Unique together over lineitem (with the ship date inside started_at).
TRIP_ORDER = [
    "started_at", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips from the event table: short and long durations, null stations, bad coordinates."""
    return table(spark, sf_dir, "events").selectExpr(
        "cast(event_id as string) as ride_id",
        "case when event_type in ('click', 'view') then 'electric_bike' else 'classic_bike' end as rideable_type",
        "ts as started_at",
        "ts + make_dt_interval(0, 0, 0, cast(value * 60 as decimal(18, 6))) as ended_at",
        "value as duration_minutes",
        "case when event_id % 101 = 0 then null else cast(user_id % 40 as string) end as start_station_id",
        "cast((event_id * 7) % 40 as string) as end_station_id",
        "case when event_id % 97 = 0 then 0.0D else 40.60D + 0.010D * (user_id % 40) end as start_lat",
        "-74.20D + 0.015D * (user_id % 40) as start_lng",
        "40.60D + 0.010D * ((event_id * 7) % 40) as end_lat",
        "-74.20D + 0.015D * ((event_id * 7) % 40) as end_lng",
        "case when user_id % 10 < 7 then 'member' else 'casual' end as member_casual",
        "event_id",
    )


def trips_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips from the line items: the large view, with repeated ride ids."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat(l_orderkey, '-', l_linenumber) as ride_id",
        "case when l_linestatus = 'O' then 'electric_bike' else 'classic_bike' end as rideable_type",
        "cast(l_shipdate as timestamp_ntz) + make_dt_interval(0, 0, 0, "
        "cast((l_orderkey * 7919 + l_linenumber * 104729) % 86400 as decimal(18, 6))) as started_at",
        "l_extendedprice / 400.0D as duration_minutes",
        "cast(l_suppkey as string) as start_station_id",
        "cast(l_partkey % 97 as string) as end_station_id",
        "40.60D + 0.010D * (l_suppkey % 40) as start_lat",
        "-74.20D + 0.015D * (l_suppkey % 40) as start_lng",
        "40.60D + 0.010D * ((l_partkey % 97) % 40) as end_lat",
        "-74.20D + 0.015D * ((l_partkey % 97) % 40) as end_lng",
        "case when l_returnflag <> 'R' then 'member' else 'casual' end as member_casual",
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per hour with events; measures follow from the hour number."""
    hours = table(spark, sf_dir, "events").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("time")).count()
    return hours.selectExpr(
        "time", "timestampdiff(HOUR, timestamp_ntz'2024-01-01', time) as h"
    ).selectExpr(
        "time",
        "cast(10 + (h * 7) % 25 as double) as temperature_c",
        "case when h % 5 = 0 then (h % 7) * 0.5D else 0.0D end as precipitation_mm",
        "cast(5 + h % 20 as double) as wind_kmh",
        "cast(40 + h % 55 as double) as humidity_pct",
        "cast(case when h % 50 < 5 then h % 5 else 0 end as double) as snow_depth_cm",
    )


def weather_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly weather with temperature missing for one, five or six hours in a row."""
    gap = "timestampdiff(HOUR, timestamp_ntz'2024-01-01', time) % 60 between 10 and 14 or " \
          "timestampdiff(HOUR, timestamp_ntz'2024-01-01', time) % 37 = 5"
    return weather(spark, sf_dir).select(
        "time", F.expr(f"case when {gap} then null else temperature_c end").alias("temperature_c")
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier rows as stations: names with depots, ids of all schemes."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey",
        "case s_suppkey % 5 when 0 then concat('HB', s_suppkey) when 1 then concat('SYS', s_suppkey) "
        "else cast(s_suppkey as string) end as start_station_id",
        "case when s_suppkey % 7 = 0 then concat(s_name, ' Depot') when s_suppkey % 11 = 0 then concat('lab ', s_name) "
        "when s_suppkey % 13 = 0 then null else s_name end as name",
        "40.60D + 0.010D * (s_suppkey % 40) as lat",
        "-74.20D + 0.015D * (s_suppkey % 40) as lng",
    )


def raw_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station ids as text in five notations, on both sides of the change of id system."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber",
        "timestampadd(YEAR, 24, cast(l_shipdate as timestamp_ntz)) as started_at",
        "case l_suppkey % 5 when 0 then concat(l_suppkey + 7000, '.1') when 1 then concat(l_suppkey, '.0') "
        "when 2 then cast(l_suppkey as string) when 3 then concat('HB', l_suppkey) else concat('SYS', l_suppkey) end as station_id",
    )


def scores_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two model scores per line item, label y."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_linestatus",
        "case when l_returnflag = 'R' then 1 else 0 end as y",
        "cast(l_orderkey % 5 as int) as fold",
    ).selectExpr(
        "*",
        "(300 * y + 100 * (1 - y) + floor(6 * ((l_orderkey * 31 + l_partkey * 17) % 1000) / 10)) / 1000.0D as p_a",
        "(300 * y + 100 * (1 - y) + floor(6 * ((l_orderkey * 13 + l_partkey * 29) % 1000) / 10)) / 1000.0D as p_b",
        "(300 * y + 100 * (1 - y) + floor(6 * ((l_orderkey * 7 + l_partkey * 41) % 1000) / 10)) / 1000.0D as p_c",
    )


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A classification table with missing categories: line items with their part."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    return li.join(part, li.l_partkey == part.p_partkey).selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey",
        "p_brand as brand",
        "case when l_partkey % 11 = 0 then null else p_type end as kind",
        "case when l_partkey % 7 = 0 then null else cast(p_size as double) end as size",
        "l_quantity as width",
        "l_extendedprice / 1000.0D as height",
        "substr('abcdefg', cast(l_orderkey % 7 + 1 as int), 1) as noise_0",
        "case when l_orderkey % 13 = 0 then null else substr('abcdefg', cast((l_orderkey * 3 + l_linenumber) % 7 + 1 as int), 1) end as noise_1",
        "case when l_returnflag = 'R' then 'p' else 'e' end as class",
        "cast(case quarter(l_shipdate) when 1 then 'w' when 2 then 's' when 3 then 'u' else 'a' end as string) as season",
    )


def orders_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per calendar day."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.date_trunc("day", "o_orderdate").cast("timestamp_ntz").alias("day"))
        .agg(F.count(F.lit(1)).alias("trips"), F.sum((F.col("o_orderstatus") == "O").cast("long")).alias("members"))
    )


# The same views as SQL. Each entry: (views it needs, body).
SQL_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "trips_ev": ((), """
        SELECT CAST(event_id AS VARCHAR) AS ride_id,
               CASE WHEN event_type IN ('click', 'view') THEN 'electric_bike' ELSE 'classic_bike' END AS rideable_type,
               ts AS started_at,
               ts + to_microseconds(CAST(round(value * 60000000) AS BIGINT)) AS ended_at,
               value AS duration_minutes,
               CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST(user_id % 40 AS VARCHAR) END AS start_station_id,
               CAST((event_id * 7) % 40 AS VARCHAR) AS end_station_id,
               CASE WHEN event_id % 97 = 0 THEN 0.0::DOUBLE ELSE 40.60::DOUBLE + 0.010::DOUBLE * (user_id % 40) END AS start_lat,
               -74.20::DOUBLE + 0.015::DOUBLE * (user_id % 40) AS start_lng,
               40.60::DOUBLE + 0.010::DOUBLE * ((event_id * 7) % 40) AS end_lat,
               -74.20::DOUBLE + 0.015::DOUBLE * ((event_id * 7) % 40) AS end_lng,
               CASE WHEN user_id % 10 < 7 THEN 'member' ELSE 'casual' END AS member_casual,
               event_id
        FROM events"""),
    "trips_li": ((), """
        SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS ride_id,
               CASE WHEN l_linestatus = 'O' THEN 'electric_bike' ELSE 'classic_bike' END AS rideable_type,
               l_shipdate + to_seconds((l_orderkey * 7919 + l_linenumber * 104729) % 86400) AS started_at,
               l_extendedprice / 400.0::DOUBLE AS duration_minutes,
               CAST(l_suppkey AS VARCHAR) AS start_station_id,
               CAST(l_partkey % 97 AS VARCHAR) AS end_station_id,
               40.60::DOUBLE + 0.010::DOUBLE * (l_suppkey % 40) AS start_lat,
               -74.20::DOUBLE + 0.015::DOUBLE * (l_suppkey % 40) AS start_lng,
               40.60::DOUBLE + 0.010::DOUBLE * ((l_partkey % 97) % 40) AS end_lat,
               -74.20::DOUBLE + 0.015::DOUBLE * ((l_partkey % 97) % 40) AS end_lng,
               CASE WHEN l_returnflag <> 'R' THEN 'member' ELSE 'casual' END AS member_casual,
               l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax
        FROM lineitem"""),
    "weather": ((), """
        SELECT time,
               CAST(10 + (h * 7) % 25 AS DOUBLE) AS temperature_c,
               CASE WHEN h % 5 = 0 THEN (h % 7) * 0.5::DOUBLE ELSE 0.0::DOUBLE END AS precipitation_mm,
               CAST(5 + h % 20 AS DOUBLE) AS wind_kmh,
               CAST(40 + h % 55 AS DOUBLE) AS humidity_pct,
               CAST(CASE WHEN h % 50 < 5 THEN h % 5 ELSE 0 END AS DOUBLE) AS snow_depth_cm
        FROM (SELECT time, date_diff('hour', TIMESTAMP '2024-01-01 00:00:00', time) AS h
              FROM (SELECT DISTINCT date_trunc('hour', ts) AS time FROM events))"""),
    "weather_gaps": (("weather",), """
        SELECT time, CASE WHEN date_diff('hour', TIMESTAMP '2024-01-01 00:00:00', time) % 60 BETWEEN 10 AND 14
                            OR date_diff('hour', TIMESTAMP '2024-01-01 00:00:00', time) % 37 = 5
                          THEN NULL ELSE temperature_c END AS temperature_c
        FROM weather"""),
    "stations": ((), """
        SELECT s_suppkey,
               CASE s_suppkey % 5 WHEN 0 THEN 'HB' || s_suppkey WHEN 1 THEN 'SYS' || s_suppkey
                    ELSE CAST(s_suppkey AS VARCHAR) END AS start_station_id,
               CASE WHEN s_suppkey % 7 = 0 THEN s_name || ' Depot' WHEN s_suppkey % 11 = 0 THEN 'lab ' || s_name
                    WHEN s_suppkey % 13 = 0 THEN NULL ELSE s_name END AS name,
               40.60::DOUBLE + 0.010::DOUBLE * (s_suppkey % 40) AS lat,
               -74.20::DOUBLE + 0.015::DOUBLE * (s_suppkey % 40) AS lng
        FROM supplier"""),
    "raw_ids": ((), """
        SELECT l_orderkey, l_linenumber, l_shipdate + INTERVAL 24 YEAR AS started_at,
               CASE l_suppkey % 5 WHEN 0 THEN CAST(l_suppkey + 7000 AS VARCHAR) || '.1'
                    WHEN 1 THEN CAST(l_suppkey AS VARCHAR) || '.0' WHEN 2 THEN CAST(l_suppkey AS VARCHAR)
                    WHEN 3 THEN 'HB' || l_suppkey ELSE 'SYS' || l_suppkey END AS station_id
        FROM lineitem"""),
    "scores_li": ((), """
        SELECT *,
               (300 * y + 100 * (1 - y) + floor(6 * ((l_orderkey * 31 + l_partkey * 17) % 1000) / 10.0)) / 1000.0::DOUBLE AS p_a,
               (300 * y + 100 * (1 - y) + floor(6 * ((l_orderkey * 13 + l_partkey * 29) % 1000) / 10.0)) / 1000.0::DOUBLE AS p_b,
               (300 * y + 100 * (1 - y) + floor(6 * ((l_orderkey * 7 + l_partkey * 41) % 1000) / 10.0)) / 1000.0::DOUBLE AS p_c
        FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_linestatus,
                     CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
                     CAST(l_orderkey % 5 AS INTEGER) AS fold FROM lineitem)"""),
    "cases": ((), """
        SELECT l_orderkey, l_linenumber, l_partkey, p_brand AS brand,
               CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE p_type END AS kind,
               CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS size,
               l_quantity AS width, l_extendedprice / 1000.0::DOUBLE AS height,
               substr('abcdefg', CAST(l_orderkey % 7 + 1 AS INTEGER), 1) AS noise_0,
               CASE WHEN l_orderkey % 13 = 0 THEN NULL
                    ELSE substr('abcdefg', CAST((l_orderkey * 3 + l_linenumber) % 7 + 1 AS INTEGER), 1) END AS noise_1,
               CASE WHEN l_returnflag = 'R' THEN 'p' ELSE 'e' END AS class,
               CASE quarter(l_shipdate) WHEN 1 THEN 'w' WHEN 2 THEN 's' WHEN 3 THEN 'u' ELSE 'a' END AS season
        FROM lineitem JOIN part ON l_partkey = p_partkey"""),
    "orders_day": ((), """
        SELECT date_trunc('day', o_orderdate)::TIMESTAMP AS day, count(*) AS trips,
               CAST(count(*) FILTER (WHERE o_orderstatus = 'O') AS BIGINT) AS members
        FROM orders GROUP BY 1"""),
    "holidays": ((), """
        SELECT DISTINCT CASE WHEN isodow(d) = 6 THEN d - 1 WHEN isodow(d) = 7 THEN d + 1 ELSE d END AS day FROM (
            SELECT make_date(y, m, dd) AS d
            FROM range(1990, 2032) t(y), (VALUES (1, 1), (6, 19), (7, 4), (11, 11), (12, 25)) f(m, dd)
            WHERE m <> 6 OR y >= 2021
            UNION ALL
            SELECT first_day + CAST((wd - isodow(first_day) + 7) % 7 + 7 * (n - 1) AS INTEGER)
            FROM (SELECT make_date(y, m, 1) AS first_day, wd, n FROM range(1990, 2032) t(y),
                  (VALUES (1, 1, 3), (2, 1, 3), (9, 1, 1), (10, 1, 2), (11, 4, 4)) f(m, wd, n))
            UNION ALL
            SELECT make_date(y, 5, 31) - CAST(isodow(make_date(y, 5, 31)) - 1 AS INTEGER) FROM range(1990, 2032) t(y))"""),
    "departures": (("trips_ev",), """
        SELECT * FROM trips_ev
        WHERE started_at IS NOT NULL AND start_station_id IS NOT NULL
          AND start_lat BETWEEN 40.4 AND 41.1 AND start_lng BETWEEN -74.4 AND -73.5"""),
    "zone_counts": (("departures",), """
        SELECT CAST(CAST(start_station_id AS INTEGER) % 10 AS INTEGER) AS zone, date_trunc('hour', started_at) AS time,
               count(*) AS trips, CAST(count(*) FILTER (WHERE member_casual = 'member') AS BIGINT) AS members,
               CAST(count(*) FILTER (WHERE rideable_type = 'electric_bike') AS BIGINT) AS electric
        FROM departures GROUP BY 1, 2"""),
    "zone_hour": (("zone_counts",), """
        SELECT z.zone, t.time, coalesce(c.trips, 0) AS trips, coalesce(c.members, 0) AS members,
               coalesce(c.electric, 0) AS electric
        FROM (SELECT CAST(unnest(range(10)) AS INTEGER) AS zone) z
        CROSS JOIN (SELECT unnest(generate_series((SELECT date_trunc('day', min(time))::TIMESTAMP FROM zone_counts),
                        (SELECT date_trunc('day', max(time))::TIMESTAMP + INTERVAL 23 HOUR FROM zone_counts), INTERVAL 1 HOUR)) AS time) t
        LEFT JOIN zone_counts c ON c.zone = z.zone AND c.time = t.time"""),
    "preds": (("zone_hour",), """
        SELECT zone, time, trips, trips * 0.9::DOUBLE + 0.5::DOUBLE AS pred_a, CAST(trips + (zone % 3) - 1 AS DOUBLE) AS pred_b
        FROM zone_hour"""),
}


def with_views(names: str | tuple[str, ...], body: str) -> str:
    """Prefix ``body`` with the view definitions it needs, in dependency order."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for need in SQL_VIEWS[name][0]:
            add(need)
        if name not in wanted:
            wanted.append(name)

    for name in (names.split() if isinstance(names, str) else names):
        add(name)
    head = ",\n".join(f"{n} AS ({SQL_VIEWS[n][1]})" for n in wanted)
    if not head:
        return body
    if body.lstrip().upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {head},\n{body.lstrip()[15:]}"
    if body.lstrip().upper().startswith("WITH "):
        return f"WITH {head},\n{body.lstrip()[5:]}"
    return f"WITH {head}\n{body}"


class Book:
    """Registered queries with their SQL twins."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def add(self, key: str, views: str = "", sql: str | None = None):
        def keep(fn):
            if key in self.queries:
                raise ValueError(f"{key} registered twice")
            self.queries[key] = fn
            if sql is not None:
                self.oracles[key] = with_views(views, sql)
            return fn

        return keep


def r6(sql: str, digits: int = 6) -> str:
    """SQL twin of ``rnd``."""
    return f"(floor(CAST({sql} AS DOUBLE) * {10**digits} + 0.5) / {10**digits})"


def rnd(value: str | Column, digits: int = 6) -> Column:
    """Rounding by arithmetic that is the same in every engine; sums of doubles differ in their last
    digits and the engines' own ``round`` treats ties differently."""
    value = F.col(value) if isinstance(value, str) else value
    return F.floor(value.cast("double") * 10**digits + 0.5) / F.lit(float(10**digits))


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: rnd(n, digits) for n in names})
