"""Joins, set operations and filters that need a second table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewheel.functions import calendar as cal
from tidewheel.functions import features
from tidewheel.operators import aggregate, grid, joins
from tidewheel.plans import demand
from tidewheel.plans import views as v
from tidewheel.plans.views import Book

BOOK = Book()
add = BOOK.add


@add("join_hourly_weather", "trips_ev weather", """SELECT t.ride_id, w.temperature_c AS temperature_2m, w.humidity_pct AS relative_humidity_2m,
    w.precipitation_mm AS precipitation, w.wind_kmh AS wind_speed_10m FROM trips_ev t LEFT JOIN weather w ON w.time = date_trunc('hour', t.started_at)""")
def join_hourly_weather(spark, sf):
    trips = v.trips_ev(spark, sf).select("ride_id", "started_at")
    out = joins.join_hourly(trips, features.duration_weather(v.weather(spark, sf)), "started_at", "time", features.WEATHER_DURATION)
    return out.select("ride_id", *features.WEATHER_DURATION)


@add("join_missing_dimension", "trips_ev", """SELECT ride_id, CAST(NULL AS DOUBLE) AS temperature_2m, CAST(NULL AS DOUBLE) AS relative_humidity_2m,
    CAST(NULL AS DOUBLE) AS precipitation, CAST(NULL AS DOUBLE) AS wind_speed_10m FROM trips_ev""")
def join_missing_dimension(spark, sf):
    return joins.join_hourly(v.trips_ev(spark, sf).select("ride_id"), None, "started_at", columns=features.WEATHER_DURATION)


@add("map_lookup", "trips_li", """SELECT coalesce(n.s_nationkey, -1) AS place, t.trips, t.start_station_id FROM
    (SELECT start_station_id, count(*) AS trips FROM trips_li GROUP BY 1) t
    LEFT JOIN (SELECT CAST(s_suppkey AS VARCHAR) AS start_station_id, s_nationkey FROM supplier WHERE s_acctbal > 0) n USING (start_station_id)""")
def map_lookup(spark, sf):
    """Stations to their district, -1 when unknown; trips are counted before the lookup."""
    counts = v.trips_li(spark, sf).groupBy("start_station_id").agg(F.count(F.lit(1)).alias("trips"))
    place = v.table(spark, sf, "supplier").where("s_acctbal > 0").select(
        F.col("s_suppkey").cast("string").alias("start_station_id"), F.col("s_nationkey").alias("place"))
    return joins.lookup(counts, place, ["start_station_id"], {"place": -1})


@add("join_active_stations", "zone_hour departures", """SELECT z.zone, z.time, z.trips, coalesce(a.active_stations, 0) AS active_stations FROM zone_hour z
    LEFT JOIN (SELECT CAST(CAST(start_station_id AS INTEGER) % 10 AS INTEGER) AS zone, date_trunc('month', started_at) AS m,
        count(DISTINCT start_station_id) AS active_stations FROM departures GROUP BY 1, 2) a ON a.zone = z.zone AND a.m = date_trunc('month', z.time)""")
def join_active_stations(spark, sf):
    active = grid.active_locations(demand.zoned_departures(spark, sf), "zone", F.col("start_station_id"))
    return grid.join_active(demand.zone_hour(spark, sf), active).select("zone", "time", "trips", "active_stations")


@add("semi_in_set", "trips_li", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM trips_li
    WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""")
def semi_in_set(spark, sf):
    keep = v.table(spark, sf, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey")).distinct()
    return v.trips_li(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").join(keep, "l_suppkey", "left_semi")


@add("anti_in_set", "trips_li", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM trips_li
    WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""")
def anti_in_set(spark, sf):
    """The set may be large and one key may dominate the rows, so the rows are salted."""
    drop = v.table(spark, sf, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey")).distinct()
    rows = v.trips_li(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return joins.salted_semi(rows, drop, ["l_suppkey"], anti=True)


@add("multiset_overlap", "trips_li", """WITH a AS (SELECT started_at, start_station_id, count(*) AS n FROM trips_li WHERE l_linenumber <= 3 GROUP BY 1, 2),
    b AS (SELECT started_at, start_station_id, count(*) AS n FROM trips_li WHERE l_linenumber >= 3 GROUP BY 1, 2)
    SELECT (SELECT CAST(sum(n) AS BIGINT) FROM a) AS rows_a, (SELECT CAST(sum(n) AS BIGINT) FROM b) AS rows_b,
        (SELECT CAST(sum(a.n) AS BIGINT) FROM a JOIN b ON a.started_at = b.started_at AND a.start_station_id = b.start_station_id AND a.n = b.n) AS rows_in_both""")
def multiset_overlap(spark, sf):
    trips = v.trips_li(spark, sf).select("started_at", "start_station_id", "l_linenumber")
    return aggregate.multiset_overlap(trips.where("l_linenumber <= 3"), trips.where("l_linenumber >= 3"), ["started_at", "start_station_id"])


@add("join_predictions", "preds weather", """SELECT zone, time, trips, pred_a AS a, pred_b AS b, w.temperature_c FROM preds LEFT JOIN weather w USING (time)""")
def join_predictions(spark, sf):
    """One row per model turned into one column per model, next to the features of the hour."""
    wide = demand.predictions(spark, sf)
    long = wide.unpivot(["zone", "time", "trips"], ["pred_a", "pred_b"], "model", "pred")
    side = long.groupBy("zone", "time", "trips").pivot("model", ["pred_a", "pred_b"]).agg(F.max("pred"))
    out = joins.join_hourly(side, v.weather(spark, sf), "time", "time", ["temperature_c"])
    return out.select("zone", "time", "trips", F.col("pred_a").alias("a"), F.col("pred_b").alias("b"), "temperature_c")


@add("nearest_hour", "weather trips_ev", """WITH f AS (SELECT * FROM weather WHERE humidity_pct >= 60),
    asked AS (SELECT ride_id, date_trunc('hour', started_at) AS at FROM trips_ev),
    c AS (SELECT a.ride_id, f.time, f.temperature_c, row_number() OVER (PARTITION BY a.ride_id ORDER BY abs(date_diff('hour', a.at, f.time)), f.time) AS rn
          FROM asked a JOIN f ON f.time BETWEEN a.at - INTERVAL 1 HOUR AND a.at + INTERVAL 1 HOUR)
    SELECT a.ride_id, c.ride_id IS NOT NULL AS in_reach, c.time AS weather_hour, c.temperature_c FROM asked a LEFT JOIN c ON c.ride_id = a.ride_id AND c.rn = 1""")
def nearest_hour(spark, sf):
    forecast = v.weather(spark, sf).where("humidity_pct >= 60")
    return joins.nearest_hour(v.trips_ev(spark, sf), forecast, "started_at", "ride_id", "time", ["temperature_c"])


SPLIT = "case when l_orderkey % 10 < 7 then 'train' when l_orderkey % 10 < 9 then 'validation' else 'test' end"
LEAK = ["kind", "size", "width", "noise_0", "season"]


@add("split_leak_check", "cases", f"""WITH s AS (SELECT coalesce(kind, '-') AS kind, coalesce(size, -999999.0) AS size, width, noise_0, season, {SPLIT} AS split FROM cases),
    g AS (SELECT kind, size, width, noise_0, season, count(*) AS n FROM s GROUP BY ALL),
    k AS (SELECT DISTINCT kind, size, width, noise_0, season, split FROM s)
    SELECT (SELECT CAST(sum(n) AS BIGINT) FROM g WHERE n > 1) AS duplicate_rows,
        (SELECT count(*) FROM s SEMI JOIN (SELECT * EXCLUDE (split) FROM k WHERE split = 'train') USING (kind, size, width, noise_0, season) WHERE s.split = 'validation') AS validation_in_train,
        (SELECT count(*) FROM s SEMI JOIN (SELECT * EXCLUDE (split) FROM k WHERE split = 'train') USING (kind, size, width, noise_0, season) WHERE s.split = 'test') AS test_in_train,
        (SELECT count(*) FROM s SEMI JOIN (SELECT * EXCLUDE (split) FROM k WHERE split = 'validation') USING (kind, size, width, noise_0, season) WHERE s.split = 'test') AS test_in_validation""")
def split_leak_check(spark, sf):
    return aggregate.split_overlap(v.cases(spark, sf).withColumn("split", F.expr(SPLIT)), LEAK, "split")


@add("union_by_name", sql="""SELECT o_orderkey AS ride_id, CAST(NULL AS VARCHAR) AS rideable_type, o_orderpriority AS member_casual FROM orders
    UNION ALL SELECT event_id, event_type, NULL FROM events""")
def union_by_name(spark, sf):
    old = v.table(spark, sf, "orders").select(F.col("o_orderkey").alias("ride_id"), F.col("o_orderpriority").alias("member_casual"))
    new = v.table(spark, sf, "events").select(F.col("event_id").alias("ride_id"), F.col("event_type").alias("rideable_type"))
    return old.unionByName(new, allowMissingColumns=True)


@add("distinct_rows", "trips_li", f"""SELECT ride_id, started_at, start_station_id, duration_minutes FROM (SELECT *,
    row_number() OVER (PARTITION BY ride_id ORDER BY {", ".join(v.TRIP_ORDER)}) AS rn FROM trips_li) WHERE rn = 1""")
def distinct_rows(spark, sf):
    out = aggregate.first_rows(v.trips_li(spark, sf), ["ride_id"], v.TRIP_ORDER)
    return out.select("ride_id", "started_at", "start_station_id", "duration_minutes")


@add("exclude_days", "orders_day", """SELECT o_orderkey, o_orderdate FROM orders
    WHERE date_trunc('day', o_orderdate) NOT IN (SELECT day FROM orders_day WHERE trips < (SELECT 0.5 * avg(trips) FROM orders_day))""")
def exclude_days(spark, sf):
    days = v.orders_day(spark, sf)
    closed = days.where(F.col("trips") < F.lit(0.5) * days.select(F.avg("trips").alias("m")).scalar()).select(F.col("day").alias("_day"))
    rows = v.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return rows.join(closed, cal.day_floor(F.col("o_orderdate")) == F.col("_day"), "left_anti")


@add("recent_members", sql="""SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders
    WHERE o_orderdate >= (SELECT max(o_orderdate) + INTERVAL 1 HOUR - INTERVAL 6 MONTH FROM orders))""")
def recent_members(spark, sf):
    from tidewheel.operators.splits import last_months_cut

    orders = v.table(spark, sf, "orders")
    recent = orders.where(F.col("o_orderdate") >= last_months_cut(orders, "o_orderdate", 6)).select(F.col("o_custkey").alias("c_custkey")).distinct()
    return v.table(spark, sf, "customer").select("c_custkey", "c_mktsegment").join(recent, "c_custkey", "left_semi")
