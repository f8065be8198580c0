"""Dense grids, time-series shaping and running features."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewheel.functions import calendar as cal
from tidewheel.operators import grid, history, joins
from tidewheel.operators.aggregate import first_rows
from tidewheel.operators.order import average_ranks
from tidewheel.plans import demand
from tidewheel.plans import views as v
from tidewheel.plans.views import Book, r6, rnd, rounded

BOOK = Book()
add = BOOK.add


@add("zone_hour_grid", "zone_hour weather", "SELECT zone, time, trips, members, electric, temperature_c FROM zone_hour LEFT JOIN weather USING (time)")
def zone_hour_grid(spark, sf):
    out = joins.join_hourly(demand.zone_hour(spark, sf), v.weather(spark, sf), "time", "time", ["temperature_c"])
    return out.select("zone", "time", "trips", "members", "electric", "temperature_c")


@add("zone_hour_model_table", "zone_hour weather departures", """
    SELECT CAST(z.zone AS SMALLINT) AS zone, z.time, CAST(z.trips AS INTEGER) AS trips, CAST(z.members AS INTEGER) AS members,
        CAST(z.electric AS INTEGER) AS electric, CAST(a.n AS INTEGER) AS active_stations,
        w.temperature_c, w.precipitation_mm, w.wind_kmh, w.humidity_pct, w.snow_depth_cm,
        CASE WHEN day(z.time) > day(last_day(z.time)) - 7 THEN 'test' ELSE 'train' END AS split
    FROM zone_hour z LEFT JOIN weather w USING (time)
    JOIN (SELECT CAST(CAST(start_station_id AS INTEGER) % 10 AS INTEGER) AS zone, date_trunc('month', started_at) AS m,
        count(DISTINCT start_station_id) AS n FROM departures GROUP BY 1, 2) a ON a.zone = z.zone AND a.m = date_trunc('month', z.time)
    WHERE date_trunc('day', z.time) NOT IN (TIMESTAMP '2024-01-13', TIMESTAMP '2024-01-26')""")
def zone_hour_model_table(spark, sf):
    table = demand.model_table(spark, sf, ["2024-01-13", "2024-01-26"])
    return table.select(F.col("zone").cast("smallint").alias("zone"), "time",
                        *[F.col(c).cast("int").alias(c) for c in ("trips", "members", "electric", "active_stations")], *demand.WEATHER, "split")


DAYS = """d AS (SELECT g.day, coalesce(o.trips, 0) AS trips FROM (SELECT unnest(generate_series((SELECT min(day) FROM orders_day),
    (SELECT max(day) FROM orders_day), INTERVAL 1 DAY)) AS day) g LEFT JOIN orders_day o USING (day))"""


def dense_days(spark, sf):
    return grid.dense_days(v.orders_day(spark, sf).select("day", "trips"), spark)


@add("daily_reindex", "orders_day", f"WITH {DAYS} SELECT day, trips FROM d")
def daily_reindex(spark, sf):
    return dense_days(spark, sf)


@add("resample", "zone_hour", f"""SELECT 'day' AS level, date_trunc('day', time)::TIMESTAMP AS start, CAST(sum(trips) AS BIGINT) AS trips, {r6("avg(trips)")} AS mean_per_hour FROM zone_hour GROUP BY 2
    UNION ALL SELECT 'month', date_trunc('month', time)::TIMESTAMP, CAST(sum(trips) AS BIGINT), {r6("avg(trips)")} FROM zone_hour GROUP BY 2
    UNION ALL SELECT 'year', date_trunc('year', time)::TIMESTAMP, CAST(sum(trips) AS BIGINT), {r6("avg(trips)")} FROM zone_hour GROUP BY 2""")
def resample(spark, sf):
    """One pass: each hour is sent to its day, month and year."""
    levels = ["day", "month", "year"]
    starts = F.array(*[F.struct(F.lit(n).alias("level"), F.date_trunc(n, F.col("time")).cast("timestamp_ntz").alias("start")) for n in levels])
    long = demand.zone_hour(spark, sf).select("trips", F.explode(starts).alias("b"))
    out = long.groupBy("b.level", "b.start").agg(F.sum("trips").alias("trips"), F.avg("trips").alias("mean_per_hour"))
    return rounded(out, "mean_per_hour")


@add("interpolate_limit", "weather_gaps", f"""
    WITH g AS (SELECT t.time, w.temperature_c AS x FROM (SELECT unnest(generate_series((SELECT min(time) FROM weather_gaps), (SELECT max(time) FROM weather_gaps), INTERVAL 1 HOUR)) AS time) t
        LEFT JOIN weather_gaps w USING (time)),
    b AS (SELECT time, x, max(CASE WHEN x IS NOT NULL THEN time END) OVER (PARTITION BY year(time) ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS t0,
        min(CASE WHEN x IS NOT NULL THEN time END) OVER (PARTITION BY year(time) ORDER BY time ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS t1 FROM g)
    SELECT b.time, {r6('''CASE WHEN b.x IS NOT NULL THEN b.x WHEN b.t0 IS NULL OR date_diff('hour', b.t0, b.time) > 2 THEN NULL
        WHEN b.t1 IS NULL THEN p.x ELSE p.x + (n.x - p.x) * date_diff('hour', b.t0, b.time) / date_diff('hour', b.t0, b.t1) END''')} AS temperature_c
    FROM b LEFT JOIN g p ON p.time = b.t0 LEFT JOIN g n ON n.time = b.t1""")
def interpolate_limit(spark, sf):
    gaps = v.weather_gaps(spark, sf)
    span = gaps.select(F.struct(F.min("time").alias("first"), F.max("time").alias("last")).alias("s")).scalar()
    hours = spark.range(1).select(F.explode(F.sequence(span["first"], span["last"], F.expr("interval 1 hour"))).alias("time"))
    out = grid.interpolate_limit(hours.join(gaps, "time", "left"), "temperature_c")
    return rounded(out.select("time", "temperature_c"), "temperature_c")


@add("dedupe_hour", sql="""SELECT time, event_id, value FROM (SELECT date_trunc('hour', ts) AS time, event_id, value,
    row_number() OVER (PARTITION BY date_trunc('hour', ts) ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def dedupe_hour(spark, sf):
    rows = v.table(spark, sf, "events").select(cal.hour_floor(F.col("ts")).alias("time"), "ts", "event_id", "value")
    return grid.dedupe_hour(rows, "time", ["ts", "event_id"]).select("time", "event_id", "value")


@add("table_invariants", "zone_hour departures", """
    SELECT 'duplicate_keys' AS check_name, count(*) AS value, count(*) = 0 AS passed FROM (SELECT zone, time FROM zone_hour GROUP BY 1, 2 HAVING count(*) > 1)
    UNION ALL SELECT 'rows_with_null', count(*), count(*) = 0 FROM zone_hour WHERE trips IS NULL OR members IS NULL OR electric IS NULL
    UNION ALL SELECT 'trips_lost', CAST((SELECT sum(trips) FROM zone_hour) - (SELECT count(*) FROM departures) AS BIGINT), (SELECT sum(trips) FROM zone_hour) = (SELECT count(*) FROM departures)
    UNION ALL SELECT 'negative_counts', count(*), count(*) = 0 FROM zone_hour WHERE trips < 0""")
def table_invariants(spark, sf):
    expected = demand.zoned_departures(spark, sf).agg(F.count(F.lit(1)).alias("n")).scalar()
    return grid.table_checks(demand.zone_hour(spark, sf), expected)


@add("lag_features", "zone_hour", """SELECT zone, time, trips, CAST(lag(trips, 24) OVER w AS DOUBLE) AS lag_24, CAST(lag(trips, 168) OVER w AS DOUBLE) AS lag_168 FROM zone_hour
    WINDOW w AS (PARTITION BY zone ORDER BY time)""")
def lag_features(spark, sf):
    table = demand.zone_hour(spark, sf).select("zone", "time", "trips")
    out = grid.lags(table, "trips", {"lag_24": 24, "lag_168": 168})
    return out.withColumns({c: F.col(c).cast("double") for c in ("lag_24", "lag_168")})


EXACT_MEAN = "CAST(sum(CAST(floor(duration_minutes * 1000000 + 0.5) AS BIGINT)) AS DOUBLE) / count(*) / 1000000.0::DOUBLE"


def _past(keys: str) -> str:
    part = f"PARTITION BY {keys} " if keys else ""
    return f"({part}ORDER BY {', '.join(v.TRIP_ORDER)} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


@add("expanding_history", "trips_li", f"""
    WITH p AS (SELECT *, coalesce(CAST(sum(dm) OVER {_past('')} AS DOUBLE) / count(*) OVER {_past('')}, 10.0) AS prior,
        CAST(coalesce(sum(dm) OVER {_past('start_station_id, end_station_id')}, 0) AS DOUBLE) AS rs, count(*) OVER {_past('start_station_id, end_station_id')} AS rc,
        CAST(coalesce(sum(dm) OVER {_past('start_station_id')}, 0) AS DOUBLE) AS ss, count(*) OVER {_past('start_station_id')} AS sc,
        CAST(coalesce(sum(dm) OVER {_past('end_station_id')}, 0) AS DOUBLE) AS es, count(*) OVER {_past('end_station_id')} AS ec FROM (SELECT *, CAST(duration_minutes AS DECIMAL(18, 6)) AS dm FROM trips_li))
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {r6("(rs + 20.0 * prior) / (rc + 20.0)")} AS route_typical_minutes, {r6("ln(1.0 + rc)")} AS route_history_log_count,
        {r6("(ss + 20.0 * prior) / (sc + 20.0)")} AS start_typical_minutes, {r6("(es + 20.0 * prior) / (ec + 20.0)")} AS end_typical_minutes FROM p""")
def expanding_history(spark, sf):
    trips = v.trips_li(spark, sf).select(*v.TRIP_ORDER, "start_station_id", "end_station_id", "duration_minutes")
    out = history.expanding_history(trips, "duration_minutes", v.TRIP_ORDER)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                      *[rnd(c).alias(c) for c in ("route_typical_minutes", "route_history_log_count", "start_typical_minutes", "end_typical_minutes")])


@add("fit_history", "trips_li", f"""
    SELECT 'route' AS level, start_station_id || ' > ' || end_station_id AS key, {r6(EXACT_MEAN)} AS mean, count(*) AS n FROM trips_li GROUP BY 2
    UNION ALL SELECT 'start', start_station_id, {r6(EXACT_MEAN)}, count(*) FROM trips_li GROUP BY 2
    UNION ALL SELECT 'end', end_station_id, {r6(EXACT_MEAN)}, count(*) FROM trips_li GROUP BY 2
    UNION ALL SELECT 'global', '', {r6(EXACT_MEAN)}, 0 FROM trips_li""")
def fit_history(spark, sf):
    fitted = history.fit_history(v.trips_li(spark, sf), "duration_minutes")
    out = None
    for level, keys in history.KEYS.items():
        part = fitted[level].select(F.lit(level).alias("level"), F.concat_ws(" > ", *keys).alias("key"), rnd(f"_{level}_mean").alias("mean"), F.col(f"_{level}_n").alias("n"))
        out = part if out is None else out.unionByName(part)
    whole = fitted["global"].select(F.lit("global").alias("level"), F.lit("").alias("key"), rnd("_mean").alias("mean"), F.lit(0).cast("long").alias("n"))
    return out.unionByName(whole)


@add("apply_history", "trips_li", f"""
    WITH a AS (SELECT * FROM trips_li WHERE year(started_at) < 2000), b AS (SELECT * FROM trips_li WHERE year(started_at) >= 2000),
    g AS (SELECT {EXACT_MEAN} AS m FROM a),
    r AS (SELECT start_station_id, end_station_id, {EXACT_MEAN} AS m, count(*) AS n FROM a GROUP BY 1, 2),
    s AS (SELECT start_station_id, {EXACT_MEAN} AS m, count(*) AS n FROM a GROUP BY 1), e AS (SELECT end_station_id, {EXACT_MEAN} AS m, count(*) AS n FROM a GROUP BY 1)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {r6("(coalesce(r.m, g.m) * coalesce(r.n, 0) + 20.0 * g.m) / (coalesce(r.n, 0) + 20.0)")} AS route_typical_minutes,
        {r6("ln(1.0 + coalesce(r.n, 0))")} AS route_history_log_count, {r6("(coalesce(s.m, g.m) * coalesce(s.n, 0) + 20.0 * g.m) / (coalesce(s.n, 0) + 20.0)")} AS start_typical_minutes,
        {r6("(coalesce(e.m, g.m) * coalesce(e.n, 0) + 20.0 * g.m) / (coalesce(e.n, 0) + 20.0)")} AS end_typical_minutes
    FROM b CROSS JOIN g LEFT JOIN r USING (start_station_id, end_station_id) LEFT JOIN s USING (start_station_id) LEFT JOIN e USING (end_station_id)""")
def apply_history(spark, sf):
    trips = v.trips_li(spark, sf)
    fitted = history.fit_history(trips.where(F.year("started_at") < 2000), "duration_minutes")
    out = history.apply_history(trips.where(F.year("started_at") >= 2000), fitted)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                      *[rnd(c).alias(c) for c in ("route_typical_minutes", "route_history_log_count", "start_typical_minutes", "end_typical_minutes")])


@add("centered_rolling_median", "orders_day", f"""WITH {DAYS},
    m AS (SELECT day, trips, count(*) OVER w AS n, median(trips) OVER w AS med FROM d WINDOW w AS (ORDER BY day ROWS BETWEEN 14 PRECEDING AND 14 FOLLOWING))
    SELECT day, trips, CASE WHEN n >= 10 THEN med END AS median_around, {r6("trips / CASE WHEN n >= 10 THEN med END")} AS ratio,
        coalesce(trips / CASE WHEN n >= 10 THEN med END < 0.25, false) AS suspicious FROM m""")
def centered_rolling_median(spark, sf):
    out = grid.centered_median(dense_days(spark, sf), "trips")
    return rounded(out.withColumn("suspicious", F.coalesce(F.col("ratio") < 0.25, F.lit(False))), "ratio")


@add("rolling_mean", "orders_day", f"""WITH {DAYS} SELECT day, trips,
    {r6("CASE WHEN count(*) OVER a = 7 THEN avg(trips) OVER a END")} AS mean_7, {r6("CASE WHEN count(*) OVER b = 30 THEN avg(trips) OVER b END")} AS mean_30
    FROM d WINDOW a AS (ORDER BY day ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING), b AS (ORDER BY day ROWS BETWEEN 15 PRECEDING AND 14 FOLLOWING)""")
def rolling_mean(spark, sf):
    out = grid.centered_mean(dense_days(spark, sf), "trips", 3, 3, "mean_7")
    return rounded(grid.centered_mean(out, "trips", 15, 14, "mean_30"), "mean_7", "mean_30")


@add("year_over_year", "orders_day", f"""WITH m AS (SELECT date_trunc('month', day)::TIMESTAMP AS month, CAST(sum(trips) AS BIGINT) AS trips FROM orders_day GROUP BY 1)
    SELECT a.month, a.trips, {r6("a.trips * 100.0 / b.trips")} AS pct_of_last_year FROM m a LEFT JOIN m b ON b.month = a.month - INTERVAL 12 MONTH""")
def year_over_year(spark, sf):
    monthly = v.orders_day(spark, sf).groupBy(cal.month_floor(F.col("day")).alias("month")).agg(F.sum("trips").alias("trips"))
    return rounded(grid.year_over_year(monthly, "trips"), "pct_of_last_year")


@add("group_rank_zone", "stations", f"""
    WITH s AS (SELECT st.*, s_suppkey % 7 AS raw_zone, c.trips FROM stations st JOIN (SELECT l_suppkey, count(*) AS trips FROM lineitem GROUP BY 1) c ON c.l_suppkey = st.s_suppkey),
    z AS (SELECT raw_zone, max_by(name, {{'t': trips, 'i': start_station_id}}) FILTER (WHERE name IS NOT NULL) AS name, count(*) AS n_stations, CAST(sum(trips) AS BIGINT) AS trips,
        {r6("avg(lat)")} AS lat, {r6("avg(lng)")} AS lng FROM s GROUP BY 1)
    SELECT CAST(row_number() OVER (ORDER BY trips DESC, raw_zone) - 1 AS INTEGER) AS zone, raw_zone, 'around ' || name AS name, n_stations, trips, lat, lng FROM z""")
def group_rank_zone(spark, sf):
    counts = v.table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count(F.lit(1)).alias("trips"))
    rows = v.stations(spark, sf).join(counts, "s_suppkey").withColumn("raw_zone", F.col("s_suppkey") % 7)
    return rounded(grid.rank_zones(rows), "lat", "lng").withColumn("name", F.concat(F.lit("around "), "name"))


@add("value_ranks_avg", "trips_li", """SELECT duration_minutes, count(*) AS n, min(rk) + (count(*) - 1) / 2.0::DOUBLE AS avg_rank
    FROM (SELECT duration_minutes, rank() OVER (ORDER BY duration_minutes) AS rk FROM trips_li) GROUP BY 1""")
def value_ranks_avg(spark, sf):
    return average_ranks(v.trips_li(spark, sf), [], "duration_minutes").select("duration_minutes", "n", "avg_rank")


@add("row_hash_duplicates", sql="""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
    QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1""")
def row_hash_duplicates(spark, sf):
    """All copies. Copies are counted by combined partial counts and found again by a salted semi join,
    so a huge group of copies is never in one task."""
    rows = v.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    keys = ["l_orderkey", "l_linenumber"]
    repeated = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return joins.salted_semi(rows, repeated, keys)
