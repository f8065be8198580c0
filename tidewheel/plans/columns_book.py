"""Projections, typing, filters and feature expressions."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tidewheel.functions import calendar as cal
from tidewheel.functions import features, geo, text
from tidewheel.operators import clean
from tidewheel.operators.order import exact_quantiles
from tidewheel.plans import views as v
from tidewheel.plans.views import Book, r6, rnd, rounded

BOOK = Book()
add = BOOK.add



@add("canonical_columns", sql="""
    SELECT CAST(NULL AS VARCHAR) AS ride_id, o_orderdate AS started_at, CAST(o_custkey AS VARCHAR) AS start_station_id,
           o_orderpriority AS member_casual, CAST(NULL AS VARCHAR) AS rideable_type FROM orders""")
def canonical_columns(spark, sf):
    old = v.table(spark, sf, "orders").select(
        F.col("o_orderdate").alias(" Start Time"), F.col("o_orderkey").alias("Trip Duration"),
        F.col("o_orderpriority").alias("User-Type"), F.col("o_custkey").cast("string").alias("start station id"))
    return text.canonical_columns(old, ["ride_id", "started_at", "start_station_id", "member_casual", "rideable_type"])


@add("require_columns", "trips_ev", "SELECT ride_id, started_at, start_lat, start_lng, member_casual FROM trips_ev")
def require_columns(spark, sf):
    need = ["ride_id", "started_at", "start_lat", "start_lng", "member_casual"]
    return text.require_columns(v.trips_ev(spark, sf), need).select(*need)


def dated_text(spark, sf):
    """Order dates written in three notations, with unreadable values in two sources."""
    return v.table(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_custkey % 5 as source",
        "cast(o_orderdate as timestamp_ntz) + make_dt_interval(0, 0, 0, cast(o_orderkey * 61 % 86400 as decimal(18))) as ts",
    ).select(
        "o_orderkey", "source",
        F.expr("""case when source = 3 and o_orderkey % 10 = 0 then 'n/a'
                       when source = 4 and o_orderkey % 10 < 4 then date_format(ts, 'M/d/yyyy H:mm:ss')
                       when source in (0, 3, 4) then date_format(ts, 'yyyy-MM-dd HH:mm:ss')
                       when source = 1 then date_format(ts, 'M/d/yyyy H:mm:ss')
                       else date_format(ts, 'M/d/yyyy H:mm') end""").alias("started_at"))


DATED = """
    raw AS (SELECT o_orderkey, o_custkey % 5 AS source, o_orderdate + to_seconds(o_orderkey * 61 % 86400) AS ts FROM orders),
    dated AS (SELECT o_orderkey, source,
        CASE WHEN source = 3 AND o_orderkey % 10 = 0 THEN 'n/a'
             WHEN source = 4 AND o_orderkey % 10 < 4 THEN strftime(ts, '%-m/%-d/%Y %-H:%M:%S')
             WHEN source IN (0, 3, 4) THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
             WHEN source = 1 THEN strftime(ts, '%-m/%-d/%Y %-H:%M:%S')
             ELSE strftime(ts, '%-m/%-d/%Y %-H:%M') END AS started_at FROM raw),
    parsed AS (SELECT *, try_strptime(started_at, '%Y-%m-%d %H:%M:%S') AS t0,
        try_strptime(started_at, '%m/%d/%Y %H:%M:%S') AS t1, try_strptime(started_at, '%m/%d/%Y %H:%M') AS t2 FROM dated)"""


@add("parse_timestamp_multi", sql=f"""WITH {DATED},
    stats AS (SELECT source, count(started_at) n, count(t0) c0, count(t1) c1, count(t2) c2 FROM parsed GROUP BY 1),
    pick AS (SELECT source, CASE WHEN c0 >= 0.99 * n THEN 0 WHEN c1 >= 0.99 * n THEN 1 WHEN c2 >= 0.99 * n THEN 2
        WHEN c0 >= c1 AND c0 >= c2 THEN 0 WHEN c1 >= c2 THEN 1 ELSE 2 END AS notation FROM stats)
    SELECT o_orderkey, CAST(notation AS INTEGER) AS notation,
           CASE notation WHEN 0 THEN t0 WHEN 1 THEN t1 ELSE t2 END AS started_at_ts
    FROM parsed JOIN pick USING (source)""")
def parse_timestamp_multi(spark, sf):
    return clean.parse_timestamp_multi(dated_text(spark, sf), "source", "started_at").select(
        "o_orderkey", "notation", "started_at_ts")


@add("parse_timestamp_rowwise", sql=f"WITH {DATED} SELECT o_orderkey, coalesce(t0, t1, t2) AS started_at FROM parsed")
def parse_timestamp_rowwise(spark, sf):
    return dated_text(spark, sf).select("o_orderkey", text.parse_rowwise(F.col("started_at")).alias("started_at"))


@add("coerce_numeric", sql="""SELECT event_id, TRY_CAST(CASE WHEN event_id % 9 = 0 THEN 'x' || value ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS number
    FROM events""")
def coerce_numeric(spark, sf):
    raw = v.table(spark, sf, "events").select(
        "event_id", F.expr("case when event_id % 9 = 0 then concat('x', value) else cast(value as string) end").alias("t"))
    return raw.select("event_id", text.to_number(F.col("t")).alias("number"))


@add("duration_minutes", "trips_ev", f"""SELECT ride_id, {r6("epoch_us(ended_at) / 60000000.0 - epoch_us(started_at) / 60000000.0")} AS minutes
    FROM trips_ev""".replace("epoch_us(ended_at) / 60000000.0 - epoch_us(started_at) / 60000000.0",
                             "CAST(epoch_us(ended_at) - epoch_us(started_at) AS DOUBLE) / 60000000.0"))
def duration_minutes(spark, sf):
    return v.trips_ev(spark, sf).select(
        "ride_id", rnd(features.minutes_between(F.col("started_at"), F.col("ended_at"))).alias("minutes"))


@add("map_values", sql="""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'member' WHEN c_custkey % 3 = 1 THEN 'casual'
    ELSE lower(trim(c_mktsegment)) END AS rider FROM customer""")
def map_values(spark, sf):
    raw = F.expr("case c_custkey % 3 when 0 then ' Subscriber' when 1 then 'CUSTOMER ' else c_mktsegment end")
    return v.table(spark, sf, "customer").select("c_custkey", text.map_words(raw).alias("rider"))


@add("default_column", "cases", "SELECT l_orderkey, l_linenumber, l_partkey, coalesce(kind, 'unknown') AS kind FROM cases")
def default_column(spark, sf):
    return v.cases(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", F.coalesce("kind", F.lit("unknown")).alias("kind"))


@add("normalize_station_id", "raw_ids", """
    SELECT l_orderkey, l_linenumber, station_id, CASE
        WHEN started_at >= TIMESTAMP '2021-02-01' AND regexp_full_match(station_id, '[0-9]+[.][0-9]') THEN station_id || '0'
        WHEN started_at < TIMESTAMP '2021-02-01' AND regexp_full_match(station_id, '[0-9]+[.]0+') THEN regexp_replace(station_id, '[.]0+$', '')
        ELSE station_id END AS fixed FROM raw_ids""")
def normalize_station_id(spark, sf):
    return v.raw_ids(spark, sf).select("l_orderkey", "l_linenumber", "station_id", text.normalize_station_id(
        F.col("station_id"), F.col("started_at")).alias("fixed"))


@add("id_scheme", "raw_ids", """SELECT CASE WHEN regexp_full_match(station_id, '[0-9]+') THEN 'integer'
    WHEN regexp_full_match(station_id, '[0-9]+[.][0-9]+') THEN 'dotted' ELSE 'text' END AS scheme,
    CAST(year(started_at) AS INTEGER) AS year, count(*) AS trips FROM raw_ids GROUP BY 1, 2""")
def id_scheme(spark, sf):
    return v.raw_ids(spark, sf).groupBy(
        text.id_scheme(F.col("station_id")).alias("scheme"), F.year("started_at").alias("year")).agg(F.count(F.lit(1)).alias("trips"))


@add("location_key", "stations", """SELECT start_station_id, CAST(CAST(round(lat * 10000) AS BIGINT) AS VARCHAR) || ','
    || CAST(CAST(round(lng * 10000) AS BIGINT) AS VARCHAR) AS location FROM stations""")
def location_key(spark, sf):
    return v.stations(spark, sf).select("start_station_id", geo.location_key(F.col("lat"), F.col("lng")).alias("location"))


@add("decode_labels", "cases", """SELECT CASE class WHEN 'e' THEN 'edible' ELSE 'poisonous' END AS class,
    CASE season WHEN 's' THEN 'spring' WHEN 'u' THEN 'summer' WHEN 'a' THEN 'autumn' ELSE 'winter' END AS season,
    count(*) AS n FROM cases GROUP BY 1, 2""")
def decode_labels(spark, sf):
    return v.cases(spark, sf).groupBy(
        clean.decode(F.col("class"), clean.LABELS["class"]).alias("class"),
        clean.decode(F.col("season"), clean.LABELS["season"]).alias("season")).agg(F.count(F.lit(1)).alias("n"))


@add("normalize_request_fields", sql="""
    SELECT p_partkey AS case_id,
           CASE WHEN p_partkey % 6 IN (0, 1) THEN NULL ELSE CAST(p_size AS DOUBLE) END AS cap_diameter,
           CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_retailprice END AS stem_height,
           CASE p_partkey % 4 WHEN 0 THEN 'w' WHEN 1 THEN 'w' WHEN 2 THEN NULL ELSE 'n' END AS gill_color,
           CASE p_partkey % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'u' ELSE NULL END AS season,
           concat_ws(',', CASE WHEN p_partkey % 6 = 0 THEN 'cap_diameter' END,
                     CASE WHEN p_partkey % 3 = 2 THEN 'season' END) AS errors FROM part""")
def normalize_request_fields(spark, sf):
    raw = v.table(spark, sf, "part").selectExpr("p_partkey as case_id", """explode(array(
        named_struct('field', 'cap-diameter', 'value', case p_partkey % 6 when 0 then 'big' when 1 then '?' else cast(p_size as string) end),
        named_struct('field', 'Stem Height_cm', 'value', case p_partkey % 5 when 0 then '' else cast(p_retailprice as string) end),
        named_struct('field', 'gill_color', 'value', case p_partkey % 4 when 0 then 'w' when 1 then ' White' when 2 then 'unknown' else 'brown' end),
        named_struct('field', 'SEASON', 'value', case p_partkey % 3 when 0 then 'autumn' when 1 then 'u' else 'x9' end),
        named_struct('field', 'shoe size', 'value', '44'))) as f""").select("case_id", "f.field", "f.value")
    return clean.normalize_requests(raw, ["cap_diameter", "stem_height"], ["gill_color", "season"])


@add("validate_ranges", "trips_ev", """SELECT ride_id, concat_ws(';',
    CASE WHEN start_station_id IS NULL THEN 'start_station_id' END,
    CASE WHEN NOT (start_lat BETWEEN 40.4 AND 41.1) THEN 'start_lat' END,
    CASE WHEN NOT (start_lng BETWEEN -74.4 AND -73.5) THEN 'start_lng' END,
    CASE WHEN NOT (end_lat BETWEEN 40.4 AND 41.1) THEN 'end_lat' END,
    CASE WHEN NOT (end_lng BETWEEN -74.4 AND -73.5) THEN 'end_lng' END) AS reasons,
    start_station_id IS NOT NULL AND start_lat BETWEEN 40.4 AND 41.1 AND start_lng BETWEEN -74.4 AND -73.5
    AND end_lat BETWEEN 40.4 AND 41.1 AND end_lng BETWEEN -74.4 AND -73.5 AS accepted FROM trips_ev""")
def validate_ranges(spark, sf):
    out = v.trips_ev(spark, sf).select("ride_id", clean.reasons(clean.request_checks()).alias("reasons"))
    return out.withColumn("accepted", F.col("reasons") == "")


@add("fillna_constant", "cases", """SELECT l_orderkey, l_linenumber, l_partkey, coalesce(kind, 'unknown') AS kind,
    CASE WHEN width = 1 THEN coalesce(size, 0.0) ELSE size END AS size FROM cases""")
def fillna_constant(spark, sf):
    """Constant fill, and a conditional fill where another column says the part is absent."""
    return v.cases(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "kind", "size", "width").fillna(
        {"kind": "unknown"}).select("l_orderkey", "l_linenumber", "l_partkey", "kind",
                                    F.when(F.col("width") == 1, F.coalesce("size", F.lit(0.0))).otherwise(F.col("size")).alias("size"))


@add("ordered_category", "trips_li", """SELECT CAST(isodow(started_at) - 1 AS INTEGER) AS weekday_rank,
    CASE isodow(started_at) WHEN 1 THEN 'Monday' WHEN 2 THEN 'Tuesday' WHEN 3 THEN 'Wednesday' WHEN 4 THEN 'Thursday'
        WHEN 5 THEN 'Friday' WHEN 6 THEN 'Saturday' ELSE 'Sunday' END AS weekday, count(*) AS trips
    FROM trips_li GROUP BY 1, 2""")
def ordered_category(spark, sf):
    ts = F.col("started_at")
    return v.trips_li(spark, sf).groupBy(cal.weekday(ts).alias("weekday_rank")).agg(F.count(F.lit(1)).alias("trips")).withColumn(
        "weekday", F.element_at(F.array(*[F.lit(d) for d in features.WEEKDAYS]), F.col("weekday_rank") + 1)).orderBy("weekday_rank")


@add("bin_numeric", "trips_li", """SELECT CASE WHEN duration_minutes > 0 AND duration_minutes <= 30 THEN '0-30'
    WHEN duration_minutes > 30 AND duration_minutes <= 90 THEN '30-90' WHEN duration_minutes > 90 AND duration_minutes <= 180 THEN '90-180'
    WHEN duration_minutes > 180 THEN 'over 180' END AS right_closed,
    CASE WHEN l_quantity >= 0 AND l_quantity < 10 THEN 'low' WHEN l_quantity >= 10 AND l_quantity < 30 THEN 'mid'
    WHEN l_quantity >= 30 THEN 'high' END AS left_closed, count(*) AS trips FROM trips_li GROUP BY 1, 2""")
def bin_numeric(spark, sf):
    inf = float("inf")
    return v.trips_li(spark, sf).groupBy(
        text.bands(F.col("duration_minutes"), [0, 30, 90, 180, inf], ["0-30", "30-90", "90-180", "over 180"]).alias("right_closed"),
        text.bands(F.col("l_quantity"), [0, 10, 30, inf], ["low", "mid", "high"], right_closed=False).alias("left_closed"),
    ).agg(F.count(F.lit(1)).alias("trips"))


# --- filters -----------------------------------------------------------------------------------

CLEAN = """duration_minutes BETWEEN 1 AND 180 AND start_lat BETWEEN 40.4 AND 41.1 AND start_lng BETWEEN -74.4 AND -73.5
    AND member_casual IN ('member', 'casual') AND started_at IS NOT NULL AND start_station_id IS NOT NULL"""


@add("clean_trips", "trips_ev", f"SELECT ride_id, started_at, duration_minutes FROM trips_ev WHERE {CLEAN}")
def clean_trips(spark, sf):
    return clean.clean_trips(v.trips_ev(spark, sf)).select("ride_id", "started_at", "duration_minutes")


@add("departure_filter", "departures", "SELECT ride_id, started_at, start_station_id FROM departures")
def departure_filter(spark, sf):
    return clean.departures(v.trips_ev(spark, sf)).select("ride_id", "started_at", "start_station_id")


@add("geo_bbox", "trips_ev", """SELECT start_lat BETWEEN 40.4 AND 41.1 AND start_lng BETWEEN -74.4 AND -73.5 AS in_area,
    start_lat BETWEEN -90 AND 90 AND start_lng BETWEEN -180 AND 180 AS in_world, count(*) AS trips FROM trips_ev GROUP BY 1, 2""")
def geo_bbox(spark, sf):
    lat, lng = F.col("start_lat"), F.col("start_lng")
    return v.trips_ev(spark, sf).groupBy(geo.in_box(lat, lng).alias("in_area"), geo.in_world(lat, lng).alias("in_world")).agg(
        F.count(F.lit(1)).alias("trips"))


@add("station_public_filter", "stations", """SELECT *, reason = '' AS keep FROM (SELECT start_station_id, name, CASE
    WHEN regexp_matches(start_station_id, '^(JC|HB)') THEN 'other system'
    WHEN regexp_matches(start_station_id, '(?i)^SYS') THEN 'not public'
    WHEN regexp_matches(coalesce(name, ''), '(?i)depot|loading dock|warehouse|\\blab\\b|\\bshop\\b|mechanic|nycbs') THEN 'not public'
    ELSE '' END AS reason FROM stations)""")
def station_public_filter(spark, sf):
    return clean.public_stations(v.stations(spark, sf)).select("start_station_id", "name", "reason", "keep")


@add("completeness_filter", "cases", """SELECT class, count(*) AS n_rows, CAST(count(*) FILTER (WHERE kind IS NULL OR size IS NULL OR noise_1 IS NULL) AS BIGINT) AS any_missing,
    CAST(count(*) FILTER (WHERE kind IS NOT NULL AND size IS NOT NULL) AS BIGINT) AS complete FROM cases GROUP BY 1""")
def completeness_filter(spark, sf):
    gap = F.greatest(*[F.col(c).isNull() for c in ("kind", "size", "noise_1")])
    return v.cases(spark, sf).groupBy("class").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(gap).alias("any_missing"),
        F.count_if(F.col("kind").isNotNull() & F.col("size").isNotNull()).alias("complete"))


@add("min_group_filter", "trips_li", f"""SELECT start_station_id, member_casual, count(*) AS trips, {r6("avg(duration_minutes)")} AS mean_minutes
    FROM trips_li GROUP BY 1, 2 HAVING count(*) >= 200""")
def min_group_filter(spark, sf):
    out = v.trips_li(spark, sf).groupBy("start_station_id", "member_casual").agg(
        F.count(F.lit(1)).alias("trips"), F.avg("duration_minutes").alias("mean_minutes")).where("trips >= 200")
    return rounded(out, "mean_minutes")


# --- scalar features ---------------------------------------------------------------------------

HALF_LAT = "sin((radians(end_lat) - radians(start_lat)) / 2)"
HALF_LNG = "sin((radians(end_lng) - radians(start_lng)) / 2)"
HAVERSINE = f"""6371.0088 * 2 * asin(sqrt(least(1.0, greatest(0.0, {HALF_LAT} * {HALF_LAT}
    + cos(radians(start_lat)) * cos(radians(end_lat)) * {HALF_LNG} * {HALF_LNG}))))"""
NORTH, EAST = "((end_lat - start_lat) * 111.0)", "((end_lng - start_lng) * 84.0)"
GRID = f"""abs({EAST} * cos(radians(29.0)) + {NORTH} * sin(radians(29.0))) + abs({NORTH} * cos(radians(29.0)) - {EAST} * sin(radians(29.0)))"""
CLOCK = "(hour(started_at) + minute(started_at) / 60.0)"
CYCLIC = {
    "start_hour": f"2 * pi() * {CLOCK} / 24", "weekday": "2 * pi() * (isodow(started_at) - 1) / 7",
    "month": "2 * pi() * (month(started_at) - 1) / 12",
}
CYCLIC_SQL = ", ".join(f"{r6(f'{f}({angle})')} AS {name}_{f}" for name, angle in CYCLIC.items() for f in ("sin", "cos"))
PATH = ["start_lat", "start_lng", "end_lat", "end_lng"]
EXACT_MEAN = "CAST(sum(CAST(floor(duration_minutes * 1000000 + 0.5) AS BIGINT)) AS DOUBLE) / count(*) / 1000000.0::DOUBLE"
LI_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@add("cyclic_time", "trips_ev", f"SELECT ride_id, {CYCLIC_SQL} FROM trips_ev")
def cyclic_time(spark, sf):
    parts = cal.cyclic_time(F.col("started_at"))
    return v.trips_ev(spark, sf).select("ride_id", *[rnd(c).alias(n) for n, c in parts.items()])


@add("calendar_parts", "trips_li", """SELECT CAST(hour(started_at) AS INTEGER) AS hour, CAST(isodow(started_at) - 1 AS INTEGER) AS weekday,
    CAST(month(started_at) AS INTEGER) AS month, CAST(year(started_at) AS INTEGER) AS year,
    CAST(isodow(started_at) >= 6 AS INTEGER) AS is_weekend, count(*) AS trips FROM trips_li GROUP BY 1, 2, 3, 4, 5""")
def calendar_parts(spark, sf):
    ts = F.col("started_at")
    return v.trips_li(spark, sf).groupBy(
        F.hour(ts).alias("hour"), cal.weekday(ts).alias("weekday"), F.month(ts).alias("month"), F.year(ts).alias("year"),
        cal.is_weekend(ts).alias("is_weekend")).agg(F.count(F.lit(1)).alias("trips"))


@add("us_federal_holidays", "orders_day holidays", """SELECT o.day, CAST(h.day IS NOT NULL AS INTEGER) AS is_holiday, o.trips
    FROM orders_day o LEFT JOIN holidays h ON h.day = CAST(o.day AS DATE)""")
def us_federal_holidays(spark, sf):
    return v.orders_day(spark, sf).select("day", cal.is_federal_holiday(F.col("day")).alias("is_holiday"), "trips")


@add("special_days", "orders_day holidays", """SELECT o.day, o.trips FROM orders_day o
    WHERE CAST(o.day AS DATE) IN (SELECT day FROM holidays) OR CAST(o.day AS DATE) IN (SELECT day + 1 FROM holidays WHERE month(day) = 11 AND isodow(day) = 4 AND day(day) BETWEEN 22 AND 28)
       OR (month(o.day) = 12 AND day(o.day) >= 24) OR (month(o.day) = 1 AND day(o.day) = 1)""")
def special_days(spark, sf):
    return v.orders_day(spark, sf).where(cal.is_special_day(F.col("day")) == 1).select("day", "trips")


@add("haversine_km", "trips_ev", f"SELECT ride_id, {r6(HAVERSINE)} AS km FROM trips_ev")
def haversine_km(spark, sf):
    return v.trips_ev(spark, sf).select("ride_id", rnd(geo.haversine_km(*map(F.col, PATH))).alias("km"))


@add("grid_distance_km", "trips_ev", f"SELECT ride_id, {r6(GRID)} AS km FROM trips_ev")
def grid_distance_km(spark, sf):
    return v.trips_ev(spark, sf).select("ride_id", rnd(geo.grid_distance_km(*map(F.col, PATH))).alias("km"))


BEARING = f"atan2({EAST} + 0.0, {NORTH} + 0.0)"


@add("bearing", "trips_ev", f"SELECT ride_id, {r6(f'sin({BEARING})')} AS bearing_sin, {r6(f'cos({BEARING})')} AS bearing_cos FROM trips_ev")
def bearing(spark, sf):
    s, c = geo.bearing_parts(*map(F.col, PATH))
    return v.trips_ev(spark, sf).select("ride_id", rnd(s).alias("bearing_sin"), rnd(c).alias("bearing_cos"))


@add("degrees_to_km", "stations", f"SELECT start_station_id, {r6('lat * 111.0')} AS north_km, {r6('lng * (111.0 * cos(radians(40.73)))')} AS east_km FROM stations")
def degrees_to_km(spark, sf):
    north, east = geo.planar_km(F.col("lat"), F.col("lng"))
    return v.stations(spark, sf).select("start_station_id", rnd(north).alias("north_km"), rnd(east).alias("east_km"))


@add("duration_features", "trips_ev weather holidays", f"""
    WITH t AS (SELECT t.*, w.temperature_c, w.humidity_pct, w.precipitation_mm, w.wind_kmh, CAST(h.day IS NOT NULL AS INTEGER) AS is_holiday
        FROM trips_ev t LEFT JOIN weather w ON w.time = date_trunc('hour', t.started_at)
        LEFT JOIN holidays h ON h.day = CAST(t.started_at AS DATE)),
    g AS (SELECT {EXACT_MEAN} AS m FROM trips_ev),
    r AS (SELECT coalesce(start_station_id, 'unknown') AS s, end_station_id AS e, {EXACT_MEAN} AS m, count(*) AS n FROM trips_ev GROUP BY 1, 2),
    a AS (SELECT coalesce(start_station_id, 'unknown') AS s, {EXACT_MEAN} AS m, count(*) AS n FROM trips_ev GROUP BY 1),
    b AS (SELECT end_station_id AS e, {EXACT_MEAN} AS m, count(*) AS n FROM trips_ev GROUP BY 1)
    SELECT ride_id, rideable_type, member_casual, coalesce(start_station_id, 'unknown') AS start_station_id, end_station_id,
        {", ".join(f"{r6(c)} AS {c}" for c in PATH)}, {r6(HAVERSINE)} AS direct_distance_km, {r6(GRID)} AS grid_distance_km,
        {r6("end_lat - start_lat")} AS delta_lat, {r6("end_lng - start_lng")} AS delta_lng,
        {r6(f"sin({BEARING})")} AS bearing_sin, {r6(f"cos({BEARING})")} AS bearing_cos,
        {r6("(r.m * r.n + 20.0 * g.m) / (r.n + 20.0)")} AS route_typical_minutes, {r6("ln(1.0 + r.n)")} AS route_history_log_count,
        {r6("(a.m * a.n + 20.0 * g.m) / (a.n + 20.0)")} AS start_typical_minutes, {r6("(b.m * b.n + 20.0 * g.m) / (b.n + 20.0)")} AS end_typical_minutes,
        {CYCLIC_SQL}, CAST(isodow(started_at) >= 6 AS INTEGER) AS is_weekend, is_holiday,
        temperature_c AS temperature_2m, humidity_pct AS relative_humidity_2m, precipitation_mm AS precipitation, wind_kmh AS wind_speed_10m
    FROM t JOIN r ON r.s = coalesce(t.start_station_id, 'unknown') AND r.e = t.end_station_id
    JOIN a ON a.s = coalesce(t.start_station_id, 'unknown') JOIN b ON b.e = t.end_station_id CROSS JOIN g""")
def duration_features(spark, sf):
    from tidewheel.operators import history, joins

    trips = v.trips_ev(spark, sf)
    fitted = history.fit_history(trips, "duration_minutes")
    rows = joins.join_hourly(trips, features.duration_weather(v.weather(spark, sf)), "started_at", "time", features.WEATHER_DURATION)
    rows = history.apply_history(rows, fitted)
    out = features.duration_features(rows)
    text_cols = features.DURATION_CATEGORIES
    return out.select("ride_id", *[F.col(c) if c in text_cols or c in ("is_weekend", "is_holiday", *features.WEATHER_DURATION)
                                   else rnd(c).alias(c) for c in features.DURATION_FEATURES])


@add("demand_features", "zone_hour weather holidays", """
    SELECT z.zone, z.time, CAST(hour(z.time) AS INTEGER) AS hour, CAST(isodow(z.time) - 1 AS INTEGER) AS weekday,
        CAST(month(z.time) AS INTEGER) AS month, CAST(isodow(z.time) >= 6 AS INTEGER) AS is_weekend,
        CAST(h.day IS NOT NULL AS INTEGER) AS is_holiday, w.temperature_c, w.precipitation_mm, w.wind_kmh,
        CAST(year(z.time) AS INTEGER) AS year, a.active_stations, w.snow_depth_cm, z.trips
    FROM zone_hour z LEFT JOIN weather w ON w.time = z.time LEFT JOIN holidays h ON h.day = CAST(z.time AS DATE)
    JOIN (SELECT CAST(CAST(start_station_id AS INTEGER) % 10 AS INTEGER) AS zone, date_trunc('month', started_at) AS m,
                 count(DISTINCT start_station_id) AS active_stations FROM departures GROUP BY 1, 2) a
      ON a.zone = z.zone AND a.m = date_trunc('month', z.time)""")
def demand_features(spark, sf):
    from tidewheel.plans import demand

    table = demand.model_table(spark, sf)
    return features.demand_features(table).select("zone", "time", *features.DEMAND_FEATURES[1:], "trips")


@add("log_transform", "trips_li", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {r6("ln(1.0 + duration_minutes)")} AS log_minutes,
    {r6("exp(least(greatest(ln(1.0 + duration_minutes), 0.0), ln(181.0))) - 1.0")} AS back FROM trips_li""")
def log_transform(spark, sf):
    logged = F.log1p("duration_minutes")
    return v.trips_li(spark, sf).select(
        *LI_KEY, rnd(logged).alias("log_minutes"), rnd(features.inverse_log(logged)).alias("back"))


@add("slot_key", "zone_counts", """SELECT CAST(hour(time) + 24 * CAST(isodow(time) >= 6 AS INTEGER) AS INTEGER) AS slot,
    CAST(zone * 48 + hour(time) + 24 * CAST(isodow(time) >= 6 AS INTEGER) AS INTEGER) AS zone_slot, CAST(sum(trips) AS BIGINT) AS trips
    FROM zone_counts GROUP BY 1, 2""")
def slot_key(spark, sf):
    dep = clean.departures(v.trips_ev(spark, sf)).select(
        (F.col("start_station_id").cast("int") % 10).alias("zone"), cal.slot(F.col("started_at")).alias("slot"))
    return dep.groupBy("slot", (F.col("zone") * 48 + F.col("slot")).alias("zone_slot")).agg(F.count(F.lit(1)).alias("trips"))


@add("clip_values", "trips_li", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {r6("least(greatest(duration_minutes - 20.0, 0.0), 180.0)")} AS minutes,
    {r6("greatest(duration_minutes - 20.0, 0.000001)")} AS positive FROM trips_li""")
def clip_values(spark, sf):
    x = F.col("duration_minutes") - 20.0
    return v.trips_li(spark, sf).select(
        *LI_KEY, rnd(features.clip(x, 0.0, 180.0)).alias("minutes"), rnd(F.greatest(x, F.lit(1e-6))).alias("positive"))


IQR = """WITH long AS (SELECT 'height' AS feature, height AS value FROM cases UNION ALL SELECT 'size', size FROM cases
        UNION ALL SELECT 'width', width FROM cases),
    q AS (SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM long GROUP BY 1),
    b AS (SELECT feature, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM q)"""


def long_cases(spark, sf):
    return v.cases(spark, sf).select("size", "width", "height").unpivot([], ["size", "width", "height"], "feature", "value")


@add("iqr_bounds", "cases", f"""{IQR} SELECT feature, {r6("any_value(low)")} AS low, {r6("any_value(high)")} AS high,
    CAST(count(*) FILTER (WHERE value < low OR value > high) AS BIGINT) AS outliers,
    CAST(count(*) FILTER (WHERE value <= 0) AS BIGINT) AS not_positive FROM long JOIN b USING (feature) WHERE value IS NOT NULL GROUP BY 1""")
def iqr_bounds(spark, sf):
    rows = long_cases(spark, sf)
    bounds = features.iqr_bounds(exact_quantiles(rows, ["feature"], "value", {"q1": 0.25, "q3": 0.75}))
    # one row per column name: bounded by the width of the table
    out = rows.where("value is not null").join(F.broadcast(bounds), "feature").groupBy("feature").agg(
        F.max("low").alias("low"), F.max("high").alias("high"),
        F.count_if((F.col("value") < F.col("low")) | (F.col("value") > F.col("high"))).alias("outliers"),
        F.count_if(F.col("value") <= 0).alias("not_positive"))
    return rounded(out, "low", "high")


@add("iqr_clip", "cases", f"""{IQR} SELECT feature, value, count(*) AS n, {r6("least(greatest(value, any_value(low)), any_value(high))")} AS clipped
    FROM long JOIN b USING (feature) WHERE value IS NOT NULL GROUP BY 1, 2""")
def iqr_clip(spark, sf):
    rows = long_cases(spark, sf)
    bounds = features.iqr_bounds(exact_quantiles(rows, ["feature"], "value", {"q1": 0.25, "q3": 0.75}))
    out = rows.where("value is not null").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(bounds), "feature")
    return out.select("feature", "value", "n", rnd(features.clip(F.col("value"), F.col("low"), F.col("high"))).alias("clipped"))


@add("shape_features", "cases", f"""SELECT l_orderkey, l_linenumber, l_partkey, {r6("pi() * (width / 2) * (width / 2) * height")} AS stem_volume,
    {r6("height * width")} AS stem_product, {r6("size * size")} AS cap_sq, {r6("size * 10 / (width + 1)")} AS cap_stem_ratio,
    {r6("height * 10 / (width + 1)")} AS slenderness,
    CAST((size IS NULL)::INTEGER + (kind IS NULL)::INTEGER + (noise_1 IS NULL)::INTEGER AS INTEGER) AS n_missing FROM cases""")
def shape_features(spark, sf):
    out = features.shape_features(v.cases(spark, sf), cap="size", stem_width="width", stem_height="height", watched=["size", "kind", "noise_1"])
    return rounded(out.select("l_orderkey", "l_linenumber", "l_partkey", "stem_volume", "stem_product", "cap_sq", "cap_stem_ratio",
                              "slenderness", "n_missing"), "stem_volume", "stem_product", "cap_sq", "cap_stem_ratio", "slenderness")


@add("weather_scenario", "weather", """SELECT time, s.scenario,
    CASE s.scenario WHEN 'snow' THEN least(0.0, temperature_c) WHEN 'storm' THEN least(-2.0, temperature_c) ELSE temperature_c END AS temperature_c,
    CASE s.scenario WHEN 'dry' THEN 0.0 WHEN 'snow' THEN 0.0 WHEN 'rain' THEN greatest(2.0, precipitation_mm)
        WHEN 'heavy' THEN greatest(8.0, precipitation_mm) WHEN 'storm' THEN greatest(1.5, precipitation_mm) ELSE precipitation_mm END AS precipitation_mm,
    CASE s.scenario WHEN 'snow' THEN greatest(15.0, snow_depth_cm) WHEN 'storm' THEN greatest(25.0, snow_depth_cm) ELSE snow_depth_cm END AS snow_depth_cm
    FROM weather CROSS JOIN (VALUES ('actual'), ('dry'), ('rain'), ('heavy'), ('snow'), ('storm')) s(scenario)""")
def weather_scenario(spark, sf):
    return features.weather_scenarios(v.weather(spark, sf)).select(
        "time", "scenario", "temperature_c", "precipitation_mm", "snow_depth_cm")


@add("condition_flags", "weather", """SELECT CASE WHEN precipitation_mm = 0 THEN 'dry' WHEN precipitation_mm >= 0.5 THEN 'wet' ELSE 'drizzle' END AS wet,
    CAST(hour(time) BETWEEN 7 AND 9 AS INTEGER) AS morning, CASE WHEN isodow(time) >= 6 THEN 'weekend' ELSE 'weekday' END AS daytype,
    count(*) AS hours FROM weather GROUP BY 1, 2, 3""")
def condition_flags(spark, sf):
    ts = F.col("time")
    return v.weather(spark, sf).groupBy(
        features.wet_class(F.col("precipitation_mm")).alias("wet"), features.morning(ts).alias("morning"),
        features.daytype(ts).alias("daytype")).agg(F.count(F.lit(1)).alias("hours"))
