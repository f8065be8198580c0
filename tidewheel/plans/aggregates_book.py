"""Aggregations, audits and profiles."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from tidewheel.functions import calendar as cal
from tidewheel.functions import geo, text
from tidewheel.operators import aggregate, clean, grid
from tidewheel.operators.order import exact_quantiles
from tidewheel.plans import demand
from tidewheel.plans import views as v
from tidewheel.plans.views import Book, r6, rnd, rounded

BOOK = Book()
add = BOOK.add


def rows():
    return F.count(F.lit(1))


TOTALS = """count(*) AS trips, CAST(count(*) FILTER (WHERE member_casual = 'member') AS BIGINT) AS members,
    CAST(count(*) FILTER (WHERE rideable_type = 'electric_bike') AS BIGINT) AS electric"""


@add("station_hour_counts", "trips_li", f"""SELECT start_station_id, date_trunc('hour', started_at) AS time, {TOTALS} FROM trips_li GROUP BY 1, 2""")
def station_hour_counts(spark, sf):
    return grid.station_hour_counts(v.trips_li(spark, sf))


@add("partial_final_merge", "trips_li", """SELECT start_station_id, date_trunc('day', started_at)::TIMESTAMP AS day, count(*) AS trips,
    max(started_at) AS last_time, min(started_at) AS first_time FROM trips_li GROUP BY 1, 2""")
def partial_final_merge(spark, sf):
    """Partials per source, then one merge: sums add, bounds are bounds of bounds."""
    day = cal.day_floor(F.col("started_at"))
    parts = v.trips_li(spark, sf).groupBy("start_station_id", day.alias("day"), F.pmod("l_orderkey", F.lit(4)).alias("source")).agg(
        rows().alias("trips"), F.max("started_at").alias("last_time"), F.min("started_at").alias("first_time"))
    return parts.groupBy("start_station_id", "day").agg(
        F.sum("trips").alias("trips"), F.max("last_time").alias("last_time"), F.min("first_time").alias("first_time"))


NAMED = "CASE WHEN event_id % 5 = 0 THEN NULL ELSE concat('stop ', start_station_id, '/', CAST(event_id % 3 AS VARCHAR(9))) END"


@add("station_dimension", "departures", f"""WITH t AS (SELECT *, {NAMED.replace("VARCHAR(9)", "VARCHAR")} AS start_station_name, date_trunc('hour', started_at) AS time FROM departures)
    SELECT start_station_id, max_by(start_station_name, {{'t': time, 'n': start_station_name}}) FILTER (WHERE start_station_name IS NOT NULL) AS name,
        {r6("sum(start_lat) / count(*)")} AS lat, {r6("sum(start_lng) / count(*)")} AS lng, count(*) AS trips, min(time) AS first_time, max(time) AS last_time
    FROM t GROUP BY 1""")
def station_dimension(spark, sf):
    trips = clean.departures(v.trips_ev(spark, sf)).withColumn("start_station_name", F.expr(NAMED.replace("VARCHAR(9)", "STRING")))
    return rounded(grid.station_dimension(trips), "lat", "lng")


@add("departure_audit", "trips_ev", """
    WITH raw AS (SELECT CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 5000 AS VARCHAR) END AS ride_id,
            CASE WHEN event_id % 211 = 0 THEN NULL ELSE date_trunc('hour', started_at) END AS started_at,
            date_trunc('hour', started_at) + to_hours(CAST(event_id % 40 - 3 AS INTEGER)) AS ended_at,
            CASE WHEN event_id % 20 = 0 THEN start_station_id || '.1' ELSE start_station_id END AS raw_id, end_station_id, start_lat, start_lng FROM trips_ev),
    t AS (SELECT *, CASE WHEN regexp_full_match(raw_id, '[0-9]+[.][0-9]') AND coalesce(started_at >= TIMESTAMP '2021-02-01', true) THEN raw_id || '0' ELSE raw_id END AS start_station_id FROM raw)
    SELECT coalesce(strftime(started_at, '%Y-%m'), 'unknown') AS month, count(*) AS rows, count(*) - count(ride_id) AS missing_ride_id,
        count(*) - count(raw_id) AS missing_start_station_id, count(*) - count(started_at) AS no_start_time,
        count(*) - count(start_station_id) AS no_start_station,
        CAST(count(*) FILTER (WHERE started_at IS NOT NULL AND start_station_id IS NOT NULL AND NOT (start_lat BETWEEN 40.4 AND 41.1 AND start_lng BETWEEN -74.4 AND -73.5)) AS BIGINT) AS outside_area,
        CAST(count(*) FILTER (WHERE ended_at < started_at) AS BIGINT) AS duration_negative,
        CAST(count(*) FILTER (WHERE date_diff('hour', started_at, ended_at) > 24) AS BIGINT) AS duration_over_24h,
        CAST(count(*) FILTER (WHERE raw_id <> start_station_id) AS BIGINT) AS station_id_fixed,
        CAST(count(*) FILTER (WHERE started_at IS NOT NULL AND start_station_id IS NOT NULL AND start_lat BETWEEN 40.4 AND 41.1 AND start_lng BETWEEN -74.4 AND -73.5) AS BIGINT) AS departures,
        count(*) - count(DISTINCT [ride_id, CAST(started_at AS VARCHAR), CAST(ended_at AS VARCHAR), start_station_id, end_station_id]) AS duplicate_rows
    FROM t GROUP BY 1""")
def departure_audit(spark, sf):
    hour = cal.hour_floor(F.col("started_at"))
    raw = v.trips_ev(spark, sf).select(
        F.expr("case when event_id % 3 = 0 then null else cast(event_id % 5000 as string) end").alias("ride_id"),
        F.when(F.col("event_id") % 211 != 0, hour).alias("started_at"),
        F.timestamp_add("HOUR", (F.col("event_id") % 40 - 3).cast("int"), hour).alias("ended_at"),
        F.expr("case when event_id % 20 = 0 then concat(start_station_id, '.1') else start_station_id end").alias("raw_id"),
        "end_station_id", "start_lat", "start_lng")
    raw = raw.withColumn("start_station_id", text.normalize_station_id(F.col("raw_id"), F.col("started_at")))
    minutes = F.timestamp_diff("MINUTE", F.col("started_at"), F.col("ended_at"))
    out = clean.departure_audit(raw, F.coalesce(cal.year_month(F.col("started_at")), F.lit("unknown")), ["ride_id", "raw_id"], minutes,
                                F.col("raw_id") != F.col("start_station_id"))
    return out.withColumnRenamed("missing_raw_id", "missing_start_station_id")


@add("cleaning_audit", "trips_ev", """SELECT strftime(started_at, '%Y%m') AS source_month, count(*) AS input_rows,
    CAST(count(*) FILTER (WHERE duration_minutes BETWEEN 1 AND 180 AND start_lat BETWEEN 40.4 AND 41.1 AND start_lng BETWEEN -74.4 AND -73.5
        AND member_casual IN ('member', 'casual') AND start_station_id IS NOT NULL) AS BIGINT) AS output_rows,
    CAST(count(*) FILTER (WHERE NOT (duration_minutes BETWEEN 1 AND 180)) AS BIGINT) AS removed_invalid_duration,
    CAST(count(*) FILTER (WHERE NOT (start_lat BETWEEN 40.4 AND 41.1 AND start_lng BETWEEN -74.4 AND -73.5)) AS BIGINT) AS removed_invalid_geo,
    CAST(count(*) FILTER (WHERE NOT (member_casual IN ('member', 'casual'))) AS BIGINT) AS removed_invalid_user_type,
    CAST(count(*) FILTER (WHERE started_at IS NULL OR start_station_id IS NULL) AS BIGINT) AS removed_missing_start FROM trips_ev GROUP BY 1""")
def cleaning_audit(spark, sf):
    return clean.cleaning_audit(v.trips_ev(spark, sf), F.date_format("started_at", "yyyyMM"))


@add("duplicate_count", sql="""SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct, CAST(sum(n) - count(*) AS BIGINT) AS duplicates
    FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)""")
def duplicate_count(spark, sf):
    return aggregate.duplicate_count(v.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


PROFILED = {"brand": "string", "kind": "string", "size": "double", "width": "double", "noise_0": "string", "noise_1": "string", "class": "string"}


@add("data_profile", "cases", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS missing, count(DISTINCT {c}) AS n_distinct,
    '{t}' AS data_type, {r6(f"(count(*) - count({c})) * 100.0 / count(*)")} AS missing_pct FROM cases""" for c, t in PROFILED.items()))
def data_profile(spark, sf):
    return rounded(aggregate.profile(v.cases(spark, sf).select(*PROFILED)), "missing_pct")


PCT = {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99}


@add("describe_percentiles", "trips_li", f"""SELECT member_casual, count(*) AS n, {r6("avg(duration_minutes)")} AS mean, {r6("stddev_samp(duration_minutes)")} AS std,
    min(duration_minutes) AS low, max(duration_minutes) AS high, {", ".join(f"{r6(f'quantile_cont(duration_minutes, {p})', 9)} AS {n}" for n, p in PCT.items())}
    FROM trips_li GROUP BY 1""")
def describe_percentiles(spark, sf):
    trips = v.trips_li(spark, sf).select("member_casual", "duration_minutes")
    spots = exact_quantiles(trips, ["member_casual"], "duration_minutes", PCT)
    basics = trips.groupBy("member_casual").agg(
        rnd(F.avg("duration_minutes")).alias("mean"), rnd(F.stddev_samp("duration_minutes")).alias("std"),
        F.min("duration_minutes").alias("low"), F.max("duration_minutes").alias("high"))
    return rounded(spots, *PCT, digits=9).join(basics, "member_casual")


@add("grouped_volume_median", "trips_li", f"""SELECT CAST(hour(started_at) AS INTEGER) AS hour, member_casual, count(*) AS trips,
    {r6("median(duration_minutes)")} AS median_minutes, {r6("avg((rideable_type = 'electric_bike')::INTEGER)")} AS electric_share FROM trips_li GROUP BY 1, 2""")
def grouped_volume_median(spark, sf):
    trips = v.trips_li(spark, sf).select(F.hour("started_at").alias("hour"), "member_casual", "duration_minutes", "rideable_type")
    medians = exact_quantiles(trips, ["hour", "member_casual"], "duration_minutes", {"median_minutes": 0.5})
    share = trips.groupBy("hour", "member_casual").agg(rnd(F.avg((F.col("rideable_type") == "electric_bike").cast("int"))).alias("electric_share"))
    return rounded(medians, "median_minutes").withColumnRenamed("n", "trips").join(share, ["hour", "member_casual"])


@add("share_by_group", "trips_li", f"""SELECT CAST(year(started_at) AS INTEGER) AS year, member_casual, count(*) AS n,
    {r6("count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY year(started_at))")} AS share FROM trips_li GROUP BY year(started_at), member_casual""")
def share_by_group(spark, sf):
    trips = v.trips_li(spark, sf).select(F.year("started_at").alias("year"), "member_casual")
    return rounded(aggregate.shares(trips, ["year"], "member_casual"), "share")


@add("crosstab", "cases", """SELECT coalesce(kind, 'unknown') AS kind, CAST(count(*) FILTER (WHERE class = 'e') AS BIGINT) AS e,
    CAST(count(*) FILTER (WHERE class = 'p') AS BIGINT) AS p FROM cases GROUP BY 1""")
def crosstab(spark, sf):
    return v.cases(spark, sf).groupBy(F.coalesce("kind", F.lit("unknown")).alias("kind")).pivot("class", ["e", "p"]).count().fillna(0, ["e", "p"])


@add("profile_by_slot", "departures", f"""SELECT start_station_id, CAST(hour(started_at) + 24 * (isodow(started_at) >= 6)::INTEGER AS INTEGER) AS slot, count(*) AS n,
    {r6("count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY start_station_id)")} AS share
    FROM departures GROUP BY start_station_id, hour(started_at) + 24 * (isodow(started_at) >= 6)::INTEGER""")
def profile_by_slot(spark, sf):
    trips = clean.departures(v.trips_ev(spark, sf)).select("start_station_id", cal.slot(F.col("started_at")).alias("slot"))
    return rounded(aggregate.shares(trips, ["start_station_id"], "slot"), "share")


@add("active_locations", "trips_li", """SELECT CAST(l_suppkey % 10 AS INTEGER) AS zone, date_trunc('month', started_at)::TIMESTAMP AS month_start,
    count(DISTINCT (CAST(round(start_lat * 10000) AS BIGINT), CAST(round(start_lng * 10000) AS BIGINT))) AS active_stations FROM trips_li GROUP BY 1, 2""")
def active_locations(spark, sf):
    trips = v.trips_li(spark, sf).withColumn("zone", (F.col("l_suppkey") % 10).cast("int"))
    return grid.active_locations(trips, "zone", geo.location_key(F.col("start_lat"), F.col("start_lng")))


@add("yearly_summary", "trips_li", f"""SELECT CAST(year(started_at) AS INTEGER) AS year, count(*) AS trips, count(DISTINCT date_trunc('day', started_at)) AS days_with_data,
    {r6("100.0 * count(*) FILTER (WHERE member_casual = 'member') / count(*)")} AS member_pct,
    {r6("100.0 * count(*) FILTER (WHERE rideable_type = 'electric_bike') / count(*)")} AS electric_pct FROM trips_li GROUP BY 1""")
def yearly_summary(spark, sf):
    """Days first, then years: the second aggregate sees one row per day."""
    daily = v.trips_li(spark, sf).groupBy(cal.day_floor(F.col("started_at")).alias("day")).agg(
        rows().alias("trips"), F.count_if(F.col("member_casual") == "member").alias("m"), F.count_if(F.col("rideable_type") == "electric_bike").alias("e"))
    return daily.groupBy(F.year("day").alias("year")).agg(
        F.sum("trips").alias("trips"), rows().alias("days_with_data"), rnd(F.sum("m") * 100.0 / F.sum("trips")).alias("member_pct"),
        rnd(F.sum("e") * 100.0 / F.sum("trips")).alias("electric_pct"))


@add("distinct_per_time", "zone_hour weather", "SELECT DISTINCT time, temperature_c, precipitation_mm FROM zone_hour LEFT JOIN weather USING (time)")
def distinct_per_time(spark, sf):
    return demand.model_table(spark, sf).select("time", "temperature_c", "precipitation_mm").dropDuplicates(["time"])


WINTER_HOURS = """SELECT date_trunc('day', o_orderdate) + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS time, avg(o_totalprice) / 1000 AS temperature_c,
    count(*) * 0.5::DOUBLE AS snowfall_cm, CAST(max(o_custkey % 12) AS DOUBLE) AS snow_depth_cm FROM orders GROUP BY 1"""


@add("winter_summary", sql=f"""WITH h AS ({WINTER_HOURS}),
    w AS (SELECT *, year(time) + (month(time) = 12)::INTEGER AS y, date_trunc('day', time) AS day FROM h WHERE month(time) IN (12, 1, 2)),
    d AS (SELECT y, day, sum(temperature_c) AS t, count(*) AS n, sum(snowfall_cm) AS s, max(snow_depth_cm) AS m FROM w GROUP BY 1, 2)
    SELECT CAST(y - 1 AS VARCHAR) || '-' || CAST(y AS VARCHAR) AS season, {r6("sum(t) / sum(n)")} AS mean_temperature, sum(s) AS snowfall_cm,
        CAST(count(*) FILTER (WHERE m >= 5) AS BIGINT) AS days_with_snow, max(m) AS max_depth_cm FROM d GROUP BY y""")
def winter_summary(spark, sf):
    hours = v.table(spark, sf, "orders").groupBy(
        F.timestamp_add("HOUR", (F.col("o_orderkey") % 24).cast("int"), cal.day_floor(F.col("o_orderdate"))).alias("time")).agg(
        (F.avg("o_totalprice") / 1000).alias("temperature_c"), (rows() * 0.5).alias("snowfall_cm"),
        F.max(F.col("o_custkey") % 12).cast("double").alias("snow_depth_cm"))
    year = F.year("time") + (F.month("time") == 12).cast("int")
    days = hours.where(F.month("time").isin(12, 1, 2)).groupBy(year.alias("y"), cal.day_floor(F.col("time")).alias("day")).agg(
        F.sum("temperature_c").alias("t"), rows().alias("n"), F.sum("snowfall_cm").alias("s"), F.max("snow_depth_cm").alias("m"))
    return days.groupBy(F.concat_ws("-", F.col("y") - 1, F.col("y")).alias("season")).agg(
        rnd(F.sum("t") / F.sum("n")).alias("mean_temperature"), F.sum("s").alias("snowfall_cm"),
        F.count_if(F.col("m") >= 5).alias("days_with_snow"), F.max("m").alias("max_depth_cm"))


SEGMENTS = ["brand", "kind", "noise_0", "noise_1", "season"]
GUESS = "((l_orderkey * 48271 + l_linenumber * 69621) % 2147483647) % 100 < case when class = 'p' then 70 else 25 end"


@add("segment_error_rates", "cases", "WITH g AS (SELECT *, " + GUESS + " AS flagged FROM cases) " + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, coalesce({c}, '__missing__') AS value, count(*) AS n, {r6("avg((flagged <> (class = 'p'))::INTEGER)")} AS error_rate,
    {r6("avg((class = 'p' AND NOT flagged)::INTEGER)")} AS false_negative_rate FROM g GROUP BY 2 HAVING count(*) >= 20""" for c in SEGMENTS))
def segment_error_rates(spark, sf):
    rows = v.cases(spark, sf).withColumn("flagged", F.expr(GUESS))
    bad = F.col("class") == "p"
    rates = {"error_rate": F.col("flagged") != bad, "false_negative_rate": bad & ~F.col("flagged")}
    return rounded(aggregate.segment_rates(rows, SEGMENTS, rates, 20), "error_rate", "false_negative_rate")


def _purity_sql():
    parts = []
    for k in (1, 2, 3):
        for cols in combinations(SEGMENTS, k):
            name = " || ' & ' || ".join(f"'{c}=' || {c}" for c in cols)
            known = " AND ".join(f"{c} IS NOT NULL" for c in cols)
            parts.append(f"""SELECT {name} AS combination, count(*) AS n, CAST(count(*) FILTER (WHERE class = 'p') AS BIGINT) AS positives
                FROM cases WHERE {known} GROUP BY {", ".join(cols)} HAVING count(*) >= 30""")
    return f"""SELECT combination, n, positives, {r6("least(positives * 1.0 / n, 1 - positives * 1.0 / n)")} AS minority_share FROM ({" UNION ALL ".join(parts)})"""


@add("purity_mining", "cases", _purity_sql())
def purity_mining(spark, sf):
    return rounded(aggregate.combination_rates(v.cases(spark, sf), SEGMENTS, F.col("class") == "p", (1, 2, 3), 30), "minority_share")


GAPPY = ["kind", "size", "noise_1"]


@add("missing_by_class", "cases", " UNION ALL ".join(
    f"""SELECT class AS scope, '{c}' AS feature, {r6(f"100.0 * avg(({c} IS NULL)::INTEGER)")} AS value FROM cases GROUP BY 1""" for c in GAPPY)
    + " UNION ALL " + " UNION ALL ".join(
    f"""SELECT 'pattern' AS scope, '{a}~{b}' AS feature, {r6(f"corr(({a} IS NULL)::INTEGER, ({b} IS NULL)::INTEGER)")} AS value FROM cases"""
    for a, b in combinations(GAPPY, 2)))
def missing_by_class(spark, sf):
    """Missing percentage per class, and whether columns go missing together."""
    gaps = v.cases(spark, sf).select("class", *[F.col(c).isNull().cast("double").alias(c) for c in GAPPY])
    rates = gaps.groupBy(F.col("class").alias("scope")).agg(*[(F.avg(c) * 100).alias(c) for c in GAPPY]).unpivot(["scope"], GAPPY, "feature", "value")
    pairs = {f"{a}~{b}": F.corr(a, b) for a, b in combinations(GAPPY, 2)}
    together = gaps.agg(F.lit("pattern").alias("scope"), *[c.alias(k) for k, c in pairs.items()])
    together = together.unpivot(["scope"], [f"`{k}`" for k in pairs], "feature", "value")
    return rounded(rates.unionByName(together), "value")


@add("quality_before_after", "cases", """SELECT 'raw' AS stage, count(*) AS n_rows, CAST(2 AS INTEGER) AS noise_columns,
        CAST(sum((kind IS NULL)::INTEGER + (noise_1 IS NULL)::INTEGER) AS BIGINT) AS empty_text_cells, count(*) - count(size) AS empty_number_cells FROM cases
    UNION ALL SELECT 'clean', count(*), CAST(0 AS INTEGER), CAST(0 AS BIGINT), count(*) - count(size) FROM cases""")
def quality_before_after(spark, sf):
    raw = v.cases(spark, sf)
    tidy = raw.drop("noise_0", "noise_1").fillna({"kind": "unknown"})

    def summary(df, stage):
        cells = [c for c in ("kind", "noise_0", "noise_1") if c in df.columns]
        empty = F.sum(sum((F.col(c).isNull().cast("long") for c in cells), F.lit(0).cast("long")))
        return df.agg(F.lit(stage).alias("stage"), rows().alias("n_rows"), F.lit(sum(c.startswith("noise") for c in cells)).alias("noise_columns"),
                      empty.alias("empty_text_cells"), F.count_if(F.col("size").isNull()).alias("empty_number_cells"))

    return summary(raw, "raw").unionByName(summary(tidy, "clean"))


@add("chance_agreement", "cases", f"""SELECT {r6("(SELECT sum(s * s) FROM (SELECT count(*) * 1.0 / (SELECT count(*) FROM cases) AS s FROM cases WHERE noise_0 IS NOT NULL GROUP BY noise_0))")} AS expected,
    {r6("(SELECT avg(coalesce(noise_0 = noise_1, false)::INTEGER) FROM cases)")} AS measured""")
def chance_agreement(spark, sf):
    return rounded(aggregate.chance_agreement(v.cases(spark, sf), "noise_0", "noise_1"), "expected", "measured")
