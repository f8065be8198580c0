"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewheel.functions import calendar as cal
from tidewheel.functions.text import notation_of
from tidewheel.plans import views as v
from tidewheel.plans.views import Book, r6, rnd, rounded
from tidewheel.session import stage, staging_path
from tidewheel.sources import archives, files

BOOK = Book()
add = BOOK.add


@add("scan_parquet_columns", sql="SELECT l_orderkey, l_extendedprice FROM lineitem")
def scan_parquet_columns(spark, sf):
    return files.read_columns(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_extendedprice"])


@add("scan_partitioned_union", "trips_li", """SELECT CAST(year(started_at) AS INTEGER) AS period, ride_id, started_at, duration_minutes FROM trips_li""")
def scan_partitioned_union(spark, sf):
    path = staging_path(spark, "periods")
    trips = v.trips_li(spark, sf).select(F.year("started_at").alias("period"), "ride_id", "started_at", "duration_minutes")
    trips.write.partitionBy("period").parquet(path)
    return files.read_parts(spark, path).select("period", "ride_id", "started_at", "duration_minutes")


@add("scan_csv_text", sql="""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) || '.10' AS station, o_orderpriority FROM orders""")
def scan_csv_text(spark, sf):
    path = staging_path(spark, "csv")
    v.table(spark, sf, "orders").select("o_orderkey", F.concat("o_custkey", F.lit(".10")).alias("station"), "o_orderpriority").write.option(
        "header", "true").csv(path)
    return files.read_text_csv(spark, path, ["o_orderkey", "station", "o_orderpriority"])


ARCHIVED = ["ride_id", "started_at", "start_station_id", "start_lat", "start_lng", "member_casual"]


def packed(spark, sf):
    """The event trips packed into archives, with older column names."""
    folder = staging_path(spark, "zips")
    rows = v.trips_ev(spark, sf).select(
        "ride_id", F.date_format("started_at", "yyyy-MM-dd HH:mm:ss").alias("started_at"), F.col("started_at").alias("ts"),
        F.col("start_station_id").alias("Start Station ID"), F.col("start_lat").alias("start station latitude"),
        F.col("start_lng").alias("start station longitude"), F.col("member_casual").alias("User Type")).drop("ts")
    made = archives.write_archives(rows, folder, rows.columns, 4)
    made.agg(F.sum("n_rows")).collect()  # one row: runs the packing
    return folder


@add("scan_archive", "trips_ev", f"""SELECT ride_id, strftime(started_at, '%Y-%m-%d %H:%M:%S') AS started_at, start_station_id, {r6("start_lat")} AS start_lat,
    {r6("start_lng")} AS start_lng, member_casual FROM trips_ev""")
def scan_archive(spark, sf):
    rows = archives.read_archives(archives.list_files(spark, packed(spark, sf))).withColumns({"start_lat": F.col("start_lat").cast("double"), "start_lng": F.col("start_lng").cast("double")})
    return rounded(rows.select(*ARCHIVED), "start_lat", "start_lng")


MEMBER_SQL = """WITH m AS (SELECT DISTINCT strftime(o_orderdate, '%Y') AS y, strftime(o_orderdate, '%m') AS mm, CAST(month(o_orderdate) AS INTEGER) AS k FROM orders),
    names AS (SELECT CAST(CAST(y AS INTEGER) + 18 AS VARCHAR) || '-city-tripdata.zip' AS archive, CAST(CAST(y AS INTEGER) + 18 AS VARCHAR) || mm AS ym, k FROM m),
    members AS (SELECT archive, ym || '-trips.csv' AS member FROM names WHERE k % 4 IN (0, 2)
        UNION ALL SELECT archive, k || '_Month/' || ym || '-trips_1.csv' FROM names WHERE k % 4 IN (0, 1)
        UNION ALL SELECT archive, k || '_Month/' || ym || '-trips_2.csv' FROM names WHERE k % 4 IN (0, 1)
        UNION ALL SELECT archive, ym || '-trips_1.csv' FROM names WHERE k % 4 = 2
        UNION ALL SELECT archive, 'a/b/' || ym || '.csv' FROM names WHERE k % 4 = 3)"""


def member_names(spark, sf):
    """Archive member names for the months that have orders: copies at two depths, parts, complete files."""
    months = v.table(spark, sf, "orders").select(
        (F.year("o_orderdate") + 18).alias("y"), F.month("o_orderdate").alias("k")).distinct()
    ym = F.concat("y", F.lpad(F.col("k").cast("string"), 2, "0"))
    folder = F.concat("k", F.lit("_Month/"), ym)
    kind = F.col("k") % 4
    names = F.array_compact(F.array(
        F.when(kind.isin(0, 2), F.concat(ym, F.lit("-trips.csv"))),
        F.when(kind.isin(0, 1), F.concat(folder, F.lit("-trips_1.csv"))),
        F.when(kind.isin(0, 1), F.concat(folder, F.lit("-trips_2.csv"))),
        F.when(kind == 2, F.concat(ym, F.lit("-trips_1.csv"))),
        F.when(kind == 3, F.concat(F.lit("a/b/"), ym, F.lit(".csv")))))
    return months.select(F.concat("y", F.lit("-city-tripdata.zip")).alias("archive"), F.explode(names).alias("member"))


@add("select_members", sql=MEMBER_SQL + """,
    p AS (SELECT archive, member, regexp_extract(member, '(20[0-9]{4})', 1) AS mo, length(member) - length(replace(member, '/', '')) AS depth,
        regexp_matches(member, '_[0-9]+[.]csv$') AS part, regexp_replace(member, '/?[^/]*$', '') AS folder FROM members),
    s AS (SELECT *, depth = min(depth) OVER (PARTITION BY archive, mo) AS top, count(*) OVER (PARTITION BY archive, mo, folder) AS nf FROM p),
    t AS (SELECT *, bool_or(top AND NOT part) OVER (PARTITION BY archive, mo) AS whole, row_number() OVER (PARTITION BY archive, mo ORDER BY depth DESC, nf DESC, folder) AS rn FROM s)
    SELECT t.archive, t.member, t.top AND (NOT t.part OR NOT t.whole) AS keep_shallowest, t.folder = f.folder AS keep_deepest
    FROM t JOIN (SELECT archive, mo, folder FROM t WHERE rn = 1) f USING (archive, mo)""")
def select_members(spark, sf):
    shallow = archives.select_members(member_names(spark, sf), "shallowest").withColumnRenamed("keep", "keep_shallowest")
    return archives.select_members(shallow, "deepest").withColumnRenamed("keep", "keep_deepest")


@add("source_period", sql="""SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN strftime(o_orderdate, '%Y') ELSE CAST(CAST(strftime(o_orderdate, '%Y') AS INTEGER) + 18 AS VARCHAR) || strftime(o_orderdate, '%m') END AS period FROM orders""")
def source_period(spark, sf):
    year, month = (F.year("o_orderdate") + 18).cast("string"), F.date_format("o_orderdate", "MM")
    kind = F.col("o_orderkey") % 4
    member = (F.when(kind == 0, F.lit("data/trips.csv")).when(kind == 1, F.concat(year, month, F.lit("-trips.csv")))
              .when(kind == 2, F.concat(F.lit("x_"), year, F.lit("-"), month, F.lit("_1.csv"))).otherwise(F.concat(F.lit("m/"), year, F.lit(" "), month, F.lit(".csv"))))
    archive = F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-city-tripdata.zip"))
    return v.table(spark, sf, "orders").select("o_orderkey", archives.source_period(archive, member).alias("period"))


LISTING = """WITH l AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) + 18 AS y, CAST(month(o_orderdate) AS INTEGER) AS m FROM orders),
    listing AS (SELECT CASE WHEN y < 2017 THEN CAST(y AS VARCHAR) ELSE CAST(y * 100 + m AS VARCHAR) END AS period, sum(y * 1000 + m) AS bytes FROM l GROUP BY 1),
    inv AS (SELECT period || '-city-tripdata.zip' AS key, period, CASE WHEN period = '2013' THEN '201306' WHEN length(period) = 4 THEN period || '01' ELSE period END AS first_month,
        CASE WHEN length(period) = 4 THEN period || '12' ELSE period END AS last_month, CAST(bytes AS BIGINT) AS bytes FROM listing)"""


def listing(spark, sf):
    """Bucket listing: yearly and monthly archives, another system's archives and other files."""
    months = v.table(spark, sf, "orders").select((F.year("o_orderdate") + 18).alias("y"), F.month("o_orderdate").alias("m")).distinct()
    period = F.when(F.col("y") < 2017, F.col("y").cast("string")).otherwise((F.col("y") * 100 + F.col("m")).cast("string"))
    sizes = months.groupBy(period.alias("period")).agg(F.sum((F.col("y") * 1000 + F.col("m")).cast("long")).alias("bytes"))
    keys = F.array(F.concat("period", F.lit("-city-tripdata.zip")), F.concat(F.lit("JC-"), "period", F.lit("-city-tripdata.csv.zip")), F.concat("period", F.lit("-index.html")))
    return sizes.select(F.explode(keys).alias("key"), "bytes")


@add("archive_inventory", sql=LISTING + " SELECT key, period, first_month, last_month, bytes FROM inv")
def archive_inventory(spark, sf):
    return archives.archive_inventory(listing(spark, sf))


@add("archive_range_select", sql=LISTING + " SELECT key, first_month, last_month FROM inv WHERE last_month >= '201605' AND first_month <= (SELECT max(last_month) FROM inv)")
def archive_range_select(spark, sf):
    return archives.select_range(archives.archive_inventory(listing(spark, sf)), "201605", "latest").select("key", "first_month", "last_month")


@add("manifest_checksum")
def manifest_checksum(spark, sf):
    """Name, size and SHA-256 of every supplied file, and what became of it since a manifest written before: that one
    lacks the events, holds another digest for the orders, and lists a file that is gone."""
    found = archives.checksums(archives.list_files(spark, sf, "*.parquet"))
    found = stage(found.select(F.regexp_extract("path", "([^/]*)$", 1).alias("file"), "bytes", "sha256"), "checksums")
    before = found.where("file <> 'events.parquet'").withColumn("sha256", F.when(F.col("file") == "orders.parquet", F.sha2("sha256", 256)).otherwise(F.col("sha256")))
    gone = found.where("file = 'events.parquet'").withColumn("file", F.lit("withdrawn.parquet"))
    earlier = stage(before.unionByName(gone), "manifest")
    return archives.manifest(found, earlier)


@add("header_scan", sql="""SELECT CASE WHEN year(o_orderdate) < 1998 THEN 'Start Time,Trip' ELSE 'started_at,ride_id' END AS header,
    CAST(CASE WHEN year(o_orderdate) < 1998 THEN 2 ELSE 0 END AS INTEGER) AS notation, string_agg(DISTINCT CAST(year(o_orderdate) AS VARCHAR), ',' ORDER BY CAST(year(o_orderdate) AS VARCHAR)) AS years
    FROM orders GROUP BY 1, 2""")
def header_scan(spark, sf):
    """Which headers and date notations occur, by year of the file."""
    path = staging_path(spark, "headers")
    orders = v.table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    old = orders.where("year < 1998").select(F.date_format("o_orderdate", "M/d/yyyy H:mm").alias("Start Time"), F.col("o_orderkey").alias("Trip"), "year")
    new = orders.where("year >= 1998").select(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("started_at"), F.col("o_orderkey").alias("ride_id"), "year")
    old.write.partitionBy("year").option("header", "true").csv(path)
    new.write.mode("append").partitionBy("year").option("header", "true").csv(path)
    heads = archives.first_lines(archives.list_files(spark, path, "*.csv"))
    notation = notation_of(F.split("first_line", ",")[0])
    return heads.groupBy("header", notation.alias("notation")).agg(
        F.sort_array(F.collect_set(F.regexp_extract("path", "year=([0-9]+)", 1))).alias("years")).withColumn(
        "years", F.concat_ws(",", "years"))


@add("json_records", sql=f"""SELECT event_type, count(*) AS rows, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k_total,
    CAST(count(*) FILTER (WHERE event_id % 101 = 0) AS BIGINT) AS missing_start, CAST(count(*) FILTER (WHERE event_id % 97 = 0) AS BIGINT) AS missing_lat FROM events GROUP BY 1""")
def json_records(spark, sf):
    """Audit records written as JSON text and flattened again, nested counts to columns."""
    events = v.table(spark, sf, "events").withColumn("k", F.from_json("props", "k int")["k"])
    audit = events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("k").alias("k_total"),
        F.struct(F.count_if(F.col("event_id") % 101 == 0).alias("missing_start"), F.count_if(F.col("event_id") % 97 == 0).alias("missing_lat")).alias("missing"))
    records = audit.select(F.to_json(F.struct("*")).alias("record"))
    schema = "event_type string, rows long, k_total long, missing struct<missing_start:long, missing_lat:long>"
    return records.select(F.from_json("record", schema).alias("r")).select("r.event_type", "r.rows", "r.k_total", "r.missing.*")


@add("hourly_payload_explode", "weather", """SELECT time AS weather_hour, CASE WHEN hour(time) = 5 THEN NULL ELSE temperature_c END AS temperature_2m, precipitation_mm AS precipitation FROM weather""")
def hourly_payload_explode(spark, sf):
    """One payload per day, with a broken number and a repeated hour in each."""
    rows = v.weather(spark, sf).select(
        cal.day_floor(F.col("time")).alias("day"),
        F.struct(F.date_format("time", "yyyy-MM-dd'T'HH:mm").alias("time"),
                 F.when(F.hour("time") == 5, F.lit("n/a")).otherwise(F.col("temperature_c").cast("string")).alias("temperature_2m"),
                 F.col("precipitation_mm").cast("string").alias("precipitation")).alias("h"))
    days = rows.groupBy("day").agg(F.sort_array(F.collect_list("h")).alias("h"))  # 24 entries a day
    again = F.concat("h", F.transform(F.slice("h", 3, 1), lambda x: F.struct(x["time"].alias("time"), F.lit("-99").alias("temperature_2m"), F.lit("-99").alias("precipitation"))))
    payload = days.select(again.alias("h")).select(F.to_json(F.struct(F.struct(*[F.col(f"h.{c}").alias(c) for c in ("time", "temperature_2m", "precipitation")]).alias("hourly"))).alias("payload"))
    return files.explode_hourly_payload(payload, "payload", ["temperature_2m", "precipitation"])


@add("sink_parquet", "trips_li", "SELECT ride_id, started_at, duration_minutes FROM trips_li")
def sink_parquet(spark, sf):
    path = staging_path(spark, "trips")
    files.write_parquet(v.trips_li(spark, sf).select("ride_id", "started_at", "duration_minutes"), path)
    return spark.read.parquet(path)


@add("sink_by_period_resume", "trips_li", """SELECT CAST(year(started_at) AS INTEGER) AS period, CASE WHEN year(started_at) < 1998 THEN 1 ELSE 2 END AS run, count(*) AS trips FROM trips_li GROUP BY 1, 2""")
def sink_by_period_resume(spark, sf):
    """Two runs: the second finds the first run's periods and only adds the others."""
    path = staging_path(spark, "resume")
    trips = v.trips_li(spark, sf).select(F.year("started_at").alias("period"), "ride_id")
    files.write_new_periods(trips.where("period < 1998").withColumn("run", F.lit(1)), path, "period")
    files.write_new_periods(trips.withColumn("run", F.lit(2)), path, "period")
    return spark.read.parquet(path).groupBy("period", "run").agg(F.count(F.lit(1)).alias("trips"))


@add("sink_json_csv", "trips_li", f"""WITH m AS (SELECT member_casual, count(*) AS trips, {r6("avg(duration_minutes)")} AS mean_minutes FROM trips_li GROUP BY 1)
    SELECT 'csv' AS format, * FROM m UNION ALL SELECT 'json', * FROM m""")
def sink_json_csv(spark, sf):
    path = staging_path(spark, "report")
    report = v.trips_li(spark, sf).groupBy("member_casual").agg(F.count(F.lit(1)).alias("trips"), rnd(F.avg("duration_minutes")).alias("mean_minutes"))
    files.write_report(report, path)
    schema = "member_casual string, trips long, mean_minutes double"
    as_json = spark.read.schema(schema).json(f"{path}/json").withColumn("format", F.lit("json"))
    as_csv = spark.read.schema(schema).option("header", "true").csv(f"{path}/csv").withColumn("format", F.lit("csv"))
    return as_json.unionByName(as_csv)
