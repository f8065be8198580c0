"""Streaming forms of the batch rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewheel.functions import features
from tidewheel.operators import joins
from tidewheel.plans import modeling
from tidewheel.plans import views as v
from tidewheel.plans.views import Book
from tidewheel.session import stage, staging_path
from tidewheel.streaming import streams

BOOK = Book()
add = BOOK.add


class _Streamed:
    """Hands the view functions a stream instead of a table: ``read.parquet(<dir>/<name>.parquet)``.

    With ``newest_first`` (a column) the table arrives in four micro-batches, later rows about first: a file each or, of large
    tables, as many files as tasks of bounded size write, in parts that can be read side by side."""

    #: Rows of a file at most, or so; bytes of a part that one task reads.
    FILE_ROWS, PART_BYTES = 2_000_000, 8 << 20

    def __init__(self, spark, newest_first=None):
        self.spark, self.read, self.newest_first = spark, self, newest_first

    def parquet(self, path):
        folder, name = path.rsplit("/", 1)
        table = self.spark.read.parquet(path)
        if not self.newest_first:
            return streams.open_stream(self.spark, folder, table.schema, name)
        arriving = staging_path(self.spark, "arriving")
        files = max(1, -(-table.count() // (4 * self.FILE_ROWS)))
        # copies of one moment are told apart by a hash, so that a file's share does not depend on them
        order = [F.col(self.newest_first).desc(), F.xxhash64(*table.columns)] if files > 1 else [F.col(self.newest_first).desc()]
        table.repartitionByRange(4 * files, *order).write.option("parquet.block.size", self.PART_BYTES).parquet(arriving)
        return streams.open_stream(self.spark, arriving, table.schema, files_per_batch=files)


@add("stream_station_hour", "departures", """SELECT start_station_id, date_trunc('hour', started_at) AS time, CAST(count(*) AS BIGINT) AS trips,
    CAST(count(*) FILTER (WHERE member_casual = 'member') AS BIGINT) AS members, CAST(count(*) FILTER (WHERE rideable_type = 'electric_bike') AS BIGINT) AS electric FROM departures
    GROUP BY 1, 2""")
def stream_station_hour(spark, sf):
    """All hours, open ones too, from batches that arrive newest first; equal to the batch counts."""
    return streams.station_hours(v.trips_ev(_Streamed(spark, "ts"), sf))


@add("stream_clean_audit", "trips_ev", """SELECT strftime(started_at, '%Y%m') AS source_month, count(*) AS input_rows,
    CAST(count(*) FILTER (WHERE duration_minutes BETWEEN 1 AND 180 AND start_lat BETWEEN 40.4 AND 41.1 AND start_lng BETWEEN -74.4 AND -73.5 AND start_station_id IS NOT NULL) AS BIGINT) AS output_rows,
    CAST(count(*) FILTER (WHERE NOT (duration_minutes BETWEEN 1 AND 180)) AS BIGINT) AS removed_invalid_duration,
    CAST(count(*) FILTER (WHERE NOT (start_lat BETWEEN 40.4 AND 41.1 AND start_lng BETWEEN -74.4 AND -73.5)) AS BIGINT) AS removed_invalid_geo,
    CAST(count(*) FILTER (WHERE member_casual NOT IN ('member', 'casual')) AS BIGINT) AS removed_invalid_user_type,
    CAST(count(*) FILTER (WHERE start_station_id IS NULL) AS BIGINT) AS removed_missing_start FROM trips_ev GROUP BY 1""")
def stream_clean_audit(spark, sf):
    return streams.merged_audit(streams.run(streams.checked_rows(v.trips_ev(_Streamed(spark), sf)), "checked"))


@add("stream_dedupe", "trips_li", "SELECT DISTINCT ride_id FROM trips_li")
def stream_dedupe(spark, sf):
    """One row per ride id from batches that arrive newest first."""
    rows = v.trips_li(_Streamed(spark, "l_shipdate"), sf).select("ride_id", "started_at", "start_station_id")
    return streams.deduplicated(rows, ["ride_id"], ["started_at", "start_station_id"]).select("ride_id")


@add("stream_weather_score")
def stream_weather_score(spark, sf):
    """Arriving trips joined with the static weather and the fitted history, then scored."""
    from tidewheel.plans.models_book import duration_model, score_requests

    train, _, fitted = modeling.duration_parts(spark, sf)
    static = {k: stage(t, "static") for k, t in fitted.items() if k != "global"}
    static["global"] = float(fitted["global"].first()[0])
    hourly = stage(features.duration_weather(v.weather(spark, sf)), "weather")
    arriving = v.trips_ev(_Streamed(spark), sf).where("start_station_id is not null")
    arriving = joins.join_hourly(arriving, hourly, "started_at", "time", features.WEATHER_DURATION)
    scored = score_requests(arriving, static, duration_model(train))
    out = scored.select("ride_id", F.col("start_station_id").alias("station"), "predicted_duration_minutes", "route_trips_in_history", "weather_source")
    return streams.run(out, "scored")
