import datetime as dt

import pyarrow as pa
from pyspark.sql import functions as F

from tidewheel.operators import clean, grid
from tidewheel.plans import streams_book
from tidewheel.plans import views as v
from tidewheel.streaming import streams

SCHEMA = "ride_id string, started_at timestamp_ntz, start_station_id string, start_lat double, start_lng double, member_casual string, rideable_type string, duration_minutes double"


def ride(i, minute, station="a"):
    return (str(i), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute), station, 40.7, -74.0, "member", "classic_bike", 5.0)


def put(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def opened(spark, folder):
    return streams.open_stream(spark, folder, spark.read.parquet(folder).schema)


def test_late_and_open_hours_are_counted(spark, tmp_path):
    folder, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    put(spark, folder, [ride(1, 5), ride(2, 10), ride(3, 70)])
    first = streams.station_hours(opened(spark, folder), "t", out, log)
    assert {(r["time"].hour, r["trips"]) for r in first.collect()} == {(0, 2), (1, 1)}
    put(spark, folder, [ride(4, 300)])
    streams.station_hours(opened(spark, folder), "t", out, log)
    put(spark, folder, [ride(5, 20), ride(6, 600)])  # ride 5 is far too late
    done = streams.station_hours(opened(spark, folder), "t", out, log)
    assert {(r["time"].hour, r["trips"]) for r in done.collect()} == {(0, 3), (1, 1), (5, 1), (10, 1)}


def test_ranges_of_batches_cover_everything_once():
    for number in range(1500):
        ranges = [range(streams.first_of_range(k), k + 1) for k in streams.cover(number)]
        assert sorted(b for r in ranges for b in r) == list(range(number + 1)) and len(ranges) <= 10
    assert len(streams.cover(199)) == 3


def test_many_batches_leave_few_folders_and_may_be_repeated(spark, tmp_path):
    folder = str(tmp_path / "sums")

    def batch(number):
        return spark.createDataFrame([("a", number), ("ab"[number % 2], 1)], "k string, n long").groupBy("k").agg(F.sum("n").alias("n"))

    def want(number):
        return sorted(map(tuple, spark.createDataFrame([r for k in range(number + 1) for r in (("a", k), ("ab"[k % 2], 1))], "k string, n long").groupBy("k").agg(F.sum("n")).collect()))

    for number in range(24):
        streams.put_sums(batch(number), number, folder, ["k"], ["n"])
        if number % 7 == 3:
            streams.put_sums(batch(number), number, folder, ["k"], ["n"])  # stopped before its commit, and run again
            assert sorted(map(tuple, streams.current_sums(spark, folder, ["k"], ["n"]).collect())) == want(number)
    assert sorted(map(tuple, streams.current_sums(spark, folder, ["k"], ["n"]).collect())) == want(23)
    left = [p.name for p in (tmp_path / "sums").iterdir()]
    assert len(left) <= 6 and {f"upto={k}" for k in streams.cover(23)} <= set(left)


def reversed_batches(spark, folder, rows, n):
    for k in reversed(range(n)):
        put(spark, folder, rows[k * len(rows) // n : (k + 1) * len(rows) // n])
    return streams.open_stream(spark, folder, spark.read.parquet(folder).schema, files_per_batch=1)


def test_equals_the_batch_counts_in_reverse_order(spark, tmp_path):
    folder = str(tmp_path / "in")
    stream = reversed_batches(spark, folder, [ride(i, i * 7, "ab"[i % 2]) for i in range(200)], 5)
    got = {tuple(r) for r in streams.station_hours(stream).collect()}
    assert got == {tuple(r) for r in grid.station_hour_counts(clean.departures(spark.read.parquet(folder))).collect()}


def test_no_ride_is_lost_in_reverse_order(spark, tmp_path):
    rides = [ride(i % 90, i * 600) for i in range(200)]  # copies are days apart
    stream = reversed_batches(spark, str(tmp_path / "in"), rides, 5)
    out = streams.deduplicated(stream, ["ride_id"], ["started_at"])
    assert sorted(int(r["ride_id"]) for r in out.collect()) == list(range(90)) and out.columns == stream.columns


def test_audit_of_two_runs_adds_up(spark, tmp_path):
    folder, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    put(spark, folder, [ride(1, 5), ride(2, 10, None)])
    streams.run(streams.checked_rows(opened(spark, folder)), "t", out, log)
    put(spark, folder, [ride(3, 20)])
    row = streams.merged_audit(streams.run(streams.checked_rows(opened(spark, folder)), "t", out, log)).first()
    assert (row["input_rows"], row["output_rows"], row["removed_missing_start"]) == (3, 2, 1)


def test_repeated_ids_are_written_once(spark, tmp_path):
    folder, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    put(spark, folder, [ride(1, 5), ride(1, 6), ride(2, 7)])
    streams.deduplicated(opened(spark, folder), ["ride_id"], ["started_at"], "t", out, log)
    put(spark, folder, [ride(2, 9), ride(3, 10)])
    done = streams.deduplicated(opened(spark, folder), ["ride_id"], ["started_at"], "t", out, log)
    assert sorted((r["ride_id"], r["started_at"].minute) for r in done.collect()) == [("1", 5), ("2", 7), ("3", 10)]


def test_state_decides_and_stored_rows_are_not_read(spark, tmp_path):
    folder, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    put(spark, folder, [ride(i, i) for i in range(50)] + [(None, *ride(1, 3)[1:])])
    streams.deduplicated(opened(spark, folder), ["ride_id"], ["started_at"], "t", out, log)
    for part in (tmp_path / "out").glob("*.parquet"):
        part.write_bytes(b"not to be read")
    put(spark, folder, [ride(7, 1), ride(99, 9), ride(99, 8), (None, *ride(1, 2)[1:])])
    streams.deduplicated(opened(spark, folder), ["ride_id"], ["started_at"], "t", out, log)
    new = [str(p) for p in (tmp_path / "out").glob("*.parquet") if p.read_bytes() != b"not to be read"]
    rows = spark.read.parquet(*new).collect()
    assert [(r["ride_id"], r["started_at"].minute) for r in rows] == [("99", 8)]


def test_stream_dedupe_in_one_hot_key(spark, tmp_path):
    folder = str(tmp_path / "in")
    put(spark, folder, [ride(i if i % 3 else 0, i % 59) for i in range(600)])
    out = streams.deduplicated(opened(spark, folder), ["ride_id"], ["started_at", "start_station_id"])
    rows = {r["ride_id"]: r["started_at"].minute for r in out.collect()}
    assert rows["0"] == 0 and len(rows) == 401


def test_first_rows_tell_null_from_nan():
    batch = pa.RecordBatch.from_pydict({"k": pa.array([1.0, None, float("nan"), -0.0, 0.0, None, 1.0]), "t": pa.array([5, 7, 1, 3, 2, 6, None]), "n": pa.array(range(7))})
    out = pa.Table.from_batches(streams._first_rows(iter([batch]), ["k"], ["t"], 0))
    assert out.column("n").to_pylist() == [2, 4, 5, 6]
    assert pa.Table.from_batches(streams._first_rows(iter([batch.slice(1, 3)]), ["k"], ["t"], 0)).column("n").to_pylist() == [1, 2, 3]


def test_large_tables_arrive_in_more_files_and_as_many_batches(spark, sf, monkeypatch):
    monkeypatch.setattr(streams_book._Streamed, "FILE_ROWS", 500)
    kept = {}
    monkeypatch.setattr(streams, "open_stream", lambda spark, folder, schema, glob="*.parquet", files_per_batch=None: kept.update(folder=folder, at_once=files_per_batch) or spark.read.parquet(folder))
    v.trips_li(streams_book._Streamed(spark, "l_shipdate"), sf)
    sizes = [r["count"] for r in spark.read.parquet(kept["folder"]).groupBy(F.input_file_name()).count().collect()]
    assert kept["at_once"] == 3 and 10 <= len(sizes) <= 12 and sum(sizes) == v.trips_li(spark, sf).count() and max(sizes) < 1000
