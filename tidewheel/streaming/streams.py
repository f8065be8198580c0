"""The batch rules as Structured Streaming jobs.

Each job runs on what is available and stops. Results that nothing later changes go to a Parquet sink in append mode, whose
own log makes a repeated micro-batch harmless; what has been seen of a key is keyed state. Counts that later rows may
still change are kept as sums over ranges of micro-batches, which a repeated micro-batch writes anew, and are brought
together when they are read. No watermark decides what is counted, and no state is kept on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.operators import clean, grid
from tidewheel.operators.order import key_codes
from tidewheel.session import staging_path

#: Keys are kept in RocksDB. A micro-batch writes what it has changed, not the files of the whole store, and rows of the
#: store are not counted, which would look up every key once more.
_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def open_stream(spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """Files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def run(stream: DataFrame, label: str, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Process everything available into a Parquet folder and return the folder as a table. Calling it
    again with the same path and checkpoint only adds what is new."""
    spark = stream.sparkSession
    path = path or staging_path(spark, label)
    checkpoint = checkpoint or staging_path(spark, f"{label}-log")
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    query = writer.trigger(availableNow=True).start(path)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def run_batches(stream: DataFrame, label: str, write: Callable[[DataFrame, int, str], None], path: str | None = None, checkpoint: str | None = None) -> str:
    """Process everything available batch by batch: ``write(batch, number, path)`` puts the batch's result below ``path``.
    Returns the path; calling again with the same path and checkpoint only adds what is new."""
    spark = stream.sparkSession
    path = path or staging_path(spark, label)
    checkpoint = checkpoint or staging_path(spark, f"{label}-log")
    writer = stream.writeStream.foreachBatch(lambda batch, number: write(batch, number, path)).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
    return path


def first_of_range(number: int) -> int:
    """Micro-batches are merged as a binary counter carries: what batch ``number`` leaves covers the batches from this one
    on, as many as the greatest power of two that divides number + 1."""
    return number - ((number + 1) & -(number + 1)) + 1


def cover(number: int, first: int = 0) -> list[int]:
    """The ranges (by their last batch) that together hold the batches ``first`` to ``number``: one for each bit of their
    count at most, newest first."""
    found = []
    while number >= first:
        found.append(number)
        number = first_of_range(number) - 1
    return found


def _range_path(folder: str, number: int) -> str:
    return f"{folder}/upto={number}"


def put_sums(sums: DataFrame, number: int, folder: str, keys: Sequence[str], measures: Sequence[str]) -> None:
    """Writes the sums of batch ``number``, merged with those of the earlier batches of its range. Every range is written by
    one batch, from ranges that end earlier, so a repeated batch writes the same again. Ranges that lie inside one that
    ended before the last batch are of no use to any batch that may be repeated, and are deleted."""
    spark = sums.sparkSession
    earlier = cover(number - 1, first_of_range(number))
    if earlier:
        sums = added_up(sums.unionByName(spark.read.schema(sums.schema).parquet(*[_range_path(folder, k) for k in earlier])), keys, measures)
    sums.write.mode("overwrite").parquet(_range_path(folder, number))
    for inner in cover(number - 2, first_of_range(number - 1)) if number else []:
        path = spark._jvm.org.apache.hadoop.fs.Path(_range_path(folder, inner))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def added_up(parts: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    kinds = dict(parts.dtypes)
    return parts.groupBy(*keys).agg(*[F.sum(m).cast(kinds[m]).alias(m) for m in measures])


def current_sums(spark: SparkSession, folder: str, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """The sums over all batches; as many folders are read as the number of batches has bits set."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    there = [int(s.getPath().getName().removeprefix("upto=")) for s in files.listStatus(path) if s.getPath().getName().startswith("upto=")]
    whole = [k for k in there if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{_range_path(folder, k)}/_SUCCESS"))]
    return added_up(spark.read.parquet(*[_range_path(folder, k) for k in cover(max(whole))]), keys, measures)


def station_hours(trips: DataFrame, label: str = "station-hours", path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Departures per station and hour, open hours and late departures included. Each micro-batch adds its partial counts,
    one row per station and hour that it touches."""
    keys, measures = ["start_station_id", "time"], ["trips", "members", "electric"]

    def write(batch: DataFrame, number: int, folder: str) -> None:
        put_sums(grid.station_hour_counts(clean.departures(batch)), number, folder, keys, measures)

    folder = run_batches(trips, label, write, path, checkpoint)
    return current_sums(trips.sparkSession, folder, keys, measures)


def checked_rows(trips: DataFrame) -> DataFrame:
    """Every row with the rules it breaks, so that kept rows and their audit come from one sink."""
    checks = clean.trip_checks()
    kept = F.lit(True)
    for rule in checks.values():
        kept = kept & rule
    flags = {f"bad_{name}": ~rule for name, rule in checks.items()}
    return trips.withColumns({**flags, "kept": kept, "source_month": F.date_format("started_at", "yyyyMM")})


def merged_audit(rows: DataFrame) -> DataFrame:
    flags = [c for c in rows.columns if c.startswith("bad_")]
    return rows.groupBy("source_month").agg(
        F.count(F.lit(1)).alias("input_rows"), F.count_if("kept").alias("output_rows"),
        *[F.count_if(c).alias(c.replace("bad_", "removed_")) for c in flags],
    )


def _first_rows(batches: Iterator[pa.RecordBatch], keys: list[str], order: list[str], at_once: int) -> Iterator[pa.RecordBatch]:
    """The first row of every key in ``order`` (nulls first) among about ``at_once`` rows, or, with 0, among all."""
    held: list[pa.RecordBatch] = []
    waiting, grown = 0, 1 << 16

    def firsts() -> pa.Table:
        rows = pa.Table.from_batches(held)
        code = np.unique(key_codes(rows, keys), return_inverse=True)[1]
        again = np.bincount(code)[code] > 1 if len(code) else np.zeros(0, bool)
        if not again.any():
            return rows
        # only rows whose key comes more than once need an order
        at = np.flatnonzero(again)
        seen = rows.select([*dict.fromkeys(order)]).take(pa.array(at)).to_pandas().assign(_code=code[at], _at=at)
        chosen = seen.sort_values(order, kind="stable", na_position="first").drop_duplicates("_code")["_at"]
        return rows.take(pa.array(np.sort(np.concatenate([np.flatnonzero(~again), chosen.to_numpy()]))))

    for batch in batches:
        held.append(batch)
        waiting += len(batch)
        if waiting >= (at_once or grown):
            rows = firsts()
            held, waiting = [], 0
            if at_once:
                yield from rows.to_batches()
            else:
                held, waiting = rows.to_batches(), len(rows)
                grown = max(grown, 2 * waiting)  # work in proportion to the rows
    if held:
        yield from firsts().to_batches()


def deduplicated(trips: DataFrame, keys: Sequence[str], order: Sequence[str], label: str = "dedupe", path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """The first arrival of every key, however late; of a micro-batch's rows the first in ``order`` (nulls first).

    Whether a key has come is keyed state in RocksDB, kept and restored by the checkpoint, so a micro-batch costs what its
    own rows cost, whatever has been stored. Copies are dropped among neighbouring rows before rows are shuffled, and again
    where a key's rows of the micro-batch are together (a task holds one row per key). A null key is a key like any other.
    """
    spark, by, first = trips.sparkSession, list(keys), list(order)
    thin = trips.mapInArrow(lambda batches: _first_rows(batches, by, first, 1 << 16), trips.schema)
    one = thin.repartition(*by).mapInArrow(lambda batches: _first_rows(batches, by, first, 0), trips.schema)
    before = {name: spark.conf.get(name, None) for name in _STORE}
    for name, value in _STORE.items():
        spark.conf.set(name, value)
    try:
        return run(one.dropDuplicates(by), label, path, checkpoint)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
