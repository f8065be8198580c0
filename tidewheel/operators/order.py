"""Global order without a single-task window.

``Window.orderBy`` without keys sends every row to one task, and ``Window.partitionBy(key)`` sends a
hot key to one task. Both are replaced by the same three steps:

1. range-partition by the full sort key, which splits hot keys too, and write the result once with
   its partition number;
2. reduce each partition to one row per key and turn these few rows into offsets;
3. finish inside each partition and add the offset.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegralType, LongType, StructField, StructType

from tidewheel.session import shuffle_partitions, stage

_FIRST = Window.unboundedPreceding


def _col(item: str | Column) -> Column:
    return F.col(item) if isinstance(item, str) else item


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on group keys in which null equals null."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    test = F.lit(True)
    for k in keys:
        test = test & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(other, test).drop(*[f"_r_{k}" for k in keys])


def _range_sorted(df: DataFrame, cols: Sequence[str | Column], label: str, ranges: int | None = None) -> DataFrame:
    keys = [_col(c) for c in cols]
    # without a partition count adaptive execution merges neighbouring ranges where the data is small
    ranged = df.repartitionByRange(*([ranges] if ranges else []), *keys).sortWithinPartitions(*keys)
    # partition number in the upper bits, position inside the partition in the lower 33
    return stage(ranged.withColumn("_mid", F.monotonically_increasing_id()), label)


def row_index(df: DataFrame, order: Sequence[str | Column], name: str = "idx", spread_copies: bool = True) -> DataFrame:
    """Add the 0-based position of every row in the given total order, and the row count as ``<name>_n``.

    ``spread_copies`` appends the scan position to the sort key, so that a large group of identical
    rows is split over tasks as well. The input must then be a scan or a staged table, whose row
    order does not change when a task is repeated.
    """
    source = df.withColumn("_scan", F.monotonically_increasing_id()) if spread_copies else df
    tail = ["_scan"] if spread_copies else []
    staged = _range_sorted(source, [*order, *tail], "index")
    staged = staged.withColumn("_part", F.shiftright("_mid", 33)).withColumn(
        "_pos", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    )
    # one row per range partition: bounded by spark.sql.shuffle.partitions
    parts = staged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = parts.select(
        "_part",
        F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(_FIRST, -1)), F.lit(0)).alias("_off"),
        F.sum("_n").over(Window.partitionBy(F.lit(1))).alias(f"{name}_n"),
    )
    return (
        staged.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_off") + F.col("_pos"))
        .drop("_part", "_pos", "_mid", "_off", *tail)
    )


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    sums: Mapping[str, str | Column],
    spread_copies: bool = False,
) -> DataFrame:
    """For each ``name -> column`` add ``<name>_before`` (sum over earlier rows of the same keys) and
    ``<name>_total`` (sum over all rows of the same keys).

    A null key is a group like any other. No task ever holds more than one range partition, whatever the size
    of a key. After the range shuffle rows move once more, to their range partition and key.
    """
    source = df.withColumn("_scan", F.monotonically_increasing_id()) if spread_copies else df
    tail = ["_scan"] if spread_copies else []
    for name, item in sums.items():
        source = source.withColumn(f"_s_{name}", _col(item))
    staged = _range_sorted(source, [*keys, *order, *tail], "running").withColumn(
        "_part", F.shiftright("_mid", 33)
    )
    # one column that is never null, so that the window's partitioning serves the join as well
    group = ["_part"]
    if keys:
        staged = staged.withColumn("_group", F.struct(*keys))
        group.append("_group")
    inside = Window.partitionBy(*group).orderBy("_mid").rowsBetween(_FIRST, -1)
    local = staged.select(
        "*", *[F.coalesce(F.sum(f"_s_{n}").over(inside), F.lit(0)).alias(f"_b_{n}") for n in sums]
    )
    # at most (range partitions + distinct keys) rows, at most one row per partition for each key
    parts = staged.groupBy(*group).agg(*[F.sum(f"_s_{n}").alias(f"_p_{n}") for n in sums])
    whole = Window.partitionBy("_group") if keys else Window.partitionBy(F.lit(1))
    earlier = whole.orderBy("_part").rowsBetween(_FIRST, -1)
    offsets = parts.select(
        *group,
        *[F.coalesce(F.sum(f"_p_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in sums],
        *[F.sum(f"_p_{n}").over(whole).alias(f"{n}_total") for n in sums],
    )
    if not keys:
        offsets = F.broadcast(offsets)  # one row per range partition
    out = local.join(offsets, group)
    for n in sums:
        out = out.withColumn(f"{n}_before", F.col(f"_b_{n}") + F.col(f"_o_{n}"))
    drop = [f"_{p}_{n}" for n in sums for p in ("s", "b", "o")]
    return out.drop("_mid", *group, *drop, *tail)


#: Whole numbers are summed as two longs, the upper one counting steps of 2 ** _LOW, so that no total overflows.
_LOW = 31
#: A range of ``running_by_keys`` holds about so many rows at most, which a task works on at once; more ranges than the
#: session's shuffle partitions are made only for that, and none of fewer rows than the smaller number.
_RANGE_ROWS, _LEAST_ROWS = 400_000, 20_000


def running_by_keys(
    df: DataFrame, order: Sequence[str | Column], key_sets: Mapping[str, Sequence[str]], sums: Mapping[str, Column], kind: str = "decimal(38,0)"
) -> DataFrame:
    """Sums over earlier rows for several key sets under one order: for each key set ``tag`` and each
    ``name -> whole number`` the column ``<tag>_<name>`` (decimal, so no total overflows; or, with ``kind`` "double", the
    double next to it).

    Rows are range-partitioned by the order and written, and move once more, whole ranges dealt out evenly, to be
    added up for all key sets at once. What went before the range comes as one extra row per key and range, summed
    from partial aggregates. The number of ranges grows with the rows, so a task's work does not. A hot key is cut by the
    ranges like everything else. A null key is a group like any other, a null number counts as nothing. ``df`` is a scan
    or a staged table, because rows that are equal in ``order`` are told apart by their scan position.
    """
    halves = {}
    for n, c in sums.items():
        if isinstance(df.select(c).schema[0].dataType, IntegralType):
            whole = F.coalesce(c, F.lit(0)).cast("long")
            halves |= {f"_h_{n}": F.shiftright(whole, _LOW), f"_l_{n}": whole.bitwiseAND(F.lit((1 << _LOW) - 1))}
        else:
            whole = F.coalesce(c.cast("decimal(38,0)"), F.lit(0))
            high = F.floor(whole / F.lit(1 << _LOW)).cast("long")
            halves |= {f"_h_{n}": high, f"_l_{n}": (whole - high.cast("decimal(38,0)") * F.lit(1 << _LOW)).cast("long")}
    count = df.count()
    ranges = max(min(shuffle_partitions(df.sparkSession), -(-count // _LEAST_ROWS)), -(-count // _RANGE_ROWS), 1)
    numbered = df.withColumn("_scan", F.monotonically_increasing_id()).withColumns(halves)
    staged = _range_sorted(numbered, [*order, "_scan"], "running", ranges).drop("_scan").withColumns({"_part": F.shiftright("_mid", 33).cast("int"), "_set": F.lit(-1)})
    rows = staged
    for k, keys in enumerate(key_sets.values()):
        parts = staged.groupBy("_part", *keys).agg(*[F.sum(h).alias(h) for h in halves])
        earlier = Window.partitionBy(*keys or [F.lit(1)]).orderBy("_part").rowsBetween(_FIRST, -1)
        carried = parts.select("_part", *keys, F.lit(-1).cast("long").alias("_mid"), F.lit(k).alias("_set"), *[F.sum(h).over(earlier).alias(h) for h in halves])
        rows = rows.unionByName(carried.where(F.col(next(iter(halves))).isNotNull()), allowMissingColumns=True)
    rows = rows.repartition(_in_turn(df.sparkSession, "_part")).sortWithinPartitions("_part", "_mid")
    kept = [c for c in df.columns if c not in halves]
    wide = kind != "double"
    made = [f"_{tag}{h}" for tag in key_sets for h in halves] if wide else [f"{tag}_{n}" for tag in key_sets for n in sums]
    schema = StructType([df.schema[c] for c in kept] + [StructField(c, LongType() if wide else DoubleType()) for c in made])
    sets, names = [list(keys) for keys in key_sets.values()], list(halves)
    scanned = rows.select(*kept, *names, "_part", "_mid", "_set").mapInArrow(lambda batches: _prefix_scan(batches, kept, sets, names, made), schema)
    if not wide:
        return scanned
    low = F.lit(1 << _LOW).cast("decimal(20,0)")
    both = {f"{t}_{n}": (F.col(f"_{t}_h_{n}").cast("decimal(19,0)") * low + F.col(f"_{t}_l_{n}")).cast("decimal(38,0)") for t in key_sets for n in sums}
    return scanned.select(*kept, *[c.cast(kind).alias(n) for n, c in both.items()])


def _in_turn(spark: SparkSession, number: str) -> Column:
    """A value for every number by which rows are dealt out evenly: the hashes of neighbouring numbers would put several
    into one partition and leave others empty."""
    n = shuffle_partitions(spark)
    slot = F.pmod(F.hash(F.col("id").cast("int")), F.lit(n))
    found = {r["slot"]: r["value"] for r in spark.range(64 * n).groupBy(slot.alias("slot")).agg(F.min("id").alias("value")).collect()}
    values = F.split(F.lit(",".join(str(found.get(k, k)) for k in range(n))), ",").cast("array<int>")
    return F.get(values, F.pmod(number, F.lit(n)))


def _nearest(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The doubles next to the numbers whose halves are given."""
    small = (high >= -(1 << 31)) & (high < 1 << 31) & (low >= 0) & (low < 1 << 61)
    out = ((high << _LOW) + low).astype(np.float64)  # a long, if both halves are small
    for k in np.flatnonzero(~small).tolist():
        out[k] = float((int(high[k]) << _LOW) + int(low[k]))
    return out


def _prefix_scan(batches: Iterator[pa.RecordBatch], kept: list[str], key_sets: list[list[str]], sums: list[str], made: list[str]) -> Iterator[pa.RecordBatch]:
    """Adds to every row the sums over earlier rows of its range partition with the same keys. Rows come sorted by
    (_part, _mid); rows with _set >= 0 come first in a partition and say what a key starts with."""
    held: list[pa.RecordBatch] = []
    part = None
    for batch in batches:
        parts = batch.column("_part").to_numpy()
        cuts = np.flatnonzero(np.diff(parts, prepend=parts[:1] - 1)).tolist() if len(parts) else []
        for low, high in zip(cuts, [*cuts[1:], len(parts)], strict=True):
            if held and parts[low] != part:
                yield from _summed(held, kept, key_sets, sums, made)
                held = []
            part = parts[low]
            held.append(batch.slice(low, high - low))
    if held:
        yield from _summed(held, kept, key_sets, sums, made)


def _summed(held: list[pa.RecordBatch], kept: list[str], key_sets: list[list[str]], sums: list[str], made: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of one range with their sums, as halves or, with a name in ``made`` for each two halves, as doubles. What a key
    starts with counts as a row in front of the others."""
    table = pa.Table.from_batches(held)
    which = table.column("_set").to_numpy()
    n_first = int(np.count_nonzero(which >= 0))
    values = np.stack([table.column(c).to_numpy() for c in sums])
    columns: list[np.ndarray] = []
    for k, keys in enumerate(key_sets):
        given = np.flatnonzero(which[:n_first] == k)
        at = np.concatenate([given, np.arange(n_first, len(which))])
        code, ours = key_codes(table, keys)[at], values[:, at]
        by_key = np.argsort(code, kind="stable")
        ordered = ours[:, by_key]
        before = np.cumsum(ordered, axis=1) - ordered
        starts = np.flatnonzero(np.diff(code[by_key], prepend=-1))
        out = np.empty_like(ours)
        out[:, by_key] = before - np.repeat(before[:, starts], np.diff(np.append(starts, len(at))), axis=1)
        found = list(out[:, len(given) :])
        columns += found if len(made) == len(key_sets) * len(sums) else [_nearest(*found[k : k + 2]) for k in range(0, len(found), 2)]
    rows = table.slice(n_first).select(kept)
    for name, column in zip(made, columns, strict=True):
        rows = rows.append_column(name, pa.array(column))
    yield from rows.to_batches(max_chunksize=10_000)


def key_codes(table: pa.Table, keys: list[str]) -> np.ndarray:
    """A number from 0 for each row, the same for rows with the same keys; null is a key like any other."""
    code = np.zeros(len(table), np.int64)
    for k, c in enumerate(keys):
        column = table.column(c).combine_chunks()
        # Spark groups the two zeros together
        coded = (pc.add(column, pa.scalar(0.0, column.type)) if pa.types.is_floating(column.type) else column).dictionary_encode()
        coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
        index = coded.indices.fill_null(len(coded.dictionary)).to_numpy(zero_copy_only=False)
        if k:
            code = np.unique(code, return_inverse=True)[1]
        code = code * (len(coded.dictionary) + 1) + index
    return code


def value_counts(df: DataFrame, keys: Sequence[str], value: str, **counted: Column) -> DataFrame:
    """Collapse rows to distinct values with counts before anything is ordered."""
    aggs = [F.count(F.lit(1)).alias("n")] + [F.sum(c.cast("long")).alias(k) for k, c in counted.items()]
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(*aggs)


def average_ranks(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per distinct value: its count ``n`` and its tie-averaged 1-based rank ``avg_rank``."""
    if "n" in (*keys, value):
        raise ValueError("the name n is taken by the count")
    cells = running_totals(value_counts(df, keys, value), keys, [value], {"n": "n"})
    return cells.withColumn("avg_rank", F.col("n_before") + (F.col("n") + 1) / F.lit(2.0))


#: Buckets of values are this fine: steps of about 1 / _STEPS in relation to the value, evenly spaced below 1 / _SCALE.
_STEPS, _SCALE = 512, float(1 << 20)


def value_bucket(value: Column) -> Column:
    """A number that never falls where the value rises (logarithms are semi-monotonic): at most some 750,000 of them, and a
    few thousand for values within some orders of magnitude. NaN, which Spark sorts last, has the last one."""
    v = value.cast("double")
    size = F.floor(F.least(F.log1p(F.abs(v) * _SCALE), F.lit(750.0)) * _STEPS).cast("int")
    return F.when(F.isnan(v), F.lit(1 << 30)).when(v < 0, -1 - size).otherwise(size)


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float]) -> DataFrame:
    """Exact, linearly interpolated quantiles per key, plus the number of values as ``n``
    (unless a quantile has that name).

    ``percentile`` keeps every distinct value of a group in one task's memory, and ordering all values shuffles them. Here
    values are counted in buckets first; only values in the buckets that hold a wanted position are counted one by one
    and ordered, over all tasks, so the shuffles do not grow with the number of distinct values elsewhere.
    """
    values = stage(df.select(*keys, F.col(value).alias("_v")).where("_v is not null"), "values").withColumn("_b", value_bucket(F.col("_v")))
    group = Window.partitionBy(*keys or [F.lit(1)])
    buckets = values.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_c"))
    buckets = buckets.select(
        *keys, "_b", "_c", F.sum("_c").over(group).alias("_n"), F.coalesce(F.sum("_c").over(group.orderBy("_b").rowsBetween(_FIRST, -1)), F.lit(0)).alias("_before"))
    spots = {}
    for name, p in probs.items():
        at = F.floor(F.lit(float(p)) * (F.col("_n") - 1))
        spots |= {f"_lo_{name}": at, f"_hi_{name}": F.least(at + 1, F.col("_n") - 1)}
    holds = F.lit(False)
    for spot in spots.values():
        holds = holds | ((spot >= F.col("_before")) & (spot < F.col("_before") + F.col("_c")))
    wanted = stage(buckets.where(holds).drop("_c"), "buckets")  # at most two for each quantile and key
    near = value_counts(join_groups(values, wanted, [*keys, "_b"]), [*keys, "_b", "_n", "_before"], "_v")
    cells = running_totals(near.withColumnRenamed("n", "_k"), [*keys, "_b"], ["_v"], {"_k": "_k"})
    start = F.col("_before") + F.col("_k_before")
    aggs = [F.max("_n").alias("_n")]
    for name, spot in spots.items():
        aggs.append(F.max(F.when((spot >= start) & (spot < start + F.col("_k")), F.col("_v").cast("double"))).alias(name))
    found = cells.groupBy(*keys).agg(*aggs)
    picks = [] if "n" in probs else [F.col("_n").alias("n")]
    for name, p in probs.items():
        at = F.lit(float(p)) * (F.col("_n") - 1)
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        picks.append((low + (high - low) * (at - F.floor(at))).alias(name))
    return found.select(*keys, *picks)
