"""Exact removal of repeated substrings by distributed prefix doubling.

A byte goes if a string of ``length`` bytes around it also starts anywhere else, in another document or in the same one.

1. *Positions.* Ranking every byte position would move many times the input, so suffixes are sorted from anchors only:
   positions whose hash of the next GRAM bytes is the least of some ``length - GRAM + 1`` neighbours. The least gram of a
   string of ``length`` bytes depends on the string alone, so copies of a string have that anchor at the same place.
2. *Prefix doubling.* Spark sorts (gram, name of the string from the anchor up to the first anchor at least ``length / 4``
   bytes on, position) over range partitions, so a hot gram is cut like anything else; equal neighbours get the smallest
   position among them as their rank. Then it sorts (rank at an anchor, rank at the anchor where that string ends,
   position) again, and the strings double: a pair of ranks is a pair of positions, so nothing is left to chance here but
   the first names. Ranks are paired inside their document, without a join. A group that is cut by the ranges is put together from one row per partition and side. A string that
   is unique is dropped; one of ``length`` bytes or more is a repeat for certain, and only its first copy goes on to speak
   for its inside in step 3. Doubling ends past twice the length, so that the strings of neighbouring anchors overlap by it.
   A text that repeats itself with a short period has an anchor in every period. Such a stretch repeats itself for certain, and
   its first period speaks for the others, so a few of its anchors are sorted, with strings of twice the length at once.
3. *Edges.* A repeat may begin and end between anchors. Strings of ``length`` bytes are candidates where their least gram is
   repeated and no certain repeat speaks for them. They are grouped by their least gram (a 64-bit name) and compared by
   48-bit hashes. A group of more than SPREAD places is split by place first, which settles the copies inside a part;
   each part then sends every string once, and these meet by hash. So of a string of a hot passage one task holds one
   copy for every SPREAD places or so.

Equal texts are worked on once. Documents are told apart by a 128-bit digest of their text, so neither null nor repeated
doc_ids matter. Of n different strings that share a 64-bit name about n*n / 2**49 pairs are taken for equal by chance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidewheel.llm.frames import free_name, narrow, text_groups
from tidewheel.session import discard, stage

LENGTH = 200
GRAM = 32
#: Bytes that are hashed at a time.
TILE = 1 << 19
#: Most occurrences of one anchor that are compared in one group.
SPREAD = 4096
#: Fewest anchors of a periodic stretch that is settled inside its text.
DENSE = 8

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def string_hashes(raw: np.ndarray, size: int) -> np.ndarray:
    """The hash of the ``size`` bytes that start at each place of ``raw``, by doubling."""
    if len(raw) < size:
        return np.zeros(0, _U)
    h, width = _mix(raw.astype(_U) + _U(0x9E3779B97F4A7C15)), 1
    while width < size:
        step = min(width, size - width)  # the last two strings may overlap
        h = _mix(h[: len(h) - step] * _U(0x9E3779B97F4A7C15 | 1) + h[step:])
        width += step
    return h


def hashes_at(raw: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """The hashes of the strings at the given places (ascending), a stretch of neighbouring places at a time."""
    new = np.flatnonzero((np.diff(starts, prepend=-TILE) > 2 * size) | (np.diff(starts // TILE, prepend=-1) > 0))
    found = []
    for a, b in zip(new.tolist(), [*new[1:].tolist(), len(starts)], strict=True):
        low = int(starts[a])
        found.append(string_hashes(raw[low : int(starts[b - 1]) + size], size)[starts[a:b] - low])
    return np.concatenate(found)


def _sliding(h: np.ndarray, window: int, least: bool) -> np.ndarray:
    """The least or greatest of every ``window`` neighbours."""
    pick, width = (np.minimum if least else np.maximum), 1
    while width < window:
        step = min(width, window - width)
        h = pick(h[: len(h) - step], h[step:])
        width += step
    return h


def anchors(raw: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of one text and the hashes of their grams. Ties are all anchors."""
    window = length - gram + 1
    places, names = [], []
    if len(raw) < length:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    n = len(raw) - gram + 1
    for at in range(0, n, TILE):
        first, last = max(0, at - window + 1), min(n, at + TILE + window - 1)
        h = string_hashes(raw[first : last + gram - 1], gram) | _U(1)
        lows = _sliding(h, window, True)  # of the windows that start at first, first + 1, ...
        pad = np.zeros(window - 1, _U)
        # a place is an anchor if it is the least in one of the windows that hold it
        best = _sliding(np.concatenate([pad, lows, pad]), window, False)
        here = np.flatnonzero(best == h)
        here = here[(here + first >= at) & (here + first < at + TILE)]
        places.append(here + first)
        names.append(h[here])
    return np.concatenate(places), np.concatenate(names)


def stretches(raw: np.ndarray, places: np.ndarray, grams: np.ndarray, length: int, gram: int) -> list[tuple[int, int]]:
    """First and last anchor of stretches of one period, in which every string of ``length`` bytes stands a period later or
    earlier as well. Consecutive anchors with one gram and one distance suggest them; their bytes are compared."""
    gaps = np.diff(places)
    equal = grams[1:] == grams[:-1]
    if np.count_nonzero(equal) < DENSE - 1:
        return []
    edge = np.flatnonzero(~equal[1:] | ~equal[:-1] | (gaps[1:] != gaps[:-1])) + 1
    found = []
    for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(gaps)], strict=True):
        low, high, period = int(places[a]), int(places[b]) + gram, int(gaps[a])
        if equal[a] and b - a + 1 >= DENSE and high - low >= 2 * period + length and np.array_equal(raw[low : high - period], raw[low + period : high]):
            found.append((a, b))
    return found


def first_strings(raw: np.ndarray, places: np.ndarray, length: int, gram: int, settled: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each anchor but the last ones: the number of the first anchor at least ``length / 4`` bytes on, and the hash of the
    string up to the end of that anchor's gram; and for how many places of its gram each anchor speaks.

    Of a settled stretch four anchors speak: the first, the second for all that do not (without a string), the last one that is
    ``length`` bytes from the end, the last. Their strings and those that end inside go to an anchor twice the length on.
    """
    import xxhash

    nexts = np.searchsorted(places, places + max(1, length // 4))
    nexts = nexts[nexts < len(places)]
    counts = np.ones(len(places), np.int32)
    if settled:
        far, inside = np.zeros(len(places), bool), np.zeros(len(places), bool)
        for a, b in settled:
            inside[a + 1 : b + 1] = True
            far[a : b + 1] = True
            counts[a + 1 : b] = 0
            counts[a + 1] = b - a - 2
            counts[np.searchsorted(places, places[b] + gram - length, side="right") - 1] = 1
        far = far[: len(nexts)] | inside[nexts]
        beyond = np.minimum(np.searchsorted(places, places[: len(nexts)] + 2 * length), len(places) - 1)
        none = counts == 0
        none[[a + 1 for a, _ in settled]] = True
        nexts = np.where(none[: len(nexts)], np.arange(len(nexts)), np.where(far, beyond, nexts))
    view = raw.tobytes()
    names = [xxhash.xxh3_64_intdigest(view[a : b + gram]) if b > a else 0 for a, b in zip(places.tolist(), places[nexts].tolist(), strict=False)]
    return nexts, np.array(names, _U), counts


def _gram(length: int) -> int:
    return min(GRAM, max(1, length // 4))


#: ``settled`` holds first and last anchors of stretches; ``counts`` is null where every anchor speaks for itself.
_ARRAYS = "n_bytes int, places array<int>, grams array<long>, nexts array<int>, names array<long>, counts array<int>, settled array<int>"


def anchored(docs: DataFrame, length: int) -> DataFrame:
    """One row per distinct text of at least ``length`` bytes: its digest, copies, anchors, grams and first strings."""
    gram = _gram(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_groups(batches):
            rows = [np.frombuffer(t.encode(), np.uint8) for t in texts]
            found = [anchors(r, length, gram) for r in rows]
            settled = [stretches(r, p, g, length, gram) for r, (p, g) in zip(rows, found, strict=True)]
            strings = [first_strings(r, p, length, gram, s) for r, (p, _), s in zip(rows, found, settled, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array([len(r) for r in rows], pa.int32()),
                    pa.array([p.astype(np.int32) for p, _ in found], pa.list_(pa.int32())),
                    pa.array([g.view(np.int64) for _, g in found], pa.list_(pa.int64())),
                    pa.array([n.astype(np.int32) for n, _, _ in strings], pa.list_(pa.int32())),
                    pa.array([x.view(np.int64) for _, x, _ in strings], pa.list_(pa.int64())),
                    pa.array([c if s else None for (_, _, c), s in zip(strings, settled, strict=True)], pa.list_(pa.int32())),
                    pa.array([[i for pair in s for i in pair] for s in settled], pa.list_(pa.int32())),
                ],
                ["key", "n_bytes", "places", "grams", "nexts", "names", "counts", "settled"],
            )

    rows = keyed(docs).where(F.octet_length("text") >= length).select("key", "text")
    found = rows.mapInArrow(run, f"key binary, {_ARRAYS}")
    one = found.groupBy("key").agg(F.count(F.lit(1)).cast("int").alias("copies"), *[F.first(c).alias(c) for c in found.columns[1:]])
    # numbers that stay what they are, as the table is written
    return stage(one.mapInArrow(_numbered, f"doc long, key binary, copies int, {_ARRAYS}"), "anchors")


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``doc``, the position of a text's first anchor: partition number and anchors before it there. The positions of
    the anchors, ``doc + i``, are all different and in the order of documents and places."""
    at = TaskContext.get().partitionId() << 40
    for batch in batches:
        n = batch.column("places").value_lengths().to_numpy().astype(np.int64) + 1
        ends = np.cumsum(n) + at
        yield pa.RecordBatch.from_arrays([pa.array(ends - n), *batch.columns], ["doc", *batch.schema.names])
        at = int(ends[-1]) if len(ends) else at


def keyed(docs: DataFrame) -> DataFrame:
    return narrow(docs).withColumn("key", F.unhex(F.md5(F.col("text").cast("binary"))))


_SORTED = "a long, b long, pos long, i int, copies int, step int, reach int"


def ranked(rows: DataFrame, by: str) -> DataFrame:
    """``rows`` (a, b, pos, i, copies, step, reach), sorted by (a, b, pos), with ``size_a`` and ``size_b``, the copies of all
    rows that share a, or a and b, and ``rank``, the smallest position with this a and b. Only rows whose ``by`` (one of the
    sizes) is more than one are kept. The result is a staged table's rows; it is read with ``.staged``.

    The rows are sorted over range partitions and numbered inside each. A group may be cut by the ranges: the first and last
    group of every partition are marked, and one row for each goes to the driver, which adds up those that belong together.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if len(b)]  # a range partition of narrow rows
        if not held:
            return
        rows = pa.Table.from_batches(held)
        a, b, pos, copies = (rows.column(c).to_numpy() for c in ("a", "b", "pos", "copies"))
        new_a = np.diff(a, prepend=a[:1]) != 0
        new_a[0] = True
        new_b = new_a | (np.diff(b, prepend=b[:1]) != 0)

        def grouped(new: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            first, number = np.flatnonzero(new), np.cumsum(new) - 1
            side = np.where(number == 0, 1, np.where(number == len(first) - 1, 2, 0)).astype(np.int8)
            return first[number], np.add.reduceat(copies.astype(np.int64), first)[number], side

        (_, size_a, side_a), (first, size_b, side_b) = grouped(new_a), grouped(new_b)
        more = {"size_a": size_a, "size_b": size_b, "rank": pos[first], "side_a": side_a, "side_b": side_b, "part": np.full(len(a), TaskContext.get().partitionId(), np.int32)}
        kept = (size_a > 1) | (side_a > 0) if by == "size_a" else (size_b > 1) | (side_b > 0)
        for name, values in more.items():
            rows = rows.append_column(name, pa.array(values))
        yield from rows.filter(pa.array(kept)).combine_chunks().to_batches(max_chunksize=1 << 16)

    in_order = rows.select("a", "b", "pos", "i", "copies", "step", "reach").repartitionByRange("a", "b", "pos").sortWithinPartitions("a", "b", "pos")
    table = stage(in_order.mapInArrow(run, f"{_SORTED}, size_a long, size_b long, rank long, side_a byte, side_b byte, part int"), "ranks")
    cut_a = table.where("side_a > 0").groupBy("part", "side_a").agg(F.first("a").alias("a"), F.first("size_a").alias("n"))
    cut_b = table.where("side_b > 0").groupBy("part", "side_b").agg(F.first("a").alias("a"), F.first("b").alias("b"), F.first("size_b").alias("n"), F.min("rank").alias("rank"))
    # at most two rows a partition each
    cuts = cut_a.withColumnRenamed("side_a", "side").unionByName(cut_b.withColumnRenamed("side_b", "side"), allowMissingColumns=True).collect()
    total, least = {}, {}
    for r in cuts:
        total[r.a, r.b] = total.get((r.a, r.b), 0) + r.n
        least[r.a, r.b] = min(r.rank or 0, least.get((r.a, r.b), r.rank or 0))
    parts = max([r.part for r in cuts], default=0) + 1

    def whole(column: str, side: str, values: dict, level: bool) -> Column:
        """The value of a marked group by partition and side, from an array that Spark folds into a constant."""
        at = [0] * (2 * parts)
        for r in cuts:
            if (r.b is not None) == level:
                at[2 * r.part + r.side - 1] = values[r.a, r.b]
        known = F.split(F.lit(",".join(map(str, at))), ",").cast("array<long>")
        return F.when(F.col(side) > 0, F.get(known, 2 * F.col("part") + F.col(side) - 1)).otherwise(F.col(column)).alias(column)

    sizes = [whole("size_a", "side_a", total, False), whole("size_b", "side_b", total, True), whole("rank", "side_b", least, True)]
    out = table.select("pos", "i", "copies", "step", "reach", *sizes).where(F.col(by) > 1)
    out.staged = table
    return out


def doubled(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """The strings that are still short of twice the ``length``, each with the string that starts at its last anchor: a and b
    are their ranks, step and reach those of both together. A string whose last anchor has no row is unique and goes.

    Both anchors are in one document, so documents are dealt out whole and a row is looked up by position among its own
    document's: each row is sent once and gives one row at most, however many copies its string has.
    """

    def whole(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts)
        held = {c: rows.column(c).to_numpy() for c in ("pos", "i", "copies", "step", "reach", "rank")}
        meets = held["pos"] + held["step"]
        at = np.minimum(np.searchsorted(held["pos"], meets), len(meets) - 1)
        kept = np.flatnonzero((held["pos"][at] == meets) & (held["reach"] < 2 * length))
        at = at[kept]
        a, pos, i, copies, step, reach = (held[c][kept] for c in ("rank", "pos", "i", "copies", "step", "reach"))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (a, held["rank"][at], pos, i, copies, step + held["step"][at], reach - np.int32(gram) + held["reach"][at])],
            ["a", "b", "pos", "i", "copies", "step", "reach"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            doc = batch.column("pos").to_numpy() - batch.column("i").to_numpy()
            last = int(np.searchsorted(doc, doc[-1]))  # rows of the last document wait for the next batch
            if last or (parts and doc[0] != parts[-1].column("pos")[0].as_py() - parts[-1].column("i")[0].as_py()):
                yield from whole([*parts, batch.slice(0, last)])
                parts = []
            parts.append(batch.slice(last))
        if parts:
            yield from whole(parts)

    by_doc = rows.select("pos", "i", "copies", "step", "reach", "rank").repartition(F.col("pos") - F.col("i")).sortWithinPartitions("pos")
    return by_doc.mapInArrow(run, _SORTED)


def certain_repeats(texts: DataFrame, length: int) -> tuple[DataFrame, list[DataFrame]]:
    """Prefix doubling over anchors: one row per ``doc`` and ``i`` with ``size``, the number of places of the anchor's gram
    if that is more than one, or with ``last`` and ``first`` for a repeated string between anchors i and last that reaches
    ``length`` bytes (``first``: no smaller position has the same string); and the staged tables that they are read from."""
    gram = _gram(length)
    # a null list of counts: all anchors are sorted; otherwise those that speak for any
    every = F.sequence(F.lit(0), F.size("grams") - 1)
    speaking = F.when(F.col("counts").isNull(), every).otherwise(F.filter(every, lambda i: F.get("counts", i) > 0))
    spots = texts.select("doc", "copies", "places", "nexts", "names", "grams", "counts", F.explode(speaking).alias("i"))
    places = F.least(F.col("copies").cast("long") * F.coalesce(F.get("counts", F.col("i")), F.lit(1)), F.lit(2**31 - 1)).cast("int")
    following = F.get("nexts", F.col("i"))  # the last anchors of a text have none
    strings = spots.select(
        F.get("grams", F.col("i")).alias("a"), F.coalesce(F.get("names", F.col("i")), F.lit(0)).cast("long").alias("b"),
        (F.col("doc") + F.col("i")).alias("pos"), "i", places.alias("copies"),
        F.coalesce(following - F.col("i"), F.lit(0)).alias("step"),
        F.coalesce(F.get("places", following) + gram - F.get("places", F.col("i")), F.lit(0)).alias("reach"),
    )
    rows = ranked(strings, "size_a")
    doc, none = (F.col("pos") - F.col("i")).alias("doc"), F.lit(None)
    found = rows.select(doc, "i", F.col("size_a").alias("size"), none.cast("int").alias("last"), none.cast("boolean").alias("first"))
    staged = [rows.staged]
    rows = rows.where("step > 0 and size_b > 1")
    while True:
        whole = rows.where(F.col("reach") >= length)
        found = found.unionByName(whole.select(doc, "i", none.cast("long").alias("size"), (F.col("i") + F.col("step")).alias("last"), (F.col("rank") == F.col("pos")).alias("first")))
        short = rows.where(F.col("reach") < 2 * length)
        if short.isEmpty():
            return found, staged
        rows = ranked(doubled(rows, length, gram), "size_b")
        staged.append(rows.staged)


def candidate_starts(n_bytes: int, places: np.ndarray, names: np.ndarray, sizes: np.ndarray, runs: list[tuple[int, int]], length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the strings that may be repeated, and the anchor (its number) with the least gram of each.

    ``sizes`` counts the places of each anchor's gram, 0 where it is not repeated; ``runs`` (first and last anchor) hold
    strings that need no candidate, as an earlier copy speaks for them. Copies are ordered by document and place, so of
    equal strings the first one always has a candidate or an earlier copy in no run.
    """
    n = n_bytes - length + 1
    # the anchors inside a string change at few starts
    edges = np.unique(np.concatenate([[0], places + 1, places - (length - gram)]))
    edges = edges[(edges >= 0) & (edges < n)]
    first = np.searchsorted(places, edges)  # the first anchor not before the start
    beyond = np.searchsorted(places, edges + length - gram, side="right")
    least = np.minimum.reduceat(np.append(names, np.iinfo(np.uint64).max), np.stack([first, beyond], axis=1).ravel())[::2]
    by_name = np.argsort(names, kind="stable")
    anchor = by_name[np.searchsorted(names, least, sorter=by_name)]
    ends = np.append(edges[1:], n)
    hit = np.flatnonzero(sizes[anchor] > 0)
    if not len(hit):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.concatenate([np.arange(edges[k], ends[k]) for k in hit.tolist()])
    anchor = np.repeat(anchor[hit], ends[hit] - edges[hit])
    if runs:
        step = np.zeros(n_bytes + 1, np.int32)
        for a, b in runs:
            step[places[a]] += 1
            step[max(places[a], places[b] + gram - length) + 1] -= 1
        free = np.cumsum(step)[starts] == 0
        starts, anchor = starts[free], anchor[free]
    return starts, anchor


#: Bytes of a string's hash that are sent.
_KEPT = 6


def _packed(hashes: np.ndarray) -> bytes:
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_KEPT].tobytes()


def _unpacked(rows: list[tuple]) -> np.ndarray:
    """The hashes of all rows, told apart by the rows' buckets as well."""
    sizes = [len(r[4]) // _KEPT for r in rows]
    wide = np.zeros((sum(sizes), 8), np.uint8)
    wide[:, :_KEPT] = np.frombuffer(b"".join(r[4] for r in rows), np.uint8).reshape(-1, _KEPT)
    names = np.repeat(np.array([r[1] for r in rows], np.int64).view(_U), sizes)
    return wide.view("<u8").ravel() ^ _mix(names)


def _slices(column: pa.Array):
    """The lists of an Arrow list column as numpy arrays, by row; a null list is empty."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    return lambda i: flat[(ends[i - 1] if i else 0) : ends[i]]


def _whole_buckets(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[list[tuple]]:
    """The rows of sorted batches; rows of one bucket (the second column) come together."""
    held: list[tuple] = []
    for batch in batches:
        held += zip(*(batch.column(c).to_pylist() for c in columns), strict=True)
        ready = next((k for k in range(len(held), 0, -1) if held[k - 1][1] != held[-1][1]), 0)
        if ready:
            yield held[:ready]
            held = held[ready:]
    yield held


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per distinct text with anything to remove: its digest ``key`` and ``spans`` (array of [from, to) byte pairs, sorted,
    neither touching nor overlapping)."""
    gram = _gram(length)
    texts = anchored(docs, length)
    certain, ranks = certain_repeats(texts, length)
    found = certain.groupBy("doc").agg(F.collect_list(F.struct("i", "size", "last", "first")).alias("found"))
    found = found.select("doc", F.filter("found", lambda x: x["size"].isNotNull()).alias("marks"), F.filter("found", lambda x: x["size"].isNull()).alias("runs"))
    known = texts.select("doc", "key", "n_bytes", "copies", "places", "grams", "settled").join(found, "doc")
    arrays = {"marked": "marks.i", "sizes": "marks.size", "runs_from": "runs.i", "runs_to": "runs.last", "runs_first": "runs.first"}
    known = stage(known.select("doc", "key", "n_bytes", "copies", "places", "grams", "settled", *[F.col(c).alias(n) for n, c in arrays.items()]), "known-runs")
    discard(texts, *ranks)

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, group in text_groups(batches):
            out = []
            lists = {c: _slices(batch.column(c)) for c in ("places", "grams", "settled", *arrays)}
            for k, (doc, text) in enumerate(zip(batch.column("doc").to_pylist(), group, strict=True)):
                row = {c: of(k) for c, of in lists.items()}
                raw, places, grams = np.frombuffer(text.encode(), np.uint8), row["places"].astype(np.int64), row["grams"]
                size = np.zeros(len(places), np.int64)
                size[row["marked"]] = row["sizes"]
                others = ~row["runs_first"].astype(bool)
                spoken = list(zip(row["runs_from"][others].tolist(), row["runs_to"][others].tolist(), strict=True))
                for a, b in row["settled"].reshape(-1, 2).tolist():
                    size[a : b + 1] = size[a]
                    spoken.append((a + 1, b))  # a period earlier stands the same
                starts, first = candidate_starts(len(raw), places, grams.view(_U), size, spoken, length, gram)
                if not len(starts):
                    continue
                hashes = hashes_at(raw, starts, length)
                new = (np.diff(first, prepend=-1) != 0) | (np.diff(starts, prepend=-2) != 1)
                edges = [*np.flatnonzero(new).tolist(), len(starts)]
                for a, b in zip(edges, edges[1:], strict=False):
                    anchor = first[a]
                    parts = int(-(-size[anchor] // SPREAD))
                    part = hash((doc, int(places[anchor]))) % parts
                    out.append((doc, int(grams[anchor]) ^ (part << 20), int(starts[a]), None if parts == 1 else (part << 31) | parts, _packed(hashes[a:b])))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc", "bucket", "start", "split", "hashes"])

    def equal_strings(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which stand more than once, and one place of each."""
        order = np.argsort(hashes, kind="stable")
        same = hashes[order[1:]] == hashes[order[:-1]]
        twice = np.zeros(len(order), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        return twice, order[np.concatenate([[True], ~same])]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket. Equal strings share a bucket, so all complete buckets are compared at once; of a
        group that was split, each string goes on once, without a place (doc -1) where its copies are settled here."""

        def settle(rows: list[tuple]) -> pa.RecordBatch:
            out = []
            if rows:
                all_hashes = _unpacked(rows)
                twice, one = equal_strings(all_hashes)
                at = 0
                for doc, _, start, _, hashes in rows:
                    n = len(hashes) // _KEPT
                    if twice[at : at + n].any():
                        hit = np.flatnonzero(twice[at : at + n]) + start
                        out.append((doc, merged(hit, hit + length).ravel(), doc, None, None, None))
                    at += n
                sizes = np.array([len(r[4]) // _KEPT for r in rows])
                row = np.repeat(np.arange(len(rows)), sizes)[one]
                split = np.array([r[3] or 0 for r in rows], np.int64)[row]
                one, row, split = one[split > 0], row[split > 0], split[split > 0]
                if len(one):
                    bucket = np.array([r[1] for r in rows], np.int64)[row]
                    plain = all_hashes[one] ^ _mix(bucket.view(_U))
                    gram, lot = bucket ^ ((split >> 31) << 20), (plain % (split & 0x7FFFFFFF).astype(_U)).astype(np.int64)
                    docs_of = np.where(twice[one], -1, np.array([r[0] for r in rows], np.int64)[row])
                    starts = (np.array([r[2] for r in rows], np.int64) - (np.cumsum(sizes) - sizes))[row] + one
                    bucket = gram ^ (lot << 20)
                    order = np.argsort(bucket, kind="stable")
                    edges = [*np.flatnonzero(np.diff(bucket[order], prepend=~bucket[order[0]])).tolist(), len(order)]
                    for a, b in zip(edges, edges[1:], strict=False):
                        k = order[a:b]
                        out.append((None, None, int(bucket[k[0]]), docs_of[k].astype("<i8").tobytes(), starts[k].astype("<i4").tobytes(), _packed(plain[k])))
            columns = list(zip(*out, strict=True)) or [[]] * 6
            kinds = [pa.int64(), pa.list_(pa.int32()), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc", "spans", "bucket", "docs", "starts", "hashes"])

        for rows in _whole_buckets(batches, ("doc", "bucket", "start", "split", "hashes")):
            yield settle(rows)

    def compare_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The strings of split groups, sorted by bucket; settled spans pass through."""

        def settle(rows: list[tuple]) -> pa.RecordBatch:
            out, rows = [r[5:] for r in rows if r[5] is not None], [r for r in rows if r[5] is None]
            if rows:
                twice, _ = equal_strings(_unpacked(rows))
                docs_of = np.concatenate([np.frombuffer(r[2], "<i8") for r in rows])
                starts = np.concatenate([np.frombuffer(r[3], "<i4") for r in rows])
                hit = np.flatnonzero(twice & (docs_of >= 0))
                hit = hit[np.argsort(docs_of[hit], kind="stable")]
                for k in np.split(hit, np.flatnonzero(np.diff(docs_of[hit])) + 1):
                    if len(k):
                        out.append((int(docs_of[k[0]]), merged(starts[k], starts[k] + length).ravel()))
            return pa.RecordBatch.from_arrays([pa.array([d for d, _ in out], pa.int64()), pa.array([s for _, s in out], pa.list_(pa.int32()))], ["doc", "spans"])

        for rows in _whole_buckets(batches, ("bucket", "bucket", "docs", "starts", "hashes", "doc", "spans")):
            yield settle(rows)

    # copies are combined before the shuffle
    one_each = keyed(docs).where(F.octet_length("text") >= length).groupBy("key").agg(F.first("text").alias("text")).join(known, "key")
    found = one_each.select("doc", "places", "grams", "settled", *arrays, "text").mapInArrow(strings, "doc long, bucket long, start int, split long, hashes binary")
    parts = found.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(compare, "doc long, spans array<int>, bucket long, docs binary, starts binary, hashes binary")
    parts = parts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(compare_parts, "doc long, spans array<int>")

    @F.pandas_udf("array<int>")
    def joined(lists: pd.Series) -> pd.Series:
        def one(flat) -> np.ndarray:
            pairs = np.asarray(flat, np.int32).reshape(-1, 2)
            return merged(pairs[:, 0], pairs[:, 1]).ravel()

        return lists.map(one)

    inside = known.where("size(runs_from) > 0").select("doc", F.zip_with("runs_from", "runs_to", lambda a, b: F.array(F.get("places", a), F.get("places", b) + gram)).alias("s")).select("doc", F.flatten("s").alias("spans"))
    copied = known.where("copies > 1").select("doc", F.expr("array(0, n_bytes)").alias("spans"))
    periodic = known.where("size(settled) > 0").select("doc", F.transform("settled", lambda x, k: F.get("places", x) + F.when(k % 2 == 1, gram).otherwise(0)).alias("spans"))
    every = parts.unionByName(inside).unionByName(copied).unionByName(periodic)
    by_doc = every.groupBy("doc").agg(F.flatten(F.collect_list("spans")).alias("spans")).select("doc", joined("spans").alias("spans"))
    spans = stage(by_doc.join(known.select("doc", "key"), "doc").select("key", "spans"), "repeated-spans")
    discard(known)
    return spans


def merged(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The union of [start, end) pairs as sorted pairs that do not touch."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > reach[:-1]])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)
    return np.stack([starts[new], reach[last]], axis=1)


def _rest(raw: bytes, flat: list[int] | None) -> bytes:
    edges = [0, *(flat or []), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def without_repeats(docs: DataFrame, length: int = LENGTH, removed_col: str = "n_removed") -> DataFrame:
    """``docs`` with all its columns, repeats cut out of ``text``, and the number of removed bytes under ``removed_col``
    (which must be free). A character that loses some of its bytes goes as a whole; a null text stays null."""
    key, found = free_name(docs, "_key"), free_name(docs, "_spans")
    spans = repeated_spans(docs, length).select(F.col("key").alias(key), F.col("spans").alias(found))
    marked = docs.withColumn(key, F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))).join(spans, key, "left")
    names = [*docs.columns, removed_col]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_groups(batches):
            raws = [(t or "").encode() for t in texts]
            rests = [_rest(r, f) for r, f in zip(raws, batch.column(found).to_pylist(), strict=True)]
            removed = [len(r) - len(x) for r, x in zip(raws, rests, strict=True)]
            new = {
                "text": pa.array([x.decode("utf-8", "ignore") if n else t for t, x, n in zip(texts, rests, removed, strict=True)], pa.string()),
                removed_col: pa.array(removed, pa.int64()),
            }
            yield pa.RecordBatch.from_arrays([new[c] if c in new else batch.column(c) for c in names], names)

    return marked.select(*docs.columns, found).mapInArrow(cut, StructType([*docs.schema, StructField(removed_col, LongType())]))


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, ``spans`` (removed [from, to) byte pairs, flattened) and ``kept``, the bytes
    that remain.

    A null or empty text has no bytes; a text shorter than ``length`` keeps all of them. Rows with equal texts are each
    other's repeats and lose everything from ``length`` bytes on. Null and repeated doc_ids are rows like any other;
    other columns are ignored; an empty table gives no rows.
    """
    spans = repeated_spans(docs, length)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_groups(batches):
            kept, sizes = [], []
            for text, flat in zip(texts, batch.column("spans").to_pylist(), strict=True):
                raw = text.encode()
                kept.append(_rest(raw, flat))
                sizes.append(len(raw))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), batch.column("spans"), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    joined = keyed(docs).join(spans, "key", "left").select("doc_id", "text", F.coalesce("spans", F.array().cast("array<int>")).alias("spans"))
    return joined.mapInArrow(cut, "doc_id long, n_bytes long, spans array<int>, kept binary")
