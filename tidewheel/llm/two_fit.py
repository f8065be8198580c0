"""Best-two-fit packing of whole documents into fixed windows, planned on the histogram of their lengths.

A window is filled greedily with the longest unpacked documents that still fit. Then, as long as it helps, its smallest
document is replaced by two unpacked ones that fit the gap it would leave more tightly: of all pairs that are longer
together and still fit, the longest.

Documents of equal length are interchangeable, so the plan is made from the counts of lengths alone: a filling is
repeated for as many windows as the counts allow every one of its steps to be taken again, which gives the same windows as
filling them one by one. The histogram has at most ``window`` rows however many documents there are, and every filling
uses up at least one length, so the plan is bounded by the window, not by the data.

1. Tasks encode texts and write one narrow row per piece, with its number among the task's pieces of that length.
2. Counts per task and length, summed over earlier tasks, make that a number among all pieces of the length.
3. The plan says for each length which numbers go to which windows. It is given to all tasks (a bounded table), and each
   piece looks its place up. Texts are read once and never shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.llm.frames import crc, narrow, text_groups
from tidewheel.llm.tokens import word_tokens
from tidewheel.session import stage

WINDOW = 4096

# A filling: its (length, documents) runs, longest first, and how many windows are filled that way.
Filling = tuple[list[tuple[int, int]], int]


def _below(counts: np.ndarray) -> np.ndarray:
    """For each number of ids the greatest length of an unpacked document that is no longer (0: none)."""
    return np.maximum.accumulate(np.where(counts > 0, np.arange(len(counts)), 0))


def _tighter_pair(counts: np.ndarray, below: np.ndarray, least: int, most: int) -> tuple[int, int] | None:
    """Two unpacked documents that are longer than ``least`` together and at most ``most``: the longest such pair, and of
    equal ones that with the longest document."""
    lengths = np.flatnonzero(counts[:most])
    if not len(lengths):
        return None
    partner = below[most - lengths]
    alone = (partner == lengths) & (counts[lengths] < 2)
    partner[alone] = below[lengths[alone] - 1]
    total = np.where(partner > 0, lengths + partner, 0)
    best = len(total) - 1 - int(np.argmax(total[::-1]))
    return (int(lengths[best]), int(partner[best])) if total[best] > least else None


def plan(histogram: dict[int, int], window: int = WINDOW) -> list[Filling]:
    """The fillings for ``histogram`` (length: documents; lengths of 1 .. window)."""
    counts = np.zeros(window + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    fillings: list[Filling] = []
    below = _below(counts)
    while below[window]:
        before = counts.copy()
        held: Counter[int] = Counter()
        most: Counter[int] = Counter()  # the most documents of a length that any step of this filling holds
        room = window
        while length := int(below[room]):
            n = min(int(counts[length]), room // length)
            held[length] += n
            counts[length] -= n
            room -= n * length
            if not counts[length]:
                below = _below(counts)
        most |= held
        while room and sum(held.values()) > 1:
            smallest = min(held)
            pair = _tighter_pair(counts, below, smallest, smallest + room)
            if pair is None:
                break
            held[smallest] -= 1
            counts[smallest] += 1
            held = +held
            for length in pair:
                held[length] += 1
                counts[length] -= 1
            room -= sum(pair) - smallest
            below = _below(counts)
            most |= held
        times = min(int(before[length]) // n for length, n in most.items())
        counts = before
        for length, n in held.items():
            counts[length] -= n * times
        below = _below(counts)
        fillings.append((sorted(held.items(), reverse=True), times))
    return fillings


class Places:
    """Where the pieces of each length go: looks up (sequence, offset) by length and number among that length."""

    def __init__(self, fillings: list[Filling]):
        rows = []
        first = 0
        for runs, times in fillings:
            at = 0
            for length, n in runs:
                rows.append((length, n, times, first, at))
                at += n * length
            first += times
        table = np.array(rows, np.int64).reshape(-1, 5)
        table = table[np.argsort(table[:, 0], kind="stable")]
        length, self.each, times, self.first, self.at = table.T
        held = self.each * times
        total = np.cumsum(held) - held
        new = np.diff(length, prepend=-1) != 0
        self.start = total - np.maximum.accumulate(np.where(new, total, 0))  # number of the first document of a run
        self.keys = self._key(length, self.start)

    @staticmethod
    def _key(length: np.ndarray, number: np.ndarray) -> np.ndarray:
        return (length.astype(np.int64) << 44) | number  # fewer than 2**44 documents of a length

    def look_up(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = np.searchsorted(self.keys, self._key(length, number), side="right") - 1
        inside = number - self.start[row]
        sequence, slot = np.divmod(inside, self.each[row])
        return self.first[row] + sequence, self.at[row] + slot * length


def cut_pieces(docs: DataFrame, path: str, end_id: int, window: int, digest: bool) -> DataFrame:
    """One row per piece, with the task that made it and its number among the task's pieces of that length."""
    body = "ids_crc32 long" if digest else "ids array<int>"
    schema = f"doc_id long, piece int, start long, length int, {body}, doc_tokens long, part int, number long"
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64() if digest else pa.list_(pa.int32()), pa.int64(), pa.int32(), pa.int64()]
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, tokens, seen = TaskContext.get().partitionId(), word_tokens(path), np.zeros(window + 1, np.int64)
        for batch, texts in text_groups(batches):
            rows = []
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), tokens.ids(texts), strict=True):
                ids = np.append(found, np.uint32(end_id))
                for piece, start in enumerate(range(0, len(ids), window)):
                    cut = ids[start : start + window]
                    rows.append((doc_id, piece, start, len(cut), crc(cut.astype("<u4").tobytes()) if digest else cut, len(ids), part, int(seen[len(cut)])))
                    seen[len(cut)] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
        tokens.clear()

    return narrow(docs).mapInArrow(run, schema)


def pack(docs: DataFrame, path: str, end_id: int = 1, window: int = WINDOW, digest: bool = False) -> DataFrame:
    """One row per piece of a document: ``doc_id``, ``piece`` (from 0), ``start`` (ids of its document before it),
    ``length``, its ids (with ``digest`` as ``ids_crc32``, of little-endian unsigned 32-bit ids), ``doc_tokens``, and its
    place: ``sequence_id`` (from 0, gapless) and ``offset`` there.

    A document is its ids and ``end_id``, so a null or empty text is one id. Only a document longer than ``window`` is
    cut: into whole windows and a rest, which is packed like a document. Null and repeated doc_ids and repeated rows are
    documents like any other; other columns are ignored; an empty table gives no rows. Documents of equal length are
    taken in the order in which tasks met them.
    """
    pieces = stage(cut_pieces(docs, path, end_id, window, digest), "pieces")
    # one row per task and length, at most as many as pieces; a length is spread over all tasks that met it
    counts = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(counts.select("length", "part", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "length-offsets")
    histogram = offsets.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most ``window`` rows
    places = Places(plan({r["length"]: r["n"] for r in histogram}, window))

    body = "ids_crc32 long" if digest else "ids array<int>"
    schema = f"doc_id long, piece int, start long, length long, {body}, doc_tokens long, sequence_id long, offset long"
    kept = ["doc_id", "piece", "start", "length", body.split()[0], "doc_tokens"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = places.look_up(batch.column("length").to_numpy(), batch.column("number").to_numpy())
            columns = [batch.column(c) for c in kept] + [pa.array(c, pa.int64()) for c in found]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in schema.split(", ")])

    # (part, length) is one task's pieces at most, whatever the size of a length
    numbered = pieces.join(offsets.drop("n"), ["part", "length"])
    numbered = numbered.select(*[F.col(c).cast("long") if c == "length" else F.col(c) for c in kept], (F.col("before") + F.col("number")).alias("number"))
    return numbered.mapInArrow(place, schema)
