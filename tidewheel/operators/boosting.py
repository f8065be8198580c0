"""Boosted regression trees on binned columns, for squared and absolute errors and for counts.

Rows are binned once and written in blocks; missing values have a bin of their own. A level of a tree is one pass: every
task adds its rows' gradients up by node, column and bin, the sums are added up in a tree of tasks, and the driver, which
sees nothing that grows with the rows, picks the splits. Where a missing value goes is chosen with the split. Leaves hold
Newton steps, except for absolute errors, where a further three passes find the medians of what is left in each leaf.

Scores are worked out again from the trees of the last REWRITE rounds in every pass, so a lost executor costs a re-read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidewheel.session import discard, shuffle_partitions, stage

#: The bin of nulls and NaN; columns have fewer bins.
MISSING = 255
BLOCK = 8192
REWRITE = 32
LOSSES = ("squared", "absolute", "poisson")
#: Bits of a value that a pass of the search for medians settles.
_DIGIT, _DIGITS = 12, 3


@dataclass
class Tree:
    """Node k has the children 2k + 1 (bins up to ``cut``) and 2k + 2; ``column`` is -1 where it has none."""

    column: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray

    @classmethod
    def of_depth(cls, depth: int) -> Tree:
        n = (2 << depth) - 1
        return cls(np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, bool), np.zeros(n))

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The last node that each row of ``bins`` reaches."""
        at, every = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for _ in range((len(self.column) + 1).bit_length() - 2):
            column = self.column[at]
            b = bins[every, column]
            right = np.where(b == MISSING, ~self.missing_left[at], b > self.cut[at])
            at = np.where(column >= 0, 2 * at + 1 + right, at)
        return at


@dataclass
class Boosted:
    """``start`` plus the values of the leaves that a row falls into; counts are the exponential of that."""

    numbers: list[str]
    edges: list[np.ndarray]
    loss: str
    start: float = 0.0
    trees: list[Tree] = field(default_factory=list)

    def binned(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        out = np.empty((len(columns[0]) if columns else 0, len(self.edges)), np.uint8)
        for k, (x, edges) in enumerate(zip(columns, self.edges, strict=True)):
            out[:, k] = np.where(np.isnan(x), MISSING, np.searchsorted(edges, x))
        return out

    def added(self, bins: np.ndarray, since: int = 0) -> np.ndarray:
        """What the trees from number ``since`` on add to the score."""
        out = np.zeros(len(bins))
        for tree in self.trees[since:]:
            out += tree.value[tree.nodes(bins)]
        return out

    def predict(self, df: DataFrame, name: str = "pred") -> DataFrame:
        """``df`` with all its columns and the prediction under ``name``, which must be free."""
        inputs = [f"_x{k}_{name}" for k in range(len(self.numbers))]
        kept = df.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                score = np.full(len(batch), self.start)
                if self.trees:
                    score += self.added(self.binned([_doubles(batch.column(c)) for c in inputs]))
                score = np.exp(score) if self.loss == "poisson" else score
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(score)], [*kept, name])

        wide = df.withColumns({x: F.col(f"`{c}`").cast("double") for x, c in zip(inputs, self.numbers, strict=True)})
        return wide.mapInArrow(run, StructType([*df.schema, StructField(name, DoubleType())]))


def _doubles(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.float64)


def _gradients(loss: str, y: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if loss == "poisson":
        mean = np.exp(score)
        return mean - y, mean
    return (score - y if loss == "squared" else np.sign(score - y)), np.ones(len(y))


def best_splits(sums: np.ndarray, l2: float, least: int) -> list[tuple[int, int, bool] | None]:
    """The best (column, cut, missing to the left) of each node, or None where no split gains anything.

    ``sums`` (node, column, bin, 3) holds gradients, second derivatives and rows. Ties go to the smallest column and cut."""
    out = []
    for node in sums:
        total = node[0].sum(axis=0)
        missing, below = node[:, MISSING:, :], np.cumsum(node[:, :MISSING, :], axis=1)
        best, gain = None, 1e-9 * max(1.0, abs(total[0]))
        for left, to_left in ((below, False), (below + missing, True)):
            right = total - left
            fair = (left[..., 2] >= least) & (right[..., 2] >= least)
            found = left[..., 0] ** 2 / (left[..., 1] + l2 + 1e-300) + right[..., 0] ** 2 / (right[..., 1] + l2 + 1e-300) - total[0] ** 2 / (total[1] + l2 + 1e-300)
            found = np.where(fair, found, -np.inf)
            at = np.unravel_index(np.argmax(found), found.shape)
            if found[at] > gain:
                best, gain = (int(at[0]), int(at[1]), to_left), found[at]
        out.append(best)
    return out


def _in_order(x: np.ndarray) -> np.ndarray:
    """Doubles as unsigned numbers in the same order."""
    bits = np.ascontiguousarray(x + 0.0).view(np.uint64)
    return np.where(bits >> np.uint64(63), ~bits, bits | np.uint64(1 << 63))


def _from_order(u: np.ndarray) -> np.ndarray:
    bits = np.where(u >> np.uint64(63), u & np.uint64((1 << 63) - 1), ~u)
    return bits.view(np.float64)


class _Blocks:
    """Binned rows in blocks: n, bins, y and the score of the trees up to the last rewriting."""

    def __init__(self, table: DataFrame, model: Boosted):
        self.table, self.model, self.since = table.persist(StorageLevel.MEMORY_AND_DISK), model, 0
        self.staged = table
        self.fan = max(1, int(shuffle_partitions(table.sparkSession) ** 0.5))

    def _read(self) -> Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        model, since, width = self.model, self.since, len(self.model.edges)

        def read(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            for bins, y, score in zip(*(batch.column(c).to_pylist() for c in ("bins", "y", "score")), strict=True):
                b = np.frombuffer(bins, np.uint8).reshape(-1, width)
                yield b, np.frombuffer(y), np.frombuffer(score) + model.added(b, since)

        return read

    def total(self, size: int, work: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over all blocks of an array of ``size`` numbers, by task first, then by groups of tasks."""
        read = self._read()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(size)
            for batch in batches:
                for block in read(batch):
                    out += work(*block).ravel()
            yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["sums"])

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(size)
            for batch in batches:
                for part in batch.column("sums"):
                    out += np.frombuffer(part.as_buffer())
            yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["sums"])

        parts = self.table.mapInArrow(run, "sums binary").repartition(self.fan).mapInArrow(merge, "sums binary").collect()  # as many as ``fan``
        return np.sum([np.frombuffer(r.sums) for r in parts], axis=0) if parts else np.zeros(size)

    def rewrite(self) -> None:
        """Write the scores so far, so that a pass evaluates the trees after them only."""
        read = self._read()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                score = pa.array([s.tobytes() for _, _, s in read(batch)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("bins"), batch.column("y"), score], ["bins", "y", "score"])

        before, now = self.staged, stage(self.table.mapInArrow(run, "bins binary, y binary, score binary"), "boosting")
        self.close()
        self.staged, self.table, self.since = now, now.persist(StorageLevel.MEMORY_AND_DISK), len(self.model.trees)
        discard(before)

    def close(self) -> None:
        self.table.unpersist()


def _leaf_medians(blocks: _Blocks, tree: Tree) -> np.ndarray:
    """The lower median of y minus score in every node where rows end, by leading bits: three passes settle 36 bits, that is
    24 of the fraction. Every other node has 0."""
    n, wide = len(tree.column), 1 << _DIGIT
    prefix, rank, held = np.zeros(n, np.uint64), np.zeros(n), np.zeros(n, bool)
    for digit in range(_DIGITS):
        shift, known = np.uint64(64 - _DIGIT * (digit + 1)), prefix

        def work(bins, y, score, shift=shift, known=known, digit=digit):
            at, u = tree.nodes(bins), _in_order(y - score) >> shift
            if digit:
                inside = (u >> np.uint64(_DIGIT)) == known[at]
                at, u = at[inside], u[inside]
            return np.bincount(at * wide + (u & np.uint64(wide - 1)).astype(np.int64), minlength=n * wide).astype(float)

        counts = np.cumsum(blocks.total(n * wide, work).reshape(n, wide), axis=1)
        if not digit:
            held = counts[:, -1] > 0
            rank = np.floor((counts[:, -1] - 1) / 2)
        place = (counts <= rank[:, None]).sum(axis=1).clip(max=wide - 1)
        rank = rank - np.where(place > 0, counts[np.arange(n), np.maximum(place - 1, 0)], 0)
        prefix = (prefix << np.uint64(_DIGIT)) | place.astype(np.uint64)
    middle = (prefix << shift) | (np.uint64(1) << (shift - np.uint64(1)))
    return np.where(held, _from_order(np.where(held, middle, np.uint64(1 << 63))), 0.0)


def fit_boosted(
    df: DataFrame, label: str, numbers: Sequence[str], loss: str = "squared", rounds: int = 10, depth: int = 5, rate: float = 0.1, bins: int = 64, l2: float = 1.0, least: int = 30
) -> Boosted:
    """Fit trees to ``label``. ``loss``: "squared", "absolute", or "poisson" for counts (log link). A leaf has at least
    ``least`` rows; a column has at most ``bins`` bins between approximate quantiles (all its values, if they are fewer).

    Rows with a null or NaN label are left out; null and NaN numbers are missing values; a column without values never
    splits. Without rows, or without columns, the model has no trees and gives its start: 0, the mean, the median, or the
    logarithm of the mean. Other columns are ignored.
    """
    if loss not in LOSSES:
        raise ValueError(f"loss is one of {', '.join(LOSSES)}")
    if not 2 <= bins < MISSING:
        raise ValueError(f"bins lie between 2 and {MISSING - 1}")
    names, y = [f"_x{k}" for k in range(len(numbers))], F.col(f"`{label}`").cast("double")
    rows = df.select(y.alias("_y"), *[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)).alias(x) for x, c in zip(names, numbers, strict=True)])
    rows = stage(rows.where("_y is not null and not isnan(_y)"), "boosting-rows")
    start = rows.agg(F.percentile_approx("_y", 0.5, 10_000).alias("m") if loss == "absolute" else F.avg("_y").alias("m")).first().m or 0.0
    if loss == "poisson":
        if rows.where("_y < 0").limit(1).count():
            raise ValueError("counts are not negative")
        start = float(np.log(max(start, 1e-9)))
    cuts = rows.approxQuantile(names, [k / bins for k in range(1, bins)], 1 / (4 * bins)) if names else []
    model = Boosted(list(numbers), [np.unique(c) for c in cuts], loss, float(start))
    if not names:
        return model

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                part = batch.slice(at, BLOCK)
                found = model.binned([_doubles(part.column(x)) for x in names])
                cells = [found.tobytes(), _doubles(part.column("_y")).tobytes(), np.full(len(part), model.start).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cells], ["bins", "y", "score"])

    blocks = _Blocks(stage(rows.mapInArrow(pack, "bins binary, y binary, score binary"), "boosting"), model)
    discard(rows)
    try:
        for _ in range(rounds):
            tree = _grown(blocks, model, depth, l2, least)
            if loss == "absolute":
                tree.value = _leaf_medians(blocks, tree)
            tree.value = tree.value * rate
            model.trees.append(tree)
            if len(model.trees) - blocks.since >= REWRITE:
                blocks.rewrite()
    finally:
        blocks.close()
    discard(blocks.staged)
    return model


def _grown(blocks: _Blocks, model: Boosted, depth: int, l2: float, least: int) -> Tree:
    tree, width = Tree.of_depth(depth), len(model.edges)
    for level in range(depth):
        first, n = (1 << level) - 1, 1 << level
        if level and not (tree.column[(first - 1) // 2 : first] >= 0).any():
            break

        def work(bins, y, score, first=first, n=n):
            g, h = _gradients(model.loss, y, score)
            at = tree.nodes(bins) - first
            here = (at >= 0) & (at < n)
            bins, at, out = bins[here], at[here] * (MISSING + 1), np.empty((n, width, MISSING + 1, 3))
            for k in range(width):
                cell = at + bins[:, k]
                for j, weight in enumerate((g[here], h[here], None)):
                    out[:, k, :, j] = np.bincount(cell, weight, n * (MISSING + 1)).reshape(n, -1)
            return out

        sums = blocks.total(n * width * (MISSING + 1) * 3, work).reshape(n, width, MISSING + 1, 3)
        node = sums[:, 0].sum(axis=1)
        if not level:
            tree.value[0] = -node[0, 0] / (node[0, 1] + l2 + 1e-300)
        for k, split in enumerate(best_splits(sums, l2, least)):
            if split is None:
                continue
            at, (column, cut, to_left) = first + k, split
            tree.column[at], tree.cut[at], tree.missing_left[at] = split
            left = sums[k, column, : cut + 1].sum(axis=0) + (sums[k, column, MISSING] if to_left else 0)
            for child, (g, h, _) in ((2 * at + 1, left), (2 * at + 2, node[k] - left)):
                tree.value[child] = -g / (h + l2 + 1e-300)
    return tree
