"""Near-duplicate vectors by a pivot-permutation index.

A vector is described by its NEAREST closest reference points (pivots) in their order. Near vectors share pivots at low
places: two vectors are candidates if there are SHARED pivots that both have, with places that add up to no more than the
least possible sum plus SLACK, in either vector. Each vector is entered in the inverted list of every such set of its
pivots, so two vectors meet in some list exactly if that many shared pivots stand that far in front. A pair is verified in
one list only, that of the smallest set that both are entered under.

A list is never expanded into pairs of rows. Its vectors are cut into blocks of BLOCK, and each pair of blocks is one
matrix product; what leaves a task is one count and one link per vector. Equal vectors are one entry with a weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.components import components
from tidewheel.session import stage

#: The reference points are at most this many vectors for up to PIVOT_ROWS vectors and grow with their number's fourth root,
#: as a list is named by four pivots. They are taken from four times as many that a hash picks. None is within APART of
#: another, so a large group of copies does not supply them all: its vectors would order them by noise.
PIVOTS = 256
PIVOT_ROWS = 1 << 16
APART = 0.8
NEAREST = 10
SHARED = 4
SLACK = 8
#: Bits of a pivot's number in the name of a list.
_BITS = 15
COSINE = 0.95
BLOCK = 1024


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id``, ``vector`` (array<double>) and whether it can link: not null, not zero, all components finite."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    moving = F.exists(x, lambda c: c != 0)
    return vectors.select(F.col(id_col).alias("vec_id"), x.alias("vector"), F.coalesce(finite & moving, F.lit(False)).alias("usable"))


def unit(rows: list) -> np.ndarray:
    """Rows of doubles as unit vectors; scaled first, so that no square overflows or vanishes."""
    x = np.array(rows, np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def pivot_sets(nearest: int, shared: int, slack: int) -> np.ndarray:
    """The sets of ``shared`` places in a permutation of ``nearest`` pivots whose sum is the least possible plus ``slack`` at most."""
    least = shared * (shared - 1) // 2
    return np.array([c for c in combinations(range(nearest), shared) if sum(c) <= least + slack])


def list_names(near: np.ndarray, sets: np.ndarray) -> np.ndarray:
    """The lists that vectors with the permutations ``near`` are entered in: the pivots of each set in ascending order, as one number."""
    chosen = np.sort(near.astype(np.int64)[:, sets], axis=2)
    return (chosen << (_BITS * np.arange(sets.shape[1])[::-1])).sum(axis=2)


def described(classes: DataFrame, reference: np.ndarray, sets: np.ndarray, nearest: int) -> DataFrame:
    """``node``, ``copies``, ``unit`` (bytes of the unit vector), ``pivots`` (the numbers of the ``nearest`` reference points,
    nearest first) and ``keys``, the names of its lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.slice(at, 4096)
                x = unit(part.column("vector").to_pylist())
                near = np.argsort(-(x @ reference.T), axis=1, kind="stable")[:, :nearest]
                made = [pa.array([r.tobytes() for r in x], pa.binary()), pa.array(list(near.astype(np.int32)), pa.list_(pa.int32())), pa.array(list(list_names(near, sets)), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([part.column("node"), part.column("copies"), *made], ["node", "copies", "unit", "pivots", "keys"])

    return classes.select("node", "copies", "vector").mapInArrow(run, "node long, copies long, unit binary, pivots array<int>, keys array<long>")


def entered_first(a: np.ndarray, b: np.ndarray, sets: np.ndarray, slack: int) -> np.ndarray:
    """For pairs of permutations (rows of ``a`` and ``b``): the smallest name of a list that both are entered in."""
    same = a[:, :, None] == b[:, None, :]
    place = np.where(same.any(axis=2), same.argmax(axis=2), 10_000)
    both = place[:, sets].sum(axis=2) <= sets.shape[1] * (sets.shape[1] - 1) // 2 + slack
    return np.where(both, list_names(a, sets), np.iinfo(np.int64).max).min(axis=1)


def _roots(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest id reachable from each of ``ids`` by the links (i, j)."""
    root = ids.copy()
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        if (new == root).all():
            return root
        root = new


def verified(batches: Iterator[pa.RecordBatch], cosine: float, sets: np.ndarray, slack: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (key, low, high); each such group holds one or two blocks of a list.

    Gives, for each vector with links in a group, the weight of the vectors linked to it and a vector that it reaches."""

    def links(rows: list[tuple]) -> list[tuple[int, int, int]]:
        key, low, high = rows[0][:3]
        ids, copies = (np.array([r[k] for r in rows], np.int64) for k in (4, 7))
        block = np.array([r[3] for r in rows])
        x, near = np.stack([np.frombuffer(r[5], np.float64) for r in rows]), np.array([r[6] for r in rows])
        a, b = np.flatnonzero(block == low), np.flatnonzero(block == high)
        i, j = np.nonzero(x[a] @ x[b].T >= cosine)
        i, j = a[i], b[j]
        if low == high:
            i, j = i[i < j], j[i < j]
        # a pair counts in one list: that of the smallest set under which both are entered
        first = [entered_first(near[i[at : at + 8192]], near[j[at : at + 8192]], sets, slack) for at in range(0, len(i), 8192)]
        once = np.concatenate([np.zeros(0, np.int64), *first]) == key
        i, j = i[once], j[once]
        if not len(i):
            return []
        n = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
        root, linked = _roots(ids, i, j), np.unique(np.concatenate([i, j]))
        return list(zip(ids[linked].tolist(), n[linked].astype(np.int64).tolist(), root[linked].tolist(), strict=True))

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["node", "n", "root"])

    held: list[tuple] = []
    names = ("key", "low", "high", "block", "node", "unit", "pivots", "copies")
    for batch in batches:
        out: list[tuple] = []
        for r in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            if held and held[0][:3] != r[:3]:
                out += links(held)
                held = []
            held.append(r)
        yield batch_of(out)
    if held:
        yield batch_of(links(held))


def spread_out(units: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of the vectors, each with a cosine below APART to those before it."""
    chosen: list[np.ndarray] = []
    for x in units:
        if len(chosen) < most and (not chosen or (np.stack(chosen) @ x).max() < APART):
            chosen.append(x)
    return np.stack(chosen)


def linked(classes: DataFrame, cosine: float, pivots: int, nearest: int, shared: int, slack: int) -> DataFrame:
    """Links of ``classes`` (node, copies, vector), all of one size: ``node``, ``n`` and ``root`` for each node and list."""
    pivots = int(min(1 << _BITS, pivots * max(1.0, classes.count() / PIVOT_ROWS) ** 0.25))
    sample = classes.orderBy(F.xxhash64("vector"), "node").limit(4 * pivots).select("vector").collect()  # bounded by ``pivots``
    reference = spread_out(unit([r.vector for r in sample]), pivots)
    nearest = min(nearest, len(reference))
    sets = pivot_sets(nearest, min(shared, nearest), slack)
    rows = stage(described(classes, reference, sets, nearest), "pivots")
    lists = rows.select("node", F.explode("keys").alias("key"))
    rows = rows.drop("keys")
    # most lists hold a single vector
    sizes = lists.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK)
    placed = lists.join(sizes, "key").select("node", "key", blocks.alias("blocks"), F.pmod(F.xxhash64("node", "key"), blocks).alias("block"))
    pairs = placed.select("node", "key", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    pairs = pairs.select("node", "key", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    groups = pairs.join(rows, "node").repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return stage(groups.mapInArrow(lambda it: verified(it, cosine, sets, slack), "node long, n long, root long"), "vector-links")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, pivots: int = PIVOTS, nearest: int = NEAREST, shared: int = SHARED, slack: int = SLACK) -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links (other rows linked directly), component_id (the smallest vec_id reachable,
    itself included) and kept (vec_id = component_id).

    Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing; vectors link only with
    others of their size. Equal vectors link with each other. A null vec_id counts after all others; rows that share a
    vec_id are rows like any other. Other columns are ignored; an empty table gives no rows. ``shared`` is 4 at most.
    """
    if not 1 <= shared <= 4:
        raise ValueError("lists are named by one to four pivots")
    rows = stage(usable(vectors, id_col, vector_col), "vectors")
    classes = rows.where("usable").groupBy("vector").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    classes = stage(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    sizes = [r.size for r in classes.select(F.size("vector").alias("size")).distinct().collect()]  # as many as there are dimensions
    found = [linked(classes.where(F.size("vector") == size), cosine, pivots, nearest, shared, slack) for size in sizes]
    known = classes.select("node", "vector", "copies", "least")
    if found:
        links = found[0]
        for more in found[1:]:
            links = links.unionByName(more)
        counts = links.groupBy("node").agg(F.sum("n").alias("n"))
        roots = components(links, "node", "root")
        known = known.join(counts, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        group = known.groupBy("root").agg(F.min("least").alias("component"))
        known = known.join(group, "root").select("vector", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), "component")
    else:
        known = known.select("vector", "copies", F.lit(None).cast("long").alias("component")).withColumnRenamed("copies", "n")
    out = rows.withColumn("vector", F.when(F.col("usable"), F.col("vector"))).join(known, "vector", "left")
    out = out.withColumn("component_id", F.when(F.col("usable"), F.col("component")).otherwise(F.col("vec_id")))
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
