"""Near-duplicate documents by a multi-index Hamming join of b-bit MinHash signatures.

A signature is ``SYMBOLS`` minima of hashed shingles, cut to ``SYMBOL_BITS`` bits each. Two signatures that differ in at
most ``DISTANCE`` symbols must, by the pigeonhole principle, differ in at most DISTANCE // CHUNKS symbols within one of
CHUNKS parts. So every signature is entered under each part with each allowed set of symbols left out, and all pairs
within the distance meet under some key. A pair at a similarity of 0.8 differs in 12.8 of the 64 symbols on average; the
distance of 25 is four standard deviations away (about 1 in 10,000 such pairs is missed, and far fewer of closer ones).
For lower thresholds ``distance_of`` takes a wider distance and more parts. Links are then confirmed on the full shingle
sets.

No group is expanded into all its pairs:

* documents with equal shingle sets are one node;
* under each key every node is compared with one centre, the one with the smallest number, which keys of the same nodes
  share; further searches work on the components found so far, not on their nodes;
* what is left are pairs within a cluster of nodes that keys tie together, in different components so far. A node's
  shingles that nobody else in the cluster has bound its similarity to all of them. Nodes outside the largest component
  that the bound does not settle meet all others in blocks of BLOCK: a pair of blocks is one product of incidence
  matrices, which counts common shingles exactly, and what leaves a task is one link for each node and component.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.components import components
from tidewheel.llm.frames import narrow, text_digest, text_groups
from tidewheel.session import discard, stage

SYMBOLS = 64
SYMBOL_BITS = 16
DISTANCE = 25
CHUNKS = 13
#: Most nodes on one side of a comparison of blocks, and most shingles in one product of matrices.
BLOCK, COLUMNS = 512, 4096
#: Words of a shingle and the least similarity in hundredths.
WIDTH, PERCENT = 5, 80

_U = np.uint64
_random = np.random.default_rng(20240229)
_PLACES = _random.integers(0, 2**64, 1024, dtype=_U) | _U(1)
_MULTIPLY = _random.integers(0, 2**64, SYMBOLS, dtype=_U) | _U(1)
_EXCLUDE = _random.integers(0, 2**64, SYMBOLS, dtype=_U)
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words (runs of anything but ASCII white space) after A-Z is lowered."""
    raw = np.frombuffer(text.encode().translate(_LOWER), np.uint8)
    if not len(raw):
        return np.zeros(0, _U)
    inside = ~_BLANK[raw]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, _U)
    # the places of all bytes in their words, one word after the other
    sizes = ends - starts
    firsts = np.cumsum(sizes) - sizes
    place = np.arange(sizes.sum()) - np.repeat(firsts, sizes)
    out = np.add.reduceat((raw[inside].astype(_U) + _U(1)) * _PLACES[place & 1023], firsts, dtype=_U)
    for i in np.flatnonzero(sizes > 1024):
        out[i] = int.from_bytes(hashlib.blake2b(raw[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return _mix(out + sizes.astype(_U))


def shingle_set(text: str, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a text of fewer words is one shingle, one without words has none."""
    words = word_hashes(text)
    n = min(width, len(words))
    if not n:
        return words
    h = np.full(len(words) - n + 1, n, _U)
    for j in range(n):
        h = _mix(h * _U(0x9E3779B97F4A7C15) + words[j : len(words) - n + 1 + j])
    return np.unique(h)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The lowest value of each of SYMBOLS permutations, cut to SYMBOL_BITS bits; empty for an empty set."""
    if not len(shingles):
        return np.zeros(0, np.int32)
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, _U)
    for at in range(0, len(shingles), 2048):
        part = shingles[at : at + 2048]
        least = np.minimum(least, ((part[None, :] ^ _EXCLUDE[:, None]) * _MULTIPLY[:, None]).min(axis=1))
    return (_mix(least) >> _U(64 - SYMBOL_BITS)).astype(np.int32)


def digested(docs: DataFrame) -> DataFrame:
    return narrow(docs).withColumn("digest", text_digest("text"))


def signatures(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per row of ``docs``: doc_id, ``digest`` (of its text), n_shingles, ``node`` (a 128-bit digest of the shingle set,
    null for an empty one) and ``sig``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_groups(batches):
            sets = [shingle_set(t, width) for t in texts]
            nodes = [hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"), pa.array(list(map(len, sets)), pa.int64()), pa.array(nodes, pa.string()), pa.array([signature(s) for s in sets], pa.list_(pa.int32()))],
                ["doc_id", "digest", "n_shingles", "node", "sig"],
            )

    return digested(docs).mapInArrow(run, "doc_id long, digest binary, n_shingles long, node string, sig array<int>")


def distance_of(percent: int) -> tuple[int, int]:
    """The distance four standard deviations beyond the mean of pairs on the threshold, DISTANCE at least, and the parts
    that leave one wrong symbol in each."""
    apart = 1 - percent / 100
    distance = max(DISTANCE, int(SYMBOLS * apart + 4 * (SYMBOLS * apart * (1 - apart)) ** 0.5))
    if not 0 < percent <= 100 or distance >= SYMBOLS:
        raise ValueError(f"signatures of {SYMBOLS} symbols cannot find all pairs at {percent} percent")
    return distance, max(CHUNKS, distance // 2 + 1)


def chunk_keys(sig: str = "sig", symbols: int = SYMBOLS, distance: int = DISTANCE, chunks: int = CHUNKS) -> Column:
    """One key for each part of the signature and each set of symbols that may be wrong in it."""
    edges = [round(i * symbols / chunks) for i in range(chunks + 1)]
    keys = []
    for a, b in zip(edges, edges[1:], strict=False):
        for wrong in combinations(range(a, b), min(distance // chunks, b - a - 1)):
            kept = [i for i in range(a, b) if i not in wrong]
            keys.append(F.xxhash64(F.lit(a), F.lit(",".join(map(str, wrong))), *[F.col(sig)[i] for i in kept]))
    return F.array(*keys)


def shingle_sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """``node`` and ``shingles`` (sorted hashes) of the given nodes; ``nodes`` has the digest of a text of each."""
    # copies are combined before the shuffle
    texts = digested(docs).groupBy("digest").agg(F.first("text").alias("text")).join(nodes, "digest").select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, group in text_groups(batches):
            sets = [shingle_set(t, width).view(np.int64) for t in group]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    return texts.mapInArrow(run, "node long, shingles array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("_x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("_y"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("_x", "_y")).cast("long")
    return both.where(common * 100 >= F.lit(percent) * (F.size("_x") + F.size("_y") - common)).select("a", "b")


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (the smallest doc_id reachable by links, itself included),
    kept (doc_id = component_id), ``digest`` (of the text) and ``first`` (whether no other doc_id and digest in the
    component comes before the row's). Without shingles a row is the first of its own.

    Below 80 percent keys hold fewer symbols, so more pairs meet; where signatures are too short it is a ValueError.

    Rows with equal shingle sets belong together; a row without shingles (null, empty or blank text) stands alone.
    A null doc_id counts after all others in a component and is kept where nothing else is there. Rows that share a
    doc_id are rows like any other, and kept together. Other columns are ignored; an empty table gives no rows.
    """
    distance, chunks = distance_of(percent)
    rows = stage(signatures(docs, width), "signatures")
    one = rows.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("digest").alias("digest"), F.first("sig").alias("sig"))
    # short numbers that stay what they are, as the table is written
    nodes = stage(one.select(F.monotonically_increasing_id().alias("id"), F.col("node").alias("set_digest"), "digest", "sig"), "nodes")
    keys = nodes.select(F.col("id").alias("node"), F.explode(chunk_keys(distance=distance, chunks=chunks)).alias("key"))
    # the centre of a key: its node with the smallest number, which is the same one for keys that hold the same nodes
    shared = keys.groupBy("key").agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("size")).where("size > 1").drop("size")
    # a row of nodes becomes one for each key, of which Spark's guess of the size knows nothing, and arrays count as one number
    # there: without the hints all keys, or all nodes, may be sent to the driver as a table small enough to broadcast
    star = keys.join(shared.hint("merge"), "key").where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    star = stage(star, "star-pairs")

    # the texts of nodes that share a key are read once more
    met = star.select(F.col("a").alias("id")).unionByName(star.select(F.col("b").alias("id"))).distinct()
    sets = stage(shingle_sets(docs, met.join(nodes.select("id", "digest"), "id").withColumnRenamed("id", "node"), width), "shingle-sets")
    links = stage(confirmed(star, sets, percent), "links")
    found = stage(components(links), "found")
    discard(links)

    # what else shares keys: components tied together by pairs that are no links
    between = contracted(star, found)
    clusters = expanded(components(between), found)
    more = stage(more_links(clusters, found, sets, percent), "links")
    discard(sets, star)
    if not more.isEmpty():
        found = expanded(components(contracted(more, found)), found, all_nodes=True)

    numbered = rows.join(nodes.select(F.col("set_digest").alias("node"), "id").hint("merge"), "node", "left")
    members = numbered.join(found.withColumnRenamed("node", "id"), "id", "left").withColumn("group", F.coalesce("root", "id"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    least = members.where(F.col("group").isNotNull()).groupBy("group").agg(F.min(place).alias("least"))
    out = members.join(least, "group", "left").withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("least.doc_id")))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    first = F.col("node").isNull() | (kept & (F.col("digest") == F.col("least.digest")))
    return out.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), "digest", F.coalesce(first, F.lit(False)).alias("first"))


def contracted(edges: DataFrame, found: DataFrame) -> DataFrame:
    """``edges`` between the roots of components instead of their nodes; a node of no component is its own root."""
    for end in ("a", "b"):
        edges = edges.join(found.select(F.col("node").alias(end), F.col("root").alias("_r")), end, "left").withColumn(end, F.coalesce("_r", end)).drop("_r")
    return edges.where("a <> b").distinct()


def expanded(roots: DataFrame, found: DataFrame, all_nodes: bool = False) -> DataFrame:
    """Components of contracted edges (``roots``) as components of nodes: all members of ``found`` follow their root. Nodes of
    components that were tied to nothing are only given with ``all_nodes``."""
    over = roots.select(F.col("node").alias("root"), F.col("root").alias("_over"))
    inside = found.join(over, "root", "left" if all_nodes else "inner").select("node", F.coalesce("_over", "root").alias("root"))
    alone = roots.join(found, "node", "left_anti")
    return inside.unionByName(alone)


def more_links(clusters: DataFrame, found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (``a``, ``b``) between the components ``found`` within clusters; of the nodes of one component that a node is
    linked to, the smallest stands for all."""
    placed = clusters.withColumnRenamed("root", "cluster").join(found, "node", "left").select("node", "cluster", F.coalesce("root", "node").alias("group"))
    counts = placed.groupBy("cluster", "group").agg(F.count(F.lit(1)).alias("m"))
    largest = counts.groupBy("cluster").agg(F.max(F.struct("m", "group"))["group"].alias("main"), F.count(F.lit(1)).alias("groups"))
    placed = placed.join(largest.where("groups > 1").drop("groups"), "cluster")

    held = stage(placed.join(sets, "node"), "open-clusters")
    shingles = held.select("cluster", "node", F.explode("shingles").alias("shingle"))
    alone = shingles.groupBy("cluster", "shingle").agg(F.count(F.lit(1)).alias("holders"), F.min("node").alias("node")).where("holders = 1")
    own = alone.groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    n = F.size("shingles")
    able = held.join(own, "node", "left").where((n - F.coalesce("own", F.lit(0))) * 100 >= n * percent)
    able = stage(able.select("cluster", "node", "group", (F.col("group") != F.col("main")).alias("outside"), "shingles"), "open-clusters")

    sizes = able.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.count_if("outside").alias("k")).where("k > 0")
    blocks = able.join(sizes, "cluster").withColumns({"_n": F.ceil(F.col("n") / BLOCK), "_k": F.ceil(F.col("k") / BLOCK)})
    one, other = F.pmod(F.xxhash64("node"), F.col("_k")), F.pmod(F.xxhash64("node"), F.col("_n"))

    def each(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    left = blocks.where("outside").select("cluster", one.alias("i"), each("_n").alias("j"), F.lit(True).alias("outer"), "node", "group", "shingles")
    right = blocks.select("cluster", each("_k").alias("i"), other.alias("j"), F.lit(False).alias("outer"), "node", "group", "shingles")
    pairs = left.unionByName(right).repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    return pairs.mapInArrow(lambda batches: block_links(batches, percent), "a long, b long").distinct()


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many hashes each set on the left shares with each on the right."""
    names, code = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    cut = sum(map(len, left))
    both = np.zeros(len(names), bool)
    both[np.intersect1d(code[:cut], code[cut:])] = True
    column = np.cumsum(both) - 1  # shingles on both sides, numbered
    out = np.zeros((len(left), len(right)), np.float32)

    def side(sets: list[np.ndarray], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        kept = both[codes]
        return row[kept], column[codes[kept]]

    (a_row, a_col), (b_row, b_col) = side(left, code[:cut]), side(right, code[cut:])
    for at in range(0, int(both.sum()), COLUMNS):
        part = []
        for n, row, col in ((len(left), a_row, a_col), (len(right), b_row, b_col)):
            take = (col >= at) & (col < at + COLUMNS)
            matrix = np.zeros((n, COLUMNS), np.float32)
            matrix[row[take], col[take] - at] = 1
            part.append(matrix)
        out += part[0] @ part[1].T
    return out.astype(np.int64)


def block_links(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (cluster, i, j); each such group holds a block of nodes outside and one of all nodes."""

    def links(rows: list[tuple]) -> list[tuple[int, int]]:
        left, right = ([r for r in rows if r[3] is outer] for outer in (True, False))
        if not left or not right:
            return []
        both = common_counts([r[6] for r in left], [r[6] for r in right])
        n, m = (np.array([len(r[6]) for r in side])[:, None] for side in (left, right))
        near = both * 100 >= percent * (n + m.T - both)
        out: dict[tuple[int, int], int] = {}
        for i, j in zip(*np.nonzero(near), strict=True):
            (a, own), (b, group) = left[i][4:6], right[j][4:6]
            if own != group:
                out[a, group] = min(b, out.get((a, group), b))
        return [(a, b) for (a, _), b in out.items()]

    def batch_of(out: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    held: list[tuple] = []
    for batch in batches:
        lists = batch.column("shingles")
        flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lists.value_lengths().to_numpy())
        sets = [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        out: list[tuple[int, int]] = []
        for r in zip(*(batch.column(c).to_pylist() for c in ("cluster", "i", "j", "outer", "node", "group")), sets, strict=True):
            if held and held[0][:3] != r[:3]:
                out += links(held)
                held = []
            held.append(r)
        yield batch_of(out)
    if held:
        yield batch_of(links(held))
