"""Prefix trie of conversations and sums over its subtrees by centroid decomposition.

A node is a distinct sequence of first turns. It is named by the smallest conversation that starts with it (its owner) and
its depth, so the turns of a conversation, with the owner of each of its prefixes, are that conversation's path through
the trie: the ancestors of a node are rows that can be looked up by (conversation, depth).

*Nodes.* A prefix is told by its depth and the exclusive or of 128 hashed bits of each (turn, place), which is a running
total and needs no chain of steps. Owners are found inside range partitions of the prefixes, of which each sends one row
per prefix; so a first turn that a third of all conversations share is never one task's work.

*Sums.* The forest of parent edges is split into components, and every component is split again at its centroid: the
deepest node below which (itself included) more than half of the component lies. The total of what lies at and below the
centroid in its component is added to every node on the path from the centroid up to the component's top, and the
components below the centroid and above it are split in turn; when a node has become a centroid, its own total and what was
added to it before are its sum. Every node takes part in at most log2(n) components.

Subtrees of at most LIMIT nodes are components from the start, and their totals count as their parent's own; what remains
above them is split at centroids by Spark, all components at a time, until no component has more than LIMIT nodes. A
component of that size is split further inside a task. Joins of nodes with their component's one row are spread over as
many parts as the component's size asks for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.llm.frames import bounded_batches
from tidewheel.operators.order import running_totals
from tidewheel.session import stage

#: Most nodes of a component that one task splits.
LIMIT = 2048
#: Rows of one conversation are worked on in stretches of 2 ** STRETCH turns.
STRETCH = 12
#: Every FAMILY-th conversation lends its first turns to the ones after it, up to HEAD - 1 of them.
FAMILY, HEAD = 20, 4
#: Most bytes of conversation numbers in one row.
CHUNK = 1 << 18

_BEFORE = Window.unboundedPreceding


def _stretch(column: str) -> Column:
    return F.shiftright(column, STRETCH)


def _stretches(low: Column, high: Column) -> Column:
    """One row for each stretch from ``low`` to ``high`` (none where ``high`` is less)."""
    first, last = F.shiftright(low, STRETCH), F.shiftright(high, STRETCH)
    return F.explode(F.when(high >= low, F.sequence(first, last)))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``at`` (place in its conversation, from 0), ``turn_key`` (128 bits of role and text) and ``words``."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    key = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.md5(text.cast("binary")).alias("same"),
        key.alias("turn_key"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    placed = running_totals(stage(rows, "turns"), ["conv_id"], ["turn", "role", "same"], {"at": F.lit(1).cast("long")}, spread_copies=True)
    return placed.select("conv_id", F.col("at_before").alias("at"), "turn_key", "words")


def rebuilt(turns: DataFrame) -> DataFrame:
    """The rows of ``ordered_turns`` after conversations took over first turns: conversation c has the first h of
    c - c % FAMILY (h: crc32 of c in decimals modulo HEAD), then its own after its first h. ``depth`` counts from 1; a row
    of depth 0 without turn stands for every conversation."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD).cast("long")
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    lent = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("at") < HEAD - 1))
    heads = lent.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("at", "turn_key", "words"))).alias("heads"))
    every = sizes.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), h.alias("h")).join(heads, "base", "left")
    every = every.withColumn("heads", F.slice(F.coalesce("heads", F.array()), F.lit(1), F.col("h").cast("int")))
    every = stage(every.select("conv_id", "n", "h", "heads"), "heads")
    top = every.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("turn_key"), F.lit(0).cast("long").alias("words"))
    first = every.select("conv_id", F.explode("heads").alias("x")).select("conv_id", (F.col("x.at") + 1).alias("depth"), "x.turn_key", "x.words")
    shift = every.select("conv_id", "h", F.size("heads").cast("long").alias("k"), _stretches(F.lit(0).cast("long"), F.col("n") - 1).alias("stretch"))
    own = turns.withColumn("stretch", _stretch("at")).join(shift, ["conv_id", "stretch"]).where("at >= h")
    own = own.select("conv_id", (F.col("k") + F.col("at") - F.col("h") + 1).alias("depth"), "turn_key", "words")
    return top.unionByName(first).unionByName(own)


def _over_parts(rows: DataFrame, keys: Sequence[str], part: dict[str, Column], whole: dict[str, Callable[[str], Column]]) -> DataFrame:
    """Adds aggregates over ``keys`` to every row: each range partition (column ``part``) sends one row per key, and gets
    one back, so a hot key is never gathered."""
    local = rows.groupBy("part", *keys).agg(*[c.alias(n) for n, c in part.items()])
    found = local.select("part", *keys, *[f(n).over(Window.partitionBy(*keys)).alias(n) for n, f in whole.items()])
    return rows.join(found, ["part", *keys])


def paths(sequences: DataFrame) -> DataFrame:
    """Every conversation's way through the trie: ``conv_id``, ``depth`` (from 0), ``owner`` (the smallest conversation with
    the same first turns), ``n_convs`` (of the node), ``size`` (nodes in its subtree), ``length`` (the conversation's last
    depth), ``words``. ``sequences`` has conv_id, depth (0 for the start, without turn), turn_key, words."""
    bits = {"a": F.xxhash64(F.lit(1), "turn_key", "depth"), "b": F.xxhash64("depth", "turn_key", F.lit(2))}
    rows = sequences.withColumns({n: F.when(F.col("depth") > 0, c).otherwise(F.lit(0).cast("long")) for n, c in bits.items()}).drop("turn_key")
    rows = rows.withColumn("stretch", _stretch("depth"))
    inside = Window.partitionBy("conv_id", "stretch").orderBy("depth").rowsBetween(_BEFORE, 0)
    earlier = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(_BEFORE, -1)
    sums = rows.groupBy("conv_id", "stretch").agg(*[F.bit_xor(n).alias(n) for n in bits])
    carried = sums.select("conv_id", "stretch", *[F.coalesce(F.bit_xor(n).over(earlier), F.lit(0)).alias(f"_{n}") for n in bits])
    named = rows.withColumns({n: F.bit_xor(n).over(inside) for n in bits}).join(carried, ["conv_id", "stretch"])
    named = named.select("conv_id", "depth", "stretch", "words", *[F.col(n).bitwiseXOR(F.col(f"_{n}")).alias(n) for n in bits])
    named = named.repartitionByRange("depth", "a", "b", "conv_id").withColumn("part", F.spark_partition_id())
    named = stage(named, "prefixes")
    owned = stage(_over_parts(named, ["depth", "a", "b"], {"owner": F.min("conv_id")}, {"owner": F.min}).drop("a", "b"), "owners")

    # a conversation owns its prefixes from some depth on
    ends = owned.groupBy("conv_id").agg(F.max("depth").alias("length"), F.min(F.when(F.col("conv_id") == F.col("owner"), F.col("depth"))).alias("since"))
    ends = ends.select("*", _stretches(F.lit(0).cast("long"), F.col("length")).alias("stretch"))
    with_ends = owned.join(ends, ["conv_id", "stretch"])
    mine = F.coalesce(F.greatest(F.lit(0).cast("long"), F.col("length") - F.greatest("since", "depth") + 1), F.lit(0))
    mine = F.when(F.col("since").isNull(), 0).otherwise(mine)
    counted = _over_parts(with_ends.withColumn("_mine", mine), ["depth", "owner"], {"size": F.sum("_mine"), "n_convs": F.count(F.lit(1))}, {"size": F.sum, "n_convs": F.sum})
    return stage(counted.drop("part", "_mine", "since"), "paths")


def trie_nodes(ways: DataFrame) -> DataFrame:
    """The nodes of ``paths``: owner, depth, up (the parent's owner, null for the root), n_convs, n_children, size, words."""
    above = ways.select(F.col("conv_id").alias("owner"), (F.col("depth") + 1).alias("depth"), F.col("owner").alias("up"))
    nodes = ways.where("conv_id = owner").select("owner", "depth", "n_convs", "size", "words").join(above, ["owner", "depth"], "left")
    children = nodes.where("depth > 0").groupBy(F.col("up").alias("owner"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, ["owner", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    return stage(nodes, "trie-nodes")


class Component:
    """A tree whose nodes are numbered so that parents come first (``up``; the first node has none)."""

    def __init__(self, up: list[int], values: list[tuple[int, ...]]):
        self.up, self.values = up, values
        self.sums = [[0] * len(values[0]) for _ in up]

    def roll_up(self) -> list[list[int]]:
        """The sum of the values at and below every node, by centroid decomposition."""
        open_parts = [list(range(len(self.up)))]
        while open_parts:
            open_parts += self._split(open_parts.pop())
        return self.sums

    def _split(self, part: list[int]) -> list[list[int]]:
        """Settles the centroid of ``part`` (parents first) and returns what is left of it."""
        up, top = self.up, part[0]
        size = dict.fromkeys(part, 1)
        for v in reversed(part[1:]):
            size[up[v]] += size[v]
        centroid = max(v for v in part if 2 * size[v] > len(part))  # they lie on one path, so the last is the deepest
        branch = {centroid: centroid}
        below: dict[int, list[int]] = {}
        above: list[int] = []
        for v in part:
            if v == centroid:
                continue
            over = branch.get(up[v]) if v != top else None
            if over is None:
                above.append(v)
            else:
                branch[v] = v if over == centroid else over
                below.setdefault(branch[v], []).append(v)
        total = [sum(x) for x in zip(*(self.values[v] for v in branch), strict=True)]
        v = centroid
        while True:
            self.sums[v] = [a + b for a, b in zip(self.sums[v], total, strict=True)]
            if v == top:
                break
            v = up[v]
        return [*below.values(), *([above] if above else [])]


_VALUES = ("n_leaves", "saved_tokens")
_NODE = ("owner", "depth", "up", "n_convs", "n_children")
_OUT = "owner long, depth long, up long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def _in_tasks(parts: DataFrame) -> DataFrame:
    """Sums inside components (top_owner, top_depth) of at most LIMIT nodes, and what was added to each node before."""
    names = [*_NODE, *_VALUES, *(f"added_{v}" for v in _VALUES), "top_owner", "top_depth"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def solve() -> list[tuple]:
            number = {(r[0], r[1]): k for k, r in enumerate(held)}
            up = [number.get((r[2], r[1] - 1), -1) for r in held]
            sums = Component(up, [r[5:7] for r in held]).roll_up()
            return [(*r[:5], *(a + b for a, b in zip(r[7:9], s, strict=True))) for r, s in zip(held, sums, strict=True)]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [x.split()[0] for x in _OUT.split(", ")])

        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if held and held[0][9:] != row[9:]:
                    out += solve()
                    held = []
                held.append(row)
            yield batch_of(out)
        if held:
            yield batch_of(solve())

    ordered = parts.select(*names).repartition("top_owner", "top_depth").sortWithinPartitions("top_owner", "top_depth", "depth", "owner")
    return ordered.mapInArrow(run, _OUT)


def _tell(nodes: DataFrame, told: DataFrame, limit: int) -> DataFrame:
    """Joins every node with its component's row in ``told`` (both have ``total``, the component's nodes), spread over as many
    parts as the component needs."""
    lots = F.ceil(F.col("total") / limit)
    salted = nodes.withColumn("_lot", F.pmod(F.xxhash64("owner", "depth"), lots))
    copies = told.withColumn("_lot", F.explode(F.sequence(F.lit(0).cast("long"), lots - 1))).drop("total")
    return salted.join(copies, ["top_owner", "top_depth", "_lot"], "left").drop("_lot")


def _split_large(nodes: DataFrame, ways: DataFrame, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """Splits components (top_owner, top_depth) at centroids until none has more than ``limit`` nodes. ``nodes`` has ``total``
    and ``below`` (nodes of the component, and of those the ones at or below the node). Returns the components left and the
    nodes that are settled."""
    settled = None
    comp = ["top_owner", "top_depth"]
    climb = ways.select("conv_id", "depth", "stretch", "owner")
    while True:
        large = nodes.where(F.col("total") > limit)
        if large.isEmpty():
            return nodes, settled
        node = F.struct("depth", "owner", "below", "up", "n_convs", "n_children", *[f"added_{v}" for v in _VALUES])
        centres = large.where(2 * F.col("below") > F.col("total")).groupBy(*comp).agg(F.max(node).alias("c"), F.max("total").alias("total"))
        centres = stage(centres, "centroids")
        told = _tell(large, centres.select(*comp, "total", F.col("c.owner").alias("c_owner"), F.col("c.depth").alias("c_depth"), F.col("c.below").alias("c_below")), limit)

        # under which child of the centroid a node lies: one look at its owner's path, for all its owner's nodes at once
        strands = told.where("depth > c_depth").groupBy("owner", *comp).agg(F.max("depth").alias("deep"), F.first("c_owner").alias("c_owner"), F.first("c_depth").alias("c_depth"))
        at_centre = climb.select(F.col("conv_id").alias("owner"), F.col("depth").alias("c_depth"), F.col("owner").alias("_at"))
        at_child = climb.select(F.col("conv_id").alias("owner"), (F.col("depth") - 1).alias("c_depth"), F.col("owner").alias("branch"))
        under = strands.join(at_centre, ["owner", "c_depth"]).where("_at = c_owner").join(at_child, ["owner", "c_depth"])
        under = under.select("owner", *comp, "branch", _stretches(F.col("c_depth") + 1, F.col("deep")).alias("stretch"))
        placed = told.withColumn("stretch", _stretch("depth")).join(under, ["owner", *comp, "stretch"], "left").drop("stretch")
        placed = placed.withColumn("branch", F.when(F.col("depth") > F.col("c_depth"), F.col("branch")))
        centre = (F.col("owner") == F.col("c_owner")) & (F.col("depth") == F.col("c_depth"))
        placed = stage(placed.withColumn("centre", centre), "split")

        # what lies at and below a centroid is its component's total, added to all nodes on the way to the top
        totals = placed.where("centre or branch is not null").groupBy(*comp).agg(*[F.sum(v).alias(f"c_{v}") for v in _VALUES])
        summed = stage(centres.join(totals, comp), "centroid-totals")
        new = summed.select(*[F.col(f"c.{x}").alias(x) for x in _NODE], *[(F.col(f"c.added_{v}") + F.col(f"c_{v}")).alias(v) for v in _VALUES])
        settled = new if settled is None else settled.unionByName(new)
        way = summed.select(F.col("c.owner").alias("conv_id"), F.col("c.depth").alias("c_depth"), "top_depth", *[f"c_{v}" for v in _VALUES], _stretches(F.col("top_depth"), F.col("c.depth") - 1).alias("stretch"))
        way = climb.join(way, ["conv_id", "stretch"]).where("depth >= top_depth and depth < c_depth").select("owner", "depth", *[f"c_{v}" for v in _VALUES], F.lit(True).alias("on_way"))

        rest = placed.where("not centre").join(way, ["owner", "depth"], "left")
        rest = rest.withColumns({f"added_{v}": F.col(f"added_{v}") + F.coalesce(f"c_{v}", F.lit(0)) for v in _VALUES})
        rest = rest.withColumn("below", F.col("below") - F.when(F.col("on_way"), F.col("c_below")).otherwise(0))
        kept = [*_NODE, *_VALUES, *[f"added_{v}" for v in _VALUES], "below", "total", *comp]
        upper = rest.where("branch is null").withColumn("total", F.col("total") - F.col("c_below")).select(*kept)
        lower = rest.where("branch is not null").withColumns({"top_owner": F.col("branch"), "top_depth": F.col("c_depth") + 1})
        tops = lower.where("owner = top_owner and depth = top_depth").select(*comp, "total", F.col("below").alias("_total"))
        lower = _tell(lower, tops, limit).withColumn("total", F.col("_total")).select(*kept)
        nodes = stage(nodes.where(F.col("total") <= limit).select(*kept).unionByName(upper).unionByName(lower), "components")


def subtree_sums(nodes: DataFrame, ways: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``nodes`` with the sums of ``n_leaves`` and ``saved_tokens`` at and below each one."""
    own = nodes.withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("words")})
    # the first node of a conversation's path whose subtree is small; all its nodes from there on lie below it
    tops = ways.where(F.col("size") <= limit).groupBy("conv_id").agg(F.min(F.struct("depth", "owner")).alias("top"))
    tops = tops.select(F.col("conv_id").alias("owner"), F.col("top.owner").alias("top_owner"), F.col("top.depth").alias("top_depth"))
    nothing = {f"added_{v}": F.lit(0).cast("long") for v in _VALUES}
    small = own.where(F.col("size") <= limit).join(tops, "owner")
    done = _in_tasks(small.withColumns(nothing))
    large = own.where(F.col("size") > limit)
    if large.isEmpty():
        return done
    done = stage(done, "small-subtrees")

    # small subtrees count as their parent's own
    hung = small.select("owner", "depth", "top_owner", "top_depth").where("owner = top_owner and depth = top_depth").select("owner", "depth")
    hung = done.join(hung, ["owner", "depth"]).groupBy(F.col("up").alias("owner"), (F.col("depth") - 1).alias("depth")).agg(*[F.sum(v).alias(f"_{v}") for v in _VALUES])
    large = large.join(hung, ["owner", "depth"], "left").withColumns({v: F.col(v) + F.coalesce(f"_{v}", F.lit(0)) for v in _VALUES})
    large = stage(large.withColumns(nothing), "large-subtrees")
    n = large.count()
    top_owner = large.where("depth = 0").select("owner").first()["owner"]  # one row: the root
    large = large.withColumns({"top_owner": F.lit(top_owner).cast("long"), "top_depth": F.lit(0).cast("long"), "total": F.lit(n).cast("long")})
    if n <= limit:
        return done.unionByName(_in_tasks(large))

    # how many large nodes lie at and below each: a conversation owns them from some depth to its last one
    heavy = ways.where(F.col("size") > limit)
    span = heavy.groupBy("conv_id").agg(F.max("depth").alias("last"), F.min(F.when(F.col("conv_id") == F.col("owner"), F.col("depth"))).alias("since")).where("since is not null")
    span = span.select("*", _stretches(F.lit(0).cast("long"), F.col("last")).alias("stretch"))
    mine = F.col("last") - F.greatest("since", "depth") + 1
    below = heavy.join(span, ["conv_id", "stretch"]).groupBy("owner", "depth").agg(F.sum(mine).alias("below"))
    parts, settled = _split_large(large.join(below, ["owner", "depth"]), ways, limit)
    done = done.unionByName(_in_tasks(parts))
    return done if settled is None else done.unionByName(settled)


def digests_of_ends(ways: DataFrame) -> DataFrame:
    """For each node where conversations end the SHA-256 of their numbers, ascending and joined by commas.

    Numbers are ordered over range partitions and joined there into rows of up to CHUNK bytes, so the one task that has to
    read a node's numbers in order reads them as a few long rows.
    """
    ends = ways.where("depth = length").select("owner", "depth", "conv_id")
    ranged = ends.repartitionByRange("owner", "depth", "conv_id").sortWithinPartitions("owner", "depth", "conv_id")

    def join_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, numbers, size = None, None, [], 0
        done: list[tuple] = []

        def out() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) or [[]] * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["owner", "depth", "first", "numbers"])

        for batch in batches:
            for owner, depth, conv in zip(*(batch.column(c).to_pylist() for c in ("owner", "depth", "conv_id")), strict=True):
                if node != (owner, depth) or size >= CHUNK:
                    if numbers:
                        done.append((*node, first, ",".join(numbers)))
                    node, first, numbers, size = (owner, depth), conv, [], 0
                numbers.append(str(conv))
                size += len(numbers[-1]) + 1
            yield out()
            done = []
        if numbers:
            done.append((*node, first, ",".join(numbers)))
        yield out()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, hashlib.sha256()
        done: list[tuple] = []

        def out() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) or [[]] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int64(), pa.int64(), pa.string()], strict=True)], ["owner", "depth", "ends_sha256"])

        for batch in batches:
            for owner, depth, numbers in zip(*(batch.column(c).to_pylist() for c in ("owner", "depth", "numbers")), strict=True):
                if node != (owner, depth):
                    if node:
                        done.append((*node, sha.hexdigest()))
                    node, sha = (owner, depth), hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(numbers.encode())
            yield out()
            done = []
        if node:
            done.append((*node, sha.hexdigest()))
        yield out()

    rows = ranged.mapInArrow(join_numbers, "owner long, depth long, first long, numbers string")
    return rows.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "first").mapInArrow(digest, "owner long, depth long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The trie of all rebuilt conversations (see ``rebuilt``), one row per node: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` (over the subtree:
    words of the node's last turn times members but one) and ``ends_sha256`` of the conversations that end there.

    ``conversations`` has conv_id, turn, role, text; turns are taken in order of turn (null first), then role, then digest of
    the text. Null and empty roles and texts are the same. Repeated rows are turns like any other. Rows without a conv_id
    belong to no conversation and are left out; other columns are ignored; an empty table gives no rows.
    """
    bounded_batches(conversations.sparkSession)
    ways = paths(rebuilt(ordered_turns(conversations)))
    sums = subtree_sums(trie_nodes(ways), ways, limit)
    found = sums.join(digests_of_ends(ways), ["owner", "depth"], "left")
    return found.select(
        F.col("owner").alias("conv_id"), "depth", F.col("up").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
