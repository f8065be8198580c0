"""Conversation structure repair: the cheapest edits after which the turns of a conversation alternate as they should.

The role initials of a repaired conversation read ``(s?(ua)+)?``. A lattice has a node for each place between turns and
each state of that pattern, and an arc for each edit: D deletes a turn, K keeps it, R gives it the role that is due, I
inserts an empty turn of the role that is due. Costs are whole numbers.

Shortest paths are found by auction (Bertsekas): every node has a price, a lower bound of what is still to be paid. A path
grows from its origin along the arc that looks cheapest. Where no arc is as cheap as the node's price says, the price is
raised to the cheapest arc and the path is drawn back by one node. The path that reaches the end is a shortest one, and the
prices then are a dual solution: every shortest path runs along tight arcs (price = cost + price of the next node). Of
the tight arcs that lead to the end the ones with the least letters are followed, so ties go to the least audit.

Prices start at the sum of what each later turn costs at least. The work of an auction grows with length times errors, so
a conversation is worked on from its end in windows of WINDOW turns: the auctions from the four states at the start of a
window make these four prices exact, and they are the prices at the end of the window before it.

How rows move: all rows are range-partitioned by conversation and turn, once. Inside a range a conversation is repaired as
its rows pass. The first and last conversation of a range may go on in the next, and one of more than SEGMENT turns is
not held in memory: such rows are written as segments. For each segment the cost and the rank of the audit between any
two states are worked out, one chain per conversation (a row of 32 numbers per segment) finds at which states the
cheapest path passes, and then every segment is traced by itself. So a conversation may be of any size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.frames import bounded_batches
from tidewheel.session import stage

#: Turns that an auction spans, and turns of one conversation that a task holds.
WINDOW, SEGMENT = 64, 4096
RETYPE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3

#: States: nothing yet, after s, after u, after a. A conversation may end in the first and the last.
_EMPTY, _S, _U, _A = range(4)
STATES = range(4)
#: The state after the user or assistant turn that is due.
_DUE = (_U, _U, _A, _U)
_DUE_ROLE = ("user", "user", "assistant", "user")
_AFTER = {"s": {_EMPTY: _S}, "u": {_EMPTY: _U, _S: _U, _A: _U}, "a": {_U: _A}, "": {s: s for s in STATES}}
INF = 1 << 60
#: What closing turns inserted after the last one cost, and how many they are.
CLOSING = (0, 2 * INSERT, INSERT, 0)
CLOSING_TURNS = (0, 2, 1, 0)
_LEGAL = {"su", "ua", "au"}


class Turn(NamedTuple):
    """A turn as the lattice sees it: its role's initial, whether it must go, and whether it is cut off."""

    initial: str
    must_go: bool
    cut_off: bool


# (letter, cost, 1 if it uses up the turn, next state), by letter
Arc = tuple[str, int, int, int]
_arcs: dict[Turn, list[list[Arc]]] = {}


def arcs_of(turn: Turn) -> list[list[Arc]]:
    """The arcs at a turn from each state, in the order of their letters."""
    if turn not in _arcs:
        extra, after = (CUT_OFF if turn.cut_off else 0), _AFTER.get(turn.initial, {})
        table = []
        for state in STATES:
            arcs: list[Arc] = [("D", DELETE, 1, state), ("I", INSERT, 0, _DUE[state])]
            if not turn.must_go:
                if state in after:
                    arcs.append(("K", extra, 1, after[state]))
                arcs.append(("R", RETYPE + extra, 1, _DUE[state]))
            table.append(arcs)
        _arcs[turn] = table
    return _arcs[turn]


class Auction:
    """The lattice of a few turns. ``ends`` has the exact price of each state after the last one (INF: not to be reached)."""

    def __init__(self, turns: list[Turn], ends: list[int]):
        self.n = len(turns)
        self.arcs = [table for turn in turns for table in arcs_of(turn)]  # by node: 4 * place + state
        n, price = self.n, [INF] * (4 * len(turns)) + list(ends)
        bound = min(ends)
        for i in range(n - 1, -1, -1):
            bound += min(min(a[1] for a in arcs if a[2]) for arcs in arcs_of(turns[i]))
            for _ in range(3):  # at most two turns are inserted at a place before a state repeats
                for s in STATES:
                    at = 4 * i + s
                    if price[at] == INF and any(price[4 * (i + used) + t] < INF for _, _, used, t in self.arcs[at]):
                        price[at] = bound
        self.price = price

    def shortest(self, state: int) -> int:
        """The cost of a shortest path from the first place and ``state``; INF where there is none."""
        price, arcs, last = self.price, self.arcs, 4 * self.n
        path = [state]
        if price[state] == INF:
            return INF
        while (at := path[-1]) < last:
            base = at & ~3
            best, best_to = INF, at
            for _, cost, used, t in arcs[at]:
                to = base + 4 * used + t
                if cost + price[to] < best:
                    best, best_to = cost + price[to], to
            if price[at] < best:  # too cheap: raise it, draw back
                price[at] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(best_to)
        return price[state]

    def trace(self, state: int) -> tuple[str, int]:
        """The least audit of a shortest path from ``state`` (for which ``shortest`` has run), and the state it ends in."""
        price, n = self.price, self.n
        leads = [False] * (4 * n) + [p < INF for p in price[4 * n :]]

        def follows(at: int, arc: Arc) -> bool:
            to = (at & ~3) + 4 * arc[2] + arc[3]
            return leads[to] and price[at] == arc[1] + price[to]

        for i in range(n - 1, -1, -1):
            for _ in range(3):
                for at in range(4 * i, 4 * i + 4):
                    leads[at] = leads[at] or any(follows(at, arc) for arc in self.arcs[at])
        audit, at = [], state
        while at < 4 * n:
            arc = next(a for a in self.arcs[at] if follows(at, a))
            audit.append(arc[0])
            at = (at & ~3) + 4 * arc[2] + arc[3]
        return "".join(audit), at & 3


class Path:
    """Shortest paths over any number of turns, from the states in ``origins`` to the end prices ``ends``."""

    def __init__(self, turns: list[Turn], ends: list[int] | tuple[int, ...] = CLOSING, origins=(_EMPTY,), window: int = WINDOW):
        self.auctions: list[Auction] = []
        prices = list(ends)
        for at in reversed(range(0, len(turns), window)):
            auction = Auction(turns[at : at + window], prices)
            prices = [auction.shortest(s) if at or s in origins else INF for s in STATES]
            self.auctions.append(auction)
        self.costs = prices

    def trace(self, state: int) -> tuple[str, int]:
        audit = []
        for auction in reversed(self.auctions):
            part, state = auction.trace(state)
            audit.append(part)
        return "".join(audit), state


def between(turns: list[Turn], window: int = WINDOW) -> tuple[list[int], list[int]]:
    """Costs from each state to each state (16 numbers, INF where there is no path), and the place of each least audit
    among those from the same state. Audits end with a turn's letter, so none is the beginning of another one."""
    costs, audits = [INF] * 16, [""] * 16
    for end in STATES:
        path = Path(turns, [0 if s == end else INF for s in STATES], STATES, window)
        for s in STATES:
            costs[4 * s + end] = path.costs[s]
            if path.costs[s] < INF:
                audits[4 * s + end] = path.trace(s)[0]
    ranks = [0] * 16
    for s in STATES:
        for rank, end in enumerate(sorted(STATES, key=lambda t: audits[4 * s + t])):
            ranks[4 * s + end] = rank
    return costs, ranks


def chain(costs: list[list[int]], ranks: list[list[int]]) -> tuple[int, list[int]]:
    """The cost of a conversation of several segments, and the states between them on the path with the least audit."""
    later = [list(CLOSING)]
    for c in reversed(costs):
        later.append([min(c[4 * s + t] + later[-1][t] for t in STATES) for s in STATES])
    later.reverse()
    states = [_EMPTY]
    for k, (c, r) in enumerate(zip(costs, ranks, strict=True)):
        s = states[-1]
        best = [t for t in STATES if c[4 * s + t] + later[k + 1][t] == later[k][s]]
        states.append(min(best, key=lambda t: r[4 * s + t]))
    return later[0][_EMPTY], states


def repaired(audit: str, state: int, roles: list[str], texts: list[str]) -> list[str]:
    """The turns that an audit leaves, as ``role:text``."""
    out, rows = [], zip(roles, texts, strict=True)
    for letter in audit:
        if letter == "I":
            out.append(f"{_DUE_ROLE[state]}:")
            state = _DUE[state]
            continue
        role, text = next(rows)
        if letter == "K":
            out.append(f"{role}:{text}")
            state = _AFTER[role[:1]][state]
        elif letter == "R":
            out.append(f"{_DUE_ROLE[state]}:{text}")
            state = _DUE[state]
    return out


def last_mark(text: Column) -> Column:
    """The last character that is no ASCII white space; empty for a blank text."""
    return F.substring(F.rtrim(text, F.lit(" \t\n\x0b\x0c\r")), -1, 1)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` (nulls in role and text: one space) after the damage that crc32 of ``conv_id:turn`` modulo 20 brings
    about: ``conv_id``, ``turn``, ``role``, ``text``, and ``there``, false for a row that was dropped."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    fault = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault <= 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (fault != 0).alias("there"),
        F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("_copies"),
    )
    return rows.select("conv_id", "turn", "role", "text", "there", F.explode("_copies")).drop("col")


RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_RESULT = [c.split()[0] for c in RESULT.split(", ")]
_ROW = ["seg", "mid", "turn", "role", "text", "last"]
_STAGED = f"{RESULT}, seg long, mid long, turn long, role string, text string, last string"
_KINDS = {"long": pa.int64(), "string": pa.string()}


def _turns(roles: list[str], lasts: list[str], again: list[bool]) -> list[Turn]:
    return [Turn(r[:1], d or not x, bool(x) and x not in ".!?") for r, x, d in zip(roles, lasts, again, strict=True)]


def _gaps(turns: list[int | None]) -> int:
    known = {t for t in turns if t is not None}
    return max(known) - min(known) + 1 - len(known) if known else 0


def _illegal(roles: list[str]) -> int:
    return sum(a[:1] + b[:1] not in _LEGAL for a, b in zip(roles, roles[1:], strict=False))


def _faults(turns: list[Turn], lasts: list[str]) -> tuple[int, int, int]:
    """How many are blank, duplicates, and cut off, the first of these counting."""
    blank = sum(not x for x in lasts)
    return blank, sum(t.must_go for t in turns) - blank, sum(t.cut_off and not t.must_go for t in turns)


def _close(lines: list[str], state: int) -> list[str]:
    for _ in range(CLOSING_TURNS[state]):
        lines.append(f"{_DUE_ROLE[state]}:")
        state = _DUE[state]
    return lines


def _repair(conv_id: int | None, rows: list[tuple], window: int) -> tuple:
    """One whole conversation; rows are (turn, role, text, last) in order."""
    turn_numbers, roles, texts, lasts = zip(*rows, strict=True) if rows else ((), (), (), ())
    seen: set[tuple[str, str]] = set()
    again = [(r, t) in seen or seen.add((r, t)) is not None for r, t in zip(roles, texts, strict=True)]
    turns = _turns(roles, lasts, again)
    path = Path(turns, window=window)
    audit, state = path.trace(_EMPTY)
    lines = _close(repaired(audit, _EMPTY, roles, texts), state)
    sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (conv_id, _gaps(turn_numbers), *_faults(turns, lasts), _illegal(roles), path.costs[_EMPTY], audit + "I" * CLOSING_TURNS[state], sha)


def repair(rows: DataFrame, window: int = WINDOW, segment: int = SEGMENT) -> DataFrame:
    """Per conversation: its faults, the cheapest repair's cost, its edits, and a digest of the repaired turns.

    ``rows`` has conv_id, turn, role, text (a null role or text counts as one space) and may have ``there``; where that is
    false, the row only says that there is such a conversation. Turns are taken in order of turn (null first), then role,
    then text; a repeated row is a duplicate of the first. ``gaps`` counts missing turn numbers; ``blank``, ``duplicate``
    (role and text seen earlier in the conversation) and ``truncated`` (the last mark is none of ``.!?``) count rows by
    their first fault; ``illegal`` counts neighbours whose role initials are none of su, ua, au. A role without initial
    adds nothing to the pattern. A null conv_id is a conversation like any other. Other columns are ignored; an empty
    table gives no rows. A conversation without rows has zeros, an empty audit and the empty string's digest.
    """
    bounded_batches(rows.sparkSession)
    there = F.col("there") if "there" in rows.columns else F.lit(True)
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    plain = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.when(there, role).alias("role"), F.when(there, text).alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    ranged = plain.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("last", last_mark(F.col("text")))
    names = [c.split()[0] for c in _STAGED.split(", ")]
    kinds = [_KINDS[c.split()[1]] for c in _STAGED.split(", ")]

    def pass_by(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 33
        done: list[tuple] = []
        held: list[tuple] = []
        conv, first, large = None, True, False
        nothing, no_row = (None,) * (len(_RESULT) - 1), (None,) * len(_ROW)

        def put_off() -> None:
            """What is held goes on as rows of one segment."""
            nonlocal held
            seg = held[0][0] if held else 0
            done.extend((conv, *nothing, seg, *r) for r in held)
            held = []

        def out() -> pa.RecordBatch:
            nonlocal done
            columns = list(zip(*done, strict=True)) or [[]] * len(names)
            done = []
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        started = False
        for batch in batches:
            for conv_id, *row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "last")), strict=True):
                if started and conv_id != conv:
                    if first or large:
                        put_off()
                    else:
                        done.append((*_repair(conv, [r[1:] for r in held if r[2] is not None], window), *no_row))
                        held = []
                    first = large = False
                elif len(held) == segment:
                    put_off()
                    large = True
                started, conv = True, conv_id
                held.append((at, *row))
                at += 1
            yield out()
        put_off()
        yield out()

    passed = stage(ranged.mapInArrow(pass_by, _STAGED), "conversations")
    whole = passed.where("seg is null").select(*_RESULT)
    return whole.unionByName(_in_segments(passed.where("seg is not null").select("conv_id", *_ROW), window))


def _in_segments(rows: DataFrame, window: int) -> DataFrame:
    """The results of conversations that lie in segments: rows with conv_id, seg, mid (their place), turn, role, text, last."""
    present = rows.where("role is not null")
    first = present.groupBy("conv_id", F.md5(F.concat("role", F.lit("\x00"), "text").cast("binary")).alias("same")).agg(F.min("mid").alias("mid"))
    marked = rows.select("conv_id", "seg", "mid", F.substring("role", 1, 1).alias("role"), "last").join(first.select("mid", F.lit(True).alias("new")), "mid", "left")
    marked = stage(marked, "marked-turns")

    def codes(frame: pd.DataFrame) -> tuple[list[Turn], list[str], list[str]]:
        frame = frame[frame["role"].notna()].sort_values("mid")
        roles, lasts = frame["role"].tolist(), frame["last"].tolist()
        return _turns(roles, lasts, frame["new"].isna().tolist()), roles, lasts

    def weigh(frame: pd.DataFrame) -> pd.DataFrame:
        turns, roles, lasts = codes(frame)
        costs, ranks = between(turns, window) if turns else ([0 if s == t else INF for s in STATES for t in STATES], [0] * 16)
        conv = frame["conv_id"].iloc[0]
        row = (None if pd.isna(conv) else int(conv), int(frame["seg"].iloc[0]), costs, ranks, *_faults(turns, lasts), _illegal(roles), roles[0] if roles else None, roles[-1] if roles else None)
        return pd.DataFrame([row], columns=["conv_id", "seg", "costs", "ranks", "blank", "duplicate", "truncated", "illegal", "head", "tail"]).astype({"conv_id": "Int64"})

    weighed = marked.groupBy("seg").applyInPandas(weigh, "conv_id long, seg long, costs array<long>, ranks array<int>, blank long, duplicate long, truncated long, illegal long, head string, tail string")

    def link(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("seg").reset_index(drop=True)
        cost, states = chain([list(c) for c in frame["costs"]], [list(r) for r in frame["ranks"]])
        ends = [x for h, t in zip(frame["head"], frame["tail"], strict=True) if isinstance(h, str) for x in (h, t)]
        n, last = len(frame), [0] * (len(frame) - 1) + [1]
        joints = _illegal(ends) - sum(a + b not in _LEGAL for a, b in zip(ends[::2], ends[1::2], strict=True))
        made = {"seg": frame["seg"], "entry": states[:-1], "exit": states[1:], "closes": last, "cost": [0] * (n - 1) + [cost], "illegal": frame["illegal"] + [*[0] * (n - 1), joints]}
        return pd.DataFrame({**made, **{c: frame[c] for c in ("blank", "duplicate", "truncated")}})

    chained = weighed.groupBy("conv_id").applyInPandas(link, "seg long, entry int, exit int, closes int, cost long, illegal long, blank long, duplicate long, truncated long")
    chained = stage(chained, "segment-states")

    def follow(frame: pd.DataFrame) -> pd.DataFrame:
        entry, leave, closes, conv = (frame[c].iloc[0] for c in ("entry", "exit", "closes", "conv_id"))
        turns, _, _ = codes(frame.assign(role=frame["role"].str[:1]))
        path = Path(turns, [0 if s == leave else INF for s in STATES], STATES, window)
        there = frame[frame["role"].notna()].sort_values("mid")
        audit = path.trace(int(entry))[0]
        lines = repaired(audit, int(entry), there["role"].tolist(), there["text"].tolist())
        if closes:
            lines, audit = _close(lines, int(leave)), audit + "I" * CLOSING_TURNS[leave]
        return pd.DataFrame({"conv_id": pd.array([None if pd.isna(conv) else int(conv)], "Int64"), "seg": [int(frame["seg"].iloc[0])], "audit": [audit], "left": ["\n".join(lines)]})

    full = rows.select("conv_id", "seg", "mid", "role", "text", "last").join(marked.select("mid", "new"), "mid").join(chained.select("seg", "entry", "exit", "closes"), "seg")
    traced = full.groupBy("seg").applyInPandas(follow, "conv_id long, seg long, audit string, left string")

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Segments in order; of a conversation only its audit and the state of its digest are held."""
        conv, audit, sha, any_line, started = None, [], hashlib.sha256(), False, False

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array(["".join(audit)]), pa.array([sha.hexdigest()])], ["conv_id", "audit", "repaired_sha256"])

        for batch in batches:
            for conv_id, part, left in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "audit", "left")), strict=True):
                if started and conv_id != conv:
                    yield row()
                if not started or conv_id != conv:
                    conv, audit, sha, any_line, started = conv_id, [], hashlib.sha256(), False, True
                audit.append(part)
                if left:
                    sha.update(("\n" if any_line else "").encode() + left.encode())
                    any_line = True
        if started:
            yield row()

    joined = traced.repartition("conv_id").sortWithinPartitions("conv_id", "seg").mapInArrow(join_up, "conv_id long, audit string, repaired_sha256 string")
    # the turns of a conversation by one partial sum each, then one row per conversation
    there = F.col("role").isNotNull()
    span = rows.groupBy("conv_id").agg(
        F.max(F.when(there, F.col("turn"))).alias("high"), F.min(F.when(there, F.col("turn"))).alias("low"), F.count_distinct(F.when(there, F.col("turn"))).alias("n"))
    span = span.select("conv_id", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("n"), F.lit(0)).alias("gaps"))
    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    totals = chained.join(rows.select("seg", "conv_id").distinct(), "seg").groupBy("conv_id").agg(*sums)
    same = F.col("conv_id").eqNullSafe(F.col("_id"))
    out = joined.join(span.withColumnRenamed("conv_id", "_id"), same).drop("_id").join(totals.withColumnRenamed("conv_id", "_id"), same)
    return out.select(*_RESULT)
