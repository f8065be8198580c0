import hashlib
import heapq
import random
import re
import zlib

import pytest

from tidewheel.llm import repair
from tidewheel.llm.book import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, seg string, there_is int, cost string"
BLANKS = " \t\n\x0b\x0c\r"


def least_edits(rows):
    """Uniform-cost search over edit scripts, by cost and then audit; the pattern is matched with a regular expression."""
    seen, turns = set(), []
    for role, text in rows:
        bare = text.rstrip(BLANKS)
        turns.append((role, text, not bare, (role, text) in seen, bool(bare) and bare[-1] not in ".!?"))
        seen.add((role, text))
    heap, n = [(0, "", 0, "", ())], 0
    while True:
        cost, audit, at, initials, out = heapq.heappop(heap)
        if at == len(turns) and re.fullmatch("(s?(ua)+)?", initials):
            return cost, audit, "\n".join(out)
        options = [("I", 3, at, r, f"{r}:") for r in ("user", "assistant")]
        if at < len(turns):
            role, text, blank, copy, cut = turns[at]
            options.append(("D", 4, at + 1, None, None))
            if not blank and not copy:
                options.append(("K", 3 * cut, at + 1, role, f"{role}:{text}"))
                options += [("R", 3 + 3 * cut, at + 1, r, f"{r}:{text}") for r in ("user", "assistant")]
        for letter, more, to, role, line in options:
            now = initials + (role or "")[:1]
            if re.fullmatch("(s?(ua)*u?)?", now):
                heapq.heappush(heap, (cost + more, audit + letter, to, now, (*out, line) if line is not None else out))


def expected(rows, damage):
    """By conversation, from (conv_id, turn, role, text)."""
    found = {}
    for conv, turn, role, text in rows:
        kept = found.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        fault = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20 if damage else 9
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        kept += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    out = []
    for conv, kept in found.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))
        known = [t for t, _, _ in kept if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        blank = duplicate = truncated = 0
        seen = set()
        for _, role, text in kept:
            bare = text.rstrip(BLANKS)
            blank += not bare
            duplicate += bool(bare) and (role, text) in seen
            truncated += bool(bare) and (role, text) not in seen and bare[-1] not in ".!?"
            seen.add((role, text))
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(kept, kept[1:])]
        cost, audit, left = least_edits([r[1:] for r in kept])
        out.append((conv, gaps, blank, duplicate, truncated, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(rng, n, longest):
    rows = []
    for conv in [*range(n), None]:
        length = rng.randint(0, longest)
        for turn in range(length):
            role = rng.choice(["user", "assistant"] * 3 + ["system", "tool", "u", "", None])
            text = rng.choice(["Yes.", "No", "Well? ", " \n", "", None, "a. b", "Ünï!", "x" * rng.randint(1, 3) + "."])
            rows.append((conv, rng.choice([turn, turn, turn, None, turn // 2, turn * 3]), role, text))
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "z", 1, "z") for r in rows], SCHEMA)


def collected(df):
    return sorted(map(tuple, df.select(*[c.split()[0] for c in repair.RESULT.split(", ")]).collect()), key=str)


@pytest.mark.parametrize("segment, window", [(4096, 64), (3, 2), (1, 1)])
def test_equals_a_search_over_edit_scripts(spark, segment, window):
    rows = conversations(random.Random(segment), 60, 9)
    df = frame(spark, rows)
    found = repair.repair(df.repartition(5), window, segment)
    assert collected(found) == expected(rows, False)
    assert collected(repair.repair(repair.damaged(df), window, segment)) == expected(rows, True)


def test_long_conversation_is_the_same_in_windows_and_segments(spark):
    rng = random.Random(4)
    roles = ["system", *["user", "assistant"] * 400]
    rows = [(1, t, r if rng.random() < 0.9 else "user", f"{t} and more{rng.choice('..!? ')}") for t, r in enumerate(roles)]
    rows += [(0, 0, "user", "Hi."), (2, None, None, None)]
    # in order, so that the last conversation is not cut by the range partitions of one more row
    whole = [repair._repair(c, [(t, r, x, x.rstrip(BLANKS)[-1:]) for k, t, r, x in rows if k == c and r], 64) for c in (0, 1)]
    by_windows = [repair._repair(c, [(t, r, x, x.rstrip(BLANKS)[-1:]) for k, t, r, x in rows if k == c and r], 7) for c in (0, 1)]
    assert whole == by_windows
    found = collected(repair.repair(frame(spark, rows), 16, 50))
    assert found[:2] == whole and found[2][:2] == (2, 0) and len(found) == 3


def test_very_long_text_and_one_conversation_with_most_rows(spark):
    rows = [(5, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(2000)] + [(6, 0, "user", "é " * 2_500_000), (6, 1, "assistant", " " * 1_000_000 + "x.")]
    found = {r[0]: r for r in collected(repair.repair(frame(spark, rows), segment=100))}
    assert found[5][6:8] == (0, "K" * 2000) and found[6][6:8] == (3, "KK")
    assert found[5][8] == hashlib.sha256("\n".join(f"{r}:{x}" for _, _, r, x in rows[:2000]).encode()).hexdigest()


def test_nothing_there(spark):
    assert collected(repair.repair(frame(spark, []))) == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert collected(repair.repair(repair.damaged(frame(spark, [(gone, 0, "user", "Yes.")])))) == [(gone, 0, 0, 0, 0, 0, 0, "", empty)]


def test_query_on_given_tables(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    assert collected(QUERIES["op12_auction_repair"](spark, sf)) == expected(rows, True)


def test_prices_are_a_dual_solution():
    rng = random.Random(8)
    for _ in range(200):
        turns = [repair.Turn(rng.choice("suax"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randint(1, 9))]
        auction = repair.Auction(turns, list(repair.CLOSING))
        cost = auction.shortest(0)
        for at, arcs in enumerate(auction.arcs):
            assert all(auction.price[at] <= a[1] + auction.price[(at & ~3) + 4 * a[2] + a[3]] for a in arcs)
        audit, end = auction.trace(0)
        assert cost == repair.Path(turns, window=2).costs[0] and len([x for x in audit if x != "I"]) == len(turns)
