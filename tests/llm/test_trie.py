import hashlib
import random
import re
import zlib

import pytest

from tidewheel.llm import trie
from tidewheel.llm.book import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, owner string, depth int, part string"


def expected(rows):
    """By plain walks over all prefixes, from (conv_id, turn, role, text)."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn, role or "", text or ""))
    for turns in own.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.md5(t[2].encode()).hexdigest()))
    nodes = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        whole = [t[1:] for t in own.get(conv - conv % 20, [])[:h] + turns[h:]]
        for depth in range(len(whole) + 1):
            nodes.setdefault(tuple(whole[:depth]), [[], []])[0].append(conv)
        nodes[tuple(whole)][1].append(conv)
    children, leaves, saved = {}, dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for node in nodes:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node, (members, _) in nodes.items():
        words = len(re.findall("[^ \t-\r]+", node[-1][1])) if node else 0
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += node not in children
            saved[node[:depth]] += (len(members) - 1) * words
    return sorted(
        (min(members), len(node), min(nodes[node[:-1]][0]) if node else -1, len(members), children.get(node, 0), leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(ends))).encode()).hexdigest())
        for node, (members, ends) in nodes.items())


def collected(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if x is None else x for x in r) for r in df.select(*names).collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "z", 1, "z") for r in rows], SCHEMA)


def conversations(rng, n, longest, words):
    rows = []
    for conv in rng.sample(range(3 * n), n):
        for turn in range(rng.randint(1, longest)):
            rows.append((conv, rng.choice([turn, turn, turn, None, turn // 2]), rng.choice(["user", "user", None, ""]), rng.choice(words)))
    rows += [(None, 0, "user", "x"), (rows[0][0], *rows[0][1:])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, limit", [(1, 2048), (2, 30), (3, 1)])
def test_equals_plain_walks(spark, seed, limit):
    rng = random.Random(seed)
    rows = conversations(rng, 60, 7, ["a", "b c", "b c", None, "", " é\n x"])
    assert collected(trie.prefix_trie(frame(spark, rows).repartition(3), limit)) == expected(rows)


def test_one_first_turn_many_copies_and_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(trie, "STRETCH", 4)  # stretches of 16 turns
    monkeypatch.setattr(trie, "CHUNK", 20)
    rng = random.Random(4)
    rows = [(c, 0, "user", "Hello there.") for c in range(0, 240)]
    rows += [(c, t, "user", f"same {t}") for c in range(60, 160) for t in range(1, 6)]  # copies
    rows += [(20 * c, t, "user", f"own {rng.randint(0, 3)}") for c in range(3) for t in range(1, 4)]
    rows += [(300, t, "user", f"long {t}") for t in range(150)] + [(301, t, "user", f"long {t}") for t in range(90)]
    assert collected(trie.prefix_trie(frame(spark, rows), 16)) == expected(rows)


@pytest.mark.parametrize("seed", range(40))
def test_component_sums(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 60)
    up = [-1] + [max(0, k - rng.randint(1, 1 + seed % 5 * 9)) for k in range(1, n)]
    values = [(rng.randint(0, 9), rng.randint(0, 9)) for _ in up]
    want = [list(v) for v in values]
    for k in range(n - 1, 0, -1):
        want[up[k]] = [a + b for a, b in zip(want[up[k]], want[k])]
    assert trie.Component(up, values).roll_up() == want


def test_nothing_and_very_long_texts(spark):
    assert collected(trie.prefix_trie(frame(spark, []))) == []
    rows = [(1, 0, "user", "ab " * 1_700_000), (2, 0, "user", "x" * 5_000_000), (2, 1, None, None)]
    assert collected(trie.prefix_trie(frame(spark, rows))) == expected(rows)


def test_query_on_given_tables(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    assert collected(QUERIES["op13_centroid_trie"](spark, sf)) == expected(rows)
