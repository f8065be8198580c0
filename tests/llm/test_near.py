import random
import re

import numpy as np
import pytest
import xxhash

from pyspark.sql import functions as F
from tests.llm.conftest import edited, frame, prose
from tidewheel.llm import fingerprints, hamming, pivots
from tidewheel.llm.components import components


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(90)] + [(i, i + 1) for i in range(300, 340)] + [(500, 500 + i) for i in range(1, 30)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = roots({x for p in links for x in p}, links)
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert found == {n: r for n, r in want.items() if n in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text, width):
    words = [w for w in (text or "").translate({i: i + 32 for i in range(65, 91)}).replace("\n", " ").replace("\t", " ").split(" ") if w]
    n = min(width, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def near_rows(seed):
    rng = random.Random(seed)
    rows = []
    for g in range(8):
        base = prose(rng, rng.randint(40, 200))
        rows += [(g * 100 + i, edited(rng, base, rng.randint(0, 9))) for i in range(rng.randint(2, 14))]
    hot = prose(rng, 150)
    rows += [(2000 + i, edited(rng, hot, rng.choice([0, 1, 2, 3, 5, 8, 12]))) for i in range(60)]
    return rows


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, messy, width, percent):
    rows = near_rows(width) + [(d if d is None or d < 1000 else d + 9000, t) for d, t in messy]
    rows = [(None if d is None else d + (5000 if i >= len(near_rows(width)) else 0), t) for i, (d, t) in enumerate(rows)]
    sets = [shingles(t, width) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    group = roots(range(len(rows)), links)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[group[i]] = min(d, least.get(group[i], d))
    want = sorted((str(d), len(s), str(least.get(group[i])), d == least.get(group[i])) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))
    found = hamming.near_duplicates(frame(spark, rows).repartition(4), width, percent).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in found) == want


def test_near_duplicates_of_nothing(no_docs):
    assert hamming.near_duplicates(no_docs).count() == 0


def test_all_pairs_within_the_distance_share_a_key(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 16, hamming.SYMBOLS)
    rows = [(0, base.tolist())]
    for i in range(1, 200):
        other = base.copy()
        wrong = rng.choice(hamming.SYMBOLS, hamming.DISTANCE, replace=False)
        other[wrong] = (other[wrong] + 1) % (1 << 16)
        rows.append((i, other.tolist()))
    keys = {r.i: set(r.k) for r in spark.createDataFrame(rows, "i int, sig array<int>").select("i", hamming.chunk_keys().alias("k")).collect()}
    assert all(keys[i] & keys[0] for i in range(1, 200)) and len(keys[0]) == hamming.SYMBOLS


def test_word_hashes_cut_at_ascii_blanks_only():
    a, b, c = (hamming.word_hashes(t).tolist() for t in ("A b\tc\x0bd", "a B\nc \x0c d", "a b\xa0c d"))
    assert a == b and len(a) == 4 and len(c) == 3
    assert hamming.word_hashes("x" * 3000) != hamming.word_hashes("x" * 3001)


def vectors(seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(400, 16))
    rows = [x]
    for g in range(12):
        rows.append(x[g] + rng.normal(size=(6 + 8 * (g == 0), 16)) * 0.06 * np.linalg.norm(x[g]) / 4)
    return np.concatenate(rows).astype(np.float32)


def test_links_between_vectors(spark):
    x = vectors(3)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    rows += [(900, rows[0][1]), (901, rows[0][1]), (900, rows[0][1]), (None, rows[1][1]), (910, None), (911, []), (912, [0.0] * 16), (913, [float("nan")] * 16), (914, [None] + [1.0] * 15), (915, [1e300] * 16), (916, [1e300] * 16), (917, [1.0, 2.0]), (918, [2.0, 4.0])]
    good = [i for i, (_, v) in enumerate(rows) if v and None not in v and any(v) and all(np.isfinite(v))]
    units = {i: np.array(rows[i][1]) / np.abs(rows[i][1]).max() for i in good}
    units = {i: v / np.linalg.norm(v) for i, v in units.items()}
    links = [(i, j) for i in good for j in good if j < i and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.95 - 1e-12]
    group, n = roots(range(len(rows)), links), [0] * len(rows)
    for i, j in links:
        n[i] += 1
        n[j] += 1
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[group[i]] = min(d, least.get(group[i], d))
    frame_ = spark.createDataFrame([(d, v, "q", "z") for d, v in rows], "vec_id long, embedding array<double>, node string, vector string").repartition(3)
    # every pair is a candidate: the index is exact
    found = pivots.near_vectors(frame_, pivots=32, nearest=6, shared=1).collect()
    want = sorted((str(d), n[i], str(least.get(group[i])), d == least.get(group[i])) for i, (d, _) in enumerate(rows))
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in found)
    exact = sum(a == b for a, b in zip(got, want, strict=True))
    assert exact >= 0.97 * len(want)
    assert all(a[1] <= b[1] for a, b in zip(got, want, strict=True) if a[0] == b[0])
    usual = pivots.near_vectors(frame_).collect()
    assert sum(r.n_links for r in usual) >= 0.9 * sum(n) and sum(r.n_links for r in usual) <= sum(n)


def test_large_lists_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(pivots, "BLOCK", 8)
    rng = np.random.default_rng(5)
    centre = rng.normal(size=12)
    x = centre + rng.normal(size=(90, 12)) * 0.02
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = pivots.near_vectors(df, pivots=10, nearest=4, shared=2).collect()
    assert {r.component_id for r in found} == {0} and sum(r.n_links for r in found) == 90 * 89


def test_vectors_of_nothing(spark):
    assert pivots.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_planted_pairs_at_the_threshold_are_found(spark):
    """64 dimensions, cosines of 0.9501: few pairs lie lower, so this is the least recall to expect."""
    rng = np.random.default_rng(21)
    x, turn = rng.normal(size=(1500, 64)), rng.normal(size=(1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    turn -= (turn * x).sum(axis=1, keepdims=True) * x
    turn /= np.linalg.norm(turn, axis=1, keepdims=True)
    near = 0.9501 * x + np.sqrt(1 - 0.9501**2) * turn
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(np.concatenate([x, near]))], "vec_id long, embedding array<double>")
    found = {r.vec_id: r for r in pivots.near_vectors(df).collect()}
    assert np.mean([found[1500 + k].component_id == k and found[k].n_links == 1 for k in range(1500)]) >= 0.98
    assert sum(r.n_links for r in found.values()) <= 3000


def test_a_pair_has_one_first_list_from_either_side():
    rng = np.random.default_rng(2)
    sets = pivots.pivot_sets(6, 3, 4)
    a, b = (np.argsort(rng.normal(size=(300, 9)) + np.arange(9) / 3, axis=1)[:, :6] for _ in range(2))
    first = pivots.entered_first(a, b, sets, 4)
    names = [pivots.list_names(x, sets) for x in (a, b)]
    wanted = [min(set(x) & set(y), default=np.iinfo(np.int64).max) for x, y in zip(*(n.tolist() for n in names), strict=True)]
    assert first.tolist() == wanted == pivots.entered_first(b, a, sets, 4).tolist()
    assert all(len(set(x)) == len(sets) for x in names[0].tolist()) and any(w < np.iinfo(np.int64).max for w in wanted)


def plain_sketch(text):
    """Hashes of five words, one after the other with the hash before as seed, as a loop."""
    words, hashes = re.findall(r"[^ \t\n\r\x0b\f]+", text), set()
    for at in range(max(1, len(words) - 4)) if words else ():
        seed = 42
        for word in words[at : at + 5] if len(words) >= 5 else [" ".join(words)]:
            seed = xxhash.xxh64_intdigest(word.encode(), seed=seed)
        hashes.add(seed - (1 << 64) if seed >> 63 else seed)
    low = [h for h in hashes if h < LAST]
    return sorted(low if len(low) >= fingerprints.LEAST else hashes)


LAST = -(1 << 63) + (1 << 64) // fingerprints.ONE_IN


def plain_likeness(a, b):
    if not all(len(s) < fingerprints.LEAST or max(s) >= LAST for s in (a, b)):
        a, b = ([h for h in s if h < LAST] for s in (a, b))
    return len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 1.0


def test_short_texts_are_compared_whole(spark):
    rng = random.Random(4)
    texts = [prose(rng, n) for n in (6, 9, 20, 40, 70, 100, 400)] + ["", "one"]
    texts += [t + " " + prose(rng, 3) for t in texts] + [" ".join(texts[5:7]), " ".join(texts[:3])]
    df = spark.createDataFrame([(i, j, a, b) for i, a in enumerate(texts) for j, b in enumerate(texts)], "i int, j int, a string, b string")
    df = df.select("i", "j", fingerprints.sketch(F.col("a")).alias("a"), fingerprints.sketch(F.col("b")).alias("b"))
    a, b = F.col("a"), F.col("b")
    own = [plain_sketch(t) for t in texts]
    assert len({len(s) for s in own}) > 6 and any(max(s, default=0) >= LAST for s in own) and any(s and max(s) < LAST for s in own)
    for r in df.select("i", "j", fingerprints.likeness(a, b).alias("l"), fingerprints.containment(a, b).alias("c"), fingerprints.merge(a, b).alias("m")).collect():
        x, y = own[r.i], own[r.j]
        assert r.l == pytest.approx(plain_likeness(x, y)) and (r.c is None or 0 <= r.c <= 1)
        assert [h for h in r.m if h < LAST] == sorted({h for h in x + y if h < LAST})
        if r.i == r.j:
            assert r.l == r.c == 1 and r.m == x


def test_sketches_by_hand(spark):
    rng = random.Random(9)
    long = prose(rng, 4000)
    part = " ".join(long.split(" ")[1000:3000])
    texts = [long, part, prose(rng, 3000), "", None, " \n ", "one two", "  one\ttwo ", "one two three four five"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", fingerprints.sketch(F.col("t")).alias("s"))
    found = {r.i: r.s for r in df.collect()}
    assert found[3] == found[4] == found[5] == [] and found[6] == found[7] and len(found[6]) == 1 and len(found[8]) == 1
    assert all(found[i] == plain_sketch(t or "") for i, t in enumerate(texts))
    assert found[0] == sorted(set(found[0])) and len(found[0]) == pytest.approx(4000 / fingerprints.ONE_IN, rel=0.2)
    every = spark.createDataFrame([(texts[0],)], "t string").select(fingerprints.sketch(F.col("t"), one_in=1).alias("s")).first().s
    assert found[0] == [h for h in every if h < -(1 << 63) + (1 << 64) // fingerprints.ONE_IN]
    a, b = F.col("a"), F.col("b")
    pairs = spark.createDataFrame([(found[1], found[0]), (found[2], found[0]), (found[0], found[1]), ([], [])], "a array<long>, b array<long>")
    rows = pairs.select(fingerprints.containment(a, b).alias("c"), fingerprints.likeness(a, b).alias("l"), fingerprints.merge(a, b).alias("m")).collect()
    assert rows[0].c == 1 and rows[1].c == 0 and rows[2].c == pytest.approx(0.5, abs=0.1) and rows[0].l == pytest.approx(0.5, abs=0.1)
    assert rows[3].c == rows[3].l == 1 and rows[0].m == found[0]


def test_edited_texts(spark, docs, no_docs, messy):
    import hashlib

    found = fingerprints.with_edits(docs).collect()
    distinct = sorted({(d, hashlib.md5((t or "").encode()).hexdigest(), t or "") for d, t in messy}, key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
    want, own = [], {}
    for i, (d, _, t) in enumerate(distinct):
        half = len(t) // 2
        new = t[: len(t) - half] + distinct[(i + 1) % len(distinct)][2][:half]
        times = sum((a, b or "") == (d, t) for a, b in messy)
        want += [(str(d), len(t), hashlib.sha256(new.encode()).hexdigest())] * times
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in found) == sorted(want)
    by_id = {d: t or "" for d, t in messy if d not in (None, 3, 4, 5)}
    order = [t for _, _, t in distinct]
    for k, (d, _, t) in enumerate(distinct):
        half = len(t) // 2
        after = order[(k + 1) % len(order)]
        sketches = [plain_sketch(x) for x in (t, t[: len(t) - half] + after[:half], after)]
        digits = ["".join(f"{h % (1 << 64):016X}" for h in s) for s in sketches]
        rows = [r for r in found if r.doc_id == d and r.fingerprint == digits[0] and r.edited_fingerprint == digits[1]]
        assert any(r.near_edited == pytest.approx(plain_likeness(*sketches[:2])) and r.near_next == pytest.approx(plain_likeness(sketches[0], sketches[2])) for r in rows)
    for r in found:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.doc_id in by_id:
            assert own.setdefault(by_id[r.doc_id], r.fingerprint) == r.fingerprint
    assert fingerprints.with_edits(no_docs).count() == 0
    one = fingerprints.with_edits(frame(spark, [(1, "a b c d e f")])).first()
    assert one.near_next == 1 and one.edited_sha256 == hashlib.sha256(b"a b c a b c"[:6] + b"a b c"[:5]).hexdigest()


def test_common_counts_are_exact(monkeypatch):
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 80))) for _ in range(40)]
    want = [[len(np.intersect1d(a, b)) for b in sets[15:]] for a in sets[:15]]
    assert hamming.common_counts(sets[:15], sets[15:]).tolist() == want
    monkeypatch.setattr(hamming, "COLUMNS", 7)
    assert hamming.common_counts(sets[:15], sets[15:]).tolist() == want


def test_links_outside_the_centre_are_found_in_blocks(spark, monkeypatch):
    """A chain of edits: the ends are far from every centre, and blocks are cut small."""
    monkeypatch.setattr(hamming, "BLOCK", 4)
    rng = random.Random(21)
    rows, text = [], prose(rng, 120)
    for i in range(30):
        rows.append((i, text))
        text = edited(rng, text, 2)
    far = prose(rng, 120)
    rows += [(100 + i, edited(rng, far, 9)) for i in range(20)]
    sets = [shingles(t, 3) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    group = roots(range(len(rows)), links)
    found = {r.doc_id: r.component_id for r in hamming.near_duplicates(frame(spark, rows), 3, 85).collect()}
    assert found == {d: rows[group[i]][0] for i, (d, _) in enumerate(rows)}


def test_keys_and_nodes_are_not_broadcast(spark, monkeypatch):
    """Keys are many times the rows they are made from, which Spark's guess of their size leaves out; a table of this size
    would always be broadcast."""
    plans, written = {}, hamming.stage

    def seen(df, label):
        plans.setdefault(label, df._jdf.queryExecution().executedPlan().toString())
        return written(df, label)

    monkeypatch.setattr(hamming, "stage", seen)
    rng = random.Random(41)
    text = prose(rng, 80)
    out = hamming.near_duplicates(frame(spark, [(1, text), (2, edited(rng, text, 1)), (3, prose(rng, 80)), (4, None)]))
    assert "SortMergeJoin" in plans["star-pairs"] and "Broadcast" not in plans["star-pairs"]
    joins = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line and "node#" in line]
    assert joins and all("SortMergeJoin" in j for j in joins)
    assert sorted((r.doc_id, r.component_id, r.kept) for r in out.collect()) == [(1, 1, True), (2, 1, False), (3, 3, True), (4, 4, True)]


def test_near_copies_without_an_id(spark):
    """Sets that stand only in rows without an id, and many texts under one id."""
    rng = random.Random(31)
    one, two = prose(rng, 150), prose(rng, 150)
    rows = [(1, one), (None, edited(rng, one, 2)), (None, two), (None, edited(rng, two, 2)), (7, prose(rng, 150)), (7, edited(rng, two, 3)), (7, prose(rng, 150))]
    found = hamming.near_duplicates(frame(spark, rows).repartition(2))
    want = [("1", "1", True), ("None", "1", False), ("None", "7", False), ("None", "7", False), ("7", "7", True), ("7", "7", True), ("7", "7", True)]
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in found.collect()) == sorted(want)


@pytest.mark.parametrize("percent", [100, 80, 60, 21])
def test_lower_thresholds_have_a_wider_distance(spark, percent):
    distance, chunks = hamming.distance_of(percent)
    mean = 64 * (1 - percent / 100)
    assert distance >= max(hamming.DISTANCE, int(mean + 4 * (mean * percent / 100) ** 0.5))
    rng = np.random.default_rng(percent)
    base = rng.integers(0, 1 << 16, hamming.SYMBOLS)
    rows = [(0, base.tolist())]
    for i in range(1, 60):
        other = base.copy()
        wrong = rng.choice(hamming.SYMBOLS, distance, replace=False)
        other[wrong] = (other[wrong] + 1) % (1 << 16)
        rows.append((i, other.tolist()))
    df = spark.createDataFrame(rows, "i int, sig array<int>").select("i", hamming.chunk_keys(distance=distance, chunks=chunks).alias("k"))
    keys = {r.i: set(r.k) for r in df.collect()}
    assert all(keys[i] & keys[0] for i in range(1, 60))


def test_too_low_thresholds_are_refused(no_docs):
    with pytest.raises(ValueError):
        hamming.near_duplicates(no_docs, percent=15)
