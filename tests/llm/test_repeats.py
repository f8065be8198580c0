import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from tests.llm.conftest import frame
from tidewheel.llm import suffixes


def brute(rows, length):
    seen = {}
    raws = [(t or "").encode() for _, t in rows]
    for raw in raws:
        for p in range(len(raw) - length + 1):
            seen[raw[p : p + length]] = seen.get(raw[p : p + length], 0) + 1
    out = []
    for (d, _), raw in zip(rows, raws, strict=True):
        gone = np.zeros(len(raw) + 2, bool)
        for p in range(len(raw) - length + 1):
            if seen[raw[p : p + length]] > 1:
                gone[p + 1 : p + length + 1] = True
        edges = np.flatnonzero(np.diff(gone)).tolist()
        out.append((str(d), len(raw), edges, bytes(b for b, g in zip(raw, gone[1:], strict=False) if not g)))
    return sorted(out)


def passages(seed):
    rng = random.Random(seed)

    def noise(n):
        return "".join(rng.choice("abcdefgh é") for _ in range(n))

    shared = [noise(rng.randint(15, 140)) for _ in range(6)]
    rows = []
    for d in range(60):
        kinds = [noise(rng.randint(0, 60)), rng.choice(shared)[rng.randint(0, 8) :], "a" * rng.randint(0, 90), "ab" * rng.randint(0, 30)]
        rows.append((d, "".join(rng.choice(kinds) for _ in range(rng.randint(0, 6)))))
    return rows + [(100, None), (101, ""), (None, rows[3][1]), (None, None), (3, rows[3][1]), (102, noise(3000) + shared[0])]


@pytest.mark.parametrize("seed,length", [(1, 20), (2, 20), (3, 50)])
def test_repeats_equal_brute_force(spark, seed, length):
    rows = passages(seed)
    found = suffixes.remove_repeats(frame(spark, rows).repartition(3), length).collect()
    assert sorted((str(r.doc_id), r.n_bytes, list(r.spans), bytes(r.kept)) for r in found) == brute(rows, length)


def test_hot_grams_are_split(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "SPREAD", 5)
    rows = passages(4)
    found = suffixes.remove_repeats(frame(spark, rows), 20).collect()
    assert sorted((str(r.doc_id), r.n_bytes, list(r.spans), bytes(r.kept)) for r in found) == brute(rows, 20)


def test_tiles_do_not_show(monkeypatch):
    rng = np.random.default_rng(1)
    raw = rng.integers(97, 100, 5000).astype(np.uint8)
    whole = suffixes.anchors(raw, 60, 15)
    hashes = suffixes.string_hashes(raw, 60)
    monkeypatch.setattr(suffixes, "TILE", 333)
    tiled = suffixes.anchors(raw, 60, 15)
    assert np.array_equal(whole[0], tiled[0]) and np.array_equal(whole[1], tiled[1])
    starts = np.flatnonzero(rng.random(len(hashes)) < 0.1)
    assert np.array_equal(suffixes.hashes_at(raw, starts, 60), hashes[starts])
    # every string of the length holds an anchor
    assert all(((whole[0] >= s) & (whole[0] <= s + 45)).any() for s in range(len(raw) - 59))


def test_all_columns_and_whole_characters(spark, docs, no_docs, messy):
    rest = suffixes.without_repeats(docs, 200, "gone")
    assert rest.columns == [*docs.columns, "gone"] and rest.count() == len(messy)
    for r in rest.collect():
        assert (r.gone == 0) or len((r.text or "").encode()) <= 4000
    assert suffixes.remove_repeats(no_docs).count() == 0
    text = "é" * 130
    cut = suffixes.without_repeats(frame(spark, [(1, "x" + text), (2, "y" + text)], clash=False), 201, "gone").collect()
    assert {r.text for r in cut} <= {"x", "y"} and all(r.gone in (259, 260) for r in cut)


def test_copies_of_a_hot_passage_never_meet_in_one_bucket(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "SPREAD", 5)
    rng = random.Random(12)

    def noise(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))

    passage, real = noise(26), suffixes._unpacked
    rows = [(d, noise(30) + passage + noise(30)) for d in range(90)] + [(200, noise(30) + passage[:22])]

    def watched(held):
        buckets = [r[1] for r in held]
        assert max(map(buckets.count, buckets)) <= 45
        return real(held)

    monkeypatch.setattr(suffixes, "_unpacked", watched)
    found = suffixes.remove_repeats(frame(spark, rows).repartition(3), 20).collect()
    assert sorted((str(r.doc_id), r.n_bytes, list(r.spans), bytes(r.kept)) for r in found) == brute(rows, 20)


def test_groups_that_are_cut_by_ranges_have_one_rank(spark):
    """A hot pair, a hot first key with different second keys, single rows; over seven ranges that are not merged."""
    rng = random.Random(5)
    rows = [(7, 7, p) for p in range(400)] + [(9, rng.randrange(300), 400 + p) for p in range(400)] + [(1000 + p, 0, 800 + p) for p in range(50)] + [(-5, -5, 900), (-5, 3, 901)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(a, b, p, 0, 1 + p % 3, 1, 1) for a, b, p in rows], suffixes._SORTED).repartition(3)
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        for by in ("size_a", "size_b"):
            found = suffixes.ranked(df, by)
            assert found.staged.select("part").distinct().count() > 3
            size_a, size_b, least = {}, {}, {}
            for a, b, p in rows:
                size_a[a] = size_a.get(a, 0) + 1 + p % 3
                size_b[a, b] = size_b.get((a, b), 0) + 1 + p % 3
                least[a, b] = min(p, least.get((a, b), p))
            wanted = [(p, size_a[a], size_b[a, b], least[a, b]) for a, b, p in rows if (size_a[a] if by == "size_a" else size_b[a, b]) > 1]
            assert sorted((r.pos, r.size_a, r.size_b, r["rank"]) for r in found.collect()) == sorted(wanted)
        texts = passages(6)
        result = suffixes.remove_repeats(frame(spark, texts).repartition(3), 20).collect()
        assert sorted((str(r.doc_id), r.n_bytes, list(r.spans), bytes(r.kept)) for r in result) == brute(texts, 20)
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_strings_double_inside_their_document_and_without_a_join(spark, monkeypatch):
    """Rows of a document that cross batches, a hot rank, a document that ends in a batch of its own."""
    rng = random.Random(3)
    rows = []
    for d in range(30):
        kept = sorted(rng.sample(range(90), 60))
        rows += [((d << 20) + i, i, 1 + d % 2, rng.randint(1, 3), rng.randint(60, 500), 0, 0, rng.randrange(4)) for i in kept]
    df = spark.createDataFrame(rows, "pos long, i int, copies int, step int, reach int, size_a long, size_b long, rank long").repartition(5)
    by_pos = {r[0]: r for r in rows}
    want = []
    for pos, i, copies, step, reach, _, _, rank in rows:
        if reach < 400 and pos + step in by_pos:
            other = by_pos[pos + step]
            want.append((rank, other[7], pos, i, copies, step + other[3], reach - 32 + other[4]))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in ("7", "60", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            found = suffixes.doubled(df, 200, 32)
            assert sorted(map(tuple, found.collect())) == sorted(want)
        assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert suffixes.doubled(df.where("pos < 0"), 200, 32).count() == 0

    joins, real = [], DataFrame.join
    monkeypatch.setattr(DataFrame, "join", lambda self, other, *on: joins.append(on) or real(self, other, *on))
    texts = passages(7)
    suffixes.certain_repeats(suffixes.anchored(frame(spark, texts), 20), 20)
    assert not joins  # copies meet by sorting only


def test_periodic_stretches_are_settled_inside_their_text(spark):
    """Stretches of several periods and lengths, cut and joined at different places, equal and unequal before and after."""
    rng = random.Random(21)

    def noise(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))

    before, after = noise(40), noise(40)
    units = ["x", "no", "Is onhe. ", "a longer é unit, "]
    rows = []
    for d in range(80):
        unit = units[d % 4]
        stretch = (unit * 60)[rng.randrange(len(unit)) :][: rng.randint(10, 300)]
        parts = [rng.choice([before, noise(rng.randint(0, 30))])[rng.randint(0, 9) :], stretch, rng.choice([after, noise(rng.randint(0, 30)), (rng.choice(units) * 50)[:200]])]
        rows.append((d, "".join(parts)))
    rows += [(200, noise(30) + "Is onhe. " * 7 + noise(9)), (201, noise(100) + ("only here " * 30)[:211] + noise(100)), (202, "0123456789" * 3 + "9"), (203, rows[0][1])]
    for length in (20, 50):
        found = suffixes.remove_repeats(frame(spark, rows).repartition(3), length).collect()
        assert sorted((str(r.doc_id), r.n_bytes, list(r.spans), bytes(r.kept)) for r in found) == brute(rows, length)


def test_rows_that_are_sorted_do_not_grow_with_the_periods_of_a_stretch(spark, monkeypatch):
    rng, sent, real = random.Random(22), [], suffixes.ranked

    def counted(rows, by):
        sent.append((rows.count(), rows.agg(F.sum("copies")).first()[0]))
        return real(rows, by)

    def noise(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))

    monkeypatch.setattr(suffixes, "ranked", counted)
    for periods in (100, 400):
        rows = [(d, noise(300) + "Is onhe. " * periods + noise(300)) for d in range(30)]
        sent.clear()
        suffixes.certain_repeats(suffixes.anchored(frame(spark, rows), 200), 200)
        assert max(n for n, _ in sent) < 30 * 25  # a few hundred bytes of noise on both sides, four anchors of the stretch
        assert sent[0][1] > 30 * (periods - 5)  # yet every place of the gram is counted
