import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidewheel.llm import two_fit
from tidewheel.llm.book import QUERIES, WORDS


def one_by_one(lengths, window):
    """Best-two-fit on documents, a window at a time."""
    left, bins = Counter(lengths), []
    while left:
        held, room = [], window
        while fits := [n for n in left if n <= room]:
            held.append(max(fits))
            left[held[-1]] -= 1
            left, room = +left, room - held[-1]
        while room and len(held) > 1:
            small = min(held)
            pairs = [(a + b, a, b) for a in left for b in left if b <= a and (a != b or left[a] > 1) and small < a + b <= small + room]
            if not pairs:
                break
            held.remove(small)
            left[small] += 1
            for n in max(pairs)[1:]:
                held.append(n)
                left[n] -= 1
            left, room = +left, window - sum(held)
        bins.append(tuple(sorted(held, reverse=True)))
    return Counter(bins)


@pytest.mark.parametrize("seed", range(60))
def test_plan_equals_filling_one_by_one(seed):
    rng = np.random.default_rng(seed)
    window, n = int(rng.integers(2, 60)), int(rng.integers(0, 120))
    lengths = (rng.integers(1, window + 1, n) if seed % 2 else np.minimum(window, rng.geometric(0.2, n))).tolist()
    found = Counter()
    for runs, times in two_fit.plan(Counter(lengths), window):
        found[tuple(x for length, k in runs for x in [length] * k)] += times
    assert found == one_by_one(lengths, window)


def test_plan_does_not_grow_with_the_documents():
    rng = np.random.default_rng(1)
    lengths, n = np.unique(np.minimum(4096, rng.lognormal(5.5, 1.3, 200_000).astype(int) + 1), return_counts=True)
    small = two_fit.plan(dict(zip(lengths.tolist(), n.tolist())))
    large = two_fit.plan(dict(zip(lengths.tolist(), (n * 10**6).tolist())))
    assert len(small) < 2 * 4096 and len(large) < 2 * 4096
    windows = sum(times for _, times in large)
    assert windows - 1 < (lengths * n * 10**6).sum() / 4096 * 1.001


def check(rows, texts, window, digest):
    """``rows`` from pack, ``texts`` by doc_id (unique): pieces cover their documents, sequences have no gaps."""
    library = Tokenizer.from_file(WORDS)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        ids = [*library.encode(texts[doc] or "", add_special_tokens=False).ids, 1]
        pieces.sort(key=lambda r: r["piece"])
        assert [r["start"] for r in pieces] == list(range(0, len(ids), window))
        for k, r in enumerate(pieces):
            part = ids[k * window : (k + 1) * window]
            assert r["piece"] == k and r["length"] == len(part) and r["doc_tokens"] == len(ids)
            assert (r["ids_crc32"] if digest else r["ids"]) == (zlib.crc32(np.array(part, "<u4").tobytes()) if digest else part)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
    assert set(by_sequence) == set(range(len(by_sequence)))
    return Counter(tuple(sorted((r["length"] for r in p), reverse=True)) for p in by_sequence.values())


@pytest.mark.parametrize("window, digest", [(4096, True), (50, False)])
def test_pieces_and_sequences(spark, docs, messy, window, digest):
    import pyspark.sql.functions as F

    unique = docs.withColumn("doc_id", F.monotonically_increasing_id()).persist()
    texts = {r["doc_id"]: r["text"] for r in unique.collect()}
    rows = two_fit.pack(unique, WORDS, window=window, digest=digest).collect()
    found = check(rows, texts, window, digest)
    assert found == one_by_one([r["length"] for r in rows], window)
    assert two_fit.pack(docs, WORDS, digest=True).count() >= len(messy)  # null and shared ids


def test_ties_and_a_text_of_megabytes(spark):
    rng = random.Random(2)
    texts = {k: "same words here" for k in range(3000)} | {3000: "ab " * 1_700_000, 3001: "x" * 300_000, 3002: "".join(rng.choice("abc .") for _ in range(400_000))}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(7)
    check(two_fit.pack(df, WORDS, digest=True).collect(), texts, 4096, True)


def test_nothing(no_docs):
    assert two_fit.pack(no_docs, WORDS).count() == 0


def test_query_on_given_tables(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op11_best_two_fit"](spark, sf).collect()
    found = check(rows, texts, 4096, True)
    assert sum(found.values()) == -(-sum(r["length"] for r in rows) // 4096)
