import random
import zlib

import numpy as np
import pytest

from pyspark.sql import functions as F
from tests.llm.conftest import frame, prose
from tidewheel.llm import quality, toxicity
from tidewheel.llm.frames import table


def labelled(spark, rows, name):
    return spark.createDataFrame(rows, f"doc_id long, {name} int, doc string")


@pytest.fixture(scope="module")
def toxic_rows():
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(500):
        words = prose(rng, rng.randint(5, 80)).split()
        bad = i % 4 == 0
        if bad:
            for _ in range(max(1, len(words) // 12)):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "M0R0N", "zorkel" + rng.choice(["", "an", "ing"])]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad), "x"))
    return rows, labels


@pytest.fixture(scope="module")
def quality_rows():
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(300):
        words = prose(rng, rng.randint(5, 80)).split()
        bad = i % 5 == 0
        if bad:
            words = [w + rng.choice(["***", "&&&", "###"]) for w in words] if i % 2 else [w for w in words for _ in range(8)]
        rows.append((i, " ".join(words)))
        labels.append((i, int(not bad), "x"))
    return rows, labels


def right(scores, labels):
    truth = {i: y for i, y, _ in labels}
    hits = [(r.score >= 0.3) == bool(truth[r.doc_id]) for r in scores if r.doc_id in truth]
    return sum(hits) / len(hits)


def test_pairs_of_one_word_share_a_feature():
    a, b = quality.hashed_features(["foo foo", "quux quux"], grams=())
    assert len(a) == 3 and a[2] == b[2] and a[0] == a[1] != b[0]
    assert [len(x) for x in quality.hashed_features(["", " \n", "ab"])] == [0, 0, 1]


def test_features_do_not_depend_on_where_a_text_stands():
    texts = ["  a bc", "a bc", "é é bc\n", "x" * 700 + " y"]
    together = [x.tolist() for x in quality.hashed_features(texts)]
    assert together == [next(quality.hashed_features([t])).tolist() for t in texts]


def test_margins_are_the_softmax():
    docs = [(np.array([1, 2, 5]), np.array([1, 1, 2]), 1), (np.array([3, 4]), np.array([2, 1]), 0)] * 5
    model = quality.SubwordModel.train(docs, bits=4, dim=3, epochs=30)
    for ids, n, y in docs[:2]:
        mean = (n / n.sum()) @ model.vectors[ids]
        logits = mean @ model.weights + model.bias
        p = np.exp(logits) / np.exp(logits).sum()
        odds = model.margins()[np.repeat(ids, n)].mean() + model.bias[1] - model.bias[0]
        assert p[1] == pytest.approx(1 / (1 + np.exp(-odds)), abs=1e-6) and (p[1] > 0.5) == bool(y)


def test_quality_on_held_out_rows(spark, quality_rows):
    rows, labels = quality_rows
    docs = frame(spark, rows)
    model = quality.fit(docs, labelled(spark, labels, "quality"), usable=F.col("doc_id") % 3 != 0)
    held = quality.score(docs.where("doc_id % 3 = 0"), model).collect()
    assert len(held) == 100 and right(held, labels) >= 0.95
    # the fit is the same whatever the partitions
    again = quality.fit(docs.repartition(7), labelled(spark, labels, "quality").repartition(5), usable=F.col("doc_id") % 3 != 0)
    assert np.array_equal(model.vectors, again.vectors)


def test_toxicity_on_held_out_rows(spark, toxic_rows):
    rows, labels = toxic_rows
    docs = frame(spark, rows)
    model = toxicity.fit(docs, labelled(spark, labels, "toxic"), usable=F.col("doc_id") % 3 != 0)
    assert any(s.startswith("zork") for s in model.stems)
    held = toxicity.score(docs.where("doc_id % 3 = 0"), model).collect()
    assert right(held, labels) >= 0.95 and all(0 <= r.score <= 1 for r in held)


def test_both_score_every_odd_row(spark, docs, no_docs, messy, toxic_rows, quality_rows):
    for module, (rows, labels), name in ((toxicity, toxic_rows, "toxic"), (quality, quality_rows, "quality")):
        model = module.fit(frame(spark, rows), labelled(spark, labels, name))
        found = module.score(docs, model).collect()
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in found) == sorted((d is None, d or 0) for d, _ in messy)
        by_text = {}
        texts = {d: t or "" for d, t in messy if d not in (None, 3, 4, 5)}
        for r in found:
            if r.doc_id in texts:
                assert by_text.setdefault(texts[r.doc_id], r.score) == r.score and 0 <= r.score <= 1
        assert module.score(no_docs, model).count() == 0
        kept = module.with_score(docs, model, "__s")
        assert kept.columns == [*docs.columns, "__s"] and kept.count() == len(messy)


def test_without_labels_or_with_one_class_all_scores_are_alike(spark, docs, no_docs):
    for module, name in ((toxicity, "toxic"), (quality, "quality")):
        nothing = module.fit(docs, labelled(spark, [], name))
        assert {r.score for r in module.score(docs, nothing).collect()} == {0.5}
        one = module.fit(docs, labelled(spark, [(1, 0, ""), (2, 0, ""), (None, 1, ""), (3, None, "")], name))
        assert all(r.score < 0.5 for r in module.score(docs, one).collect())
        assert module.fit(no_docs, labelled(spark, [(1, 0, ""), (2, 1, "")], name)) is not None


def test_dense_features_by_hand():
    import re

    text = "You are an IDIOT!! or m0r0n? sooo good 42"
    chunks = text.split()
    flags = np.array(toxicity.chunk_flags(chunks, frozenset({"good"})))
    got = dict(zip(toxicity.FEATURES, toxicity.text_features(text, flags), strict=True))
    assert got["lexicon"] == pytest.approx(2 / 9) and got["stems"] == pytest.approx(1 / 9)
    assert got["second"] == pytest.approx(1 / 9) and got["near"] == pytest.approx(2 / 9) and got["any_hit"] == 1
    assert got["all_capitals"] == pytest.approx(1 / 9) and got["disguised"] == pytest.approx(1 / 9) and got["stretched"] == pytest.approx(1 / 9)
    assert got["exclaim"] == pytest.approx(2 / len(text)) and got["upper"] == pytest.approx(len(re.findall("[A-Z]", text)) / len(text))
    assert toxicity.text_features("", np.zeros(0, np.int64))[:5] == [0, 0, 0, 0, 0]


def test_folds_are_crc32_of_the_id(spark):
    ids = spark.range(200).withColumnRenamed("id", "doc_id")
    for r in ids.select("doc_id", quality.held_out().alias("q"), toxicity.held_out().alias("t")).collect():
        crc = zlib.crc32(str(r.doc_id).encode())
        assert (r.q, r.t) == (crc % 5 == 0, crc % 4 == 2)


def test_table_accuracy(spark, sf="/root/testdata/sf0.01"):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = quality.fit(docs, labels, usable=~quality.held_out())
    truth = labels.where(quality.held_out()).select("doc_id", F.col("quality").alias("y"))
    rows = quality.score(docs, model).join(truth, "doc_id").collect()
    assert sum((r.score >= 0.3) == bool(r.y) for r in rows) >= 0.9 * len(rows) > 40
