import random

import corpus_pipeline
from pyspark.sql import functions as F
from tests.llm.conftest import DOC, edited, messy_rows, prose


def corpus():
    """Clean prose with labels, toxic and poor documents, near copies, and a passage that documents share."""
    rng = random.Random(8)
    rows, labels = [], []
    passage = prose(rng, 70)
    for i in range(400):
        words = prose(rng, rng.randint(60, 140)).split()
        toxic, poor = i % 8 == 1, i % 8 == 2
        if toxic:
            for _ in range(8):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "scum", "worthless"]))
        if poor:
            words = [w + rng.choice(["***", "&&&"]) for w in words]
        text = " ".join(words)
        if i in (400 - 5, 400 - 9, 400 - 13):
            text += " " + passage
        rows.append((i, text))
        labels.append((i, int(not poor), int(toxic)))
    copies = [(1000 + i, edited(rng, rows[8 * i][1], i % 3)) for i in range(6)]
    return rows + copies, labels, passage


def write(spark, folder, rows, labels):
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], DOC)
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_stages_act_on_planted_documents(spark, tmp_path):
    rows, labels, passage = corpus()
    write(spark, tmp_path, rows, labels)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {d: t for d, t in rows}
    for k, (name, step) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = step(spark, docs, str(tmp_path)).persist()
        assert docs.columns == [c.split()[0] for c in DOC.split(", ")]
        left = {r.doc_id: r.text for r in docs.collect()}
        lost = set(kept) - set(left)
        toxic, poor = {i for i in range(400) if i % 8 == 1}, {i for i in range(400) if i % 8 == 2}
        if name == "toxicity":
            assert lost == toxic
        elif name == "quality":
            assert lost == poor
        elif name == "near_duplicates":
            assert lost == {1000 + i for i in range(6)}
        elif name == "repeats":
            assert not lost and all(passage not in t for t in left.values())
            changed = {d for d in left if left[d] != kept[d]}
            assert changed == {400 - 5, 400 - 9, 400 - 13}
        kept = left
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(kept)
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert whole.agg(F.sum("length")).first() == packed.agg(F.sum("length")).first()


def test_odd_tables(spark, tmp_path):
    write(spark, f"{tmp_path}/odd", messy_rows(), [(1, 1, 0), (2, 0, 1), (None, 1, 1)])
    assert corpus_pipeline.run(spark, f"{tmp_path}/odd").count() > 0
    write(spark, f"{tmp_path}/none", [], [])
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_one_of_repeated_rows_stays(spark, tmp_path):
    text = prose(random.Random(1), 50)
    docs = spark.createDataFrame([(1, text, "en", "s", 1, "z")] * 3 + [(None, text, "en", "s", 1, "z"), (2, None, "en", "s", 0, "z")], DOC + ", _n string")
    out = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert sorted((str(r.doc_id), r.text is None) for r in out.collect()) == [("1", False), ("2", True)]


def test_rows_are_judged_by_id_and_text(spark):
    rng = random.Random(5)
    one, two, three, four, five = (prose(rng, 80) for _ in range(5))
    rows = [(1, one), (None, one), (None, two), (None, None), (None, ""), (4, three), (5, three), (5, four)]
    rows += [(None, five), (None, five), (None, five.upper())]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], DOC).repartition(3)
    out = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
    # a unique row without an id, rows without words and a unique text under a shared id stay
    want = [(1, one), (None, two), (None, None), (None, ""), (4, three), (5, four)]
    assert sorted(map(str, [x for x in out if (x[1] or "").lower() != five])) == sorted(map(str, want))
    assert len(out) == len(want) + 1


def test_messy_rows_lose_only_copies(spark):
    rows = messy_rows()
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], DOC)
    out = {(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
    assert (None, None) in out and (5, "you IDIOT!!! " * 4) in out and (None, rows[3][1]) not in out and (5, rows[5][1]) not in out


def test_texts_move_once_where_no_row_is_repeated(spark):
    """Decisions too large to broadcast: the join that drops copies shuffles the texts, and nothing else does."""
    rng = random.Random(9)
    texts = [prose(rng, 60) for _ in range(60)]
    rows = list(enumerate(texts)) + [(100 + i, edited(rng, t, 1)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], DOC)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2k")
    try:
        out = corpus_pipeline.drop_near_duplicates(spark, docs, "")
        plan = out._jdf.queryExecution().executedPlan().toString()  # before tasks have run, as it decides what is shuffled
        assert sorted(r.doc_id for r in out.collect()) == list(range(60))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert sum("SortMergeJoin" in j and "LeftAnti" in j for j in joins) == 1
    assert not any("SortMergeJoin" in j and "LeftSemi" in j for j in joins)
