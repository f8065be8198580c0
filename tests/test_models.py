import datetime as dt
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tidewheel.operators import prepare
from tidewheel.plans import modeling, models_book
from tidewheel.plans import views as v
from tidewheel.session import staging_root


ROOT = Path(__file__).resolve().parents[1]


def test_group_mean_with_fallback(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 8.0)], "k string, y double")
    means, overall = prepare.group_means(train, ["k"], "y")
    out = prepare.predict_group_mean(spark.createDataFrame([("a",), ("z",)], "k string"), means, overall, ["k"]).orderBy("k").collect()
    assert [r["pred"] for r in out] == [2.0, 4.0]


def test_recent_months(spark):
    days = spark.createDataFrame([(dt.datetime(2023, m, 1),) for m in range(1, 13)], "t timestamp_ntz")
    assert prepare.recent(days, "t", 3).count() == 3


def test_permuted_columns_are_a_permutation(spark):
    rows = spark.createDataFrame([(i % 7, i, float(i)) for i in range(300)], "a long, b long, x double")
    placed = modeling.positions(rows, ["a", "b"])
    one, two = (modeling.permuted(placed, ["x"], repeat).toPandas() for repeat in (0, 1))
    for out in (one, two):
        assert sorted(out["_p_x"]) == sorted(out["x"]) and (out["_p_x"] == out["x"]).mean() < 0.1
    assert (one.sort_values("b")["_p_x"].to_numpy() == two.sort_values("b")["_p_x"].to_numpy()).mean() < 0.1
    assert modeling.permuted(modeling.positions(rows.where("false"), ["a", "b"]), ["x"], 0).count() == 0


def test_keyed_bijection_uses_every_number_once():
    for n in (1, 2, 3, 10, 17, 99, 100, 101, 5000, 65537):
        for key in (1, 2, 12345):
            out = modeling.keyed_bijection(np.arange(n), n, key)
            assert np.array_equal(np.sort(out), np.arange(n))
    many = modeling.keyed_bijection(np.arange(100_000), 100_000, 3)
    assert abs(np.corrcoef(np.arange(100_000), many)[0, 1]) < 0.02 and (many == np.arange(100_000)).sum() < 20


def test_candidates_are_drawn_from_their_ranges_and_repeatable():
    space = {"a": modeling.Between(2, 5), "b": modeling.Between(1, 1000, log=True), "c": modeling.Between(0.1, 0.2, whole=False), "d": ["x", "y"]}
    drawn = modeling.sampled(space, 200, 7)
    assert drawn == modeling.sampled(space, 200, 7) != modeling.sampled(space, 200, 8)
    assert {c["a"] for c in drawn} == {2, 3, 4, 5} and {c["d"] for c in drawn} == {"x", "y"}
    assert all(1 <= c["b"] <= 1000 and 0.1 <= c["c"] <= 0.2 for c in drawn) and 0.3 < np.mean([c["b"] < 32 for c in drawn]) < 0.7
    assert len(modeling.sampled({"a": modeling.Between(1, 3)}, 10, 1)) == 3
    assert modeling.grid({"a": [1, 2], "b": [3]}) == [{"a": 1, "b": 3}, {"a": 2, "b": 3}]


def test_halving_drops_candidates_and_equals_a_cross_validation(spark):
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.feature import VectorAssembler

    rng = np.random.default_rng(3)
    x = rng.random((600, 2))
    y = (x[:, 0] + 0.3 * rng.random(600) > 0.6).astype(float)
    rows = spark.createDataFrame([(float(a), float(b), float(t), i % 3) for i, ((a, b), t) in enumerate(zip(x, y))], "a double, b double, y double, fold int")
    learner, judge = DecisionTreeClassifier(labelCol="y", seed=1), BinaryClassificationEvaluator(labelCol="y")
    stages = [VectorAssembler(inputCols=["a", "b"], outputCol="features")]
    search = modeling.FoldSearch(rows, stages, learner, judge)
    candidates = modeling.grid({"maxDepth": [1, 2, 3, 5]})
    found = search.halving(candidates, [([0], 2), ([1, 2], None)])
    assert sorted(len(s) for _, s in found) == [1, 1, 3, 3]
    first = [s[0] for _, s in found]
    assert {c["maxDepth"] for c, s in found if len(s) == 3} == {candidates[i]["maxDepth"] for i in sorted(range(4), key=lambda i: -first[i])[:2]}
    direct = learner.copy({learner.maxDepth: 3}).fit(stages[0].transform(rows.where("fold <> 0"))).transform(stages[0].transform(rows.where("fold = 0")))
    assert first[2] == pytest.approx(judge.evaluate(direct))


def test_out_of_fold_scores_cover_every_row_once(spark):
    rng = np.random.default_rng(13)
    x = rng.normal(size=300)
    rows = [(i, float(v), float(v + rng.normal() > 0), i % 3) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "i long, x double, y double, fold int")
    oof = modeling.out_of_fold(df, [VectorAssembler(inputCols=["x"], outputCol="features")], {"m": modeling.logistic()}, range(3))
    assert oof.count() == 300 and oof.select("i").distinct().count() == 300
    assert oof.stat.corr("p_m", "x") > 0.9


def test_profiles_sum_to_one(spark):
    trips = spark.range(500).select((F.col("id") % 3).cast("string").alias("start_station_id"), (F.col("id") % 48).cast("int").alias("slot"))
    out = modeling.slot_profiles(trips, 10).toPandas()
    assert len(out) == 3 and out.drop(columns="start_station_id").sum(axis=1).to_numpy() == pytest.approx([1, 1, 1])


def test_zone_numbers_follow_the_load(spark):
    rows = [("a", 5, 10), ("b", 5, 1), ("c", 7, 50), ("d", 2, 3)]
    out = {r["start_station_id"]: r["zone"] for r in modeling.zones_by_rank(spark.createDataFrame(rows, "start_station_id string, raw_zone int, trips long")).collect()}
    assert out == {"c": 0, "a": 1, "b": 1, "d": 2}


def test_staging_follows_the_session(spark, tmp_path):
    own = f"tidewheel/{spark.sparkContext.applicationId}"
    if named := spark.conf.get("spark.checkpoint.dir", None):  # the cluster's choice comes first
        assert staging_root(spark) == f"{named.rstrip('/')}/{own}"
        return
    before = spark.conf.get("tidewheel.staging.dir")
    spark.conf.set("tidewheel.staging.dir", str(tmp_path))
    try:
        assert staging_root(spark) == f"{tmp_path}/{own}"
        spark.conf.unset("tidewheel.staging.dir")
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            staging_root(spark)
    finally:
        spark.conf.set("tidewheel.staging.dir", before)


def test_staged_folders_go_with_the_session(tmp_path):
    code = f"""
from tidewheel.session import local_session, stage, staging_root
spark = local_session("1", "brief", {str(tmp_path)!r})
spark.conf.set("spark.sql.shuffle.partitions", "2")
out = stage(spark.range(10).groupBy("id").count(), "x")
import glob
print(staging_root(spark), out.count(), len(glob.glob(staging_root(spark) + "/x-*")))
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    folder, rows, staged = done.stdout.split()[-3:]
    assert (rows, staged) == ("10", "1") and not Path(folder.removeprefix("file:")).exists()


def trips_between(spark, stations, n=20_000):
    """Minutes that depend on the station's number."""
    rows = spark.range(n).select(
        F.format_string("s%05d", F.col("id") % stations).alias("station"), (F.col("id") % 7).cast("double").alias("x"),
        ((F.col("id") % stations) / (stations / 10) + F.col("id") % 7).alias("y"))
    return rows


def test_trees_take_thousands_of_stations_and_unseen_ones(spark):
    rows = trips_between(spark, 5000)
    learner = GBTRegressor(labelCol="y", maxIter=5, maxDepth=5, maxBins=64, seed=1, predictionCol="raw")
    model = modeling.fit(rows, modeling.tree_stages(["station"], ["x"]), learner)
    fitted = model.transform(rows).agg(F.avg(F.abs(F.col("raw") - F.col("y"))).alias("e")).first()["e"]
    assert fitted < 1.2  # without the stations about 2.5
    strange = spark.createDataFrame([("nowhere", 1.0), (None, 2.0)], "station string, x double")
    out = model.transform(strange).collect()
    assert len(out) == 2 and all(r["_c_station"] == -1 and np.isfinite(r["raw"]) for r in out)


def test_rare_values_and_unknown_ones_share_a_column(spark):
    rows = spark.createDataFrame([("a",)] * 9 + [("b",)] * 6 + [("c",)] * 2 + [("d",)], "k string")
    model = modeling.Codes(["k"], 5).fit(rows)
    asked = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("new",)], "k string")
    assert [r["_c_k"] for r in model.transform(asked).collect()] == [0.0, 1.0, 2.0, 2.0, 2.0]


def test_the_zone_is_a_category_of_the_demand_model(spark, sf):
    rows = modeling.demand_frame(spark, sf)
    model = modeling.demand_model(rows, rounds=1)
    marks = model.transform(modeling.as_double(rows, modeling.DEMAND_NUMBERS)).schema["features"].metadata["ml_attr"]["attrs"]
    assert any(a["name"] == "_n_zone" for a in marks["nominal"]) and len(marks["numeric"]) == len(modeling.DEMAND_NUMBERS)


def test_published_models_pass_the_gate_or_stay(spark, sf, tmp_path):
    rows = modeling.demand_frame(spark, sf)
    train, test = rows.where("split = 'train'"), rows.where("split = 'test'")
    good = modeling.demand_model(train, rounds=5)
    bad = modeling.demand_model(train.withColumn("log_trips", F.lit(3.0)), rounds=1)
    models_book.publish(spark, good, {"test_period": "p", "mae": 1.5}, str(tmp_path))
    again, about = models_book.published(spark, str(tmp_path))
    assert about.first().asDict() == {"test_period": "p", "mae": 1.5}
    assert models_book.gate(good, again, test, "p").first()["accepted"] is True
    assert models_book.gate(bad, again, test, "p").first()["accepted"] is False


def test_every_fold_is_judged_by_the_cascade(spark, sf):
    out = models_book.cascade_specialist(spark, sf).collect()
    assert {r["model"] for r in out} == {"p_first", "p_special"} and all(0 <= r["auc"] <= 1 for r in out)
    # all five folds hold doubtful rows
    rows = modeling.risk_frame(spark, sf)
    model = modeling.fit(rows, models_book.risk_stages(), modeling.logistic())
    doubt = modeling.risk_scores(model, rows).where(F.col("p").between(0.3, 0.7))
    assert doubt.select("fold").distinct().count() == 5


def test_scores_and_probes_of_a_fitted_duration_model(spark, sf):
    scored = models_book.score_batch(spark, sf)
    assert scored.where(~F.col("predicted_duration_minutes").between(0, 180)).count() == 0 and scored.count() > 0
    checks = {r["check_name"]: r["passed"] for r in models_book.plausibility_checks(spark, sf).collect()}
    assert checks["duration in range"] and checks["unknown stations on a holiday in range"]


def test_components_follow_a_direct_decomposition(spark, sf):
    rows = v.table(spark, sf, "embeddings").orderBy("vec_id").select("vec_id", "embedding").collect()
    x = np.array([r["embedding"] for r in rows], float)
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    _, s, vt = np.linalg.svd(z - z.mean(0), full_matrices=False)
    got = models_book.pca_2d(spark, sf).orderBy("vec_id").toPandas()
    for k, name in enumerate(["pc1", "pc2"]):
        want = z @ vt[k]
        assert np.abs(np.corrcoef(want, got[name])[0, 1]) == pytest.approx(1, abs=1e-6)


def test_more_zones_cost_less(spark, sf):
    out = models_book.choose_k(spark, sf).orderBy("k").collect()
    costs = [r["cost"] for r in out]
    assert [r["k"] for r in out] == [3, 5, 10, 15] and costs == sorted(costs, reverse=True)


def test_a_learner_reads_parts_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(modeling, "FIT_ROWS", 100)
    rows = modeling.stage(spark.range(2000).select(F.col("id").cast("double").alias("x"), (F.col("id") % 2).cast("double").alias("y"), F.lit("other").alias("z")).coalesce(1), "parts")
    seen = []

    class Watched(type(modeling.logistic())):
        def _fit(self, dataset):
            seen.append((dataset.columns, dataset.select(F.spark_partition_id().alias("p")).groupBy("p").count().agg(F.max("count")).first()[0]))
            return super()._fit(dataset)

    learner = Watched(labelCol="y", featuresCol="features", maxIter=2)
    stages = [VectorAssembler(inputCols=["x"], outputCol="features")]
    modeling.fit(rows, stages, learner)
    modeling.out_of_fold(rows.withColumn("fold", (F.col("x") % 4).cast("int")), stages, {"m": learner}, range(2))
    assert [columns for columns, _ in seen] == [["features", "y"]] * 3
    assert max(n for _, n in seen) <= 110


def test_folds_are_dealt_out_once(spark, monkeypatch):
    """However many folds, fits and candidates there are, rows are shuffled for learners once, and no fold is written."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rng = np.random.default_rng(17)
    x = rng.normal(size=400)
    made = [(float(a), "abc"[i % 3], float(a + 0.3 * rng.normal() > 0), i % 4) for i, a in enumerate(x)]
    rows = modeling.stage(spark.createDataFrame(made, "x double, k string, y double, fold int"), "folds")
    dealt, written = [], []
    frame, stage = type(rows), modeling.stage
    repartition = frame.repartition
    monkeypatch.setattr(frame, "repartition", lambda self, *a: (dealt.append(a), repartition(self, *a))[1])
    monkeypatch.setattr(modeling, "stage", lambda df, label: (written.append(label), stage(df, label))[1])
    tree = DecisionTreeClassifier(labelCol="y", seed=1)
    oof = modeling.out_of_fold(rows, modeling.linear_stages(["k"], ["x"]), {"m": modeling.logistic(), "t": tree}, range(4))
    assert oof.count() == 400 and oof.stat.corr("p_m", "x") > 0.8
    assert len(dealt) == 1 and written == ["oof"]
    with modeling.dealt(rows) as kept:
        search = modeling.FoldSearch(kept, modeling.tree_stages(["k"], ["x"]), tree, BinaryClassificationEvaluator(labelCol="y"), even=True)
        scores = [s for _, s in search.halving(modeling.grid({"maxDepth": [1, 3]}), [([0, 1], 1), ([2], None)])]
        model = modeling.fit(kept.where("fold > 1"), modeling.linear_stages(["k"], ["x"]), modeling.logistic(), even=True)
    assert sorted(map(len, scores)) == [2, 3] and all(0.8 < x <= 1 for s in scores for x in s)
    assert model.transform(rows).count() == 400
    assert len(dealt) == 2 and written == ["oof"]


def test_one_hot_codes_follow_the_library(spark):
    """Common, rare, null, unseen and oddly ordered values; one pass over the rows counts them all."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer

    values = ["b"] * 7 + ["\U0001f600"] * 7 + ["\uff5e"] * 7 + ["a"] * 9 + ["rare"] * 2 + [None] * 2
    rows = spark.createDataFrame([(x, "one", i % 5) for i, x in enumerate(values)], "k string, whole string, n int")
    asked = spark.createDataFrame([(x, y, z) for x in ["a", "b", "\U0001f600", "\uff5e", "rare", "new", None] for y in ["one", "two", None] for z in [0, 4, 9]], rows.schema)
    columns = ["k", "whole", "n"]
    index = StringIndexer(inputCols=columns, outputCols=[f"i_{c}" for c in columns], handleInvalid="keep", stringOrderType="frequencyDesc").fit(rows)
    common = {"k": 4, "whole": 1, "n": 5}

    def coded(df):
        return index.transform(df).withColumns({f"c_{c}": F.least(F.col(f"i_{c}"), F.lit(float(common[c]))) for c in columns})

    encoder = OneHotEncoder(inputCols=[f"c_{c}" for c in columns], outputCols=[f"o_{c}" for c in columns], handleInvalid="keep").fit(coded(rows))
    found = modeling.OneHotCodes(columns, 5).fit(rows).transform(encoder.transform(coded(asked)))
    for r in found.collect():
        assert all(r[f"_o_{c}"] == r[f"o_{c}"] and r[f"_c_{c}"] == r[f"c_{c}"] for c in columns)
    ordered = StringIndexer(inputCol="k", outputCol="i", handleInvalid="keep", stringOrderType="alphabetAsc").fit(rows)
    codes = modeling.Codes(["k"]).fit(rows).transform(ordered.transform(asked)).collect()
    assert all(r["_c_k"] == (-1 if r["i"] == len(ordered.labels) else r["i"]) for r in codes)


def test_no_median_is_looked_for_where_no_number_lacks(spark):
    rows = spark.createDataFrame([(1.0, None, float("nan")), (2.0, 5.0, 1.0)], "a double, b double, c double")
    assert modeling.complete(rows, ["a", "b", "c"]) == ["a"] and modeling.complete(rows, []) == []
    for whole, filled in ((["a"], [["b", "c"]]), (["a", "b", "c"], []), ([], [["a", "b", "c"]])):
        for stages in (modeling.linear_stages([], ["a", "b", "c"], whole=whole), modeling.tree_stages([], ["a", "b", "c"], whole=whole)):
            assert [x.getInputCols() for x in stages[:-1]] == filled
            assert stages[-1].getInputCols() == [c if c in whole else f"_f_{c}" for c in "abc"]


def test_weights_of_classes_do_not_shuffle_rows_by_class(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = spark.createDataFrame([(float(i % 4 == 0), i) for i in range(40)], "y double, i long")
        out = prepare.with_balanced_weights(rows, rows, "y")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert {r["y"]: r["weight"] for r in out.collect()} == {1.0: 2.0, 0.0: pytest.approx(2 / 3)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
