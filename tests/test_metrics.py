import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewheel.operators import metrics, prepare


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(8)
    y = (rng.random(900) < 0.4).astype(int)
    p = np.round(np.clip(0.25 * y + rng.random(900) * 0.7, 0, 1), 2)
    pdf = pd.DataFrame({"y": y, "p": p, "g": rng.integers(0, 3, 900)})
    return pdf, spark.createDataFrame(pdf)


def brute_auc(y, p):
    a, b = p[y == 1], p[y == 0]
    return ((a[:, None] > b[None, :]).sum() + 0.5 * (a[:, None] == b[None, :]).sum()) / (len(a) * len(b))


def test_auc_by_group(scored):
    pdf, df = scored
    for r in metrics.roc_auc(df, "p", "y", ["g"]).collect():
        part = pdf[pdf["g"] == r["g"]]
        assert r["auc"] == pytest.approx(brute_auc(part["y"].to_numpy(), part["p"].to_numpy()))
        assert r["positives"] == part["y"].sum()


def test_roc_and_average_precision(scored):
    pdf, df = scored
    curve = metrics.roc_curve(df, "p", "y").toPandas().sort_values("threshold", ascending=False)
    assert curve.iloc[0][["fpr", "tpr"]].tolist() == [0, 0] and curve.iloc[-1][["fpr", "tpr"]].tolist() == [1, 1]
    assert np.trapezoid(curve["tpr"], curve["fpr"]) == pytest.approx(brute_auc(pdf["y"].to_numpy(), pdf["p"].to_numpy()))
    ap, last = 0.0, 0.0
    for t in sorted(pdf["p"].unique(), reverse=True):
        hit = pdf["p"] >= t
        recall, precision = pdf["y"][hit].sum() / pdf["y"].sum(), pdf["y"][hit].mean()
        ap, last = ap + (recall - last) * precision, recall
    assert metrics.average_precision(df, "p", "y").first()[0] == pytest.approx(ap)


def test_sweep_compares_with_the_written_threshold(scored):
    """0.29 and other hundredths are not exact doubles."""
    pdf, df = scored
    for r in metrics.threshold_sweep(df, "p", "y").collect():
        hit = pdf["p"] >= round(r["threshold"], 2)
        assert (r["tp"], r["fp"]) == ((hit & (pdf["y"] == 1)).sum(), (hit & (pdf["y"] == 0)).sum())
        assert r["tp"] + r["fn"] == pdf["y"].sum() and r["tp"] + r["fp"] + r["tn"] + r["fn"] == len(pdf)


def test_rates_are_zero_without_rows(spark):
    r = metrics.add_rates(spark.createDataFrame([(5, 0, 0, 0)], "tn long, fp long, fn long, tp long")).first()
    assert (r["precision"], r["recall"], r["f1"], r["f2"], r["specificity"]) == (0, 0, 0, 0, 1)


def test_recall_threshold(scored, spark):
    pdf, df = scored
    for r in metrics.recall_threshold(df, "p", "y", [0.9, 0.98]).collect():
        positive = pdf["p"][pdf["y"] == 1]
        best = max(t for t in pdf["p"].unique() if (positive >= t).mean() >= r["target"])
        assert r["threshold"] == pytest.approx(np.floor(best * 1000) / 1000)
    with pytest.raises(Exception, match="not reachable"):
        metrics.recall_threshold(spark.createDataFrame([(0.5, 1)], "p double, y int"), "p", "y", [1.1]).collect()


def test_noise_correction_inverts_the_noise(spark):
    recall, fpr, pi, eps = 0.93, 0.2, 0.35, 0.08
    q = pi * (1 - eps) + (1 - pi) * eps
    a, b = pi * (1 - eps) / q, pi * eps / (1 - q)
    measured = a * recall + (1 - a) * fpr, b * recall + (1 - b) * fpr
    out = metrics.corrected_rates(F.lit(measured[0]), F.lit(measured[1]), F.lit(eps), F.lit(q))
    row = spark.range(1).select(*[c.alias(n) for n, c in out.items()]).first()
    assert row["recall"] == pytest.approx(recall) and row["specificity"] == pytest.approx(1 - fpr)
    assert row["accuracy"] == pytest.approx(recall * pi + (1 - fpr) * (1 - pi))


def test_confident_joint_sums_to_one(scored):
    _, df = scored
    out = metrics.confident_joint(df, "p", "y").toPandas()
    assert out["joint"].sum() == pytest.approx(1.0)
    share = out.groupby("given")["joint"].sum()
    assert share[1] == pytest.approx(df.agg(F.avg("y")).first()[0])


def test_regression_and_count_metrics(spark):
    y, p = np.array([0.0, 3.0, 5.0, 10.0]), np.array([0.0, 2.0, 7.0, 9.0])
    df = spark.createDataFrame(list(zip(y.tolist(), p.tolist())), "y double, p double")
    r = metrics.regression_metrics(df, "y", "p").first()
    assert (r["n"], r["mae"], r["median_ae"]) == (4, 1.0, 1.0)
    assert r["rmse"] == pytest.approx(np.sqrt(6 / 4)) and r["r2"] == pytest.approx(1 - 6 / ((y - y.mean()) ** 2).sum())
    c = metrics.count_metrics(df, "y", "p").first()
    lifted = np.maximum(p, 1e-6)
    dev = 2 * np.mean(np.where(y > 0, y * np.log(np.where(y > 0, y, 1) / lifted), 0) - (y - lifted))
    assert c["poisson_deviance"] == pytest.approx(dev)


def test_null_groups_are_kept(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), (None, 1.0, 4.0), (None, 3.0, 3.0)], "g string, y double, p double")
    out = {r["g"]: r["mae"] for r in metrics.error_groups(df, "y", "p", ["g"]).collect()}
    assert out == {"a": 1.0, None: 1.5}


def test_model_choice_and_gate(spark):
    table = spark.createDataFrame([("a", 3.50, 0.40), ("b", 3.58, 0.47), ("c", 3.70, 0.60)], "model string, mae double, r2 double")
    assert [r["model"] for r in metrics.select_model(table).where("selected").collect()] == ["b"]
    new = spark.createDataFrame([("p1", 10.3), ("p2", 99.0)], "test_period string, mae double")
    old = spark.createDataFrame([("p1", 10.0)], "test_period string, mae double")
    gate = {r["test_period"]: (r["comparable"], r["accepted"]) for r in metrics.quality_gate(new, old).collect()}
    assert gate == {"p1": (True, False), "p2": (False, True)}


def test_blend_matches_a_direct_search(spark):
    rng = np.random.default_rng(9)
    y = (rng.random(300) < 0.5).astype(int)
    s = {c: np.round(np.clip(0.3 * y + 0.6 * rng.random(300), 0, 1), 2) for c in ("p_a", "p_b", "p_c")}
    pdf = pd.DataFrame({"y": y, **s})
    sweep = prepare.blend_sweep(spark.createDataFrame(pdf), ["p_a", "p_b", "p_c"], "y", units=4)
    assert sweep.count() == 15 * 91
    best = metrics.best_threshold(sweep, 0.85, ["wa", "wb"]).where("choice = 'best accuracy'").first()
    top = 0.0
    for i in range(5):
        for j in range(5 - i):
            blend = (i / 4) * pdf["p_a"] + (j / 4) * pdf["p_b"] + ((4 - i - j) / 4) * pdf["p_c"]
            top = max(top, max((((blend >= k / 100) == (y == 1)).mean()) for k in range(5, 96)))
    assert best["accuracy"] == pytest.approx(top)


def test_blend_counts_equal_a_sweep_of_each_blend(spark):
    rng = np.random.default_rng(10)
    s = np.round(rng.random((500, 3)) * 1.2 - 0.1, 3)
    rows = [(*(None if rng.random() < 0.02 else float(x) for x in r), int(y) if y < 2 else None) for r, y in zip(s, rng.integers(0, 3, 500))]
    df = spark.createDataFrame(rows, "a double, b double, c double, y int").repartition(3)
    columns = ["threshold", "tn", "fp", "fn", "tp", "f2"]
    found = prepare.blend_sweep(df, ["a", "b", "c"], "y", units=3)
    for i, j in ((0, 0), (1, 1), (3, 0)):
        blend = (i / 3.0) * F.col("a") + (j / 3.0) * F.col("b") + ((3 - i - j) / 3.0) * F.col("c")
        want = metrics.threshold_sweep(df.where("y is not null").withColumn("s", blend), "s", "y").select(*columns)
        assert sorted(want.collect()) == sorted(found.where((F.col("wa") == i) & (F.col("wb") == j)).select(*columns).collect())
    assert prepare.blend_sweep(df.where("false"), ["a", "b", "c"], "y").count() == 0


def test_encoding_and_weights(spark):
    rows = [("a",)] * 6 + [("b",)] * 2 + [("c",)] * 5 + [("d",)]
    df = spark.createDataFrame(rows, "c string")
    table = {r["c"]: (r["ordinal"], r["slot"]) for r in prepare.categories(df, "c", 5).collect()}
    assert table == {"a": (0, 0), "b": (1, 2), "c": (2, 1), "d": (3, 2)}
    out = prepare.encode(spark.createDataFrame([("z",)], "c string"), prepare.categories(df, "c", 5), "c").first()
    assert out["ordinal"] == -1 and out["slot"] is None
    weights = {r["c"]: r["weight"] for r in prepare.balanced_weights(df, "c").collect()}
    assert weights["a"] == pytest.approx(14 / (4 * 6))


def test_impute_learns_on_train_only(spark):
    train = spark.createDataFrame([(1.0, "x"), (3.0, "x"), (8.0, "y")], "n double, k string")
    rows = spark.createDataFrame([(None, None), (100.0, "q")], "n double, k string")
    out = prepare.impute(rows, prepare.fill_values(train, medians=["n"], modes=["k"])).collect()
    assert (out[0]["n"], out[0]["k"], out[0]["n_missing"]) == (3.0, "x", 1) and out[1]["n"] == 100.0


def test_bootstrap_with_distinct_and_with_one_score_and_with_one_class(spark):
    rng = np.random.default_rng(12)
    for scores in (rng.random(700), np.repeat(0.5, 60), np.round(rng.random(500), 1)):
        y = (rng.random(len(scores)) < 0.4).astype(int)
        df = spark.createDataFrame([(float(s), int(t), i, i * 7) for i, (s, t) in enumerate(zip(scores, y))], "s double, y int, a long, b long")
        out = {r["rep"]: r for r in metrics.bootstrap_scores(df, "s", "y", F.col("a"), F.col("b"), 4, 0.3).collect()}
        steps = np.cumsum([math.exp(-1.0) / math.factorial(k) for k in range(12)]).round(12)
        for rep in range(4):
            x = (np.arange(len(y)) * 48271 + (np.arange(len(y)) * 7 + rep * 1_000_003) * 69621) % metrics.MODULUS
            for _ in range(2):
                x = ((x * x) % metrics.MODULUS * 48271 + x) % metrics.MODULUS
            w = np.searchsorted(steps, x / float(metrics.MODULUS), side="right")
            p, n = w * y, w * (1 - y)
            pairs = sum((p[i] * n * ((scores[i] > scores) + (scores[i] == scores) / 2)).sum() for i in range(len(y)))
            assert out[rep]["auc"] == pytest.approx(pairs / (p.sum() * n.sum()))
            assert out[rep]["recall"] == pytest.approx(p[scores >= 0.3].sum() / p.sum())
    one = metrics.bootstrap_scores(df.withColumn("y", F.lit(1)), "s", "y", F.col("a"), F.col("b"), 3, 0.3).collect()
    assert [(r["auc"], r["specificity"]) for r in one] == [(None, None)] * 3 and all(r["recall"] is not None for r in one)


def test_noise_corrections_undo_the_noise(spark):
    rng = np.random.default_rng(13)
    n, eps = 400_000, 0.15
    true = rng.random(n) < 0.35
    score = true + rng.normal(0, 1, n)
    label = true ^ (rng.random(n) < eps)
    cut = score > 0.4

    def auc(t):
        order = score.argsort().argsort()
        return (order[t].sum() - t.sum() * (t.sum() - 1) / 2) / (t.sum() * (~t).sum())

    given = spark.createDataFrame([(float(cut[label].mean()), float(cut[~label].mean()), float(auc(label)), float(label.mean()))], "r double, f double, a double, q double")
    fixed = {**metrics.corrected_rates(F.col("r"), F.col("f"), F.lit(eps), F.col("q")), **metrics.corrected_auc(F.col("a"), F.lit(eps), F.col("q"))}
    row = given.select(*[c.alias(k) for k, c in fixed.items()]).first()
    assert row["recall"] == pytest.approx(cut[true].mean(), abs=0.01) and row["specificity"] == pytest.approx((~cut[~true]).mean(), abs=0.01)
    assert row["accuracy"] == pytest.approx((cut == true).mean(), abs=0.01) and row["auc_true"] == pytest.approx(auc(true), abs=0.01)

    assert row["auc_perfect"] == pytest.approx(((label & true).sum() * (~label & ~true).sum() + ((label & true).sum() * (~label & true).sum() + (label & ~true).sum() * (~label & ~true).sum()) / 2) / (label.sum() * (~label).sum()), abs=0.01)
