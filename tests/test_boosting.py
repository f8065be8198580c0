"""Boosted trees against a direct implementation that looks at every row for every split."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewheel.operators import boosting

SCHEMA = "id long, x0 double, x1 double, x2 double, label double, pred_ string"


def table(n=900, seed=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)), 1)
    x[:, 2] = rng.integers(0, 5, n)
    y = np.where(x[:, 0] > 0.3, 4.0, 1.0) + x[:, 2] + rng.normal(size=n) ** 3
    gone = rng.random(n) < 0.2
    y[gone] += 3
    rows = []
    for k in range(n):
        first = (None if k % 2 else float("nan")) if gone[k] else float(x[k, 0])
        rows.append((k, first, float(x[k, 1]), float(x[k, 2]), float(y[k]), "z"))
    return rows


def direct(model, rows, loss, rounds, depth, rate, l2, least):
    """Predictions of trees that are grown by trying every cut on all rows of a node."""
    x = np.array([[math.nan if v is None else v for v in r[1:4]] for r in rows])
    y = np.array([r[4] for r in rows])
    score = np.full(len(y), model.start)

    def grow(at, level, g, h, leaf):
        best = None
        if level < depth:
            total = g[at].sum() ** 2 / (h[at].sum() + l2)
            for to_left in (False, True):
                for k in range(x.shape[1]):
                    for edge in [*model.edges[k], math.inf]:
                        left = np.where(np.isnan(x[at, k]), to_left, x[at, k] <= edge)
                        a, b = at[left], at[~left]
                        if min(len(a), len(b)) < least:
                            continue
                        gain = g[a].sum() ** 2 / (h[a].sum() + l2) + g[b].sum() ** 2 / (h[b].sum() + l2) - total
                        if gain > (best[0] + 1e-9 if best else 1e-6):
                            best = (gain, a, b)
        if best is None:
            leaf(at)
        else:
            grow(best[1], level + 1, g, h, leaf)
            grow(best[2], level + 1, g, h, leaf)

    for _ in range(rounds):
        if loss == "poisson":
            g, h = np.exp(score) - y, np.exp(score)
        else:
            g, h = (score - y if loss == "squared" else np.sign(score - y)), np.ones(len(y))
        new = score.copy()

        def leaf(at, g=g, h=h, new=new):
            if loss == "absolute":
                step = np.sort(y[at] - score[at])[(len(at) - 1) // 2]
            else:
                step = -g[at].sum() / (h[at].sum() + l2)
            new[at] = score[at] + rate * step

        grow(np.arange(len(y)), 0, g, h, leaf)
        score = new
    return np.exp(score) if loss == "poisson" else score


@pytest.mark.parametrize("loss", boosting.LOSSES)
def test_equals_a_direct_implementation(spark, loss, monkeypatch):
    monkeypatch.setattr(boosting, "REWRITE", 2)
    monkeypatch.setattr(boosting, "BLOCK", 100)
    rows = [(*r[:4], float(max(0, round(r[4]))) if loss == "poisson" else r[4], r[5]) for r in table()]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    model = boosting.fit_boosted(df, "label", ["x0", "x1", "x2"], loss, rounds=3, depth=3, rate=0.3, bins=8, l2=1.0, least=20)
    assert len(model.trees) == 3
    found = {r.id: r.p for r in model.predict(df, "p").collect()}
    wanted = direct(model, rows, loss, 3, 3, 0.3, 1.0, 20)
    assert np.allclose([found[r[0]] for r in rows], wanted, rtol=1e-6, atol=1e-6)


def test_held_out_error_falls_with_rounds(spark):
    df = spark.createDataFrame(table(3000, 9), SCHEMA)
    train, held = df.where("id % 4 <> 0"), df.where("id % 4 = 0")

    def error(rounds):
        model = boosting.fit_boosted(train, "label", ["x0", "x1", "x2"], "absolute", rounds=rounds, depth=3, rate=0.3)
        return model.predict(held, "p").agg(F.avg(F.abs(F.col("p") - F.col("label")))).first()[0]

    start, later = error(0), error(6)
    assert later < 0.7 * start


def test_odd_tables(spark):
    columns = ["x0", "x1", "x2"]
    none = spark.createDataFrame([], SCHEMA)
    model = boosting.fit_boosted(none, "label", columns, rounds=2)
    assert model.predict(none, "p").count() == 0 and model.predict(none, "p").columns == [*none.columns, "p"]
    # labels that are null or NaN, a column without values, one value only, repeated rows
    rows = [(1, None, 1.0, 2.0, None, "z"), (2, None, 1.0, 2.0, float("nan"), None), *[(3, None, 1.0, 2.0, 5.0, None)] * 70]
    df = spark.createDataFrame(rows, SCHEMA)
    for loss, wanted in (("squared", 5.0), ("absolute", 5.0), ("poisson", 5.0)):
        model = boosting.fit_boosted(df, "label", columns, loss, rounds=2)
        found = model.predict(df, "p").collect()
        assert len(found) == len(rows) and all(abs(r.p - wanted) < 1e-6 for r in found)
        assert all(r.p == found[0].p for r in boosting.fit_boosted(df, "label", [], loss).predict(df, "p").collect())
    with pytest.raises(ValueError):
        boosting.fit_boosted(df, "label", columns, "cubic")
    with pytest.raises(ValueError):
        boosting.fit_boosted(spark.createDataFrame([(1, 1.0, 1.0, 1.0, -1.0, None)], SCHEMA), "label", columns, "poisson")


def test_order_of_doubles():
    x = np.array([-math.inf, -5.5, -1e-310, 0.0, 1e-310, 2.0, 7e300, math.inf])
    u = boosting._in_order(x)
    assert (np.diff(u.astype(object)) > 0).all() and np.array_equal(boosting._from_order(u), x)
