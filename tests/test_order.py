import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewheel.operators import order


@pytest.fixture(autouse=True)
def small_ranges_stay_apart(spark):
    """Tiny test data would otherwise be merged into one partition."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def skewed(n=3000, seed=1):
    """One key holds 80 % of the rows, many rows are exact copies."""
    rng = np.random.default_rng(seed)
    key = np.where(rng.random(n) < 0.8, "hot", rng.integers(0, 30, n).astype(str))
    return pd.DataFrame({"k": key, "t": rng.integers(0, 200, n), "x": rng.integers(0, 50, n).astype(float)})


def test_row_index_counts_every_row_once_in_order(spark):
    pdf = skewed()
    out = order.row_index(spark.createDataFrame(pdf), ["t", "k", "x"]).toPandas()
    assert sorted(out["idx"]) == list(range(len(pdf)))
    assert set(out["idx_n"]) == {len(pdf)}
    by_index = out.sort_values("idx")[["t", "k", "x"]].reset_index(drop=True)
    pd.testing.assert_frame_equal(by_index, pdf[["t", "k", "x"]].sort_values(["t", "k", "x"]).reset_index(drop=True))


def test_copies_of_one_row_are_spread_over_partitions(spark):
    same = spark.range(4000).select(F.lit("a").alias("k"), F.lit(1).alias("t"))
    staged = order._range_sorted(same.withColumn("_scan", F.monotonically_increasing_id()), ["t", "_scan"], "copies")
    sizes = [r["count"] for r in staged.groupBy(F.shiftright("_mid", 33)).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 4000 * 0.7


def test_hot_key_is_spread_over_partitions(spark):
    rows = spark.range(4000).select(F.when(F.col("id") % 10 > 0, "hot").otherwise("cold").alias("k"), F.col("id").alias("t"))
    staged = order._range_sorted(rows, ["k", "t"], "hot")
    hot = [r["count"] for r in staged.where("k = 'hot'").groupBy(F.shiftright("_mid", 33)).count().collect()]
    assert len(hot) >= 3 and max(hot) < 3600 * 0.6


def test_running_totals_match_pandas(spark):
    pdf = skewed().sort_values(["t", "x", "k"]).reset_index(drop=True)
    pdf["i"] = np.arange(len(pdf))
    pdf.loc[pdf["k"] == "7", "k"] = None
    want_sum = pdf.groupby("k", dropna=False)["x"].cumsum() - pdf["x"]
    total = pdf.groupby("k", dropna=False)["x"].transform("sum")
    out = order.running_totals(spark.createDataFrame(pdf), ["k"], ["i"], {"s": "x"}).toPandas().sort_values("i")
    assert len(out) == len(pdf)
    np.testing.assert_allclose(out["s_before"], want_sum)
    np.testing.assert_allclose(out["s_total"], total)


def test_rows_move_once_after_the_range_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame(skewed()).withColumn("i", F.monotonically_increasing_id())
        plan = order.running_totals(df, ["k"], ["i"], {"s": "x"})._jdf.queryExecution().executedPlan().toString()
        # rows once (for the window, which serves the join), the sums of each partition and key, and their offsets
        assert len(re.findall(r"Exchange hashpartitioning\(_part", plan.split("Initial Plan")[-1])) == 3
        wide = order.running_by_keys(df, ["i"], {"all": [], "k": ["k"], "kt": ["k", "t"]}, {"n": F.lit(1).cast("long")})
        plan = wide._jdf.queryExecution().executedPlan().toString()
        assert plan.split("Initial Plan")[-1].count("REPARTITION_BY_COL") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_several_key_sets_match_pandas(spark):
    pdf = skewed().sort_values(["t", "x", "k"]).reset_index(drop=True)
    pdf["i"] = np.arange(len(pdf))
    pdf.loc[pdf["k"] == "7", "k"] = None
    sets = {"all": [], "k": ["k"], "kt": ["k", "t"], "t": ["t"]}
    out = order.running_by_keys(spark.createDataFrame(pdf), ["i"], sets, {"s": F.col("x").cast("long"), "n": F.lit(1).cast("long")}).toPandas().sort_values("i")
    for tag, keys in sets.items():
        groups = pdf.groupby(keys, dropna=False) if keys else pdf.groupby(np.zeros(len(pdf)))
        assert (out[f"{tag}_s"].astype(float).to_numpy() == (groups["x"].cumsum() - pdf["x"]).to_numpy()).all()
        assert (out[f"{tag}_n"].astype(int).to_numpy() == groups.cumcount().to_numpy()).all()


def test_sums_of_several_key_sets_beyond_a_long(spark):
    rows = [(i, "a" if i % 3 else None, -(10**18) * 9 if i % 2 else 9 * 10**18 + i) for i in range(60)]
    df = spark.createDataFrame(rows, "i long, k string, v long")
    for value, times in ((F.col("v"), 1), (F.col("v").cast("decimal(30,0)") * 1000, 1000)):
        out = order.running_by_keys(df, ["i"], {"all": [], "k": ["k"]}, {"s": value}).orderBy("i").collect()
        for i, r in enumerate(out):
            assert int(r["all_s"]) == times * sum(x for _, _, x in rows[:i])
            assert int(r["k_s"]) == times * sum(x for _, k, x in rows[:i] if k == rows[i][1])


def test_quantiles_match_numpy(spark):
    pdf = skewed()
    pdf["x"] = pdf["x"] + np.random.default_rng(2).random(len(pdf))
    pdf.loc[::17, "x"] = np.nan
    out = order.exact_quantiles(spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "k string, t long, x double"),
                                ["k"], "x", {"a": 0.25, "b": 0.5, "c": 0.975}).toPandas().set_index("k")
    for key, part in pdf.groupby("k"):
        values = part["x"].dropna()
        assert out.loc[key, "n"] == len(values)
        np.testing.assert_allclose(out.loc[key, ["a", "b", "c"]].astype(float), np.quantile(values, [0.25, 0.5, 0.975]))


def test_buckets_never_fall_where_values_rise(spark):
    rng = np.random.default_rng(7)
    values = np.concatenate([rng.normal(0, 10.0 ** rng.integers(-300, 300, 3000)), rng.normal(0, 1e-6, 500), [0.0, -0.0, 1e308, -1e308, 5e-324, np.inf, -np.inf], 2.0 ** np.arange(-40, 40)])
    rows = spark.createDataFrame([(float(v),) for v in np.sort(values)] + [(float("nan"),)], "v double").select("v", order.value_bucket(F.col("v")).alias("b")).collect()
    buckets = [r["b"] for r in rows]
    assert buckets == sorted(buckets)


def test_quantiles_of_odd_values(spark):
    rng = np.random.default_rng(8)
    for values in ([3.0], [1.0, 1.0, 1.0], (rng.normal(0, 1, 400) * 10.0 ** rng.integers(-12, 12, 400)).tolist(), (1.0 + rng.random(300) * 1e-12).tolist(), [-5e-324, 0.0, 5e-324]):
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(3)
        row = order.exact_quantiles(df, [], "x", {"a": 0.1, "b": 0.5, "c": 1.0}).first()
        np.testing.assert_allclose([row["a"], row["b"], row["c"]], np.quantile(values, [0.1, 0.5, 1.0]), rtol=1e-15, atol=0)
        assert row["n"] == len(values)
    assert order.exact_quantiles(spark.createDataFrame([], "k string, x double"), ["k"], "x", {"a": 0.1}).count() == 0


def test_only_values_near_a_quantile_are_shuffled(spark):
    df = spark.range(20000).select((F.rand(3) * 1000).alias("x"))
    seen = {}
    real = order.running_totals
    try:
        order.running_totals = lambda cells, *a, **k: real(seen.setdefault("cells", cells), *a, **k)
        order.exact_quantiles(df, [], "x", {"m": 0.5}).collect()
    finally:
        order.running_totals = real
    assert seen["cells"].count() < 20000 / 50


def test_average_ranks_match_pandas(spark):
    pdf = skewed()
    out = order.average_ranks(spark.createDataFrame(pdf), [], "x").toPandas().set_index("x")["avg_rank"]
    want = pdf["x"].rank()
    assert (pdf["x"].map(out) == want).all()


def test_merged_ranges_give_the_same_totals(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    pdf = skewed()
    out = order.row_index(spark.createDataFrame(pdf), ["t", "k", "x"]).toPandas()
    assert sorted(out["idx"]) == list(range(len(pdf)))

