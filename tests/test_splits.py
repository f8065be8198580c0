import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewheel.operators import splits


def numbers(spark, n):
    return spark.range(n).select(F.col("id").alias("i"), (F.col("id") % 3).cast("string").alias("c"))


def test_systematic_sample_bounds(spark):
    got = sorted(r["i"] for r in splits.systematic_sample(numbers(spark, 1000), ["i"], 100).collect())
    assert len(got) <= 100 and got[0] == 0 and got[-1] >= 990
    assert splits.systematic_sample(numbers(spark, 50), ["i"], 100).count() == 50


def test_sample_size_must_be_positive(spark):
    with pytest.raises(ValueError, match="positive"):
        splits.systematic_sample(numbers(spark, 10), ["i"], 0)


@pytest.mark.parametrize("n,m", [(1000, 7), (101, 100), (37, 2), (10, 10), (5, 9), (1000, 999), (9, 1)])
def test_linspace_sample(spark, n, m):
    got = sorted(r["i"] for r in splits.linspace_sample(numbers(spark, n), ["i"], m).collect())
    want = list(range(n)) if n <= m else sorted({j * (n - 1) // (m - 1) for j in range(m)}) if m > 1 else [0]
    assert got == want


def test_nested_split_sizes(spark):
    out = splits.nested_temporal_split(numbers(spark, 500), ["i"])
    got = {r["split"]: (r["n"], r["lo"], r["hi"]) for r in out.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.min("i").alias("lo"), F.max("i").alias("hi")).collect()}
    assert got == {"train": (320, 0, 319), "validation": (80, 320, 399), "test": (100, 400, 499)}


def test_two_rows_still_give_both_sides(spark):
    out = splits.temporal_split(numbers(spark, 2), ["i"]).orderBy("i").collect()
    assert [r["split"] for r in out] == ["train", "test"]


def test_last_week_of_each_month(spark):
    days = [("2024-02-22", "train"), ("2024-02-23", "test"), ("2024-12-24", "train"), ("2024-12-25", "test")]
    df = spark.createDataFrame(days, "d string, want string").withColumn("d", F.col("d").cast("timestamp_ntz"))
    assert df.where(splits.last_week_label(F.col("d")) != F.col("want")).count() == 0


def test_last_months(spark):
    hours = spark.sql("select explode(sequence(timestamp_ntz'2024-01-01', timestamp_ntz'2025-12-31 23:00:00', interval 1 hour)) as t")
    cut = hours.select(splits.last_months_cut(hours, "t", 12).alias("c")).first()["c"]
    assert cut == dt.datetime(2025, 1, 1)


def test_backtest_never_trains_on_the_future(spark):
    days = spark.sql("select explode(sequence(timestamp_ntz'2020-01-01', timestamp_ntz'2024-12-31', interval 1 day)) as t")
    out = splits.backtest_folds(days, "t", 3, 12)
    spans = {(r["fold"], r["role"]): (r["lo"], r["hi"]) for r in out.groupBy("fold", "role").agg(F.min("t").alias("lo"), F.max("t").alias("hi")).collect()}
    assert set(spans) == {(f, r) for f in range(3) for r in ("train", "validate")}
    for f in range(3):
        assert spans[f, "train"][1] < spans[f, "validate"][0]
    assert spans[2, "validate"][1] == dt.datetime(2024, 12, 31)
    assert spans[0, "validate"][1] < spans[1, "validate"][0]


def test_class_shares_are_kept(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 10 < 9, "big").otherwise("small").alias("c"))
    out = splits.stratified_split(rows, "c", splits.mixed_number(F.col("id"), F.lit(1)), ["id"], {"train": 0.7, "validation": 0.15, "test": 0.15})
    got = {(r["c"], r["split"]): r["count"] for r in out.groupBy("c", "split").count().collect()}
    assert got == {("big", "train"): 630, ("big", "validation"): 135, ("big", "test"): 135, ("small", "train"): 70, ("small", "validation"): 15, ("small", "test"): 15}


def test_folds_are_disjoint_and_balanced(spark):
    out = splits.stratified_folds(numbers(spark, 300), "c", splits.mixed_number(F.col("i"), F.lit(3)), ["i"], 5)
    assert out.count() == 300 and out.select("i").distinct().count() == 300
    assert {r["count"] for r in out.groupBy("c", "fold").count().collect()} == {20}


def test_group_folds_keep_groups_whole_and_balance(spark):
    rows = spark.range(1000).select((F.col("id") % 17).alias("g"))
    out = splits.group_folds(rows, F.col("g"), 4).toPandas()
    assert out["grp"].is_unique and len(out) == 17
    load = out.groupby("fold")["n"].sum()
    assert load.max() - load.min() <= out["n"].max()


def test_mixed_numbers_look_random(spark):
    out = spark.range(10000).select((splits.mixed_number(F.col("id"), F.lit(5)) % 10).alias("d")).groupBy("d").count().toPandas()
    chi2 = ((out["count"] - 1000) ** 2 / 1000).sum()
    assert 1.0 < chi2 < 27.9  # even steps would be far below, a bad mix far above


def test_training_windows_nest(spark):
    days = spark.sql("select explode(sequence(timestamp_ntz'2015-01-01', timestamp_ntz'2024-12-31', interval 1 day)) as t")
    out = splits.training_windows(days, "t", F.lit("2024-01-01").cast("timestamp_ntz"), [1, 3, None])
    got = {r["training_window"]: r["count"] for r in out.groupBy("training_window").count().collect()}
    assert got == {"last 1": 365, "last 3": 1095, "all": 3287}
