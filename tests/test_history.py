import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewheel.operators import history, order


def frame(spark, rows):
    return spark.createDataFrame(rows, "i long, start_station_id string, end_station_id string, duration_minutes double")


def test_first_estimates_do_not_see_their_own_row(spark):
    out = history.expanding_history(frame(spark, [(0, "a", "b", 10.0), (1, "a", "b", 20.0), (2, "a", "b", 999.0)]), "duration_minutes", ["i"]).orderBy("i").collect()
    assert [r["route_typical_minutes"] for r in out[:2]] == [10.0, 10.0]
    assert out[2]["route_typical_minutes"] == pytest.approx((30 + 20 * 15) / 22)
    assert [round(float(np.expm1(r["route_history_log_count"]))) for r in out] == [0, 1, 2]


def test_sums_beyond_a_long(spark):
    out = history.expanding_history(frame(spark, [(i, "a", "b", 4e12) for i in range(6)]), "duration_minutes", ["i"]).orderBy("i").collect()
    assert out[5]["route_typical_minutes"] == pytest.approx(4e12) and 5 * 4e12 * 1e6 > 2**63
    fitted = history.fit_history(frame(spark, [(i, "a", "b", 4e12) for i in range(6)]), "duration_minutes")
    assert fitted["route"].first()["_route_mean"] == pytest.approx(4e12)


def test_matches_a_sequential_pass(spark):
    rng = np.random.default_rng(3)
    n = 800
    pdf = pd.DataFrame({"i": np.arange(n), "start_station_id": np.where(rng.random(n) < 0.7, "hot", rng.integers(0, 9, n).astype(str)),
                        "end_station_id": rng.integers(0, 5, n).astype(str), "duration_minutes": rng.integers(100, 18000, n) / 100})
    pdf.loc[::50, "start_station_id"] = None
    rows = [tuple(None if v is None or v != v else v for v in r) for r in pdf.itertuples(index=False)]
    out = history.expanding_history(frame(spark, rows), "duration_minutes", ["i"]).toPandas().sort_values("i").reset_index()
    prior = pdf["duration_minutes"].expanding().mean().shift().fillna(10.0)
    for name, keys in {"route_typical_minutes": ["start_station_id", "end_station_id"], "start_typical_minutes": ["start_station_id"], "end_typical_minutes": ["end_station_id"]}.items():
        g = pdf.fillna({"start_station_id": "unknown"}).groupby(keys)["duration_minutes"]
        want = (g.cumsum() - pdf["duration_minutes"] + 20 * prior) / (g.cumcount() + 20)
        np.testing.assert_allclose(out[name], want)


def test_unseen_route_falls_back_to_the_global_mean(spark):
    fitted = history.fit_history(frame(spark, [(0, "a", "b", 10.0), (1, "a", "c", 20.0)]), "duration_minutes")
    row = history.apply_history(frame(spark, [(9, "x", "y", 1.0)]), fitted).first()
    assert row["route_history_log_count"] == 0.0 and row["route_typical_minutes"] == pytest.approx(15.0)
    known = history.apply_history(frame(spark, [(9, "a", "b", 1.0)]), fitted).first()
    assert known["route_typical_minutes"] == pytest.approx((10 + 20 * 15) / 21)


def test_no_history_gives_nulls(spark):
    row = history.apply_history(frame(spark, [(9, "x", "y", 1.0)]), None).first()
    assert row["start_typical_minutes"] is None


def test_ranges_grow_with_the_rows_and_doubles_are_the_decimals(spark, monkeypatch):
    monkeypatch.setattr(order, "_RANGE_ROWS", 50)  # far more ranges than shuffle partitions
    pinned = {}
    monkeypatch.setattr(order, "_range_sorted", lambda df, cols, label, ranges=None, f=order._range_sorted: pinned.setdefault("staged", f(df, cols, label, ranges)))
    rows = [(i, f"{i % 7}" if i % 11 else None, float((i * 37) % 101) * (1e13 if i % 2 else 1)) for i in range(2000)]
    df = spark.createDataFrame(rows, "i long, k string, x double")
    sums = {"s": F.col("x").cast("decimal(38,0)"), "n": F.lit(1).cast("long")}
    out = order.running_by_keys(df, ["i"], {"all": [], "k": ["k"]}, sums, "double").orderBy("i").collect()
    sizes = [r["count"] for r in pinned["staged"].groupBy(F.shiftright("_mid", 33).alias("p")).count().collect()]
    assert len(sizes) >= 30 and max(sizes) <= 200
    seen, total = {}, [0, 0]
    for (_, k, x), r in zip(rows, out, strict=True):
        mine = seen.setdefault(k, [0, 0])
        assert (r["all_s"], r["all_n"], r["k_s"], r["k_n"]) == (float(total[0]), total[1], float(mine[0]), mine[1])
        for t in (mine, total):
            t[0], t[1] = t[0] + int(x), t[1] + 1
