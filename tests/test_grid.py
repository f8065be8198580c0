import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewheel.functions import features
from tidewheel.operators import aggregate, grid, joins
from tidewheel.plans import demand


def hours(spark, values):
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "time timestamp_ntz, x double")


def test_interpolation_is_limited_from_the_left(spark):
    out = grid.interpolate_limit(hours(spark, [None, 1.0, None, None, None, 5.0, None, None, None]), "x").orderBy("time")
    assert [r["x"] for r in out.collect()] == [None, 1.0, 2.0, 3.0, None, 5.0, 5.0, 5.0, None]


def test_interpolation_matches_pandas(spark):
    rng = np.random.default_rng(10)
    values = [float(v) if rng.random() > 0.4 else None for v in rng.integers(0, 30, 200)]
    out = [r["x"] for r in grid.interpolate_limit(hours(spark, values), "x").orderBy("time").collect()]
    want = pd.Series(values, dtype=float).interpolate(limit=2)
    np.testing.assert_allclose(pd.Series(out, dtype=float), want)


def daily(spark, n=120):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"day": pd.date_range("2024-01-01", periods=n), "trips": rng.integers(0, 100, n)})
    rows = [(d.to_pydatetime(), int(t)) for d, t in pdf.itertuples(index=False)]
    return pdf.set_index("day")["trips"], spark.createDataFrame(rows, "day timestamp_ntz, trips long")


def test_centered_median_and_means_match_pandas(spark):
    series, df = daily(spark)
    out = grid.centered_mean(grid.centered_mean(grid.centered_median(df, "trips"), "trips", 3, 3, "m7"), "trips", 15, 14, "m30").orderBy("day").toPandas()
    np.testing.assert_allclose(out["median_around"], series.rolling(29, center=True, min_periods=10).median())
    np.testing.assert_allclose(out["m7"], series.rolling(7, center=True).mean())
    np.testing.assert_allclose(out["m30"], series.rolling(30, center=True).mean())


def test_weather_of_the_started_hour(spark):
    trip = spark.createDataFrame([(dt.datetime(2024, 5, 1, 10, 37),)], "started_at timestamp_ntz")
    weather = spark.createDataFrame([(dt.datetime(2024, 5, 1, 10), 1.5), (dt.datetime(2024, 5, 1, 11), 9.0)], "time timestamp_ntz, precipitation double")
    assert joins.join_hourly(trip, weather, "started_at", columns=["precipitation"]).first()["precipitation"] == 1.5
    twice = weather.unionByName(weather)
    with pytest.raises(Exception, match="more than one row"):
        joins.join_hourly(trip, twice, "started_at", columns=["precipitation"]).collect()
    none = joins.join_hourly(trip, None, "started_at", columns=features.WEATHER_DURATION).first()
    assert all(none[c] is None for c in features.WEATHER_DURATION)


def test_nearest_hour(spark):
    asked = spark.createDataFrame([("a", dt.datetime(2024, 5, 1, 10, 37)), ("b", dt.datetime(2024, 5, 1, 20, 0)), ("c", dt.datetime(2024, 5, 1, 12, 0))], "id string, t timestamp_ntz")
    weather = spark.createDataFrame([(dt.datetime(2024, 5, 1, 11), 1.0), (dt.datetime(2024, 5, 1, 13), 2.0)], "time timestamp_ntz, x double")
    out = {r["id"]: (r["in_reach"], r["x"]) for r in joins.nearest_hour(asked, weather, "t", "id", "time", ["x"]).collect()}
    assert out == {"a": (True, 1.0), "b": (False, None), "c": (True, 1.0)}
    twice = joins.nearest_hour(asked.unionByName(asked), weather, "t", "id", "time", ["x"])
    assert twice.count() == 6 and "Exchange hashpartitioning" not in twice._jdf.queryExecution().executedPlan().toString()


def test_grid_conserves_trips_and_size(spark, sf):
    table = demand.zone_hour(spark, sf).toPandas()
    days = table["time"].dt.normalize().nunique()
    assert len(table) == demand.N_ZONES * days * 24 and not table.duplicated(["zone", "time"]).any()
    assert table["trips"].sum() == demand.zoned_departures(spark, sf).count()


def test_zones_without_supply_vanish(spark):
    g = spark.createDataFrame([(0, dt.datetime(2024, 1, 5), 1), (0, dt.datetime(2024, 2, 5), 0)], "zone int, time timestamp_ntz, trips int")
    active = spark.createDataFrame([(0, dt.datetime(2024, 1, 1), 3)], "zone int, month_start timestamp_ntz, active_stations long")
    assert [r["active_stations"] for r in grid.join_active(g, active).orderBy("time").collect()] == [3, 0]


def test_first_rows_take_the_first_of_many_copies(spark):
    rows = [("a", 3, "z"), ("a", 1, "y"), ("a", 1, "x"), ("b", 9, "w")]
    out = aggregate.first_rows(spark.createDataFrame(rows, "k string, t int, v string"), ["k"], ["t"]).orderBy("k").collect()
    assert [tuple(r) for r in out] == [("a", 1, "x"), ("b", 9, "w")]


def test_overlap_counts_equal_multiplicities(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (3,)], "k int")
    b = spark.createDataFrame([(1,), (1,), (2,), (2,), (4,)], "k int")
    assert tuple(aggregate.multiset_overlap(a, b, ["k"]).first()) == (4, 5, 2)


def test_salted_semi_join_keeps_every_copy(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 900, 1).otherwise(F.col("id")).alias("k"))
    keys = spark.createDataFrame([(1,), (950,)], "k long")
    assert joins.salted_semi(rows, keys, ["k"]).count() == 901
    assert joins.salted_semi(rows, keys, ["k"], anti=True).count() == 99


def test_combinations_match_brute_force(spark):
    rng = np.random.default_rng(12)
    pdf = pd.DataFrame({"a": rng.choice(["x", "y", None], 400), "b": rng.choice(["u", "v"], 400), "y": rng.random(400) < 0.3})
    df = spark.createDataFrame([tuple(r) for r in pdf.itertuples(index=False)], "a string, b string, y boolean")
    got = {r["combination"]: (r["n"], r["positives"]) for r in aggregate.combination_rates(df, ["a", "b"], F.col("y"), (1, 2), 10).collect()}
    want = {}
    for cols in (["a"], ["b"], ["a", "b"]):
        for values, part in pdf.dropna(subset=cols).groupby(cols):
            if len(part) >= 10:
                want[" & ".join(f"{c}={v}" for c, v in zip(cols, values))] = (len(part), part["y"].sum())
    assert got == want


def test_scenarios_only_change_what_belongs_to_them(spark):
    w = spark.createDataFrame([(20.0, 3.0, 5.0, 1.0)], "temperature_c double, precipitation_mm double, wind_kmh double, snow_depth_cm double")
    out = {r["scenario"]: (r["temperature_c"], r["precipitation_mm"], r["snow_depth_cm"]) for r in features.weather_scenarios(w).collect()}
    assert out == {"actual": (20, 3, 1), "dry": (20, 0, 1), "rain": (20, 3, 1), "heavy": (20, 8, 1), "snow": (0, 0, 15), "storm": (-2, 3, 25)}
