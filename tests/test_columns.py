import datetime as dt

import pandas as pd
import pytest
from pandas.tseries.holiday import USFederalHolidayCalendar
from pyspark.sql import functions as F

from tidewheel.functions import calendar as cal
from tidewheel.functions import features, text
from tidewheel.operators import clean


def ts(value):
    return dt.datetime.fromisoformat(value)


def trips(spark, rows):
    schema = "ride_id string, started_at timestamp_ntz, ended_at timestamp_ntz, start_station_id string, end_station_id string, " \
             "start_lat double, start_lng double, end_lat double, end_lng double, rideable_type string, member_casual string"
    return spark.createDataFrame(rows, schema)


BASE = ("1", ts("2024-06-11T08:30:00"), ts("2024-06-11T08:42:00"), "a", "b", 40.74, -73.99, 40.75, -73.98, "classic_bike", "member")


def test_older_column_names(spark):
    old = spark.createDataFrame([("720", "2015-01-01 00:01:00", "x", "Subscriber")], "`Trip Duration` string, ` Start Time` string, bikeid string, `User Type` string")
    out = text.canonical_columns(old, ["started_at", "member_casual", "bike_id", "end_lat"]).first()
    assert out["started_at"] == "2015-01-01 00:01:00" and out["bike_id"] == "x" and out["end_lat"] is None


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="end_lat.*start_lat"):
        text.require_columns(spark.range(1), ["start_lat", "end_lat", "id"])


def test_cleaning_keeps_one_row_and_audits_the_other(spark):
    """A 12 minute and a 5 hour ride with old words."""
    rows = trips(spark, [BASE[:2] + (ts("2024-06-11T08:42:00"),) + BASE[3:10] + ("Subscriber",), ("2",) + BASE[1:2] + (ts("2024-06-11T13:30:00"),) + BASE[3:10] + ("Customer ",)])
    rows = rows.withColumns({"member_casual": text.map_words(F.col("member_casual")), "duration_minutes": features.minutes_between(F.col("started_at"), F.col("ended_at"))})
    kept = clean.clean_trips(rows).collect()
    assert [(r["ride_id"], r["member_casual"], r["duration_minutes"]) for r in kept] == [("1", "member", 12.0)]
    audit = clean.cleaning_audit(rows, F.date_format("started_at", "yyyyMM")).first()
    assert (audit["input_rows"], audit["output_rows"], audit["removed_invalid_duration"]) == (2, 1, 1)


def test_duration_bounds_can_be_exclusive(spark):
    rows = trips(spark, [BASE]).withColumn("duration_minutes", F.explode(F.array(F.lit(1.0), F.lit(180.0), F.lit(2.0))))
    assert clean.clean_trips(rows).count() == 3
    assert clean.clean_trips(rows, inclusive=False).count() == 1


def test_null_comparisons_count_as_invalid(spark):
    rows = trips(spark, [BASE[:5] + (None,) + BASE[6:]]).withColumn("duration_minutes", F.lit(None).cast("double"))
    audit = clean.cleaning_audit(rows, F.lit("m")).first()
    assert audit["removed_invalid_duration"] == 1 and audit["removed_invalid_geo"] == 1


def test_end_time_does_not_reach_the_features(spark):
    later = BASE[:2] + (ts("2024-06-11T10:00:00"),) + BASE[3:]
    a, b = (features.duration_features(trips(spark, [r])).select(*features.DURATION_FEATURES).first() for r in (BASE, later))
    assert a == b


def test_farther_destination_is_farther(spark):
    far = BASE[:7] + (40.80, -73.90) + BASE[9:]
    a, b = (features.duration_features(trips(spark, [r])).first() for r in (BASE, far))
    assert b["direct_distance_km"] > a["direct_distance_km"] and b["grid_distance_km"] > a["grid_distance_km"]


def test_time_features_repeat_after_a_week(spark):
    week = BASE[:1] + (ts("2024-06-18T08:30:00"),) + BASE[2:]
    a, b = (features.duration_features(trips(spark, [r])).first() for r in (BASE, week))
    for name in ("start_hour_sin", "start_hour_cos", "weekday_sin", "weekday_cos", "month_sin", "month_cos"):
        assert a[name] == pytest.approx(b[name])


def test_holidays_match_the_observed_calendar(spark):
    days = spark.sql("select explode(sequence(timestamp_ntz'2012-12-15', timestamp_ntz'2027-01-15', interval 1 day)) as d")
    got = {r["d"] for r in days.where(cal.is_federal_holiday(F.col("d")) == 1).collect()}
    want = {d.to_pydatetime() for d in USFederalHolidayCalendar().holidays("2012-12-15", "2027-01-15")}
    assert got == want


def test_holiday_flag_uses_whole_days(spark):
    df = spark.sql("select * from values (timestamp_ntz'2024-07-04 23:45:00'), (timestamp_ntz'2024-07-05 00:00:00') t(d)")
    assert [r[0] for r in df.select(cal.is_federal_holiday(F.col("d"))).collect()] == [1, 0]


def test_station_ids(spark):
    rows = [("7407.1", "2022-01-01"), ("7407.1", "2020-01-01"), ("119.0", "2020-01-01"), ("119.0", "2022-01-01"), ("HB101", "2022-01-01"), ("72", "2014-01-01"), ("3423.10", "2022-01-01")]
    df = spark.createDataFrame(rows, "s string, d string").withColumn("d", F.col("d").cast("timestamp_ntz"))
    got = [r[0] for r in df.select(text.normalize_station_id(F.col("s"), F.col("d"))).collect()]
    assert got == ["7407.10", "7407.1", "119", "119.00", "HB101", "72", "3423.10"]


def test_date_notation_is_chosen_per_file(spark):
    good = [("a", f"2020-01-01 00:00:{i % 60:02d}") for i in range(199)] + [("a", "1/1/2015 0:01")]
    rows = good + [("b", "1/31/2015 7:05:09"), ("c", "1/31/2015 7:05"), ("c", None)]
    out = clean.parse_timestamp_multi(spark.createDataFrame(rows, "f string, v string"), "f", "v").toPandas()
    assert out[out["f"] == "a"]["v_ts"].isna().sum() == 1
    assert out[out["f"] == "b"]["v_ts"].iloc[0] == pd.Timestamp("2015-01-31 07:05:09")
    assert out[out["f"] == "c"]["notation"].unique().tolist() == [2]


def test_unknown_code_stops_the_job(spark):
    df = spark.createDataFrame([("e",), (None,)], "c string")
    assert [r[0] for r in df.select(clean.decode(F.col("c"), clean.LABELS["class"])).collect()] == ["edible", None]
    with pytest.raises(Exception, match="code without a label"):
        spark.createDataFrame([("z",)], "c string").select(clean.decode(F.col("c"), clean.LABELS["class"])).collect()


def test_public_stations(spark):
    rows = [("1", "Broad St"), ("JC1", "x Depot"), ("sys9", None), ("4", "lab east"), ("5", "Slab St"), ("HB7", None)]
    out = {r["start_station_id"]: r["reason"] for r in clean.public_stations(spark.createDataFrame(rows, "start_station_id string, name string")).collect()}
    assert out == {"1": "", "JC1": "other system", "sys9": "not public", "4": "not public", "5": "", "HB7": "other system"}


def test_bands(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (2.0,), (7.0,)], "x double")
    right = [r[0] for r in df.select(text.bands(F.col("x"), [-0.01, 0, 0.5, float("inf")], ["dry", "light", "more"])).collect()]
    left = [r[0] for r in df.select(text.bands(F.col("x"), [0, 0.5, 2], ["a", "b"], right_closed=False)).collect()]
    assert right == ["dry", "light", "more", "more"] and left == ["a", "b", None, None]
