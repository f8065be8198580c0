"""Cleaning rules, row checks and audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions import geo
from tidewheel.functions.text import DATE_NOTATIONS

# Accepted durations in minutes, rider words, bike words.
DURATION_RANGE = (1.0, 180.0)
RIDERS = ["member", "casual"]
BIKES = ["classic_bike", "electric_bike"]
# Names and ids that are not public stations.
NON_PUBLIC_NAME = r"(?i)depot|loading dock|warehouse|\blab\b|\bshop\b|mechanic|nycbs"
NON_PUBLIC_ID = r"(?i)^SYS"
OTHER_SYSTEM_ID = r"^(JC|HB)"

# One-letter codes and their words, in the order of the columns.
COLORS = {
    "n": "brown", "b": "buff", "g": "gray", "r": "green", "p": "pink", "u": "purple", "e": "red",
    "w": "white", "y": "yellow", "l": "blue", "o": "orange", "k": "black",
}
LABELS = {
    "class": {"e": "edible", "p": "poisonous"},
    "cap_shape": {
        "b": "bell", "c": "conical", "x": "convex", "f": "flat", "s": "sunken", "p": "spherical", "o": "others",
    },
    "gill_color": {**COLORS, "f": "none"},
    "stem_surface": {
        "i": "fibrous", "g": "grooves", "y": "scaly", "s": "smooth", "h": "shiny", "l": "leathery",
        "k": "silky", "t": "sticky", "w": "wrinkled", "e": "fleshy", "f": "none",
    },
    "spore_print_color": COLORS,
    "ring_type": {
        "c": "cobwebby", "e": "evanescent", "r": "flaring", "g": "grooved", "l": "large", "p": "pendant",
        "s": "sheathing", "z": "zone", "y": "scaly", "m": "movable", "f": "none",
    },
    "habitat": {
        "g": "grasses", "l": "leaves", "m": "meadows", "p": "paths", "h": "heaths", "u": "urban",
        "w": "waste", "d": "woods",
    },
    "season": {"s": "spring", "u": "summer", "a": "autumn", "w": "winter"},
}
MISSING_WORDS = ["", "unknown", "?"]


def yes(test: Column) -> Column:
    """A comparison with null counts as not met."""
    return F.coalesce(test, F.lit(False))


def count_if(test: Column) -> Column:
    return F.count_if(yes(test))


def parse_timestamp_multi(
    df: DataFrame, file_col: str, value_col: str, notations: Sequence[str] = tuple(DATE_NOTATIONS), share: float = 0.99
) -> DataFrame:
    """Add ``<value>_ts`` and the number of the notation chosen for the file.

    The first notation that reads at least ``share`` of a file's filled values is taken for the whole
    file, else the one that reads most. Choosing is one aggregate with a row per file.
    """
    reads = [F.try_to_timestamp(F.col(value_col), F.lit(n)).cast("timestamp_ntz") for n in notations]
    stats = df.groupBy(file_col).agg(
        F.count(value_col).alias("_filled"), *[F.count(r).alias(f"_r{i}") for i, r in enumerate(reads)]
    )
    good = F.coalesce(*[F.when(F.col(f"_r{i}") >= F.lit(share) * F.col("_filled"), F.lit(i)) for i in range(len(reads))])
    most = F.greatest(*[F.col(f"_r{i}") for i in range(len(reads))])
    best = F.coalesce(*[F.when(F.col(f"_r{i}") == most, F.lit(i)) for i in range(len(reads))])
    choice = stats.select(file_col, F.coalesce(good, best).alias("notation"))
    pick = None
    for i, r in enumerate(reads):
        test = F.col("notation") == i
        pick = F.when(test, r) if pick is None else pick.when(test, r)
    return df.join(choice, file_col).withColumn(f"{value_col}_ts", pick)


def decode(column: Column, labels: Mapping[str, str]) -> Column:
    """Code to word. Null stays null; a code without a word stops the job."""
    words = F.create_map(*[F.lit(x) for x in chain.from_iterable(labels.items())])
    return F.when(column.isNull(), F.lit(None).cast("string")).otherwise(
        F.coalesce(F.try_element_at(words, column), F.raise_error(F.concat(F.lit("code without a label: "), column)))
    )


def trip_checks(low: float = DURATION_RANGE[0], high: float = DURATION_RANGE[1], inclusive: bool = True) -> dict[str, Column]:
    """The four validity rules of a trip; a row may break several."""
    minutes = F.col("duration_minutes")
    within = minutes.between(low, high) if inclusive else (minutes > low) & (minutes < high)
    return {
        "invalid_duration": yes(within),
        "invalid_geo": geo.in_box(F.col("start_lat"), F.col("start_lng")),
        "invalid_user_type": yes(F.col("member_casual").isin(RIDERS)),
        "missing_start": F.col("started_at").isNotNull() & F.col("start_station_id").isNotNull(),
    }


def clean_trips(trips: DataFrame, **bounds) -> DataFrame:
    test = F.lit(True)
    for rule in trip_checks(**bounds).values():
        test = test & rule
    return trips.where(test)


def cleaning_audit(trips: DataFrame, month: Column, **bounds) -> DataFrame:
    """Rows in and out and, per rule, how many rows break it (not exclusive). One pass."""
    checks = trip_checks(**bounds)
    kept = F.lit(True)
    for rule in checks.values():
        kept = kept & rule
    return trips.groupBy(month.alias("source_month")).agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(kept).alias("output_rows"),
        *[F.count_if(~rule).alias(f"removed_{name}") for name, rule in checks.items()],
    )


def departures(trips: DataFrame) -> DataFrame:
    """Rows that count as a departure; the duration plays no part."""
    return trips.where(
        F.col("started_at").isNotNull()
        & F.col("start_station_id").isNotNull()
        & geo.in_box(F.col("start_lat"), F.col("start_lng"))
    )


def public_stations(stations: DataFrame) -> DataFrame:
    """Add ``reason`` and ``keep``; a later rule overrides an earlier one."""
    station = F.col("start_station_id")
    reason = (
        F.when(station.rlike(OTHER_SYSTEM_ID), "other system")
        .when(station.rlike(NON_PUBLIC_ID), "not public")
        .when(F.coalesce(F.col("name"), F.lit("")).rlike(NON_PUBLIC_NAME), "not public")
        .otherwise("")
    )
    return stations.withColumn("reason", reason).withColumn("keep", F.col("reason") == "")


def reasons(checks: Mapping[str, Column]) -> Column:
    """Names of the checks a row fails, in order, joined by a semicolon."""
    return F.concat_ws(";", *[F.when(~yes(ok), F.lit(name)) for name, ok in checks.items()])


def request_checks() -> dict[str, Column]:
    """Field rules of a duration request."""
    c = F.col
    return {
        "rideable_type": c("rideable_type").isin(BIKES),
        "member_casual": c("member_casual").isin(RIDERS),
        "start_station_id": F.length("start_station_id").between(1, 100),
        "end_station_id": F.length("end_station_id").between(1, 100),
        "start_lat": c("start_lat").between(*geo.LAT_RANGE),
        "start_lng": c("start_lng").between(*geo.LNG_RANGE),
        "end_lat": c("end_lat").between(*geo.LAT_RANGE),
        "end_lng": c("end_lng").between(*geo.LNG_RANGE),
    }


def normalize_requests(fields: DataFrame, numeric: Sequence[str], categories: Sequence[str]) -> DataFrame:
    """Rows ``(case_id, field, value)`` to one row per case with typed columns and an error text.

    Field names may use '-', ' ' or '_' and a unit suffix; a category may be a code or a word.
    """
    name = F.regexp_replace(F.regexp_replace(F.lower(F.trim("field")), "[- ]", "_"), "_(cm|mm)$", "")
    value = F.lower(F.trim("value"))
    value = F.when(value.isin(MISSING_WORDS), F.lit(None)).otherwise(value)
    rows = fields.select("case_id", name.alias("column"), value.alias("value"))
    rows = rows.where(F.col("column").isin([*numeric, *categories]))
    code = F.col("value")
    known = F.lit(True)
    for column in categories:
        here = F.col("column") == column
        words = LABELS[column]
        to_code = F.create_map(*[F.lit(x) for k, v in words.items() for x in (v, k)])
        code = F.when(here, F.coalesce(F.try_element_at(to_code, F.col("value")), F.col("value"))).otherwise(code)
        known = F.when(here, F.coalesce(F.try_element_at(to_code, F.col("value")), F.col("value")).isin(list(words))).otherwise(known)
    number = F.col("value").try_cast("double")
    known = F.when(F.col("column").isin(list(numeric)), number.isNotNull()).otherwise(known)
    bad = F.col("value").isNotNull() & ~known
    rows = rows.select("case_id", "column", code.alias("code"), number.alias("number"), bad.alias("bad"))
    aggs = [F.max(F.when((F.col("column") == c) & ~F.col("bad"), F.col("number"))).alias(c) for c in numeric]
    aggs += [F.max(F.when((F.col("column") == c) & ~F.col("bad"), F.col("code"))).alias(c) for c in categories]
    wrong = F.collect_set(F.when(F.col("bad"), F.col("column")))  # at most one entry per known column
    return rows.groupBy("case_id").agg(*aggs, F.concat_ws(",", F.sort_array(wrong)).alias("errors"))


def departure_audit(raw: DataFrame, month: Column, text_columns: Sequence[str], minutes: Column, fixed: Column) -> DataFrame:
    """Per month: rows, missing values per column, broken starts, odd durations, repaired ids, departures,
    duplicate rows. The duplicate count compares whole trips, as old data has no id."""
    ok = (
        F.col("started_at").isNotNull()
        & F.col("start_station_id").isNotNull()
        & geo.in_box(F.col("start_lat"), F.col("start_lng"))
    )
    known = F.col("started_at").isNotNull() & F.col("start_station_id").isNotNull()
    trip = ["ride_id", "started_at", "ended_at", "start_station_id", "end_station_id"]
    # copies are collapsed before anything is counted, so a large group of copies is one row per task
    return (
        raw.withColumn("_month", month)
        .groupBy("_month", *trip)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in text_columns],
            F.count_if(F.col("started_at").isNull()).alias("no_start_time"),
            F.count_if(F.col("start_station_id").isNull()).alias("no_start_station"),
            F.count_if(known & ~ok).alias("outside_area"),
            count_if(minutes < 0).alias("duration_negative"),
            count_if(minutes > 24 * 60).alias("duration_over_24h"),
            count_if(fixed).alias("station_id_fixed"),
            F.count_if(ok).alias("departures"),
        )
        .groupBy(F.col("_month").alias("month"))
        .agg(
            F.sum("rows").alias("rows"),
            *[F.sum(f"missing_{c}").alias(f"missing_{c}") for c in text_columns],
            *[F.sum(c).alias(c) for c in ("no_start_time", "no_start_station", "outside_area", "duration_negative",
                                          "duration_over_24h", "station_id_fixed", "departures")],
            (F.sum("rows") - F.count(F.lit(1))).alias("duplicate_rows"),
        )
    )
