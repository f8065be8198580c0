"""Typical durations from the past, without reading the row's own outcome."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.operators.order import running_by_keys

# Weight of the prior in trips, prior of the very first trip in minutes.
SMOOTHING = 20.0
FIRST_PRIOR = 10.0

KEYS = {
    "route": ["start_station_id", "end_station_id"],
    "start": ["start_station_id"],
    "end": ["end_station_id"],
}


def _whole(target: str, digits: int) -> Column:
    return F.floor(F.col(target) * 10**digits + 0.5)


def _key(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("unknown"))


def expanding_history(trips: DataFrame, target: str, order: Sequence[str], digits: int = 6) -> DataFrame:
    """Past-only smoothed means per route, start and end, in the given total order.

    The estimate of a row is ``(sum of earlier + 20 * prior) / (earlier rows + 20)``, where the prior is
    the mean of all earlier rows. Sums are whole numbers of ``10 ** -digits`` minutes in wide decimals: the same
    digits come out however the rows were spread, and no total overflows. ``trips`` is a scan or a staged table.
    """
    rows = trips.withColumns({"_start": _key("start_station_id"), "_end": _key("end_station_id")})
    key_sets = {"_all": [], "_route": ["_start", "_end"], "_start_": ["_start"], "_end_": ["_end"]}
    sums = {"sum": _whole(target, digits), "cnt": F.when(F.col(target).isNull(), 0).otherwise(1).cast("long")}
    rows = running_by_keys(rows, order, key_sets, sums, "double")

    def minutes(tag: str) -> Column:
        return F.col(f"{tag}_sum") / F.lit(float(10**digits))

    def count(tag: str) -> Column:
        return F.col(f"{tag}_cnt")

    prior = F.when(count("_all") > 0, minutes("_all") / count("_all")).otherwise(F.lit(FIRST_PRIOR))

    def estimate(tag: str) -> Column:
        return (minutes(tag) + SMOOTHING * prior) / (count(tag) + SMOOTHING)

    return rows.withColumns({
        "route_typical_minutes": estimate("_route"),
        "route_history_log_count": F.log1p(count("_route")),
        "start_typical_minutes": estimate("_start_"),
        "end_typical_minutes": estimate("_end_"),
    }).drop("_start", "_end", *[f"{t}_{m}" for t in key_sets for m in ("sum", "cnt")])


def fit_history(trips: DataFrame, target: str, digits: int = 6) -> Mapping[str, DataFrame]:
    """Mean and count per route, start and end, and the global mean: four keyed tables. Sums are whole
    numbers, as in ``expanding_history``."""
    whole = _whole(target, digits).cast("decimal(38,0)")
    rows = trips.select(
        _key("start_station_id").alias("start_station_id"), _key("end_station_id").alias("end_station_id"), whole.alias("_y")
    )
    mean = F.sum("_y").cast("double") / F.count("_y") / F.lit(float(10**digits))
    fitted = {tag: rows.groupBy(*keys).agg(mean.alias(f"_{tag}_mean"), F.count("_y").alias(f"_{tag}_n")) for tag, keys in KEYS.items()}
    fitted["global"] = rows.agg(mean.alias("_mean"))
    return fitted


def apply_history(rows: DataFrame, fitted: Mapping[str, DataFrame | float] | None) -> DataFrame:
    """Smoothed estimates from fitted tables; an unseen key falls back to the global mean."""
    from tidewheel.functions.features import HISTORY_FEATURES

    if fitted is None:
        return rows.withColumns({c: F.lit(None).cast("double") for c in HISTORY_FEATURES})
    overall = fitted["global"]
    overall = F.lit(overall) if isinstance(overall, float) else overall.scalar()
    out = rows.withColumns({"start_station_id": _key("start_station_id"), "end_station_id": _key("end_station_id")})
    for tag, keys in KEYS.items():
        out = out.join(fitted[tag], keys, "left")
    out = out.withColumn("_g", overall)

    def estimate(tag: str) -> Column:
        n = F.coalesce(F.col(f"_{tag}_n"), F.lit(0))
        mean = F.coalesce(F.col(f"_{tag}_mean"), F.col("_g"))
        return (mean * n + SMOOTHING * F.col("_g")) / (n + SMOOTHING)

    return out.withColumns({
        "route_typical_minutes": estimate("route"),
        "route_history_log_count": F.log1p(F.coalesce(F.col("_route_n"), F.lit(0)).cast("double")),
        "start_typical_minutes": estimate("start"),
        "end_typical_minutes": estimate("end"),
    }).drop("_g", *[f"_{t}_{m}" for t in KEYS for m in ("mean", "n")])
