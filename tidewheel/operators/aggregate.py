"""Profiles, shares, agreement and set comparison."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, missing, percentage missing, distinct values.

    Values are counted per (column, value) first, so neither a wide table nor a dominant value loads
    one task.
    """
    types = dict(df.dtypes)
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    cells = text.unpivot([], df.columns, "column_name", "value").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    out = cells.groupBy("column_name").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("missing"),
        F.count("value").alias("n_distinct"),
    )
    kinds = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    return out.withColumns({"data_type": F.element_at(kinds, F.col("column_name")),
                            "missing_pct": F.col("missing") * 100.0 / F.col("n_rows")})


def shares(df: DataFrame, group: Sequence[str], category: str) -> DataFrame:
    """Share of each category in its group."""
    counts = df.groupBy(*group, category).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*group)))


def duplicate_count(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, distinct rows and their difference."""
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"), (F.sum("n") - F.count(F.lit(1))).alias("duplicates")
    )


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in a total order; combined before the shuffle, so many copies cost little."""
    rest = [c for c in df.columns if c not in keys]
    ordered = [*order, *[c for c in rest if c not in order]]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*ordered)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def multiset_overlap(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows found in both tables with equal multiplicity. One shuffle over both, no join."""
    tagged = a.select(*keys, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(*keys, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    both = tagged.groupBy(*keys).agg(F.sum("_a").alias("a"), F.sum("_b").alias("b"))
    return both.agg(
        F.sum("a").alias("rows_a"),
        F.sum("b").alias("rows_b"),
        F.sum(F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(0)).alias("rows_in_both"),
    )


def combination_rates(df: DataFrame, columns: Sequence[str], positive: Column, sizes: Sequence[int], at_least: int) -> DataFrame:
    """Every combination of known values of 1, 2, ... columns with enough rows, and the share of the
    rarer label in it. Rows are collapsed to distinct combinations before the grouping sets multiply them."""
    cells = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"), F.sum(positive.cast("long")).alias("_p"))
    sets = [list(c) for k in sizes for c in combinations(columns, k)]
    out = cells.groupingSets(sets, *columns).agg(
        F.sum("_n").alias("n"), F.sum("_p").alias("positives"), F.grouping_id().alias("_id"), *[F.grouping(c).alias(f"_g_{c}") for c in columns]
    )
    known = F.lit(True)
    for c in columns:
        known = known & ((F.col(f"_g_{c}") == 1) | F.col(c).isNotNull())
    rate = F.col("positives") / F.col("n")
    name = F.concat_ws(" & ", *[F.when(F.col(f"_g_{c}") == 0, F.concat(F.lit(f"{c}="), F.col(c))) for c in columns])
    return out.where(known & (F.col("n") >= at_least)).select(
        name.alias("combination"), "n", "positives", F.least(rate, 1 - rate).alias("minority_share")
    )


def segment_rates(df: DataFrame, columns: Sequence[str], rates: dict[str, Column], at_least: int, missing: str = "__missing__") -> DataFrame:
    """Rates per value of every listed column, stacked."""
    flags = {f"_{k}": c.cast("long") for k, c in rates.items()}
    filled = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(missing)).alias(c) for c in columns], *[c.alias(k) for k, c in flags.items()])
    cells = filled.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(k).alias(k) for k in flags])
    long = cells.unpivot(["_n", *flags], list(columns), "feature", "value")
    out = long.groupBy("feature", "value").agg(F.sum("_n").alias("n"), *[(F.sum(f"_{k}") / F.sum("_n")).alias(k) for k in rates])
    return out.where(F.col("n") >= at_least)


def chance_agreement(df: DataFrame, a: str, b: str) -> DataFrame:
    """Agreement expected from two random rows of ``a`` next to the measured agreement of ``a`` and ``b``."""
    cells = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("_n"))
    total = df.agg(F.count(F.lit(1)).alias("t")).scalar()
    per_value = cells.groupBy(a).agg(F.sum("_n").alias("_n"), F.sum(F.when(F.col(a) == F.col(b), F.col("_n")).otherwise(0)).alias("_same"))
    share = F.col("_n") / total
    return per_value.agg(
        F.sum(F.when(F.col(a).isNotNull(), share * share)).alias("expected"), (F.sum("_same") / F.max(total)).alias("measured")
    )


def split_overlap(df: DataFrame, features: Sequence[str], split: str) -> DataFrame:
    """Rows whose features also occur in another split, and rows with a twin anywhere. Equal features
    meet in one small group of counts; nothing is joined."""
    cells = df.groupBy(*features).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(split) == s).alias(s) for s in ("train", "validation", "test")],
    )

    def seen(rows: str, where: str) -> Column:
        return F.sum(F.when(F.col(where) > 0, F.col(rows)).otherwise(0))

    return cells.agg(
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("duplicate_rows"),
        seen("validation", "train").alias("validation_in_train"),
        seen("test", "train").alias("test_in_train"),
        seen("test", "validation").alias("test_in_validation"),
    )
