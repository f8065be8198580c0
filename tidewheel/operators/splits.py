"""Train, validation and test labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.functions import calendar as cal
from tidewheel.operators.order import row_index, running_totals
from tidewheel.session import stage

MODULUS = 2147483647


def pick_number(*keys: Column) -> Column:
    """Repeatable pseudo-random number from integer keys; not an engine hash, so any engine agrees."""
    factors = (48271, 69621)
    total = F.lit(0).cast("long")
    for key, factor in zip(keys, factors):
        total = total + key.cast("long") * F.lit(factor)
    return F.pmod(total, F.lit(MODULUS))


def mixed_number(*keys: Column) -> Column:
    """Like ``pick_number`` but squared twice modulo the prime. Resampling needs this: a linear number
    walks through consecutive keys in even steps, which looks far less random than a real draw."""
    x = pick_number(*keys)
    for _ in range(2):
        x = F.pmod(F.pmod(x * x, F.lit(MODULUS)) * F.lit(48271) + x, F.lit(MODULUS))
    return x


def last_week_label(ts: Column) -> Column:
    """The last seven days of every month are test."""
    return F.when(F.dayofmonth(ts) > F.dayofmonth(F.last_day(ts)) - 7, "test").otherwise("train")


def last_months_cut(df: DataFrame, ts: str, months: int) -> Column:
    """Newest hour + 1 h - N months, as a scalar."""
    edge = F.timestamp_add("HOUR", F.lit(1), F.max(ts))
    return df.select((edge - F.make_ym_interval(F.lit(0), F.lit(months))).alias("cut")).scalar()


def backtest_folds(df: DataFrame, ts: str, n_folds: int, months: int) -> DataFrame:
    """Rows once per fold in which they take part, with ``fold`` and ``role``.

    Fold i validates on a window of ``months`` months and trains on everything before it; the last fold
    ends with the data. The expansion is a filter on an array of ``n_folds`` entries, no join.
    """
    end = F.col("_end")
    out = df.withColumn("_end", df.select(F.timestamp_add("HOUR", F.lit(1), F.max(ts)).alias("e")).scalar())
    roles = []
    for fold in range(n_folds):
        back = n_folds - fold
        stop = end - F.make_ym_interval(F.lit(0), F.lit(months * (back - 1)))
        start = stop - F.make_ym_interval(F.lit(0), F.lit(months))
        role = F.when(F.col(ts) < start, "train").when(F.col(ts) < stop, "validate")
        roles.append(F.when(role.isNotNull(), F.struct(F.lit(fold).alias("fold"), role.alias("role"))))
    out = out.withColumn("_r", F.explode(F.array_compact(F.array(*roles))))
    return out.select(*df.columns, "_r.fold", "_r.role")


def temporal_split(df: DataFrame, order: Sequence[str], train_share: float = 0.8) -> DataFrame:
    """Oldest rows are train; at least one row on each side."""
    out = row_index(df, order, "_i")
    cut = F.greatest(F.lit(1), F.least(F.col("_i_n") - 1, F.floor(F.col("_i_n") * F.lit(train_share))))
    return out.withColumn("split", F.when(F.col("_i") < cut, "train").otherwise("test")).drop("_i", "_i_n")


def nested_temporal_split(df: DataFrame, order: Sequence[str], train_share: float = 0.8) -> DataFrame:
    """Train, validation and test: the split applied again inside the older part, with one ordering."""
    out = row_index(df, order, "_i")
    n = F.col("_i_n")
    outer = F.greatest(F.lit(1), F.least(n - 1, F.floor(n * F.lit(train_share))))
    inner = F.greatest(F.lit(1), F.least(outer - 1, F.floor(outer * F.lit(train_share))))
    label = F.when(F.col("_i") < inner, "train").when(F.col("_i") < outer, "validation").otherwise("test")
    return out.withColumn("split", label).drop("_i", "_i_n")


def class_ranked(df: DataFrame, label: str, draw: Column, ties: Sequence[str]) -> DataFrame:
    """Rank rows of each class by the draw without sending a class to one task. Adds ``_rank`` from 0
    and ``_class_n``. Rows equal in ``ties`` as well are told apart by their place in a written copy of ``df``."""
    drawn = stage(df.withColumn("_draw", draw), "drawn")
    out = running_totals(drawn, [label], ["_draw", *ties], {"one": F.lit(1)}, spread_copies=True)
    return out.withColumnsRenamed({"one_before": "_rank", "one_total": "_class_n"}).drop("_draw")


def stratified_split(df: DataFrame, label: str, draw: Column, ties: Sequence[str], shares: dict[str, float]) -> DataFrame:
    """Split keeping the class shares; ``shares`` in order, the last part takes the rest."""
    out = class_ranked(df, label, draw, ties)
    names = list(shares)
    pick, so_far = None, 0.0
    for name in names[:-1]:
        so_far += shares[name]
        test = F.col("_rank") < F.floor(F.col("_class_n") * F.lit(round(so_far, 10)) + 0.5)
        pick = F.when(test, name) if pick is None else pick.when(test, name)
    return out.withColumn("split", pick.otherwise(names[-1])).drop("_rank", "_class_n")


def stratified_folds(df: DataFrame, label: str, draw: Column, ties: Sequence[str], k: int) -> DataFrame:
    """k folds that each hold an equal share of every class."""
    out = class_ranked(df, label, draw, ties)
    return out.withColumn("fold", F.pmod("_rank", F.lit(k)).cast("int")).drop("_rank", "_class_n")


def group_folds(df: DataFrame, group: Column, k: int) -> DataFrame:
    """Folds of whole groups, balanced by size: the biggest group goes to the emptiest fold.

    Only the group sizes (one row per calendar week) are folded, in a single small aggregate.
    """
    sizes = df.groupBy(group.alias("grp")).agg(F.count(F.lit(1)).alias("n"))
    state = "struct<load:array<bigint>,placed:array<struct<grp:int,fold:int>>>"
    listed = sizes.agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("neg"), F.col("grp").cast("int").alias("grp")))).alias("g"))
    start = F.from_json(F.lit('{"load":[' + ",".join("0" for _ in range(k)) + '],"placed":[]}'), state)

    def place(acc: Column, item: Column) -> Column:
        at = F.array_position(acc["load"], F.array_min(acc["load"])).cast("int") - 1
        load = F.transform(acc["load"], lambda x, i: F.when(i == at, x - item["neg"]).otherwise(x))
        placed = F.concat(acc["placed"], F.array(F.struct(item["grp"].alias("grp"), at.alias("fold"))))
        return F.struct(load.alias("load"), placed.alias("placed"))

    folded = listed.select(F.aggregate("g", start, place).alias("r"))
    return folded.select(F.explode("r.placed").alias("p")).select("p.grp", "p.fold").join(sizes, "grp")


def training_windows(df: DataFrame, ts: str, test_start: Column, years: Sequence[int | None]) -> DataFrame:
    """Rows before the test period once per training window: the last 1, 2, ... years or all."""
    base = df.withColumn("_cut", test_start).where(F.col(ts) < F.col("_cut"))
    names = []
    for y in years:
        name = "all" if y is None else f"last {y}"
        inside = F.lit(True) if y is None else F.col(ts) >= F.col("_cut") - F.make_ym_interval(F.lit(y), F.lit(0))
        names.append(F.when(inside, F.lit(name)))
    return base.withColumn("training_window", F.explode(F.array_compact(F.array(*names)))).drop("_cut")


def systematic_sample(df: DataFrame, order: Sequence[str], max_rows: int) -> DataFrame:
    """Every k-th row in order, k chosen so that at most ``max_rows`` remain."""
    if max_rows < 1:
        raise ValueError("max_rows must be positive")
    out = row_index(df, order, "_i")
    step = F.greatest(F.lit(1), F.ceil(F.col("_i_n") / F.lit(max_rows)))
    return out.where(F.pmod("_i", step) == 0).drop("_i", "_i_n")


def linspace_sample(df: DataFrame, order: Sequence[str], max_rows: int) -> DataFrame:
    """``max_rows`` evenly spaced rows with the first and the last.

    Position j is floor(j * (n - 1) / (m - 1)); a row is kept when some j maps to it, tested by
    arithmetic on the row's own position.
    """
    out = row_index(df, order, "_i")
    n, i, m = F.col("_i_n"), F.col("_i"), max_rows
    if m == 1:
        return out.where(i == 0).drop("_i", "_i_n")
    # smallest j with j * (n - 1) >= i * (m - 1); integers only
    j = F.floor((i * (m - 1) + n - 2) / F.greatest(n - 1, F.lit(1)).cast("decimal(20,0)"))
    hit = (F.floor(j * (n - 1) / F.lit(m - 1).cast("decimal(20,0)")) == i) & (j <= m - 1)
    return out.where((n <= m) | hit).drop("_i", "_i_n")
