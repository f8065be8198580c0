"""Statistical tests and effect sizes as distributed aggregates.

Each test reduces the data to a handful of sums; only the last scalar step runs on one row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewheel.functions import calendar as cal
from tidewheel.operators.order import average_ranks, exact_quantiles, running_totals, value_counts
from tidewheel.operators.splits import MODULUS, mixed_number

# Chebyshev fit of the complementary error function (relative error below 1.2e-7).
ERFC = [
    -1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277,
]


def erfc(x: Column) -> Column:
    t = F.lit(1.0) / (1 + F.abs(x) / 2)
    poly = F.lit(ERFC[-1])
    for c in reversed(ERFC[:-1]):
        poly = poly * t + c
    tail = t * F.exp(poly - x * x)
    return F.when(x >= 0, tail).otherwise(2 - tail)


def normal_tail(z: Column) -> Column:
    """P(Z > z)."""
    return erfc(z / math.sqrt(2)) / 2


def chi2_tail(x: Column, dof: Column) -> Column:
    """P(X > x) for a whole number of degrees of freedom: the finite sum, one term per two degrees."""
    h = x / 2
    odd = F.pmod(dof, F.lit(2)) == 1
    terms = F.floor((dof - F.when(odd, 1).otherwise(0)) / 2).cast("int")
    first_log = F.when(odd, 0.5 * F.log(h) - math.lgamma(1.5) - h).otherwise(-h)
    # sum of exp(first_log + sum of log(h / (j + shift)))
    shift = F.when(odd, F.lit(0.5)).otherwise(F.lit(0.0))
    start = F.struct(first_log.alias("l"), F.when(odd, erfc(F.sqrt(h))).otherwise(F.lit(0.0)).alias("s"))
    steps = F.when(terms > 0, F.sequence(F.lit(1), terms)).otherwise(F.array().cast("array<int>"))

    def add(acc: Column, j: Column) -> Column:
        return F.struct((acc["l"] + F.log(h) - F.log(j + shift)).alias("l"), (acc["s"] + F.exp(acc["l"])).alias("s"))

    return F.when(x <= 0, F.lit(1.0)).otherwise(F.aggregate(steps, start, add)["s"])


def mann_whitney(df: DataFrame, value: str, first: Column) -> DataFrame:
    """U of the rows where ``first`` holds, with tie-corrected z, p-values and Cliff's delta; one row."""
    cells = value_counts(df.where(first.isNotNull()), [], value, a=first.cast("int"))
    cells = running_totals(cells, [], [value], {"n": "n"})
    rank = F.col("n_before") + (F.col("n") + 1) / F.lit(2.0)
    n = F.col("n").cast("double")
    sums = cells.agg(
        F.sum("a").alias("n1"),
        F.sum(F.col("n") - F.col("a")).alias("n2"),
        F.sum(F.col("a") * rank).alias("r1"),
        F.sum(n * n * n - n).alias("ties"),
    )
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    total = n1 + n2
    out = sums.withColumn("u", F.col("r1") - n1 * (n1 + 1) / 2)
    sigma = F.sqrt(n1 * n2 / 12 * (total + 1 - F.col("ties") / (total * (total - 1))))
    off = F.col("u") - n1 * n2 / 2
    out = out.withColumns({
        "z": off / sigma,
        "p_greater": normal_tail((off - 0.5) / sigma),
        "p_two_sided": F.least(F.lit(1.0), 2 * normal_tail((F.abs(off) - 0.5) / sigma)),
        "cliffs_delta": 2 * F.col("u") / (n1 * n2) - 1,
    })
    return out.drop("r1", "ties")


def bootstrap_median_diff(df: DataFrame, value: str, group: str, first: str, second: str, repetitions: int) -> DataFrame:
    """2.5 and 97.5 percentile of median(first) - median(second) over resamples of full size; one row.

    Values are ordered once per group. The median of n draws with replacement lies at a random position: the number of
    draws below a position is binomial, so the position is n * (1/2 + z / (2 sqrt n)) with a standard normal z (here
    the sum of twelve uniform numbers less six). A replicate looks up one position per group, however many rows there are.
    """
    spark = df.sparkSession
    rows = df.where(F.col(group).isin([first, second]) & F.col(value).isNotNull()).select(F.col(group).alias("g"), F.col(value).alias("x"))
    placed = running_totals(rows, ["g"], ["x"], {"one": F.lit(1)}, spread_copies=True)
    sizes = rows.groupBy("g").agg(F.count(F.lit(1)).alias("size"))  # two rows
    draws = spark.range(repetitions * 12).select(
        F.floor(F.col("id") / 12).cast("int").alias("rep"), (F.col("id") % 12).alias("slot"), F.explode(F.array(F.lit(first), F.lit(second))).alias("g")
    )
    number = mixed_number(F.col("slot"), F.col("rep") + F.when(F.col("g") == first, 0).otherwise(1_000_003))
    sums = draws.groupBy("rep", "g").agg(F.sum(number).alias("t")).join(F.broadcast(sizes), "g")
    z, n = F.col("t") / F.lit(float(MODULUS)) - 6.0, F.col("size").cast("double")
    at = F.floor(n * (0.5 + z / (2.0 * F.sqrt(n))))
    wanted = sums.select("rep", "g", F.greatest(F.lit(0), F.least(F.col("size") - 1, at)).alias("one_before"))
    # 2 * repetitions rows: a fixed bound
    medians = placed.select("g", "one_before", "x").join(F.broadcast(wanted), ["g", "one_before"])
    diffs = medians.groupBy("rep").agg(
        (F.max(F.when(F.col("g") == first, F.col("x"))) - F.max(F.when(F.col("g") == second, F.col("x")))).alias("d")
    )
    return diffs.agg(F.percentile("d", 0.025).alias("ci_low"), F.percentile("d", 0.975).alias("ci_high"), F.count("d").alias("replicates"))


def group_medians(df: DataFrame, value: str, group: str) -> DataFrame:
    return exact_quantiles(df, [group], value, {"median": 0.5})


def wilcoxon(df: DataFrame, difference: str, keys: Sequence[str] = ()) -> DataFrame:
    """Signed-rank statistic per key; zero differences are dropped, ties share their average rank."""
    rows = df.where((F.col(difference) != 0) & F.col(difference).isNotNull()).withColumn("_abs", F.abs(difference))
    cells = value_counts(rows, keys, "_abs", up=F.col(difference) > 0)
    cells = running_totals(cells, keys, ["_abs"], {"n": "n"})
    rank = F.col("n_before") + (F.col("n") + 1) / F.lit(2.0)
    n = F.col("n").cast("double")
    sums = cells.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum(F.col("up") * rank).alias("w_plus"), F.sum((F.col("n") - F.col("up")) * rank).alias("w_minus"),
        F.sum(n * n * n - n).alias("ties"),
    )
    m = F.col("n").cast("double")
    sigma = F.sqrt(m * (m + 1) * (2 * m + 1) / 24 - F.col("ties") / 48)
    z = (F.col("w_plus") - m * (m + 1) / 4) / sigma
    return sums.withColumns({
        "z": z, "p_less": normal_tail(-z), "p_two_sided": 2 * normal_tail(F.abs(z)), "statistic": F.least("w_plus", "w_minus"),
    }).drop("ties")


def chi_square(df: DataFrame, a: str, b: str, keys: Sequence[str] = (), weight: Column | None = None) -> DataFrame:
    """Chi-square, degrees of freedom, p and Cramer's V per key. Empty cells need no row, and a two by two
    table gets the continuity correction."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    cells = df.groupBy(*keys, a, b).agg(n.cast("double").alias("_o"))
    cells = cells.withColumns({
        "_r": F.sum("_o").over(Window.partitionBy(*keys, a)),
        "_c": F.sum("_o").over(Window.partitionBy(*keys, b)),
    })
    sums = cells.groupBy(*keys).agg(
        F.sum("_o").alias("n"),
        F.sum(F.col("_o") * F.col("_o") / (F.col("_r") * F.col("_c"))).alias("_q"),
        F.countDistinct(a).alias("_nr"),
        F.countDistinct(b).alias("_nc"),
        F.min(F.struct("_o", "_r", "_c")).alias("_x"),
    )
    total = F.col("n")
    two = (F.col("_nr") == 2) & (F.col("_nc") == 2)
    # in a two by two table every cell is equally far from its expectation
    row, column = F.col("_x._r"), F.col("_x._c")
    less = F.greatest(F.lit(0.0), F.abs(F.col("_x._o") - row * column / total) - 0.5)
    margins = row * (total - row) * column * (total - column)
    chi2 = F.when(two, less * less * total * total * total / margins).otherwise(total * (F.col("_q") - 1))
    dof = (F.col("_nr") - 1) * (F.col("_nc") - 1)
    out = sums.withColumns({"chi2": chi2, "dof": dof})
    smaller = F.least("_nr", "_nc") - 1
    return out.withColumns({
        "cramers_v": F.sqrt(F.col("chi2") / (total * smaller)), "p_value": chi2_tail(F.col("chi2"), F.col("dof")),
    }).drop("_q", "_nr", "_nc", "_x")


def welch(df: DataFrame, value: str, first: Column) -> DataFrame:
    """Unequal-variance t and its degrees of freedom from two groups' moments."""
    x = F.col(value)
    a, b = F.when(first, x), F.when(~first, x)
    m = df.agg(F.avg(a).alias("m1"), F.avg(b).alias("m2"), F.var_samp(a).alias("v1"), F.var_samp(b).alias("v2"),
               F.count(a).alias("n1"), F.count(b).alias("n2"))
    s1, s2 = F.col("v1") / F.col("n1"), F.col("v2") / F.col("n2")
    t = (F.col("m1") - F.col("m2")) / F.sqrt(s1 + s2)
    dof = (s1 + s2) * (s1 + s2) / (s1 * s1 / (F.col("n1") - 1) + s2 * s2 / (F.col("n2") - 1))
    return m.select("n1", "n2", (F.col("m1") - F.col("m2")).alias("difference"), t.alias("t"), dof.alias("dof"))


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Correlation of tie-averaged ranks. Rows are collapsed to distinct pairs before ranks are looked up."""
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    pairs = rows.groupBy(x, y).agg(F.count(F.lit(1)).alias("w"))
    rx = average_ranks(rows, [], x).select(x, F.col("avg_rank").alias("rx"), F.col("n_total").alias("t"))
    ry = average_ranks(rows, [], y).select(y, F.col("avg_rank").alias("ry"))
    joined = pairs.join(rx, x).join(ry, y)
    middle = (F.col("t") + 1) / F.lit(2.0)
    dx, dy, w = F.col("rx") - middle, F.col("ry") - middle, F.col("w")
    return joined.agg(F.sum("w").alias("n"), (F.sum(w * dx * dy) / F.sqrt(F.sum(w * dx * dx) * F.sum(w * dy * dy))).alias("rho"))


def matched_strata(hours: DataFrame, strata: Sequence[str], state: str, value: str, one: str, other: str) -> DataFrame:
    """Mean in both states per stratum, for strata that have both, with the log of their ratio."""
    means = hours.groupBy(*strata).agg(
        F.avg(F.when(F.col(state) == one, F.col(value))).alias("mean_one"),
        F.avg(F.when(F.col(state) == other, F.col(value))).alias("mean_other"),
        F.count_if(F.col(state) == one).alias("n_one"),
        F.count_if(F.col(state) == other).alias("n_other"),
    ).where("mean_one > 0 and mean_other > 0")
    return means.withColumn("log_ratio", F.log(F.col("mean_one") / F.col("mean_other")))


def block_bootstrap(spark: SparkSession, errors: DataFrame, ts: str, a: str, b: str, repetitions: int) -> DataFrame:
    """MAE(b) - MAE(a) when whole days are drawn again: mean, interval, share of draws won by a; one row.

    The errors are summed per day first; only day sums (one row per calendar day) are drawn.
    """
    days = errors.groupBy(cal.day_floor(F.col(ts)).alias("day")).agg(F.sum(a).alias("sa"), F.sum(b).alias("sb"), F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(F.lit(1)).orderBy("day")
    placed = days.select((F.row_number().over(order) - 1).alias("at"), F.count(F.lit(1)).over(Window.partitionBy(F.lit(1))).alias("k"), "sa", "sb", "n")
    draws = spark.range(repetitions).select(F.col("id").cast("int").alias("rep"), F.explode(F.sequence(F.lit(0).cast("long"), placed.select((F.max("k") - 1).alias("m")).scalar())).alias("slot"))
    draws = draws.select("rep", F.pmod(mixed_number(F.col("slot"), F.col("rep")), placed.select(F.max("k").alias("m")).scalar()).alias("at"))
    sums = draws.join(placed, "at").groupBy("rep").agg((F.sum("sb") / F.sum("n") - F.sum("sa") / F.sum("n")).alias("d"))
    return sums.agg(F.avg("d").alias("gain"), F.percentile("d", 0.025).alias("ci_low"), F.percentile("d", 0.975).alias("ci_high"),
                    F.avg((F.col("d") > 0).cast("double")).alias("p_better"))


def poisson_weight(draw: Column) -> Column:
    """Poisson(1) weight from a number in [0, 1): how many cumulative probabilities it reaches."""
    steps, term, total = [], math.exp(-1.0), 0.0
    for k in range(12):
        total += term
        steps.append(round(total, 12))
        term /= k + 1
    weight = F.lit(0)
    for s in steps:
        weight = weight + (draw >= F.lit(s)).cast("int")
    return weight
