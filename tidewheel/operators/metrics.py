"""Evaluation metrics, thresholds and label noise.

Rank-based metrics work on one row per distinct score with counts of both classes; the running sums over
them come from ``running_totals``, so no task holds all scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.operators.order import exact_quantiles, join_groups, running_totals
from tidewheel.operators.splits import MODULUS

# The threshold grid in hundredths.
GRID = (5, 95)


# --- regression --------------------------------------------------------------------------------


def regression_metrics(df: DataFrame, y: str, pred: str, keys: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE, median absolute error and R2 per key."""
    error = F.col(y) - F.col(pred)
    rows = df.withColumn("_abs", F.abs(error))
    basics = rows.groupBy(*keys).agg(
        F.avg("_abs").alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.sum(error * error) / (F.var_pop(y) * F.count(F.lit(1)))).alias("r2"),
    )
    medians = exact_quantiles(rows, keys, "_abs", {"median_ae": 0.5})
    if keys:
        return join_groups(medians, basics, keys)
    one = basics.select(F.struct("mae", "rmse", "r2").alias("v")).scalar()
    return medians.select("n", "median_ae", *[one[c].alias(c) for c in ("mae", "rmse", "r2")])


def count_metrics(df: DataFrame, y: str, pred: str, keys: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE, R2 and Poisson deviance of counts; predictions are lifted to 1e-6."""
    p = F.greatest(F.col(pred), F.lit(1e-6))
    t = F.col(y).cast("double")
    log_part = F.when(t > 0, t * F.log(t / p)).otherwise(0.0)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(t - p)).alias("mae"), F.sqrt(F.avg((t - p) * (t - p))).alias("rmse"),
        (1 - F.sum((t - p) * (t - p)) / (F.var_pop(t) * F.count(F.lit(1)))).alias("r2"),
        (F.avg(log_part - (t - p)) * 2).alias("poisson_deviance"),
    )


def tolerance(df: DataFrame, y: str, pred: str, absolute: Mapping[str, float], relative: Mapping[str, float], floor: float = 1.0) -> DataFrame:
    """Percentage of rows whose error is within each bound."""
    error = F.abs(F.col(y) - F.col(pred))
    share = error / F.greatest(F.abs(F.col(y)), F.lit(floor))
    aggs = [(F.avg((error <= b).cast("double")) * 100).alias(n) for n, b in absolute.items()]
    aggs += [(F.avg((share <= b).cast("double")) * 100).alias(n) for n, b in relative.items()]
    return df.agg(F.count(F.lit(1)).alias("n"), *aggs)


def error_groups(df: DataFrame, y: str, pred: str, keys: Sequence[str], at_least: int = 1) -> DataFrame:
    """Rows, MAE, median absolute error and bias per group."""
    rows = df.withColumns({"_abs": F.abs(F.col(pred) - F.col(y)), "_err": F.col(pred) - F.col(y)})
    basics = rows.groupBy(*keys).agg(F.avg("_abs").alias("mae"), F.avg("_err").alias("bias"))
    return exact_quantiles(rows, keys, "_abs", {"median_ae": 0.5}).where(F.col("n") >= at_least).transform(
        join_groups, basics, keys)


# --- classification ----------------------------------------------------------------------------


def score_cells(df: DataFrame, score: str, y: str, keys: Sequence[str] = (), weight: Column | None = None) -> DataFrame:
    """One row per distinct score (and key): positives and negatives at the score, at or above it, and in all."""
    w = F.lit(1) if weight is None else weight
    cells = df.where(F.col(score).isNotNull()).groupBy(*keys, score).agg(F.sum(w * F.col(y)).alias("pos"), F.sum(w * (1 - F.col(y))).alias("neg"))
    out = running_totals(cells, keys, [score], {"pos": "pos", "neg": "neg"})
    return out.withColumns({"tp": F.col("pos_total") - F.col("pos_before"), "fp": F.col("neg_total") - F.col("neg_before")})


def _auc(keys: Sequence[str], cells: DataFrame) -> DataFrame:
    # a positive outranks the negatives below it and half of those at its own score
    won = F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / F.lit(2.0))
    return cells.groupBy(*keys).agg(
        F.max("pos_total").alias("positives"), F.max("neg_total").alias("negatives"),
        F.try_divide(F.sum(won), F.max(F.col("pos_total").cast("double") * F.col("neg_total"))).alias("auc"),
    )


def roc_auc(df: DataFrame, score: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    return _auc(keys, score_cells(df, score, y, keys))


def roc_curve(df: DataFrame, score: str, y: str) -> DataFrame:
    """A point per distinct score, and the start at (0, 0)."""
    points = score_cells(df, score, y).select(
        F.col(score).cast("double").alias("threshold"), F.try_divide("fp", "neg_total").alias("fpr"), F.try_divide("tp", "pos_total").alias("tpr"))
    return points.unionByName(df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], points.schema))


def average_precision(df: DataFrame, score: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    step = F.col("pos") / F.col("pos_total") * F.col("tp") / (F.col("tp") + F.col("fp"))
    return score_cells(df, score, y, keys).groupBy(*keys).agg(F.sum(step).alias("average_precision"))


def weighted_scores(df: DataFrame, keys: Sequence[str], score: str, y: str, weight: str, cut: float) -> DataFrame:
    """AUC, and recall and specificity at a cut, from weighted rows; null where a class is absent."""
    cells = score_cells(df, score, y, keys, F.col(weight))
    over = F.col(score) >= cut
    won = F.col("pos") * (F.col("neg_before") + F.col("neg") / F.lit(2.0))
    return cells.groupBy(*keys).agg(
        F.try_divide(F.sum(won), F.sum("pos") * F.sum("neg")).alias("auc"),
        F.try_divide(F.sum(F.when(over, F.col("pos")).otherwise(0)), F.sum("pos")).alias("recall"),
        F.try_divide(F.sum(F.when(~over, F.col("neg")).otherwise(0)), F.sum("neg")).alias("specificity"),
    )


def confusion(df: DataFrame, y: str, flagged: Column, keys: Sequence[str] = ()) -> DataFrame:
    bad = F.col(y) == 1
    return df.groupBy(*keys).agg(
        F.count_if(~bad & ~flagged).alias("tn"), F.count_if(~bad & flagged).alias("fp"),
        F.count_if(bad & ~flagged).alias("fn"), F.count_if(bad & flagged).alias("tp"),
    )


def add_rates(counts: DataFrame) -> DataFrame:
    """Rates from tn, fp, fn, tp; zero where a divisor is zero."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))

    def over(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / F.when(b > 0, b)).otherwise(0.0)

    precision, recall, specificity = over(tp, tp + fp), over(tp, tp + fn), over(tn, tn + fp)
    return counts.withColumns({
        "accuracy": over(tp + tn, tp + tn + fp + fn), "balanced_accuracy": (recall + specificity) / 2, "precision": precision,
        "recall": recall, "specificity": specificity, "f1": over(2 * tp, 2 * tp + fp + fn), "f2": over(5 * tp, 5 * tp + 4 * fn + fp),
    })


def hundredth(score: Column) -> Column:
    """Largest k with k / 100 <= score, tested on the very doubles a threshold table holds."""
    k = F.floor(score * 100).cast("int")
    k = F.when((k + 1) / F.lit(100.0) <= score, k + 1).otherwise(k)
    return F.when(k / F.lit(100.0) > score, k - 1).otherwise(k)


def hundredths(scores: np.ndarray) -> np.ndarray:
    """The same in numpy; 0 where there is no score."""
    scores = np.where(np.isfinite(scores), scores, np.where(scores == np.inf, 1e9, 0.0))
    k = np.floor(scores * 100)
    k += (k + 1) / 100.0 <= scores
    k -= k / 100.0 > scores
    return k.astype(np.int64)


def threshold_sweep(df: DataFrame, score: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """Counts and rates for every threshold 0.05, 0.06, ... 0.95 in one pass: a histogram of hundredths
    (about a hundred rows per key) and its sums from above."""
    positive, negative = F.col(y), 1 - F.col(y)
    bins = df.groupBy(*keys, hundredth(F.col(score)).alias("_k")).agg(F.sum(positive).cast("long").alias("_p"), F.sum(negative).cast("long").alias("_n"))
    # about a hundred bins per key become one row, so the bins are not worked out a second time for the totals
    hist = F.collect_list(F.struct("_k", "_p", "_n"))
    grouped = bins.groupBy(*keys).agg(hist.alias("_h"), F.sum("_p").alias("_tp"), F.sum("_n").alias("_tn"))
    grid = grouped.withColumn("_g", F.explode(F.sequence(F.lit(GRID[0]), F.lit(GRID[1])))).where("_tp is not null")

    def above(part: str) -> Column:
        return F.aggregate(F.filter("_h", lambda h: h["_k"] >= F.col("_g")), F.lit(0).cast("long"), lambda total, h: total + h[part])

    counted_up = grid.withColumns({"tp": above("_p"), "fp": above("_n")})
    counts = counted_up.select(
        *keys, (F.col("_g") / F.lit(100.0)).alias("threshold"), (F.col("_tn") - F.col("fp")).alias("tn"), "fp", (F.col("_tp") - F.col("tp")).alias("fn"), "tp")
    return add_rates(counts)


def best_threshold(sweep: DataFrame, min_recall: float, ties: Sequence[str] = ()) -> DataFrame:
    """Most accurate threshold overall, and most accurate with enough recall; ties by the stated order,
    then by the higher threshold, then by the smaller tie columns. Both in one aggregate."""
    tail = [F.col("f2"), F.col("threshold"), *[-F.col(c) for c in ties]]
    row = F.struct(*sweep.columns)
    free = F.max_by(row, F.struct(F.col("accuracy"), F.col("balanced_accuracy"), *tail))
    safe = F.max_by(row, F.when(F.col("recall") >= min_recall, F.struct(F.col("accuracy"), F.col("precision"), *tail)))
    picked = sweep.agg(free.alias("a"), safe.alias("b"))
    both = F.array(F.struct(F.lit("best accuracy").alias("choice"), F.col("a").alias("r")), F.struct(F.lit("enough recall").alias("choice"), F.col("b").alias("r")))
    return picked.select(F.explode(both).alias("e")).select("e.choice", "e.r.*").where("threshold is not null")


def recall_threshold(df: DataFrame, score: str, y: str, targets: Sequence[float]) -> DataFrame:
    """Highest score cut that reaches each recall target, floored to a thousandth."""
    cells = score_cells(df, score, y).withColumn("_t", F.explode(F.array(*[F.lit(float(t)) for t in targets])))
    reached = F.when(F.col("tp") >= F.col("_t") * F.col("pos_total"), F.col(score))
    cut = F.max(reached)
    return cells.groupBy(F.col("_t").alias("target")).agg(
        F.when(cut.isNull(), F.raise_error(F.lit("the recall is not reachable")).cast("double")).otherwise(F.floor(cut * 1000) / 1000.0).alias("threshold"))


# --- resampling ------------------------------------------------------------------------------


def bootstrap_scores(df: DataFrame, score: str, y: str, a: Column, b: Column, reps: int, cut: float) -> DataFrame:
    """AUC, recall and specificity (at ``cut``) of ``reps`` Poisson(1) bootstrap replicates: ``rep`` and the three.

    Rows move once, to their range of scores. A task walks its range in order and keeps, for each replicate, sums over
    it; its first and last score are kept apart, as they may go on in the next range. What leaves a task are three rows
    of arrays, however many rows and replicates there are. Where a replicate lacks a class, what needs it is null. A row's weight in a replicate follows from the integers ``a``
    and ``b`` (see ``mixed_number``).
    """
    steps = np.cumsum([math.exp(-1.0) / math.factorial(k) for k in range(12)]).round(12)
    offsets = np.arange(reps, dtype=np.int64) * 1_000_003

    def weights(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x = (a[:, None] * 48271 + (b[:, None] + offsets) * 69621) % MODULUS
        for _ in range(2):
            x = ((x * x) % MODULUS * 48271 + x) % MODULUS
        return np.searchsorted(steps, x / float(MODULUS), side="right")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        first, held = None, None  # (scores, positives, negatives): of the first score, and of the last one so far
        block = np.zeros((5, reps))  # positives, negatives, ordered pairs, positives at the cut, negatives below it

        def settle(s: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> None:
            """Adds scores that cannot go on any more; the first one of the range is kept apart."""
            nonlocal first
            if first is None and len(s):
                first, s, pos, neg = (s[:1], pos[0], neg[0]), s[1:], pos[1:], neg[1:]
            before = block[1] + neg.cumsum(axis=0) - neg
            block[2] += (pos * (before + neg / 2)).sum(axis=0)
            block[0] += pos.sum(axis=0)
            block[1] += neg.sum(axis=0)

        for batch in batches:
            for at in range(0, len(batch), 8192):
                piece = batch.slice(at, 8192)
                s, t, ka, kb = (piece.column(i).to_numpy(zero_copy_only=False) for i in range(4))
                w = weights(ka, kb).astype(np.float64)
                pos, neg = w * t[:, None], w * (1 - t)[:, None]
                block[3] += pos[s >= cut].sum(axis=0)
                block[4] += neg[s < cut].sum(axis=0)
                if held is not None:
                    s, pos, neg = np.append(held[0], s), np.vstack([held[1], pos]), np.vstack([held[2], neg])
                heads = np.flatnonzero(np.diff(s, prepend=np.nan) != 0)
                s, pos, neg = s[heads], np.add.reduceat(pos, heads), np.add.reduceat(neg, heads)
                settle(s[:-1], pos[:-1], neg[:-1])
                held = (s[-1:], pos[-1], neg[-1])
        last = held if first is not None else None
        first = first or held
        rows = [(part, 1, None, *block)]
        for place, edge in ((0, first), (2, last)):
            if edge is not None:
                rows.append((part, place, float(edge[0][0]), edge[1], edge[2], *np.zeros((3, reps))))
        kinds = [pa.int32(), pa.int32(), pa.float64(), *[pa.list_(pa.float64())] * 5]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["part", "place", "score", *names])

    names = ["pos", "neg", "pairs", "hit", "spared"]
    ranged = df.where(F.col(score).isNotNull()).select(F.col(score).cast("double").alias("s"), F.col(y).cast("long").alias("y"), a.cast("long").alias("a"), b.cast("long").alias("b"))
    ranged = ranged.repartitionByRange("s", "a", "b").sortWithinPartitions("s")
    schema = "part int, place int, score double, " + ", ".join(f"{n} array<double>" for n in names)
    cells = ranged.mapInArrow(walk, schema).select("part", "place", "score", F.posexplode(F.arrays_zip(*names)).alias("rep", "v")).select("part", "place", "score", "rep", "v.*")
    # a score at the edge of several ranges is one score
    at = F.col("part").cast("long") * 3 + F.col("place")
    whole = cells.groupBy("rep", "score", F.when(F.col("score").isNull(), at).alias("_block")).agg(F.min(at).alias("at"), *[F.sum(n).alias(n) for n in names])
    below = F.coalesce(F.sum("neg").over(Window.partitionBy("rep").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    inside = F.when(F.col("score").isNull(), F.col("pairs")).otherwise(F.col("pos") * F.col("neg") / 2)
    sums = whole.withColumn("_a", inside + F.col("pos") * below).groupBy("rep").agg(F.sum("_a").alias("_a"), *[F.sum(n).alias(n) for n in names])
    rates = {"auc": ("_a", F.col("pos") * F.col("neg")), "recall": ("hit", F.col("pos")), "specificity": ("spared", F.col("neg"))}
    return sums.select("rep", *[F.try_divide(F.col(a), b).alias(n) for n, (a, b) in rates.items()])


# --- label noise -------------------------------------------------------------------------------


def true_share(eps: Column, labelled: Column) -> Column:
    """Share of rows that are truly positive, when a label is flipped with probability eps either way and the share
    ``labelled`` carries a positive one: labelled = true * (1 - eps) + (1 - true) * eps."""
    return (labelled - eps) / (1 - 2 * eps)


def corrected_rates(recall: Column, fpr: Column, eps: Column, q: Column) -> dict[str, Column]:
    """True recall, specificity and accuracy from measured ones. In shares of all rows: of what is flagged, the truly
    positive part keeps its label with 1 - eps and loses it with eps, the truly negative part the other way round."""
    with_label, without = recall * q, fpr * (1 - q)
    positive = ((1 - eps) * with_label - eps * without) / (1 - 2 * eps)
    negative = ((1 - eps) * without - eps * with_label) / (1 - 2 * eps)
    true = true_share(eps, q)
    return {"recall": positive / true, "specificity": 1 - negative / (1 - true), "accuracy": positive + 1 - true - negative}


def corrected_auc(auc: Column, eps: Column, q: Column) -> dict[str, Column]:
    """True AUC, and what a perfect model would measure on these labels.

    A pair of a labelled positive and a labelled negative row is truly so ordered where neither label is flipped, the other
    way round where both are, and of one class (won half the time) where one is."""
    true = true_share(eps, q)
    mixed = true * (1 - true)
    alike = eps * (1 - eps) * (true * true + (1 - true) * (1 - true)) / 2
    pairs = q * (1 - q)
    return {
        "auc_true": (auc * pairs - alike - mixed * eps * eps) / (mixed * (1 - 2 * eps)),
        "auc_perfect": (mixed * (1 - eps) * (1 - eps) + alike) / pairs,
    }


def noise_threshold(df: DataFrame, score: str, y: str, eps: float, target: float) -> DataFrame:
    """Highest score cut whose true recall reaches the target, floored to a thousandth."""
    cells = score_cells(df, score, y)
    p, n = F.col("pos_total"), F.col("neg_total")
    q = p / (p + n)
    rates = corrected_rates(F.col("tp") / p, F.col("fp") / n, F.lit(eps), q)
    cut = F.max(F.when(rates["recall"] >= target, F.col(score)))
    return cells.agg(F.lit(eps).alias("eps"), F.lit(target).alias("target"), (F.floor(cut * 1000) / 1000.0).alias("threshold"))


def confident_joint(df: DataFrame, score: str, y: str) -> DataFrame:
    """Joint of given and likely label. A row counts for a class whose probability reaches the class's mean
    over its own rows; when both do, the larger wins. Rows are rescaled to the class sizes; the counts are
    left as fractions."""
    p1 = F.col(score)
    means = df.agg(F.struct(F.avg(F.when(F.col(y) == 1, p1)).alias("t1"), F.avg(F.when(F.col(y) == 0, 1 - p1)).alias("t0")).alias("v")).scalar()
    in1, in0 = p1 >= means["t1"] - 1e-6, (1 - p1) >= means["t0"] - 1e-6
    likely = F.when(in1 & in0, (p1 > 0.5).cast("int")).when(in1, 1).when(in0, 0)
    cells = df.groupBy(F.col(y).alias("given"), likely.alias("likely")).agg(F.count(F.lit(1)).alias("c"))
    per_class = Window.partitionBy("given")  # four to six rows in all
    sized = cells.withColumn("size", F.sum("c").over(per_class))
    known = sized.where("likely is not null").withColumn("seen", F.sum("c").over(per_class))
    calibrated = known.withColumn("share", F.col("c") / F.col("seen") * F.col("size"))
    whole = Window.partitionBy(F.lit(1))
    return calibrated.select("given", "likely", F.col("c").alias("confident"), (F.col("share") / F.sum("share").over(whole)).alias("joint"))


def fold_summary(folds: DataFrame, reference: str) -> DataFrame:
    """Mean, spread, percentiles and paired wins against a reference model, from ``(model, metric, fold,
    value)``. All rows of a metric and fold are a handful of models."""
    pair = Window.partitionBy("metric", "fold")
    rows = folds.withColumn("_ref", F.max(F.when(F.col("model") == reference, F.col("value"))).over(pair))
    return rows.groupBy("model", "metric").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.percentile("value", 0.025).alias("p2_5"), F.percentile("value", 0.975).alias("p97_5"),
        F.count_if(F.col("value") > F.col("_ref")).alias("wins"), F.count_if(F.col("value") == F.col("_ref")).alias("ties"),
        F.count_if(F.col("value") < F.col("_ref")).alias("losses"),
    )


def select_model(table: DataFrame, tolerance_mae: float = 0.10) -> DataFrame:
    """Among models within the tolerance of the best MAE, the one with the highest R2. One row per model."""
    best = table.select(F.min("mae").alias("b")).scalar()
    able = table.withColumn("eligible", F.col("mae") <= best + tolerance_mae)
    order = Window.partitionBy(F.lit(1)).orderBy(F.desc("eligible"), F.desc("r2"), F.asc("mae"), F.asc("model"))
    return able.withColumn("selected", F.row_number().over(order) == 1)


def quality_gate(new: DataFrame, current: DataFrame, tolerance_share: float = 0.02) -> DataFrame:
    """Reject a model that is worse than the current one on the same test period; rows ``(test_period, mae)``."""
    rows = new.select("test_period", F.col("mae").alias("new_mae")).join(
        current.select("test_period", F.col("mae").alias("current_mae")), "test_period", "left")
    limit = F.col("current_mae") * (1 + tolerance_share)
    return rows.withColumns({
        "limit_mae": limit, "comparable": F.col("current_mae").isNotNull(),
        "accepted": F.coalesce(F.col("new_mae") <= limit, F.lit(True)),
    })
