"""Evaluation metrics, thresholds, label noise."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewheel.functions import calendar as cal
from tidewheel.functions import features
from tidewheel.functions.text import bands
from tidewheel.operators import joins, metrics
from tidewheel.plans import demand
from tidewheel.plans import views as v
from tidewheel.plans.views import Book, r6, rnd, rounded

BOOK = Book()
add = BOOK.add

# A duration prediction: the trip's own length pulled towards the middle.
GUESS = "0.7D * duration_minutes + 35.0D + (l_orderkey % 13) - 6"
GUESS_SQL = "0.7::DOUBLE * duration_minutes + 35.0::DOUBLE + (l_orderkey % 13) - 6"
ERR = f"g AS (SELECT *, {GUESS_SQL} AS pred FROM trips_li)"
REG = """{n} AS n, {mae} AS mae, {rmse} AS rmse, {med} AS median_ae, {r2} AS r2""".format(
    n="count(*)", mae=r6("avg(abs(duration_minutes - pred))"), rmse=r6("sqrt(avg((duration_minutes - pred) * (duration_minutes - pred)))"),
    med=r6("median(abs(duration_minutes - pred))", 9), r2=r6("1 - sum((duration_minutes - pred) * (duration_minutes - pred)) / (var_pop(duration_minutes) * count(*))"))


def guessed(spark, sf):
    return v.trips_li(spark, sf).withColumn("pred", F.expr(GUESS))


def reg_rounded(df):
    return rounded(rounded(df, "mae", "rmse", "r2"), "median_ae", digits=9)


@add("regression_metrics", "trips_li", f"WITH {ERR} SELECT {REG} FROM g")
def regression_metrics(spark, sf):
    return reg_rounded(metrics.regression_metrics(guessed(spark, sf), "duration_minutes", "pred"))


COUNT = {m: (f"SELECT '{m}' AS model, count(*) AS n, {r6(f'avg(abs(trips - p))')} AS mae, {r6('sqrt(avg((trips - p) * (trips - p)))')} AS rmse, "
             f"{r6('1 - sum((trips - p) * (trips - p)) / (var_pop(trips) * count(*))')} AS r2, "
             f"{r6('2 * avg(CASE WHEN trips > 0 THEN trips * ln(trips / p) ELSE 0.0 END - (trips - p))')} AS poisson_deviance "
             f"FROM (SELECT CAST(trips AS DOUBLE) AS trips, greatest({m}, 0.000001::DOUBLE) AS p FROM preds)") for m in ("pred_a", "pred_b")}


def long_predictions(spark, sf):
    return demand.predictions(spark, sf).unpivot(["zone", "time", "trips"], ["pred_a", "pred_b"], "model", "pred")


@add("count_metrics", "preds", " UNION ALL ".join(COUNT.values()))
def count_metrics(spark, sf):
    return rounded(metrics.count_metrics(long_predictions(spark, sf), "trips", "pred", ["model"]), "mae", "rmse", "r2", "poisson_deviance")


@add("tolerance_accuracy", "trips_li", f"""WITH {ERR}, e AS (SELECT abs(duration_minutes - pred) AS e, duration_minutes AS y FROM g) SELECT count(*) AS n, {r6("100.0 * avg((e <= 3)::INTEGER)")} AS within_3_min,
    {r6("100.0 * avg((e <= 5)::INTEGER)")} AS within_5_min, {r6("100.0 * avg((e / greatest(abs(y), 1.0) <= 0.20)::INTEGER)")} AS within_20_pct FROM e""")
def tolerance_accuracy(spark, sf):
    out = metrics.tolerance(guessed(spark, sf), "duration_minutes", "pred", {"within_3_min": 3, "within_5_min": 5}, {"within_20_pct": 0.20})
    return rounded(out, "within_3_min", "within_5_min", "within_20_pct")


@add("metrics_by_period", "trips_li", f"WITH {ERR} SELECT strftime(started_at, '%Y-%m') AS month, {REG} FROM g GROUP BY 1 HAVING count(*) >= 2")
def metrics_by_period(spark, sf):
    rows = guessed(spark, sf).withColumn("month", cal.year_month(F.col("started_at")))
    return reg_rounded(metrics.regression_metrics(rows, "duration_minutes", "pred", ["month"]).where("n >= 2"))


GROUPED = f"""count(*) AS n, {r6("median(abs(duration_minutes - pred))", 9)} AS median_ae, {r6("avg(abs(pred - duration_minutes))")} AS mae, {r6("avg(pred - duration_minutes)")} AS bias"""
WEEKPART = "CASE WHEN isodow(started_at) >= 6 THEN 'weekend' ELSE 'weekday' END"


@add("subgroup_errors", "trips_li", f"""WITH {ERR}, s AS (SELECT *, {WEEKPART} AS weekpart FROM g)
    SELECT 'rider x bike x weekpart' AS dimension, member_casual || ' ' || rideable_type || ' ' || weekpart AS part, {GROUPED} FROM s GROUP BY 2 HAVING count(*) >= 100
    UNION ALL SELECT 'member_casual', member_casual, {GROUPED} FROM s GROUP BY 2 HAVING count(*) >= 100
    UNION ALL SELECT 'rideable_type', rideable_type, {GROUPED} FROM s GROUP BY 2 HAVING count(*) >= 100
    UNION ALL SELECT 'weekpart', weekpart, {GROUPED} FROM s GROUP BY 2 HAVING count(*) >= 100""")
def subgroup_errors(spark, sf):
    rows = guessed(spark, sf).select("member_casual", "rideable_type", features.daytype(F.col("started_at")).alias("weekpart"), "duration_minutes", "pred")
    single = [F.struct(F.lit(c).alias("dimension"), F.col(c).alias("part")) for c in ("member_casual", "rideable_type", "weekpart")]
    crossed = F.struct(F.lit("rider x bike x weekpart").alias("dimension"), F.concat_ws(" ", "member_casual", "rideable_type", "weekpart").alias("part"))
    long = rows.select("duration_minutes", "pred", F.explode(F.array(crossed, *single)).alias("d")).select("duration_minutes", "pred", "d.*")
    out = metrics.error_groups(long, "duration_minutes", "pred", ["dimension", "part"], 100)
    return rounded(rounded(out, "mae", "bias"), "median_ae", digits=9)


@add("errors_by_hour_zone", "preds", f"""
    SELECT 'hour' AS level, CAST(hour(time) AS INTEGER) AS item, isodow(time) >= 6 AS weekend, {r6("avg(abs(trips - pred_a))")} AS mae, {r6("avg(pred_a - trips)")} AS bias,
        {r6("avg(abs(trips - pred_a)) / avg(trips)")} AS relative_mae FROM preds GROUP BY 2, 3
    UNION ALL SELECT 'zone', zone, false, {r6("avg(abs(trips - pred_a))")}, {r6("avg(pred_a - trips)")}, {r6("avg(abs(trips - pred_a)) / avg(trips)")} FROM preds GROUP BY 2""")
def errors_by_hour_zone(spark, sf):
    ts = F.col("time")
    levels = F.array(F.struct(F.lit("hour").alias("level"), F.hour(ts).alias("item"), (F.weekday(ts) >= 5).alias("weekend")),
                     F.struct(F.lit("zone").alias("level"), F.col("zone").alias("item"), F.lit(False).alias("weekend")))
    rows = demand.predictions(spark, sf).select("trips", "pred_a", F.explode(levels).alias("l"))
    out = rows.groupBy("l.level", "l.item", "l.weekend").agg(
        F.avg(F.abs(F.col("trips") - F.col("pred_a"))).alias("mae"), F.avg(F.col("pred_a") - F.col("trips")).alias("bias"), F.avg("trips").alias("t"))
    return rounded(out.withColumn("relative_mae", F.try_divide("mae", "t")).drop("t"), "mae", "bias", "relative_mae")


@add("errors_by_band", "preds weather", f"""SELECT CASE WHEN precipitation_mm <= 0 THEN 'dry' WHEN precipitation_mm <= 0.5 THEN 'to 0.5' WHEN precipitation_mm <= 2 THEN '0.5 to 2' ELSE 'over 2' END AS rain,
    count(*) AS hours, {r6("avg(trips)")} AS actual, {r6("avg(pred_a)")} AS predicted, {r6("avg(abs(trips - pred_a))")} AS mae FROM preds JOIN weather USING (time) GROUP BY 1""")
def errors_by_band(spark, sf):
    rows = joins.join_hourly(demand.predictions(spark, sf), v.weather(spark, sf), "time", "time", ["precipitation_mm"]).where("precipitation_mm is not null")
    band = bands(F.col("precipitation_mm"), [-0.01, 0, 0.5, 2, 100], ["dry", "to 0.5", "0.5 to 2", "over 2"])
    out = rows.groupBy(band.alias("rain")).agg(F.count(F.lit(1)).alias("hours"), F.avg("trips").alias("actual"), F.avg("pred_a").alias("predicted"),
                                              F.avg(F.abs(F.col("trips") - F.col("pred_a"))).alias("mae"))
    return rounded(out, "actual", "predicted", "mae")


# --- classification ----------------------------------------------------------------------------


def scores(spark, sf):
    return v.scores_li(spark, sf)


COUNTS = """CAST(count(*) FILTER (WHERE y = 0 AND {f} < {t}) AS BIGINT) AS tn, CAST(count(*) FILTER (WHERE y = 0 AND {f} >= {t}) AS BIGINT) AS fp,
    CAST(count(*) FILTER (WHERE y = 1 AND {f} < {t}) AS BIGINT) AS fn, CAST(count(*) FILTER (WHERE y = 1 AND {f} >= {t}) AS BIGINT) AS tp"""
RATES = ", ".join(f"{r6(e)} AS {n}" for n, e in {
    "accuracy": "(tp + tn) * 1.0 / (tp + tn + fp + fn)",
    "balanced_accuracy": "(CASE WHEN tp + fn > 0 THEN tp * 1.0 / (tp + fn) ELSE 0 END + CASE WHEN tn + fp > 0 THEN tn * 1.0 / (tn + fp) ELSE 0 END) / 2",
    "precision": "CASE WHEN tp + fp > 0 THEN tp * 1.0 / (tp + fp) ELSE 0 END", "recall": "CASE WHEN tp + fn > 0 THEN tp * 1.0 / (tp + fn) ELSE 0 END",
    "specificity": "CASE WHEN tn + fp > 0 THEN tn * 1.0 / (tn + fp) ELSE 0 END", "f1": "CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0 END",
    "f2": "CASE WHEN 5 * tp + 4 * fn + fp > 0 THEN 5.0 * tp / (5 * tp + 4 * fn + fp) ELSE 0 END"}.items())
RATE_NAMES = ["accuracy", "balanced_accuracy", "precision", "recall", "specificity", "f1", "f2"]


@add("confusion_counts", "scores_li", f"SELECT fold, {COUNTS.format(f='p_a', t='0.46')} FROM scores_li GROUP BY 1")
def confusion_counts(spark, sf):
    return metrics.confusion(scores(spark, sf), "y", F.col("p_a") >= 0.46, ["fold"])


@add("threshold_metrics", "scores_li", f"WITH c AS (SELECT fold, {COUNTS.format(f='p_a', t='0.46')} FROM scores_li GROUP BY 1) SELECT *, {RATES} FROM c")
def threshold_metrics(spark, sf):
    return rounded(metrics.add_rates(metrics.confusion(scores(spark, sf), "y", F.col("p_a") >= 0.46, ["fold"])), *RATE_NAMES)


SWEEP = f"""t AS (SELECT CAST(k AS DOUBLE) / 100.0::DOUBLE AS threshold FROM range(5, 96) r(k)),
    c AS (SELECT threshold, {COUNTS.format(f='p_a', t='threshold')} FROM t, scores_li GROUP BY 1), s AS (SELECT *, {RATES} FROM c)"""


def sweep(spark, sf):
    return rounded(metrics.threshold_sweep(scores(spark, sf), "p_a", "y"), *RATE_NAMES)


@add("threshold_sweep", "scores_li", f"WITH {SWEEP} SELECT * FROM s")
def threshold_sweep(spark, sf):
    return sweep(spark, sf)


@add("choose_threshold_accuracy", "scores_li", f"""WITH {SWEEP} (SELECT 'best accuracy' AS choice, * FROM s ORDER BY accuracy DESC, balanced_accuracy DESC, f2 DESC, threshold DESC LIMIT 1)
    UNION ALL (SELECT 'enough recall' AS choice, * FROM s WHERE recall >= 0.85 ORDER BY accuracy DESC, precision DESC, f2 DESC, threshold DESC LIMIT 1)""")
def choose_threshold_accuracy(spark, sf):
    return metrics.best_threshold(sweep(spark, sf), 0.85)


@add("choose_threshold_recall", "scores_li", """WITH c AS (SELECT p_a, sum(y) AS p FROM scores_li GROUP BY 1), k AS (SELECT p_a, sum(p) OVER (ORDER BY p_a DESC) AS tp, sum(p) OVER () AS total FROM c)
    SELECT t.target, floor(max(p_a) * 1000) / 1000 AS threshold FROM k, (VALUES (0.9::DOUBLE), (0.95::DOUBLE), (0.98::DOUBLE)) t(target) WHERE tp >= t.target * total GROUP BY 1""")
def choose_threshold_recall(spark, sf):
    return metrics.recall_threshold(scores(spark, sf), "p_a", "y", [0.90, 0.95, 0.98])


CELLS = """c AS (SELECT {keys} p_a, CAST(sum(y) AS DOUBLE) AS p, CAST(sum(1 - y) AS DOUBLE) AS n FROM {src} GROUP BY ALL),
    k AS (SELECT *, sum(n) OVER ({part} ORDER BY p_a) - n AS below, sum(p) OVER ({part} ORDER BY p_a DESC) AS tp, sum(n) OVER ({part} ORDER BY p_a DESC) AS fp,
        sum(p) OVER ({part}) AS pt, sum(n) OVER ({part}) AS nt FROM c)"""
ALL_CELLS = CELLS.format(keys="", src="scores_li", part="")
AUC = "sum(p * (below + n / 2)) / any_value(pt * nt)"


@add("roc_auc", "scores_li", f"WITH {ALL_CELLS} SELECT CAST(any_value(pt) AS BIGINT) AS positives, CAST(any_value(nt) AS BIGINT) AS negatives, {r6(AUC, 9)} AS auc FROM k")
def roc_auc(spark, sf):
    return rounded(metrics.roc_auc(scores(spark, sf), "p_a", "y"), "auc", digits=9)


@add("roc_curve", "scores_li", f"WITH {ALL_CELLS} SELECT p_a AS threshold, {r6('fp / nt')} AS fpr, {r6('tp / pt')} AS tpr FROM k UNION ALL SELECT 'inf'::DOUBLE, 0.0, 0.0")
def roc_curve(spark, sf):
    return rounded(metrics.roc_curve(scores(spark, sf), "p_a", "y"), "fpr", "tpr")


@add("average_precision", "scores_li", f"WITH {ALL_CELLS} SELECT {r6('sum(p / pt * tp / (tp + fp))', 9)} AS average_precision FROM k")
def average_precision(spark, sf):
    return rounded(metrics.average_precision(scores(spark, sf), "p_a", "y"), "average_precision", digits=9)


@add("risk_zones", "scores_li", f"""SELECT CASE WHEN p_a < 0.13 THEN 'edible' WHEN p_a < 0.33 THEN 'uncertain' ELSE 'poisonous' END AS risk, count(*) AS n, CAST(sum(y) AS BIGINT) AS positives,
    {r6("count(*) * 1.0 / sum(count(*)) OVER ()")} AS share, {r6("avg(y)")} AS positive_rate FROM scores_li GROUP BY 1""")
def risk_zones(spark, sf):
    zone = F.when(F.col("p_a") < 0.13, "edible").when(F.col("p_a") < 0.33, "uncertain").otherwise("poisonous")
    out = scores(spark, sf).groupBy(zone.alias("risk")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("y").cast("long")).alias("positives"))
    total = scores(spark, sf).agg(F.count(F.lit(1)).alias("t")).scalar()
    return rounded(out.withColumns({"share": F.col("n") / total, "positive_rate": F.col("positives") / F.col("n")}), "share", "positive_rate")


@add("disagreement_groups", "scores_li", f"""SELECT CASE WHEN p_a >= 0.5 THEN 'both positive' WHEN p_a >= 0.33 THEN 'differ' ELSE 'both negative' END AS cuts,
    CASE WHEN greatest(p_a, p_b, p_c) - least(p_a, p_b, p_c) > 0.3 THEN 'models differ' ELSE 'models agree' END AS models,
    count(*) AS n, {r6("avg(y)")} AS positive_rate, {r6("avg(greatest(p_a, p_b, p_c) - least(p_a, p_b, p_c))")} AS mean_spread FROM scores_li GROUP BY 1, 2""")
def disagreement_groups(spark, sf):
    spread = F.greatest("p_a", "p_b", "p_c") - F.least("p_a", "p_b", "p_c")
    cuts = F.when(F.col("p_a") >= 0.5, "both positive").when(F.col("p_a") >= 0.33, "differ").otherwise("both negative")
    out = scores(spark, sf).groupBy(cuts.alias("cuts"), F.when(spread > 0.3, "models differ").otherwise("models agree").alias("models")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("y").alias("positive_rate"), F.avg(spread).alias("mean_spread"))
    return rounded(out, "positive_rate", "mean_spread")


SCORED = """sc AS (SELECT *, (l_partkey % 11 = 0)::INTEGER + (l_partkey % 7 = 0)::INTEGER + (l_orderkey % 13 = 0)::INTEGER + (l_suppkey % 3 = 0)::INTEGER AS n_missing FROM scores_li)"""


def scored_missing(spark, sf):
    gone = sum(((F.col(c) % m == 0).cast("int") for c, m in (("l_partkey", 7), ("l_orderkey", 13), ("l_suppkey", 3))), (F.col("l_partkey") % 11 == 0).cast("int"))
    return scores(spark, sf).withColumn("n_missing", gone)


@add("error_outcome", "scores_li", f"""WITH {SCORED} SELECT CASE WHEN y = 1 AND p_a < 0.46 THEN 'false negative' WHEN y = 0 AND p_a >= 0.46 THEN 'false positive' ELSE 'correct' END AS outcome,
    count(*) AS n, {r6("avg(n_missing)")} AS mean_missing, median(n_missing) AS median_missing, {r6("stddev_samp(n_missing)")} AS std_missing FROM sc GROUP BY 1""")
def error_outcome(spark, sf):
    """The median is over a handful of distinct counts, so it stays a plain aggregate."""
    y, flagged = F.col("y") == 1, F.col("p_a") >= 0.46
    outcome = F.when(y & ~flagged, "false negative").when(~y & flagged, "false positive").otherwise("correct")
    out = scored_missing(spark, sf).groupBy(outcome.alias("outcome")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("n_missing").alias("mean_missing"), F.percentile("n_missing", 0.5).alias("median_missing"), F.stddev_samp("n_missing").alias("std_missing"))
    return rounded(out, "mean_missing", "std_missing")


@add("label_noise_rates", "scores_li", f"""SELECT 'surely negative' AS part, count(*) AS n, {r6("avg(y)")} AS contrary FROM scores_li WHERE p_a < 0.15
    UNION ALL SELECT 'surely positive', count(*), {r6("avg(1 - y)")} FROM scores_li WHERE p_a > 0.65""")
def label_noise_rates(spark, sf):
    p, y = F.col("p_a"), F.col("y")
    part = F.when(p < 0.15, "surely negative").when(p > 0.65, "surely positive")
    out = scores(spark, sf).groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.avg(F.when(p < 0.15, y).otherwise(1 - y)).alias("contrary"))
    return rounded(out.where("part is not null"), "contrary")


@add("confident_joint", "scores_li", f"""WITH t AS (SELECT avg(p_a) FILTER (WHERE y = 1) - 0.000001 AS t1, avg(1 - p_a) FILTER (WHERE y = 0) - 0.000001 AS t0 FROM scores_li),
    l AS (SELECT y AS given, CASE WHEN p_a >= t1 AND 1 - p_a >= t0 THEN (p_a > 0.5)::INTEGER WHEN p_a >= t1 THEN 1 WHEN 1 - p_a >= t0 THEN 0 END AS likely FROM scores_li, t),
    c AS (SELECT given, likely, count(*) AS confident FROM l WHERE likely IS NOT NULL GROUP BY 1, 2), s AS (SELECT y AS given, count(*) AS size FROM scores_li GROUP BY 1),
    k AS (SELECT given, likely, confident, confident * 1.0::DOUBLE / sum(confident) OVER (PARTITION BY given) * size AS share FROM c JOIN s USING (given))
    SELECT given, likely, confident, {r6("share / sum(share) OVER ()")} AS joint FROM k""")
def confident_joint(spark, sf):
    return rounded(metrics.confident_joint(scores(spark, sf), "p_a", "y"), "joint")


NOISE = """pi AS (SELECT *, (q - eps) / (1 - 2 * eps) AS pi FROM m), ab AS (SELECT *, pi * (1 - eps) / q AS a, pi * eps / (1 - q) AS b FROM pi),
    d AS (SELECT *, a * (1 - b) - (1 - a) * b AS det, 0.5 * (a * b + (1 - a) * (1 - b)) + (1 - a) * b AS off FROM ab),
    r AS (SELECT *, (mr * (1 - b) - mf * (1 - a)) / det AS tr, (a * mf - b * mr) / det AS tf FROM d)"""


@add("noise_corrected_rates", "scores_li", f"""WITH {ALL_CELLS}, au AS (SELECT {AUC} AS auc FROM k),
    m AS (SELECT cut, eps, avg(y) AS q, avg((p_a >= cut)::INTEGER) FILTER (WHERE y = 1) AS mr, avg((p_a >= cut)::INTEGER) FILTER (WHERE y = 0) AS mf, (SELECT auc FROM au) AS auc
        FROM scores_li, (VALUES (0.5::DOUBLE), (0.33::DOUBLE)) c(cut), (VALUES (0.0::DOUBLE), (0.05::DOUBLE), (0.08::DOUBLE), (0.11::DOUBLE)) e(eps) GROUP BY 1, 2), {NOISE}
    SELECT cut, eps, {r6("tr")} AS recall, {r6("1 - tf")} AS specificity, {r6("tr * pi + (1 - tf) * (1 - pi)")} AS accuracy, {r6("(auc - off) / det")} AS auc_true, {r6("det + off")} AS auc_perfect FROM r""")
def noise_corrected_rates(spark, sf):
    rows = scores(spark, sf)
    y, p = F.col("y"), F.col("p_a")
    auc = metrics.roc_auc(rows, "p_a", "y").select("auc").scalar()
    cuts = rows.select("y", "p_a", F.explode(F.array(F.lit(0.5), F.lit(0.33))).alias("cut"))
    measured = cuts.groupBy("cut").agg(F.avg("y").alias("q"), F.avg(F.when(y == 1, (p >= F.col("cut")).cast("int"))).alias("mr"), F.avg(F.when(y == 0, (p >= F.col("cut")).cast("int"))).alias("mf"))
    cases = measured.withColumn("eps", F.explode(F.array(*[F.lit(e) for e in (0.0, 0.05, 0.08, 0.11)])))
    out = {**metrics.corrected_rates(F.col("mr"), F.col("mf"), F.col("eps"), F.col("q")), **metrics.corrected_auc(auc, F.col("eps"), F.col("q"))}
    return cases.select("cut", "eps", *[rnd(c).alias(n) for n, c in out.items()])


@add("choose_threshold_noise", "scores_li", f"""WITH {ALL_CELLS}, m AS (SELECT p_a, pt / (pt + nt) AS q, tp / pt AS mr, fp / nt AS mf, 0.05::DOUBLE AS eps FROM k), {NOISE}
    SELECT 0.05::DOUBLE AS eps, 0.9::DOUBLE AS target, floor(max(p_a) * 1000) / 1000 AS threshold FROM r WHERE tr >= 0.9""")
def choose_threshold_noise(spark, sf):
    return metrics.noise_threshold(scores(spark, sf), "p_a", "y", 0.05, 0.90)


@add("auc_by_group", "scores_li", f"""WITH {SCORED}, g AS (SELECT y, p_a, CASE WHEN n_missing >= 2 THEN '2+ missing' ELSE n_missing || ' missing' END AS part FROM sc
        UNION ALL SELECT y, p_a, CASE WHEN l_partkey % 7 = 0 THEN 'size absent' ELSE 'size present' END FROM sc), {CELLS.format(keys="part,", src="g", part="PARTITION BY part")}
    SELECT part, CAST(any_value(pt) AS BIGINT) AS positives, CAST(any_value(nt) AS BIGINT) AS negatives, {r6(AUC)} AS auc FROM k GROUP BY 1""")
def auc_by_group(spark, sf):
    n = F.col("n_missing")
    parts = F.array(F.when(n >= 2, "2+ missing").otherwise(F.concat(n.cast("string"), F.lit(" missing"))), F.when(F.col("l_partkey") % 7 == 0, "size absent").otherwise("size present"))
    rows = scored_missing(spark, sf).select("y", "p_a", F.explode(parts).alias("part"))
    return rounded(metrics.roc_auc(rows, "p_a", "y", ["part"]), "auc")


FOLDS = " UNION ALL ".join(
    f"""SELECT '{m}' AS model, fold, avg((({p} >= 0.46)::INTEGER = y)::INTEGER) AS accuracy, avg(({p} >= 0.46)::INTEGER) FILTER (WHERE y = 1) AS recall FROM scores_li GROUP BY 2"""
    for m, p in (("a", "p_a"), ("b", "p_b"), ("c", "p_c")))


def fold_table(spark, sf):
    """(model, metric, fold, value) from the scores of three models."""
    long = scores(spark, sf).unpivot(["fold", "y"], ["p_a", "p_b", "p_c"], "model", "p")
    rates = metrics.add_rates(metrics.confusion(long, "y", F.col("p") >= 0.46, ["model", "fold"]))
    out = rates.withColumn("model", F.substring("model", 3, 1)).unpivot(["model", "fold"], ["accuracy", "recall"], "metric", "value")
    return out


@add("fold_summary", "scores_li", f"""WITH f AS ({FOLDS}), l AS (SELECT model, fold, 'accuracy' AS metric, accuracy AS value FROM f UNION ALL SELECT model, fold, 'recall', recall FROM f),
    r AS (SELECT l.*, ref.value AS ref FROM l JOIN l ref ON ref.model = 'a' AND ref.metric = l.metric AND ref.fold = l.fold)
    SELECT model, metric, {r6("avg(value)")} AS mean, {r6("stddev_samp(value)")} AS std, {r6("quantile_cont(value, 0.025)")} AS p2_5, {r6("quantile_cont(value, 0.975)")} AS p97_5,
        CAST(count(*) FILTER (WHERE value > ref) AS BIGINT) AS wins, CAST(count(*) FILTER (WHERE value = ref) AS BIGINT) AS ties, CAST(count(*) FILTER (WHERE value < ref) AS BIGINT) AS losses FROM r GROUP BY 1, 2""")
def fold_summary(spark, sf):
    return rounded(metrics.fold_summary(fold_table(spark, sf), "a"), "mean", "std", "p2_5", "p97_5")


MODELS = {"near": (1.0, 0.04), "same": (1.0, 0.0), "low": (0.9, 0.5), "far": (0.5, 3.0)}
MODEL_ROWS = " UNION ALL ".join(f"SELECT '{m}' AS model, CAST(trips AS DOUBLE) AS y, trips * {a}::DOUBLE + {b}::DOUBLE + (zone % 3) * 0.1::DOUBLE AS p FROM zone_hour" for m, (a, b) in MODELS.items())


def model_table(spark, sf):
    rows = demand.zone_hour(spark, sf)
    long = rows.select("trips", "zone", F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.lit(a).alias("a"), F.lit(b).alias("b")) for m, (a, b) in MODELS.items()])).alias("m"))
    long = long.select("m.model", "trips", (F.col("trips") * F.col("m.a") + F.col("m.b") + (F.col("zone") % 3) * 0.1).alias("pred"))
    return rounded(metrics.count_metrics(long, "trips", "pred", ["model"]).select("model", "mae", "r2"), "mae", "r2")


@add("select_model", "zone_hour", f"""WITH r AS ({MODEL_ROWS}), t AS (SELECT model, {r6("avg(abs(y - p))")} AS mae, {r6("1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))")} AS r2 FROM r GROUP BY 1),
    e AS (SELECT *, mae <= (SELECT min(mae) FROM t) + 0.10 AS eligible FROM t) SELECT *, row_number() OVER (ORDER BY eligible DESC, r2 DESC, mae, model) = 1 AS selected FROM e""")
def select_model(spark, sf):
    return metrics.select_model(model_table(spark, sf))


@add("quality_gate", "preds", f"""WITH t AS (SELECT CASE WHEN day(time) > day(last_day(time)) - 7 THEN 'last week' ELSE 'before' END AS test_period,
        {r6("avg(abs(trips - pred_b))")} AS new_mae, {r6("avg(abs(trips - pred_a))")} AS current_mae FROM preds GROUP BY 1)
    SELECT test_period, new_mae, CASE WHEN test_period = 'last week' THEN current_mae END AS current_mae, {r6("CASE WHEN test_period = 'last week' THEN current_mae * 1.02 END")} AS limit_mae,
        test_period = 'last week' AS comparable, test_period <> 'last week' OR new_mae <= current_mae * 1.02 AS accepted FROM t""")
def quality_gate(spark, sf):
    """The current model was only measured on the last weeks; elsewhere there is nothing to compare with."""
    ts = F.col("time")
    rows = demand.predictions(spark, sf).withColumn("test_period", F.when(F.dayofmonth(ts) > F.dayofmonth(F.last_day(ts)) - 7, "last week").otherwise("before"))

    def mae(pred):
        return rows.groupBy("test_period").agg(rnd(F.avg(F.abs(F.col("trips") - F.col(pred)))).alias("mae"))

    return rounded(metrics.quality_gate(mae("pred_b"), mae("pred_a").where("test_period = 'last week'")), "limit_mae")
