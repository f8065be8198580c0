"""Baselines, preparation, fitted models and scoring."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from itertools import combinations

import numpy as np
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.pipeline import Pipeline, PipelineModel
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, GeneralizedLinearRegression, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from tidewheel.functions import calendar as cal
from tidewheel.functions import features, geo
from tidewheel.operators import boosting, clean, glm, history, joins, metrics, prepare
from tidewheel.operators.order import exact_quantiles
from tidewheel.plans import demand, modeling
from tidewheel.plans import views as v
from tidewheel.plans.metrics_book import RATE_NAMES, RATES
from tidewheel.plans.views import Book, r6, rnd, rounded
from tidewheel.session import stage, staging_path

BOOK = Book()
add = BOOK.add
LI_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
SPLIT = "CASE WHEN day(time) > day(last_day(time)) - 7 THEN 'test' ELSE 'train' END"


@add("group_mean_baseline", "zone_hour", f"""WITH s AS (SELECT *, hour(time) AS hour, isodow(time) >= 6 AS we, {SPLIT} AS split FROM zone_hour),
    m AS (SELECT zone, hour, we, avg(trips) AS m FROM s WHERE split = 'train' AND time >= TIMESTAMP '2024-01-08' GROUP BY 1, 2, 3), g AS (SELECT avg(trips) AS g FROM s WHERE split = 'train' AND time >= TIMESTAMP '2024-01-08')
    SELECT zone, time, trips, {r6("coalesce(m.m, g.g)")} AS pred FROM s LEFT JOIN m USING (zone, hour, we), g WHERE split = 'test'""")
def group_mean_baseline(spark, sf):
    """Mean of the same zone, hour and part of the week, with the global mean for unseen combinations."""
    ts = F.col("time")
    table = demand.zone_hour(spark, sf).withColumns({"hour": F.hour(ts), "is_weekend": cal.is_weekend(ts), "test": F.dayofmonth(ts) > F.dayofmonth(F.last_day(ts)) - 7})
    train = prepare.recent(table.where("not test and time >= timestamp_ntz'2024-01-08'"), "time", 12)
    keys = ["zone", "hour", "is_weekend"]
    means, overall = prepare.group_means(train, keys, "trips")
    out = prepare.predict_group_mean(table.where("test"), means, overall, keys)
    return rounded(out.select("zone", "time", "trips", "pred"), "pred")


@add("constant_baseline", "trips_li", f"""SELECT {r6("median(duration_minutes)", 9)} AS median_minutes, {r6("avg(duration_minutes)")} AS mean_minutes,
    (SELECT start_station_id FROM trips_li GROUP BY 1 ORDER BY count(*) DESC, start_station_id LIMIT 1) AS commonest_station FROM trips_li""")
def constant_baseline(spark, sf):
    trips = v.trips_li(spark, sf)
    return trips.agg(F.avg("duration_minutes").alias("mean_minutes")).select(
        rnd(prepare.median(trips, "duration_minutes").scalar(), 9).alias("median_minutes"), rnd("mean_minutes").alias("mean_minutes"),
        prepare.most_frequent(trips, "start_station_id").scalar().alias("commonest_station"))


TRAIN = "l_orderkey % 10 < 8"
MODE = "(SELECT {c} FROM tr WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {c} LIMIT 1)"


@add("impute", "cases", f"""WITH tr AS (SELECT * FROM cases WHERE {TRAIN}) SELECT l_orderkey, l_linenumber, l_partkey, width, height, coalesce(size, (SELECT median(size) FROM tr)) AS size,
    coalesce(kind, {MODE.format(c="kind")}) AS kind, coalesce(noise_1, {MODE.format(c="noise_1")}) AS noise_1,
    (size IS NULL)::INTEGER AS size_missing, (kind IS NULL)::INTEGER AS kind_missing, (noise_1 IS NULL)::INTEGER AS noise_1_missing FROM cases""")
def impute(spark, sf):
    rows = v.cases(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "width", "height", "size", "kind", "noise_1")
    fills = prepare.fill_values(rows.where(TRAIN), medians=["size"], modes=["kind", "noise_1"])
    return prepare.impute(rows, fills)


@add("encode_categories", "cases", f"""WITH c AS (SELECT *, kind || '/' || brand || CASE WHEN width = 50 THEN '/' || (l_partkey % 37) ELSE '' END AS cat FROM cases WHERE kind IS NOT NULL),
    n AS (SELECT cat, count(*) AS n FROM c WHERE {TRAIN} GROUP BY 1),
    k AS (SELECT cat, CAST(row_number() OVER (ORDER BY cat) - 1 AS INTEGER) AS ordinal, CAST(CASE WHEN n < 5 THEN sum((n >= 5)::INTEGER) OVER () ELSE sum((n >= 5)::INTEGER) OVER (ORDER BY cat) - 1 END AS INTEGER) AS slot FROM n)
    SELECT coalesce(ordinal, -1) AS ordinal, coalesce(slot, -1) AS slot, cat, count(*) AS n FROM c LEFT JOIN k USING (cat) GROUP BY 1, 2, 3""")
def encode_categories(spark, sf):
    cat = F.concat_ws("/", "kind", "brand", F.when(F.col("width") == 50, (F.col("l_partkey") % 37).cast("string")))
    rows = v.cases(spark, sf).where("kind is not null").select("l_orderkey", cat.alias("cat"))
    table = prepare.categories(rows.where(TRAIN), "cat", 5)
    counts = rows.groupBy("cat").agg(F.count(F.lit(1)).alias("n"))
    return prepare.encode(counts, table, "cat").withColumn("slot", F.coalesce("slot", F.lit(-1))).select("ordinal", "slot", "cat", "n")


@add("class_weights", "cases", f"""WITH c AS (SELECT class, count(*) AS n FROM cases GROUP BY 1) SELECT class, n, {r6("(SELECT sum(n) FROM c) * 1.0::DOUBLE / ((SELECT count(*) FROM c) * n)")} AS weight,
    CASE WHEN class = 'p' THEN 3.0::DOUBLE ELSE 1.0::DOUBLE END AS given_weight FROM c""")
def class_weights(spark, sf):
    out = prepare.balanced_weights(v.cases(spark, sf), "class")
    return rounded(out, "weight").withColumn("given_weight", F.when(F.col("class") == "p", 3.0).otherwise(1.0))


@add("standard_scale", "cases", f"""WITH m AS (SELECT avg(width) AS mw, stddev_pop(width) AS sw, avg(height) AS mh, stddev_pop(height) AS sh FROM cases WHERE {TRAIN})
    SELECT l_orderkey, l_linenumber, l_partkey, {r6("(width - mw) / sw")} AS width_scaled, {r6("(height - mh) / sh")} AS height_scaled FROM cases, m""")
def standard_scale(spark, sf):
    rows = v.cases(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "width", "height")
    out = prepare.scale(rows, rows.where(TRAIN), ["width", "height"])
    return rounded(out.drop("width", "height"), "width_scaled", "height_scaled")


VOTES = {"p_a": 0.35, "p_b": 0.45, "p_c": 0.2}


@add("soft_vote", "scores_li", f"""SELECT {", ".join(LI_KEY)}, {r6("p_a * 0.35::DOUBLE + p_b * 0.45::DOUBLE + p_c * 0.2::DOUBLE")} AS p_vote FROM scores_li""")
def soft_vote(spark, sf):
    return rounded(prepare.soft_vote(v.scores_li(spark, sf), VOTES).select(*LI_KEY, "p_vote"), "p_vote")


BLEND_K = "floor(s * 100)"
BLEND = f"""cells AS (SELECT p_a, p_b, p_c, sum(y) AS p, sum(1 - y) AS n FROM scores_li GROUP BY 1, 2, 3),
    w AS (SELECT CAST(i AS INTEGER) AS wa, CAST(j AS INTEGER) AS wb, CAST(20 - i - j AS INTEGER) AS wc FROM range(21) a(i), range(21) b(j) WHERE i + j <= 20),
    b AS (SELECT wa, wb, wc, p, n, (wa / 20.0::DOUBLE) * p_a + (wb / 20.0::DOUBLE) * p_b + (wc / 20.0::DOUBLE) * p_c AS s FROM cells, w),
    k1 AS (SELECT *, CASE WHEN ({BLEND_K} + 1) / 100.0::DOUBLE <= s THEN {BLEND_K} + 1 ELSE {BLEND_K} END AS k0 FROM b),
    h AS (SELECT wa, wb, wc, CASE WHEN k0 / 100.0::DOUBLE > s THEN k0 - 1 ELSE k0 END AS k, sum(p) AS p, sum(n) AS n FROM k1 GROUP BY 1, 2, 3, 4),
    t AS (SELECT wa, wb, wc, CAST(g AS DOUBLE) / 100.0::DOUBLE AS threshold, CAST(coalesce(sum(n) FILTER (WHERE k < g), 0) AS BIGINT) AS tn, CAST(coalesce(sum(n) FILTER (WHERE k >= g), 0) AS BIGINT) AS fp,
        CAST(coalesce(sum(p) FILTER (WHERE k < g), 0) AS BIGINT) AS fn, CAST(coalesce(sum(p) FILTER (WHERE k >= g), 0) AS BIGINT) AS tp FROM h, range(5, 96) r(g) GROUP BY ALL),
    s AS (SELECT *, {RATES} FROM t)"""


@add("blend_search", "scores_li", f"""WITH {BLEND} (SELECT 'best accuracy' AS choice, * FROM s ORDER BY accuracy DESC, balanced_accuracy DESC, f2 DESC, threshold DESC, wa, wb LIMIT 1)
    UNION ALL (SELECT 'enough recall' AS choice, * FROM s WHERE recall >= 0.85 ORDER BY accuracy DESC, precision DESC, f2 DESC, threshold DESC, wa, wb LIMIT 1)""")
def blend_search(spark, sf):
    """All 231 weight triples and 91 thresholds; best overall and best with enough recall."""
    swept = rounded(prepare.blend_sweep(v.scores_li(spark, sf), ["p_a", "p_b", "p_c"], "y"), *RATE_NAMES)
    return metrics.best_threshold(swept, 0.85, ["wa", "wb"])


@add("drop_suspicious_labels", "scores_li", """SELECT fold, y, CAST(count(*) FILTER (WHERE (y = 1 AND p_a < 0.35) OR (y = 0 AND p_a > 1 - 0.35::DOUBLE)) AS BIGINT) AS dropped,
    CAST(count(*) FILTER (WHERE NOT ((y = 1 AND p_a < 0.35) OR (y = 0 AND p_a > 1 - 0.35::DOUBLE))) AS BIGINT) AS kept FROM scores_li GROUP BY 1, 2""")
def drop_suspicious_labels(spark, sf):
    odd = prepare.suspicious(F.col("p_a"), F.col("y"), 0.35)
    return v.scores_li(spark, sf).groupBy("fold", "y").agg(F.count_if(odd).alias("dropped"), F.count_if(~odd).alias("kept"))


# --- clusters and components -------------------------------------------------------------------


def located(spark, sf):
    rows = modeling.busiest_stations(spark, sf).where("keep")
    north, east = geo.planar_km(F.col("lat"), F.col("lng"))
    return stage(rows.withColumns({"north": north, "east": east}), "stations")


def zone_kmeans(rows, k):
    ready = VectorAssembler(inputCols=["north", "east"], outputCol="features").transform(rows)
    return KMeans(k=k, seed=42, weightCol="trips", maxIter=40).fit(ready), ready


@add("weighted_kmeans_zones")
def weighted_kmeans_zones(spark, sf):
    """Zones from station positions in kilometres, weighted by recent trips, numbered from busy to quiet."""
    rows = located(spark, sf)
    model, ready = zone_kmeans(rows, 10)
    labelled = model.transform(ready).withColumnRenamed("prediction", "raw_zone")
    return modeling.zones_by_rank(labelled).select("start_station_id", "zone", "trips", "lat", "lng")


@add("choose_k")
def choose_k(spark, sf):
    """Cost, silhouette (on squared distance) and load per zone for several numbers of zones."""
    rows = located(spark, sf)
    out = None
    for k in (3, 5, 10, 15):
        model, ready = zone_kmeans(rows, k)
        labelled = model.transform(ready)
        silhouette = ClusteringEvaluator().evaluate(labelled)
        load = labelled.groupBy("prediction").agg(F.sum("trips").alias("t"))
        row = load.agg(F.lit(k).alias("k"), F.lit(model.summary.trainingCost).alias("cost"), F.lit(silhouette).alias("silhouette"),
                       F.percentile("t", 0.5).alias("median_load"), F.min("t").alias("quietest"))
        out = row if out is None else out.unionByName(row)
    return out


@add("behaviour_clusters")
def behaviour_clusters(spark, sf):
    """Stations grouped by their share of trips over 48 hour slots."""
    trips = v.trips_li(spark, sf).select("start_station_id", cal.slot(F.col("started_at")).alias("slot"))
    profiles = stage(modeling.slot_profiles(trips, 20), "profiles")
    ready = VectorAssembler(inputCols=profiles.columns[1:], outputCol="features").transform(profiles)
    return KMeans(k=4, seed=42).fit(ready).transform(ready).select("start_station_id", F.col("prediction").alias("profile"))


@add("pca_2d")
def pca_2d(spark, sf):
    """Two components of the scaled vectors."""
    rows = v.table(spark, sf, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("raw"))
    stages = [StandardScaler(inputCol="raw", outputCol="scaled", withMean=True), PCA(k=2, inputCol="scaled", outputCol="pc")]
    out = Pipeline(stages=stages).fit(rows).transform(rows).withColumn("pc", vector_to_array("pc"))
    return out.select("vec_id", F.col("pc")[0].alias("pc1"), F.col("pc")[1].alias("pc2"))


# --- fitted models -----------------------------------------------------------------------------


def duration_scores(scored, raw):
    """Clipped minutes from a log prediction, and the usual metrics."""
    out = scored.withColumn("pred", features.clip(raw, 0.0, features.MAX_MINUTES))
    return metrics.regression_metrics(out, "duration_minutes", "pred")


DURATION_NUMBERS = [c for c in features.DURATION_FEATURES if c not in features.DURATION_CATEGORIES]


def stacked(parts):
    out = None
    for name, part in parts:
        part = part.withColumn("model", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def risk_table(models, train, test):
    """AUC and rates at one half for each fitted classifier."""
    parts = []
    for name, (stages, learner) in models.items():
        scored = stage(modeling.risk_scores(modeling.fit(train, stages, learner), test).select("y", "p"), "scored")
        auc = metrics.roc_auc(scored, "p", "y").select("auc").scalar()
        rates = metrics.add_rates(metrics.confusion(scored, "y", F.col("p") >= 0.5))
        parts.append((name, rates.withColumn("auc", auc)))
    return stacked(parts)


@add("fit_linear")
def fit_linear(spark, sf):
    """Ridge on the logarithm of minutes, and a class-balanced logistic regression."""
    train, test, _ = modeling.duration_parts(spark, sf)
    numbers = DURATION_NUMBERS
    ridge = LinearRegression(labelCol="log_minutes", featuresCol="features", regParam=0.01, elasticNetParam=0.0, predictionCol="raw")
    model = modeling.fit(modeling.as_double(train, numbers), modeling.linear_stages(features.DURATION_CATEGORIES, numbers), ridge)
    fitted = duration_scores(model.transform(modeling.as_double(test, numbers)), features.inverse_log(F.col("raw")))
    rows = modeling.risk_frame(spark, sf)
    weighted = stage(prepare.with_balanced_weights(rows, rows.where("fold <> 0"), "y"), "weighted")
    table = risk_table({"logistic": (modeling.linear_stages(modeling.RISK_CATEGORIES, modeling.RISK_NUMBERS), modeling.logistic("weight"))},
                       weighted.where("fold <> 0"), weighted.where("fold = 0"))
    return fitted.select(F.lit("ridge").alias("model"), F.col("n").alias("rows"), F.col("mae").alias("score"), F.col("r2").alias("second")).unionByName(
        table.select("model", (F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")).alias("rows"), F.col("auc").alias("score"), F.col("recall").alias("second")))


@add("fit_poisson_glm")
def fit_poisson_glm(spark, sf):
    """Additive zone and slot effects against one effect per zone and slot, with a temperature spline."""
    rows = modeling.demand_frame(spark, sf)
    rows = glm.spline(rows, "temperature_c", 4, rows.where("split = 'train'"))
    rows = stage(rows.withColumns({c: F.col(c).cast("string") for c in ("zone", "slot", "zone_slot")}), "glm")
    numbers = [*[c for c in rows.columns if c.startswith("temperature_c_b")], "log_rain", "wind_kmh", "is_holiday"]
    parts = []
    for name, categories in (("additive", ["zone", "slot"]), ("interaction", ["zone_slot"])):
        learner = GeneralizedLinearRegression(family="poisson", link="log", labelCol="trips", regParam=1e-4, maxIter=25, predictionCol="pred")
        model = modeling.fit(modeling.as_double(rows.where("split = 'train'"), numbers), modeling.linear_stages(categories, numbers), learner)
        parts.append((name, metrics.count_metrics(model.transform(modeling.as_double(rows.where("split = 'test'"), numbers)), "trips", "pred")))
    return stacked(parts)


@add("fit_forest")
def fit_forest(spark, sf):
    """Random forest and decision tree, for counts and for classes."""
    rows = modeling.as_double(modeling.demand_frame(spark, sf), modeling.DEMAND_NUMBERS)
    prepared = Pipeline(stages=modeling.tree_stages([], modeling.DEMAND_NUMBERS, modeling.DEMAND_CATEGORIES)).fit(rows.where("split = 'train'"))
    vectors = stage(prepared.transform(rows).select("features", "trips", "split"), "vectors")
    parts = []
    for name, learner in (("forest", RandomForestRegressor(labelCol="trips", numTrees=20, maxDepth=8, seed=42, predictionCol="pred")),
                          ("tree", DecisionTreeRegressor(labelCol="trips", maxDepth=8, seed=42, predictionCol="pred"))):
        model = modeling.learned(learner, vectors.where("split = 'train'"))
        out = metrics.count_metrics(model.transform(vectors.where("split = 'test'")), "trips", "pred")
        parts.append((name, out.select(F.col("n").alias("rows"), F.col("mae").alias("score"), F.col("r2").alias("second"))))
    cases = modeling.risk_frame(spark, sf)
    kinds = modeling.tree_stages(modeling.RISK_CATEGORIES, modeling.RISK_NUMBERS)
    table = risk_table({"forest classifier": (kinds, RandomForestClassifier(labelCol="y", numTrees=20, maxDepth=6, seed=42)),
                        "tree classifier": (kinds, DecisionTreeClassifier(labelCol="y", maxDepth=6, seed=42))}, cases.where("fold <> 0"), cases.where("fold = 0"))
    return stacked(parts).unionByName(table.select(
        (F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")).alias("rows"), F.col("auc").alias("score"), F.col("recall").alias("second"), "model"))


@add("fit_boosting")
def fit_boosting(spark, sf):
    """Boosted trees on the logarithm of minutes and on minutes, squared and absolute loss; and on zone counts, Poisson loss."""
    train, test, _ = modeling.duration_parts(spark, sf)
    codes = modeling.Codes(features.DURATION_CATEGORIES).fit(train)
    train, test = codes.transform(train), codes.transform(test)
    columns = [*DURATION_NUMBERS, *[f"_c_{c}" for c in features.DURATION_CATEGORIES]]
    parts = []
    for name, label, loss in (("log squared", "log_minutes", "squared"), ("squared", "duration_minutes", "squared"), ("absolute", "duration_minutes", "absolute")):
        scored = boosting.fit_boosted(train, label, columns, loss).predict(test, "raw")
        raw = F.col("raw")
        parts.append((name, duration_scores(scored, features.inverse_log(raw) if label == "log_minutes" else raw)))
    rows = modeling.demand_frame(spark, sf)
    counts = boosting.fit_boosted(rows.where("split = 'train'"), "trips", [*modeling.DEMAND_NUMBERS, *modeling.DEMAND_CATEGORIES], "poisson")
    parts.append(("poisson", metrics.regression_metrics(counts.predict(rows.where("split = 'test'")), "trips", "pred")))
    return stacked(parts)


def risk_stages(whole=()):
    return modeling.linear_stages(modeling.RISK_CATEGORIES, modeling.RISK_NUMBERS, whole=whole)


def risk_rows(spark, sf):
    """What the risk models read, and the numbers that no row lacks."""
    rows = modeling.risk_frame(spark, sf).select(*modeling.RISK_COLUMNS)
    return rows, modeling.complete(rows, modeling.RISK_NUMBERS)


def risk_learners():
    return {"logistic": modeling.logistic(), "tree": DecisionTreeClassifier(labelCol="y", maxDepth=5, seed=42)}


@add("cross_validate")
def cross_validate(spark, sf):
    """Scores per fold from out-of-fold predictions of two models."""
    rows, whole = risk_rows(spark, sf)
    oof = modeling.out_of_fold(rows, risk_stages(whole), risk_learners(), range(5))
    long = oof.unpivot(["fold", "y"], ["p_logistic", "p_tree"], "model", "p")
    auc = metrics.roc_auc(long, "p", "y", ["model", "fold"])
    ap = metrics.average_precision(long, "p", "y", ["model", "fold"])
    return auc.join(ap, ["model", "fold"])


SEARCH_GRID = {"maxDepth": [3, 6], "minInstancesPerNode": [1, 20]}
SEARCH_SPACE = {"maxDepth": modeling.Between(2, 8), "minInstancesPerNode": modeling.Between(1, 100, log=True)}
#: Random candidates, and the folds that each rung adds with how many candidates go on after it.
N_RANDOM, RUNGS = 8, [([0], 4), ([1], 2), ([2, 3, 4], None)]


@add("hyperparameter_search")
def hyperparameter_search(spark, sf):
    """A grid on all given folds, and a random search that halves its candidates as folds are added, by score."""
    learner = DecisionTreeClassifier(labelCol="y", seed=42)
    rows, whole = risk_rows(spark, sf)
    with modeling.dealt(rows) as kept:
        # the preparation is part of what is fitted on the training folds
        stages = modeling.tree_stages(modeling.RISK_CATEGORIES, modeling.RISK_NUMBERS, whole=whole)
        search = modeling.FoldSearch(kept, stages, learner, BinaryClassificationEvaluator(labelCol="y"), even=True)
        found = [("grid", *r) for r in search.halving(modeling.grid(SEARCH_GRID), [(range(5), None)])]
        found += [("random", *r) for r in search.halving(modeling.sampled(SEARCH_SPACE, N_RANDOM, 42), RUNGS)]
    rows = [(method, c["maxDepth"], c["minInstancesPerNode"], len(s), float(np.mean(s)), float(np.std(s, ddof=1)) if len(s) > 1 else None) for method, c, s in found]
    return spark.createDataFrame(rows, "method string, max_depth int, min_rows int, folds int, auc double, auc_std double").orderBy(F.desc("auc"))


@add("stack_models")
def stack_models(spark, sf):
    """A logistic regression on the out-of-fold scores of two models, judged on folds 3 and 4."""
    rows, whole = risk_rows(spark, sf)
    oof = modeling.out_of_fold(rows, risk_stages(whole), risk_learners(), range(5))
    ready = VectorAssembler(inputCols=["p_logistic", "p_tree"], outputCol="features").transform(oof.select("fold", "y", "p_logistic", "p_tree"))
    meta = modeling.learned(modeling.logistic(), ready.where("fold < 3"))
    scored = modeling.positive_score(meta.transform(ready.where("fold >= 3")), "p_stacked")
    return metrics.roc_auc(scored.unpivot(["y"], ["p_logistic", "p_tree", "p_stacked"], "model", "p"), "p", "y", ["model"])


LOW, HIGH = 0.3, 0.7


@add("cascade_specialist")
def cascade_specialist(spark, sf):
    """A second model fitted only on doubtful rows. For each held-out fold, doubt on the training side is decided by models
    that saw neither the row's fold nor the held-out one, so the comparison on the held-out doubtful rows is fair."""
    rows, whole = risk_rows(spark, sf)
    special = (modeling.tree_stages(modeling.RISK_CATEGORIES, modeling.RISK_NUMBERS, whole=whole), GBTClassifier(labelCol="y", maxIter=5, maxDepth=4, seed=42))
    # the score is worked out once for both ends of the range
    in_doubt = F.exists(F.array("p_first"), lambda p: p.between(LOW, HIGH))
    with modeling.dealt(rows) as kept, ThreadPoolExecutor(2) as pool:

        def first(folds):
            """The rows of ``folds`` that a model of all other rows doubts."""
            held = F.col("fold").isin(list(folds))
            model = modeling.fit(kept.where(~held), risk_stages(whole), modeling.logistic(), even=True)
            return modeling.risk_scores(model, kept.where(held), "p_first").where(in_doubt)

        # a model without folds h and k scores k for the held-out h, and h for the held-out k
        inner = None
        pairs = list(combinations(range(5), 2))
        for (h, k), scored in zip(pairs, pool.map(first, pairs), strict=True):
            scored = scored.withColumn("held", F.when(F.col("fold") == h, k).otherwise(h))
            inner = scored if inner is None else inner.unionByName(scored)
        inner = stage(inner, "doubtful")
        out = None
        for held, judged in enumerate(pool.map(first, [(k,) for k in range(5)])):
            judged = modeling.risk_scores(modeling.fit(inner.where(F.col("held") == held).drop("p_first", "held"), *special), judged, "p_special")
            out = judged if out is None else out.unionByName(judged)
        out = stage(out, "cascade")
    return metrics.roc_auc(out.unpivot(["y"], ["p_first", "p_special"], "model", "p"), "p", "y", ["model"])


@add("permutation_importance")
def permutation_importance(spark, sf):
    """How much the error grows when a column, or the weather columns together, come from another row. All
    variants are scored in one pass; a repeat costs one more pairing of rows."""
    rows = modeling.demand_frame(spark, sf)
    numbers = modeling.DEMAND_NUMBERS
    model = modeling.demand_model(rows.where("split = 'train'"), rounds=5)
    test = stage(rows.where("split = 'test'").withColumn("hour_number", F.timestamp_diff("HOUR", F.lit("2000-01-01").cast("timestamp_ntz"), F.col("time"))), "test")
    made = [*modeling.DEMAND_CATEGORIES, *numbers]
    groups = {c: [c] for c in made} | {"weather": ["temperature_c", "precipitation_mm", "wind_kmh", "snow_depth_cm"]}
    placed = modeling.positions(test, ["hour_number", "zone"])
    out = None
    for repeat in range(2):
        pair = modeling.permuted(placed, made, repeat)
        variants = [F.struct(F.lit(name).alias("feature"), *[F.col(f"_p_{c}" if c in cols else c).cast("double" if c in numbers else "int").alias(c) for c in made]) for name, cols in {"(none)": [], **groups}.items()]
        wide = pair.select("trips", F.explode(F.array(*variants)).alias("v")).select("trips", "v.*")
        scored = modeling.predict_demand(model, wide)
        part = scored.groupBy("feature").agg(F.avg(F.abs(F.col("trips") - F.col("pred"))).alias("mae")).withColumn("repeat", F.lit(repeat))
        out = part if out is None else out.unionByName(part)
    table = stage(out, "importance")
    base = table.where("feature = '(none)'").select(F.avg("mae").alias("m")).scalar()
    return table.where("feature <> '(none)'").groupBy("feature").agg(F.avg(F.col("mae") - base).alias("increase"), F.stddev_samp("mae").alias("std"))


@add("feature_ablation")
def feature_ablation(spark, sf):
    """Fit again without chosen features."""
    rows = modeling.demand_frame(spark, sf)
    parts = []
    for name, drop in (("all", []), ("no supply", ["active_stations"]), ("no snow", ["snow_depth_cm"]), ("no weather", ["temperature_c", "precipitation_mm", "wind_kmh", "snow_depth_cm"])):
        numbers = [c for c in modeling.DEMAND_NUMBERS if c not in drop]
        model = modeling.demand_model(rows.where("split = 'train'"), numbers, rounds=5)
        parts.append((name, metrics.count_metrics(modeling.predict_demand(model, rows.where("split = 'test'"), numbers), "trips", "pred")))
    return stacked(parts)


# --- scoring and publishing --------------------------------------------------------------------


def duration_model(train, rounds=5):
    numbers = DURATION_NUMBERS
    learner = GBTRegressor(labelCol="log_minutes", maxIter=rounds, maxDepth=5, maxBins=64, seed=42, predictionCol="raw")
    return modeling.fit(modeling.as_double(train, numbers), modeling.tree_stages(features.DURATION_CATEGORIES, numbers), learner)


def score_requests(requests, fitted, model):
    """Requests to minutes: history, features, model, clip, with what the answer rests on."""
    ready = features.duration_features(history.apply_history(requests, fitted))
    scored = model.transform(modeling.as_double(ready, DURATION_NUMBERS))
    given = F.lit(True)
    for c in features.WEATHER_DURATION:
        given = given & F.col(c).isNotNull()
    return scored.withColumns({
        "predicted_duration_minutes": F.round(features.clip(features.inverse_log(F.col("raw")), 0.0, features.MAX_MINUTES), 1),
        "direct_distance_km": F.round("direct_distance_km", 2),
        "route_trips_in_history": F.round(F.expm1("route_history_log_count")).cast("long"),
        "weather_source": F.when(given, "given").otherwise("missing: median of training"),
    })


@add("score_batch")
def score_batch(spark, sf):
    """Every request of the event table that passes the field rules; weather is absent on some."""
    train, _, fitted = modeling.duration_parts(spark, sf)
    requests = v.trips_ev(spark, sf).withColumn("_why", clean.reasons(clean.request_checks())).where("_why = ''")
    requests = joins.join_hourly(requests, features.duration_weather(v.weather(spark, sf)), "started_at", "time", features.WEATHER_DURATION)
    requests = requests.withColumns({c: F.when(F.col("event_id") % 7 != 0, F.col(c)) for c in features.WEATHER_DURATION})
    out = score_requests(requests, fitted, duration_model(train))
    return out.select("ride_id", "predicted_duration_minutes", "direct_distance_km", "route_trips_in_history", "weather_source")


def day_requests(spark, sf, zones, scenarios=True):
    """24 hours for every zone and covered day, under every weather scenario."""
    hours = features.weather_scenarios(v.weather(spark, sf))
    supply = zones.select("zone", "active_stations")
    cells = hours.withColumn("zone", F.explode(F.sequence(F.lit(0), F.lit(demand.N_ZONES - 1))))
    return features.demand_features(cells.join(supply, "zone"))


def current_supply(rows):
    """Active stations per zone in the newest month."""
    return rows.groupBy("zone").agg(F.max_by("active_stations", "time").alias("active_stations"))


@add("score_day")
def score_day(spark, sf):
    """Hourly predictions per zone, day and scenario, and the total of the day."""
    rows = modeling.demand_frame(spark, sf)
    model = modeling.demand_model(rows.where("split = 'train'"), rounds=5)
    scored = modeling.predict_demand(model, day_requests(spark, sf, current_supply(rows)))
    return scored.groupBy("zone", cal.day_floor(F.col("time")).alias("day"), "scenario").agg(
        F.concat_ws(",", F.transform(F.sort_array(F.collect_list(F.struct("hour", F.round("pred", 1).alias("p")))), lambda e: e["p"].cast("string"))).alias("hourly_trips"),
        F.round(F.sum("pred")).cast("long").alias("total_trips"), F.count(F.lit(1)).alias("hours"))


def publish(spark, model, about, folder):
    """The model and what is known of it, side by side."""
    model.write().overwrite().save(f"{folder}/model")
    spark.createDataFrame([(json.dumps(about),)], "value string").write.mode("overwrite").text(f"{folder}/metadata")


def published(spark, folder):
    """The published model and its metadata (``test_period``, ``mae``) as a one-row table."""
    about = spark.read.text(f"{folder}/metadata").select(F.from_json("value", "test_period string, mae double").alias("m")).select("m.*")
    return PipelineModel.load(f"{folder}/model"), about


def gate(new, old, test, period):
    """The usual gate (2 %) between two models on the same test period."""

    def row(model):
        measured = metrics.count_metrics(modeling.predict_demand(model, test), "trips", "pred")
        return measured.select(F.lit(period).alias("test_period"), "mae")

    return stage(metrics.quality_gate(row(new), row(old)), "gate")


@add("retrain_and_publish")
def retrain_and_publish(spark, sf):
    """A first model of the older half is published. A new one is measured against it on the held-out weeks, passes the
    gate or not, is fitted on everything and published in its place, and is read back."""
    rows = modeling.demand_frame(spark, sf)
    train, test = rows.where("split = 'train'"), rows.where("split = 'test'")
    folder = staging_path(spark, "published")
    period = test.select(F.concat_ws(" to ", F.min("time").cast("string"), F.max("time").cast("string")).alias("p")).first()["p"]
    half = train.select(F.percentile(F.unix_seconds(F.col("time").cast("timestamp")), 0.5).alias("h")).scalar()
    older = train.where(F.unix_seconds(F.col("time").cast("timestamp")) <= half)
    publish(spark, modeling.demand_model(older), {"test_period": "", "mae": None}, folder)
    current, _ = published(spark, folder)
    decision = gate(modeling.demand_model(train), current, test, period)
    verdict = decision.first()
    if verdict["accepted"]:
        about = {"features": list(features.DEMAND_FEATURES), "target": "trips per zone and hour", "test_period": period, "mae": verdict["new_mae"]}
        publish(spark, modeling.demand_model(rows), about, folder)
    again, about = published(spark, folder)
    scored = modeling.predict_demand(again, test).agg(F.count_if(F.col("pred") >= 0).alias("scored")).scalar()
    stored = about.select("mae").scalar()
    return decision.withColumns({"published_mae": F.when(F.col("accepted"), stored), "scored": scored})


@add("plausibility_checks")
def plausibility_checks(spark, sf):
    """Behaviour of fitted models on probe requests taken from the data: scores in range for every
    category, and the direction of distance, hour and weather effects."""
    train, test, fitted = modeling.duration_parts(spark, sf)
    model = duration_model(train)
    probes = test.select("ride_id", "started_at", *features.DURATION_CATEGORIES, "start_lat", "start_lng", "end_lat", "end_lng", *features.WEATHER_DURATION)
    out = score_requests(probes, fitted, model)
    minutes = F.col("predicted_duration_minutes")
    far = exact_quantiles(test, [], "direct_distance_km", {"q": 0.5}).select("q").scalar()
    ranges = out.agg(F.lit("duration in range").alias("check_name"), F.count_if(~minutes.between(0, 180)).cast("double").alias("value"),
                     (F.count_if(~minutes.between(0, 180)) == 0).alias("passed"))
    longer = F.avg(F.when(F.col("direct_distance_km") > far, minutes)) - F.avg(F.when(F.col("direct_distance_km") <= far, minutes))
    distance = out.agg(F.lit("farther minus nearer minutes").alias("check_name"), longer.alias("value"), (longer > 0).alias("passed"))
    # stations nobody has seen, and the evening of a holiday
    strange = probes.withColumns({"start_station_id": F.lit("nowhere"), "end_station_id": F.lit("nowhere else"), "started_at": F.lit("2026-07-04 23:45:00").cast("timestamp_ntz")})
    odd = score_requests(strange, fitted, model).agg(
        F.lit("unknown stations on a holiday in range").alias("check_name"), F.count_if(~minutes.between(0, 180)).cast("double").alias("value"),
        (F.count_if(F.coalesce(~minutes.between(0, 180), F.lit(True))) == 0).alias("passed"))
    kinds = out.groupBy("rideable_type", "member_casual").agg(F.avg(minutes).alias("value")).select(
        F.concat_ws(" ", F.lit("scores"), "rideable_type", "member_casual").alias("check_name"), "value", F.col("value").isNotNull().alias("passed"))
    rows = modeling.demand_frame(spark, sf)
    scored = stage(modeling.predict_demand(modeling.demand_model(rows.where("split = 'train'"), rounds=5), day_requests(spark, sf, current_supply(rows))), "probes")

    def versus(name, one, other):
        gap = F.avg(F.when(one, F.col("pred"))) - F.avg(F.when(other, F.col("pred")))
        return scored.agg(F.lit(name).alias("check_name"), gap.alias("value"), (gap > 0).alias("passed"))

    dry = F.col("scenario") == "dry"
    return (ranges.unionByName(distance).unionByName(kinds).unionByName(odd)
            .unionByName(versus("rush minus night", dry & (F.col("hour") == 8), dry & (F.col("hour") == 4)))
            .unionByName(versus("dry minus heavy rain", dry, F.col("scenario") == "heavy")))
