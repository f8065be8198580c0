"""Training frames and model stages shared by the model queries."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidewheel.functions import features
from tidewheel.operators import clean, history, joins, splits
from tidewheel.operators.order import row_index
from tidewheel.plans import demand
from tidewheel.plans import views as v
from tidewheel.session import stage

RISK_CATEGORIES = ["brand", "kind", "season"]
RISK_NUMBERS = ["size", "width", "height"]
RISK_COLUMNS = [*RISK_CATEGORIES, *RISK_NUMBERS, "y", "fold"]
DEMAND_CATEGORIES = ["zone"]
DEMAND_NUMBERS = [c for c in features.DEMAND_FEATURES if c not in DEMAND_CATEGORIES]


def demand_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Zone-hours with demand features, staged once for all passes of a fit."""
    table = features.demand_features(demand.model_table(spark, sf)).where("temperature_c is not null")
    out = table.withColumns({
        "slot": F.col("hour") + 24 * F.col("is_weekend"), "log_rain": F.log1p("precipitation_mm"), "log_trips": F.log1p("trips")})
    out = out.withColumn("zone_slot", F.col("zone") * 48 + F.col("slot"))
    return stage(out, "demand")


def duration_parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, Mapping[str, DataFrame]]:
    """Train and test trips with duration features; history looks only backwards in train and comes from
    train in test."""
    trips = clean.clean_trips(v.trips_ev(spark, sf))
    trips = joins.join_hourly(trips, features.duration_weather(v.weather(spark, sf)), "started_at", "time", features.WEATHER_DURATION)
    parts = splits.temporal_split(stage(trips, "trips"), ["started_at", "event_id"])
    train, test = parts.where("split = 'train'"), parts.where("split = 'test'")
    fitted = history.fit_history(train, "duration_minutes")
    past = history.expanding_history(train, "duration_minutes", ["started_at", "event_id"])
    made = [features.duration_features(past), features.duration_features(history.apply_history(test, fitted))]
    keep = ["ride_id", "started_at", "duration_minutes", *features.DURATION_FEATURES]
    ready = [stage(m.select(*keep).withColumn("log_minutes", F.log1p("duration_minutes")), "duration") for m in made]
    return ready[0], ready[1], fitted


def risk_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Cases with a 0/1 label and five class-balanced folds."""
    ties = ["l_orderkey", "l_linenumber", "l_partkey", "width", "height"]
    rows = splits.stratified_folds(v.cases(spark, sf).drop("noise_0", "noise_1"), "class", splits.mixed_number(F.col("l_orderkey"), F.col("l_linenumber")), ties, 5)
    rows = rows.withColumns({c: F.coalesce(c, F.lit("unknown")) for c in RISK_CATEGORIES})
    rows = rows.withColumn("y", (F.col("class") == "p").cast("double"))
    # a label that depends on the features, so that there is something to learn
    signal = F.col("width") / 50 + F.col("height") / 105 + (F.col("season") == "u").cast("double")
    draw = splits.mixed_number(F.col("l_partkey"), F.col("l_orderkey")) / float(splits.MODULUS)
    return stage(rows.withColumn("y", F.when(draw < 0.08, F.col("y")).otherwise((signal > 1.2).cast("double"))), "risk")


class Codes(Estimator):
    """Numbers for categories, ``<column>`` to ``_c_<column>``, without the nominal marks that would make a learner treat
    them as a set: ordinal codes in alphabetical order with -1 for unknown values, or, with ``at_least``, codes by
    frequency in which values of fewer rows and unknown ones share the last."""

    def __init__(self, columns: Sequence[str], at_least: int = 0):
        super().__init__()
        self.columns, self.at_least = list(columns), at_least

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        return self._coded(dataset)[0]

    def _coded(self, dataset: DataFrame) -> tuple[PipelineModel, list[int]]:
        """The model, and the largest code of each column in ``dataset``; one pass counts the values of all columns."""
        tallies = [dataset.groupBy(F.col(c).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n")).withColumn("at", F.lit(i)) for i, c in enumerate(self.columns)]
        counts: list[dict[str | None, int]] = [{} for _ in self.columns]
        for r in reduce(DataFrame.unionByName, tallies).collect():  # the labels of a model are held by the driver
            counts[r["at"]][r["value"]] = r["n"]
        stages, picks, most = [], [], []
        for column, seen in zip(self.columns, counts, strict=True):
            # as the library's own indexer orders them: by code points, with ``at_least`` the commonest first
            labels = sorted((x for x in seen if x is not None), key=lambda x: (-seen[x] if self.at_least else 0, x))
            stages.append(StringIndexerModel.from_labels(labels, inputCol=column, outputCol=f"_i_{column}", handleInvalid="keep"))
            if self.at_least:
                common = sum(seen[x] >= self.at_least for x in labels)
                picks.append(f"least(`_i_{column}`, {float(common)}D) AS `_c_{column}`")
                most.append(common if len(seen) > common else max(common - 1, 0))
            else:
                picks.append(f"if(`_i_{column}` >= {len(labels)}, -1D, `_i_{column}` + 0D) AS `_c_{column}`")
                most.append(len(labels) - 1)
        return PipelineModel([*stages, SQLTransformer(statement=f"SELECT *, {', '.join(picks)} FROM __THIS__")]), most


class OneHotCodes(Codes):
    """``Codes`` and their one-hot vectors, ``_c_<column>`` to ``_o_<column>``. Counting values for the codes tells how long
    the vectors are, so no pass looks for the largest code."""

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        codes, most = self._coded(dataset)
        ends = dataset.sparkSession.range(1).select(*[F.lit(float(n)).alias(f"_c_{c}") for c, n in zip(self.columns, most, strict=True)])
        encoder = OneHotEncoder(inputCols=[f"_c_{c}" for c in self.columns], outputCols=[f"_o_{c}" for c in self.columns], handleInvalid="keep")
        return PipelineModel([*codes.stages, encoder.fit(ends)])


def complete(rows: DataFrame, columns: Sequence[str]) -> list[str]:
    """Those of the numeric ``columns`` in which no row lacks a number."""
    if not columns:
        return []
    lacking = rows.agg(*[F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).alias(c) for c in columns]).first()
    return [c for c in columns if not lacking[c]]


def _numbers(numbers: Sequence[str], whole: Sequence[str]) -> tuple[list, list[str]]:
    """The stages that fill missing numbers, and the columns that hold all numbers then."""
    gaps = [c for c in numbers if c not in whole]
    fill = [Imputer(inputCols=gaps, outputCols=[f"_f_{c}" for c in gaps], strategy="median")] if gaps else []
    return fill, [c if c in whole else f"_f_{c}" for c in numbers]


def linear_stages(categories: Sequence[str], numbers: Sequence[str], at_least: int = 5, whole: Sequence[str] = ()) -> list:
    """One-hot categories in which rare values (fewer than ``at_least`` training rows) and unknown ones are one, median
    for missing numbers, one vector. MLlib's linear learners scale columns themselves before they penalise. For numbers that
    no row lacks, in training or later (``whole``), no median is looked for."""
    fill, filled = _numbers(numbers, whole)
    stages = [OneHotCodes(categories, at_least)] if categories else []
    return [*stages, *fill, VectorAssembler(inputCols=[*filled, *[f"_o_{c}" for c in categories]], outputCol="features")]


def tree_stages(categories: Sequence[str], numbers: Sequence[str], nominal: Sequence[str] = (), whole: Sequence[str] = ()) -> list:
    """Ordinal codes for ``categories``, which trees split as ordered numbers however many there are (-1: unknown), and
    sets for the few values of ``nominal`` columns (fewer than a learner's bins). ``whole`` as in ``linear_stages``."""
    fill, filled = _numbers(numbers, whole)
    stages: list = []
    if categories:
        stages.append(Codes(categories))
    if nominal:
        stages.append(StringIndexer(inputCols=list(nominal), outputCols=[f"_n_{c}" for c in nominal], handleInvalid="keep", stringOrderType="alphabetAsc"))
    return [*stages, *fill, VectorAssembler(inputCols=[*filled, *[f"_c_{c}" for c in categories], *[f"_n_{c}" for c in nominal]], outputCol="features")]


def as_double(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


#: A partition of rows that a learner passes over holds so many at most, whatever the size of the files they are read from:
#: a file split of repetitive columns is many times as large in memory. Below that, no more partitions than cores.
FIT_ROWS, LEAST_ROWS = 200_000, 10_000


def _even(rows: DataFrame) -> DataFrame:
    n = rows.count()
    return rows.repartition(max(min(rows.sparkSession.sparkContext.defaultParallelism, -(-n // LEAST_ROWS)), -(-n // FIT_ROWS), 1))


@contextmanager
def dealt(rows: DataFrame) -> Iterator[DataFrame]:
    """``rows``, which are read from a written table, dealt out evenly and kept meanwhile. Folds of them are spread evenly as
    well, so they are fitted without dealing them out again (``even``)."""
    kept = _even(rows).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def pinned(prepared: Transformer, rows: DataFrame, columns: Sequence[str], even: bool = False) -> DataFrame:
    """``rows``, which are read from a written table and dealt out evenly unless they are ``even`` already, prepared, and kept
    for the passes of a learner."""
    return prepared.transform(rows if even else _even(rows)).select(*columns).persist(StorageLevel.MEMORY_AND_DISK)


def inputs(learner: Estimator) -> list[str]:
    """The columns that a learner reads."""
    optional = [learner.getParam(name) for name in ("weightCol", "offsetCol", "validationIndicatorCol") if learner.hasParam(name)]
    given = [learner.getOrDefault(param) for param in optional if learner.isDefined(param)]
    return [learner.getFeaturesCol(), learner.getLabelCol(), *filter(None, given)]


def learned(learner: Estimator, rows: DataFrame, prepared: Transformer | None = None, even: bool = False) -> Model:
    """The learner's model of ``rows``, of which it passes over its own columns only, in parts of bounded size."""
    train = pinned(prepared or PipelineModel([]), rows, inputs(learner), even)
    try:
        return learner.fit(train)
    finally:
        train.unpersist()


def fit(df: DataFrame, stages: list, learner: Estimator, even: bool = False) -> PipelineModel:
    prepared = Pipeline(stages=stages).fit(df)
    return PipelineModel([*prepared.stages, learned(learner, df, prepared, even)])


def positive_score(scored: DataFrame, name: str = "p") -> DataFrame:
    return scored.withColumn(name, vector_to_array("probability")[1])


def risk_scores(model: PipelineModel, rows: DataFrame, name: str = "p") -> DataFrame:
    keep = rows.columns
    return positive_score(model.transform(rows), name).select(*keep, name)


def out_of_fold(rows: DataFrame, stages: list, learners: Mapping[str, Estimator], folds: Sequence[int], fold: str = "fold") -> DataFrame:
    """Scores of each model for rows it was not fitted on, staged. The preparation of a fold is fitted
    once and shared by its models; rows are dealt out once for all folds."""
    columns = sorted({c for learner in learners.values() for c in inputs(learner)})
    out = None
    with dealt(rows) as kept:
        for k in folds:
            rest = kept.where(F.col(fold) != k)
            prepare = Pipeline(stages=stages).fit(rest)
            train = pinned(prepare, rest, columns, even=True)
            held = prepare.transform(kept.where(F.col(fold) == k))
            keep = list(rows.columns)
            for name, learner in learners.items():
                held = positive_score(learner.fit(train).transform(held), f"p_{name}").select(*keep, "features", f"p_{name}")
                keep.append(f"p_{name}")
            train.unpersist()
            out = held.drop("features") if out is None else out.unionByName(held.drop("features"))
        return stage(out, "oof")


def logistic(weight: str | None = None) -> LogisticRegression:
    learner = LogisticRegression(labelCol="y", featuresCol="features", regParam=0.001, maxIter=20)
    return learner.setWeightCol(weight) if weight else learner


def demand_model(rows: DataFrame, numbers: Sequence[str] = tuple(DEMAND_NUMBERS), rounds: int = 10) -> PipelineModel:
    """Boosted trees on the logarithm of the count; the zone is a category."""
    learner = GBTRegressor(labelCol="log_trips", featuresCol="features", predictionCol="log_pred", maxIter=rounds, maxDepth=5, seed=42)
    return fit(as_double(rows, numbers), tree_stages([], numbers, DEMAND_CATEGORIES), learner)


def predict_demand(model: PipelineModel, rows: DataFrame, numbers: Sequence[str] = tuple(DEMAND_NUMBERS)) -> DataFrame:
    """Counts, never below zero."""
    keep = rows.columns
    scored = model.transform(as_double(rows, numbers))
    return scored.withColumn("pred", F.greatest(F.lit(0.0), F.expm1("log_pred"))).select(*[F.col(c) for c in keep], "pred")


def keyed_bijection(x: np.ndarray, n: int, key: int, rounds: int = 6) -> np.ndarray:
    """Each of 0 .. n-1 once, in an order that follows from ``key``. A number is split into row and column of a table with
    room for n or little more, and each is shifted in turn by a hash of the other (a Feistel network); where that leads
    to a place beyond n it is done again, which ends, as the step is one-to-one."""
    wide = max(1, math.isqrt(max(n - 1, 0)) + 1)
    high = -(-n // wide) or 1

    def mixed(v: np.ndarray, salt: int) -> np.ndarray:
        h = (v.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((h ^ (h >> np.uint64(32))) >> np.uint64(1)).astype(np.int64)

    def step(v: np.ndarray) -> np.ndarray:
        row, column = v // wide, v % wide
        for k in range(rounds):
            salt = (key * 1_000_003 + 2 * k) % (1 << 62)
            row = (row + mixed(column, salt)) % high
            column = (column + mixed(row, salt + 1)) % wide
        return row * wide + column

    out = step(np.asarray(x, np.int64))
    while (beyond := out >= n).any():
        out[beyond] = step(out[beyond])
    return out


def positions(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with their place ``_a`` in one order, written once for all repeats of ``permuted``."""
    return stage(row_index(rows, keys, "_a", spread_copies=False).drop("_a_n"), "positions")


def permuted(placed: DataFrame, columns: Sequence[str], repeat: int) -> DataFrame:
    """Rows of ``positions`` with ``_p_<column>``: the columns of another row, each row's used once. A row's partner is
    computed from its place, so a repeat costs one join by place and no order of its own."""
    n = placed.count()

    def partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            other = keyed_bijection(batch.column("_a").to_numpy(), n, repeat + 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(other)], [*batch.schema.names, "_b"])

    paired = placed.mapInArrow(partners, StructType([*placed.schema, StructField("_b", LongType())]))
    other = placed.select(F.col("_a").alias("_b"), *[F.col(c).alias(f"_p_{c}") for c in columns])
    return paired.join(other, "_b").drop("_a", "_b")


@dataclass(frozen=True)
class Between:
    """A parameter's values from ``low`` to ``high``: evenly spread, or with ``log`` so in their logarithm; whole numbers or not."""

    low: float
    high: float
    whole: bool = True
    log: bool = False

    def draw(self, rng: np.random.Generator) -> float | int:
        ends = (math.log(self.low), math.log(self.high)) if self.log else (self.low, self.high)
        if self.whole and not self.log:
            return int(rng.integers(self.low, self.high + 1))
        value = rng.uniform(*ends)
        value = min(max(math.exp(value) if self.log else value, self.low), self.high)
        return int(round(value)) if self.whole else float(value)


Candidate = dict[str, object]


def sampled(space: Mapping[str, Between | Sequence[object]], n: int, seed: int) -> list[Candidate]:
    """``n`` different candidates (fewer if the space has no more), each parameter drawn from its range or list; the same ones
    for the same seed."""
    rng, found = np.random.default_rng(seed), []
    for _ in range(50 * n):
        one = {name: values.draw(rng) if isinstance(values, Between) else values[int(rng.integers(len(values)))] for name, values in space.items()}
        if one not in found:
            found.append(one)
        if len(found) == n:
            break
    return found


def grid(space: Mapping[str, Sequence[object]]) -> list[Candidate]:
    """Every combination of the listed values."""
    return [dict(zip(space, values, strict=True)) for values in product(*space.values())]


class FoldSearch:
    """Scores of candidates on given folds. Rows are dealt out once (``dealt``); the preparation of a fold is fitted on its
    training rows once and shared by all candidates and searches."""

    def __init__(self, rows: DataFrame, stages: list, learner: Estimator, evaluator: Evaluator, fold: str = "fold", even: bool = False):
        self.rows, self.stages, self.learner, self.evaluator, self.fold, self.even = rows, stages, learner, evaluator, fold, even
        self.prepared: dict[int, PipelineModel] = {}

    def _parts(self, k: int) -> list[DataFrame]:
        """A fold's training rows and the held-out ones, prepared and kept."""
        train, held = self.rows.where(F.col(self.fold) != k), self.rows.where(F.col(self.fold) == k)
        if k not in self.prepared:
            self.prepared[k] = Pipeline(stages=self.stages).fit(train)
        keep = [self.learner.getFeaturesCol(), self.learner.getLabelCol()]
        return [pinned(self.prepared[k], part, keep, self.even) for part in (train, held)]

    def _scored(self, candidate: Candidate, train: DataFrame, held: DataFrame) -> float:
        settings = {self.learner.getParam(name): value for name, value in candidate.items()}
        return float(self.evaluator.evaluate(self.learner.copy(settings).fit(train).transform(held)))

    def _scores(self, pool: ThreadPoolExecutor, candidates: Sequence[Candidate], k: int) -> list[float]:
        """All candidates on a fold, whose rows are kept meanwhile."""
        parts = self._parts(k)
        try:
            return list(pool.map(lambda c: self._scored(c, *parts), candidates))
        finally:
            for part in parts:
                part.unpersist()

    def halving(self, candidates: Sequence[Candidate], rungs: Sequence[tuple[Sequence[int], int | None]], parallelism: int = 4) -> list[tuple[Candidate, list[float]]]:
        """Candidates with their scores by fold. Every rung adds folds and lets the given number of candidates with the best
        mean so far go on (None: all); those that drop out keep the scores they have. Ties go to the earlier candidate."""
        scores: list[list[float]] = [[] for _ in candidates]
        alive = list(range(len(candidates)))
        with ThreadPoolExecutor(parallelism) as pool:
            for folds, survivors in rungs:
                for k in folds:
                    for i, value in zip(alive, self._scores(pool, [candidates[i] for i in alive], k), strict=True):
                        scores[i].append(value)
                alive = sorted(alive, key=lambda i: (-float(np.mean(scores[i])), i))[:survivors]
        return list(zip(candidates, scores, strict=True))


def busiest_stations(spark: SparkSession, sf: str, months: int = 12) -> DataFrame:
    """Public stations with the trips of the newest months as weight."""
    trips = v.trips_li(spark, sf)
    recent = trips.where(F.col("started_at") >= splits.last_months_cut(trips, "started_at", months))
    weight = recent.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count(F.lit(1)).alias("trips"))
    return clean.public_stations(v.stations(spark, sf)).join(weight, "s_suppkey")


def slot_profiles(trips: DataFrame, at_least: int) -> DataFrame:
    """One row per station, one share column per hour slot; stations with few trips are left out."""
    slots = list(range(48))
    wide = trips.groupBy("start_station_id").pivot("slot", slots).count().fillna(0)
    total = sum((F.col(str(s)) for s in slots[1:]), F.col("0"))
    kept = wide.withColumn("_t", total).where(F.col("_t") >= at_least)
    return kept.select("start_station_id", *[(F.col(str(s)) / F.col("_t")).alias(f"s{s}") for s in slots])


def zones_by_rank(labelled: DataFrame) -> DataFrame:
    """Raw cluster numbers to zone numbers from busy to quiet."""
    sizes = labelled.groupBy("raw_zone").agg(F.sum("trips").alias("t"))
    ranked = sizes.withColumn("zone", (F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("t"), "raw_zone")) - 1).cast("int"))
    return labelled.join(ranked.drop("t"), "raw_zone")


