"""Poisson regression with fixed effects, fitted by MLlib, and cluster-robust standard errors."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.session import shuffle_partitions, stage

Z95 = 1.959963984540054


@dataclass
class Fit:
    """A fitted model, its rows with features and mean ``mu``, and the position of every numeric column."""

    model: object
    rows: DataFrame
    at: Mapping[str, int]
    label: str


def fit(df: DataFrame, label: str, categories: Sequence[str], numbers: Sequence[str]) -> Fit:
    """Log-link Poisson regression; every category is a set of dummies with one level left out. Numeric
    columns come first in the feature vector. The rows are staged first: the fit passes over them several
    times and must not evaluate the plan behind them again."""
    df = stage(df, "glm")
    stages = []
    if categories:
        stages.append(StringIndexer(inputCols=list(categories), outputCols=[f"_i_{c}" for c in categories], stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=[f"_i_{c}" for c in categories], outputCols=[f"_o_{c}" for c in categories]))
    stages.append(VectorAssembler(inputCols=[*numbers, *[f"_o_{c}" for c in categories]], outputCol="features"))
    prepared = Pipeline(stages=stages).fit(df).transform(df).persist()
    learner = GeneralizedLinearRegression(family="poisson", link="log", labelCol=label, featuresCol="features", predictionCol="mu", maxIter=50)
    model = learner.fit(prepared)
    prepared.unpersist()
    return Fit(model, model.transform(prepared), {c: i for i, c in enumerate(numbers)}, label)


def effects(fitted: Fit, names: Sequence[str]) -> DataFrame:
    """Coefficient and factor exp(coefficient) with the model's own standard errors."""
    errors = fitted.model.summary.coefficientStandardErrors
    rows = [(n, float(fitted.model.coefficients[fitted.at[n]]), float(errors[fitted.at[n]])) for n in names]
    out = fitted.rows.sparkSession.createDataFrame(rows, "term string, coefficient double, std_error double")
    return _with_interval(out)


def _with_interval(out: DataFrame) -> DataFrame:
    b, s = F.col("coefficient"), F.col("std_error")
    return out.withColumns({"factor": F.exp(b), "factor_low": F.exp(b - Z95 * s), "factor_high": F.exp(b + Z95 * s)})


def robust_effects(fitted: Fit, names: Sequence[str], cluster: str) -> DataFrame:
    """Coefficients with sandwich standard errors clustered by a column.

    The information matrix is summed from the few non-zero entries of each row. With its solution ``a``
    for one coefficient, the variance is the sum over clusters of the squared sum of ``a . x * residual``,
    so no matrix of cluster scores is built.
    """
    spark = fitted.rows.sparkSession
    base = fitted.rows.select(
        F.col(cluster).alias("_c"), F.concat(vector_to_array("features"), F.array(F.lit(1.0))).alias("x"), F.col("mu"),
        (F.col(fitted.label) - F.col("mu")).alias("r"),
    )
    filled = base.withColumn("nz", F.filter(F.transform("x", lambda v, i: F.struct(i.alias("i"), v.alias("v"))), lambda e: e["v"] != 0))
    pairs = filled.select("mu", "nz", F.explode("nz").alias("p")).select("mu", "p", F.explode("nz").alias("q"))
    info = pairs.groupBy(F.col("p.i").alias("i"), F.col("q.i").alias("j")).agg(F.sum(F.col("mu") * F.col("p.v") * F.col("q.v")).alias("w"))
    size = fitted.model.numFeatures + 1
    matrix = np.zeros((size, size))
    for i, j, w in info.collect():  # (features + 1) squared at most
        matrix[i, j] = w
    counts = base.agg(F.count(F.lit(1)), F.countDistinct("_c")).first()
    n, g = counts[0], counts[1]
    correction = g / (g - 1) * (n - 1) / (n - size)
    rows = []
    for name in names:
        unit = np.zeros(size)
        unit[fitted.at[name]] = 1.0
        a = np.linalg.lstsq(matrix, unit, rcond=None)[0]
        weights = F.array(*[F.lit(float(w)) for w in a])
        dot = F.aggregate(F.zip_with("x", weights, lambda u, w: u * w), F.lit(0.0), lambda s, e: s + e)
        per_cluster = base.groupBy("_c").agg(F.sum(dot * F.col("r")).alias("s"))
        meat = per_cluster.agg(F.sum(F.col("s") * F.col("s"))).first()[0]
        rows.append((name, float(fitted.model.coefficients[fitted.at[name]]), float(np.sqrt(meat * correction)), int(g)))
    out = spark.createDataFrame(rows, "term string, coefficient double, std_error double, clusters long")
    return _with_interval(out)


@dataclass
class Absorbed:
    """A Poisson fit with one free level per group: coefficients, their variances from the model and clustered by group,
    and the number of groups."""

    terms: Sequence[str]
    coefficients: np.ndarray
    variance: np.ndarray
    clustered: np.ndarray
    groups: int


def _log_sums(x: np.ndarray, y: np.ndarray, b: np.ndarray) -> tuple:
    """What a group's rows add to its sums: rows, counts, counts times x, and the sums of e, e x and e x x' with
    e = exp(x b - top)."""
    e = x @ b
    top = e.max()
    e = np.exp(e - top)
    ex = e[:, None] * x
    return len(y), y.sum(), y @ x, top, e.sum(), ex.sum(axis=0), ex.T @ x


def _joined(one: tuple | None, other: tuple) -> tuple:
    """The sums of two parts of a group, on the larger ``top`` of both."""
    if one is None:
        return other
    top = max(one[3], other[3])
    f, g = np.exp(one[3] - top), np.exp(other[3] - top)
    return one[0] + other[0], one[1] + other[1], one[2] + other[2], top, *(f * u + g * v for u, v in zip(one[4:], other[4:], strict=True))


def _share(sums: tuple) -> tuple:
    """A whole group's share of rows, groups, score, information and sums of squared group scores: its level makes its
    means add up to its counts."""
    n, total, yx, _, s0, s1, s2 = sums
    score = yx - total * s1 / s0
    info = total / s0 * s2 - total * np.outer(s1 / s0, s1 / s0)
    return n, 1, score, info, np.outer(score, score)


def _newton_sums(batches: Iterator[pa.RecordBatch], b: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The shares of the groups of one range of rows sorted by group: whole groups are added up; the first and the last may
    go on in other ranges and are sent as sums. No group's rows are held beyond a batch."""
    size = len(b)
    whole = [0, 0, np.zeros(size), np.zeros((size, size)), np.zeros((size, size))]
    edges: list[tuple[object, tuple]] = []
    now, held = None, None

    def close() -> None:
        if not edges:
            edges.append((now, held))
        else:
            for k, part in enumerate(_share(held)):
                whole[k] = whole[k] + part

    for batch in batches:
        for at in range(0, len(batch), 4096):
            piece = batch.slice(at, 4096)
            names = piece.column("g").to_pylist()
            y = piece.column("y").to_numpy()
            x = piece.column("x").flatten().to_numpy().reshape(len(y), size)
            cuts = [0, *(k for k in range(1, len(names)) if names[k] != names[k - 1]), len(names)]
            for low, high in zip(cuts, cuts[1:], strict=False):
                if held is not None and names[low] != now:
                    close()
                    held = None
                now, held = names[low], _joined(held, _log_sums(x[low:high], y[low:high], b))
    if held is not None:
        edges.append((now, held))
    rows = [(None, whole[0], whole[1], 0.0, 0.0, 0.0, whole[2], None, whole[3].ravel(), whole[4].ravel())]
    rows += [(str(g), h[0], 0, float(h[1]), float(h[3]), float(h[4]), h[2], h[5], h[6].ravel(), None) for g, h in edges]
    yield _sum_rows(rows)


_SUMS = "g string, n long, groups long, total double, top double, s0 double, score array<double>, s1 array<double>, info array<double>, meat array<double>"


def _sum_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "double": pa.float64(), "array<double>": pa.list_(pa.float64())}
    fields = [f.split() for f in _SUMS.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def _merge_sums(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """One row for all rows of a task: whole groups' shares are added, parts of groups joined first. Rows come with all parts
    of a group in one task, a part with no group's name is a share already."""
    parts: dict[str, tuple] = {}
    whole = [0, 0, np.zeros(size), np.zeros((size, size)), np.zeros((size, size))]

    def add(share: tuple) -> None:
        for k, part in enumerate(share):
            whole[k] = whole[k] + part

    for batch in batches:
        for r in batch.to_pylist():
            vector, matrix = np.array(r["score"]), np.array(r["info"]).reshape(size, size)
            if r["g"] is None:
                add((r["n"], r["groups"], vector, matrix, np.array(r["meat"]).reshape(size, size)))
            else:
                parts[r["g"]] = _joined(parts.get(r["g"]), (r["n"], r["total"], vector, r["top"], r["s0"], np.array(r["s1"]), matrix))
    for sums in parts.values():
        add(_share(sums))
    yield _sum_rows([(None, whole[0], whole[1], 0.0, 0.0, 0.0, whole[2], None, whole[3].ravel(), whole[4].ravel())])


def fit_absorbed(df: DataFrame, label: str, categories: Sequence[str], numbers: Sequence[str], group: str, rounds: int = 50) -> Absorbed:
    """Log-link Poisson regression with an effect for every value of ``group`` that never becomes a column.

    Given the other coefficients, a group's best level makes its means add up to its counts, which leaves a likelihood
    of the other coefficients alone. Newton steps on it sum, per group, a vector and a small matrix. Rows are sorted by
    group over range partitions once and stay there for all steps; a step sends one row per partition and two parts of
    groups, which are added up in a tree. A group of any size is cut by the ranges. A null group counts as one. Raises
    ArithmeticError if ``rounds`` steps do not converge. An empty table has no groups and no coefficients.
    """
    df = stage(df.select(*dict.fromkeys([*categories, *numbers, group, label])), "glm")
    if df.isEmpty():
        return Absorbed(list(numbers), np.zeros(0), np.zeros((0, 0)), np.zeros((0, 0)), 0)
    stages = []
    if categories:
        stages.append(StringIndexer(inputCols=list(categories), outputCols=[f"_i_{c}" for c in categories], stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=[f"_i_{c}" for c in categories], outputCols=[f"_o_{c}" for c in categories]))
    stages.append(VectorAssembler(inputCols=[*numbers, *[f"_o_{c}" for c in categories]], outputCol="features"))
    rows = Pipeline(stages=stages).fit(df).transform(df)
    rows = rows.select(F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("none")).alias("g"), F.col(label).cast("double").alias("y"), vector_to_array("features").alias("x"))
    rows = stage(rows, "absorbed")
    size = len(rows.select("x").first()["x"])
    # the staged table is what a lost executor's ranges are made of again
    pinned = rows.withColumn("_r", F.monotonically_increasing_id()).repartitionByRange("g", "_r").sortWithinPartitions("g", "_r").drop("_r").persist(StorageLevel.MEMORY_AND_DISK)

    def sums(b: np.ndarray):
        found = pinned.mapInArrow(lambda batches: _newton_sums(batches, b), _SUMS)
        lot = F.pmod(F.when(F.col("g").isNull(), F.monotonically_increasing_id()).otherwise(F.xxhash64("g")), F.lit(fan))
        merged = found.withColumn("_lot", lot).repartition(fan, "_lot").drop("_lot").mapInArrow(lambda batches: _merge_sums(batches, size), _SUMS)
        parts = merged.collect()  # at most as many as the square root of the partitions
        total = [np.sum([np.array(r[k]) for r in parts], axis=0) for k in ("score", "info", "meat")]
        return sum(r["n"] for r in parts), sum(r["groups"] for r in parts), total[0], total[1].reshape(size, size), total[2].reshape(size, size)

    fan = max(1, int(shuffle_partitions(df.sparkSession) ** 0.5))
    b = np.zeros(size)
    try:
        for _ in range(rounds):
            n, groups, score, info, meat = sums(b)
            step = np.linalg.lstsq(info, score, rcond=None)[0]
            if np.abs(step).max(initial=0.0) < 1e-9:
                break
            b = b + step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        else:
            raise ArithmeticError(f"the fit has not converged after {rounds} steps; the last one was {np.abs(step).max():.3g}")
    finally:
        pinned.unpersist()
    inverse = np.linalg.pinv(info)
    correction = groups / max(groups - 1, 1) * (n - 1) / max(n - size - groups, 1)
    return Absorbed(list(numbers), b, inverse, inverse @ meat @ inverse * correction, groups)


def absorbed_effects(spark: SparkSession, fitted: Absorbed, names: Sequence[str], clustered: bool) -> DataFrame:
    """Coefficients and factors with the model's own standard errors, or with errors clustered by the absorbed group."""
    variance = fitted.clustered if clustered else fitted.variance
    rows = []
    for name in names if fitted.groups else ():
        k = list(fitted.terms).index(name)
        rows.append((name, float(fitted.coefficients[k]), float(np.sqrt(variance[k, k])), *([int(fitted.groups)] if clustered else [])))
    return _with_interval(spark.createDataFrame(rows, "term string, coefficient double, std_error double" + (", clusters long" if clustered else "")))


def spline(df: DataFrame, column: str, terms: int, fitted_on: DataFrame | None = None) -> DataFrame:
    """Cubic spline columns ``<column>_b1..`` on evenly spaced knots: x, x^2, x^3 and one cubed hinge per
    inner knot, on the column scaled so that ``fitted_on`` (the training rows; default: all) fills [0, 1]."""
    ends = (df if fitted_on is None else fitted_on).select(F.struct(F.min(column).alias("low"), F.max(column).alias("high")).alias("e")).scalar()
    x = (F.col(column) - ends["low"]) / F.greatest(ends["high"] - ends["low"], F.lit(1e-9))
    out = {f"{column}_b1": x, f"{column}_b2": x * x, f"{column}_b3": x * x * x}
    inner = terms - 3
    for k in range(1, inner + 1):
        hinge = F.greatest(F.lit(0.0), x - k / (inner + 1))
        out[f"{column}_b{3 + k}"] = hinge * hinge * hinge
    return df.withColumns(out)


def deviance_table(spark: SparkSession, fits: Mapping[str, Fit]) -> DataFrame:
    rows = []
    for name, fitted in fits.items():
        s = fitted.model.summary
        rows.append((name, float(s.deviance), float(s.nullDeviance), 1 - float(s.deviance) / float(s.nullDeviance)))
    return spark.createDataFrame(rows, "model string, deviance double, null_deviance double, explained double")
