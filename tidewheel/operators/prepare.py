"""Baselines and feature preparation fitted on the training part only."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.operators.order import exact_quantiles, running_totals
from tidewheel.session import shuffle_partitions


def group_means(train: DataFrame, keys: Sequence[str], y: str) -> tuple[DataFrame, Column]:
    """Mean per key set, and the global mean as a scalar."""
    means = train.groupBy(*keys).agg(F.avg(y).alias("group_mean"))
    return means, train.select(F.avg(y).alias("m")).scalar()


def recent(train: DataFrame, ts: str, months: int) -> DataFrame:
    """Only the last calendar months of the training part."""
    number = F.year(ts) * 12 + F.month(ts)
    newest = train.select(F.max(number).alias("m")).scalar()
    return train.where(number > newest - months)


def predict_group_mean(rows: DataFrame, means: DataFrame, overall: Column, keys: Sequence[str], name: str = "pred") -> DataFrame:
    return rows.join(means, list(keys), "left").withColumn(name, F.coalesce("group_mean", overall)).drop("group_mean")


def most_frequent(df: DataFrame, column: str) -> DataFrame:
    """One row with the commonest value; the smaller value wins a tie."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.min_by(column, F.struct(-F.col("n"), F.col(column))).alias(column))


def median(df: DataFrame, column: str) -> DataFrame:
    return exact_quantiles(df, [], column, {column: 0.5}).select(column)


def fill_values(train: DataFrame, medians: Sequence[str] = (), means: Sequence[str] = (), modes: Sequence[str] = ()) -> Mapping[str, Column]:
    """Scalars learned on the training part, one per column."""
    out = {c: median(train, c).scalar() for c in medians}
    out |= {c: train.select(F.avg(c).alias(c)).scalar() for c in means}
    return out | {c: most_frequent(train, c).scalar() for c in modes}


def impute(rows: DataFrame, fills: Mapping[str, Column], indicator: bool = True) -> DataFrame:
    flags = {f"{c}_missing": F.col(c).isNull().cast("int") for c in fills} if indicator else {}
    return rows.withColumns(flags).withColumns({c: F.coalesce(F.col(c), value) for c, value in fills.items()})


def categories(train: DataFrame, column: str, min_count: int = 5) -> DataFrame:
    """Known categories with an ordinal number and a one-hot slot; rare ones share the last slot. The
    distinct categories are numbered by distributed running counts, however many there are."""
    counts = train.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    rare = F.col("n") < min_count
    ranked = running_totals(counts, [], [column], {"any": F.lit(1), "common": (~rare).cast("int")})
    slot = F.when(rare, F.col("common_total")).otherwise(F.col("common_before"))
    return ranked.select(column, F.col("any_before").cast("int").alias("ordinal"), slot.cast("int").alias("slot"))


def encode(rows: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """Unknown categories get ordinal -1 and no slot."""
    return rows.join(table, column, "left").withColumn("ordinal", F.coalesce("ordinal", F.lit(-1)))


def balanced_weights(train: DataFrame, label: str) -> DataFrame:
    """n / (classes * n_class) per class."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(F.lit(1))
    return counts.withColumn("weight", F.sum("n").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("n")))


def with_balanced_weights(rows: DataFrame, train: DataFrame, label: str) -> DataFrame:
    """``rows`` whose label occurs in ``train`` with the ``weight`` of their class. There is a row per class, which goes to
    every task; shuffled by label, all rows of a class would be in one."""
    return rows.join(F.broadcast(balanced_weights(train, label).select(label, "weight")), label)


def scale(rows: DataFrame, train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population deviation, both from one pass over the training part."""
    moments = train.agg(F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns]).alias("v")).scalar()
    return rows.withColumns({f"{c}_scaled": (F.col(c) - moments[c]["m"]) / moments[c]["s"] for c in columns})


def soft_vote(rows: DataFrame, weights: Mapping[str, float], name: str = "p_vote") -> DataFrame:
    total = None
    for column, w in weights.items():
        part = F.col(column) * F.lit(w)
        total = part if total is None else total + part
    return rows.withColumn(name, total)


def suspicious(score: Column, y: Column, cut: float) -> Column:
    """The label strongly contradicts an out-of-fold score."""
    return ((y == 1) & (score < cut)) | ((y == 0) & (score > 1 - cut))


def blend_sweep(rows: DataFrame, scores: Sequence[str], y: str, units: int = 20) -> DataFrame:
    """Every weight triple in steps of 1/units with counts and rates for each threshold of the grid.

    A task keeps one table of counts (triple x hundredth x class), to which batches of rows are added; rows are never
    repeated. One row per task and triple is shuffled, and those of a triple are added as they pass. A row without one of
    the scores lies below every threshold; a row without a label is not counted.
    """
    from tidewheel.operators.metrics import GRID, add_rates, hundredths

    triples = np.array([(i, j, units - i - j) for i in range(units + 1) for j in range(units + 1 - i)])
    n_bins = GRID[1] - GRID[0] + 2  # the first one is below the grid

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = triples / float(units)
        table, seen = np.zeros((2, len(triples) * n_bins), np.int64), False
        for batch in batches:
            for at in range(0, len(batch), 2048):
                piece = batch.slice(at, 2048)
                a, b, c, label = (piece.column(i).to_numpy(zero_copy_only=False) for i in range(4))
                blended = w[:, :1] * a + w[:, 1:2] * b + w[:, 2:] * c
                bins = np.clip(hundredths(blended), GRID[0] - 1, GRID[1]) - (GRID[0] - 1)
                bins += (np.arange(len(triples)) * n_bins)[:, None]
                for value in (0, 1):
                    table[value] += np.bincount(bins[:, label == value].ravel(), minlength=table.shape[1])
                seen = True
        if seen:
            each = list(table.reshape(2, len(triples), n_bins).transpose(1, 0, 2).reshape(len(triples), -1))
            yield pa.RecordBatch.from_arrays([pa.array(range(len(triples)), pa.int32()), pa.array(each, pa.list_(pa.int64()))], ["t", "counts"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            lists = batch.column("counts").flatten().to_numpy().reshape(len(batch), 2, n_bins)
            for t, counts in zip(batch.column("t").to_pylist(), lists, strict=True):
                found[t] = found[t] + counts if t in found else counts
        grid = np.arange(GRID[0], GRID[1] + 1)
        for t, counts in found.items():
            above = counts[:, ::-1].cumsum(axis=1)[:, ::-1][:, 1:]  # at or above each threshold
            (fp, tp), (negatives, positives) = above, counts.sum(axis=1)
            weights = [pa.array([int(x)] * len(grid), pa.int32()) for x in triples[t]]
            yield pa.RecordBatch.from_arrays([*weights, *map(pa.array, (grid / 100.0, negatives - fp, fp, positives - tp, tp))], ["wa", "wb", "wc", "threshold", "tn", "fp", "fn", "tp"])

    narrow = rows.select(*[F.col(c).cast("double") for c in scores], F.col(y).cast("long").alias("_y")).where("_y is not null")
    # four numbers a row are dealt out evenly, as each row costs a few hundred blends
    counted = narrow.repartition(shuffle_partitions(rows.sparkSession)).mapInArrow(count, "t int, counts array<long>")
    summed = counted.repartition("t").mapInArrow(add_up, "wa int, wb int, wc int, threshold double, tn long, fp long, fn long, tp long")
    return add_rates(summed)
