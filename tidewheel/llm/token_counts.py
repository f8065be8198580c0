"""Exact length histogram of encoded documents, and the suffix sums that answer questions on every context limit."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.frames import narrow, text_groups
from tidewheel.llm.tokens import word_tokens
from tidewheel.operators.order import running_totals


def token_lengths(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``n_tokens`` (without special ids) of each document; a null or empty text has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(path)
        for batch, texts in text_groups(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(x) for x in tokens.ids(texts)], pa.int64())], ["doc_id", "n_tokens"])
        tokens.clear()

    return narrow(docs).mapInArrow(run, "doc_id long, n_tokens long")


def length_histogram(lengths: DataFrame, length_col: str = "n_tokens") -> DataFrame:
    """One row per distinct length, with sums over shorter and longer documents.

    ``n_docs`` documents have ``length`` ids. ``docs_longer`` and ``tokens_longer`` sum over documents above that
    length, ``docs_upto`` and ``tokens_upto`` over the others. ``truncated_tokens`` is what remains of all documents
    if each is cut at ``length``: tokens_upto + length * docs_longer. ``share_upto`` is docs_upto over all documents;
    the quantile q is the smallest length whose share is at least q. Null lengths are not counted; no rows give no
    rows. Documents are counted before lengths are ordered, so ties and hot lengths cost one row.
    """
    cells = (
        lengths.where(F.col(length_col).isNotNull())
        .groupBy(F.col(length_col).cast("long").alias("length"))
        .agg(F.count(F.lit(1)).alias("n_docs"))
    )
    sums = running_totals(cells, [], ["length"], {"d": "n_docs", "t": F.col("n_docs") * F.col("length")})
    upto = F.col("d_before") + F.col("n_docs")
    tokens = F.col("t_before") + F.col("n_docs") * F.col("length")
    return sums.select(
        "length",
        "n_docs",
        upto.alias("docs_upto"),
        tokens.alias("tokens_upto"),
        (F.col("d_total") - upto).alias("docs_longer"),
        (F.col("t_total") - tokens).alias("tokens_longer"),
        (tokens + F.col("length") * (F.col("d_total") - upto)).alias("truncated_tokens"),
        (upto / F.col("d_total")).alias("share_upto"),
    )


def at_limits(histogram: DataFrame, limits: Sequence[int]) -> DataFrame:
    """For any context limits, also ones that no document has: documents that fit, documents cut, and the ids that
    remain if each document is cut at the limit. The histogram is read once; limits are a short literal list."""
    n, at = F.col("n_docs"), F.col("length")
    rows = histogram.select("n_docs", "length", F.explode(F.array(*[F.lit(int(x)) for x in limits]).cast("array<long>")).alias("context"))
    return rows.groupBy("context").agg(
        F.sum(F.when(at <= F.col("context"), n).otherwise(0)).alias("docs_fit"),
        F.sum(F.when(at > F.col("context"), n).otherwise(0)).alias("docs_cut"),
        F.sum(F.least(at, F.col("context")) * n).alias("truncated_tokens"),
    )


def quantiles(histogram: DataFrame, shares: Sequence[float]) -> DataFrame:
    """The smallest length that at least the given share of the documents does not exceed."""
    rows = histogram.select("length", "share_upto", F.explode(F.array(*[F.lit(float(x)) for x in shares])).alias("share"))
    return rows.where(F.col("share_upto") >= F.col("share")).groupBy("share").agg(F.min("length").alias("length"))
