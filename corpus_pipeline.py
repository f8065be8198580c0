"""From raw documents to packed training sequences: five stages, each one operator of ``tidewheel.llm``.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before it kept, and returns a DataFrame that is
written and read again as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm import hamming, packing, quality, suffixes, toxicity
from tidewheel.llm.book import CUT, WORDS
from tidewheel.llm.frames import free_name, table, text_digest
from tidewheel.session import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose calibrated chance of being toxic is CUT or more; null and empty texts are scored as well.
    Where the labels lack a class, no document goes."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic", ~toxicity.held_out())
    if model.trees is None:
        return docs
    score = free_name(docs, "score")
    return toxicity.with_score(docs, model, score).where(F.col(score) < CUT).drop(score)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose chance of being of good quality is below CUT. Where the labels lack a class, none goes."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "quality", ~quality.held_out())
    if model.classes < 2:
        return docs
    score = free_name(docs, "score")
    return quality.with_score(docs, model, score).where(F.col(score) >= CUT).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8): the one with the smallest id,
    a null id after all others, and of texts under that id the one with the smallest digest.

    Documents without words are in no group and stay. Of rows of a group that share a doc_id and a text one stays, whichever way they were read. Rows
    are told apart by doc_id and text, so what is decided for one row says nothing about others under its id.
    """
    key = free_name(docs, "_digest")
    rows = hamming.near_duplicates(docs).where("n_shingles > 0").groupBy("doc_id", "digest")
    decided = rows.agg(F.first("first").alias("_first"), F.count(F.lit(1)).alias("_rows")).where("not _first or _rows > 1")
    decided = stage(decided.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_text"), "_first"), "near-decisions")
    marked = docs.withColumn(key, text_digest("text"))

    def same(rows: DataFrame) -> Column:
        return marked["doc_id"].eqNullSafe(rows["_id"]) & (marked[key] == rows["_text"])

    once = marked.join(decided, same(decided), "left_anti")
    # of rows that differ in other columns only, the one with the smallest hash of all columns; a table of their own, mostly
    # small, spares all texts a second shuffle
    several = stage(decided.where("_first"), "near-repeated-rows")
    again = marked.join(several, same(several), "left_semi").groupBy(F.col("doc_id").alias("_id"), F.col(key).alias("_text"))
    again = again.agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("_row")).select("_row.*")
    return once.drop(key).unionByName(again)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without strings of 200 bytes that stand anywhere else as well. A document of which nothing is left goes."""
    removed = free_name(docs, "n_removed")
    some = F.coalesce(F.char_length("text") > 0, F.lit(True)) | (F.col(removed) == 0)
    return suffixes.without_repeats(docs, removed_col=removed).where(some).drop(removed).withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long"))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of at most 4096 ids."""
    return packing.pack(docs, WORDS, digest=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("packing", pack_sequences),
]

#: Trained classifiers and tokenizers are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
