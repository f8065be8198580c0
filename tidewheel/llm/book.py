"""The registered queries of this subpackage and their SQL twins, where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm import fingerprints, hamming, licenses, packing, pieces, pivots, quality, repair, suffixes, token_counts, toxicity, trie, twins, two_fit
from tidewheel.llm.frames import table

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

QUERIES = {}
ORACLES: dict[str, str] = {"op12_auction_repair": twins.AUCTION_REPAIR, "op13_centroid_trie": twins.CENTROID_TRIE}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


#: A score from here on is class 1.
CUT = 0.3


def judged(scores: DataFrame, held_out: Column) -> DataFrame:
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


@query
def op1_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), WORDS, digest=True)


@query
def op2_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "quality", ~quality.held_out())
    return judged(quality.score(docs, model), quality.held_out())


@query
def op3_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.length_histogram(token_counts.token_lengths(table(spark, sf_dir, "documents"), WORDS))


@query
def op4_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_edits(table(spark, sf_dir, "documents"))


@query
def op5_boosted_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic", ~toxicity.held_out())
    return judged(toxicity.score(docs, model), toxicity.held_out())


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents")))


@query
def op7_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op8_hamming_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85).drop("digest", "first")


@query
def op9_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(table(spark, sf_dir, "documents"), 200)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: x - n)  # last end - last start + ... of an even list
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        (F.size("spans") / 2).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op10_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode(table(spark, sf_dir, "documents"), PIECES)
    return pieces.decode(encoded, PIECES).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(pieces.ids_text().cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op11_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return two_fit.pack(table(spark, sf_dir, "documents"), WORDS, digest=True)


@query
def op12_auction_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damaged(table(spark, sf_dir, "conversations")))


@query
def op13_centroid_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))
