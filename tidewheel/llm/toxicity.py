"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The features are densities of a fixed lexicon and of word stems learned from labelled documents, how near such words
stand to the second person, capitals, punctuation, and disguised spellings. Trees and calibration are MLlib's, fitted
on a bounded sample; every other document only passes through one scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from tidewheel.llm.frames import ChunkTable, free_name, id_crc, narrow, text_groups
from tidewheel.llm.quality import chosen_labels
from tidewheel.session import stage

#: Trees, stems and calibration are fitted on at most this many labelled documents, chosen by a hash of their ids.
FIT_ROWS = 12_000
#: Most learned stems; a stem is the first letters of a word.
MOST_STEMS = 1000
STEM_SIZES = (4, 5)
#: A stem is learned if it stands in at least so many toxic documents, and so large a part of its documents is toxic.
STEM_DOCS, STEM_SHARE = 5, 0.8
NEAR = 6  # words to a second person

LEXICON = frozenset(
    "asshole bastard bitch bullshit clown coward crap creep cretin damn degenerate despicable dimwit disgusting dumb "
    "dumbass fool freak garbage hate hateful idiot idiotic imbecile jerk kill liar loathsome loser losers lunatic moron "
    "moronic nasty pathetic pig psycho rat repulsive scum scumbag shit shut stupid subhuman sucker trash ugly useless "
    "vermin vile weirdo worthless wretch".split()
)
SECOND = frozenset("you your yours yourself u ur ya thou thee tu te ti toi ton ta tes vous votre vos du dich dir dein deine ihr euch usted ustedes vosotros".split())
_DISGUISE = str.maketrans("013457@$!|", "oieastasii")
_INSIDE = re.compile(r"[^\W_][\W\d_]+[^\W\d_]")
_LONG = re.compile(r"([^\W\d_])\1\1")

FEATURES = (
    "lexicon", "stems", "second", "near", "any_hit", "all_capitals", "disguised", "stretched", "upper", "exclaim", "question", "marks", "digits", "log_words",
)
_HIT, _STEM, _YOU, _CAPS, _HIDDEN, _LENGTHY = 1, 2, 4, 8, 16, 32


def word_of(chunk: str) -> str:
    return chunk.strip(".,;:!?\"'()[]{}<>*#%&$|-_").casefold()


def chunk_flags(chunks: Sequence[str], stems: frozenset[str]) -> list[int]:
    out = []
    for chunk in chunks:
        word = word_of(chunk)
        plain = word.translate(_DISGUISE)
        flags = 0
        if word in LEXICON:
            flags |= _HIT
        elif plain in LEXICON or re.sub(r"[\W_]", "", plain) in LEXICON:
            flags |= _HIT | _HIDDEN
        if any(word[:n] in stems for n in STEM_SIZES if len(word) >= n):
            flags |= _STEM
        if word in SECOND:
            flags |= _YOU
        if len(word) > 1 and chunk.isupper():
            flags |= _CAPS
        if _INSIDE.search(word):
            flags |= _HIDDEN
        if _LONG.search(word):
            flags |= _LENGTHY
        out.append(flags)
    return out


def text_features(text: str, flags: np.ndarray) -> list[float]:
    """The dense features of one text, given the flags of its white-space separated chunks; all in 0 .. 1 but the last."""
    words, size = max(1, len(flags)), max(1, len(text))
    hits = np.flatnonzero(flags & (_HIT | _STEM))
    you = np.flatnonzero(flags & _YOU)
    near = 0
    if len(hits) and len(you):
        at = np.searchsorted(you, hits)
        left = np.abs(hits - you[np.maximum(at - 1, 0)])
        right = np.abs(you[np.minimum(at, len(you) - 1)] - hits)
        near = int((np.minimum(left, right) <= NEAR).sum())
    raw = np.frombuffer(text.encode(), np.uint8)
    counts = np.bincount(raw, minlength=128)
    upper, digits = counts[65:91].sum(), counts[48:58].sum()
    marks = counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()

    def share(flag: int) -> float:
        return float(np.count_nonzero(flags & flag)) / words

    return [
        share(_HIT), share(_STEM), share(_YOU), near / words, float(len(hits) > 0), share(_CAPS), share(_HIDDEN), share(_LENGTHY),
        float(upper) / size, float(counts[33]) / size, float(counts[63]) / size, float(marks) / size, float(digits) / size, float(np.log1p(len(flags))),
    ]


def with_features(docs: DataFrame, stems: Sequence[str], name: str = "features") -> DataFrame:
    """``docs`` with all its columns and, under ``name``, an array of doubles in the order of FEATURES."""
    known = frozenset(stems)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(lambda chunks: chunk_flags(chunks, known))
        for batch, texts in text_groups(batches):
            texts = [t or "" for t in texts]
            split = [t.split() for t in texts]
            flags = table.lookup(split).__getitem__
            rows = [text_features(t, np.fromiter(map(flags, chunks), np.int64, len(chunks))) for t, chunks in zip(texts, split, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, pa.list_(pa.float64()))], [*batch.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema, StructField(name, ArrayType(DoubleType()))]))


def learned_stems(sample: DataFrame) -> list[str]:
    """Word stems of (``text``, ``label``) rows that stand almost only in toxic documents; at most MOST_STEMS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_groups(batches):
            rows = [sorted({w[:n] for w in map(word_of, set(t.split())) for n in STEM_SIZES if len(w) >= n and w[:n].isalpha()}) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(rows, pa.list_(pa.string()))], ["label", "stems"])

    stems = sample.select("text", "label").mapInArrow(run, "label int, stems array<string>").select("label", F.explode("stems").alias("stem"))
    seen = stems.groupBy("stem").agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("n"))
    best = seen.where((F.col("toxic") >= STEM_DOCS) & (F.col("toxic") >= STEM_SHARE * F.col("n")))
    return [r.stem for r in best.orderBy(F.desc("toxic"), "stem").limit(MOST_STEMS).collect()]


@dataclass
class ToxicityModel:
    stems: list[str]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    base_rate: float


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", usable: Column | None = None, rows: int = FIT_ROWS) -> ToxicityModel:
    """Fit on at most ``rows`` labelled documents for which ``usable`` (a condition on doc_id) holds.

    Stems and trees come from three quarters of them, the calibration from the rest. Of rows with one doc_id the
    smallest text counts. Where a part lacks one of the two classes, the model is the share of toxic documents.
    """
    picked = chosen_labels(labels, label_col, F.lit(True) if usable is None else usable, rows)
    found = narrow(docs).join(F.broadcast(picked), "doc_id")  # proven bound: at most ``rows`` ids
    one = found.groupBy("doc_id").agg(F.min(F.struct("text", "label")).alias("x")).select("doc_id", "x.*")
    sample = stage(one.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(4))), "toxicity-sample")
    seen = {(r.part, r.label): r.n for r in sample.groupBy((F.col("fold") == 0).alias("part"), "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    base = (sum(n for (_, y), n in seen.items() if y) + 1) / (sum(seen.values()) + 2)
    if len(seen) < 4:
        return ToxicityModel([], None, None, base)
    stems = learned_stems(sample.where("fold != 0"))
    dense = with_features(sample, stems).select("fold", F.col("label").cast("double").alias("label"), array_to_vector("features").alias("vector"))
    dense = dense.coalesce(4).persist()  # bounded: one short vector for each of ``rows`` documents
    trees = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=15, maxDepth=3, stepSize=0.3, seed=7).fit(dense.where("fold != 0"))
    held = trees.transform(dense.where("fold = 0")).select("label", vector_to_array("probability")[1].alias("chance"))
    calibration = IsotonicRegression(featuresCol="chance", labelCol="label", predictionCol="score").fit(held)
    dense.unpersist()
    return ToxicityModel(stems, trees, calibration, base)


def with_score(docs: DataFrame, model: ToxicityModel, name: str = "score") -> DataFrame:
    """``docs`` with all its columns and, under ``name`` (which must be free), the calibrated chance of being toxic."""
    if model.trees is None:
        return docs.withColumn(name, F.lit(model.base_rate))
    features, vector, chance, raw, kind, p, found = (free_name(docs, x) for x in ("_features", "_vector", "_chance", "_raw", "_class", "_p", "_found"))
    dense = with_features(docs, model.stems, features).withColumn(vector, array_to_vector(features))
    trees = model.trees.copy().setFeaturesCol(vector).setProbabilityCol(chance).setRawPredictionCol(raw).setPredictionCol(kind)
    judged = trees.transform(dense).withColumn(p, vector_to_array(chance)[1])
    out = model.calibration.copy().setFeaturesCol(p).setPredictionCol(found).transform(judged)
    return out.select(*docs.columns, F.least(F.greatest(F.col(found), F.lit(0.0)), F.lit(1.0)).alias(name))


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id`` and ``score`` of every whole text, empty ones included.

    Null texts count as empty; null and repeated doc_ids and repeated rows are kept; other columns are ignored.
    """
    return with_score(narrow(docs), model).select("doc_id", "score")


def held_out(column: str = "doc_id") -> Column:
    return F.coalesce(id_crc(column) % 4 == 2, F.lit(False))
