"""Supervised subword embeddings: hashed words, word pairs and character n-grams have learned vectors, a document is
the average of its vectors, and a softmax layer gives the classes. Trained by stochastic gradient descent in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidewheel.llm.frames import id_crc, narrow, text_groups

BITS = 16
DIM = 12
GRAMS = (3, 5)
#: The classifier is fitted on at most this many labelled documents, chosen by a hash of their ids.
FIT_ROWS = 2000
EPOCHS = 12
RATE = 0.5

_U = np.uint32
_POWERS = np.array([pow(0x01000193, i + 1, 1 << 32) for i in range(256)], _U)


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    """Spread 32-bit hashes; the upper bits become the feature."""
    x = (x ^ _U(salt * 0x9E3779B1 & 0xFFFFFFFF)) * _U(0x85EBCA6B)
    x ^= x >> _U(13)
    return x * _U(0xC2B2AE35)


def hashed_features(texts: list[str], bits: int = BITS, grams: tuple[int, ...] = GRAMS) -> Iterator[np.ndarray]:
    """The features of each text as numbers below 2**bits: its words, pairs of neighbouring words, and character
    n-grams on UTF-8 bytes. A pair is the exclusive or of its words, so a repeated word gives one and the same feature."""
    for text in texts:
        raw = np.frombuffer(text.encode(), np.uint8)
        found = []
        if len(raw):
            inside = raw > 0x20
            edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
            starts, ends = edges[::2], edges[1::2]
            wide = raw.astype(_U) + _U(1)
            if len(starts):
                place = np.arange(len(raw))
                place[starts[0] :] -= np.repeat(starts, np.diff(np.append(starts, len(raw))))
                weighted = wide * _POWERS[place & 255] * inside
                words = np.add.reduceat(weighted, starts, dtype=_U)
                found += [_mix(words, 1), _mix(words[1:] ^ words[:-1], 2)]
            for n in grams:
                if len(raw) >= n:
                    h = np.zeros(len(raw) - n + 1, _U)
                    for j in range(n):
                        h += wide[j : len(raw) - n + 1 + j] * _POWERS[j]
                    found.append(_mix(h, 2 + n))
        yield (np.concatenate(found) >> _U(32 - bits)) if found else np.zeros(0, _U)


@dataclass
class SubwordModel:
    """``vectors`` (features x dim), ``weights`` (dim x 2) and ``bias`` (2); a text's class probabilities are the softmax
    of its average vector times the weights plus the bias. A text without features has the bias alone."""

    vectors: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    classes: int = 2  # how many the model has seen; with fewer than two it cannot tell documents apart

    @classmethod
    def train(cls, docs: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, dim: int = DIM, epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> SubwordModel:
        """``docs``: distinct features, their counts (or, as 32-bit floats, their parts of the document), and the class (0 or
        1) of each document."""
        rng = np.random.default_rng(seed)
        model = cls(rng.uniform(-1 / dim, 1 / dim, (1 << bits, dim)).astype(np.float32), np.zeros((dim, 2), np.float32), np.zeros(2, np.float32))
        share = (sum(y for _, _, y in docs) + 1) / (len(docs) + 2)
        model.bias += np.log([1 - share, share]).astype(np.float32)
        model.classes = len({y for _, _, y in docs})
        docs = [(ids, n if n.dtype == np.float32 else (n / max(n.sum(), 1)).astype(np.float32), y) for ids, n, y in docs]
        steps, step = max(1, epochs * len(docs)), 0
        for _ in range(epochs):
            for at in rng.permutation(len(docs)):
                ids, part, y = docs[at]
                pace = rate * (1 - step / steps)
                step += 1
                rows = model.vectors[ids]
                mean = part @ rows
                logits = mean @ model.weights + model.bias
                p = np.exp(logits - logits.max())
                miss = p / p.sum()
                miss[y] -= 1
                back = model.weights @ miss
                model.weights -= pace * np.outer(mean, miss)
                model.bias -= pace * 0.1 * miss
                # a feature's step is scaled up, as each holds a small part of the average
                model.vectors[ids] = rows - (pace * 20) * part[:, None] * back[None, :]
        return model

    def margins(self) -> np.ndarray:
        """What each feature adds to the log odds of class 1, before averaging."""
        return (self.vectors @ (self.weights[:, 1] - self.weights[:, 0])).astype(np.float64)


def chosen_labels(labels: DataFrame, label_col: str, usable: Column, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids, by a hash of the id; a doc_id with several labels takes the smallest."""
    one = (
        labels.where(usable & F.col("doc_id").isNotNull() & F.col(label_col).isNotNull())
        .groupBy("doc_id")
        .agg(F.min(label_col).cast("int").alias("label"))
    )
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", usable: Column | None = None, rows: int = FIT_ROWS, bits: int = BITS) -> SubwordModel:
    """Fit on at most ``rows`` labelled documents for which ``usable`` (a condition on doc_id) holds.

    Only their distinct hashed features and the parts they hold come to the driver, at most 2**bits a document and six
    bytes each. Of rows with one doc_id the one with the smallest features counts. Without labelled documents the model says 0.5 for every text.
    """
    picked = chosen_labels(labels, label_col, F.lit(True) if usable is None else usable, rows)
    kind = "<u2" if bits <= 16 else "<u4"
    # proven bound: at most ``rows`` ids
    texts = narrow(docs).join(F.broadcast(picked), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, group in text_groups(batches):
            found = [(a, (n / max(n.sum(), 1)).astype("<f4")) for a, n in (np.unique(x, return_counts=True) for x in hashed_features(group, bits))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array([a.astype(kind).tobytes() for a, _ in found], pa.binary()), pa.array([b.tobytes() for _, b in found], pa.binary())],
                ["doc_id", "label", "ids", "n"],
            )

    features = texts.mapInArrow(run, "doc_id long, label int, ids binary, n binary")
    one = features.groupBy("doc_id").agg(F.min(F.struct("ids", "n", "label")).alias("x")).select("doc_id", "x.*").orderBy("doc_id")
    return SubwordModel.train([(np.frombuffer(r.ids, kind), np.frombuffer(r.n, "<f4"), r.label) for r in one.collect()], bits)


def score(docs: DataFrame, model: SubwordModel) -> DataFrame:
    """``doc_id`` and ``score``: the probability of class 1 for every whole text, empty ones included.

    Null texts count as empty; null and repeated doc_ids and repeated rows are kept; other columns are ignored.
    """
    return with_score(narrow(docs), model).drop("text")


def with_score(docs: DataFrame, model: SubwordModel, name: str = "score") -> DataFrame:
    """``docs`` with all its columns and the score under ``name``, which must be free."""
    margins, offset = model.margins(), float(model.bias[1] - model.bias[0])
    bits = len(margins).bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_groups(batches):
            odds = [(margins[x].mean() if len(x) else 0.0) + offset for x in hashed_features([t or "" for t in texts], bits)]
            scores = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema, StructField(name, DoubleType())]))


def held_out(column: str = "doc_id") -> Column:
    return F.coalesce(id_crc(column) % 5 == 0, F.lit(False))
