"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are handled in groups of about this many characters, whatever the size of an Arrow batch.
GROUP_CHARS = 1 << 21


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Most bytes that a batch of rows takes to Python where the session keeps Spark's default; a longer row comes alone.
BATCH_BYTES = 8 << 20
_BATCH, _DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def bounded_batches(spark: SparkSession) -> None:
    """Batches of rows for Python are bounded by bytes, not by rows alone, as texts may be long."""
    if spark.conf.get(_BATCH, _DEFAULT) == _DEFAULT:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def narrow(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the whole text (null: empty), whatever else ``docs`` holds."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores in front if ``df`` has such a column in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_digest(column: str = "text") -> Column:
    """128 bits that tell texts apart; a null text counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(column), F.lit("")).cast("binary")))


def id_crc(column: str = "doc_id") -> Column:
    """crc32 of the id written as text; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def crc(data: bytes) -> int:
    return zlib.crc32(data)


def text_groups(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with their texts, each of about GROUP_CHARS characters (a longer text comes alone)."""
    for batch in batches:
        values = batch.column(column).to_pylist()
        start = held = 0
        for i, text in enumerate(values):
            size = len(text or "")
            if held and held + size > GROUP_CHARS:
                yield batch.slice(start, i - start), values[start:i]
                start, held = i, 0
            held += size
        if start < len(values):
            yield batch.slice(start), values[start:]


class ChunkTable:
    """What has been worked out for each distinct chunk: every chunk is worked out once while the table lives.

    ``work`` takes a list of distinct chunks and returns their results in that order. The table starts anew when
    it holds more than ``limit`` chunks, which bounds its memory and changes no result.
    """

    def __init__(self, work, limit: int = 150_000):
        self.work, self.limit, self.known = work, limit, {}

    def lookup(self, chunks_by_text: list[list]) -> dict:
        """A table that holds every chunk of the given texts."""
        wanted = set()
        for chunks in chunks_by_text:
            wanted.update(chunks)
        if len(self.known) + len(wanted) > self.limit:
            self.known = {}
        new = [c for c in wanted if c not in self.known]
        if new:
            self.known.update(zip(new, self.work(new), strict=True))
        return self.known


class ChunkIds:
    """The ids of each distinct chunk: ``encode`` takes distinct chunks and returns all their ids in one array, and how
    many each has. The table starts anew when it holds more than ``limit`` chunks, as ChunkTable does."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = 600_000):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        # a chunk that is looked up for the first time gets the next number
        self.known: defaultdict[str, int] = defaultdict(count().__next__)
        self.ids, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def _places(self, chunks: Iterable[str], n: int) -> np.ndarray:
        """The numbers of ``n`` chunks, which may repeat; those that are new are encoded."""
        place = np.fromiter(map(self.known.__getitem__, chunks), np.int64, n)
        if fresh := len(self.known) - len(self.sizes):
            try:
                ids, sizes = self.encode([*islice(reversed(self.known), fresh)][::-1])
            except BaseException:
                self.clear()
                raise
            self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
        return place

    def _gathered(self, place: np.ndarray, n_chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.sizes[place]
        ends = np.cumsum(sizes)
        starts = (np.cumsum(self.sizes) - self.sizes)[place]
        flat = self.ids[np.repeat(starts - (ends - sizes), sizes) + np.arange(sizes.sum())]
        return flat, np.concatenate([[0], ends])[np.cumsum(n_chunks)]

    def gather(self, chunks_by_text: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, put together from those of their chunks by position, and where each text ends."""
        n_chunks = np.fromiter(map(len, chunks_by_text), np.int64, len(chunks_by_text))
        n = int(n_chunks.sum())
        if len(self.known) + n > self.limit and len(self.known) + len(set().union(*chunks_by_text)) > self.limit:
            self.clear()
        return self._gathered(self._places(chain.from_iterable(chunks_by_text), n), n_chunks)

    def gather_lists(self, chunks_by_text: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """``gather`` for an Arrow array of lists: Arrow finds the distinct chunks, and only those are looked up."""
        coded = chunks_by_text.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False)
        if len(self.known) + len(distinct) > self.limit:
            self.clear()
        place = self._places(distinct, len(distinct))
        return self._gathered(place[coded.indices.to_numpy()], chunks_by_text.value_lengths().to_numpy())
