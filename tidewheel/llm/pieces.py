"""SentencePiece encoding and decoding through a table of distinct chunks.

White space is marked by U+2581, and no piece of the model goes on past the end of a word into the next marker
(checked when the model is loaded). So a text is cut in front of every run of markers, each distinct chunk is
segmented once by the library, and its ids are put back at every place where the chunk stands.

The table lives in the Python worker: joining every word of the corpus back over a shuffle would move several times the
input, while a worker segments a chunk anew only when it first meets it. Decoding goes the same way over the table of
pieces; a text with pieces that stand for parts of characters is left to the library as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.frames import ChunkIds, narrow, text_groups

MARK = "▁"
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")


class PieceModel:
    """A sentencepiece model whose normaliser only marks spaces and adds one marker in front."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(MARK in name.lstrip(MARK) for name in names):
            raise ValueError("pieces of this model cross white space markers")
        if self.model.encode(" a ") == self.model.encode("a"):
            raise ValueError("this model drops spaces, so chunks cannot be encoded on their own")
        self._spell(names)
        self.lone = self.model.piece_to_id(MARK)
        self.encoded = ChunkIds(self._encode, 250_000)

    def _encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # the library puts the first marker back; it gives no ids for an empty text, so a lone marker is its own piece
        lists = self.model.encode([c[1:].replace(MARK, " ") for c in chunks], num_threads=1)
        lists = [x or [self.lone] for x in lists]
        return np.concatenate(lists).astype(np.uint32), np.array([len(x) for x in lists])

    def _spell(self, names: list[str]) -> None:
        """The bytes of each piece, one piece after the other, and which pieces mean the same wherever they stand."""
        spelt, plain = [], []
        for i, name in enumerate(names):
            one_byte = int(name[1:-1], 16) if self.model.is_byte(i) else None
            plain.append(one_byte < 0x80 if one_byte is not None else not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i)))
            spelt.append(bytes([one_byte]) if one_byte is not None else name.replace(MARK, " ").encode())
        self.plain = np.array(plain)
        self.spelt = np.frombuffer(b"".join(spelt), np.uint8)
        self.sizes = np.array([len(x) for x in spelt])
        self.starts = np.cumsum(self.sizes) - self.sizes

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text ends."""
        return self.encoded.gather([_CHUNK.findall(marked) for marked in self.model.normalize(texts)])

    def decode(self, flat: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of id lists that stand one after the other in ``flat``, each up to its end."""
        sizes = self.sizes[flat]
        reach = np.cumsum(sizes)
        raw = self.spelt[np.repeat(self.starts[flat] - (reach - sizes), sizes) + np.arange(sizes.sum())].tobytes()
        odd = np.concatenate([[0], np.cumsum(~self.plain[flat])])
        cuts, out = np.concatenate([[0], reach]), []
        for a, b in zip([0, *ends], ends, strict=False):
            if odd[a] != odd[b]:
                out.append(self.model.decode(flat[a:b].tolist()))
            else:
                text = raw[cuts[a] : cuts[b]].decode()
                out.append(text[1:] if text[:1] == " " else text)  # the marker that encoding put in front
        return out


@lru_cache(maxsize=1)
def piece_model(path: str) -> PieceModel:
    """One model and its tables for each Python worker."""
    return PieceModel(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``ids`` (array<int>) of each document, exactly as the library encodes its whole text.

    A null text is encoded as an empty one: no ids. Null and repeated doc_ids and repeated rows are kept as they are;
    other columns of ``docs`` are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch, texts in text_groups(batches):
            flat, ends = model.encode(texts)
            ids = pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), pa.array(flat.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    return narrow(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (``doc_id``, ``ids``) with ``decoded``: the text of each id list; null ids: an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                lists = part.column("ids")
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                texts = model.decode(flat, np.cumsum([n or 0 for n in lists.value_lengths().to_pylist()]))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists, pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def ids_text(ids: str = "ids") -> Column:
    """Decimal ids joined by commas."""
    return F.array_join(F.col(ids).cast("array<string>"), ",")
