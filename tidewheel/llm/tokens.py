"""Token ids of whole texts by a public tokenizer of the ``tokenizers`` library, run inside Spark tasks.

The vocabulary's pre-tokenizer never joins text across white space, so each distinct run of other characters is
encoded once and its ids are looked up for every place where it stands. Texts are split at ASCII white space by Arrow; the
tokenizer sees to any other.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidewheel.llm.frames import ChunkIds

#: Stands between distinct chunks while they are encoded together; a token of its own between blanks.
_BETWEEN = "\x01"
#: Marks that stand around words; not those that begin a contraction or one of the vocabulary's special tokens.
_MARKS = ".,;:!?#*$%&()[]{}-_=+/\"~^@"


class WordTokens:
    """``path`` names a ``tokenizers`` file whose pre-tokenizer separates at white space and drops it."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        (self.between,) = self._ids(_BETWEEN)
        self.parts = ChunkIds(self._encode, 1_200_000)
        self.table = ChunkIds(self._by_parts, 1_000_000)

    def _ids(self, text: str) -> list[int]:
        (found,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)  # without offsets
        return found.ids

    def _encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the chunks and how many each has. Chunks go to the library a thousand at a time."""
        found: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        for at in range(0, len(chunks), 1000):
            part = chunks[at : at + 1000]
            ids = np.array(self._ids(f" {_BETWEEN} ".join([*part, ""])), np.uint32)
            ends = np.flatnonzero(ids == self.between)
            if len(ends) == len(part):
                found.append(np.delete(ids, ends))
                sizes.append(np.diff(ends, prepend=-1) - 1)
            else:  # a chunk has that character itself
                each = [np.array(self._ids(c), np.uint32) for c in part]
                found += each
                sizes.append(np.array([len(x) for x in each]))
        return np.concatenate(found), np.concatenate(sizes)

    def _by_parts(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Chunks that differ in capitals or in marks around a word share the word."""
        flat, ends = self.parts.gather([word_parts(c) for c in chunks])
        return flat, np.diff(ends, prepend=0)

    def clear(self) -> None:
        """Empties the tables at the end of a task, so a worker that lives on holds no more than the tokenizer."""
        self.table.clear()
        self.parts.clear()
        pa.default_memory_pool().release_unused()

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as unsigned 32-bit numbers."""
        flat, ends = self.table.gather_lists(pc.ascii_split_whitespace(pa.array(texts, pa.large_string())))
        cuts = [0, *ends.tolist()]
        return [flat[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def word_parts(chunk: str) -> list[str]:
    """A chunk of letters between marks, cut where the pre-tokenizer cuts it anyway; any other chunk is one part."""
    plain = chunk.isascii()
    if plain:
        chunk = chunk.lower()  # the tokenizer would do so
    word = chunk.strip(_MARKS)
    if len(word) == len(chunk) or not word.isalpha() or not (plain or word.lower().isalpha()):
        return [chunk]
    at = chunk.index(word)
    if not at:
        return [word, chunk[len(word) :]]
    return [p for p in (chunk[:at], word, chunk[at + len(word) :]) if p]


@lru_cache(maxsize=1)
def word_tokens(path: str) -> WordTokens:
    """One tokenizer for each Python worker; a task that is done clears its tables."""
    return WordTokens(path)
