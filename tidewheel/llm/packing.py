"""Sum-of-squares online packing of documents into fixed windows.

Each document goes to the fill level that leaves the smallest sum, over the levels 1 .. window-1, of the squared
number of windows standing at that level. The levels are an array of counts, so a placement costs one pass over at
most ``window`` numbers and does not depend on how many windows are open.

Every Spark partition packs its own documents: no shuffle, and a lost task is packed again from the same rows with
the same result, provided that the input is a scan or a written table. Documents may be cut: one longer than the
window first fills whole windows. When a partition ends (or ``max_open`` windows stand open), the emptiest windows
are cut up to fill the fullest, which leaves one remainder below a window per partition. It is written as windows
whose lengths are powers of two, so nothing is padded.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewheel.llm.frames import crc, narrow, text_groups
from tidewheel.llm.tokens import word_tokens

WINDOW = 4096
#: Most windows that stand open in a task; each holds fewer than ``window`` ids.
MAX_OPEN = 1024

SCHEMA = "doc_id long, start long, length long, ids array<int>, doc_tokens long, sequence_id long, offset long"

# A piece: (doc_id, start, ids, doc_tokens)
Piece = tuple[int | None, int, np.ndarray, int]


class SquaresPacker:
    """Places pieces one by one; ``closed`` collects full windows as lists of pieces."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN):
        self.window, self.max_open = window, max_open
        self.levels = np.zeros(window + 1, np.int64)
        self.open: list[list[list[Piece]]] = [[] for _ in range(window)]
        self.n_open = 0
        self.closed: list[list[Piece]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        total, whole = len(ids), len(ids) // self.window * self.window
        for at in range(0, whole, self.window):
            self.closed.append([(doc_id, at, ids[at : at + self.window], total)])
        if whole < total:
            self._place([], (doc_id, whole, ids[whole:].copy(), total))
        if self.n_open > self.max_open:
            self.settle()

    def level_for(self, size: int) -> int:
        """The fill level (0: a new window) at which ``size`` more ids leave the smallest sum of squares.

        With n windows at a level, one more adds 2n+1 and one fewer takes 2n-1; full windows do not count.
        Ties go to the fullest window.
        """
        n, top = self.levels, self.window - size
        change = 2 * (n[size : self.window + 1] - n[: top + 1]) + 2
        change[top] -= 2 * n[self.window] + 1  # it becomes full
        change[0] += 2 * n[0] - 1  # no window leaves a level
        usable = n[: top + 1] > 0
        usable[0] = True
        change = np.where(usable, change, np.iinfo(np.int64).max)
        return top - int(np.argmin(change[::-1]))

    def _place(self, pieces: list[Piece], piece: Piece) -> None:
        size = len(piece[2])
        level = self.level_for(size)
        if level:
            pieces = self.open[level].pop()
            self.levels[level] -= 1
            self.n_open -= 1
        pieces.append(piece)
        self._keep(pieces, level + size)

    def _keep(self, pieces: list[Piece], fill: int) -> None:
        if fill == self.window:
            self.closed.append(pieces)
        elif fill:
            self.open[fill].append(pieces)
            self.levels[fill] += 1
            self.n_open += 1

    def settle(self) -> None:
        """Cut the emptiest open windows up to fill the fullest, until at most one is open."""
        stand = [pieces for level in self.open for pieces in level]  # emptiest first
        self.open = [[] for _ in range(self.window)]
        self.levels[:] = 0
        self.n_open = 0
        spare: list[Piece] = []
        low = 0
        while stand[low:]:
            pieces = stand.pop()
            room = self.window - sum(len(p[2]) for p in pieces)
            while room:
                if not spare:
                    if low == len(stand):
                        break
                    spare = stand[low]
                    low += 1
                doc_id, start, ids, total = spare.pop()
                pieces.append((doc_id, start, ids[:room], total))
                if len(ids) > room:
                    spare.append((doc_id, start + room, ids[room:], total))
                room -= min(room, len(ids))
            self._keep(pieces, self.window - room)
        if spare:
            self._keep(spare, sum(len(p[2]) for p in spare))

    def finish(self) -> list[list[Piece]]:
        """Settle, and cut what remains into windows whose lengths are powers of two, longest first."""
        while self.n_open > 1:
            self.settle()
        rest = [p for level in self.open for pieces in level for p in pieces]
        left, out = sum(len(p[2]) for p in rest), []
        while left:
            room = size = 1 << (left.bit_length() - 1)
            pieces = []
            while room:
                doc_id, start, ids, total = rest.pop(0)
                pieces.append((doc_id, start, ids[:room], total))
                if len(ids) > room:
                    rest.insert(0, (doc_id, start + room, ids[room:], total))
                room -= min(room, len(ids))
            out.append(pieces)
            left -= size
        return out


def pack(docs: DataFrame, path: str, end_id: int = 2, window: int = WINDOW, max_open: int = MAX_OPEN, digest: bool = False) -> DataFrame:
    """One row per piece of a document: its place in its document (``start``, ``length``), its ids, and its place in
    its sequence (``sequence_id``, ``offset``).

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A document is its ids and ``end_id``, so a null
    or empty text is one id. Null and repeated doc_ids are documents like any other; an empty table gives no rows.
    With ``digest`` the ids are given as ``ids_crc32`` (of little-endian unsigned 32-bit ids) instead of an array.
    """
    schema = SCHEMA.replace("ids array<int>", "ids_crc32 long") if digest else SCHEMA

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        numbers = count(TaskContext.get().partitionId() << 40)
        tokens, packer = word_tokens(path), SquaresPacker(window, max_open)

        def rows(windows: list[list[Piece]]) -> pa.RecordBatch:
            out: list[tuple] = []
            for pieces in windows:
                number, at = next(numbers), 0
                for doc_id, start, ids, total in pieces:
                    out.append((doc_id, start, len(ids), crc(ids.astype("<u4").tobytes()) if digest else ids, total, number, at))
                    at += len(ids)
            columns = list(zip(*out, strict=True))
            kinds = [pa.int64()] * 3 + [pa.int64() if digest else pa.list_(pa.int32())] + [pa.int64()] * 3
            names = [x.split()[0] for x in schema.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

        for batch, texts in text_groups(batches):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tokens.ids(texts), strict=True):
                packer.add(doc_id, np.append(ids, np.uint32(end_id)))
            if packer.closed:
                yield rows(packer.closed)
                packer.closed = []
        tokens.clear()
        last = packer.finish()
        if packer.closed or last:
            yield rows(packer.closed + last)

    return narrow(docs).mapInArrow(run, schema)
