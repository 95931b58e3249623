"""Bounded-space online packing of token sequences.

Each task keeps a fixed number of open windows. A document (its ids and a closing id) first fills
whole windows; what remains goes to the open window that it leaves the least room in. If none has
room, a new window opens; if as many as allowed are open, the fullest is completed with the head
of the remainder and emitted. When the task's documents end, the leftovers are merged: their
pieces fill windows one after another, and what then remains is cut into windows whose lengths
are powers of two, which need no padding. There is no shuffle, and a task's state is a few windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, slices
from .tokens import vocabulary

#: One piece: document id, ids before it in its document, its ids (4 bytes each), ids of its document.
Piece = tuple[object, int, bytes, int]


class Packer:
    """Packs one stream of documents; emits (sequence number, pieces)."""

    def __init__(self, size: int, open_windows: int) -> None:
        self.size, self.most = size, open_windows
        self.windows: list[list[Piece]] = []
        self.fill: list[int] = []
        self.done: list[tuple[int, list[Piece]]] = []
        self.sequences = 0

    def _emit(self, pieces: list[Piece]) -> None:
        self.done.append((self.sequences, pieces))
        self.sequences += 1

    def add(self, doc: object, ids: bytes) -> None:
        total, at, width = len(ids) // 4, 0, 4 * self.size
        while len(ids) - 4 * at >= width:
            self._emit([(doc, at, ids[4 * at : 4 * at + width], total)])
            at += self.size
        while at < total:
            n = total - at
            room = [(self.size - f, i) for i, f in enumerate(self.fill) if self.size - f >= n]
            if room:
                space, i = min(room)
                self.windows[i].append((doc, at, ids[4 * at :], total))
                self.fill[i] += n
                at = total
                if space == n:
                    self._close(i)
            elif len(self.windows) < self.most:
                self.windows.append([(doc, at, ids[4 * at :], total)])
                self.fill.append(n)
                at = total
            else:
                fullest = max(range(len(self.fill)), key=lambda i: (self.fill[i], -i))
                head = self.size - self.fill[fullest]
                self.windows[fullest].append((doc, at, ids[4 * at : 4 * (at + head)], total))
                at += head
                self._close(fullest)

    def _close(self, i: int) -> None:
        self._emit(self.windows.pop(i))
        self.fill.pop(i)

    def finish(self) -> None:
        """Merge the leftovers."""
        left = sum(self.fill)
        order = sorted(range(len(self.fill)), key=lambda i: -self.fill[i])
        pieces = [p for i in order for p in self.windows[i]]
        self.windows, self.fill = [], []
        sizes = [self.size] * (left // self.size)
        sizes += [1 << b for b in reversed(range(self.size.bit_length())) if left % self.size >> b & 1]
        pieces.reverse()
        for size in sizes:
            window: list[Piece] = []
            while size:
                doc, start, ids, total = pieces.pop()
                n = min(size, len(ids) // 4)
                window.append((doc, start, ids[: 4 * n], total))
                if 4 * n < len(ids):
                    pieces.append((doc, start + n, ids[4 * n :], total))
                size -= n
            self._emit(window)


def pack(docs: DataFrame, vocabulary_file: str, size: int = 1024, open_windows: int = 32, closing_id: int = 0, with_ids: bool = False, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and its ids).

    Every id of every document, closing id included, lies in exactly one piece; a sequence has at
    most `size` ids, and its pieces' offsets run from 0 without gaps. A null or empty text is a
    document of the closing id alone. Repeated rows and ids are documents of their own; other
    columns are ignored. sequence_id is unique over all tasks. An empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids
    out = arrow_schema(schema)
    end = closing_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, packer, task = vocabulary(vocabulary_file), Packer(size, open_windows), TaskContext.get().partitionId() << 34

        def rows() -> pa.RecordBatch:
            columns: list[list] = [[] for _ in out]
            for number, pieces in packer.done:
                offset = 0
                for doc, start, ids, total in pieces:
                    n = len(ids) // 4
                    row = (doc, start, n, crc32(ids), total, task + number, offset)
                    for c, x in zip(columns, row, strict=False):
                        c.append(x)
                    if with_ids:
                        columns[-1].append(memoryview(ids).cast("I").tolist())
                    offset += n
            packer.done = []
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out, strict=True)], schema=out)

        for batch in batches:
            for part in slices(batch):
                for doc, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    packer.add(doc, v.encode(t or "") + end)
                yield rows()
        packer.finish()
        yield rows()

    return docs.select(F.col(id_col), F.col(text).alias("text")).mapInArrow(run, schema)
