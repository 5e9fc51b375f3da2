"""Sum-of-squares online packing of token ids into windows.

Every task packs the documents it reads, in their order, so nothing is shuffled. What fills whole windows is
cut off; the rest of a document goes to the fill level (or a new window) that leaves the smallest sum of
squared counts of partially filled windows. The counts stand in a level array. When as many windows are open
as allowed, and at the end of a task, windows are filled up exactly by cutting pieces, so that a task leaves
one window with padding at most.

Defined results: ids are those of ``tokenizers`` as they come, so the name of a special token in a text is that token;
a null or empty text is its end token alone; a null key stays null; repeated rows are packed
each by themselves; an empty table gives no rows; columns beside key and text are dropped.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from millrace.llm.common import whole
from millrace.llm.token_ids import encoder

WINDOW = 1024
MOST_OPEN = 1024


@dataclass
class Piece:
    key: object
    start: int
    ids: array
    doc_tokens: int

    def cut(self, length: int) -> tuple[Piece, Piece]:
        return (Piece(self.key, self.start, self.ids[:length], self.doc_tokens),
                Piece(self.key, self.start + length, self.ids[length:], self.doc_tokens))


Placed = tuple[Piece, int, int]  # piece, window, offset


class SquaresPacker:
    """Open windows by fill level, and the level array that scores them."""

    def __init__(self, window: int = WINDOW, most_open: int = MOST_OPEN) -> None:
        self.window, self.most_open = window, most_open
        self.levels = np.zeros(window + 1, np.int64)  # windows at each fill; 0 and full ones are not counted
        self.open: list[list[list[Piece]]] = [[] for _ in range(window)]
        self.n_open = self.closed = 0

    def level_for(self, size: int) -> int:
        """Fill level whose use leaves the smallest sum of squares; 0 opens a window. Of equal ones the fullest."""
        counts = self.levels[1:self.window + 1 - size]
        cost = 2 * (self.levels[1 + size:] - counts) + 2
        cost[-1:] -= 1  # a window that becomes full leaves the array
        cost[counts == 0] = np.iinfo(np.int64).max
        fresh = 2 * self.levels[size] + 1
        if not len(cost):
            return 0
        best = len(cost) - 1 - int(np.argmin(cost[::-1]))
        return best + 1 if cost[best] <= fresh else 0

    def _close(self, pieces: list[Piece]) -> list[Placed]:
        placed, offset = [], 0
        for piece in pieces:
            placed.append((piece, self.closed, offset))
            offset += len(piece.ids)
        self.closed += 1
        return placed

    def _take(self, level: int) -> list[Piece]:
        if level == 0:
            return []
        self.levels[level] -= 1
        self.n_open -= 1
        return self.open[level].pop()

    def _put(self, level: int, pieces: list[Piece]) -> list[Placed]:
        if level == self.window:
            return self._close(pieces)
        self.levels[level] += 1
        self.n_open += 1
        self.open[level].append(pieces)
        return []

    def add(self, piece: Piece) -> Iterator[Placed]:
        while len(piece.ids) >= self.window:
            head, piece = piece.cut(self.window)
            yield from self._close([head])
        while len(piece.ids):
            level = self.level_for(len(piece.ids))
            if level == 0 and self.n_open >= self.most_open:
                level = int(np.flatnonzero(self.levels)[-1])  # the fullest takes what it can
            head, piece = piece.cut(min(len(piece.ids), self.window - level))
            yield from self._put(level + len(head.ids), [*self._take(level), head])

    def finish(self) -> Iterator[Placed]:
        """Fill the fullest open windows with cut pieces of the emptiest."""
        left = [(level, pieces) for level in range(1, self.window) for pieces in self.open[level]]
        low, high = 0, len(left) - 1
        spare: list[Piece] = []
        while low <= high:
            level, pieces = left[high]
            high -= 1
            while level < self.window and (spare or low <= high):
                if not spare:
                    spare = left[low][1][::-1]
                    low += 1
                head, tail = spare.pop().cut(self.window - level)
                pieces.append(head)
                level += len(head.ids)
                if len(tail.ids):
                    spare.append(tail)
            yield from self._close(pieces)
        while spare:  # the emptiest window was only taken in part
            pieces, level = [], 0
            while spare and level < self.window:
                head, tail = spare.pop().cut(self.window - level)
                pieces.append(head)
                level += len(head.ids)
                if len(tail.ids):
                    spare.append(tail)
            yield from self._close(pieces)


def pack_squares(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = 0,
                 most_open: int = MOST_OPEN, ranks: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of documents and their places.

    Columns: the key, ``start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, with ``with_ids``, the
    piece's ``ids`` as little-endian 32-bit numbers. A sequence id is the task's number times 2^32 plus a count.
    """
    source = df.select(F.col(f"`{key}`").alias("key"), whole(F.col(f"`{text}`")).alias("text"))
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    fields = [StructField("key", source.schema["key"].dataType), *[StructField(n, LongType()) for n in names]]
    if with_ids:
        fields.append(StructField("ids", BinaryType()))
    schema = StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 32
        codec, packer, key_type = encoder(ranks, special=True), SquaresPacker(window, most_open), None

        def rows(placed: list[Placed]) -> pa.RecordBatch:
            raw = [p.ids.tobytes() for p, _, _ in placed]
            columns = [
                pa.array([p.key for p, _, _ in placed], key_type),
                pa.array([p.start for p, _, _ in placed], pa.int64()), pa.array([len(p.ids) for p, _, _ in placed], pa.int64()),
                pa.array([zlib.crc32(b) for b in raw], pa.int64()), pa.array([p.doc_tokens for p, _, _ in placed], pa.int64()),
                pa.array([first + w for _, w, _ in placed], pa.int64()), pa.array([o for _, _, o in placed], pa.int64()),
            ]
            if with_ids:
                columns.append(pa.array(raw, pa.binary()))
            return pa.RecordBatch.from_arrays(columns, names=["key", *names, *["ids"] * with_ids])

        ready: list[Placed] = []
        for batch in batches:
            key_type = batch.schema.field("key").type
            for doc, body in zip(batch.column("key").to_pylist(), batch.column("text"), strict=True):
                ids = codec.encode(body.as_py(), end_id)
                ready += packer.add(Piece(doc, 0, ids, len(ids)))
                if len(ready) >= 4096:
                    yield rows(ready)
                    ready = []
        if key_type is not None:
            ready += packer.finish()
            for at in range(0, len(ready), 4096):
                yield rows(ready[at:at + 4096])

    return source.mapInArrow(run, schema).withColumnRenamed("key", key)
