"""Packed id matrices: best-fit-decreasing packing of token ids, found through a segment tree.

A task packs what it reads in blocks of bounded size; nothing is shuffled. A document longer than a window is
split without loss: its full windows stand alone, its rest is packed. Rests go by falling length into the open
window with the least room that still holds them; a segment tree over room sizes finds it in as many steps as
the window length has bits.

Defined results: a null or empty text is its end token alone; a null key stays null; repeated rows are packed
each by themselves; an empty table gives no rows; columns beside key and text are dropped.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from millrace.llm.common import whole
from millrace.llm.token_ids import encoder

WINDOW = 2048
BLOCK_TOKENS = 4_000_000  # ids held by a task at a time
Part = tuple[object, int, array]  # key, ids of the document before it, ids


class RoomTree:
    """How many open windows have each amount of room, as sums over a binary tree."""

    def __init__(self, window: int) -> None:
        self.size = 1 << window.bit_length()
        self.sums = [0] * (2 * self.size)

    def change(self, room: int, by: int) -> None:
        node = room + self.size
        while node:
            self.sums[node] += by
            node >>= 1

    def least_from(self, room: int) -> int | None:
        """Smallest amount of room, not under the given one, that some window has."""
        node = room + self.size
        if not self.sums[node]:
            while node > 1 and (node & 1 or not self.sums[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node + (not self.sums[2 * node])
        return node - self.size


def best_fit(parts: list[Part], window: int) -> list[list[Part]]:
    """Windows of the parts, none longer than a window."""
    tree, open_windows, closed = RoomTree(window), [[] for _ in range(window + 1)], []
    for part in sorted(parts, key=lambda p: len(p[2]), reverse=True):
        size = len(part[2])
        room = tree.least_from(size)
        if room is None:
            content, room = [], window
        else:
            content = open_windows[room].pop()
            tree.change(room, -1)
        content.append(part)
        if room == size:
            closed.append(content)
        else:
            open_windows[room - size].append(content)
            tree.change(room - size, 1)
    return closed + [content for same in open_windows for content in same]


def pack_best_fit(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = 50256,
                  block_tokens: int = BLOCK_TOKENS, id_bytes: int = 2, ranks: str | None = None) -> DataFrame:
    """One row per window.

    Columns: ``window_id`` (the task's number times 2^32 plus a count), ``input_ids`` (one matrix row: window times
    ``id_bytes`` little-endian bytes, padded with ``end_id``; an id that needs more fails the job), ``n_tokens``, ``cu_seqlens`` (segment ends from 0 on),
    ``position_resets`` (where positions start from 0 again; padding is a segment of its own), ``keys`` and ``starts``
    (document of each segment, and its ids before it).
    """
    source = df.select(F.col(f"`{key}`").alias("key"), whole(F.col(f"`{text}`")).alias("text"))
    schema = StructType([
        StructField("window_id", LongType()), StructField("input_ids", BinaryType()), StructField("n_tokens", IntegerType()),
        StructField("cu_seqlens", ArrayType(IntegerType())), StructField("position_resets", ArrayType(IntegerType())),
        StructField("keys", ArrayType(source.schema["key"].dataType)), StructField("starts", ArrayType(LongType()))])
    kind = {2: "<u2", 4: "<u4"}[id_bytes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, codec, key_type = TaskContext.get().partitionId() << 32, encoder(ranks), None

        def rows(windows: list[list[Part]]) -> pa.RecordBatch:
            nonlocal number
            most = max((max(ids) for parts in windows for _, _, ids in parts), default=0)
            if max(most, end_id) > np.iinfo(kind).max:
                raise ValueError(f"the id {max(most, end_id)} does not fit into {id_bytes} bytes: set id_bytes=4")
            matrix = np.full((len(windows), window), end_id, kind)
            ends = []
            for row, parts in zip(matrix, windows, strict=True):
                at = [0]
                for _, _, ids in parts:
                    row[at[-1]:at[-1] + len(ids)] = ids
                    at.append(at[-1] + len(ids))
                ends.append(at)
            number += len(windows)
            return pa.RecordBatch.from_arrays([
                pa.array(range(number - len(windows), number), pa.int64()), pa.array([r.tobytes() for r in matrix], pa.binary()),
                pa.array([e[-1] for e in ends], pa.int32()), pa.array(ends, pa.list_(pa.int32())),
                pa.array([e if e[-1] < window else e[:-1] for e in ends], pa.list_(pa.int32())),
                pa.array([[p[0] for p in w] for w in windows], pa.list_(key_type)),
                pa.array([[p[1] for p in w] for w in windows], pa.list_(pa.int64()))], names=schema.names)

        parts, held = [], 0
        for batch in batches:
            key_type = batch.schema.field("key").type
            full = []
            for doc, body in zip(batch.column("key").to_pylist(), batch.column("text"), strict=True):
                ids = codec.encode(body.as_py(), end_id)
                whole_windows = len(ids) - len(ids) % window
                full += [[(doc, at, ids[at:at + window])] for at in range(0, whole_windows, window)]
                if whole_windows < len(ids):
                    parts.append((doc, whole_windows, ids[whole_windows:]))
                    held += len(ids) - whole_windows
                if len(full) >= 512:
                    yield rows(full)
                    full = []
                if held >= block_tokens:
                    packed = best_fit(parts, window)
                    for at in range(0, len(packed), 512):
                        yield rows(packed[at:at + 512])
                    parts, held = [], 0
            if full:
                yield rows(full)
        packed = best_fit(parts, window)
        for at in range(0, len(packed), 512):
            yield rows(packed[at:at + 512])

    return source.mapInArrow(run, schema)


def write_matrices(packed: DataFrame, path: str) -> None:
    """Write the windows; each file's ``input_ids`` column, joined, is one id matrix."""
    packed.write.mode("overwrite").parquet(path)


def read_matrix(spark: SparkSession, path: str, window: int = WINDOW, id_bytes: int = 2) -> DataFrame:
    """The written windows with their ids and positions as arrays."""
    written = spark.read.parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(b.as_py(), {2: "<u2", 4: "<u4"}[id_bytes]).astype("<i4") for b in batch.column("input_ids")]
            places = []
            for resets in batch.column("position_resets").to_pylist():
                bounds = np.array([*resets, window])
                places.append(np.arange(window) - np.repeat(bounds[:-1], np.diff(bounds)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("window_id"), pa.array([i.tolist() for i in ids], pa.list_(pa.int32())),
                 pa.array([p.tolist() for p in places], pa.list_(pa.int32()))], names=["window_id", "ids", "positions"])

    return written.select("window_id", "input_ids", "position_resets").mapInArrow(
        run, "window_id long, ids array<int>, positions array<int>")
