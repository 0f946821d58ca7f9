"""Packing of documents into token windows by best-fit decreasing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rosterflow.llm.common import col, ship, slices, texts_of
from rosterflow.llm.tokens import encoder

ROWS_PER_BATCH = 2_000
SEQUENCES_PER_TASK = 1 << 40


class OpenWindows:
    """Open windows by remaining capacity, in a segment tree whose leaves are the capacities."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.held = [0] * (2 * self.leaves)
        self.stacks: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, window_id: int, capacity: int) -> None:
        self.stacks[capacity].append(window_id)
        node = self.leaves + capacity
        while node:
            self.held[node] += 1
            node >>= 1

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Takes out the window with the least capacity of at least ``need``: its id and capacity."""
        held, node = self.held, self.leaves + need
        if not held[node]:
            while node > 1 and (node & 1 or not held[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if held[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        while node:
            held[node] -= 1
            node >>= 1
        return self.stacks[capacity].pop(), capacity


def best_fit_decreasing(lengths: list[int], window: int) -> list[list[int]]:
    """Items (by index) of each window; every length is from 1 to ``window``. Ties keep their order."""
    windows: list[list[int]] = []
    open_windows = OpenWindows(window)
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = open_windows.tightest(lengths[item])
        if found is None:
            found = (len(windows), window)
            windows.append([])
        windows[found[0]].append(item)
        if found[1] > lengths[item]:
            open_windows.put(found[0], found[1] - lengths[item])
    return windows


def power_parts(total: int) -> list[int]:
    """``total`` as a sum of powers of two, the largest first."""
    return [1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]


def cut_to_powers(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Pieces (item, start, length) of one window, cut into windows whose sizes are powers of two."""
    queue = list(reversed(pieces))
    windows = []
    for size in power_parts(sum(p[2] for p in pieces)):
        taken = []
        while size:
            item, start, length = queue.pop()
            used = min(length, size)
            taken.append((item, start, used))
            size -= used
            if used < length:
                queue.append((item, start + used, length - used))
        windows.append(taken)
    return windows


PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ]
)
ARROW_PIECES = pa.schema([(f.name, pa.binary() if f.name == "ids" else pa.int64()) for f in PIECES.fields])


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = 1024,
    end_id: int = 0,
    block_docs: int = 8192,
    least_fill: float = 15 / 16,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Sequences of at most ``window`` tokens, as one row per piece of a document.

    A document is the ids of its whole text and then ``end_id``. It is cut into full windows first,
    each a sequence of its own; what is left is packed by best-fit decreasing, in blocks of
    ``block_docs`` documents of one scan task, so that nothing is shuffled and a task holds at most
    ``block_docs * window`` ids. Windows filled below ``least_fill``, of which a block has a few at
    most, are cut into sequences whose sizes are powers of two and need no padding.

    Each piece has ``ids`` (packed little-endian unsigned 32-bit), where it starts in its document,
    the document's size, and its place in the sequence, without gaps from 0. Sequence ids are
    unique and follow from the partitions of ``docs``, so a task that runs again gives the same ones.

    Null and empty texts are documents of one token. Repeated rows and ids are packed row by row; a
    null id stays null. An empty table gives no piece. Other columns of ``docs`` are not read.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).encode
        end = np.array([end_id], dtype="<u4").tobytes()
        sequence = TaskContext.get().partitionId() * SEQUENCES_PER_TASK
        rows: list[tuple] = []
        left: list[tuple] = []

        def flush() -> None:
            nonlocal sequence
            for items in best_fit_decreasing([len(r[2]) // 4 for r in left], window):
                pieces = [(i, 0, len(left[i][2]) // 4) for i in items]
                fill = sum(p[2] for p in pieces)
                small = fill < least_fill * window and fill & (fill - 1)
                for taken in cut_to_powers(pieces) if small else [pieces]:
                    offset = 0
                    for item, start, length in taken:
                        doc, before, ids, total = left[item]
                        part = ids[4 * start : 4 * (start + length)]
                        rows.append((doc, before + start, length, part, total, sequence, offset))
                        offset += length
                    sequence += 1
            left.clear()

        def ready() -> Iterator[pa.RecordBatch]:
            for begin in range(0, len(rows), ROWS_PER_BATCH):
                columns = zip(*rows[begin : begin + ROWS_PER_BATCH])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(columns, ARROW_PIECES)], schema=ARROW_PIECES
                )
            rows.clear()

        for batch in slices(batches):
            for doc, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                ids = encode(text) + end
                total = len(ids) // 4
                full = total - total % window
                for start in range(0, full, window):
                    rows.append((doc, start, window, ids[4 * start : 4 * (start + window)], total, sequence, 0))
                    sequence += 1
                if full < total:
                    left.append((doc, full, ids[4 * full :], total))
                if len(rows) >= ROWS_PER_BATCH:
                    yield from ready()
                if len(left) >= block_docs:
                    flush()
                    yield from ready()
        flush()
        yield from ready()

    ship(docs.sparkSession)
    picked = docs.select(col(id_column).cast("long").alias("doc_id"), col(text_column).cast("string").alias("text"))
    return picked.mapInArrow(pack, PIECES)
