"""Best-fit-decreasing packing of token ids into fixed windows, with binary output.

Documents are tokenized and split losslessly into segments of at most one
window. A block of segments is sorted by falling length; each goes to the open
window with the least room that still holds it. A segment tree over room values
(0 .. window) answers "smallest room of at least n that some window has". Blocks
are filled row by row within a partition, so nothing is shuffled and memory is
bounded by one block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from newsarc.llm.tokens import default_path, documents_ids

WINDOW = 2048
BLOCK_IDS = 1 << 20   # ids of a block
END, PAD = 1, 0

SCHEMA = ("window_id long, input_ids binary, n_ids int, cu_seqlens array<int>, position_ids binary, "
          "doc_ids array<long>, doc_starts array<long>")


class Rooms:
    """Segment tree over room sizes 0..size: is there an open window with that room?"""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, room: int, window: int) -> None:
        self.open[room].append(window)
        i = self.leaves + room
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, window) with the least room of at least ``need``, removed; None if there is none."""
        i = self.leaves + need
        if not self.count[i]:
            # climb until a right neighbour holds a window, then descend to its smallest room
            while i > 1 and (i & 1 or not self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.leaves
        window = self.open[room].pop()
        while i:
            self.count[i] -= 1
            i >>= 1
        return room, window


def best_fit(lengths: list[int], window: int) -> list[int]:
    """The window of each segment (none longer than ``window``)."""
    rooms, where, n = Rooms(window), [0] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        got = rooms.take(lengths[i])
        if got is None:
            got, n = (window, n), n + 1
        where[i] = got[1]
        rooms.add(got[0] - lengths[i], got[1])
    return where


def _windows(segments, window: int, first: int):
    """Record batches of the packed windows of one block."""
    where = best_fit([len(s[2]) for s in segments], window)
    members: dict[int, list[int]] = {}
    for i, w in enumerate(where):
        members.setdefault(w, []).append(i)
    rows = []
    for w, own in members.items():
        ids = np.full(window, PAD, dtype="<u4")
        positions = np.zeros(window, dtype="<u2" if window <= 1 << 16 else "<u4")
        ends = [0]
        for i in own:
            a, z = ends[-1], ends[-1] + len(segments[i][2])
            ids[a:z], positions[a:z] = segments[i][2], np.arange(z - a)
            ends.append(z)
        rows.append((first + w, ids.tobytes(), ends[-1], ends, positions.tobytes(),
                     [segments[i][0] for i in own], [segments[i][1] for i in own]))
    names = ["window_id", "input_ids", "n_ids", "cu_seqlens", "position_ids", "doc_ids", "doc_starts"]
    types = [pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    for a in range(0, len(rows), 256):
        cols = list(zip(*rows[a:a + 256]))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=names)


def pack(docs: DataFrame, window: int = WINDOW, text: str = "text", ident: str = "doc_id", path: str | None = None,
         end: int | None = END, block_ids: int = BLOCK_IDS) -> DataFrame:
    """One row per window of ``window`` ids.

    input_ids: little-endian unsigned 32-bit ids, padded with 0; n_ids: ids before
    the padding; cu_seqlens: cumulative segment lengths from 0; position_ids:
    little-endian unsigned 16-bit positions that start anew at 0 in each segment
    (0 in the padding); doc_ids and doc_starts: the segments' documents and how
    many of their ids come before. A document is its ids and ``end``; every id is in
    exactly one window. A null text counts as empty; null ids stay null; repeated
    rows are documents of their own; other columns are not read.
    """
    path = path or default_path()

    def run(batches):
        base, n, total, segments = TaskContext.get().partitionId() << 40, 0, 0, []
        for b, i, ids in documents_ids(batches, path, text, end):
            name = b[ident][i].as_py()
            for a in range(0, len(ids), window):
                segments.append((name, a, ids[a:a + window]))
                total += len(segments[-1][2])
            if total >= block_ids:
                yield from _windows(segments, window, base + n)
                n, total, segments = n + len(segments), 0, []
        if segments:
            yield from _windows(segments, window, base + n)

    return docs.select(ident, text).mapInArrow(run, SCHEMA)


def write(docs: DataFrame, folder: str, **options) -> None:
    """The packed windows as Parquet files: a row is a row of the id matrix."""
    pack(docs, **options).write.parquet(folder)
