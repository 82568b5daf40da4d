"""Packing by Karmarkar-Karp multiway differencing.

Documents are tokenized and cut into pieces; a block of pieces is dealt into k
windows: every piece starts as a partial partition (its length in one window,
zero in the others), and the two partial partitions with the largest
imbalances are merged with opposing orders until one is left. k is the
smallest count that could hold the block; it rises whenever the fullest window
exceeds the capacity. Blocks are filled row by row inside a partition, so
nothing is shuffled and memory is bounded by one block.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from newsarc.llm.tokens import default_path, documents_ids

CAPACITY = 2048
BLOCK_WINDOWS = 256   # windows of a block: 0.5 M tokens
PIECE = 512           # documents are cut into pieces of this many ids at most

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, seq_len long, ids binary")


def differencing(lengths: list[int], k: int) -> np.ndarray:
    """Window (0..k-1) of each piece by multiway differencing."""
    n = len(lengths)
    if k <= 1 or n <= 1:
        return np.zeros(n, dtype="int64")
    sums: dict[int, np.ndarray] = {}
    heap = []
    for i, size in enumerate(lengths):
        s = np.zeros(k, dtype="int64")
        s[0] = size  # kept in falling order
        sums[i] = s
        heap.append((-size, i))
    heapq.heapify(heap)
    merges, node = [], n
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        s = sums.pop(a) + sums.pop(b)[::-1]
        order = np.argsort(-s, kind="stable")
        s = s[order]
        s -= s[-1]
        merges.append((a, b, order.astype("int32")))
        sums[node] = s
        heapq.heappush(heap, (-int(s[0]), node))
        node += 1
    slots = {node - 1: np.arange(k)}
    for a, b, order in reversed(merges):
        node -= 1
        place = slots.pop(node)
        back = np.empty(k, dtype="int64")
        back[order] = place       # window of each unsorted slot
        slots[a], slots[b] = back, back[::-1]
    return np.array([slots[i][0] for i in range(n)], dtype="int64")


def pack_block(lengths: list[int], capacity: int) -> np.ndarray:
    """Windows for the pieces, none above the capacity; k rises until that holds."""
    k = max(1, -(-sum(lengths) // capacity))
    while True:
        where = differencing(lengths, k)
        if np.bincount(where, weights=lengths, minlength=k).max() <= capacity:
            return where
        k += max(1, k // 200)


def _cut(n: int, capacity: int, piece: int) -> list[int]:
    """Lengths of a document's pieces: whole windows first, then pieces as long as possible."""
    whole, rest = divmod(n, capacity)
    return [capacity] * whole + [piece] * (rest // piece) + ([rest % piece] if rest % piece else [])


def pack(docs: DataFrame, capacity: int = CAPACITY, text: str = "text", ident: str = "doc_id",
         path: str | None = None, end: int | None = 1, piece: int = PIECE,
         block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per piece: document, place in it, its ids, and its sequence and offset there.

    Every id of every document lies in exactly one piece. A null text counts as
    empty (only the end id). Null ids stay null. Repeated rows are documents of
    their own. Texts of any length are cut; a piece never exceeds the capacity.
    seq_len is the number of ids in the sequence before padding. Other columns of
    ``docs`` are not read, so clashing names do no harm.
    """
    path = path or default_path()

    def run(batches):
        pid, seq = TaskContext.get().partitionId(), 0
        docs_, pieces, total = [], [], 0   # (id, ids), (document, start, length)
        for b, i, ids in documents_ids(batches, path, text, end):
            if not len(ids):
                continue
            docs_.append((b[ident][i].as_py(), ids))
            at = 0
            for size in _cut(len(ids), capacity, piece):
                pieces.append((len(docs_) - 1, at, size))
                at += size
                total += size
                if total >= block_windows * capacity:
                    yield from _emit(docs_, pieces, pid, seq, capacity)
                    seq += len(pieces)
                    docs_, pieces, total = docs_[-1:], [], 0
                    # the rest of this document belongs to the next block
        if pieces:
            yield from _emit(docs_, pieces, pid, seq, capacity)

    return docs.select(ident, text).mapInArrow(run, SCHEMA)


def _emit(docs, pieces, pid, seq, capacity):
    whole = [j for j, p in enumerate(pieces) if p[2] == capacity]
    part = [j for j, p in enumerate(pieces) if p[2] < capacity]
    where = np.empty(len(pieces), dtype="int64")
    where[whole] = np.arange(len(whole))
    if part:
        where[part] = len(whole) + pack_block([pieces[j][2] for j in part], capacity)
    fill: dict[int, int] = {}
    used: dict[int, int] = {}
    for j, w in enumerate(where.tolist()):
        used[w] = used.get(w, 0) + pieces[j][2]
    cols: list[list] = [[] for _ in range(9)]
    for (d, start, size), w in zip(pieces, where.tolist()):
        ident, ids = docs[d]
        raw = ids[start:start + size].tobytes()
        at = fill.get(w, 0)
        fill[w] = at + size
        for c, v in zip(cols, (ident, start, size, zlib.crc32(raw), len(ids), (pid << 40) + seq + w, at, used[w], raw)):
            c.append(v)
    types = [pa.int64()] * 8 + [pa.binary()]
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    for a in range(0, len(pieces), 5000):
        yield pa.RecordBatch.from_arrays([pa.array(c[a:a + 5000], t) for c, t in zip(cols, types)], names=names)
