"""Nearest neighbours by multi-index hashing over learned binary codes.

Vectors are centred, rotated and cut to signs. The rotation is learnt on at most
``SAMPLE`` vectors (taken by the order of a hash of the id): principal axes, then
an orthogonal map that brings the projections near the corners of the cube. All
rows are encoded. A code is split into ``PARTS`` substrings and each is indexed: if
two codes differ in at most r bits, some substring differs in at most r // PARTS,
so probing every substring at that distance retrieves every code within r.

The index is dealt: each task holds the tables of its rows, batch by batch, and
answers a block of at most about ``QUERY_BLOCK`` queries (broadcast; a bounded size)
with its own best k, so no pairs are shuffled but k per query and task. Hits are
ranked by the exact cosine of the original vectors. Queries that found fewer than
k are searched again with the radius that retrieves every code.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsarc.llm.common import cut, written

BITS, PARTS = 64, 4
WIDTH = BITS // PARTS
RADIUS = 28
SAMPLE, TURNS = 10_000, 30
QUERY_BLOCK = 4096


class Coder:
    """Learned rotation and the 64-bit codes it gives."""

    def __init__(self, sample: np.ndarray, bits: int = BITS):
        x = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        self.mean = x.mean(axis=0)
        x = x - self.mean
        axes = np.linalg.svd(x, full_matrices=False)[2]
        rng = np.random.default_rng(7)
        if len(axes) < bits:  # fewer dimensions than bits: random directions fill up
            axes = np.vstack([axes, rng.standard_normal((bits - len(axes), x.shape[1]))])
        v = x @ axes[:bits].T
        turn = np.linalg.qr(rng.standard_normal((bits, bits)))[0]
        for _ in range(TURNS):
            u, _, w = np.linalg.svd(np.where(v @ turn > 0, 1.0, -1.0).T @ v)
            turn = (u @ w).T
        self.map = axes[:bits].T @ turn

    def codes(self, x: np.ndarray) -> np.ndarray:
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        return np.packbits((x - self.mean) @ self.map > 0, axis=1).view(">u8").ravel().astype("uint64")


def substrings(codes: np.ndarray) -> np.ndarray:
    """The parts of each code, one row per part."""
    return np.stack([(codes >> np.uint64(WIDTH * p) & np.uint64((1 << WIDTH) - 1)).astype("int64") for p in range(PARTS)])


def masks(reach: int) -> np.ndarray:
    """All numbers of ``WIDTH`` bits with at most ``reach`` bits set."""
    return np.array([sum(1 << b for b in c) for d in range(reach + 1) for c in combinations(range(WIDTH), d)], dtype="int64")


class Shard:
    """The substring tables of some codes."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.tables = codes, []
        for sub in substrings(codes):
            order = np.argsort(sub, kind="stable")
            values, first = np.unique(sub[order], return_index=True)
            self.tables.append((order, values, np.append(first, len(sub))))

    def within(self, code: np.ndarray, radius: int, flips: np.ndarray | None) -> np.ndarray:
        """Rows whose code differs from ``code`` in at most ``radius`` bits, each once.

        ``flips`` are the masks of the probes; without them (more probes than table
        entries) the probes are the entries near enough.
        """
        reach, found = radius // PARTS, []
        for own, (order, values, first) in zip(substrings(code.reshape(1))[:, 0], self.tables):
            if flips is None:
                at = np.nonzero(np.bitwise_count(values ^ own) <= reach)[0]
            else:
                probes = own ^ flips
                at = np.searchsorted(values, probes)
                at = at[(at < len(values)) & (values[np.minimum(at, len(values) - 1)] == probes)]
            n = first[at + 1] - first[at]
            found.append(order[np.repeat(first[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())])
        rows = np.unique(np.concatenate(found))
        return rows[np.bitwise_count(self.codes[rows] ^ code) <= radius]


def usable(vectors: DataFrame, ident: str, vector: str) -> DataFrame:
    """(id, v): vectors that are not null, not zero and hold only finite components."""
    v = F.col(vector).cast("array<double>")
    return (vectors.select(F.col(ident).cast("long").alias("id"), v.alias("v"))
            .where(F.col("id").isNotNull() & (F.size("v") > 0)
                   & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
                   & F.exists("v", lambda c: c != 0)))


def _matrix(col) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def encoded(rows: DataFrame, sample: int = SAMPLE) -> DataFrame | None:
    """(id, v, code) of all rows as a table; None without rows.

    Vectors of another length than the most common one cannot be compared and are left out.
    """
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if sizes is None:
        return None
    rows = rows.where(F.size("v") == sizes["d"])
    few = rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").toArrow()["v"].combine_chunks()
    coder = rows.sparkSession.sparkContext.broadcast(Coder(_matrix(few)))  # 64 x dimension numbers

    def run(batches):
        for b in batches:
            if b.num_rows:
                codes = coder.value.codes(_matrix(b["v"]))
                yield pa.RecordBatch.from_arrays([b["id"], b["v"], pa.array(codes.view("int64"))], names=["id", "v", "code"])

    return written(rows.mapInArrow(run, "id long, v array<double>, code long"), "ann-codes")


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _search(index: DataFrame, queries, k: int, radius: int) -> DataFrame:
    """(query_id, vec_id, score): for each task the best k of each query of the block."""
    few = masks(radius // PARTS)

    def run(batches):
        qid, qv, qcode = queries.value
        norms = np.sqrt((qv * qv).sum(axis=1))
        best_ids = [np.zeros(0, dtype="int64")] * len(qid)
        best = [np.zeros(0)] * len(qid)
        for b in batches:
            if not b.num_rows:
                continue
            ids, x = b["id"].to_numpy(), _matrix(b["v"])
            size = np.sqrt((x * x).sum(axis=1))
            shard = Shard(b["code"].to_numpy().view("uint64"))
            flips = few if len(few) < b.num_rows else None
            for i in range(len(qid)):
                rows = shard.within(qcode[i], radius, flips)
                rows = rows[ids[rows] != qid[i]]
                # row sums do not depend on a row's place, so equal vectors get equal scores
                scores = (x[rows] * qv[i]).sum(axis=1) / (size[rows] * norms[i])
                all_ids, all_scores = np.append(best_ids[i], ids[rows]), np.append(best[i], scores)
                top = _best(all_ids, all_scores, k)
                best_ids[i], best[i] = all_ids[top], all_scores[top]
        n = [len(x) for x in best]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(qid, n), pa.int64()), pa.array(np.concatenate([*best_ids, np.zeros(0, "int64")]), pa.int64()),
             pa.array(np.concatenate([*best, np.zeros(0)]), pa.float64())], names=["query_id", "vec_id", "score"])

    found = index.mapInArrow(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _blocks(queries: DataFrame):
    """The queries (distinct ids) in broadcast blocks."""
    n = max(1, -(-queries.count() // QUERY_BLOCK))
    for i in range(n):
        part = queries.where(F.pmod(F.xxhash64("id"), F.lit(n)) == i).dropDuplicates(["id"]).orderBy("id").toArrow()
        if part.num_rows:
            yield queries.sparkSession.sparkContext.broadcast(
                (part["id"].to_numpy(), _matrix(part["v"].combine_chunks()), part["code"].to_numpy().view("uint64")))


def neighbours(vectors: DataFrame, every: int = 50, k: int = 5, radius: int = RADIUS,
               ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for rows whose id is divisible by ``every`` the k nearest others.

    Nearest first by cosine, ties to the smaller id. Vectors that are null, zero,
    empty or hold null or non-finite components, and rows with a null id, take
    no part. Rows that share the query's id are its own; other repeated rows are
    candidates each. Fewer than k candidates: all of them. Other columns are
    not read; an empty table gives an empty result.
    """
    empty = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = encoded(usable(vectors, ident, vector))
    if index is None:
        return empty
    queries = index.where(F.pmod("id", F.lit(every)) == 0)
    parts = [cut(_search(index, block, k, radius)) for block in _blocks(queries)]
    if not parts:
        return empty
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    full = found.groupBy("query_id").count().where(F.col("count") >= k).select(F.col("query_id").alias("id"))
    rest = cut(queries.join(full, "id", "left_anti"))
    if not rest.isEmpty():
        found = found.join(rest.select(F.col("id").alias("query_id")).distinct(), "query_id", "left_anti")
        for block in _blocks(rest):
            found = found.unionByName(cut(_search(index, block, k, BITS)))
    return found.select("query_id", "rank", "vec_id", "score")
