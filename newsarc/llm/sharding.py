"""Sharding: minimax contiguous partition of ordered atomic groups.

Documents with equal text form one atomic group, the groups stand in the order
of their text's digest (so a shard is a mixture of the corpus, and no join is
needed to learn a group's place). The smallest capacity for which a greedy
walk needs at most ``n_shards`` shards is searched, and the order is cut there.

At scale the groups are a range-sorted table with running sums, never a list on
the driver. One step of the walk is one look-up "which group holds byte
position t"; a whole band of capacities walks at once, so the search needs a
few passes of ``n_shards - 1`` look-ups however many groups there are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsarc.llm.common import cut, with_positions, written

BAND = 1024  # capacities that are tried in one walk


class Groups:
    """The ordered groups with running sums as a sorted table; answers look-ups by byte position."""

    def __init__(self, groups: DataFrame):
        parts = cut(groups.repartitionByRange("digest").sortWithinPartitions("digest")
                    .withColumn("pid", F.spark_partition_id()))
        self.total = self.rows = self.largest = 0
        offsets: dict[int, tuple[int, int]] = {}
        for p in sorted(parts.groupBy("pid").agg(F.sum("bytes"), F.sum("rows"), F.max("bytes")).collect()):
            offsets[p[0]] = (self.total, self.rows)
            self.total, self.rows, self.largest = self.total + p[1], self.rows + p[2], max(self.largest, p[3])

        def running(batches):
            sums: dict[int, tuple[int, int]] = dict(offsets)
            for x in batches:
                for pid in np.unique(x["pid"].to_numpy()).tolist():
                    y = x.filter(pa.compute.equal(x["pid"], pid))
                    b, r = sums[pid]
                    ends = b + np.cumsum(y["bytes"].to_numpy(zero_copy_only=False))
                    rows = r + np.cumsum(y["rows"].to_numpy(zero_copy_only=False))
                    sums[pid] = (int(ends[-1]), int(rows[-1]))
                    yield pa.RecordBatch.from_arrays(
                        [y["digest"], pa.array(np.append(b, ends[:-1]), pa.int64()), pa.array(ends, pa.int64()),
                         pa.array(np.append(r, rows[:-1]), pa.int64())], names=["digest", "start", "end", "row"])

        # Parquet: small files are read together and sorted row groups are skipped
        self.df = written(parts.mapInArrow(running, "digest binary, start long, end long, row long"), "shard-groups")

    def at(self, targets: np.ndarray) -> dict[int, tuple[int, int, bytes]]:
        """For each byte position: start (bytes, rows) and digest of the group that holds it."""
        ts = np.unique(targets)

        def find(batches):
            for x in batches:
                start, end = x["start"].to_numpy(zero_copy_only=False), x["end"].to_numpy(zero_copy_only=False)
                n = np.searchsorted(ts, end, "left") - np.searchsorted(ts, start, "left")  # targets in [start, end)
                i = np.repeat(np.arange(len(n)), n)
                first = np.searchsorted(ts, start[i], "left")
                near = ts[first + (np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(near, pa.int64()), x["start"].take(pa.array(i)), x["row"].take(pa.array(i)),
                     x["digest"].take(pa.array(i))], names=["t", "start", "row", "digest"])

        got = (self.df.where((F.col("start") <= int(ts[-1])) & (F.col("end") > int(ts[0])))
               .mapInArrow(find, "t long, start long, row long, digest binary").collect())
        return {r["t"]: (r["start"], r["row"], bytes(r["digest"])) for r in got}


def walk(groups: Groups, caps: np.ndarray, n_shards: int) -> list[list[tuple[int, bytes]] | None]:
    """Greedy walk for each capacity: its cuts as (first row, first digest), or None if it needs more shards."""
    at = np.zeros(len(caps), dtype="int64")
    cuts: list[list[tuple[int, bytes]]] = [[] for _ in caps]
    for _ in range(n_shards - 1):
        going = np.nonzero(at + caps < groups.total)[0]
        if not len(going):
            break
        found = groups.at((at + caps)[going])
        for i in going:
            start, row, digest = found[int(at[i] + caps[i])]
            at[i] = start
            cuts[i].append((row, digest))
    return [c if a + cap >= groups.total else None for c, a, cap in zip(cuts, at, caps)]


def minimax_cuts(groups: Groups, n_shards: int) -> tuple[int, list[tuple[int, bytes]]]:
    """The smallest feasible capacity and its cuts."""
    mean = -(-groups.total // n_shards)
    low, high = max(groups.largest, mean), mean + groups.largest  # high: each full shard holds more than the mean
    best = None
    while best is None or low < high:
        caps = np.unique(np.linspace(low, high, BAND).astype("int64"))
        walks = walk(groups, caps, n_shards)
        i = next(i for i, c in enumerate(walks) if c is not None)
        best, high = walks[i], int(caps[i])
        low = int(caps[i - 1]) + 1 if i else high
    return high, best


def shard(docs: DataFrame, n_shards: int = 16, text: str = "text", order: str = "doc_id") -> DataFrame:
    """``docs`` (without the text) plus size, text_crc32, digest, shard, slot and capacity.

    size is the UTF-8 length plus one. Null texts have no bytes, no checksum and
    are one group of their own, apart from empty texts. Slots count from 0 within
    a shard in the order of (digest, ``order``); repeated rows take neighbouring
    slots. An empty table gives an empty result. With fewer groups than shards
    the last shards stay empty. Columns of ``docs`` that clash with the added
    names are replaced.
    """
    added = ["size", "text_crc32", "digest", "shard", "slot", "capacity", "pid", "idx"]
    keep = [c for c in docs.columns if c != text and c not in added]
    t = F.col(text)
    rows = docs.select(*[F.col(f"`{c}`") for c in keep],
                       (F.coalesce(F.octet_length(t), F.lit(0)) + 1).cast("long").alias("size"),
                       F.crc32(F.encode(t, "UTF-8")).alias("text_crc32"),
                       F.coalesce(F.unhex(F.sha2(t, 256)), F.lit(b"")).alias("digest"))
    rows, first = with_positions(rows, "digest", order)
    if not first:
        return rows.select("*", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"),
                           F.lit(0).cast("long").alias("capacity")).drop("pid", "idx")
    groups = Groups(rows.groupBy("digest").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")))
    capacity, cuts = minimax_cuts(groups, n_shards)
    number = F.lit(0)
    for _, digest in cuts:
        number = number + (F.col("digest") >= F.lit(digest)).cast("int")
    starts = F.array(*[F.lit(n).cast("long") for n in [0, *[row for row, _ in cuts]]])
    # one entry per range of the sort; as bounded as the number of partitions
    base = F.array(*[F.lit(first.get(p, 0)).cast("long") for p in range(max(first) + 1)])
    return (rows.withColumn("shard", number)
            .withColumn("slot", F.get(base, F.col("pid")) + F.col("idx") - F.get(starts, F.col("shard")))
            .withColumn("capacity", F.lit(capacity).cast("long")).drop("pid", "idx"))
