"""Merkle manifest of a dataset, in blocks that are stored in van Emde Boas order.

Leaves are digests of rows. The leaves of a group (a language) stand in the order
of their ids; every two consecutive nodes become their parent until one is left.
Aligned runs of 2^HEIGHT leaves are one block: a task builds the block's subtree
and keeps its digests in one array. That array is laid out recursively: the upper
half of the levels first, then each lower subtree as a stretch of its own, so a
path from leaf to root touches few stretches at any cache or page size. The place
of a node follows from its level and number alone (``addresses``); building and
finding siblings use the same arithmetic. The block roots are the leaves of the
next tier, until each group has one root; the groups' roots are one more tree.

Proofs go the other way: a block appends the siblings that its root got above to
those it finds inside, so a row per block, not per document, meets the tier
above. Texts are hashed where they are read and never shuffled.
"""

from __future__ import annotations

from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsarc.llm.common import cut, with_positions

HEIGHT = 12                 # a block has at most 4,096 leaves
MOST_GROUPS = 20_000        # groups up to which their table (three numbers and a name each) is broadcast
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED = 7
LONE = ""                   # a path's step without a sibling


@lru_cache(maxsize=64)
def addresses(height: int) -> tuple[np.ndarray, ...]:
    """Places of the nodes of a full tree by level (0: the root), in van Emde Boas order."""
    levels = height + 1
    if levels == 1:
        return (np.zeros(1, dtype="int64"),)
    upper = levels // 2
    lower = levels - upper
    top, below = addresses(upper - 1), addresses(lower - 1)
    out = list(top)
    for level in range(lower):
        number = np.arange(1 << (upper + level))
        subtree, inside = number >> level, number & ((1 << level) - 1)
        out.append((1 << upper) - 1 + subtree * ((1 << lower) - 1) + below[level][inside])
    return tuple(out)


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


class Block:
    """A subtree of ``height`` over its leaves (hex digests); missing leaves are at the end."""

    def __init__(self, height: int, count: int, nodes: bytearray | bytes):
        self.height, self.nodes = height, nodes
        self.counts = [max(1, -(-count // (1 << (height - level)))) for level in range(height + 1)]

    @classmethod
    def build(cls, leaves: list[str], height: int) -> "Block":
        block = cls(height, len(leaves), bytearray(32 * ((2 << height) - 1)))
        row = leaves
        for level in range(height, -1, -1):
            for number, node in enumerate(row):
                at = 32 * int(addresses(height)[level][number])
                block.nodes[at:at + 32] = bytes.fromhex(node)
            if level:
                row = [digest(*row[k:k + 2]) for k in range(0, len(row), 2)]
        return block

    def node(self, level: int, number: int) -> str:
        at = 32 * int(addresses(self.height)[level][number])
        return bytes(self.nodes[at:at + 32]).hex()

    def path(self, leaf: int) -> list[str]:
        """Siblings from the leaf to the root: L or R (their side) and the digest; LONE where there is none."""
        out = []
        for level in range(self.height, 0, -1):
            number = leaf >> (self.height - level)
            other = number ^ 1
            out.append(LONE if other >= self.counts[level] else "RL"[number & 1] + self.node(level, other))
        return out


def fold(leaf: str, path: list[str]) -> str:
    """The root that a leaf and its siblings give."""
    for step in path:
        leaf = digest(step[1:], leaf) if step[:1] == "L" else digest(leaf, step[1:])
    return leaf


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(*values: Column) -> Column:
    """SHA-256 of the values, each behind its length; null is a dash."""
    return F.sha2(F.concat(*map(_field, values)), 256)


def _tier(leaves: DataFrame, height: int) -> DataFrame:
    """Blocks (g, size, block, height, count, nodes, root, members) of (g, size, pos, leaf, extra).

    ``size`` is the number of leaves of the group. A group's only block has the height its
    leaves need; one of several blocks has the full height, whatever it holds.
    """
    schema = "g long, size long, block long, height int, count int, nodes binary, root string"
    extra = leaves.schema["extra"].dataType.simpleString()
    members = f"array<struct<pos:bigint,leaf:string,extra:{extra}>>"
    rows = (leaves.withColumn("block", F.shiftright("pos", height)).groupBy("g", "size", "block")
            .agg(F.sort_array(F.collect_list(F.struct("pos", "leaf", "extra"))).alias("members")))   # at most 2^height

    def run(batches):
        for b in batches:
            for k in range(b.num_rows):   # one block in memory at a time
                row = b.slice(k, 1)
                digests = row["members"].flatten().field("leaf").to_pylist()
                size = row["size"][0].as_py()
                high = height if size > 1 << height else (size - 1).bit_length()
                block = Block.build(digests, high)
                yield pa.RecordBatch.from_arrays(
                    [row["g"], row["size"], row["block"], pa.array([high], pa.int32()), pa.array([len(digests)], pa.int32()),
                     pa.array([bytes(block.nodes)], pa.binary()), pa.array([block.node(0, 0)], pa.string()), row["members"]],
                    names=["g", "size", "block", "height", "count", "nodes", "root", "members"])

    return rows.mapInArrow(run, f"{schema}, members {members}")


def tiers(leaves: DataFrame, height: int, most: int) -> list[DataFrame]:
    """The blocks of each tier; ``most`` is the size of the largest group."""
    out = [cut(_tier(leaves, height))]
    while most > 1 << height:
        most = -(-most // (1 << height))
        roots = (out[-1].where(F.col("size") > 1 << height)
                 .select("g", F.shiftright(F.col("size") + ((1 << height) - 1), height).alias("size"), F.col("block").alias("pos"),
                         F.col("root").alias("leaf"), F.lit(0).alias("extra")))
        out.append(cut(_tier(roots, height)))
    return out


def tops(blocks: list[DataFrame], height: int) -> DataFrame:
    """(g, root): each group's root."""
    out = None
    for tier in blocks:
        part = tier.where(F.col("size") <= 1 << height).select("g", "root")
        out = part if out is None else out.unionByName(part)
    return out


def _paths(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """(g, block, path, subroot, top) of a tier's leaves; ``above`` has the same of its blocks."""
    both = blocks.select("g", "block", "height", "count", "nodes").join(above, ["g", "block"])

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                block = Block(r["height"], r["count"], r["nodes"])
                n = r["count"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["g"]] * n, pa.int64()), pa.array([(r["block"] << r["height"]) + k for k in range(n)], pa.int64()),
                     pa.array([block.path(k) + r["path"] for k in range(n)], pa.list_(pa.string())),
                     pa.array([r["subroot"]] * n, pa.string()), pa.array([r["top"]] * n, pa.string())],
                    names=["g", "block", "path", "subroot", "top"])

    return both.mapInArrow(run, "g long, block long, path array<string>, subroot string, top string")


def descend(blocks: list[DataFrame], groups: DataFrame, height: int) -> DataFrame:
    """(g, block, path, subroot, top) for the first tier's blocks, from the groups' (g, path, subroot, top)."""
    above = None
    for tier in reversed(blocks):
        own = (tier.where(F.col("size") <= 1 << height).select("g", "block").join(groups, "g")
               .select("g", "block", "path", "subroot", "top"))
        above = own if above is None else own.unionByName(above)
        if tier is not blocks[0]:
            above = cut(_paths(tier, above))
    return above


def _placed(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``at``, their place in the whole order."""
    ranged, first = with_positions(rows, *order)
    starts = rows.sparkSession.createDataFrame(sorted(first.items()), "pid int, _start long")   # a row per range
    return (ranged.join(F.broadcast(starts), "pid")
            .withColumn("at", F.col("_start") + F.col("idx")).drop("pid", "idx", "_start"))


def leaves_of(docs: DataFrame, group: str = "lang", ident: str = "doc_id", columns: tuple[str, ...] = COLUMNS,
              bumped: str = "n_chars", every: int = TAMPERED) -> DataFrame:
    """(grp, id, leaf, changed): ``changed`` is the tampered row's digest, null where nothing was changed.

    Tampering adds one to ``bumped`` (a null stays) in the rows whose id's checksum ``every`` divides.
    """
    own = [F.col(f"`{c}`") for c in columns]
    more = [F.col(f"`{c}`").cast("decimal(38,0)") + 1 if c == bumped else F.col(f"`{c}`") for c in columns]
    hit = (F.pmod(F.crc32(F.col(f"`{ident}`").cast("string").cast("binary")), F.lit(every)) == 0) & F.col(f"`{bumped}`").isNotNull()
    return docs.select(F.col(f"`{group}`").alias("grp"), F.col(f"`{ident}`").alias("id"), row_digest(*own).alias("leaf"),
                       F.when(hit, row_digest(*more)).alias("changed"))


def manifest(leaves: DataFrame, height: int = HEIGHT) -> tuple[list[DataFrame], list[DataFrame], DataFrame]:
    """Blocks of the groups' trees, blocks of the tree over the groups, and the groups' places and sizes.

    Leaves of a group are ordered by id (null first), equal ids by their digests; groups by name (null
    first). The blocks are checkpointed; ``nodes`` is the subtree in van Emde Boas order, 32 bytes a digest.
    """
    placed = _placed(cut(leaves), "grp", "id", "leaf")
    sizes = placed.groupBy("grp").agg(F.min("at").alias("first"), F.count("*").alias("size"))
    groups = cut(_placed(sizes, "grp").select(F.col("grp").alias("_grp"), "first", "size", F.col("at").alias("g")))
    total, most = groups.agg(F.count("*"), F.max("size")).first()
    small = F.broadcast(groups) if total <= MOST_GROUPS else groups
    rows = (placed.join(small, F.col("grp").eqNullSafe(F.col("_grp")))
            .select("g", "size", (F.col("at") - F.col("first")).alias("pos"), "leaf", F.struct("id", "changed").alias("extra")))
    below = tiers(rows, height, most or 0)
    heads = tops(below, height).select(F.lit(0).cast("long").alias("g"), F.lit(total).cast("long").alias("size"),
                                       F.col("g").alias("pos"), F.col("root").alias("leaf"), F.lit(0).alias("extra"))
    return below, tiers(heads, height, total), groups


def proofs(below: list[DataFrame], over: list[DataFrame], height: int = HEIGHT) -> DataFrame:
    """id, leaf, subroot, root, proof_sha256, folded_root and verified of each leaf of a manifest."""
    top = (tops(over, height).withColumnRenamed("root", "top")
           .select("g", F.array().cast("array<string>").alias("path"), F.lit(None).cast("string").alias("subroot"), "top"))
    heads = tops(below, height).select("g", F.col("root").alias("_own"))
    groups = (_paths(over[0], descend(over, top, height)).drop("g", "subroot").withColumnRenamed("block", "g")
              .join(heads, "g").withColumnRenamed("_own", "subroot"))
    both = below[0].select("g", "block", "height", "count", "nodes", "members").join(
        descend(below, cut(groups), height), ["g", "block"])
    kind = next(f.dataType for f in below[0].schema["members"].dataType.elementType["extra"].dataType if f.name == "id")

    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                row = b.slice(k, 1)
                r = row.select(["height", "count", "nodes", "path", "subroot", "top"]).to_pylist()[0]
                block = Block(r["height"], r["count"], r["nodes"])
                members = row["members"].flatten()
                extra = members.field("extra")
                leaf, changed = members.field("leaf").to_pylist(), extra.field("changed").to_pylist()
                proof, folded = [], []
                for n in range(r["count"]):
                    path = block.path(n) + r["path"]
                    proof.append(digest(*(step[1:] for step in path)))
                    folded.append(fold(changed[n] or leaf[n], path))
                n = r["count"]
                yield pa.RecordBatch.from_arrays(
                    [extra.field("id"), pa.array(leaf, pa.string()), pa.array([r["subroot"]] * n, pa.string()),
                     pa.array([r["top"]] * n, pa.string()), pa.array(proof, pa.string()), pa.array(folded, pa.string()),
                     pa.array([f == r["top"] for f in folded], pa.bool_())],
                    names=["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return both.mapInArrow(run, f"id {kind.simpleString()}, leaf string, subroot string, root string, "
                                "proof_sha256 string, folded_root string, verified boolean")


def audit(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of each document.

    Null fields are dashes in the digest, so null and empty texts differ. A null
    language is the first group, null ids stand first in theirs and are never
    tampered with; rows with the same id are leaves of their own, in the order of
    their digests. Other columns are not read. One document is its own root and an
    empty table gives an empty result.
    """
    below, over, _ = manifest(leaves_of(docs), height)
    return proofs(below, over, height).withColumnRenamed("id", "doc_id")
