"""SimHash near-duplicates found by covering locality-sensitive hashing.

A radius r takes the 2^(r+1)-1 masks <m(i), v> over GF(2): every bit i carries a
non-zero vector m(i) of r+1 bits, mask v keeps the bits with odd <m(i), v>. Any
r bit positions leave a non-zero v orthogonal to all of them, so two
fingerprints that differ in at most r bits agree under at least one mask: no
pair within the radius is missed.

Exact copies are folded first (one row per distinct fingerprint). A bucket of at
most ``SMALL`` fingerprints is compared pair by pair. A larger one is linked
without pairs: two fingerprints are within distance 2 exactly if some middle
point is within distance 1 of both, so each fingerprint names its middle points
inside the mask's free bits, and those that share one (at most 65) form a star.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsarc.llm.common import blank_words, cut, row_name

RADIUS = 2
SMALL = 48
SHINGLE = 3
SEED = 42


def covering_masks(radius: int = RADIUS) -> list[int]:
    """The 2^(radius+1)-1 masks of 64 bits, as unsigned integers."""
    vectors = (1 << (radius + 1)) - 1
    return [sum(1 << i for i in range(64) if bin((1 + i % vectors) & v).count("1") % 2)
            for v in range(1, vectors + 1)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprint(text: str | None, shingle: int = SHINGLE, block: int = 1 << 15) -> int:
    """Signed 64-bit SimHash of the word shingles' XXH64; zero without words."""
    from xxhash import xxh64_intdigest

    words = blank_words(text)
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, dtype="int64")
    for a in range(0, n, block):
        part = words[a:a + block + shingle - 1]
        if len(part) <= shingle:
            hashes = [xxh64_intdigest(b" ".join(part), SEED)]
        else:
            runs = zip(*(part[k:] for k in range(shingle)))
            hashes = list(map(xxh64_intdigest, map(b" ".join, runs), repeat(SEED)))
        bits = np.unpackbits(np.array(hashes, dtype=">u8").view("u1").reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype="int64")
    return int(np.packbits(counts * 2 > n).view(">i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", ident: str = "doc_id", shingle: int = SHINGLE,
                 keys: bool = False) -> DataFrame:
    """(doc_id, fp): one row per document; with ``keys`` also ``k``, the row's name (``common.row_name``)."""
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b[0], *b.columns[2:], pa.array([fingerprint(t.as_py(), shingle) for t in b[1]], pa.int64())],
                names=["doc_id", *b.schema.names[2:], "fp"])

    more = [row_name(F.col(f"`{ident}`"), F.col(f"`{text}`")).alias("k")] if keys else []
    return docs.select(F.col(ident).cast("long").alias("doc_id"), text, *more).mapInArrow(
        run, f"doc_id long, {'k string, ' if keys else ''}fp long")


def links(points: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b), a < b: links that connect exactly the fingerprints within the radius.

    ``points`` has distinct ``fp``. Radius 2 or less (the middle-point star covers
    that); the links of a large bucket are a star per middle point, not all pairs.
    """
    if radius > 2:
        raise ValueError("the exact way for large buckets covers a radius of at most 2")
    masks = covering_masks(radius)
    keys = F.array(*[F.struct(F.lit(v).alias("v"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("k"))
                     for v, m in enumerate(masks)])
    rows = points.select("fp", F.explode(keys).alias("t")).select("t.v", "t.k", "fp")
    sizes = cut(rows.groupBy("v", "k").count().where("count > 1"))
    # both sides are plain exchanges below the join, so a hot bucket is split by measured size
    shared = rows.join(sizes.hint("shuffle_merge"), ["v", "k"])
    near = lambda x, y: F.bit_count(x.bitwiseXOR(y)) <= radius

    # a bucket of at most SMALL members: each later member against the earlier ones
    small = (shared.where(F.col("count") <= SMALL).groupBy("v", "k").agg(F.sort_array(F.collect_list("fp")).alias("m"))
             .select(F.explode(F.expr("m")).alias("a"), "m")
             .select("a", F.explode(F.filter("m", lambda x: (x > F.col("a")) & near(x, F.col("a")))).alias("b")))

    # a larger bucket: middle points = itself and one flipped free bit
    free = [[0, *[signed(1 << i) for i in range(64) if not m >> i & 1]] for m in masks]
    flips = F.element_at(F.array(*[F.array(*[F.lit(x).cast("long") for x in f]) for f in free]), F.col("v") + 1)
    stars = (shared.where(F.col("count") > SMALL)
             .select("fp", F.explode(F.transform(flips, lambda x: F.col("fp").bitwiseXOR(x))).alias("z"))
             .groupBy("z").agg(F.collect_set("fp").alias("m")).where(F.size("m") > 1)  # at most 65 members
             .select(F.array_min("m").alias("a"), F.explode("m").alias("b")).where("a < b"))
    return small.unionByName(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each node's component, by alternating large and small stars."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e if not large else e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # small star: a is the larger end
        least = cut(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        out = both.join(least.hint("shuffle_merge"), "a")
        if large:
            out = out.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = (out.select(F.col("b").alias("a"), F.col("m").alias("b"))
                   .unionByName(least.select("a", F.col("m").alias("b"))))
        return out.where("a > b").distinct()

    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct())
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    before = None
    while True:
        edges = cut(star(cut(star(edges, True)), False))
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select("root").distinct().select(F.col("root").alias("node"), "root"))


def near_duplicates(docs: DataFrame, text: str = "text", ident: str = "doc_id",
                    shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per document.

    component_id is the smallest doc_id that is reachable over links, the
    document itself included. Null and empty texts and texts of blanks have no
    words and the fingerprint zero, which is linked like any other. A null doc_id
    never names a component unless all its members have none. Repeated rows stay
    rows. Other columns are not read; an empty table gives an empty result.
    """
    prints = cut(fingerprints(docs, text, ident, shingle))
    points = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = cut(components(links(points.select("fp"), radius)))
    merged = roots.withColumnRenamed("node", "fp").join(points, "fp")
    first = merged.groupBy("root").agg(F.min("first").alias("component"))
    named = cut(roots.join(first, "root").select(F.col("node").alias("fp"), "component"))
    names = cut(points.join(named, "fp", "left").select("fp", F.coalesce("component", "first").alias("component_id")))
    return (prints.join(names.hint("shuffle_merge"), "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def representatives(docs: DataFrame, text: str = "text", ident: str = "doc_id",
                    shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(k): the row name (``common.row_name``) of the one document of each component that stays.

    That is the smallest doc_id, a null one last; among several texts under it the smallest name. Rows are
    told apart by id and text, so an id that stands at several texts is judged for each of them.
    """
    prints = cut(fingerprints(docs, text, ident, shingle, keys=True))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k")).alias("best")
    points = cut(prints.groupBy("fp").agg(best))   # copies first, before anything is shuffled by component
    roots = components(links(points.select("fp"), radius))
    named = points.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return (named.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("best").alias("best"))
            .select(F.col("best.k").alias("k")))
