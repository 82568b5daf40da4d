"""Benchmark decontamination with suffix arrays over shards of the training text.

Words become numbers of the benchmark's vocabulary (0: any other word). Each
task strings its documents into shards of at most ``SHARD_WORDS`` words and sorts
the shard's suffixes; every test suffix is binary-searched in it. The range it
finds holds all places where its first ``window`` words occur verbatim, and the
matches are then followed to their full length. Suffixes that meet another
word, or the document's end, before the shortest window cannot match and are
left out of the array.

The benchmark is read in blocks of ``BLOCK_BYTES`` (by hash of the item). One block
is broadcast at a time: where there are several, the documents and what was found
in them are cut behind each block but the last, and its broadcast is given up, so
no worker holds two. Nothing is shuffled, and no group of documents ever meets in
one task.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsarc.llm.common import alnum_words, cut

WINDOW = 10
SHARD_WORDS = 1 << 18
BLOCK_BYTES = 8 << 20
MATCH = "struct<start:int,length:int,item_id:string,item_start:int>"


class TestBlock:
    """The test suffixes of one block of items: ids, windows and who holds them."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        vocab: dict[bytes, int] = {}
        texts = [(i, [vocab.setdefault(w, len(vocab) + 1) for w in alnum_words(t)]) for i, t in items]
        self.vocab, self.window = vocab, window
        at, flat = 0, []
        by_window: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        self.items, self.ends, self.starts = [], [], []
        for ident, ids in sorted(texts, key=lambda x: x[0]):
            if not ids:
                continue
            k = len(self.items)
            self.items.append(ident)
            self.starts.append(at)
            flat += ids
            at += len(ids)
            self.ends.append(at)
            for o in range(max(1, len(ids) - window + 1)):
                by_window.setdefault(tuple(ids[o:o + window]), []).append((k, o))
        self.flat = np.array(flat, dtype="uint32")
        self.windows = sorted(by_window)
        self.lengths = np.array([len(w) for w in self.windows], dtype="int64")
        self.places = [by_window[w] for w in self.windows]
        low = np.zeros((len(self.windows), window), dtype=">u4")
        high = np.full((len(self.windows), window), 0xFFFFFFFF, dtype=">u4")
        for r, w in enumerate(self.windows):
            low[r, :len(w)] = high[r, :len(w)] = w
        self.low, self.high = _keys(low), _keys(high)

    @property
    def shortest(self) -> int:
        return int(self.lengths.min())


def _keys(rows: np.ndarray) -> np.ndarray:
    """Rows of big-endian numbers as byte strings, which sort like the rows."""
    rows = np.ascontiguousarray(rows, dtype=">u4")
    return rows.view(f"S{rows.shape[1] * 4}").ravel()


def suffix_array(words: np.ndarray, window: int, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Start places of the suffixes in sorted order, and their sorted keys (first ``window`` words)."""
    n = len(words)
    stops = np.append(np.nonzero(words == 0)[0], n)
    run = stops[np.searchsorted(stops, np.arange(n))] - np.arange(n)  # known words from here on
    starts = np.nonzero(run >= shortest)[0]
    padded = np.concatenate([words, np.zeros(window, dtype=words.dtype)])
    rows = padded[starts[:, None] + np.arange(window)].astype("uint32")
    beyond = np.arange(window) >= run[starts][:, None]
    rows[beyond] = 0
    keys = _keys(rows)
    order = np.argsort(keys, kind="stable")
    return starts[order], keys[order]


def matches(words: np.ndarray, test: TestBlock) -> tuple[np.ndarray, list[tuple[int, int, int, int]]]:
    """Hit words, and the left-maximal verbatim matches (start, length, item number, item start).

    Each test suffix is searched by its window; places where also the preceding
    word agrees belong to a longer match of an earlier suffix.
    """
    hit = np.zeros(len(words) + 1, dtype="int64")
    found: list[tuple[int, int, int, int]] = []
    starts, keys = suffix_array(words, test.window, test.shortest)
    if not len(starts):
        return hit[:-1].astype(bool), found
    low, high = np.searchsorted(keys, test.low, "left"), np.searchsorted(keys, test.high, "right")
    for q in np.nonzero(high > low)[0]:
        at = np.sort(starts[low[q]:high[q]])
        size = int(test.lengths[q])
        hit[at] += 1  # places are distinct
        hit[at + size] -= 1
        for k, o in test.places[q]:
            base = test.starts[k] + o
            first = at if o == 0 else at[(at == 0) | (words[at - 1] != test.flat[base - 1])]
            length = np.full(len(first), size, dtype="int64")
            going = np.arange(len(first))
            step = size
            while len(going) and base + step < test.ends[k]:
                inside = going[first[going] + step < len(words)]
                going = inside[words[first[inside] + step] == test.flat[base + step]]
                length[going] = step + 1
                step += 1
            found += [(int(p), int(n), k, o) for p, n in zip(first, length)]
    return np.cumsum(hit[:-1]) > 0, found


def _pass(docs: DataFrame, text: str, block, window: int) -> DataFrame:
    """Adds this block's hit spans and matches to ``spans`` and ``matches``."""
    schema = docs.schema

    def run(batches):
        test: TestBlock = block.value
        vocab = test.vocab.get
        for b in batches:
            col, at = b.schema.get_field_index(text), 0
            while at < b.num_rows:
                shard, ends, counts = [], [], []
                total, row = 0, at
                while row < b.num_rows and (total < SHARD_WORDS or row == at):
                    found = alnum_words(b[col][row].as_py())
                    ids = np.fromiter(map(vocab, found, repeat(0)), dtype="uint32", count=len(found))
                    shard += [ids, np.zeros(1, dtype="uint32")]
                    counts.append(len(found))
                    total += len(found) + 1
                    ends.append(total)
                    row += 1
                words = np.concatenate(shard)
                hit, got = matches(words, test)
                yield _answer(b.slice(at, row - at), schema, np.array(ends), np.array(counts), hit, got, test)
                at = row

    return docs.mapInArrow(run, schema)


def _answer(b, schema, ends, counts, hit, got, test) -> pa.RecordBatch:
    starts = ends - counts - 1
    edge = np.diff(np.concatenate([[0], hit.astype("int8"), [0]]))
    rise, fall = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
    doc = np.searchsorted(ends, rise, "right")
    spans = [[] for _ in counts]
    for d, a, z in zip(doc.tolist(), rise.tolist(), fall.tolist()):
        spans[d].append({"start": a - int(starts[d]), "length": z - a})
    lists = [[] for _ in counts]
    for p, n, k, o in sorted(got):
        d = int(np.searchsorted(ends, p, "right"))
        lists[d].append({"start": p - int(starts[d]), "length": n, "item_id": test.items[k], "item_start": o})
    cols = {name: b[i] for i, name in enumerate(b.schema.names)}
    cols["_n_words"] = pa.array(counts, pa.int64())
    cols["_spans"] = pa.array([(x or []) + y for x, y in zip(cols["_spans"].to_pylist(), spans)], SPANS)
    cols["_matches"] = pa.array([(x or []) + y for x, y in zip(cols["_matches"].to_pylist(), lists)], MATCHES)
    return pa.RecordBatch.from_arrays([cols[f.name] for f in schema], names=[f.name for f in schema])


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))
MATCHES = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()),
                              ("item_id", pa.string()), ("item_start", pa.int32())]))


def blocks(benchmark: DataFrame, text: str, ident: str, window: int):
    """The benchmark's items in blocks of about ``BLOCK_BYTES``, one at a time; ids are strings from here on."""
    rows = benchmark.select(F.col(ident).cast("string").alias("i"), F.col(text).alias("t")).where("t is not null and i is not null")
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-size // BLOCK_BYTES))
    for k in range(n):
        items = [(r["i"], r["t"]) for r in rows.where(F.pmod(F.xxhash64("i"), F.lit(n)) == k).collect()]
        block = TestBlock(items, window) if items else None
        if block is not None and len(block.windows):
            yield block


def overlap(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", ident: str = "doc_id",
            item_text: str = "text", item_ident: str = "item_id", prefix: str = "") -> DataFrame:
    """``docs`` plus n_words, n_hit, spans, matches, item_ids, longest and contaminated.

    spans are the hit words as (start, length) per benchmark block; matches are the
    left-maximal verbatim matches with their item and the place in it, each in
    full length; longest is the longest of them. A null or empty text has no
    words; null items and items without words have no window; items of fewer
    words than the window are one window. Item ids may be of any type. Repeated items count once by
    item_id, repeated documents are judged each. An empty benchmark hits nothing. Columns
    of ``docs`` that clash with the added names (``prefix`` stands before each) are replaced.
    """
    added = [prefix + x for x in ("n_words", "n_hit", "spans", "matches", "item_ids", "longest", "contaminated")]
    own = [c for c in docs.columns if c not in added]
    spans_type = "array<struct<start:int,length:int>>"
    out = docs.select(*[F.col(f"`{c}`") for c in own], F.lit(None).cast("long").alias("_n_words"),
                      F.array().cast(spans_type).alias("_spans"), F.array().cast(f"array<{MATCH}>").alias("_matches"))
    sc, any_block = docs.sparkSession.sparkContext, False
    live = None
    for block in blocks(benchmark, item_text, item_ident, window):
        if live is not None:   # what the block before has found is written, then its broadcast goes
            out = cut(out)
            live.unpersist()
        live = sc.broadcast(block)
        out, any_block = _pass(out, text, live, window), True
    out = out.withColumn("_matches", F.col("_matches").cast(
        f"array<{MATCH.replace('item_id:string', 'item_id:' + benchmark.schema[item_ident].dataType.simpleString())}>"))
    if not any_block:
        out = out.withColumn("_n_words", F.size(F.expr(
            f"filter(split(regexp_replace(coalesce(`{text}`, ''), '[\\\\x00-\\\\x2F\\\\x3A-\\\\x40\\\\x5B-\\\\x60\\\\x7B-\\\\x7F]+', ' '), ' '), x -> x != '')")).cast("long"))
    # spans of several blocks may overlap: count their union in order of start
    union = F.aggregate(F.array_sort("_spans"),
                        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
                        lambda s, x: F.struct(
                            (s["n"] + F.greatest(F.lit(0).cast("long"), x["start"] + x["length"]
                                                 - F.greatest(s["end"], x["start"].cast("long")))).alias("n"),
                            F.greatest(s["end"], (x["start"] + x["length"]).cast("long")).alias("end")),
                        lambda s: s["n"])
    found = [F.col("_n_words"), union, F.col("_spans"), F.col("_matches"),
             F.array_sort(F.array_distinct(F.col("_matches.item_id"))),
             F.coalesce(F.array_max(F.col("_matches.length")), F.lit(0))]
    return (out.select(*[F.col(f"`{c}`") for c in own], *[c.alias(n) for c, n in zip(found, added)])
            .withColumn(added[-1], F.col(added[1]) > 0))


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold a window of the benchmark; all columns stay as they are."""
    judged = overlap(docs, benchmark, prefix="_bench_", **options)
    return judged.where("not _bench_contaminated").select(*[F.col(f"`{c}`") for c in docs.columns])


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, contaminated, longest and items_sha256 for each document."""
    return overlap(docs.select("doc_id", "text"), benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(F.col("item_ids").cast("array<string>"))), 256).alias("items_sha256"),
        "contaminated", "longest")
