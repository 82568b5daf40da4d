"""Decontamination against a plain search of every window."""

import hashlib
import re

import pytest

from newsarc.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(text, items):
    w = words(text)
    hit, found = set(), set()
    for ident, t in items:
        v = words(t)
        n = min(10, len(v))
        if not n:
            continue
        for o in range(len(v) - n + 1):
            for p in range(len(w) - n + 1):
                if w[p:p + n] == v[o:o + n]:
                    hit.update(range(p, p + n))
                    found.add(ident)
    names = ",".join(sorted(map(str, found)))
    return len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)


ITEM = "One two THREE four five six seven eight nine ten eleven twelve"
ITEMS = [(1, ITEM), (2, "short item"), (3, ""), (4, None), (5, "a a a a a a a a a a a a a"), (10, ITEM + " more"),
         (11, "z"), (12, "café 42 naïve"), (5, "a a a a a a a a a a a a a")]
DOCS = [(1, "x " + ITEM.lower() + " y"), (2, "one two three four five six seven eight nine"), (3, None), (4, ""),
        (5, "a " * 50), (6, "Short-ITEM; short item, z"), (7, "CAFé 42... naïve!"), (8, "two three four five six seven eight nine ten eleven"),
        (8, "two three four five six seven eight nine ten eleven"), (None, ITEM + " " + ITEM), (9, "clean words only here"),
        (12, "pad " * 3000 + ITEM + " more " + "pad " * 3000)]


def got(spark, docs, items):
    d = spark.createDataFrame([(i, t, "c") for i, t in docs], "doc_id long, text string, n_hit string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
                   for r in decontaminate.report(d, b).collect()), key=str)


@pytest.mark.parametrize("block_bytes,shard_words", [(8 << 20, 1 << 18), (40, 1 << 18), (8 << 20, 8)])
def test_report_equals_brute_force(spark, monkeypatch, block_bytes, shard_words):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)   # 40: several blocks
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", shard_words)   # 8: a shard per document
    assert got(spark, DOCS, ITEMS) == sorted(((i, *brute(t, ITEMS)) for i, t in DOCS), key=str)


def test_real_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    index = {}
    for i, t in items:
        v = words(t)
        for o in range(max(1, len(v) - 9)):
            index.setdefault(tuple(v[o:o + 10]), set()).add(i)
    assert all(len(k) == 10 for k in index)
    want = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for p in range(len(w) - 9):
            k = index.get(tuple(w[p:p + 10]))
            if k:
                hit.update(range(p, p + 10))
                found |= k
        want.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit)))
    assert got(spark, docs, items) == sorted(want, key=str)


def test_longest_matches_and_locations(spark):
    d = spark.createDataFrame([(1, "x " + ITEM.lower() + " more y"), (2, "q " + " ".join(ITEM.split()[1:]))], "doc_id long, text string")
    b = spark.createDataFrame([(1, ITEM), (10, ITEM + " more")], "item_id long, text string")
    r = {x["doc_id"]: x for x in decontaminate.overlap(d, b).collect()}
    assert [tuple(m) for m in r[1]["matches"]] == [(1, 12, 1, 0), (1, 13, 10, 0)] and r[1]["longest"] == 13
    assert [tuple(m) for m in r[2]["matches"]] == [(1, 11, 1, 1), (1, 11, 10, 1)]


def test_clean_and_empty_tables(spark):
    d = spark.createDataFrame(DOCS, "doc_id long, text string")
    b = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert sorted(r["doc_id"] for r in decontaminate.clean(d, b).collect()) == sorted(
        i for i, t in DOCS if not brute(t, ITEMS)[4])
    none = spark.createDataFrame([], "item_id long, text string")
    assert [(r["n_words"], r["n_hit"]) for r in decontaminate.report(d, none).orderBy("doc_id", "n_words").collect()] == [
        (x[1], 0) for x in sorted(((i, len(words(t))) for i, t in DOCS), key=lambda x: (x[0] is not None, x))]
    assert decontaminate.report(d.where("false"), b).count() == 0


def test_items_named_by_strings_and_one_live_block(spark, monkeypatch):
    from pyspark.core.broadcast import Broadcast
    live, most = set(), []
    real, gone = spark.sparkContext.broadcast, Broadcast.unpersist
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 40)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, v: (lambda b: (live.add(id(b)), most.append(len(live)), b)[2])(real(v)))
    monkeypatch.setattr(Broadcast, "unpersist", lambda self, *a: (live.discard(id(self)), gone(self, *a))[1])
    items = [(f"it-{i}", t) for i, t in ITEMS]
    d = spark.createDataFrame(DOCS, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id string, text string")
    out = decontaminate.overlap(d, b)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1 and len(most) > 2 and set(most) == {1}
    rows = decontaminate.report(d, b).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows),
                  key=str) == sorted(((i, *brute(t, items)) for i, t in DOCS), key=str)
    ids = {m["item_id"] for r in out.collect() for m in r["matches"]}
    assert ids and all(i.startswith("it-") for i in ids)
