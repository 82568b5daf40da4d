"""Sharding against a plain binary search over the ordered groups."""

import hashlib
import zlib
from itertools import groupby

import pytest

from newsarc.llm import sharding


def brute(texts, n):
    """Smallest feasible capacity by plain binary search; null stands first."""
    keyed = sorted((b"" if t is None else hashlib.sha256(t.encode()).digest(), len((t or "").encode()) + 1) for t in texts)
    groups = [sum(s for _, s in g) for _, g in groupby(keyed, key=lambda x: x[0])]

    def shards(cap):
        used, room = 1, cap
        for g in groups:
            if g > room:
                used, room = used + 1, cap
            room -= g
        return used

    low, high = max(groups), sum(groups)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if shards(mid) <= n else (mid + 1, high)
    return low


CASES = {
    "mixed": [f"text {i} " * (i % 17 + 1) for i in range(200)] + ["copy"] * 60 + ["", "", None, None, "é" * 30],
    "hot": ["a long copy of a text"] * 300 + [f"t{i}" for i in range(100)],
    "one long": ["x" * 50_000] + [f"t{i}" for i in range(50)],
    "few": ["a", "b"],
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_capacity_is_minimal_and_groups_are_whole(spark, name, monkeypatch):
    monkeypatch.setattr(sharding, "BAND", 7)  # several walks
    texts = CASES[name]
    rows = [(i if i % 50 else 7, t, "clash") for i, t in enumerate(texts)]   # ids repeat
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(5)
    got = sharding.shard(df, 16).collect()
    assert len(got) == len(rows)
    sizes, slots, home = {}, {}, {}
    for r in got:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        home.setdefault(bytes(r["digest"]), set()).add(r["shard"])
    assert all(0 <= s < 16 for s in sizes)
    assert all(len(x) == 1 for x in home.values())
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert max(sizes.values()) <= brute(texts, 16) == got[0]["capacity"]
    want = sorted((len((t or "").encode()) + 1, None if t is None else zlib.crc32(t.encode())) for t in texts if t is not None)
    assert sorted((r["size"], r["text_crc32"]) for r in got if r["text_crc32"] is not None) == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.shard(df).columns[-3:] == ["shard", "slot", "capacity"] and sharding.shard(df).count() == 0


def test_query_covers_all_documents(spark):
    from newsarc.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    got = QUERIES["op1_sharding"](spark, sf)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
