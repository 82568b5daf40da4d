"""SimHash: fingerprints, covering masks and components against brute force."""

import random
import re
from itertools import combinations

import pytest
import xxhash

from newsarc.llm import simhash


def plain_fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]
    if not words:
        return 0
    shingles = [words] if len(words) < 3 else [words[i:i + 3] for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints, radius=2):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, j in combinations(range(len(ids)), 2):
        if bin(prints[i] ^ prints[j]).count("1") <= radius:
            a, b = find(i), find(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(i)
    out = [None] * len(ids)
    for members in groups.values():
        named = [ids[i] for i in members if ids[i] is not None]
        for i in members:
            out[i] = min(named) if named else None
    return out


def test_masks_cover_every_pair_of_bits():
    masks = simhash.covering_masks(2)
    assert len(masks) == 7
    for a, b in combinations(range(64), 2):
        assert any(not m >> a & 1 and not m >> b & 1 for m in masks)


def test_fingerprint_equals_the_plain_one():
    texts = ["", " \t\n", None, "One", "two Words", "a b c", "Ä É ß  x y", "the the the the the " * 50,
             " ".join(str(i % 97) for i in range(40_000))]
    for t in texts:
        got = simhash.fingerprint(t) & (1 << 64) - 1
        assert got == plain_fingerprint(t)
        assert simhash.fingerprint(t, block=11) & (1 << 64) - 1 == got


@pytest.mark.parametrize("small", [1, 4, 48])
def test_links_connect_exactly_the_points_within_the_radius(spark, small, monkeypatch):
    monkeypatch.setattr(simhash, "SMALL", small)  # 1: every shared bucket takes the star way
    rng = random.Random(3)
    points = {0}
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(25):
            p = centre
            for b in rng.sample(range(64), rng.randint(0, 3)):
                p ^= 1 << b
            points.add(p)
    points = sorted(points)
    df = spark.createDataFrame([(simhash.signed(p),) for p in points], "fp long")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(df)).collect()}
    got = {}
    for i, p in enumerate(points):
        s = simhash.signed(p)
        got.setdefault(roots.get(s, s), set()).add(i)
    want = {}
    for i, c in enumerate(plain_components(list(range(len(points))), points)):
        want.setdefault(c, set()).add(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(200, 100), (300, 200)], "a long, b long")
    got = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 100, 300: 100}


def test_documents_with_copies_nulls_and_repeats(spark):
    base = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows = [(10 + i, t) for i, t in enumerate(base)] + [(5000 + i, base[3]) for i in range(200)]
    rows += [(3, ""), (2, None), (None, base[5]), (None, "only this"), (5001, base[3]), (1, " \n ")]
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, component_id string").repartition(4)
    got = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(df).collect()), key=str)
    prints = [plain_fingerprint(t) for _, t in rows]
    want = plain_components([i for i, _ in rows], prints)
    assert got == sorted(((i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, want)), key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).count() == 0
