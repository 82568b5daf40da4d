"""Multi-index hashing: pigeonhole retrieval, exact scores, recall, odd vectors."""

import math

import numpy as np
import pytest

from newsarc.llm import ann


def exact(rows, every=50, k=5):
    ok = [(i, np.array(v, dtype="float64")) for i, v in rows
          if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    out = {}
    for i, v in ok:
        if i % every == 0:
            near = sorted(((-(v @ w) / (np.linalg.norm(v) * np.linalg.norm(w)), j) for j, w in ok if j != i))
            out[i] = [(j, -s) for s, j in near[:k]]
    return out


def found(df, **o):
    out = {}
    for r in sorted(ann.neighbours(df, **o).collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


@pytest.mark.parametrize("radius", [0, 5, 11, 28, 64])
def test_every_code_within_the_radius_is_retrieved(radius):
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 2**63, 3000, dtype="uint64")
    codes[:500] = codes[0] ^ (np.uint64(1) << rng.integers(0, 64, 500, dtype="uint64"))
    shard, flips = ann.Shard(codes), ann.masks(min(radius // ann.PARTS, 3))
    for q in (codes[0], codes[700], np.uint64(0)):
        want = np.nonzero(np.bitwise_count(codes ^ q) <= radius)[0]
        assert np.array_equal(shard.within(q, radius, None), want)
        if radius // ann.PARTS <= 3:
            assert np.array_equal(shard.within(q, radius, flips), want)


def test_recall_and_scores_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    want = exact([(r["vec_id"], r["embedding"]) for r in df.collect()])
    got = found(df)
    assert set(got) == set(want) and all(len(x) == 5 for x in got.values())
    hit = sum(len({j for j, _ in got[q]} & {j for j, _ in want[q]}) for q in want)
    assert hit / (5 * len(want)) >= 0.9
    vectors = {r["vec_id"]: np.array(r["embedding"], dtype="float64") for r in df.collect()}
    for q, near in got.items():
        for j, s in near:
            v, w = vectors[q], vectors[j]
            assert s == pytest.approx(v @ w / (np.linalg.norm(v) * np.linalg.norm(w)), abs=1e-12)


def test_full_radius_is_exact_with_ties_copies_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "QUERY_BLOCK", 3)   # several blocks
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(200)]
    rows += [(200 + i, rows[0][1]) for i in range(120)]   # many copies of one vector
    rows += [(500, None), (550, [0.0] * 8), (551, [1.0] * 7 + [None]), (552, [1.0] * 7 + [float("nan")]),
             (553, [1.0] * 7 + [float("inf")]), (554, []), (None, [1.0] * 8)]
    df = spark.createDataFrame([(i, v, 0.5) for i, v in rows], "vec_id long, embedding array<double>, score double").repartition(4)
    got, want = found(df, radius=64), exact(rows)
    assert {q: [j for j, _ in x] for q, x in got.items()} == {q: [j for j, _ in x] for q, x in want.items()}


def test_few_candidates_and_small_radius(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.9, 0.1]), (2, [-1.0, 0.2]), (50, [0.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = found(df, radius=0)   # what the radius misses is found by the full search
    assert [j for j, _ in got[0]] == [1, 50, 2] and len(got[50]) == 3
    assert ann.neighbours(df.where("vec_id = 0")).count() == 0
    assert ann.neighbours(df.where("false")).count() == 0
