"""Katz model against a plain recursive version, and its normalisation."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from newsarc.llm import katz


def brute(docs, order):
    """The same model with dictionaries: id -> (n_known, base, score) and a function P(w, context)."""
    tok = {d: [*katz.blank_words(t), b"\n"] for d, t in docs}
    train = [w for d, w in tok.items() if d is not None and zlib.crc32(str(d).encode()) % 5 != 1]
    uni = Counter(w for t in train for w in t)
    total, types = sum(uni.values()), len(uni)
    grams = {n: Counter() for n in range(2, order + 1)}
    for t in train:
        s = [None, *t]
        for n in grams:
            grams[n].update(tuple(s[i:i + n]) for i in range(len(s) - n + 1))

    def disc(counter):
        return katz.discounts(np.array([sum(c == r for c in counter.values()) for r in range(1, katz.CUT + 2)]))

    d = {1: disc(uni), **{n: disc(c) for n, c in grams.items()}}
    used = lambda n, c: d[n][c] * c if c <= katz.CUT else c
    seen_mass = sum(used(1, c) for c in uni.values()) / total
    unk = max(1 - seen_mass, 0.5 / (total + 0.5 * (types + 1)))
    followers = {n: defaultdict(dict) for n in grams}
    for n, c in grams.items():
        for g, k in c.items():
            followers[n][g[:-1]][g[-1]] = k

    def p(w, ctx):
        if not ctx:
            return used(1, uni[w]) / total * (1 - unk) / seen_mass if w in uni else unk
        own = followers[len(ctx) + 1].get(ctx)
        if not own:
            return p(w, ctx[1:])
        den = sum(own.values()) + (1 if all(c > katz.CUT for c in own.values()) else 0)
        if w in own:
            return used(len(ctx) + 1, own[w]) / den
        left = 1 - sum(used(len(ctx) + 1, c) for c in own.values()) / den
        return left / (1 - sum(p(x, ctx[1:]) for x in own)) * p(w, ctx[1:])

    out = {}
    for i, t in tok.items():
        s = [None, *t]
        out[i] = (len(t), sum(w in uni for w in t),
                  sum(math.log10((uni[w] + 0.5) / (total + 0.5 * (types + 1))) for w in t),
                  sum(math.log10(p(s[j], tuple(s[max(0, j - order + 1):j]))) for j in range(1, len(s))))
    return out, p, uni, followers


@pytest.fixture(scope="module")
def docs(spark):
    rows = [r[:] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    rows = [(i, " ".join(t.split(" ")[:60])) for i, t in rows]
    common = "a b a b a b c a b"
    return rows + [(1000 + i, common) for i in range(40)] + [(2001, ""), (2002, None), (2003, "A  b\tzzz\n qqq"), (None, "a b")]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_the_recursive_model(spark, docs, order, monkeypatch):
    monkeypatch.setattr(katz, "BUCKET_BYTES", 2000)
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, kind string").repartition(3)
    got = {r["doc_id"]: r for r in katz.scored(df, order).collect()}
    want, *_ = brute(docs, order)
    assert set(got) == set(want)
    for i, (n, known, base, score) in want.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"]) == (n, known)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] == pytest.approx(score, rel=1e-9), i
        assert r["held_out"] == (i is None or zlib.crc32(str(i).encode()) % 5 == 1)


def test_each_context_sums_to_one(docs):
    _, p, uni, followers = brute(docs, 3)
    vocabulary = [*uni, b"never seen"]
    for ctx in [(), (b"a",), (b"the",), (None,), (b"a", b"b"), (b"unseen",)] + list(followers[3])[:20]:
        assert sum(p(w, ctx) for w in vocabulary) == pytest.approx(1, abs=1e-9)


def test_empty_table_and_no_training_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert katz.scored(df).count() == 0
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    got = katz.scored(spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")).collect()
    assert [(r["n_known"], r["train_tokens"], r["score"]) for r in got] == [(0, 0, 0.0)] * 3


def test_pack_round_trip():
    arrays = [np.array([], dtype="int64"), np.arange(300), np.array([1 << 62, 3]), np.array([0.1, 0.2, 0.1, 0.1, 0.1]),
              np.random.default_rng(1).random(10)]
    for a, b in zip(arrays, katz._unpack(katz._pack(*arrays))):
        assert np.array_equal(a.astype(b.dtype), b)
