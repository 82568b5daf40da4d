"""Quality classifier: held-out accuracy, no leak of ids and labels, odd inputs."""

import zlib

import numpy as np
import pytest

from newsarc.llm import quality


def plain_margin(model, row):
    out = model.base
    for f, t, v in zip(model.feature, model.threshold, model.value):
        node = 0
        for _ in range(model.depth):
            node = 2 * node + (2 if row[f[node]] > t[node] else 1)
        out += v[node - len(f)]
    return out


def test_flat_trees_equal_a_walk_and_learn_a_rule():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((1500, 6))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    model = quality.fit(x, y)
    test = rng.standard_normal((400, 6))
    assert np.allclose(model.margin(test), [plain_margin(model, r) for r in test])
    truth = (test[:, 0] > 0) ^ (test[:, 3] > 0.5)
    assert ((model.probability(test) > 0.5) == truth).mean() > 0.95


@pytest.mark.parametrize("y", [[], [1.0] * 30, [0.0] * 30])
def test_constant_without_both_labels(y):
    model = quality.fit(np.zeros((len(y), 3)), np.array(y))
    assert len(set(model.probability(np.random.default_rng(0).random((5, 3))).tolist())) == 1


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.classify(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert len(got) > 300
    assert (got["predicted"] == got["quality"]).mean() > 0.97
    assert got.loc[got["quality"] == 1, "predicted"].mean() > 0.99   # clean documents stay


def test_scores_depend_on_the_text_alone(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.train(docs, labels)
    held = labels.selectExpr("doc_id", "1 - quality AS quality").where(quality.held_out())
    flipped = quality.train(docs, labels.where(~quality.held_out()).select("doc_id", "quality").unionByName(held))
    assert all(np.array_equal(a, b) for a, b in zip(model.value, flipped.value))
    rows = [(1, None), (2, ""), (2, ""), (None, "WORD!! " * 9), (3, "WORD!! " * 9), (4, "ordinary words here. " * 30000)]
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, score string")
    got = quality.score(df, model).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    by = {(r["doc_id"], r["text"]): r["score"] for r in got}
    assert by[1, None] == by[2, ""] and by[None, "WORD!! " * 9] == by[3, "WORD!! " * 9]


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, None), (1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    odd = spark.createDataFrame([(1, None), (1, 7), (None, 1), (99, 1)], "doc_id long, quality int")
    for labels in (none, odd):
        got = quality.classify(docs, labels).collect()
        assert len(got) == 3 and len({r["score"] for r in got}) == 1
        assert {r["held_out"] for r in got if r["doc_id"] == 1} == {zlib.crc32(b"1") % 5 == 0}
    assert quality.classify(docs.where("false"), none).count() == 0


def plain_fit(x, y, trees, depth, bins, rate, min_leaf, ridge):
    """The boosting written out: every split of every feature tried row by row over the same bin borders."""
    n, nf = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(nf)]
    share = y.mean()
    margin = np.full(n, np.log(share / (1 - share)))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        groups, values = [np.arange(n)], []
        for _ in range(depth):
            after = []
            for rows in groups:
                best, cut = 1e-9, None
                for f in range(nf):
                    for e in edges[f]:
                        left = rows[x[rows, f] <= e]
                        right = rows[x[rows, f] > e]
                        if min(len(left), len(right)) < min_leaf:
                            continue
                        score = lambda r: g[r].sum() ** 2 / (h[r].sum() + ridge)
                        gain = score(left) + score(right) - score(rows)
                        if gain > best + 1e-12:
                            best, cut = gain, (left, right)
                after += list(cut) if cut else [rows, rows[:0]]
            groups = after
        for rows in groups:
            if len(rows):
                margin[rows] += rate * g[rows].sum() / (h[rows].sum() + ridge)
    return margin


def test_split_search_equals_a_plain_one():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((160, 3)).round(1)
    y = ((x[:, 0] + 0.5 * x[:, 1] > 0.2) ^ (rng.random(160) < 0.1)).astype(float)
    how = dict(trees=4, depth=2, bins=8, rate=0.3, min_leaf=10, ridge=1.0)
    assert np.allclose(quality.fit(x, y, **how).margin(x), plain_fit(x, y, **how))
