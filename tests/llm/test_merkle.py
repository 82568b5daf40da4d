"""Merkle manifest: layout, blocks of several heights, proofs and odd rows against a plain tree."""

import random
import zlib
from hashlib import sha256

import pytest

from newsarc.llm import merkle


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain(rows):
    """doc_id, leaf, subroot, root, proof, folded and verified by whole levels in lists."""
    def leaf(r, more=0):
        values = [r[0], r[1], r[2], None if r[3] is None else r[3] + more, r[4]]
        return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([H(*out[-1][k:k + 2]) for k in range(0, len(out[-1]), 2)])
        return out

    def steps(tree, k):
        for row in tree[:-1]:
            yield (k & 1, row[k ^ 1] if k ^ 1 < len(row) else "")
            k >>= 1
    low = lambda v: (v is not None, v)
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    trees = {n: levels([leaf(r) for r in sorted(groups[n], key=lambda r: (low(r[0]), leaf(r)))]) for n in names}
    top = levels([trees[n][-1][0] for n in names])
    out = []
    for g, n in enumerate(names):
        for k, r in enumerate(sorted(groups[n], key=lambda r: (low(r[0]), leaf(r)))):
            path = [*steps(trees[n], k), *steps(top, g)]
            at = leaf(r, 1) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 else leaf(r)
            for side, other in path:
                at = H(other, at) if side else H(at, other)
            out.append((r[0], leaf(r), trees[n][-1][0], top[-1][0], H(*(o for _, o in path)), at, at == top[-1][0]))
    return out


SCHEMA = "doc_id long, source string, lang string, n_chars int, text string"


def corpus(n, langs, seed=1):
    rng = random.Random(seed)
    rows = [(rng.randint(0, 3 * n), rng.choice(["a", None, "ü"]), rng.choice(langs), rng.choice([None, 5, 10 ** 9]),
             rng.choice([None, "", "é" * 9, "text 1:2", "z" * 5000])) for _ in range(n)]
    return rows + rows[:3]


@pytest.mark.parametrize("height", range(0, 8))
def test_layout_is_a_recursive_permutation(height):
    places = merkle.addresses(height)
    assert sorted(int(a) for level in places for a in level) == list(range((2 << height) - 1))
    assert int(places[0][0]) == 0
    upper = (height + 1) // 2
    if height:
        for root in range(1 << upper):   # each lower subtree is one stretch
            inside = [int(places[lv][k]) for lv in range(upper, height + 1)
                      for k in range(root << (lv - upper), (root + 1) << (lv - upper))]
            assert max(inside) - min(inside) == len(inside) - 1


@pytest.mark.parametrize("height, n, langs", [
    (3, 0, ["x"]), (12, 1, ["x"]), (1, 2, [None]), (2, 37, ["b", "a", None, "é", "z"]), (3, 64, ["only"]),
    (2, 61, ["only"]), (3, 150, ["hot"] * 8 + list("abcdefghijklmn")), (12, 150, ["a", "b", None])])
def test_equals_the_plain_tree(spark, height, n, langs):
    rows = corpus(n, langs) if n > 2 else corpus(n, langs)[:n]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(map(tuple, merkle.audit(df, height).collect()))
    assert got == sorted(plain(rows))
    assert n < 30 or {r[-1] for r in got} == {True, False}


def test_null_ids_clashing_columns_and_names(spark):
    rows = [(None, "s", None, 1, "a"), (None, "s", None, 2, "a"), (3, "s", None, 1, "b"), (3, "s", None, 1, "b")]
    df = spark.createDataFrame(rows, SCHEMA)
    clash = df.selectExpr("*", "'x' AS leaf", "1 AS g", "2 AS size", "3 AS at", "4 AS id", "5 AS grp")
    out = merkle.audit(clash)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, out.collect()), key=key) == sorted(plain(rows), key=key)


def test_manifest_blocks_are_whole_subtrees(spark):
    rows = corpus(90, ["a", "b"])
    below, over, groups = merkle.manifest(merkle.leaves_of(spark.createDataFrame(rows, SCHEMA)), 3)
    assert len(below) == 2 and len(over) == 1 and groups.count() == 2
    for r in below[0].collect():
        leaves = [m["leaf"] for m in r["members"]]
        block = merkle.Block(r["height"], r["count"], bytes(r["nodes"]))
        assert len(leaves) == r["count"] <= 8 and len(r["nodes"]) == 32 * 15
        assert [block.node(r["height"], k) for k in range(r["count"])] == leaves
        assert all(merkle.fold(x, block.path(k)) == r["root"] for k, x in enumerate(leaves))
