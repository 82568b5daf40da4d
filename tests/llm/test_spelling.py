"""Spelling variants: against comparing all words, checksums, pieces of long texts, odd rows."""

import random
import re
import zlib
from collections import Counter

import pytest

from newsarc.llm import spelling


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def plain(rows, min_length=7, min_count=2, factor=10, every=31, long=None):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    out, form = {}, {}
    for w, n in words.items():
        found = sorted((-words[v], v) for v in words if near(w, v))
        good = found and -found[0][0] >= factor * n
        form[w] = found[0][1] if good else None
        out[w] = (form[w], n, len(found), -found[0][0] if good else None)
    def root(w):
        while form[w]:
            w = form[w]
        return w
    return {(w, f, root(w), n, k, fn) for w, (f, n, k, fn) in out.items()}


def corpus(seed, letters, low, high):
    rng = random.Random(seed)
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(low, high))) for _ in range(25)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randint(0, 60)):
            w = rng.choice(stems[:1 + rng.randrange(len(stems))])
            if rng.random() < 0.3:
                k = rng.randrange(len(w) + 1)
                w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1:]])
            words.append(rng.choice([w, w.upper(), w.capitalize()]))
        rows.append((i, rng.choice([" ", ", ", "\n", "3"]).join(words)))
    return rows


@pytest.mark.parametrize("letters, low, high, how", [
    ("ab", 6, 9, {}), ("aé", 7, 12, {"every": 3}), ("abcdefghij", 7, 9, {"factor": 2}),
    ("ab", 6, 9, {"long": 8}), ("abcd", 7, 9, {"long": 3, "factor": 2}), ("aab", 1, 5, {"min_length": 1, "min_count": 1, "factor": 3, "every": 2})])
def test_equals_comparing_all_words(spark, letters, low, high, how):
    rows = corpus(len(letters), letters, low, high)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [tuple(r) for r in spelling.variants(df, **how).collect()]
    want = plain(rows, **how)
    assert len(got) == len(want) and set(got) == want
    assert sum(1 for r in want if r[1]) > 3


def test_chains_of_forms_end_at_their_root(spark):
    words = {"abcdefgh": 2, "abcdefgi": 20, "abcdefji": 200, "abcdkfji": 2000, "alcdkfji": 20000, "zzzzzzzz": 2}
    text = " ".join(" ".join([w] * n) for w, n in words.items())
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = {r["word"]: r for r in spelling.variants(df, every=10 ** 9).collect()}
    assert {w: r["root"] for w, r in got.items()} == {w: "zzzzzzzz" if w[0] == "z" else "alcdkfji" for w in words}
    assert got["abcdefgh"]["form"] == "abcdefgi" and got["abcdefgh"]["form_n"] == 20


def test_counts_do_not_depend_on_pieces_and_batches(spark, monkeypatch):
    rows = corpus(5, "abcé", 6, 80)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    want = {tuple(r) for r in spelling.vocabulary(df, every=5).collect()}
    assert want == {r[0:1] + r[3:4] for r in plain(rows, every=5)}   # runs beyond SHORT bytes too
    assert any(len(w.encode()) > spelling.SHORT for w, _ in want)
    counts = spelling.Counts()
    for i, t in rows:
        counts.add([str(i)], [[r for p in spelling.parts(t, 7) for r in spelling.runs(p)]], 5)
    words, n = counts.rows(7)
    total = Counter()
    for w, k in zip(words, n):
        total[w] += k
    assert {(w, k) for w, k in total.items() if k > 1} == want
    assert list(spelling.parts("ab cd", 9)) == ["ab cd"] and "".join(spelling.parts("abc def ghi", 2)) == "abc def ghi"


def test_odd_rows(spark):
    long = "wonderful " * 300_000 + "x" * 200_000 + " " + "y" * 200_000 + "z" + " a" + "y" * 200_000
    rows = [(1, None), (2, ""), (2, "Straße Straße ÀÉÎÕÜÝÿ ÀÉÎÕÜÝÿ × ÷ naïveté́ naïveté日本"), (None, "nothing nothing"), (3, long), (3, long)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'c' AS word", "1 AS n", "'k' AS key")
    got = {tuple(r) for r in spelling.variants(df).collect()}
    assert got == plain(rows) and any(len(r[0]) >= 199_999 for r in got)
    assert spelling.variants(df.where("false")).count() == 0
    assert spelling.variants(df.where("doc_id = 1")).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_keys_meet_exactly_the_neighbours():
    words = ["hello", "helo", "hell", "hellos", "jello", "help", "aaa", "aaaa", "aab", "aa"]
    for a in words:
        for b in words:
            if a != b:
                met = [(x, y) for k, x in spelling.keys_of(a) for j, y in spelling.keys_of(b) if k == j]
                met = [m for m in met if m[0] or m[1]]
                assert bool(met) == near(a, b), (a, b)
