"""Chunk removal: against a plain version, and its promises."""

import random
import re
from collections import defaultdict

import pytest

from newsarc.llm import line_dedup


def chunks(text, line_hash):
    """Plain version of the chunking; line_hash gives Spark's signed 64-bit hash."""
    lines = [x for x in re.split(r"(?<=\n)(?!\n)|(?<=[.,;:!?] )(?!\n)", text) if x]
    n = len(lines)
    last = [x.endswith("\n") or i == n - 1 for i, x in enumerate(lines)]
    h = [line_hash[x.rstrip(" \n")] for x in lines]
    roll = []
    for i in range(n):
        v = h[i]
        if i and not last[i - 1]:
            u = h[i - 1] & (1 << 64) - 1
            r = (u << 1 | u >> 63) & (1 << 64) - 1
            v ^= r - (1 << 64) if r >> 63 else r
        roll.append(v)
    out, at = [], 0
    for i in range(n):
        inner = 0 < i < n - 1 and not last[i - 1] and not last[i + 1] and roll[i] < roll[i - 1] and roll[i] < roll[i + 1]
        if last[i] or inner:
            out.append((i - at + 1, "".join(lines[at:i + 1])))
            at = i + 1
    return out


def brute(rows, line_hash, min_words):
    cut = {i: chunks(t or "", line_hash) for i, t in rows}
    size = lambda c: c.rstrip(" \n").count(" ") + 1
    first = {}
    for i in sorted(cut):
        for no, (n, c) in enumerate(cut[i]):
            if n > 1 or size(c) >= min_words:
                first.setdefault(c.rstrip(" \n"), (i, no))
    out = {}
    for i, t in rows:
        gone, run, before = set(), [], None
        for no, (n, c) in enumerate([*cut[i], (0, "")]):
            origin = first.get(c.rstrip(" \n")) if (n > 1 or (n and size(c) >= min_words)) else None
            place = (origin[0], origin[1] - no) if origin and origin != (i, no) else None
            if place != before:
                if sum(size(cut[i][k][1]) for k in run) >= min_words:
                    gone |= set(run)
                run, before = [], place
            if place:
                run.append(no)
        out[i] = None if t is None else "".join(c for no, (_, c) in enumerate(cut[i]) if no not in gone)
    return out


def corpus():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(400)]

    def sentence():
        return " ".join(rng.choice(vocabulary) for _ in range(rng.randint(3, 12))) + rng.choice([". ", ", ", "! ", "; "])
    passages = ["".join(sentence() for _ in range(10)) for _ in range(4)]
    rows = []
    for i in range(80):
        parts = ["".join(sentence() for _ in range(rng.randint(1, 12))) for _ in range(rng.randint(1, 4))]
        if i % 3 == 0:
            parts.insert(rng.randint(0, len(parts)), passages[i % 4])
        rows.append((i, "\n".join(parts)))
    rows += [(100, rows[0][1]), (101, rows[1][1]), (102, ""), (103, None), (104, "\n\n"), (105, "word " * 500),
             (106, passages[0] * 30), (107, "no punctuation at all"), (108, "a plain one\n" + "word " * 500),
             (111, "kept here\n" + passages[1]), (112, passages[1] + "\nand more"),
             (109, "SHOUT!! " * 60), (110, "some NEW!! SHOUT!! SHOUT!! words!! of!! SHOUT!! all kinds!! ")]
    return rows, passages


@pytest.fixture(scope="module")
def case(spark):
    rows, passages = corpus()
    lines = sorted({x.rstrip(" \n") for _, t in rows if t for x in re.split(r"(?<=\n)(?!\n)|(?<=[.,;:!?] )(?!\n)", t) if x})
    df = spark.createDataFrame([(x,) for x in lines], "x string")
    return rows, passages, {r["x"]: r["h"] for r in df.selectExpr("x", "xxhash64(x) AS h").collect()}


@pytest.mark.parametrize("min_words", [1, 20])
def test_equals_the_plain_version(spark, case, min_words):
    rows, _, line_hash = case
    df = spark.createDataFrame([(i, t, 9) for i, t in rows], "doc_id long, text string, removed_words int").repartition(5)
    out = line_dedup.dedup_lines(df, min_words=min_words)
    assert out.columns == ["doc_id", "text", "removed_chunks", "removed_words"]
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got == brute(rows, line_hash, min_words)


def test_a_repeated_passage_stays_once(spark, case):
    rows, passages, _ = case
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for p in passages:
        assert sum(1 for t in got.values() if t and p.strip() in t) <= 1
    assert got[100].count(" ") < 20 and got[0] == rows[0][1]   # a copy is all but emptied, its original is whole
    assert got[105] == "word " * 500 and got[108] == "a plain one\n"   # a long line alone counts as a chunk
    assert got[111] == "kept here\n" and got[112] == "and more"   # with or without a line break after it
    assert got[110] == dict(rows)[110]                         # short phrases that recur stay
    untouched = [i for i in range(80) if i % 3]
    assert all(got[i] == rows[i][1] for i in untouched)


def test_repeated_rows_null_ids_and_empty_table(spark, case):
    rows, _, _ = case
    df = spark.createDataFrame([rows[0], rows[0], (None, rows[2][1]), (None, rows[2][1])], "doc_id long, text string")
    assert sorted(r["text"] for r in line_dedup.dedup_lines(df).collect()) == sorted([rows[0][1]] * 2 + [rows[2][1]] * 2)
    assert line_dedup.dedup_lines(df.where("false")).count() == 0


def test_no_python_in_the_plan(spark, case):
    df = spark.createDataFrame(case[0], "doc_id long, text string")
    plan = line_dedup.dedup_lines(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
