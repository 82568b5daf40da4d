"""Passage removal: against a plain version, and passages that chunks between fixed borders miss."""

import random
import re

import pytest

from newsarc.llm import line_dedup

LINE = r"(?<=\n)(?!\n)|(?<=[.,;:!?] )(?!\n)"


def plain(rows, min_words):
    """All lines in a run of min_words or more that stands at an earlier place go."""
    cut = {i: [x for x in re.split(LINE, t or "") if x] for i, t in sorted(rows)}
    first, gone = {}, {i: set() for i in cut}
    for i, lines in cut.items():
        words = [len(re.split("[ \t\r\n]+", x.strip(" \t\r\n"))) if x.strip(" \t\r\n") else 0 for x in lines]
        for s in range(len(lines)):
            for e in range(s, len(lines)):
                if sum(words[s:e + 1]) < min_words or not words[s] or not words[e]:
                    continue
                k, at = first.setdefault("".join(lines[s:e + 1]).rstrip(" \n"), (i, s))
                if k != i or s > at + e - s:
                    gone[i] |= set(range(s, e + 1))
    return {i: None if t is None else "".join(x for n, x in enumerate(cut[i]) if n not in gone[i]) for i, t in rows}


def removed(spark, rows, **how):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return {r["doc_id"]: r for r in line_dedup.dedup_passages(df, **how).collect()}


def clause(rng, low, high):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(rng.randint(low, high)))


def test_short_lines_go(spark):
    rng = random.Random(2)
    verse = "".join(clause(rng, 8, 8) + "\n" for _ in range(10))
    mixed = clause(rng, 15, 15) + "\n" + clause(rng, 4, 4) + "\n\n" + clause(rng, 15, 15) + "\n"
    menu = "".join(clause(rng, 1, 2) + "\n" for _ in range(30))
    rows = [(n, f"{clause(rng, 9, 9)}\n{verse}{clause(rng, 9, 9)}. {mixed}{clause(rng, 9, 9)}\n\n{menu}end of {n}")
            for n in range(4)]
    got = removed(spark, rows)
    assert got[0]["text"] == rows[0][1] and got[0]["removed_words"] == 0
    for n in range(1, 4):
        assert not any(p in got[n]["text"] for p in (*verse.splitlines(), *mixed.splitlines()[:2], menu))
        assert len(got[n]["text"].split()) == 30 and got[n]["removed_chunks"] == 3
        assert got[n]["removed_words"] + 30 == len(rows[n][1].split())


def corpus():
    rng = random.Random(4)
    def text(n):
        return "".join(clause(rng, 1, 9) + rng.choice([". ", ", ", "\n", "\n\n", "! ", "; ", "\n \n"]) for _ in range(n))
    passages = [text(n) for n in (3, 5, 8, 12)]
    rows = [(i, "".join(rng.choice([text(rng.randint(0, 6)), rng.choice(passages)]) for _ in range(4))) for i in range(60)]
    return rows + [(70, passages[2] * 12), (71, "SHOUT!! " * 60), (72, ""), (73, None), (74, "\n\n \n"),
                   (75, "word " * 50), (76, "new\n" + "word " * 50), (77, "a  b\tc\r\n" * 9), (78, "x " + "a  b\tc\r\n" * 9)]


@pytest.mark.parametrize("min_words", [1, 7, 20])
def test_equals_the_plain_version(spark, min_words):
    rows = corpus()
    got = removed(spark, rows, min_words=min_words)
    want = plain(rows, min_words)
    def words(t):  # blank lines between two repeated runs may stay
        return None if t is None else [x for x in re.split(LINE, t) if x.strip()]
    assert {i: words(r["text"]) for i, r in got.items()} == {i: words(t) for i, t in want.items()}
    assert sum(want[i] != t for i, t in rows) > 20
    assert all((r["removed_chunks"] > 0) == (words(want[i]) != words(dict(rows)[i])) for i, r in got.items())


@pytest.mark.parametrize("low, high, size", [(8, 12, 51), (8, 12, 60), (12, 20, 51), (12, 20, 60), (8, 12, 100)])
def test_passages_inside_a_paragraph_go(spark, low, high, size):
    rng = random.Random(size + low)

    def text(n):
        return "".join(clause(rng, low, high) + ", " for _ in range(n))

    def passage():
        out = ""
        while (left := size - len(out.split())) > 0:
            out += (clause(rng, left, left) if left <= high else clause(rng, low, min(high, left - 1))) + ", "
        return out
    passages = [passage() for _ in range(40)]
    rows, alone = [], {}
    for n in range(80):
        a, b = text(rng.randint(1, 6)), text(rng.randint(1, 6))
        rows.append((n, a + passages[n % 40] + b))
        alone[n] = a + b
    got = removed(spark, rows)
    assert all(got[n]["text"] == (rows[n][1] if n < 40 else alone[n]) for n in range(80))
    assert all(got[n]["removed_words"] == (0 if n < 40 else size) for n in range(80))


def test_rows_of_one_id_null_ids_clashes_and_no_python(spark):
    long = "so many words of one clause " * 10
    df = spark.createDataFrame([(5, long, 1), (5, long, 1), (None, "other " * 30, 1), (None, "other " * 30, 1), (9, "x, " + long, 1)],
                               "doc_id long, text string, removed_words int")
    out = line_dedup.dedup_passages(df)
    assert out.columns == ["doc_id", "text", "removed_chunks", "removed_words"]
    assert sorted((r["text"], r["removed_words"]) for r in out.collect()) == sorted(
        [(long, 0)] * 2 + [("other " * 30, 0)] * 2 + [("x, ", 60)])
    assert line_dedup.dedup_passages(df.where("false")).count() == 0
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().toString())


def counted_pairs(spark, rows, monkeypatch):
    """What goes into the join with the originals: rows, and the runs in them."""
    seen = {}
    real = line_dedup._with_bytes

    def spy(runs, texts):
        seen["pairs"] = runs.select("_k", "_fk").distinct().count()
        seen["copies"] = runs.where("s = -1").count()
        return real(runs, texts)
    monkeypatch.setattr(line_dedup, "_with_bytes", spy)
    return removed(spark, rows), seen


def test_a_thousand_copies_meet_their_original_once(spark, monkeypatch):
    rng = random.Random(8)
    text = "".join(clause(rng, 3, 9) + rng.choice([". ", ", ", "\n"]) for _ in range(60))
    rows = [(n, text) for n in range(1000)] + [(2000, "x y. " + text)]
    got, seen = counted_pairs(spark, rows, monkeypatch)
    assert seen == {"pairs": 1000, "copies": 999}
    assert got[0]["text"] == text and all(got[n]["text"] == "" and got[n]["removed_chunks"] == 1 for n in range(1, 1000))
    assert got[2000]["text"] == "x y. " and got[500]["removed_words"] == len(text.split())


def test_a_line_in_every_document_is_a_pair_each(spark, monkeypatch):
    rng = random.Random(9)
    hot = clause(rng, 25, 25) + "\n"
    rows = [(n, (hot + clause(rng, 5, 5) + "\n") * 1 + hot * (n % 3) + clause(rng, 6, 6)) for n in range(400)]
    got, seen = counted_pairs(spark, rows, monkeypatch)
    assert seen["pairs"] <= 400 and all(hot not in got[n]["text"] for n in range(1, 400))
    assert got[0]["text"].count(hot) == 1


def test_copies_on_both_sides_of_the_smallest_passage(spark):
    rng = random.Random(10)
    short, long = clause(rng, 19, 19), "\n\n" + clause(rng, 20, 20) + " \n"
    got = removed(spark, [(n, short) for n in range(3)] + [(n, long) for n in range(5, 8)])
    assert [got[n]["text"] for n in range(3)] == [short] * 3
    assert [got[n]["text"] for n in range(5, 8)] == [long, "", ""]


def test_one_id_at_a_copy_and_another_text(spark):
    rng = random.Random(11)
    a, b, c = (clause(rng, 30, 30) for _ in range(3))
    rows = [(1, a), (2, b), (3, a), (3, c + "\n" + b)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["text"]) for r in line_dedup.dedup_passages(df).collect())
    assert got == sorted([(1, a), (2, b), (3, ""), (3, c + "\n")])


def test_no_aggregate_of_the_windows_is_sorted(spark, monkeypatch):
    plans = {}
    real = line_dedup.written

    def spy(df, name, *rest):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, name, *rest)
    monkeypatch.setattr(line_dedup, "written", spy)
    removed(spark, corpus())
    assert {"line-windows", "line-repeats", "line-places", "line-firsts"} <= set(plans)
    assert not any("SortAggregate" in plan for plan in plans.values())


def test_a_text_is_scanned_for_line_ends_once(spark):
    rng = random.Random(12)
    texts = ["".join(rng.choice(["a", "\u00e9", "\U0001f600", " ", "  ", "\n", "\n\n", "\t", "\r\n", ".", ", ", "; ", ": ", "!", "? ", "$0"])
                     for _ in range(rng.randint(0, 40))) for _ in range(600)]
    texts += [x.replace("a", "\x01") for x in texts[:200]] + ["!" * 50000, ", " * 50000, "\n" * 50000, "", None]
    df = spark.createDataFrame([(x,) for x in texts], "t string").repartition(4)
    out = df.select("t", line_dedup._lines(df["t"]).alias("x"))
    assert all(r["x"] == (None if r["t"] is None else [y for y in re.split(LINE, r["t"]) if y]) for r in out.collect())
    assert out._jdf.queryExecution().executedPlan().toString().count("replace(") <= 2   # in the plan's tree and below it


def test_the_first_place_in_the_first_document(spark):
    rng = random.Random(13)
    hot = clause(rng, 22, 22) + "\n"
    short = [clause(rng, 5, 5) + "\n" for _ in range(3)]
    rows = [(7, short[0] + hot), (-2, short[1] + hot + short[2] + hot), (9, hot)]
    got = removed(spark, rows)
    assert [got[i]["text"] for i in (7, -2, 9)] == [short[0], short[1] + hot + short[2], ""]


def test_no_text_is_sorted_for_its_originals_and_runs_are_not_aggregated(spark, monkeypatch):
    plans = {}
    real = line_dedup.written

    def spy(df, name, *rest):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, name, *rest)
    monkeypatch.setattr(line_dedup, "written", spy)
    got = removed(spark, corpus())
    assert {i: r["text"] is None for i, r in got.items()} == {i: t is None for i, t in corpus()}
    assert "Sort" not in plans["line-originals"] and "ShuffledHashJoin" in plans["line-originals"]
    assert "_run" not in plans["line-pairs"] and "sum(" not in plans["line-pairs"]


def test_words_of_lines_with_each_end(spark):
    rng = random.Random(14)
    ends = [". ", ", ", "\n", "\n\n", " \n", ". \n", "! \n\n", "; ", ".\n"]
    rows = []
    for n, odd in enumerate(["", "", "x\ty ", " x", "x  y ", "x\r\n"]):   # the last four hold other white space
        part = odd + "".join(clause(rng, 1, 9) + end for end in ends * 3) + clause(rng, 20, 20)
        rows += [(10 * n, part), (10 * n + 1, part), (10 * n + 2, f"one {n}.\n" + part), (10 * n + 3, part + "\nthe end")]
    got = removed(spark, rows)
    for i, t in rows:
        assert got[i]["removed_words"] == len(t.split()) - len(got[i]["text"].split())
        assert i % 10 != 1 or got[i]["text"] == "" and got[i]["removed_chunks"] == 1
        assert i % 10 < 2 or len(got[i]["text"].split()) < 5
