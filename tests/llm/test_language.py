"""Language identification: held-out accuracy, the two steps, what is learnt from, odd inputs."""

import zlib

import numpy as np

from newsarc.llm import language

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got["held_out"]]
    assert len(held) > 150 and (held["lang"] == held["lang_pred"]).mean() > 0.98
    assert got["score"].between(0, 1).all()
    assert all((zlib.crc32(str(i).encode()) % 4 == 2) == h for i, h in zip(got["doc_id"], got["held_out"]))


def test_machine_separates_and_equals_a_plain_minimum():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((120, 3))
    y = np.where(x @ [1.0, -2.0, 0.5] + 0.3 + 0.3 * rng.standard_normal(120) > 0, 1.0, -1.0)
    w = language.machine(x, y, rounds=2000)
    assert (np.sign(x @ w[:-1] + w[-1]) == y).mean() > 0.9
    # plain version: gradient descent on the primal problem
    full, share = np.hstack([x, np.ones((120, 1))]), np.where(y > 0, (y > 0).mean(), (y < 0).mean())
    v = np.zeros(4)
    for _ in range(20_000):
        loss = np.maximum(0, 1 - y * (full @ v))
        v -= 1e-3 * (v - (full * (loss * y / share)[:, None]).sum(axis=0))
    assert np.allclose(w, v, atol=0.02)


def test_family_first_then_a_duel_within_it():
    assert language.family("DE") == language.family("en-GB") != language.family("fr") == language.family("pt_BR")
    assert language.family("xx") != language.family("yy")
    rng = np.random.default_rng(2)
    centres = {"de": [9, 0, 3, 0], "en": [9, 0, 0, 3], "nl": [9, 0, -3, -3], "fr": [0, 9, 3, 0], "es": [0, 9, 0, 3], "xx": [-9, -9, 0, 0]}
    names = np.array(sorted(centres) * 40, dtype=object)
    x = np.array([centres[n] for n in names]) + 0.5 * rng.standard_normal((len(names), 4))
    tree = language.Tree(x, names)
    assert tree.families.names == ["=xx", "germanic", "romance"]
    assert [len(d.pairs) for d in tree.languages] == [0, 3, 1]      # languages meet only within their family
    found, score = tree.predict(x)
    assert found == names.tolist() and ((score > 0.5) & (score <= 1)).all()
    assert tree.predict(x[:0])[0] == []


def test_grams_of_whole_texts(monkeypatch):
    text = "Straße — 12 Über uns, ça va! " * 50
    whole = language.grams(text)
    assert np.isclose(whole @ whole, 1) and np.array_equal(whole, language.grams(text.replace("12", " 7 99 ")))
    assert not language.grams(None).any() and not language.grams(" 12 .!\n").any()
    monkeypatch.setattr(language, "PART", 64)
    assert language.grams(text) @ whole > 0.97      # pieces cut a few words only
    assert language.grams("x " * 500 + "zebra")[language.grams("zebra") > 0].all()   # the end counts too


def test_odd_rows_and_nothing_learnt_from_held_out_rows(spark):
    en, fr = "the house of the people and that was it ", "la maison des gens et voici que cela est "
    rows = [(i, (en if i % 2 else fr) * 3, "en" if i % 2 else "fr", "x") for i in range(60)]
    rows = [r if zlib.crc32(str(r[0]).encode()) % 4 != 2 else (*r[:2], "tlh", "x") for r in rows]   # held out: not learnt
    rows += [(100, None, "en", "x"), (101, "", "en", "x"), (102, "12 !? ²", "en", "x"), (None, en, "zz", "x"), (103, en * 20000, None, "x"),
             (103, fr, None, "x"), (103, fr, None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = language.identify(df).collect()
    assert len(got) == len(rows)
    by = [(r["doc_id"], r["lang_pred"]) for r in got]
    assert all(p == ("en" if i % 2 else "fr") for i, p in by if i is not None and i < 60)
    assert {p for i, p in by if i in (100, 101, 102)} == {"und"} and all(r["score"] == 0 for r in got if r["lang_pred"] == "und")
    assert sorted(p for i, p in by if i == 103) == ["en", "fr", "fr"]
    assert [(r["lang_pred"], r["held_out"]) for r in got if r["doc_id"] is None] == [("en", True)]
    kept = language.predict(df, language.train(df))
    assert kept.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    assert language.identify(df.where("false")).count() == 0
    none = language.identify(df.withColumn("lang", df["lang"].substr(9, 1).eqNullSafe("?").cast("string")).where("lang IS NULL"))
    assert none.count() == 0
    assert {r["lang_pred"] for r in language.identify(df.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")).collect()} == {"und"}
    few = language.train(df, max_rows=4)
    assert [len(d.names) for d in few.languages] == [1, 1]
