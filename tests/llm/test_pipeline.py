"""The pipeline's stages against plain versions on the small tables, and odd rows through all of it."""

import numpy as np
import pytest

import corpus_pipeline as P
from newsarc.llm import quality, simhash
from newsarc.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_are_in_order_and_keep_the_columns(spark):
    assert [n for n, _ in P.STAGES] == ["quality", "line_dedup", "near_dedup", "decontaminate", "pack"]
    docs = table(spark, SF, "documents")
    for _, stage in P.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_each_stage_against_a_plain_version(spark):
    docs = table(spark, SF, "documents")
    rows = {r["doc_id"]: r for r in docs.collect()}

    model = quality.train(docs, table(spark, SF, "labels"))
    x = np.array([quality.statistics(r["text"]) for r in rows.values()])
    want = {i for i, p in zip(rows, model.probability(x)) if p >= 0.3}
    assert {r["doc_id"] for r in P.quality_stage(spark, docs, SF).collect()} == want

    cut = P.line_dedup_stage(spark, docs, SF).collect()
    assert len(cut) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in cut)
    assert all(len(r["text"]) <= len(rows[r["doc_id"]]["text"]) for r in cut)

    prints = {i: simhash.fingerprint(r["text"]) & (1 << 64) - 1 for i, r in rows.items()}
    ids, parent = sorted(rows), {i: i for i in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            if bin(prints[i] ^ prints[j]).count("1") <= 2:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    kept = P.near_dedup_stage(spark, docs, SF).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted({find(i) for i in ids})
    assert all(r["text"] == rows[r["doc_id"]]["text"] for r in kept)


def test_odd_documents_pass_through(spark, tmp_path):
    base = table(spark, SF, "documents")
    odd = spark.createDataFrame(
        [(9001, None, "en", None, None), (9002, "", None, "s", 0), (None, "a text without an id, kept as it is. " * 20, "en", "s", 1),
         (9003, "long " * 60_000, "en", "s", 1), (0, "another text under a used id, given twice. " * 30, "en", "s", 1)], base.schema)
    extra = base.unionByName(odd).withColumn("score", P.F.lit("mine")).withColumn("fp", P.F.lit(1)).withColumn("spans", P.F.lit(2)).withColumn("removed_words", P.F.lit(3))
    docs = extra
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == extra.columns
        docs = spark.createDataFrame(out.collect(), extra.schema)
        assert {(r["score"], r["fp"], r["spans"], r["removed_words"]) for r in docs.collect()} == {("mine", 1, 2, 3)}
    packed = P.packing_stage(spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


@pytest.mark.parametrize("k", range(len(P.STAGES)))
def test_empty_documents(spark, k):
    assert P.STAGES[k][1](spark, table(spark, SF, "documents").where("false"), SF).count() == 0


def test_run_packs_what_is_kept(spark):
    out = P.run(spark, SF)
    docs = table(spark, SF, "documents")
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    assert {r[0] for r in out.select("doc_id").distinct().collect()} == {r[0] for r in docs.select("doc_id").collect()}


def test_near_dedup_judges_an_id_for_each_of_its_texts(spark):
    base = table(spark, SF, "documents")
    a, b, c = ("alpha beta gamma delta epsilon zeta eta theta " * 9, "one two three four five six seven eight nine " * 9,
               "rain snow wind sun fog hail storm cloud frost " * 9)
    rows = [(1, a, "en", "s", 1), (2, a, "en", "s", 1), (2, b, "en", "s", 1), (3, c, "en", "s", 1), (3, b, "en", "s", 1),
            (None, c, "en", "s", 1), (None, "null id " * 30, "en", "s", 1), (None, "null id " * 30, "en", "t", 1), (5, None, "en", "s", None),
            (6, "", None, "s", 0), (7, "row twice " * 30, "en", "s", 1), (7, "row twice " * 30, "en", "s", 2)]
    got = P.near_dedup_stage(spark, spark.createDataFrame(rows, base.schema), SF).collect()
    key = lambda r: (str(r["doc_id"]), str(r["text"])[:9])
    assert sorted(map(key, got)) == sorted([("1", a[:9]), ("2", b[:9]), ("3", c[:9]), ("None", "null id n"), ("5", "None"), ("7", "row twice")])
