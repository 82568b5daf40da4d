"""From raw documents to packed training windows, in five stages.

quality       documents that the classifier rejects go
line_dedup    repeated passages are cut out of the texts
near_dedup    one document of each SimHash component stays (the smallest doc_id)
decontaminate documents that hold a verbatim window of the benchmark go
pack          the rest as token pieces in windows of 2048 ids

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; between two stages the documents are a Parquet table in the shared folder.
All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsarc.llm import decontaminate, kk_packing, line_dedup, quality, simhash
from newsarc.llm.common import drop, row_name, ship, table, written

THRESHOLD = 0.3  # documents with a lower score go


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least THRESHOLD; the labels of this table are learnt from."""
    ship(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, name="_quality").where(F.col("_quality") >= THRESHOLD).select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages; n_chars, if there, is counted anew. No row goes."""
    out = line_dedup.dedup_passages(docs, prefix="_dedup_")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: the smallest doc_id (a null one last), whichever rows share it.

    Rows are named by id and text: an id that stands at two texts is two documents, a row that is given
    twice is one. One exchange by name serves the join and the choice among equal rows.
    """
    ship(spark)
    keep = simhash.representatives(docs)
    named = docs.withColumn("_name", row_name(F.col("doc_id"), F.col("text")))
    kept = named.join(keep.select(F.col("k").alias("_name")), "_name", "left_semi")
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    order = Window.partitionBy("_name").orderBy(*[F.col(f"`{c}`").cast("string") for c in rest] or [F.lit(0)])
    return kept.withColumn("_n", F.row_number().over(order)).where("_n = 1").select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten consecutive words of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces with their ids, windows and places there."""
    ship(spark)
    return kk_packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontamination_stage),
    ("pack", packing_stage),
]

# SQL cannot express the classifier, the fingerprints or the tokenizer; tests/llm/test_pipeline.py
# holds the stages against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        kept = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            drop(before)   # what a stage has read goes; the last one's input is read by the result
        docs = before = kept
    return STAGES[-1][1](spark, docs, sf_dir)
