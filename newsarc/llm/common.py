"""Helpers shared by the operators: tables, cuts of lineage, words, row positions."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# A-Z to a-z; every other byte stays (so UTF-8 text stays valid).
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# A-Z to a-z; ASCII bytes that are neither digit nor letter become a blank.
ALNUM = bytes(b + 32 if 65 <= b <= 90 else
              (b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32) for b in range(256))


def ship(spark: SparkSession) -> None:
    """Give the executors this package (once per application), wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_newsarc_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="newsarc-py-"), "newsarc_code.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.join("newsarc", os.path.relpath(full, top)))
    sc.addPyFile(path)
    sc._newsarc_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def blank_words(text: str | None) -> list[bytes]:
    """Lower-cased words between blanks (space and 09-0D), as UTF-8."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(LOWER).split()


def alnum_words(text: str | None) -> list[bytes]:
    """Lower-cased words of digits, a-z and all non-ASCII characters, as UTF-8."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(ALNUM).split()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a private one only for a local master."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        configured = sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="newsarc-llm-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and forget its lineage.

    A lost executor costs nothing that was cut; Spark's cleaner removes the
    files once the DataFrame is gone (``cleanCheckpoints``).
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back (compact, prunable).

    The shuffle files behind it go as soon as it is written: nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._newsarc_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made and nothing reads any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._newsarc_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_name(ident: Column, text: Column) -> Column:
    """Names a row for a join: the digest of its id and text, never null.

    Rows that agree in both are one document given twice and are treated alike.
    """
    return F.sha2(F.concat_ws(":", F.coalesce(ident.cast("string"), F.lit("-")), F.coalesce(F.sha2(text, 256), F.lit("-"))), 256)


def with_positions(df: DataFrame, *order: str) -> tuple[DataFrame, dict[int, int]]:
    """Sorted, cut rows with ``pid`` (range) and ``idx`` (row in it), and each range's first position.

    A row's position in the whole order is ``first[pid] + idx``. The ranges are
    dealt by all order columns, so rows that share the leading one are split.
    """
    part = (1 << 33) - 1
    mono = F.monotonically_increasing_id()
    out = cut(df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_mono", mono)
              .withColumn("pid", F.shiftright("_mono", 33).cast("int"))
              .withColumn("idx", F.col("_mono").bitwiseAND(F.lit(part))).drop("_mono"))
    first, at = {}, 0
    for r in sorted(out.groupBy("pid").count().collect()):
        first[r["pid"]] = at
        at += r["count"]
    return out, first
