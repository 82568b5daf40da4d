"""Spark session set-up and the few settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job of the library assumes. AQE re-plans joins and coalesces
# shuffle partitions at run time; skew-join splitting handles hot sites/hosts.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Cap for automatic broadcast: the planner only broadcasts a side whose
    # estimated size is below it, otherwise it shuffles both sides.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # checkpoints are removed once their DataFrame is garbage-collected
    # (a static setting: applied where this library builds the session)
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, partitions: int | None = None,
                  app: str = "newsarc") -> SparkSession:
    """Session for tests, bench and the driver; on a cluster ``master`` is None."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.driver.memory", "16g")
        builder = builder.config("spark.ui.enabled", "false")
        if master.startswith("local"):  # one machine: a private folder is shared by all its tasks
            builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="newsarc-ckpt-"))
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to a session someone else built."""
    for key, value in DEFAULT_CONF.items():
        try:
            spark.conf.set(key, value)
        except Exception:  # static conf on a running session: keep theirs
            pass
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder: the cluster's ``spark.checkpoint.dir``, which must be set.

    Only streams and the sinks that read what they append to need it; no
    query does.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    configured = configured or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder (stream state, cut tables)."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder once, its lineage forgotten.

    For rows that are costly to make and read several times, and for iterations. Survives the
    loss of an executor; Spark's cleaner removes the files when the DataFrame is gone. Where no
    folder is set, a local master gets a private one (one machine shares it with all its tasks).
    """
    spark = df.sparkSession
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured and not spark.sparkContext.getCheckpointDir() and spark.sparkContext.master.startswith("local"):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="newsarc-ckpt-"))
    ensure_checkpoint_dir(spark)
    return df.checkpoint(eager=True)
