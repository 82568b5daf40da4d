"""Sinks (S2-S7): the archive tree as partitioned tables.

The reference writes ``news/<state>/<y>/<m>/<d>/<md5(site)>/...`` with one
gzip file per site and day. Here the same tree is Hive partitions
``state/year/month/day`` (pruned on read); the site hash is a column the
files are clustered by, or a fifth partition level when asked for (fine for a
state's few hundred sites a day, too fine for a national archive).

Writes are rebalanced by the partition columns: AQE splits a busy state or day
over as many tasks as its measured size needs and joins small ones.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsarc.functions.urls import url_hash
from newsarc.session import ensure_checkpoint_dir

DAY_PARTS = ("state", "year", "month", "day")


def with_day_parts(df: DataFrame, ts: str = "archived_time") -> DataFrame:
    """Add year, month, day (UTC, not zero-padded in paths) from a timestamp."""
    t = F.col(ts)
    return df.withColumn("year", F.year(t)).withColumn("month", F.month(t)).withColumn("day", F.dayofmonth(t))


def _spread(df: DataFrame, parts: list[str]) -> DataFrame:
    """Rows of a partition together, as many writers as its measured size needs.

    The REBALANCE hint lets AQE split a site-day of any size and join small ones.
    """
    return df.hint("rebalance", *[F.col(c) for c in parts])


def stored(spark, root: str) -> DataFrame | None:
    """The table under ``root``; None if nothing was written yet. Any other read error is raised."""
    try:
        return spark.read.parquet(root)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def write_registry(outlets: DataFrame, path: str, nested: bool = False) -> None:
    """The enriched registry.

    Flat Parquet by default. ``nested=True`` writes JSON lines, one per state:
    ``{"state": ..., "registry": {media: [outlet, ...]}}``; a state's outlets
    are a bounded group (hundreds), never the whole registry in one row.
    """
    if not nested:
        outlets.write.mode("overwrite").parquet(path)
        return
    cols = [c for c in outlets.columns if c not in ("state", "media")]
    per_media = outlets.groupBy("state", "media").agg(
        F.collect_list(F.struct(*cols)).alias("outlets"))
    per_state = per_media.groupBy("state").agg(
        F.map_from_entries(F.collect_list(F.struct("media", "outlets"))).alias("registry"))
    per_state.write.mode("overwrite").json(path)


def write_articles(articles: DataFrame, root: str, fmt: str = "parquet",
                   site_partition: bool = False) -> None:
    """S3: append article records under state/year/month/day[/website_hash].

    ``fmt='json'`` writes gzip JSON lines as the collectors did.
    """
    parts = list(DAY_PARTS) + (["website_hash"] if site_partition else [])
    w = _spread(articles, list(DAY_PARTS)).write.mode("append").partitionBy(*parts)
    if fmt == "json":
        w.option("compression", "gzip").json(root)
    else:
        w.parquet(root)


def write_bodies(bodies: DataFrame, root: str) -> None:
    """Article HTML as Parquet rows (url_hash = md5(url), body), not one file per page."""
    out = bodies.withColumn("url_hash", url_hash("url"))
    _spread(out, list(DAY_PARTS)).write.mode("append").partitionBy(*DAY_PARTS).parquet(root)


def write_site_records(records: DataFrame, root: str) -> DataFrame:
    """One site record per site and day; only those not stored yet are appended.

    Of several new records of a site and day the earliest stays. Returns the
    rows written. Stored keys are read for the new rows' days only: a semi join
    on the partition columns, which prunes the partitions at run time.
    """
    spark = records.sparkSession
    keys = list(DAY_PARTS) + ["website_hash"]
    rest = [c for c in records.columns if c not in keys]
    first = F.min(F.struct(*sorted(rest, key=lambda c: c != "archived_time"))).alias("_r")
    new = records.groupBy(*keys).agg(first).select(*keys, *[F.col(f"_r.{c}") for c in rest])
    old = stored(spark, root)
    if old is not None:
        days = new.select(*DAY_PARTS).distinct()
        new = new.join(old.select(*keys).join(days, list(DAY_PARTS), "left_semi"), keys, "left_anti")
    # the anti join reads the table being appended to: cut the lineage first
    # (reliable checkpoint in the shared spark.checkpoint.dir), so the rows
    # written and the rows returned are the same
    ensure_checkpoint_dir(spark)
    new = new.checkpoint(eager=True)
    _spread(new, list(DAY_PARTS)).write.mode("append").partitionBy(*DAY_PARTS).parquet(root)
    return new


def write_run_articles(articles: DataFrame, root: str, run_ts) -> None:
    """Articles of one run in their own partition ``run_ts`` (first collector)."""
    out = articles.withColumn("run_ts", F.date_format(F.lit(run_ts).cast("timestamp"), "yyyyMMddHHmmss"))
    _spread(out, list(DAY_PARTS)).write.mode("append").partitionBy(*DAY_PARTS, "run_ts").parquet(root)


def read_seen(spark, root: str) -> DataFrame:
    """The seen-URL table (website_hash, day, url[, batch_id])."""
    return spark.read.parquet(root)


def write_seen(seen_new: DataFrame, root: str, batch_id: int | None = None) -> None:
    """Append only (site, day, url) rows not stored yet.

    With ``batch_id`` the rows stand in the batch's own partition, which a
    replay of the batch overwrites; its own rows do not count as stored.
    """
    spark = seen_new.sparkSession
    keys = ["website_hash", "day", "url"]
    new = seen_new.select(*keys).distinct()
    old = stored(spark, root)
    if old is not None:
        if batch_id is not None:
            old = old.filter(F.col("batch_id") != batch_id)
        days = new.select("day").distinct()
        new = new.join(old.select(*keys).join(days, "day", "left_semi"), keys, "left_anti")
    if batch_id is None:
        _spread(new, ["day"]).write.mode("append").partitionBy("day").parquet(root)
    else:
        # the overwritten partition is read by nobody else: cut before it is replaced
        ensure_checkpoint_dir(spark)
        new = new.withColumn("batch_id", F.lit(batch_id).cast("long")).checkpoint(eager=True)
        (_spread(new, ["day"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("day", "batch_id").parquet(root))
