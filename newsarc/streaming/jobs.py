"""Structured Streaming forms of the collector loop.

The reference polls every outlet in an endless loop; here new fetch results
arrive as files and each operator is a streaming DataFrame transformation or
a ``foreachBatch`` step. State lives in the checkpoint folder (the shared
``spark.checkpoint.dir``), so a lost executor or a restarted query resumes
where it stopped. Event time is ``fetched_at``/``seen_at``. Windowed
aggregations (T5, T6) drop rows later than the watermark and count them in
the query's progress (``numRowsDroppedByWatermark``); the watermark
deduplications (T2, T4) use it to evict old state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsarc.functions.records import archive_outcome
from newsarc.session import checkpoint_path, ensure_checkpoint_dir
from newsarc.sources.sinks import stored, write_seen


def start(df: DataFrame, name: str, sink: Callable[[DataFrame, int], None] | None = None,
          fmt: str | None = None, path: str | None = None, mode: str = "append",
          available_now: bool = True, processing_time: str | None = None,
          checkpoint: str | None = None):
    """Start a query under a checkpoint in the shared checkpoint folder.

    ``available_now`` drains what is there and stops (a scheduled round);
    ``processing_time`` runs rounds forever, like the collectors' loop.
    """
    spark = df.sparkSession
    w = df.writeStream.queryName(name).outputMode(mode).option(
        "checkpointLocation", checkpoint or checkpoint_path(spark, f"streams/{name}"))
    if sink is not None:
        w = w.foreachBatch(sink)
    else:
        w = w.format(fmt or "parquet")
        if path:
            w = w.option("path", path)
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    return w.start()


def stream_dedup(df: DataFrame, keys: tuple[str, ...] = ("website_hash", "url"),
                 ts: str = "seen_at", delay: str = "1 day") -> DataFrame:
    """A URL of a site is taken once per calendar day (seen set as state).

    The day is part of the key, as the collectors keep one seen set per day's
    folder; the watermark only evicts days that are over.
    """
    d = df.withColumn("day", F.to_date(F.col(ts)))
    return d.withWatermark(ts, delay).dropDuplicatesWithinWatermark([*keys, "day"])


def stream_site_records(df: DataFrame, ts: str = "fetched_at", delay: str = "1 day") -> DataFrame:
    """T4: one site record per site and day."""
    d = df.withColumn("day", F.to_date(F.col(ts)))
    return d.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["website_hash", "day"])


def stream_usage(df: DataFrame, ts: str = "ts", length: str = "length", crawl: str = "collection",
                 window: str = "1 day", slide: str | None = None, delay: str = "1 day") -> DataFrame:
    """T5: bytes and documents per collection in tumbling (or sliding) event-time windows."""
    win = F.window(ts, window, slide) if slide else F.window(ts, window)
    g = df.withWatermark(ts, delay).groupBy(win.alias("w"), crawl).agg(
        F.count(F.lit(1)).alias("documents"), F.sum(length).alias("bytes"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    crawl, "documents", "bytes")


def stream_sessions(log: DataFrame, ts: str = "timestamp", key: str = "page",
                    gap: str = "60 seconds", delay: str = "10 minutes") -> DataFrame:
    """Bursts of crawl activity per page: a new session after ``gap`` of quiet.

    A page's open session is one state row; rows of one page in one batch meet
    in one task (the engine's rule for session windows).
    """
    g = log.withWatermark(ts, delay).groupBy(F.session_window(ts, gap).alias("s"), key).agg(
        F.count(F.lit(1)).alias("events"))
    return g.select(key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                    "events")


# ------------------------------------------------------------- foreachBatch

def append_batch(root: str, partition_by: tuple[str, ...] = ("state", "year", "month", "day")):
    """``foreachBatch`` sink appending rows to the tree, idempotent by batch id.

    Each batch owns the partition ``batch_id=<id>`` under its day partitions
    and is written with dynamic partition overwrite: a batch replayed after a
    failure replaces its own files instead of adding a second copy.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        out = batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_by, "batch_id").parquet(root))
    return sink


def cap_batch(root: str, n: int = 5, site: str = "website_hash", rnd: str = "round",
              order: tuple[str, ...] = ("origin", "feed_pos", "entry_pos", "url")):
    """5 links per site and round, kept across micro-batches.

    For each batch: slots left = n - rows already stored for (site, round);
    the batch's candidates are ranked per (site, round) in the batch order and
    the first ``slots left`` are appended. The stored counts are an aggregate
    over the sink table (one row per site and round), joined on the key.
    Replays are idempotent (the batch's own partition is overwritten and its
    own rows are not counted as stored).
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        old = stored(spark, root)
        keys = [site, rnd]
        if old is not None:
            # only the rounds of this batch are read: a semi join on the partition column
            used = old.filter(F.col("batch_id") != batch_id) \
                .join(batch.select(rnd).distinct(), rnd, "left_semi") \
                .groupBy(*keys).agg(F.count(F.lit(1)).alias("_used"))
            cand = batch.join(used, keys, "left")
        else:
            cand = batch.withColumn("_used", F.lit(0).cast("long"))
        w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
        ranked = cand.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n) \
            .filter(F.col("_r") + F.coalesce(F.col("_used"), F.lit(0)) <= n) \
            .withColumn("rank", (F.col("_r") + F.coalesce(F.col("_used"), F.lit(0))).cast("int")) \
            .drop("_r", "_used")
        (ranked.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(rnd, "batch_id").parquet(root))
    return sink


def retry_batch(retry_root: str, out_root: str, delay_minutes: int = 60, max_tries: int = 3):
    """Failed archive calls come back later.

    Each batch of archive results (url, output, called_at[, tries]) is split
    by P14: archived rows go to ``out_root``; every outcome also goes to the
    retry table: a retryable failure with tries left as ``due`` from ``called_at +
    delay`` on, others as ``gave_up``, a success as ``done``, which closes the URL. A
    caller takes ``due_retries`` into its next round. Both writes are idempotent
    by batch id; ``compact_retries`` keeps the table as small as what is open.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        b = batch if "tries" in batch.columns else batch.withColumn("tries", F.lit(0))
        b = b.withColumn("_o", archive_outcome("output")).withColumn("batch_id", F.lit(batch_id).cast("long"))
        done = F.col("_o.status") == "archived"
        ok = b.filter(done).select(
            "url", F.col("_o.archive_url").alias("archive_ref"), F.col("called_at").alias("archived_time"),
            "batch_id")
        tries = F.col("tries") + F.when(done, 0).otherwise(1)
        state = (F.when(done, "done").when((tries >= max_tries) | ~F.col("_o.retryable"), "gave_up").otherwise("due"))
        outcome = b.filter(done | (F.col("_o.status") == "failed")).select(
            "url", tries.cast("int").alias("tries"),
            (F.col("called_at") + F.expr(f"INTERVAL {int(delay_minutes)} MINUTES")).alias("not_before"),
            state.alias("state"), "batch_id")
        for df, root in ((ok, out_root), (outcome, retry_root)):
            (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(root))
    return sink


def _latest_outcome(r: DataFrame) -> DataFrame:
    """Per URL its last outcome; within one batch the later call, a success before a failure of the same time."""
    order = F.struct("batch_id", "not_before", F.col("state") == "done", "tries")
    return r.groupBy("url").agg(F.max_by(F.struct("tries", "not_before", "state", "batch_id"), order).alias("l")) \
        .select("url", "l.*")


def due_retries(spark: SparkSession, retry_root: str, now) -> DataFrame:
    """URLs whose last outcome is due by ``now`` (to union into a round)."""
    r = stored(spark, retry_root)
    if r is None:
        return spark.createDataFrame([], "url string, tries int")
    return _latest_outcome(r).filter((F.col("state") == "due") & (F.col("not_before") <= F.lit(now).cast("timestamp"))) \
        .select("url", "tries")


def compact_retries(spark: SparkSession, retry_root: str, compact_root: str) -> None:
    """T8 upkeep: only the last outcome of URLs that are still due, as a new table for the next rounds."""
    r = stored(spark, retry_root)
    if r is not None:
        _latest_outcome(r).filter("state = 'due'").write.mode("overwrite").partitionBy("batch_id").parquet(compact_root)


def collect_batch(outlets: DataFrame, archive_results: DataFrame, articles_root: str, seen_root: str,
                  n: int = 5, rule: str = "base"):
    """T1 + E2 as a ``foreachBatch`` step: each micro-batch of fetch results is one round.

    The round's candidates are checked against the stored seen set, capped,
    joined to the archive results and appended under their day partitions and
    ``batch_id``. The seen rows carry the batch id too and are kept under the day
    of the run, the day they are read by. A replayed batch ignores its own seen
    rows and overwrites its own partitions, so it finds and writes the same.
    """
    from newsarc.plans.jobs import collect_articles

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run_ts = batch.agg(F.max("fetched_at")).first()[0]
        if run_ts is None:
            return
        seen = stored(spark, seen_root)
        if seen is not None:
            seen = seen.filter(F.col("batch_id") != batch_id)
        articles, _ = collect_articles(outlets, batch, archive_results, run_ts, seen, n, rule)
        # cut the lineage once (shared checkpoint folder): both writes use the same rows
        ensure_checkpoint_dir(spark)
        articles = articles.checkpoint(eager=True)
        (articles.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy("state", "year", "month", "day", "batch_id").parquet(articles_root))
        new_seen = articles.select("website_hash", F.to_date(F.lit(run_ts).cast("timestamp")).alias("day"),
                                   F.col("link").alias("url"))
        write_seen(new_seen, seen_root, batch_id)
    return sink
