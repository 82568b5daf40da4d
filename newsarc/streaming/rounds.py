"""T1 with E2 over rounds of event time: candidates wait for their bodies, however the files arrive.

A round is a stretch of ``fetched_at``. Each micro-batch leaves two narrow tables behind, by
round: ``offers`` (links of home pages, entries of feeds) and ``facts`` (target and text size of
every fetch). A round is decided once, when the watermark (the latest ``fetched_at`` of all batches,
less ``delay``) has passed its end: then every candidate meets every body of its round, whichever
batch brought them. So the same files in one batch, in three or one by one give the same articles
and the same seen rows.

Everything is kept under the round, not the batch. A batch that is replayed after a failure
finds the same watermark before it (``progress`` rows of earlier batches), writes its own parts over,
and decides the same rounds again into the same partitions. Rows of a round that was decided in an earlier
batch are late: they are counted in ``progress`` and dropped. Rounds are decided one after the other,
as the seen set of a day carries over; the loop is as long as the rounds a batch closes.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsarc.plans import jobs
from newsarc.session import cut
from newsarc.sources.sinks import stored

PROGRESS = "batch_id long, latest timestamp, rows long, late long"


def _overwrite(df: DataFrame, path: str, *parts: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path))


def _round(length: str):
    return F.date_format(F.window("fetched_at", length)["start"], "yyyyMMdd-HHmmss")


def _start(name: str) -> dt.datetime:
    return dt.datetime.strptime(name, "%Y%m%d-%H%M%S")


def _seconds(spark: SparkSession, interval: str) -> float:
    """Length of an interval such as ``1 hour``."""
    return spark.range(1).select((F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {interval}")).cast("double")).first()[0]


class Rounds:
    """The tables under ``root`` and the decision over them; an instance is a ``foreachBatch`` sink."""

    def __init__(self, outlets: DataFrame, archive_results: DataFrame | Callable[[], DataFrame], root: str,
                 length: str = "1 hour", delay: str = "1 hour", n: int = 5, rule: str = "base"):
        """``archive_results`` may be a function, called for each round, where results are still arriving."""
        self.outlets, self.archive_results, self.root = outlets, archive_results, root.rstrip("/")
        self.length, self.n, self.rule = length, n, rule
        spark = outlets.sparkSession
        self.seconds, self.delay = _seconds(spark, length), dt.timedelta(seconds=_seconds(spark, delay))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = self.watermark(spark, batch_id - 1)
        rows = batch.withColumn("round", _round(self.length))
        # a round is decided in the batch after whose rows the watermark has passed its end
        late = self._ended(F.col("round"), before)
        fresh = rows.filter(~late)
        _overwrite(jobs.offers(self.outlets, fresh, ("round",)).withColumn("batch_id", F.lit(batch_id).cast("long")),
                   self.path("offers"), "round", "batch_id")
        _overwrite(jobs.facts(fresh, keep=("round",)).withColumn("batch_id", F.lit(batch_id).cast("long")),
                   self.path("facts"), "round", "batch_id")
        seen = rows.agg(F.max("fetched_at").alias("latest"), F.count(F.lit(1)).alias("rows"),
                        F.count_if(late).alias("late")).withColumn("batch_id", F.lit(batch_id).cast("long"))
        _overwrite(seen.select("latest", "rows", "late", "batch_id"), self.path("progress"), "batch_id")
        self.decide(spark, before, self.watermark(spark, batch_id))
        self.forget(spark, before)

    def watermark(self, spark: SparkSession, batch_id: int | None = None) -> dt.datetime | None:
        """After ``batch_id`` (None: after all): the latest fetch so far less the delay."""
        p = stored(spark, self.path("progress"))
        if p is None:
            return None
        latest = (p if batch_id is None else p.filter(F.col("batch_id") <= batch_id)).agg(F.max("latest")).first()[0]
        return None if latest is None else latest - self.delay

    def _ended(self, name, at: dt.datetime | None):
        """Is the round over at that time? Round names order like their times."""
        if at is None:
            return F.lit(False)
        return F.coalesce(name <= (at - dt.timedelta(seconds=self.seconds)).strftime("%Y%m%d-%H%M%S"), F.lit(False))

    def open_rounds(self, spark: SparkSession) -> list[str]:
        facts = stored(spark, self.path("facts"))   # a row per round: partition names only
        return [] if facts is None else sorted(r[0] for r in facts.select("round").distinct().collect())

    def decide(self, spark: SparkSession, before: dt.datetime | None, until: dt.datetime | None) -> None:
        """Decide the rounds that ended after ``before``, up to ``until`` (None: all), in order."""
        end = [(r, _start(r) + dt.timedelta(seconds=self.seconds)) for r in self.open_rounds(spark)]
        for name, at in end:
            if (before is None or at > before) and (until is not None and at <= until):
                self._decide(spark, name)

    def close(self, spark: SparkSession) -> None:
        """Decide what is still open, at the end of a crawl; running it again changes nothing."""
        before = self.watermark(spark)
        self.decide(spark, before, dt.datetime.max)

    def _decide(self, spark: SparkSession, name: str) -> None:
        offers, facts = (stored(spark, self.path(t)) for t in ("offers", "facts"))
        known = facts.filter(F.col("round") == name)
        seen = stored(spark, self.path("seen"))
        if seen is not None:
            seen = seen.filter(F.col("round") < name)
        results = self.archive_results() if callable(self.archive_results) else self.archive_results
        if offers is None:
            return
        articles, new_seen = jobs.decide(offers.filter(F.col("round") == name), known, results, _start(name), seen,
                                         self.n, self.rule)
        articles = cut(articles)   # both writes use the same rows
        _overwrite(articles.withColumn("round", F.lit(name)), self.path("articles"), "state", "year", "month", "day", "round")
        new_seen = articles.select("website_hash", F.to_date(F.lit(_start(name))).alias("day"), F.col("link").alias("url"))
        _overwrite(new_seen.distinct().withColumn("round", F.lit(name)), self.path("seen"), "day", "round")

    def forget(self, spark: SparkSession, before: dt.datetime | None) -> None:
        """Delete offers and facts of rounds that earlier, finished batches decided."""
        if before is None:
            return
        for name in self.open_rounds(spark):
            if _start(name) + dt.timedelta(seconds=self.seconds) <= before:
                for table in ("offers", "facts"):
                    path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path(table)}/round={name}")
                    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
