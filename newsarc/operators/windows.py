"""Windows, caps, quotas, top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsarc.operators import ordered


def cap_per_site(df: DataFrame, n: int = 5, site: tuple[str, ...] = ("website_hash",),
                 order: tuple[str, ...] = ("origin", "feed_pos", "entry_pos", "url"),
                 out: str = "rank") -> DataFrame:
    """At most ``n`` links per site (and round), feed links first, in order.

    ``row_number() <= n`` is planned as a WindowGroupLimit: each map task keeps
    its best ``n`` rows per site before the shuffle, so a site with millions
    of candidates still moves at most ``n`` rows per task.
    """
    w = Window.partitionBy(*site).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= n)


def cap_first_version(df: DataFrame, n: int = 11, min_feed: int = 10,
                      site: tuple[str, ...] = ("website_hash",),
                      order: tuple[str, ...] = ("origin", "feed_pos", "entry_pos", "url"),
                      out: str = "rank") -> DataFrame:
    """The first collector's cap. Up to ``n`` links; home-page links
    (origin 1) only when the feed gave fewer than ``min_feed``.
    """
    ranked = cap_per_site(df, n, site, order, out)
    w = Window.partitionBy(*site)
    feed_n = F.sum(F.when(F.col("origin") == 0, 1).otherwise(0)).over(w)
    return ranked.withColumn("_feed_n", feed_n) \
        .filter((F.col("origin") == 0) | (F.col("_feed_n") < min_feed)).drop("_feed_n")


def daily_quota(df: DataFrame, n: int = 200, day: str = "day",
                site_rank: str = "rank", site: str = "website_hash",
                order: tuple[str, ...] = ("url",)) -> DataFrame:
    """The archive takes ``n`` URLs a day; the rest waits ``day_offset`` days.

    Order inside a day: round robin over sites (every site's first link, then
    every site's second, ...), sites by hash. The rank comes from range
    partitions of (day, site rank, site, url), so one day, however large,
    never lands in a single task.
    """
    ranked = ordered.ranked_by_range(df, [site_rank, site, *order], [day], out="quota_rank")
    return ranked.withColumn(
        "day_offset", F.floor((F.col("quota_rank") - 1) / F.lit(n)).cast("int"))


def first_by_priority(df: DataFrame, key: list[str], value: str, prio: str, pos: str,
                      out: str | None = None) -> DataFrame:
    """Per key, the value with the smallest (priority, position)."""
    return df.groupBy(*key).agg(
        F.min_by(F.col(value), F.struct(F.col(prio), F.col(pos))).alias(out or value))


def capture_changes(captures: DataFrame, key: str = "urlkey", ts: str = "ts",
                    digest: str = "digest", tiebreak: str | None = None) -> DataFrame:
    """Per URL over time, each capture is ``first``, ``changed`` or ``unchanged``
    against the previous capture's digest (over range partitions: no URL is
    ever sorted whole in one task)."""
    order = [ts] + ([tiebreak] if tiebreak else [])
    prev = ordered.previous_value(captures, [key], order, digest, out="prev_digest", exists="_had")
    change = (F.when(~F.col("_had"), F.lit("first"))
              .when(F.col("prev_digest").eqNullSafe(F.col(digest)), F.lit("unchanged"))
              .otherwise(F.lit("changed")))
    return prev.withColumn("change", change).drop("_had")


def crawl_progress(captures: DataFrame, crawl: str = "collection", ts: str = "ts",
                   length: str = "length", tiebreak: str | None = None) -> DataFrame:
    """Cumulative documents and bytes of each crawl over time."""
    order = [ts] + ([tiebreak] if tiebreak else [])
    out = ordered.running_sums(captures.withColumn("_one", F.lit(1)), [crawl], order,
                               {"cum_docs": "_one", "cum_bytes": length})
    return out.drop("_one").withColumn("cum_docs", F.col("cum_docs").cast("long"))


def top_n(df: DataFrame, by: str, n: int, tiebreak: str | None = None) -> DataFrame:
    """The ``n`` largest rows by ``by`` (ties by ``tiebreak`` ascending)."""
    order = [F.col(by).desc()] + ([F.col(tiebreak).asc()] if tiebreak else [])
    return df.orderBy(*order).limit(n)


def page_durations(log: DataFrame, crawl: str = "collection", page: str = "page",
                   ts: str = "timestamp", start_msg: str = "Awaiting page load",
                   end_msg: str = "Page Finished") -> DataFrame:
    """One row per visit of a page in a crawl: its start message and the first finish after it.

    A visit runs from one start to the page's next one; ``finished`` is NULL when
    the page did not finish in between, finishes before any start are left out.
    """
    is_start = F.col("message").contains(start_msg)
    is_end = F.col("message").contains(end_msg)
    # the visit is the number of starts so far, counted over key ranges: a page with very many rows is
    # several ranges. A finish logged in the same instant as a start belongs to the visit before.
    rows = log.filter(F.col(page).isNotNull() & (is_start | is_end)).select(
        crawl, page, ts, is_start.cast("int").alias("_start"), is_end.alias("_end"))
    visits = ordered.running_sums(rows, [crawl, page], [ts, "_start"], {"visit": "_start"}).filter(F.col("visit") > 0)
    is_start, is_end = F.col("_start") == 1, F.col("_end")
    agg = visits.groupBy(crawl, page, "visit").agg(
        F.min(F.when(is_start, F.col(ts))).alias("started"),
        F.min(F.when(is_end, F.col(ts))).alias("finished"))
    return agg.withColumn("seconds",
                          F.col("finished").cast("double") - F.col("started").cast("double"))


def url_order(captures: DataFrame, key: str = "urlkey", ts: str = "ts",
              partitions: int | None = None) -> DataFrame:
    """The index order (urlkey, time): range partitioning + local sort."""
    if partitions:
        captures = captures.repartitionByRange(partitions, key, ts)
    return captures.sortWithinPartitions(key, ts) if partitions else captures.orderBy(key, ts)
