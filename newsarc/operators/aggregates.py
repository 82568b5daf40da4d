"""Aggregations and reports.

All are hash aggregates with a partial (map-side) step; reports keyed by a
host or seed therefore survive a host holding a third of the captures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsarc.functions import urls as U
from newsarc.functions.records import archive_outcome


def _n():
    return F.count(F.lit(1)).cast("long")


def media_counts(outlets: DataFrame, media: str = "media") -> DataFrame:
    """A1: outlets per media type plus the total row (``media`` NULL)."""
    return outlets.rollup(media).agg(_n().alias("n_outlets"))


def coverage(outlets: DataFrame, state: str = "state", media: str = "media") -> DataFrame:
    """A2: outlets per state x media with alive and with-feed counts, all subtotals."""
    alive = F.col("website_status").between(200, 299)
    has_feed = F.coalesce(F.size("rss"), F.lit(0)) > 0
    return outlets.cube(state, media).agg(
        _n().alias("n_outlets"),
        F.count_if(F.coalesce(alive, F.lit(False))).cast("long").alias("n_alive"),
        F.count_if(has_feed).cast("long").alias("n_with_feed"))


def seed_report(captures: DataFrame, seed: str = "collection") -> DataFrame:
    """A3: documents and bytes per seed."""
    return captures.groupBy(seed).agg(_n().alias("documents"),
                                      F.sum("length").cast("long").alias("bytes"))


def host_report(captures: DataFrame, url: str = "url") -> DataFrame:
    """A4: documents and bytes per host (netloc of the URL)."""
    return captures.withColumn("host", U.url_netloc(F.col(url))).groupBy("host").agg(
        _n().alias("documents"), F.sum("length").cast("long").alias("bytes"))


def file_type_report(captures: DataFrame, mime: str = "mime") -> DataFrame:
    """A5: documents and bytes per MIME type (missing -> 'unknown')."""
    return captures.withColumn("file_type", F.coalesce(F.col(mime), F.lit("unknown"))) \
        .groupBy("file_type").agg(_n().alias("documents"),
                                  F.sum("length").cast("long").alias("bytes"))


def seed_metrics(captures: DataFrame, crawl_pages: DataFrame, seed: str = "collection") -> DataFrame:
    """Per seed: documents, bytes, 2xx/3xx/4xx/5xx counts, robots failures and the robots-blocked flag.

    A seed is blocked by robots when its robots.txt failed and no page answered 2xx.
    """
    s = F.col("status")
    robots = F.col("url").endswith("/robots.txt")
    m = captures.groupBy(seed).agg(
        _n().alias("documents"), F.sum("length").cast("long").alias("bytes"),
        F.count_if(s.between(200, 299)).cast("long").alias("ok"),
        F.count_if(s.between(300, 399)).cast("long").alias("redirects"),
        F.count_if(s.between(400, 499)).cast("long").alias("client_errors"),
        F.count_if(s.between(500, 599)).cast("long").alias("server_errors"),
        F.count_if(robots & (s >= 400)).cast("long").alias("robots_fail"),
        F.count_if(~robots & s.between(200, 299)).alias("_pages"))
    m = m.withColumn("robots_blocked", (F.col("robots_fail") > 0) & (F.col("_pages") == 0)).drop("_pages")
    seeds = crawl_pages.filter(F.col("seed")).groupBy(seed).agg(_n().alias("seeds"))
    return m.join(seeds, seed, "full")


def daily_usage(captures: DataFrame, budget_bytes: int | None = None,
                crawl: str = "collection", ts: str = "ts") -> DataFrame:
    """Bytes and documents per day and collection; with a budget, what is left."""
    d = captures.groupBy(F.to_date(F.col(ts)).alias("day"), crawl).agg(
        _n().alias("documents"), F.sum("length").cast("long").alias("bytes"))
    if budget_bytes is not None:
        from pyspark.sql import Window
        w = Window.partitionBy(crawl).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
        d = d.withColumn("budget_left", F.lit(budget_bytes) - F.sum("bytes").over(w))
    return d


def average_usage(captures: DataFrame, crawl: str = "collection", ts: str = "ts") -> DataFrame:
    """Days with captures and average bytes per such day of each collection."""
    return daily_usage(captures, None, crawl, ts).groupBy(crawl).agg(
        _n().alias("days"), F.floor(F.sum("bytes") / _n()).cast("long").alias("bytes_per_day"))


def archive_outcomes(archive_results: DataFrame, keys: tuple[str, ...] = ("website_hash",)) -> DataFrame:
    """Found / archived / failed / server errors per site (and run)."""
    o = archive_outcome("output")
    return archive_results.withColumn("_o", o).groupBy(*keys).agg(
        _n().alias("found"),
        F.count_if(F.col("_o.status") == "archived").cast("long").alias("archived"),
        F.count_if(F.col("_o.status") == "failed").cast("long").alias("failed"),
        F.count_if(F.col("_o.retryable")).cast("long").alias("server_errors"))


def duplicate_share(captures: DataFrame, digest: str = "digest", approx: bool = False,
                    keys: tuple[str, ...] = (), order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """Captures and bytes whose digest was captured before (redundancy).

    Exact: the first capture of each digest is unique, every other one a
    duplicate; computed from per-digest counts (an aggregate, not a window).
    ``approx`` uses HyperLogLog for the distinct count only.
    """
    if approx:
        return captures.groupBy(*keys).agg(
            _n().alias("captures"),
            F.approx_count_distinct(digest).cast("long").alias("distinct_digests"))
    per = captures.groupBy(*keys, digest).agg(
        _n().alias("_n"), F.sum("length").cast("long").alias("_b"),
        F.min_by(F.col("length"), F.struct(*order)).cast("long").alias("_first_b"))
    return per.groupBy(*keys).agg(
        F.sum("_n").cast("long").alias("captures"),
        F.count(F.lit(1)).cast("long").alias("distinct_digests"),
        (F.sum("_n") - F.count(F.lit(1))).cast("long").alias("duplicate_captures"),
        F.sum("_b").cast("long").alias("bytes"),
        (F.sum("_b") - F.sum("_first_b")).cast("long").alias("duplicate_bytes"))


SKETCH_BITS = 14   # 2^14 registers a sketch: a standard error of 0.8 %


def duplicate_sketches(captures: DataFrame, digest: str = "digest", keys: tuple[str, ...] = ("collection",),
                       ts: str = "ts", bits: int = SKETCH_BITS) -> DataFrame:
    """A9 in mergeable form: per (keys, day) captures, bytes and a HyperLogLog sketch of the digests.

    Kept as a table partitioned by day: a new day adds its rows, old days are never read again. A sketch
    has a fixed size, whatever the day holds.
    """
    return captures.groupBy(*keys, F.to_date(ts).alias("day")).agg(
        _n().alias("captures"), F.sum("length").cast("long").alias("bytes"),
        F.hll_sketch_agg(digest, F.lit(bits)).alias("sketch"))


def duplicate_estimate(sketches: DataFrame, keys: tuple[str, ...] = ("collection",)) -> DataFrame:
    """A9 over any days of ``duplicate_sketches``: distinct digests and duplicates from the united sketches.

    Captures and bytes are exact. ``distinct_digests`` has a standard error of 1.04 / sqrt(2^bits); the
    duplicates are the rest, their bytes the same share of all bytes.
    """
    g = sketches.groupBy(*keys).agg(
        F.sum("captures").cast("long").alias("captures"), F.sum("bytes").cast("long").alias("bytes"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch", F.lit(True))).alias("_d"))
    distinct = F.least(F.col("_d"), F.col("captures"))
    return g.select(*keys, "captures", distinct.alias("distinct_digests"),
                    (F.col("captures") - distinct).alias("duplicate_captures"), "bytes",
                    F.round(F.col("bytes") * (F.col("captures") - distinct) / F.col("captures")).cast("long").alias("duplicate_bytes"))


def status_report(captures: DataFrame, status: str = "status") -> DataFrame:
    """A10: captures per status code and the share of each."""
    from pyspark.sql import Window
    g = captures.groupBy(status).agg(_n().alias("captures"))
    total = F.sum("captures").over(Window.partitionBy())
    return g.withColumn("share", F.round(F.col("captures") / total, 6))


def log_summary(log: DataFrame) -> DataFrame:
    """Rows per level x context x message, with level and level x context subtotals."""
    return log.rollup("logLevel", "context", "message").agg(_n().alias("rows"))


def crawl_summary(log: DataFrame, crawl: str = "collection") -> DataFrame:
    """Start, end, duration and the last crawl status counts of each crawl."""
    status = F.col("context") == "crawlStatus"
    last_status = F.max_by(F.when(status, F.col("details")), F.when(status, F.col("timestamp")))
    g = log.groupBy(crawl).agg(
        F.min("timestamp").alias("started"), F.max("timestamp").alias("ended"),
        last_status.alias("_last"),
        F.count_if(F.col("logLevel") == "error").cast("long").alias("errors"),
        F.count_if(F.lower(F.col("message")).contains("timeout")
                   | F.lower(F.col("message")).contains("timed out")).cast("long").alias("timeouts"))
    for field in ("crawled", "total", "pending", "failed"):
        g = g.withColumn(field, F.get_json_object("_last", f"$.{field}").cast("long"))
    return g.withColumn("seconds", F.col("ended").cast("double") - F.col("started").cast("double")) \
        .drop("_last")


def frontier_summary(frontier: DataFrame) -> DataFrame:
    """URLs per list x depth, and added per minute."""
    by_list = frontier.groupBy("list", "depth").agg(_n().alias("urls"))
    per_minute = frontier.filter(F.col("added").isNotNull()) \
        .groupBy(F.date_trunc("minute", "added").alias("minute")).agg(_n().alias("added"))
    return by_list, per_minute


def links_per_page(links: DataFrame, page: str = "page_id", url: str = "url") -> DataFrame:
    """Distinct links found on each page."""
    return links.groupBy(page).agg(F.count_distinct(url).cast("long").alias("n_links"))


def feed_rows(outlets: DataFrame, feeds: DataFrame, website: str = "website") -> DataFrame:
    """A15 as rows (website, feed, pos): an outlet's own feeds with their place, then found ones (pos NULL), each once."""
    own = outlets.select(website, F.posexplode("rss").alias("pos", "feed"))
    found = feeds.select(website, F.lit(None).cast("int").alias("pos"), "feed").join(
        outlets.select(website).distinct(), website, "left_semi")
    return own.unionByName(found).groupBy(website, "feed").agg(F.min("pos").alias("pos"))


def feed_rollup(outlets: DataFrame, feeds: DataFrame, website: str = "website") -> DataFrame:
    """Found feeds added to the outlet's ``rss`` array, no duplicates, order kept.

    The registry's own form; an outlet with very many sitemap feeds is better kept as ``feed_rows``.
    """
    f = feeds.groupBy(website).agg(F.array_sort(F.collect_set("feed")).alias("_found"))
    joined = outlets.join(f, website, "left")
    rss = F.coalesce(F.col("rss"), F.array().cast("array<string>"))
    found = F.coalesce(F.col("_found"), F.array().cast("array<string>"))
    return joined.withColumn("rss", F.array_distinct(F.concat(rss, found))).drop("_found")
