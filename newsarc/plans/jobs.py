"""End-to-end jobs (E1-E7): compositions of the operators.

Inputs are tables (fetch results, archive results, crawl files); nothing here
makes a network call. Every step is a DataFrame transformation; the jobs
return DataFrames and write only when given a path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsarc.functions import urls as U
from newsarc.functions.content import content_size, html_text, publication_time
from newsarc.functions.records import site_record
from newsarc.operators import aggregates as A
from newsarc.operators import filters as FL
from newsarc.operators import generators as G
from newsarc.operators import joins as J
from newsarc.operators import sets as S
from newsarc.operators import windows as W
from newsarc.sources import readers as R
from newsarc.sources import sinks as K


# A fetch among those of its URL: the latest wins, of equal times the largest values.
VERSION = ("fetched_at", "status", "final_url", "_h")


def _versioned(fetches: DataFrame) -> DataFrame:
    """Fetches with ``_v``, which orders those of a URL and names one (the body by a hash made in the scan)."""
    f = fetches if "fetched_at" in fetches.columns else fetches.withColumn("fetched_at", F.lit(None).cast("timestamp"))
    return f.withColumn("_h", F.xxhash64("body")).withColumn("_v", F.struct(*VERSION)).drop("_h")


def _newest(versioned: DataFrame, url: str = "url") -> DataFrame:
    """(url, _v): the latest version of each URL, from narrow columns."""
    return versioned.groupBy(url).agg(F.max("_v").alias("_v"))


def latest_bodies(fetches: DataFrame, wanted: DataFrame, url: str = "url") -> DataFrame:
    """Rows of ``wanted`` with the latest fetch of their ``url``: status, final_url and body.

    Which fetch is the latest is settled on narrow columns; a body meets only the wanted rows (the
    planner broadcasts them where their measured size allows).
    """
    f = _versioned(fetches)
    last = _newest(f).select(F.col("url").alias("_u"), "_v")
    named = wanted.join(last, wanted[url] == last["_u"]).drop("_u")
    rows = f.select(F.col("url").alias("_u"), F.col("_v").alias("_own"), "status", "final_url", "body")
    # rows that a fetch table holds twice count once
    return (rows.join(named, (rows["_u"] == named[url]) & (rows["_own"] == named["_v"]))
            .drop("_u", "_own", "_v").dropDuplicates([c for c in wanted.columns if wanted.schema[c].dataType.typeName() != "map"]))


# ----------------------------------------------------------------- E1

def enrich_registry(outlets: DataFrame, fetches: DataFrame, rows: bool = False) -> DataFrame:
    """Status, then feeds for outlets without one (J1 -> F10 -> G2/G3/G4 -> F9 -> J5 -> A15).

    Fallback chain per outlet: own ``rss``; else the feed declared in the home
    page head; else feed-like ``<loc>`` of sitemap.xml, else of
    sitemap_index.xml (first that answered 200), else of every sitemap named in
    robots.txt. ``rows`` gives the feeds as rows (website, feed, pos) in place of outlets with arrays.
    """
    with_status = J.attach_status(outlets, fetches)
    need = with_status.filter(FL.needs_feed_flag()).select("website").distinct()

    home = latest_bodies(fetches, need, "website")
    html_feeds = G.discover_feeds(home.withColumn("final_url", F.coalesce("final_url", "website")),
                                  keep=("website",))

    # statuses decide which sitemap answered; bodies are read for those alone
    status = J.latest_fetch(fetches, cols=("status",)).withColumnRenamed("url", "sitemap")
    tried = need.select("website", F.posexplode(U.sitemap_urls("website")).alias("prio", "sitemap"))
    answered = tried.join(status.filter(F.col("status") == 200), "sitemap")
    direct = W.first_by_priority(answered, ["website"], "sitemap", "prio", "prio")
    robots = latest_bodies(fetches, need.select("website", U.robots_url("website").alias("url"))) \
        .filter(F.col("status").between(200, 299))
    from_robots = G.robots_sitemaps(robots, keep=("website",)).select("website", "sitemap")
    from_robots = from_robots.join(direct.select("website"), "website", "left_anti")
    sitemaps = direct.select("website", "sitemap").unionByName(from_robots).distinct()

    bodies = latest_bodies(fetches, sitemaps, "sitemap").filter(F.col("status").between(200, 299))
    locs = G.sitemap_locs(bodies, keep=("website",))
    smap_feeds = FL.feed_like(locs, "loc").select("website", F.col("loc").alias("feed"))
    smap_feeds = smap_feeds.join(html_feeds.select("website"), "website", "left_anti")
    found = html_feeds.select("website", "feed").unionByName(smap_feeds)
    return A.feed_rows(with_status, found) if rows else A.feed_rollup(with_status, found)


# ----------------------------------------------------------------- E2-E4

def offers(outlets: DataFrame, fetches: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """What each fetched home page and feed of an alive outlet offers: narrow rows, made in the scan.

    ``src`` and ``_v`` name the fetch an offer comes from; ``keep`` columns of the fetch stay. Of a
    page's fetches only the latest will count (``candidates``), whichever batch it came with.
    """
    alive = FL.alive(outlets).select("state", "website", F.md5("website").alias("website_hash"), "rss")
    f = _versioned(fetches)
    f = f.select(F.col("url").alias("src"), "_v", "final_url", "body", *keep)
    feeds = alive.select("state", "website", "website_hash",
                         F.posexplode(F.coalesce("rss", F.array().cast("array<string>"))).alias("feed_pos", "feed"))
    key = ("src", "_v", "state", "website", "website_hash", *keep)
    entries = G.feed_entries(f.join(feeds, f["src"] == feeds["feed"]), keep=(*key, "feed_pos"))
    from_feeds = entries.select(*key, F.col("link").alias("url"), F.col("feed_pos").cast("long").alias("feed_pos"),
                                "entry_pos", "published", F.lit(0).alias("origin"))
    sites = alive.drop("rss")
    home = f.join(sites, f["src"] == sites["website"]).withColumn("final_url", F.coalesce("final_url", "website"))
    links = G.extract_links(home, keep=key)
    from_home = links.select(*key, "url", F.lit(0).cast("long").alias("feed_pos"), F.col("pos").alias("entry_pos"),
                             F.lit(None).cast("string").alias("published"), F.lit(1).alias("origin"))
    return from_feeds.unionByName(from_home)


def facts(fetches: DataFrame, unit: str = "words", keep: tuple[str, ...] = ()) -> DataFrame:
    """What the rounds need to know of each fetch but its body: redirect target and text size."""
    f = fetches if "fetched_at" in fetches.columns else fetches.withColumn("fetched_at", F.lit(None).cast("timestamp"))
    return f.select("url", "final_url", "status", "fetched_at", *keep,
                    F.inline(F.array(F.struct(content_size(html_text("body"), unit).alias("content_size"),
                                              F.xxhash64("body").alias("_h")))))


def candidates(outlets: DataFrame, fetches: DataFrame) -> DataFrame:
    """U2 of feed entries (G5 over each outlet's fetched feeds) and home-page links (G1).

    Every alive site offers both; the cap (W1) orders feed entries before home-page
    links, so a site falls back to its home page for as many links as its feeds,
    after all tests, did not give.
    """
    return _candidates(offers(outlets, fetches), facts(fetches))


def _candidates(found: DataFrame, known: DataFrame) -> DataFrame:
    """Offers of each page's latest fetch; a URL once per feed position, or once for the home page (first place)."""
    last = _newest(known.withColumn("_v", F.struct(*VERSION))).select(F.col("url").alias("src"), "_v")
    c = found.join(last, ["src", "_v"], "left_semi")
    cols = ["state", "website", "website_hash", "url", "feed_pos", "entry_pos", "published"]
    feed = c.filter("origin = 0").select(*cols).distinct()
    home = S.distinct_links(c.filter("origin = 1").select(*cols), ("website_hash", "url"), ("entry_pos", "state", "website"))
    return S.union_candidates(feed, home.select(*cols))


def _by_final_url(fetches: DataFrame) -> DataFrame:
    """Fetches under the address their body was found at (a redirected one under its target)."""
    return fetches.withColumn("url", F.coalesce("final_url", "url"))


def collect_articles(outlets: DataFrame, fetches: DataFrame, archive_results: DataFrame,
                     run_ts, seen: DataFrame | None = None, n: int = 5, rule: str = "base",
                     unit: str = "words", count: str = "archived") -> tuple[DataFrame, DataFrame]:
    """Candidates -> J4 -> F3 -> J2 -> J7 -> W1 -> J6; returns (articles, new seen rows).

    ``count='archived'`` caps after the archive join (a failed link does not
    use a slot, as in the collectors); ``'selected'`` caps before it. Bodies are
    read in the scan; what crosses shuffles is narrow.
    """
    return decide(offers(outlets, fetches), facts(fetches, unit), archive_results, run_ts, seen, n, rule, unit, count)


def decide(found: DataFrame, known: DataFrame, archive_results: DataFrame, run_ts, seen: DataFrame | None = None,
           n: int = 5, rule: str = "base", unit: str = "words", count: str = "archived") -> tuple[DataFrame, DataFrame]:
    """E2 from offers and facts, whenever and with whatever batch each of them came."""
    run = F.lit(run_ts).cast("timestamp")
    c = select_articles(_candidates(found, known), known, archive_results, run, seen, n, rule, unit, count)
    articles = c.select(
        "state", "website", "website_hash", F.col("url").alias("link"), "expanded_url",
        publication_time("published", run).alias("publication_date"), "archived_time", "archive_ref",
        F.lit("web_archive").alias("archive_kind"))
    articles = K.with_day_parts(articles.withColumn("_run", run), "_run").drop("_run")
    new_seen = articles.select("website_hash", F.to_date(run).alias("day"), F.col("link").alias("url"))
    return articles, new_seen


def select_articles(c: DataFrame, known: DataFrame, archive_results: DataFrame, run, seen: DataFrame | None = None,
                    n: int = 5, rule: str = "base", unit: str = "words", count: str = "archived") -> DataFrame:
    """J4 -> F3 -> J2 -> J7 -> W1 -> J6 over candidates: the round's links with rank and archive reference."""
    c = J.expand_urls(c.withColumn("seen_at", run), known, "url", out="expanded_url")
    site = "website" if rule == "not_home" else None
    c = c.filter(FL.article_flag("expanded_url", rule, site))
    if seen is not None:
        # the seen set is kept per site and day: only the run's day counts
        # (and, ``day`` being a partition column, only that day is read)
        if "day" in seen.columns:
            seen = seen.filter(F.col("day") == F.to_date(run))
        c = J.drop_seen(c, seen.select("website_hash", "url"))
    sizes = _by_final_url(known).select(F.col("url").alias("expanded_url"), "fetched_at", "content_size")
    c = J.content_check(c, sizes, "expanded_url", unit, ts="fetched_at").filter("has_content")
    if count == "selected":
        return J.record_captures(W.cap_per_site(c, n), archive_results, "url")
    return W.cap_per_site(J.record_captures(c, archive_results, "url"), n)


def collect_html(outlets, fetches, archive_results, run_ts, seen=None, n: int = 5):
    """E2 with the last-segment rule; the article bodies are returned for S4."""
    articles, new_seen = collect_articles(outlets, fetches, archive_results, run_ts, seen, n,
                                          rule="last_segment")
    wanted = articles.select("state", "year", "month", "day", "website_hash", F.col("link").alias("url"), "expanded_url")
    bodies = latest_bodies(_by_final_url(fetches), wanted, "expanded_url").select(
        "state", "year", "month", "day", "website_hash", "url", "body")
    return articles, new_seen, bodies


def site_records(outlets: DataFrame, archive_results: DataFrame, run_ts) -> DataFrame:
    """A record per alive site that the archive took: its reference, the archive
    time and the outlet's columns as ``publication_metadata``."""
    recs = FL.alive(outlets)
    recs = recs.select("state", "website", F.md5("website").alias("website_hash"),
                       site_record(recs.columns).alias("publication_metadata"))
    taken = J.record_captures(recs, archive_results, "website").withColumnRenamed("archive_ref", "archived_path")
    return K.with_day_parts(taken.withColumn("_run", F.lit(run_ts).cast("timestamp")), "_run").drop("_run")


def collect_v2(outlets, fetches, archive_results, run_ts, site_root: str | None = None, n: int = 5):
    """Site records first (S5, only sites the archive took), the depth-3 rule, no seen set."""
    if site_root:
        K.write_site_records(site_records(outlets, archive_results, run_ts), site_root)
    return collect_articles(outlets, fetches, archive_results, run_ts, None, n, rule="depth3")[0]


def archive_home_pages(outlets: DataFrame, archive_results: DataFrame) -> DataFrame:
    """E5: newspapers answering 200 -> their archive reference (F2 -> J6)."""
    ok = FL.exact_ok(outlets).withColumnRenamed("website", "url")
    return J.record_captures(ok, archive_results, "url").withColumnRenamed("archive_ref", "archived_link") \
        .withColumnRenamed("url", "website")


# ----------------------------------------------------------------- E6

def crawl_report(spark: SparkSession, collections_root: str) -> dict[str, DataFrame]:
    """The crawl reports from the crawler's files under ``<root>/<collection>/...``."""
    caps = R.read_cdx(spark, f"{collections_root}/*/warc-cdx")
    pages = R.read_crawl_pages(spark, f"{collections_root}/*/pages")
    log = R.read_crawl_log(spark, f"{collections_root}/*/logs")
    frontier = R.read_frontier(spark, f"{collections_root}/*/crawls")
    by_list, per_minute = A.frontier_summary(frontier)
    return {
        "seeds": A.seed_report(caps),
        "hosts": A.host_report(caps),
        "file_types": A.file_type_report(caps),
        "seed_metrics": A.seed_metrics(caps, pages),
        "daily_usage": A.daily_usage(caps),
        "duplicates": A.duplicate_share(caps, keys=("collection",), order=("ts", "offset")),
        "status": A.status_report(caps),
        "log": A.log_summary(log),
        "crawls": A.crawl_summary(log),
        "frontier": by_list,
        "frontier_per_minute": per_minute,
        "progress": W.crawl_progress(caps, "collection", "ts", "length", "offset"),
        "page_durations": W.page_durations(log),
        "changes": W.capture_changes(caps, "urlkey", "ts", "digest", "offset"),
    }


# ----------------------------------------------------------------- E7

def article_filter(links: DataFrame, fetches: DataFrame, outlets: DataFrame,
                   unit: str = "words") -> DataFrame:
    """E7, the six filtering steps of the report: dereference (J4) -> known domain (J3) ->
    normalise and dedup (P7 + U5) -> depth and boundary (F3) -> word count (F7).
    """
    x = J.expand_urls(links, fetches, "url", out="expanded_url")
    x = J.known_domain(x, outlets, "expanded_url")
    x = S.dedup_normalized(x, "expanded_url")
    x = x.filter(FL.article_flag("norm_url", "base"))
    sizes = _by_final_url(fetches).select(F.regexp_replace(F.lower("url"), "/+$", "").alias("norm_url"), "fetched_at",
                                          content_size(html_text("body"), unit).alias("content_size"))
    return J.content_check(x, sizes, "norm_url", unit, ts="fetched_at").filter("has_content").drop("has_content")
