"""The registered queries: one per operator of the inventory that the driver's
tables can carry. Each takes ``(spark, sf_dir)`` and returns a DataFrame whose
column names equal those of its oracle SQL in ``newsarc.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsarc.functions import urls as U
from newsarc.functions.content import BLANKS, content_size, publication_time
from newsarc.functions.records import archive_outcome, log_field, site_record, status_class
from newsarc.operators import aggregates as A
from newsarc.operators import filters as FL
from newsarc.operators import generators as G
from newsarc.operators import joins as J
from newsarc.operators import sets as S
from newsarc.operators import windows as W
from newsarc.plans import derive as D
from newsarc.plans import jobs
from newsarc.sources import readers as R
from newsarc.session import cut

Query = Callable[[SparkSession, str], DataFrame]

SESSION_GAP_SECONDS = 3600
TOP_HOSTS = 5


# ----------------------------------------------------------------- links

def q_links(spark, sf):
    """G1 + P3: every link of every page, resolved."""
    return D.links(spark, sf).select("page_id", "pos", "href", "url")


def _distinct_links(spark, sf):
    return S.distinct_links(D.links(spark, sf).select("website_hash", "url", "page_id", "pos"))


def q_links_distinct(spark, sf):
    """One row per (site, url) with the first page and position."""
    return _distinct_links(spark, sf)


def q_links_per_page(spark, sf):
    """A14."""
    return A.links_per_page(D.links(spark, sf))


def _candidates(spark, sf):
    """Page URLs (feed origin 0) then the distinct links (home origin 1)."""
    feed = D.page_candidates(spark, sf).select("website_hash", "url", "feed_pos", "entry_pos")
    home = _distinct_links(spark, sf).select("website_hash", "url", F.col("page_id").alias("feed_pos"),
                                             F.col("pos").alias("entry_pos"))
    return S.union_candidates(feed, home)


def q_union_candidates(spark, sf):
    return _candidates(spark, sf)


def _articles(rule):
    def q(spark, sf):
        out = FL.article_url(_candidates(spark, sf), rule, "url")
        return out.select("website_hash", "url", "origin", "feed_pos", "entry_pos")
    q.__doc__ = f"F3, F4: article test, rule {rule!r}, over the candidates."
    return q


def q_articles_depth3(spark, sf):
    """F5 over page URLs (depth 2 at most) and the archiver's outputs (archive URLs are deep, errors no URL)."""
    pages = D.table(spark, sf, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), "url")
    refs = D.archive_results(spark, sf).select(F.lit("archive").alias("kind"), F.col("event_id").alias("id"),
                                               F.col("output").alias("url"))
    return FL.article_url(pages.unionByName(refs), "depth3", "url")


def q_articles_not_home(spark, sf):
    """candidates against the site's first page as its home page (so the home page is a candidate too)."""
    homes = D.table(spark, sf, "pages").groupBy(F.md5(U.site_root("url")).alias("website_hash")).agg(
        F.min_by("url", "page_id").alias("home"))
    c = _candidates(spark, sf).join(homes, "website_hash")
    out = FL.article_url(c, "not_home", "url", "home")
    return out.select("website_hash", "url", "origin", "feed_pos", "entry_pos")


def q_same_site(spark, sf):
    """F8: page links against their page's site, and captures against the site of user 1."""
    links = D.links(spark, sf).select(F.lit("link").alias("kind"), F.col("page_id").alias("id"), "url", "website")
    caps = D.event_captures(spark, sf).select(F.lit("capture").alias("kind"), F.col("event_id").alias("id"), "url",
                                              F.lit("https://u1").alias("website"))
    return FL.same_site(links.unionByName(caps), "url", "website").select("kind", "id", "url")


def q_crawlable(spark, sf):
    """F13 over the links as written (relative ones are no URLs) and their resolved form."""
    links = D.links(spark, sf)
    raw = links.select("page_id", "pos", F.explode(F.array("href", "url")).alias("link"))
    return FL.crawlable(raw, "link")


# ------------------------------------------------------------ URL parts

def q_url_parts(spark, sf):
    """P1, P4 and the parts of every page URL."""
    p = D.table(spark, sf, "pages")
    return p.select("page_id", U.url_scheme("url").alias("scheme"), U.url_netloc("url").alias("netloc"),
                    U.url_path("url").alias("path"), U.url_query("url").alias("query"),
                    U.url_fragment("url").alias("fragment"), U.path_depth("url").alias("depth"),
                    U.is_valid_url("url").alias("valid"))


def q_domain(spark, sf):
    """P2 over links and pages."""
    return D.links(spark, sf).select("page_id", "pos", U.domain("url").alias("domain"))


def q_normalized_dedup(spark, sf):
    """U5 (P7) per site."""
    return S.dedup_normalized(D.links(spark, sf), "url", keys=("website_hash",))


def q_url_hash(spark, sf):
    """P8."""
    p = D.table(spark, sf, "pages")
    return p.select("page_id", U.site_root("url").alias("website"),
                    U.url_hash(U.site_root("url")).alias("website_hash"),
                    U.url_hash("url").alias("url_hash"))


def q_archive_path(spark, sf):
    """The tree path of each page's site record for the run day."""
    p = D.table(spark, sf, "pages")
    state = F.upper(D.page_lang("url"))
    return p.select("page_id", U.archive_path(state, F.to_timestamp(F.lit(D.RUN_DAY)),
                                              U.site_root("url")).alias("archive_path"))


def surt(url) -> F.Column:
    """SURT-style sort key: reversed host labels without www, ``)``, lower-cased path+query."""
    host = F.regexp_replace(F.lower(U.url_netloc(url)), r"^www\.", "")
    rev = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    q = U.url_query(url)
    tail = F.concat(U.url_path(url, strip_params=False),
                    F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit("")))
    return F.concat(rev, F.lit(")"), F.lower(tail))


def q_url_order(spark, sf):
    """Pages in index order (urlkey, page)."""
    p = D.table(spark, sf, "pages").select("page_id", surt(F.col("url")).alias("urlkey"))
    return p.orderBy("urlkey", "page_id")


# --------------------------------------------------------------- content

def q_html_words(spark, sf):
    """P12 + P13."""
    return D.page_sizes(spark, sf).select("page_id", "n_words", "n_chars")


def _document_text(spark, sf):
    text = F.trim(F.regexp_replace("text", BLANKS, " "))
    return D.table(spark, sf, "documents").select("doc_id", F.inline(F.array(F.struct(
        content_size(text, "words").alias("n_words"), content_size(text, "chars").alias("n_chars")))))


def q_content_words20(spark, sf):
    """F7, the stated rule: at least 20 words."""
    return FL.enough_content(_document_text(spark, sf), "n_words", "words").select("doc_id", "n_words")


def q_content_chars20(spark, sf):
    """F7, code rule: more than 20 characters."""
    return FL.enough_content(_document_text(spark, sf), "n_chars", "chars").select("doc_id", "n_chars")


def q_content_check(spark, sf):
    """Candidates joined to the size of their page text; no body -> rejected."""
    sizes = D.page_sizes(spark, sf).select("url", "page_id", F.col("n_words").alias("content_size"))
    out = J.content_check(_candidates(spark, sf), sizes, "url", "words", ts="page_id")
    return out.select("website_hash", "url", "origin", "has_content")


# ------------------------------------------------------------- selection

def _base_articles(spark, sf):
    return FL.article_url(_candidates(spark, sf), "base", "url")


def q_cap5(spark, sf):
    """5 articles per site, feed first, in order."""
    out = W.cap_per_site(_base_articles(spark, sf), 5)
    return out.select("website_hash", "url", "origin", "rank")


def q_cap11(spark, sf):
    """The first collector's cap (11, home page only below 10 from the feed)."""
    out = W.cap_first_version(_base_articles(spark, sf), 11, 10)
    return out.select("website_hash", "url", "origin", "rank")


def q_drop_seen(spark, sf):
    """Links not already seen on an earlier page of the same site."""
    links = cut(D.links(spark, sf).select("page_id", "pos", "website_hash", "url"))   # the pages are parsed once
    seen = links.select("website_hash", "url", "page_id")
    return J.drop_seen(links, seen, before=("page_id", "page_id"))


def q_known_domain(spark, sf):
    """Page links and captured sites whose domain belongs to a registered outlet."""
    links = D.links(spark, sf).select(F.lit("link").alias("kind"), F.col("page_id").alias("id"), "url")
    caps = D.event_captures(spark, sf).select(F.lit("capture").alias("kind"), F.col("event_id").alias("id"), "url")
    return J.known_domain(links.unionByName(caps), D.outlets(spark, sf)).select("kind", "id", "url")


def q_new_urls(spark, sf):
    """Links of each site's latest page not found on its earlier pages."""
    return S.new_in_latest(D.links(spark, sf).select("page_id", "website_hash", "url"))


def q_kept_urls(spark, sf):
    """U4: links of the latest page that earlier pages had too."""
    return S.kept_in_latest(D.links(spark, sf).select("page_id", "website_hash", "url"))


def q_expand_urls(spark, sf):
    """Candidates to their final URL from the fetch table."""
    f = D.fetches(spark, sf).withColumn("fetched_at", F.col("page_id"))
    out = J.expand_urls(_candidates(spark, sf), f, "url")
    return out.select("website_hash", "url", "origin", "expanded_url")


def q_expand_chain(spark, sf):
    """J4 over chains of single hops: twenty pages each redirect to the next one; the last is the end,
    hops back into the chain, or leaves to a page that was never fetched."""
    p = D.table(spark, sf, "pages").select("page_id", "url")
    i, back = F.col("page_id"), F.pmod(F.floor(F.col("page_id") / 20), F.lit(3))
    ahead = F.when(F.pmod(i, F.lit(20)) < 19, i + 1).when(back == 1, i - 5)
    urls = p.groupBy("page_id").agg(F.min("url").alias("_next"))
    hops = p.withColumn("_to", ahead).join(urls.withColumnRenamed("page_id", "_to"), "_to", "left").select(
        "page_id", "url", F.when((F.pmod(i, F.lit(20)) == 19) & (back == 2), F.concat(F.lit("https://gone.example.org/"), i))
        .otherwise(F.col("_next")).alias("final_url"), i.alias("fetched_at"))
    return J.expand_chains(p, hops, "url").select("page_id", "url", "expanded_url", "n_hops")


def q_in_scope(spark, sf):
    """candidates against their page's seed: its section (``https://h/en/``), for odd pages the bare host."""
    section = F.concat(U.site_root("url"), D.page_lang("url"), F.lit("/"))
    host = F.concat(U.url_scheme("url"), F.lit("://"), U.url_netloc("url"))
    c = _candidates(spark, sf).join(
        D.table(spark, sf, "pages").select(
            F.md5(U.site_root("url")).alias("website_hash"), F.col("page_id").alias("feed_pos"),
            F.when(F.col("page_id") % 2 == 1, host).otherwise(section).alias("seed_url")),
        ["website_hash", "feed_pos"])
    return c.select("website_hash", "url", "origin", "feed_pos", "entry_pos",
                    FL.in_scope_flag("url", "seed_url").alias("in_scope"))


def q_seed_of(spark, sf):
    """F11 over a table of seeds: each link with the longest scope among all sections and odd pages' hosts."""
    p = D.table(spark, sf, "pages")
    host = F.concat(U.url_scheme("url"), F.lit("://"), U.url_netloc("url"))
    section = F.concat(U.site_root("url"), D.page_lang("url"), F.lit("/"))
    seeds = p.select(F.when(F.col("page_id") % 2 == 1, host).otherwise(section).alias("seed_url")).distinct()
    links = D.links(spark, sf).select("page_id", "pos", "url")
    return FL.seed_of(cut(links), seeds)


def q_collect(spark, sf):
    """E2's decision (``jobs.select_articles``) over the pages: every third page seen before, every fifth
    refused by the archive."""
    pages = D.table(spark, sf, "pages")
    seen = pages.filter(F.col("page_id") % 3 == 0).select(F.md5(U.site_root("url")).alias("website_hash"), "url")
    known = D.page_sizes(spark, sf).select("url", F.lit(None).cast("string").alias("final_url"),
                                           F.col("page_id").alias("fetched_at"), F.col("n_words").alias("content_size"))
    calls = pages.select("url", F.timestamp_seconds("page_id").alias("called_at"), F.when(
        F.col("page_id") % 5 == 0, F.lit("520 Server Error: x")).otherwise(
        F.concat(F.lit("https://web.archive.org/web/1/"), F.col("url"))).alias("output"))
    c = jobs.select_articles(_candidates(spark, sf), known, calls, F.to_timestamp(F.lit(D.RUN_DAY)), seen, 5)
    return c.select("website_hash", "url", "origin", "rank", "archive_ref")


# --------------------------------------------------------------- reports

def q_seed_report(spark, sf):
    return A.seed_report(D.page_captures(spark, sf))


def q_host_report(spark, sf):
    return A.host_report(D.page_captures(spark, sf))


def q_type_report(spark, sf):
    return A.file_type_report(D.page_captures(spark, sf))


def q_top_hosts(spark, sf):
    """The 5 hosts with most bytes."""
    return W.top_n(A.host_report(D.page_captures(spark, sf)), "bytes", TOP_HOSTS, "host")


def q_dedup_content(spark, sf):
    """One document per text digest, the first by doc_id."""
    out = S.dedup_content(D.document_captures(spark, sf), "digest", ("doc_id",))
    return out.select("digest", "doc_id", "source")


def q_duplicate_share(spark, sf):
    """Captures and bytes that repeat an earlier digest, per source."""
    return A.duplicate_share(D.document_captures(spark, sf), "digest", keys=("source",),
                             order=("doc_id",))


def q_duplicate_sketch(spark, sf):
    """A9 from sketches per source and day, united: exact captures and bytes, and whether the estimated
    distinct digests lie within three standard errors (2.4 %, at least 1) of the exact number."""
    c = D.document_captures(spark, sf).withColumn("ts", F.timestamp_seconds(F.col("doc_id") * 3600))
    est = A.duplicate_estimate(A.duplicate_sketches(c, keys=("source",)), ("source",))
    exact = c.groupBy("source").agg(F.count_distinct("digest").alias("_exact"))
    close = F.abs(F.col("distinct_digests") - F.col("_exact")) <= F.greatest(F.lit(1.0), F.col("_exact") * 0.024)
    return est.join(exact, "source").select("source", "captures", "bytes", close.alias("within"))


def q_daily_quota(spark, sf):
    """Documents queued for the archive, 200 a day, round robin over sources."""
    d = D.document_captures(spark, sf).withColumn("day", F.lit(D.RUN_DAY).cast("date"))
    from newsarc.operators import ordered
    ranked = ordered.ranked_by_range(d, ["doc_id"], ["website_hash"], out="rank")
    out = W.daily_quota(ranked, 200, "day", "rank", "website_hash", ("url",))
    return out.select("doc_id", "website_hash", "rank", "quota_rank", "day_offset")


def q_daily_usage(spark, sf):
    """Bytes and documents per day and collection."""
    return A.daily_usage(D.event_captures(spark, sf))


def q_crawl_progress(spark, sf):
    """Cumulative documents and bytes of each collection over time."""
    out = W.crawl_progress(D.event_captures(spark, sf), "collection", "ts", "length", "event_id")
    return out.select("event_id", "collection", "cum_docs", "cum_bytes")


def q_capture_changes(spark, sf):
    """First / changed / unchanged against the previous capture of the site."""
    out = W.capture_changes(D.event_captures(spark, sf), "urlkey", "ts", "digest", "event_id")
    return out.select("event_id", "urlkey", "prev_digest", "change")


def q_capture_as_of(spark, sf):
    """Each replay request (a view) gets the site's latest other capture at or before it."""
    c = D.event_captures(spark, sf)
    req = c.filter(F.col("digest") == "view").select("event_id", "urlkey", "ts")
    caps = c.filter(F.col("digest") != "view").select("urlkey", "ts", "digest", "event_id")
    out = J.capture_as_of(req, caps, "urlkey", "ts", ("ts", "digest"))
    return out.select("event_id", "urlkey", F.col("capture.ts").alias("capture_ts"),
                      F.col("capture.digest").alias("capture_digest"))


def q_sliding_usage(spark, sf):
    """T5 batch twin: 7-day windows sliding by a day, per collection (days first, then the windows they lie in)."""
    c = D.event_captures(spark, sf)
    days = c.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), "collection").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("length").alias("bytes"))
    g = days.groupBy(F.window("day", "7 days", "1 day").alias("w"), "collection").agg(
        F.sum("documents").cast("long").alias("documents"), F.sum("bytes").cast("long").alias("bytes"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "collection", "documents", "bytes")


def q_sessions(spark, sf):
    """T6 batch twin: bursts of captures per site, a new one after an hour of quiet."""
    from newsarc.operators import ordered
    c = D.event_captures(spark, sf)
    out = ordered.sessions(c, "urlkey", "ts", SESSION_GAP_SECONDS, "event_id")
    return out.select("urlkey", "session_start", "session_end", "events")


def q_status_report(spark, sf):
    """A10."""
    return A.status_report(D.event_captures(spark, sf))


# ------------------------------------------------------- registry, archive

def q_registry_flat(spark, sf):
    """D2/S1 flat outlets."""
    return D.outlets(spark, sf)


def q_media_counts(spark, sf):
    """A1."""
    return A.media_counts(D.outlets(spark, sf))


def q_coverage(spark, sf):
    """A2: state x media cube with alive and with-feed counts."""
    o = D.outlets(spark, sf)
    o = o.withColumn("rss", F.when(F.col("has_feed"), F.array(F.col("website")))
                     .otherwise(F.array().cast("array<string>")))
    return A.coverage(o)


def q_needs_feed(spark, sf):
    """outlets without a feed."""
    o = D.outlets(spark, sf).withColumn(
        "rss", F.when(F.col("has_feed"), F.array(F.col("website"))))
    return FL.needs_feed(o).select("website_hash", "website", "state", "media")


def _site_fetches(spark, sf):
    c = D.event_captures(spark, sf)
    return c.select(F.col("url"), F.col("status"), F.col("ts").alias("fetched_at"))


def _event_outlets(spark, sf):
    c = D.event_captures(spark, sf)
    return c.select(F.col("url").alias("website")).distinct()


def q_attach_status(spark, sf):
    """Each site with the status of its latest fetch."""
    return J.attach_status(_event_outlets(spark, sf), _site_fetches(spark, sf))


def q_alive(spark, sf):
    """sites whose latest fetch answered 2xx."""
    return FL.alive(J.attach_status(_event_outlets(spark, sf), _site_fetches(spark, sf)))


def q_archive_outcome(spark, sf):
    """P14 on every archiver output."""
    r = D.archive_results(spark, sf).withColumn("o", archive_outcome("output"))
    return r.select("event_id", F.col("o.status").alias("status"),
                    F.col("o.retryable").alias("retryable"), F.col("o.archive_url").alias("archive_url"))


def q_outcome_counts(spark, sf):
    """Found / archived / failed / server errors per site."""
    return A.archive_outcomes(D.archive_results(spark, sf), ("website_hash",))


def q_record_captures(spark, sf):
    """Sites become records only when their latest archive call succeeded."""
    sel = _event_outlets(spark, sf).withColumnRenamed("website", "url")
    out = J.record_captures(sel, D.archive_results(spark, sf), "url")
    return out.select("url", "archive_ref", "archived_time")


def q_locate_block(spark, sf):
    """Each link's key in a block index with one block per host (its smallest key)."""
    pages = D.table(spark, sf, "pages")
    blocks = pages.groupBy(U.url_netloc("url").alias("filename")).agg(
        F.min(surt(F.col("url"))).alias("urlkey_from"), F.count(F.lit(1)).cast("long").alias("length")) \
        .withColumn("offset", F.lit(0).cast("long"))
    keys = D.links(spark, sf).select("page_id", "pos", surt(F.col("url")).alias("urlkey"))
    out = J.locate_block(keys, blocks)
    return out.select("page_id", "pos", "urlkey", F.col("block.filename").alias("block_file"),
                      F.col("block.urlkey_from").alias("block_from"))


RFC822 = "EEE, dd MMM yyyy HH:mm:ss"


def q_publication_time(spark, sf):
    """Feed dates written four ways (GMT, +0500, EST, ISO; none for errors), parsed back."""
    e = D.table(spark, sf, "events").select("event_id", "event_type", "ts")
    t, kind = F.col("ts"), F.col("event_type")
    text = (F.when(kind == "view", F.concat(F.date_format(t, RFC822), F.lit(" GMT")))
            .when(kind == "click", F.concat(F.date_format(t + F.expr("INTERVAL 5 HOURS"), RFC822), F.lit(" +0500")))
            .when(kind == "purchase", F.concat(F.date_format(t - F.expr("INTERVAL 5 HOURS"), RFC822), F.lit(" EST")))
            .when(kind == "signup", F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    fallback = F.to_timestamp(F.lit(D.RUN_DAY))
    return e.select("event_id", text.alias("published"),
                    publication_time(text, fallback).cast("timestamp_ntz").alias("publication_date"))


def q_log_summary(spark, sf):
    """Events read as a crawl log: rows per level x context x message with subtotals."""
    c = D.event_captures(spark, sf)
    log = c.select(F.when(F.col("status") >= 500, "error").otherwise("info").alias("logLevel"),
                   F.col("digest").alias("context"), F.coalesce("mime", F.lit("none")).alias("message"))
    return A.log_summary(log)


def q_seed_type(spark, sf):
    """which candidates each seed type would crawl (page URL = seed, depth 0; link = depth 1;
    out of the section's scope = one hop)."""
    c = q_in_scope(spark, sf).withColumn("depth", F.col("origin")) \
        .withColumn("hops", F.when(F.col("in_scope"), 0).otherwise(1))
    return c.select("website_hash", "url", "origin", "feed_pos", "entry_pos",
                    *[FL.seed_type_flag(k, "depth", "in_scope", "hops").alias(k) for k in FL.SEED_TYPES])


def q_registry_seeds(spark, sf):
    """Seed URLs of the outlets, trailing slash forced, distinct."""
    return G.registry_seeds(D.outlets(spark, sf))


def q_exact_ok(spark, sf):
    """captures as outlets (HTML: newspapers), answering 200 with a website."""
    c = D.event_captures(spark, sf).select(
        "event_id", F.col("url").alias("website"), F.col("status").alias("website_status"),
        F.when(F.col("mime") == "text/html", "newspaper").otherwise("tv").alias("media"))
    return FL.exact_ok(c).select("event_id", "website")


# -------------------------------------- bodies rendered row by row from pages

def _rendered(spark, sf, body):
    return D.table(spark, sf, "pages").select("page_id", F.col("url").alias("final_url"), body.alias("body"))


def q_discover_feeds(spark, sf):
    """Heads with a stylesheet, an Atom link and (even pages) a quoted RSS link."""
    i = F.col("page_id").cast("string")
    head = F.concat(F.lit('<head><link rel="stylesheet" data-type="application/rss+xml" href="/s.css">'
                          '<!--<link type="application/rss+xml" href="/old">-->'
                          '<link type="application/atom+xml" href="/atom/'), i, F.lit('">'),
                    F.when(F.col("page_id") % 2 == 0, F.concat(
                        F.lit("<link title=\"a > b\" href='/rss/"), i, F.lit("?a=1&amp;b=2' type='application/rss+xml'/>")))
                    .otherwise(""), F.lit("</head>"))
    return G.discover_feeds(_rendered(spark, sf, head), keep=("page_id",))


def q_robots_sitemaps(spark, sf):
    """Robots texts with two sitemap lines."""
    site = U.site_root("url")
    text = F.concat(F.lit("User-agent: *\nSitemap: "), site, F.lit("map-"), F.col("page_id").cast("string"),
                    F.lit(".xml \r\nDisallow: /x\nsitemap:"), site, F.lit("news.xml\n"))
    return G.robots_sitemaps(_rendered(spark, sf, text), keep=("page_id",))


def q_sitemap_locs(spark, sf):
    """Sitemaps with a reference-coded, a commented and a CDATA location."""
    coded = F.replace("url", F.lit("&"), F.lit("&amp;"))
    text = F.concat(F.lit("<urlset><url><loc> "), coded, F.lit("&amp;x=&#65; </loc></url><!--<loc>no</loc>--><loc><![CDATA["),
                    F.col("url"), F.lit("]]></loc></urlset>"))
    return G.sitemap_locs(_rendered(spark, sf, text), keep=("page_id",))


def q_feed_entries(spark, sf):
    """An RSS item in CDATA, one without a link and an Atom entry with self and alternate links."""
    i, coded = F.col("page_id").cast("string"), F.replace("url", F.lit("&"), F.lit("&amp;"))
    text = F.concat(F.lit("<rss><item><link><![CDATA[ "), F.col("url"), F.lit(" ]]></link><pubDate><![CDATA[day "), i,
                    F.lit(']]></pubDate></item><item><link></link></item><entry><link rel="self" href="/self"/>'
                          '<link href="'), coded, F.lit('" rel="alternate"/><updated>late</updated><published>p'), i,
                    F.lit("</published></entry></rss>"))
    return G.feed_entries(_rendered(spark, sf, text), keep=("page_id",))


# ------------------------------------------------- events as a crawl's files

def q_seed_metrics(spark, sf):
    """Metrics per site; every fifth event asks for robots.txt, purchases are seeds."""
    c = D.event_captures(spark, sf)
    url = F.when(F.col("event_id") % 5 == 0, F.concat("url", F.lit("robots.txt"))).otherwise(F.col("url"))
    caps = c.select("urlkey", url.alias("url"), "status", "length")
    return A.seed_metrics(caps, c.select("urlkey", (F.col("digest") == "purchase").alias("seed")), "urlkey")


def q_average_usage(spark, sf):
    """Average bytes per day of each collection."""
    return A.average_usage(D.event_captures(spark, sf))


def q_page_durations(spark, sf):
    """Views as starts, clicks and purchases as finishes of a page."""
    c = D.event_captures(spark, sf)
    log = c.select("collection", F.col("urlkey").alias("page"), F.col("ts").cast("timestamp").alias("timestamp"),
                   F.when(F.col("digest") == "view", "Awaiting page load").when(
                       F.col("digest").isin("click", "purchase"), "Page Finished").otherwise("other").alias("message"))
    return W.page_durations(log).select("collection", "page", "visit", F.col("started").cast("timestamp_ntz").alias("started"),
                                        F.col("finished").cast("timestamp_ntz").alias("finished"))


def q_log_field(spark, sf):
    """A field of the details text."""
    return D.table(spark, sf, "events").select("event_id", log_field("props", "k").alias("k"))


def q_site_record(spark, sf):
    """The outlet's columns as one nested record."""
    o = D.outlets(spark, sf)
    rec = o.select("website_hash", site_record(["state", "media", "name", "website"]).alias("publication_metadata"))
    return rec.select("website_hash", "publication_metadata.state", "publication_metadata.media",
                      "publication_metadata.name", "publication_metadata.website")


def q_page_captures(spark, sf):
    """Each page with its captures (the captures of its host's pages under the same URL)."""
    pages = D.page_captures(spark, sf).withColumn("status", F.lit(200))
    caps = pages.filter(F.col("page_id") % 2 == 0).select(
        "collection", "url", F.timestamp_seconds("page_id").cast("timestamp_ntz").alias("ts"), "status", "mime",
        F.md5("url").alias("digest"), "length")
    out = J.page_captures(pages.select("page_id", "collection", "url", "status", "mime"), caps)
    return out.select("page_id", "collection", "url", "capture_ts", "digest", "length")


def q_feed_like(spark, sf):
    """page URLs that look like feeds (``rss`` or ``feed`` in the text)."""
    return FL.feed_like(D.table(spark, sf, "pages").select("page_id", "url"), "url")


def q_status_class(spark, sf):
    """P15 on every capture's status."""
    c = D.event_captures(spark, sf)
    return c.select("event_id", "status", status_class("status").alias("status_class"))


def q_urlkey_host(spark, sf):
    """Host of every capture key."""
    c = D.event_captures(spark, sf)
    return c.select("event_id", "urlkey", U.urlkey_host("urlkey").alias("host"))


def q_robots_urls(spark, sf):
    """P10: robots.txt and the two sitemap locations of every outlet."""
    o = D.outlets(spark, sf)
    maps = U.sitemap_urls("website")
    return o.select("website_hash", U.robots_url("website").alias("robots_url"),
                    maps[0].alias("sitemap_url"), maps[1].alias("sitemap_index_url"))


def q_first_feed(spark, sf):
    """Per site, the first feed-like page URL by priority (``rss`` before ``feed``), then page."""
    p = D.table(spark, sf, "pages").select("page_id", "url")
    f = FL.feed_like(p, "url").select(
        F.md5(U.site_root("url")).alias("website_hash"), "url", "page_id",
        F.when(F.col("url").contains("rss"), 0).otherwise(1).alias("prio"))
    return W.first_by_priority(f, ["website_hash"], "url", "prio", "page_id", out="feed")


def q_page_resources(spark, sf):
    """Links as resources joined to the page named in their referrer (page type = language)."""
    pages = D.page_captures(spark, sf).select(
        F.lit("page").alias("kind"), "page_id", F.lit(None).cast("int").alias("pos"), "url",
        F.lit(None).cast("string").alias("referrer"), "mime", F.col("page_id").alias("ts"),
        F.lit(200).alias("status"))
    links = D.links(spark, sf).join(
        D.table(spark, sf, "pages").select("page_id", F.col("url").alias("referrer")), "page_id").select(
        F.lit("link").alias("kind"), "page_id", "pos", "url", "referrer",
        F.lit(None).cast("string").alias("mime"), F.col("page_id").alias("ts"), F.lit(200).alias("status"))
    out = J.page_resources(cut(pages.unionByName(links)))   # the pages are parsed once
    return out.select("kind", "page_id", "pos", "url", "page_mime")


# ------------------------------------------- events rendered as a crawl's lines

def _in_file(folder):
    return F.concat(F.lit("file:/data/collections/"), F.col("collection"), F.lit(f"/{folder}/0"))


def _text(name, value):
    """A JSON field whose value is a string without quotes in it."""
    return F.concat(F.lit(f'"{name}": "'), value, F.lit('"'))


def _utc(ts):
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def q_read_cdx(spark, sf):
    """Events as index lines; errors are cut off, a sign-up has no numeric status, views have a referrer."""
    c = D.event_captures(spark, sf)
    fields = [F.lit('"cookie": {"a": [1, "}"]}'), _text("url", F.concat("url", F.lit("?e="), F.col("event_id").cast("string"))),
              _text("mime", F.coalesce("mime", F.lit("unk"))),
              _text("status", F.when(F.col("digest") == "signup", "-").otherwise(F.col("status").cast("string"))),
              _text("digest", F.concat(F.lit("sha-256:"), "digest")), _text("length", F.col("length").cast("string")),
              _text("offset", F.col("event_id").cast("string")), F.lit('"filename": "rec-0.warc.gz"'),
              F.when(F.col("digest") == "view", _text("referrer", F.col("url")))]
    line = F.concat("urlkey", F.lit(" "), F.date_format("ts", "yyyyMMddHHmmss"), F.lit(" {"), F.concat_ws(", ", *fields),
                    F.when(F.col("digest") == "error", "").otherwise("}"))
    rows = R.cdx_rows(c.select(line.alias("value"), _in_file("warc-cdx").alias("file_path")))
    return rows.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def q_read_block_index(spark, sf):
    """Events as block lines; every tenth is a ``!meta`` line."""
    c = D.event_captures(spark, sf)
    n = F.col("event_id").cast("string")
    line = F.concat(F.when(F.col("event_id") % 10 == 0, F.lit("!meta")).otherwise(F.col("urlkey")), F.lit(" "),
                    F.date_format("ts", "yyyyMMddHHmmss"), F.lit(' {"offset": '), n, F.lit(', "length": '),
                    F.col("length").cast("string"), F.lit(', "digest": "'), F.col("digest"), F.lit('", "filename": "b-'), n, F.lit('.gz"}'))
    rows = R.block_rows(c.select(line.alias("value"), _in_file("indexes").alias("file_path")))
    return rows.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _log_lines(spark, sf):
    """Events as a crawl log: sign-ups report the crawl's status, errors time out, others load a page."""
    c = D.event_captures(spark, sf)
    n, kind = F.col("event_id").cast("string"), F.col("digest")
    details = (F.when(kind == "signup", F.concat(F.lit('{"crawled": '), n, F.lit(', "total": '), (F.col("event_id") + 7).cast("string"),
                                                 F.lit(', "pending": 1, "failed": '), (F.col("event_id") % 3).cast("string"), F.lit("}")))
               .when(kind == "click", F.lit('["a", {"b": 1}]')).otherwise(F.concat(F.lit("{"), _text("page", F.col("url")), F.lit("}"))))
    line = F.concat(F.lit("{"), _text("timestamp", _utc(F.col("ts"))), F.lit(", "),
                    _text("logLevel", F.when(kind == "error", "error").otherwise("info")), F.lit(", "),
                    _text("context", F.when(kind == "signup", "crawlStatus").otherwise("pageStatus")), F.lit(", "),
                    _text("message", F.when(kind == "error", "Page Load Timed Out").when(kind == "signup", "Crawl statistics")
                          .otherwise("Page Finished")), F.lit(', "details": '), details, F.lit("}"))
    return c.select(F.when(F.col("event_id") % 100 == 99, F.lit("  ")).otherwise(line).alias("value"),
                    _in_file("logs").alias("file_path"))


def q_read_crawl_log(spark, sf):
    """JSON log lines (every hundredth blank) to typed columns."""
    rows = R.crawl_log_rows(_log_lines(spark, sf))
    return rows.select("collection", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "logLevel", "context",
                       "message", "page")


def q_crawl_summary(spark, sf):
    """A12 over the log lines."""
    out = A.crawl_summary(R.crawl_log_rows(_log_lines(spark, sf)))
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("started", "ended")}).drop("seconds")


def q_read_scraper_log(spark, sf):
    """Text log lines; every seventh is the tail of a trace."""
    c = D.event_captures(spark, sf)
    line = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS"), F.lit(" - "),
                    F.when(F.col("status") == 500, "ERROR").otherwise("INFO"), F.lit(" - "), "url", F.lit(" - "), "digest")
    value = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("  File x - "), line)).otherwise(line)
    return R.scraper_log_rows(c.select(value.alias("value"))).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _frontier(spark, sf):
    """Events as crawl state: a file per collection, its lists one after the other; finished items are bare URLs."""
    c = D.event_captures(spark, sf)
    n, kind = F.col("event_id").cast("string"), F.col("digest")
    place = F.when(kind.isin("view", "click"), 0).when(kind == "purchase", 1).otherwise(2)
    item = F.concat(F.lit("    - '{"), _text("added", _utc(F.col("ts"))), F.lit(", "), _text("url", F.concat("url", n)),
                    F.lit(', "seedId": '), (F.col("event_id") % 4).cast("string"), F.lit(', "depth": '),
                    (F.col("event_id") % 3).cast("string"), F.lit(', "extraHops": 0}\''))
    line = F.when(place == 2, F.concat(F.lit("    - "), "url", n)).otherwise(item)
    at = lambda i, e: F.struct(i.cast("long").alias("b"), e.cast("long").alias("n")).alias("_at")
    items = c.select(line.alias("line"), _in_file("crawls").alias("_file"), at(place, F.col("event_id") + 1))
    heads = c.select("collection").distinct().select("*", F.posexplode(F.array(*map(F.lit, ("queued", "pending", "done")))).alias("i", "list"))
    heads = heads.select(F.concat(F.lit("  "), "list", F.lit(":")).alias("line"), _in_file("crawls").alias("_file"),
                         at(F.col("i"), F.lit(0)))
    return R.frontier_rows(cut(items.unionByName(heads)))


def q_read_frontier(spark, sf):
    """Crawl state lines to items with the list they stand in."""
    return _frontier(spark, sf).withColumn("added", F.col("added").cast("timestamp_ntz"))


def q_frontier_summary(spark, sf):
    """URLs per list and depth."""
    return A.frontier_summary(_frontier(spark, sf))[0]


def q_frontier_minutes(spark, sf):
    """URLs added per minute."""
    return A.frontier_summary(_frontier(spark, sf))[1].withColumn("minute", F.col("minute").cast("timestamp_ntz"))


def q_feed_for_outlet(spark, sf):
    """Own feeds of every third site, feeds from heads of even pages, feeds from sitemaps of every fifth page."""
    o = D.outlets(spark, sf)
    own = F.array(F.concat("website", F.lit("rss")), F.concat("website", F.lit("feed")), F.concat("website", F.lit("rss")))
    o = o.withColumn("rss", F.when(F.length("name") % 3 == 0, own).when(F.length("name") % 3 == 1, F.array().cast("array<string>")))
    p = D.table(spark, sf, "pages").select("page_id", U.site_root("url").alias("website"))
    def found(k, name):
        return p.filter(F.col("page_id") % k == 0).select("website", F.concat("website", F.lit(name), (F.col("page_id") % 4).cast("string")).alias("feed"))
    return J.feed_for_outlet(o, found(2, "atom/"), found(5, "map/")).withColumn("pos", F.col("pos").cast("int"))


QUERIES: dict[str, Query] = {
    "q_links": q_links,
    "q_links_distinct": q_links_distinct,
    "q_links_per_page": q_links_per_page,
    "q_articles_base": _articles("base"),
    "q_articles_last_segment": _articles("last_segment"),
    "q_articles_depth3": q_articles_depth3,
    "q_articles_not_home": q_articles_not_home,
    "q_same_site": q_same_site,
    "q_crawlable": q_crawlable,
    "q_url_parts": q_url_parts,
    "q_domain": q_domain,
    "q_normalized_dedup": q_normalized_dedup,
    "q_url_hash": q_url_hash,
    "q_archive_path": q_archive_path,
    "q_url_order": q_url_order,
    "q_html_words": q_html_words,
    "q_content_words20": q_content_words20,
    "q_content_chars20": q_content_chars20,
    "q_content_check": q_content_check,
    "q_cap5": q_cap5,
    "q_cap11": q_cap11,
    "q_union_candidates": q_union_candidates,
    "q_drop_seen": q_drop_seen,
    "q_known_domain": q_known_domain,
    "q_new_urls": q_new_urls,
    "q_kept_urls": q_kept_urls,
    "q_expand_urls": q_expand_urls,
    "q_expand_chain": q_expand_chain,
    "q_in_scope": q_in_scope,
    "q_seed_of": q_seed_of,
    "q_seed_report": q_seed_report,
    "q_host_report": q_host_report,
    "q_type_report": q_type_report,
    "q_top_hosts": q_top_hosts,
    "q_dedup_content": q_dedup_content,
    "q_duplicate_share": q_duplicate_share,
    "q_duplicate_sketch": q_duplicate_sketch,
    "q_daily_quota": q_daily_quota,
    "q_daily_usage": q_daily_usage,
    "q_crawl_progress": q_crawl_progress,
    "q_capture_changes": q_capture_changes,
    "q_capture_as_of": q_capture_as_of,
    "q_sliding_usage": q_sliding_usage,
    "q_sessions": q_sessions,
    "q_status_report": q_status_report,
    "q_registry_flat": q_registry_flat,
    "q_media_counts": q_media_counts,
    "q_coverage": q_coverage,
    "q_needs_feed": q_needs_feed,
    "q_attach_status": q_attach_status,
    "q_alive": q_alive,
    "q_archive_outcome": q_archive_outcome,
    "q_outcome_counts": q_outcome_counts,
    "q_record_captures": q_record_captures,
    "q_locate_block": q_locate_block,
    "q_publication_time": q_publication_time,
    "q_log_summary": q_log_summary,
    "q_registry_seeds": q_registry_seeds,
    "q_seed_type": q_seed_type,
    "q_exact_ok": q_exact_ok,
    "q_feed_like": q_feed_like,
    "q_status_class": q_status_class,
    "q_urlkey_host": q_urlkey_host,
    "q_robots_urls": q_robots_urls,
    "q_first_feed": q_first_feed,
    "q_page_resources": q_page_resources,
    "q_collect": q_collect,
    "q_discover_feeds": q_discover_feeds,
    "q_robots_sitemaps": q_robots_sitemaps,
    "q_sitemap_locs": q_sitemap_locs,
    "q_feed_entries": q_feed_entries,
    "q_seed_metrics": q_seed_metrics,
    "q_average_usage": q_average_usage,
    "q_page_durations": q_page_durations,
    "q_log_field": q_log_field,
    "q_site_record": q_site_record,
    "q_page_captures": q_page_captures,
    "q_read_cdx": q_read_cdx,
    "q_read_block_index": q_read_block_index,
    "q_read_crawl_log": q_read_crawl_log,
    "q_read_scraper_log": q_read_scraper_log,
    "q_read_frontier": q_read_frontier,
    "q_crawl_summary": q_crawl_summary,
    "q_frontier_summary": q_frontier_summary,
    "q_frontier_minutes": q_frontier_minutes,
    "q_feed_for_outlet": q_feed_for_outlet,
}
