"""The archive's tables as Spark derives them from the driver's parquet tables.

The driver ships ``pages(page_id, url, html)``, ``documents(doc_id, text, lang,
source, n_chars)`` and ``events(event_id, ts, user_id, event_type, value,
props)``. Each view below maps one of them onto a table of the archive, row
by row (no sampling, no subsets), so every query's work grows with them:

* ``pages``     -> fetches (a fetched page and its body), candidates, outlets
* ``documents`` -> captures of article texts (digest = md5 of the text)
* ``events``    -> captures of sites over time (url by user, digest by type)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsarc.functions import urls as U
from newsarc.functions.content import content_size, html_text
from newsarc.operators.generators import extract_links

# The mapping of event types onto capture fields.
EVENT_STATUS = {"error": 500, "signup": 302}          # others: 200
EVENT_MIME = {"view": "text/html", "click": "application/json",
              "purchase": "text/html", "signup": "application/javascript"}  # error: unknown
# Outlet media class by top-level domain of the site.
TLD_MEDIA = {"com": "newspaper", "net": "radio", "org": "tv"}  # others: broadcast
RUN_DAY = "2025-03-17"   # the collection round the pages belong to


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(col, mapping: dict, default):
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v)))
    return expr.otherwise(F.lit(default))


# ---------------------------------------------------------------- pages

def page_lang(url) -> F.Column:
    """First path segment of a page URL (its language section)."""
    return F.try_element_at(U.path_segments(url), F.lit(1))


def fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: one fetch per page; the final URL is the page URL without its fragment."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", "url", F.regexp_replace("url", "#.*$", "").alias("final_url"),
                    F.lit(200).alias("status"), F.col("html").alias("body"))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 over every page: page_id, website, website_hash, pos, href, url."""
    p = table(spark, sf_dir, "pages").select(
        "page_id", "html", F.col("url").alias("page_url"),
        U.site_root("url").alias("website"))
    p = p.withColumn("website_hash", F.md5("website"))
    return extract_links(p, body="html", base="page_url",
                         keep=("page_id", "website", "website_hash"))


def page_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page URLs themselves as feed-origin candidates (origin 0)."""
    p = table(spark, sf_dir, "pages")
    return p.select(U.site_root("url").alias("website"), F.md5(U.site_root("url")).alias("website_hash"),
                    "url", F.col("page_id").alias("feed_pos"), F.lit(0).alias("entry_pos"))


def page_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text size of each page, computed in the scan (the body is dropped here)."""
    p = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return with_text_sizes(p, "html", ("page_id", "url"))


def with_text_sizes(df: DataFrame, body: str, keep: tuple[str, ...]) -> DataFrame:
    """``keep`` + ``n_words`` + ``n_chars`` of the body's text, the text computed once.

    The sizes leave through a one-row generator (``inline``), so a later
    filter on them (F7) stays above it instead of being rewritten into a
    second evaluation of ``html_text`` below it.
    """
    text = df.select(*keep, html_text(body).alias("_text"))
    sizes = F.struct(content_size("_text", "words").alias("n_words"),
                     content_size("_text", "chars").alias("n_chars"))
    return text.select(*keep, F.inline(F.array(sizes)))


def page_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as captures of a crawl: seed = site, bytes = body length, type = language."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", U.site_root("url").alias("collection"), "url",
                    F.length("html").cast("long").alias("length"),
                    page_lang("url").alias("mime"))


def outlets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 flat: one outlet per site seen in the pages.

    state = language section of its first page, media = by top-level domain,
    website_status = 200 (it answered), has_feed = a page URL looks like a feed.
    """
    p = table(spark, sf_dir, "pages").select(
        "page_id", "url", U.site_root("url").alias("website"), U.url_netloc("url").alias("name"))
    g = p.groupBy("website", "name").agg(
        F.upper(F.min_by(page_lang("url"), F.col("page_id"))).alias("state"),
        F.count(F.lit(1)).cast("long").alias("n_pages"),
        F.max(F.col("url").contains("rss") | F.col("url").contains("feed")).alias("has_feed"))
    tld = F.regexp_extract("name", r"\.([A-Za-z]+)$", 1)
    return g.select("state", _case(tld, TLD_MEDIA, "broadcast").alias("media"), "name",
                    "website", F.md5("website").alias("website_hash"), "n_pages",
                    F.lit(200).alias("website_status"), "has_feed")


# ------------------------------------------------------------ documents

def document_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", "source", F.md5("source").alias("website_hash"),
                    F.concat(F.lit("https://"), F.col("source"), F.lit(".example.org/doc/"),
                             F.col("doc_id").cast("string")).alias("url"),
                    F.md5("text").alias("digest"), F.col("n_chars").alias("length"))


# --------------------------------------------------------------- events

def event_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as captures of a site over time (one site per user)."""
    e = table(spark, sf_dir, "events")
    uid = F.col("user_id").cast("string")
    return e.select(
        "event_id",
        F.concat(F.lit("com,example,u"), uid, F.lit(")/")).alias("urlkey"),
        F.concat(F.lit("https://u"), uid, F.lit(".example.com/")).alias("url"),
        "ts",
        F.col("event_type").alias("digest"),
        F.floor(F.col("value") * 100 + 0.5).cast("long").alias("length"),
        _case(F.col("event_type"), EVENT_STATUS, 200).alias("status"),
        F.when(F.col("event_type").isin(*EVENT_MIME),
               _case(F.col("event_type"), EVENT_MIME, None)).alias("mime"),
        F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("collection"),
    )


def archive_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archiver outputs, one per event: error -> server error, signup -> refused, else a URL."""
    c = event_captures(spark, sf_dir)
    ok = F.concat(F.lit("https://web.archive.org/web/"), F.date_format("ts", "yyyyMMddHHmmss"),
                  F.lit("/"), F.col("url"))
    out = (F.when(F.col("digest") == "error", F.lit("520 Server Error: Unknown Error"))
           .when(F.col("digest") == "signup", F.lit("Error: archive refused the URL"))
           .otherwise(ok))
    return c.select("event_id", "url", F.md5("url").alias("website_hash"),
                    out.alias("output"), F.col("ts").alias("called_at"))
