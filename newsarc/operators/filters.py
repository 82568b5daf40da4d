"""Filters and predicates.

Each rule exists twice: as a boolean Column (``*_flag``) for use inside a
larger projection, and as a DataFrame filter. The URL tests are plain
expressions, so Catalyst pushes them below joins and they run in the scan's
code-generated stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsarc.functions import urls as U
from newsarc.functions.common import col_of, let

ARTICLE_RULES = ("base", "last_segment", "depth3", "not_home")

# The content thresholds of the article test.
MIN_WORDS = 20   # stated rule: pages with fewer than 20 words are dropped
MIN_CHARS = 20   # code: more than 20 characters are kept


def alive(df: DataFrame, status: str = "website_status") -> DataFrame:
    """status present and 2xx."""
    return df.filter(F.col(status).between(200, 299))


def exact_ok(df: DataFrame, media: str = "media", status: str = "website_status",
             website: str = "website") -> DataFrame:
    """newspapers answering exactly 200 with a website."""
    return df.filter((F.col(media) == "newspaper") & (F.col(status) == 200)
                     & F.col(website).isNotNull() & (F.col(website) != ""))


def article_flag(url, rule: str = "base", site=None) -> Column:
    """URL-shape part of the article test, on the (expanded) URL.

    base         depth 0 no; depth >= 3 yes; depth 1-2 with -, _ or . in a segment
    last_segment the last segment is numeric or has a boundary, then as base with
                 numeric segments counting as boundaries
    depth3       depth >= 3 only
    not_home     as base, and neither the site URL nor the site's path
    """
    if rule not in ARTICLE_RULES:
        raise ValueError(f"rule must be one of {ARTICLE_RULES}")
    if rule == "not_home" and site is None:
        raise ValueError("rule 'not_home' needs the site column")
    u = col_of(url)

    def shape_of(segs):        # the segments are computed once and bound here
        depth = F.size(segs)
        first_two = F.slice(segs, 1, 2)
        if rule == "base":
            return (depth >= 3) | ((depth >= 1) & F.exists(first_two, U.has_word_boundary))
        if rule == "last_segment":
            last = F.try_element_at(segs, F.lit(-1))
            last_ok = U.is_numeric_segment(last) | U.has_word_boundary(last)
            some = F.exists(first_two, lambda s: U.has_word_boundary(s) | U.is_numeric_segment(s))
            return (depth >= 1) & last_ok & ((depth >= 3) | some)
        if rule == "depth3":
            return depth >= 3
        s = col_of(site)
        home = (u == s) | (U.url_path(s) == U.url_path(u))
        return ~home & ((depth >= 3) | ((depth >= 1) & F.exists(first_two, U.has_word_boundary)))

    return F.coalesce(U.is_valid_url(u) & let(U.path_segments(u), shape_of), F.lit(False))


def article_url(df: DataFrame, rule: str = "base", url: str = "url",
                site: str | None = None) -> DataFrame:
    """F3-F6 as a filter."""
    return df.filter(article_flag(url, rule, site))


def enough_content_flag(size, unit: str = "words") -> Column:
    """words >= 20 (stated rule, default) or characters > 20 (code)."""
    s = col_of(size)
    if unit == "words":
        return F.coalesce(s >= MIN_WORDS, F.lit(False))
    if unit == "chars":
        return F.coalesce(s > MIN_CHARS, F.lit(False))
    raise ValueError("unit must be 'words' or 'chars'")


def enough_content(df: DataFrame, size: str, unit: str = "words") -> DataFrame:
    return df.filter(enough_content_flag(size, unit))


def same_site_flag(url, site) -> Column:
    """F8: the link's netloc starts with the site's netloc."""
    return F.coalesce(U.url_netloc(col_of(url)).startswith(U.url_netloc(col_of(site))),
                      F.lit(False))


def same_site(df: DataFrame, url: str = "url", site: str = "website") -> DataFrame:
    return df.filter(same_site_flag(url, site))


def feed_like_flag(text) -> Column:
    """contains ``rss`` or ``feed`` (case-sensitive, as written)."""
    t = col_of(text)
    return F.coalesce(t.contains("rss") | t.contains("feed"), F.lit(False))


def feed_like(df: DataFrame, text: str = "loc") -> DataFrame:
    return df.filter(feed_like_flag(text))


def needs_feed_flag(website="website", rss="rss") -> Column:
    """a website and no feed (``rss`` missing or empty)."""
    w, r = col_of(website), col_of(rss)
    return (w.isNotNull() & (w != "")) & (F.coalesce(F.size(r), F.lit(0)) <= 0)


def needs_feed(df: DataFrame) -> DataFrame:
    return df.filter(needs_feed_flag())


def _host(url) -> Column:
    """Host and port in lower case, without user info."""
    return F.regexp_replace(F.lower(U.url_netloc(url)), "^.*@", "")


def scope_prefix(seed) -> Column:
    """Host and path of a seed up to the path's last ``/`` (http and https alike).

    A seed without a path covers its host: ``https://h`` like ``https://h/``.
    """
    folder = F.regexp_extract(U.url_path(seed, strip_params=False), "^(.*/)", 1)
    return F.concat(_host(seed), F.when(folder == "", F.lit("/")).otherwise(folder))


def in_scope_flag(url, seed, include=None, exclude=None) -> Column:
    """default scope of a seed plus include/exclude regex lists.

    In scope when host (and port) are the seed's and the path starts with the
    seed's path up to its last ``/`` (so ``https://h/local`` covers all of
    ``h``), or the URL matches an include regex; never when it matches an exclude
    regex. Non-http URLs are out.
    """
    u = col_of(url)
    path = U.url_path(u, strip_params=False)
    place = F.concat(_host(u), F.when(path == "", F.lit("/")).otherwise(path))
    ok = U.is_crawlable(u) & (U.url_netloc(seed) != "") & place.startswith(scope_prefix(seed))
    if include is not None:
        ok = ok | F.coalesce(F.exists(col_of(include), lambda r: F.regexp_like(u, r)), F.lit(False))
    if exclude is not None:
        ok = ok & ~F.coalesce(F.exists(col_of(exclude), lambda r: F.regexp_like(u, r)), F.lit(False))
    return F.coalesce(ok, F.lit(False))


def in_scope(df: DataFrame, scopes: DataFrame, url: str = "url") -> DataFrame:
    """F11 as a join: rows carry ``seed_url``; scopes give include/exclude lists."""
    joined = df.join(scopes.select("seed_url", "include", "exclude"), "seed_url", "left")
    return joined.filter(in_scope_flag(url, "seed_url", "include", "exclude")) \
        .drop("include", "exclude")


def seed_of(links: DataFrame, seeds: DataFrame, url: str = "url", seed: str = "seed_url", out: str = "seed_url") -> DataFrame:
    """F11 over a table of seeds: each link with the seed whose scope holds it (the longest prefix), or NULL.

    A scope ends at a ``/``, so only the folders on the link's own path can be one: a link asks for
    those (as many as its path has ``/``) by an equi-join on host and folder, and the longest that answers
    wins. The number of seeds of a host plays no part. Of seeds with one scope the smallest URL counts.
    Links keep their number, repeated ones too; no seed table grows a link.
    """
    scopes = (seeds.filter(F.coalesce(U.url_netloc(seed) != "", F.lit(False)))
              .groupBy(scope_prefix(seed).alias("_scope")).agg(F.min(seed).alias("_seed")))
    asked = links.select(F.col(url).alias("_u")).filter(U.is_crawlable("_u")).distinct()
    path = U.url_path("_u", strip_params=False)
    place = F.concat(_host("_u"), F.when(path == "", F.lit("/")).otherwise(path))
    asked = asked.withColumn("_parts", F.split(place, "/"))
    folders = F.transform(F.sequence(F.lit(1), F.size("_parts") - 1),
                          lambda n: F.concat(F.array_join(F.slice("_parts", F.lit(1), n), "/"), F.lit("/")))
    rows = asked.select("_u", F.explode(F.when(F.size("_parts") > 1, folders)).alias("_scope"))
    best = rows.join(scopes, "_scope").groupBy("_u").agg(
        F.max_by("_seed", F.length("_scope")).alias("_best"))
    return links.join(best, links[url] == best["_u"], "left").drop("_u").withColumnRenamed("_best", out)


# Seed types as (follow in-scope links, extra hops off scope).
SEED_TYPES = {
    "standard": (True, 0),
    "standard_plus": (True, 1),
    "one_page": (False, 0),
    "one_page_plus": (False, 1),
}


def seed_type_flag(kind: str, depth, in_scope_col, hops) -> Column:
    """is a discovered URL crawled under a seed type?

    ``depth`` is the link distance from the seed, ``hops`` the links taken
    outside the scope. Standard: any in-scope page; Standard+: plus the first
    page of links off them; One Page: the seed only; One Page+: the seed and
    the pages it links to directly.
    """
    if kind not in SEED_TYPES:
        raise ValueError(f"kind must be one of {sorted(SEED_TYPES)}")
    follow, extra = SEED_TYPES[kind]
    d, s, h = col_of(depth), col_of(in_scope_col), col_of(hops)
    if follow:
        ok = (s & (h == 0)) | ((h >= 1) & (h <= extra))
    else:
        ok = (d == 0) | ((d == 1) & F.lit(extra >= 1))
    return F.coalesce(ok, F.lit(False))


def crawlable(df: DataFrame, url: str = "url") -> DataFrame:
    """only http(s) URLs."""
    return df.filter(U.is_crawlable(url))
