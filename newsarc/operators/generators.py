"""Generators: one fetched body -> many rows.

Bodies are parsed with regular expressions inside the JVM. The per-page work
(finding tags, picking the first feed link) is done on the arrays of one row,
so no generator needs a shuffle; only the caller's later distinct/cap does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsarc.functions import urls as U
from newsarc.functions.common import col_of, let

# One attribute of a tag (name, or name=value with the value quoted or not), and the value of a named one.
_OTHER = r"""(?:[^\s"'>]++|"[^"]*+"|'[^']*+'|\s(?!%s\s*=))*+"""
_VALUE = r"""\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
A_HREF = r"(?i)<a(?=\s)" + _OTHER % "href" + r"\shref" + _VALUE
LINK_TAG = r"""(?i)<link(?=[\s/>])(?:[^"'>]++|"[^"]*+"|'[^']*+')*+>"""
TYPE_ATTR = r"(?i)^<link" + _OTHER % "type" + r"\stype" + _VALUE
HREF_ATTR = r"(?i)^<link" + _OTHER % "href" + r"\shref" + _VALUE
LOC_TAG = r"(?is)<loc(?:\s[^>]*)?>(.*?)</loc\s*>"
# What a parser does not read as markup.
HIDDEN = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
# Named character references that occur in addresses.
ENTITIES = (("&quot;", '"'), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", "\u00a0"), ("&amp;", "&"))
# Feed MIME types, in the order they are tried.
FEED_TYPES = ("application/rss+xml", "application/atom+xml", "text/xml", "application/xml")
RSS_ONLY = ("application/rss+xml",)


def unescape(text) -> Column:
    """Character references decoded once: numeric ones, then the named ones, ``&amp;`` last."""
    t = col_of(text)
    number = "&#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"

    def char(ref: Column) -> Column:
        digits = F.regexp_extract(ref, "([0-9a-fA-F]+);", 1)
        code = F.when(F.lower(ref).contains("x"), F.conv(digits, 16, 10)).otherwise(digits).cast("long")
        return F.when(code == 38, F.lit("&amp;")).when(code.between(1, 0x10FFFF), F.decode(
            F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))

    refs = F.transform(F.regexp_extract_all(t, F.lit(number), F.lit(0)), char)
    joined = let(F.struct(refs.alias("r"), F.split(t, number, -1).alias("p")), lambda x: F.array_join(
        F.transform(x["p"], lambda p, i: F.concat(p, F.coalesce(F.get(x["r"], i), F.lit("")))), ""))
    out = F.when(t.contains("&#"), joined).otherwise(t)
    for ref, plain in ENTITIES:
        out = F.replace(out, F.lit(ref), F.lit(plain))
    return F.when(t.contains("&"), out).otherwise(t)


def unquote_attr(value) -> Column:
    """Attribute text without its quotes, character references decoded (as an HTML parser does)."""
    v = col_of(value)
    inner = F.when(v.startswith('"') | v.startswith("'"),
                   F.substring(v, F.lit(2), F.length(v) - 2)).otherwise(v)
    return unescape(inner)


def markup(body) -> Column:
    """The body without comments, scripts and styles."""
    return F.regexp_replace(col_of(body), HIDDEN, " ")


def hrefs(body) -> Column:
    """All ``<a href>`` values of a body, in document order."""
    return F.transform(F.regexp_extract_all(markup(body), F.lit(A_HREF), F.lit(1)), unquote_attr)


def extract_links(fetches: DataFrame, body: str = "body", base: str = "final_url",
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """G1: every ``<a href>`` of a page as a row, resolved on the page's final URL.

    Output: ``keep`` columns, ``pos`` (0-based order in the page), ``href``, ``url``.
    Links are not made distinct here; U1 does that with a defined winner. The
    base URL is split once per page, before the explode.
    """
    pages = U.with_base_parts(fetches.select(*keep, F.col(base).alias("_base"), F.col(body).alias("_body")),
                              "_base")
    exploded = pages.select(*keep, F.posexplode(U.resolve_all(hrefs("_body"))).alias("pos", "_l"))
    return exploded.select(*keep, "pos", F.col("_l.href").alias("href"), F.col("_l.url").alias("url"))


def _attr(tag: Column, pattern: str) -> Column:
    return unquote_attr(F.regexp_extract(tag, pattern, 1))


def feed_link(body, base=None, types: tuple[str, ...] = FEED_TYPES, raw: bool = False) -> Column:
    """G2 per page: href of the first ``<link type=T>`` for T in ``types`` order.

    For each type only the first tag of that type counts; a tag without href
    passes to the next type. The href is resolved on ``base`` unless ``raw``.
    """
    tags = F.regexp_extract_all(markup(body), F.lit(LINK_TAG), F.lit(0))
    infos = F.transform(tags, lambda t: F.struct(_attr(t, TYPE_ATTR).alias("type"),
                                                 _attr(t, HREF_ATTR).alias("href")))

    def of_type(t):
        return lambda x: x["type"] == F.lit(t)

    def first_href(arr):
        picks = [let(F.try_element_at(F.filter(arr, of_type(t)), F.lit(1)),
                     lambda f: F.when(f["href"] != "", f["href"])) for t in types]
        return F.coalesce(*picks)

    found = let(infos, first_href)
    if raw or base is None:
        return found
    return U.url_resolve(col_of(base), found)


def discover_feeds(fetches: DataFrame, body: str = "body", base: str = "final_url",
                   keep: tuple[str, ...] = ("url",), raw: bool = False,
                   rss_only: bool = False) -> DataFrame:
    """One row per page that declares a feed: ``keep`` columns + ``feed``."""
    types = RSS_ONLY if rss_only else FEED_TYPES
    out = fetches.select(*keep, feed_link(body, F.col(base), types, raw).alias("feed"))
    return out.filter(F.col("feed").isNotNull())


def robots_sitemaps(fetches: DataFrame, body: str = "body",
                    keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """``Sitemap:`` lines of robots.txt (any case), text after the first colon, trimmed."""
    lines = F.split(col_of(body), "\r\n|\r|\n")
    maps = F.transform(F.filter(lines, lambda ln: F.lower(ln).startswith("sitemap:")),
                       lambda ln: F.regexp_replace(F.substring(ln, 9, 1 << 30),
                                                   r"^\s+|\s+$", ""))
    return fetches.select(*keep, F.posexplode(maps).alias("pos", "sitemap"))


def sitemap_locs(fetches: DataFrame, body: str = "body",
                 keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """Text of every ``<loc>`` of a sitemap (broken XML tolerated)."""
    locs = F.transform(F.regexp_extract_all(F.regexp_replace(col_of(body), "(?s)<!--.*?-->", ""), F.lit(LOC_TAG), F.lit(1)),
                       xml_text)
    return fetches.select(*keep, F.posexplode(locs).alias("pos", "loc"))


def xml_text(inner) -> Column:
    """Text of an element: a CDATA section as it is, else with references decoded; blanks cut at both ends."""
    x = F.regexp_replace(col_of(inner), r"^\s+|\s+$", "")
    raw = F.regexp_extract(x, r"(?s)^<!\[CDATA\[(.*)\]\]>$", 1)
    return F.regexp_replace(F.when(x.startswith("<![CDATA["), raw).otherwise(unescape(x)), r"^\s+|\s+$", "")


ITEM = r"(?is)<item\b[^>]*>.*?</item>|<entry\b[^>]*>.*?</entry>"
ITEM_LINK_TEXT = r"(?is)<link(?:\s[^>]*)?>([^<]*|\s*<!\[CDATA\[.*?\]\]>\s*)</link>"
REL_ATTR = r"(?i)^<link" + _OTHER % "rel" + r"\srel" + _VALUE
# The date elements, in the order they are tried.
DATE_TAGS = ("pubDate", "published", "dc:date", "updated")


def _element(item, name: str) -> Column:
    return xml_text(F.regexp_extract(col_of(item), rf"(?is)<{name}(?:\s[^>]*)?>(.*?)</{name}\s*>", 1))


def _item_link(item) -> Column:
    """RSS: the text of ``<link>``; Atom: the first link whose rel is absent or ``alternate``, else the first."""
    text = xml_text(F.regexp_extract(col_of(item), ITEM_LINK_TEXT, 1))
    tags = F.transform(F.regexp_extract_all(col_of(item), F.lit(LINK_TAG), F.lit(0)), lambda t: F.struct(
        F.lower(_attr(t, REL_ATTR)).alias("rel"), _attr(t, HREF_ATTR).alias("href")))
    with_href = F.filter(tags, lambda x: x["href"] != "")
    atom = let(with_href, lambda a: F.coalesce(
        F.try_element_at(F.filter(a, lambda x: x["rel"].isin("", "alternate")), F.lit(1))["href"],
        F.try_element_at(a, F.lit(1))["href"]))
    return F.when(text != "", text).otherwise(atom)


def feed_entries(fetches: DataFrame, body: str = "body",
                 keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """RSS ``<item>`` and Atom ``<entry>`` rows: ``entry_pos``, ``link``, ``published``.

    ``published`` is the raw date text (P11 parses it), NULL if there is none. An
    entry without a link is left out; positions count all entries.
    """
    items = F.regexp_extract_all(F.regexp_replace(col_of(body), "(?s)<!--.*?-->", ""), F.lit(ITEM), F.lit(0))
    rows = fetches.select(*keep, F.posexplode(items).alias("entry_pos", "item"))
    dates = [F.nullif(_element("item", t), F.lit("")) for t in DATE_TAGS]
    return rows.select(*keep, "entry_pos", _item_link("item").alias("link"),
                       F.coalesce(*dates).alias("published")).filter(F.col("link") != "")


def registry_seeds(outlets: DataFrame, website: str = "website") -> DataFrame:
    """Seed URLs with a forced trailing slash, distinct."""
    w = F.col(website)
    seeds = outlets.filter(w.isNotNull() & (w != "")) \
        .select(F.concat(F.regexp_replace(w, "/+$", ""), F.lit("/")).alias("seed_url"))
    return seeds.distinct()
