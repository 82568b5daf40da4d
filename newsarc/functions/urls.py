"""URL column functions.

All of them are built-in Spark expressions (regexps, arrays and higher-order
functions), so they stay inside whole-stage code generation. ``parse_url`` is
not used: it throws on URLs the standard library accepts (spaces, ``|``).

The semantics follow the standard library's ``urlsplit``/``urlparse``/
``urljoin`` that the collectors use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsarc.functions.common import col_of, let

# Grammar of a URL scheme, and the file names joined to a site.
SCHEME = "[A-Za-z][A-Za-z0-9+.-]*"
ROBOTS_FILE = "robots.txt"
SITEMAP_FILES = ("sitemap.xml", "sitemap_index.xml")
IPV6_OR_FUTURE = (r"^(?:v[0-9A-Fa-f]+\..+|(?:[0-9A-Fa-f]{0,4}:){2,7}"
                  r"(?:[0-9A-Fa-f]{0,4}|[0-9]{1,3}(?:\.[0-9]{1,3}){3})(?:%.+)?)$")


def clean_url(url) -> Column:
    """Strip leading C0 controls/blanks and drop tab, CR and LF, as urlsplit does."""
    c = col_of(url)
    return F.regexp_replace(F.regexp_replace(c, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")


def url_scheme(url) -> Column:
    """Lower-cased scheme, '' when there is none."""
    return F.lower(F.regexp_extract(col_of(url), f"^({SCHEME}):", 1))


def url_netloc(url) -> Column:
    """Authority part (user info and port kept), '' without ``//``."""
    return F.regexp_extract(col_of(url), f"^(?:{SCHEME}:)?//([^/?#]*)", 1)


def url_path(url, strip_params: bool = True) -> Column:
    """Path as ``urlparse`` gives it: ``;params`` of the last segment removed."""
    path = F.regexp_extract(col_of(url), f"^(?:{SCHEME}:)?(?://[^/?#]*)?([^?#]*)", 1)
    if strip_params:
        path = F.regexp_replace(path, ";[^/]*$", "")
    return path


def url_query(url) -> Column:
    return F.regexp_extract(col_of(url), r"^[^?#]*\?([^#]*)", 1)


def url_fragment(url) -> Column:
    return F.regexp_extract(col_of(url), "^[^#]*#(.*)$", 1)


def is_valid_url(url) -> Column:
    """Scheme and netloc both non-empty; an unbalanced ``[``/``]`` is an error -> false."""
    u = clean_url(url)
    netloc = url_netloc(u)
    unbalanced = netloc.contains("[") != netloc.contains("]")
    # a bracketed host must look like an IPv6 address or an IPvFuture literal
    bracketed = F.regexp_extract(netloc, r"\[([^\]]*)\]", 1)
    bad_host = netloc.contains("[") & ~bracketed.rlike(IPV6_OR_FUTURE)
    return F.coalesce(u.rlike(f"^{SCHEME}://[^/?#]+") & ~unbalanced & ~bad_host, F.lit(False))


def percent_decode(url) -> Column:
    """``%XX`` decoding as ``urllib.parse.unquote``: ``+`` stays, bad escapes stay."""
    c = col_of(url)
    protected = F.regexp_replace(F.regexp_replace(c, r"\+", "%2B"), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(protected), c)


def domain(url) -> Column:
    """Netloc of the decoded URL, cut at ``&``, leading ``www.`` removed; '' -> NULL."""
    netloc = url_netloc(percent_decode(clean_url(url)))
    d = F.regexp_replace(F.split_part(netloc, F.lit("&"), F.lit(1)), r"^www\.", "")
    return F.when(d != "", d)


def site_root(url) -> Column:
    """``scheme://netloc/`` of a URL: the outlet's website for a fetched page."""
    return F.concat(url_scheme(url), F.lit("://"), url_netloc(url), F.lit("/"))


def path_segments(url) -> Column:
    """Non-empty parts of the path."""
    return F.filter(F.split(url_path(url), "/"), lambda s: s != "")


def path_depth(url) -> Column:
    return F.size(path_segments(url))


def has_word_boundary(segment) -> Column:
    """P5: the segment holds ``-``, ``_`` or ``.``."""
    return col_of(segment).rlike("[-_.]")


def is_numeric_segment(segment) -> Column:
    """Digits only (ASCII digits)."""
    return col_of(segment).rlike("^[0-9]+$")


def normalize_url(url) -> Column:
    """Lower case, trailing slashes removed."""
    return F.regexp_replace(F.lower(col_of(url)), "/+$", "")


def url_hash(url) -> Column:
    """md5 hex of the URL text (the site directory of the archive tree)."""
    return F.md5(col_of(url))


def archive_path(state, ts, site) -> Column:
    """``news/<state>/<y>/<m>/<d>/<md5(site)>``; month and day not zero-padded."""
    t = col_of(ts)
    return F.concat_ws("/", F.lit("news"), col_of(state), F.year(t).cast("string"),
                       F.month(t).cast("string"), F.dayofmonth(t).cast("string"),
                       F.md5(col_of(site)))


def _remove_dot_segments(segments: Column) -> Column:
    empty = F.array().cast("array<string>")

    def step(acc, s):
        return (F.when(s == "..", F.when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1))
                       .otherwise(acc))
                .when(s == ".", acc)
                .otherwise(F.concat(acc, F.array(s))))

    resolved = F.aggregate(segments, empty, step)
    last = F.try_element_at(segments, F.lit(-1))
    return F.when(last.isin(".", ".."), F.concat(resolved, F.array(F.lit("")))).otherwise(resolved)


# a path with a "." or ".." segment needs the fold above; others are joined as they are
DOT_SEGMENT = r"(^|/)\.\.?(/|$)"


def _split_params(full_path: Column) -> tuple[Column, Column]:
    """``urlparse``'s split of ``;params`` from the last segment: (path, params)."""
    return F.regexp_replace(full_path, ";[^/]*$", ""), F.regexp_extract(full_path, ";([^/]*)$", 1)


def _base_parts(b: Column, orig: Column | None = None) -> dict[str, Column]:
    """Parts of a (cleaned) base URL that every href resolved on it needs."""
    path, params = _split_params(url_path(b, strip_params=False))
    parts = F.split(path, "/")
    base_dir = F.when(F.try_element_at(parts, F.lit(-1)) != "",
                      F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    return {"orig": b if orig is None else orig, "raw": b, "scheme": url_scheme(b),
            "netloc": url_netloc(b), "path": path, "params": params, "query": url_query(b),
            "dir": base_dir}


def _href_parts(h: Column, b_scheme: Column) -> dict[str, Column]:
    """Parts of a (cleaned) href: its scheme and the text after ``scheme:``."""
    h_scheme = url_scheme(h)
    rest = F.when(h_scheme != "", F.regexp_extract(h, f"(?s)^{SCHEME}:(.*)$", 1)).otherwise(h)
    return {"raw": h, "scheme": h_scheme, "rest": rest}


def _net_parts(rest: Column) -> dict[str, Column]:
    """A ``//netloc`` at the start of the rest, and what follows it."""
    has_net = rest.startswith("//")
    return {"has_net": has_net, "netloc": F.regexp_extract(rest, "^//([^/?#]*)", 1),
            "after": F.when(has_net, F.regexp_extract(rest, "(?s)^//[^/?#]*(.*)$", 1)).otherwise(rest)}


def _rest_parts(after: Column) -> dict[str, Column]:
    path, params = _split_params(F.regexp_extract(after, "^([^?#]*)", 1))
    return {"path": path, "params": params, "query": url_query(after), "fragment": url_fragment(after)}


def _joined_path(b: dict, r: dict) -> Column:
    """Resolved path of an href with a path: merged with the base directory, dots removed."""
    r_path = r["path"]
    merged = F.concat(b["dir"], F.split(r_path, "/"))
    n = F.size(merged)
    merged = F.concat(F.slice(merged, 1, 1), F.filter(F.slice(merged, 2, n - 2), lambda s: s != ""),
                      F.slice(merged, n, 1))
    absolute = r_path.startswith("/")
    simple_abs = absolute & ~r_path.rlike(DOT_SEGMENT)
    return F.when(simple_abs, r_path).otherwise(
        F.array_join(_remove_dot_segments(F.when(absolute, F.split(r_path, "/")).otherwise(merged)), "/"))


def _part(sep: str, value: Column) -> Column:
    """``sep + value``, or nothing when the value is empty (as urlunparse drops it)."""
    return F.when(value != "", F.concat(F.lit(sep), value)).otherwise(F.lit(""))


def _join(b: dict, h: dict, r: dict, joined: Column | None = None) -> Column:
    """The urljoin case analysis over already computed parts."""
    if joined is None:
        joined = _joined_path(b, r)
    prefix = F.concat(b["scheme"], F.lit("://"), b["netloc"])
    tail = F.concat(_part(";", r["params"]), _part("?", r["query"]), _part("#", r["fragment"]))
    # href without path and params: base path and params, href query else base query
    no_path = F.concat(
        prefix, b["path"], _part(";", b["params"]),
        F.when(r["query"] != "", F.concat(F.lit("?"), r["query"])).otherwise(_part("?", b["query"])),
        _part("#", r["fragment"]))
    network = F.concat(b["scheme"], F.lit("://"), r["netloc"], r["path"], tail)
    path = F.when(joined == "", F.lit("/")) \
        .when(~joined.startswith("/"), F.concat(F.lit("/"), joined)).otherwise(joined)
    with_path = F.concat(prefix, path, tail)
    # urljoin returns the other argument untouched when one is empty, and the
    # href untouched under another scheme; an href of blanks only is not empty
    return (F.when(b["raw"] == "", h["orig"])
            .when(h["orig"] == "", b["orig"])
            .when((h["scheme"] != "") & (h["scheme"] != b["scheme"]), h["orig"])
            .when(r["has_net"] & (r["netloc"] != ""), network)
            .when((r["path"] == "") & (r["params"] == ""), no_path)
            .otherwise(with_path))


BASE_PARTS = ("orig", "raw", "scheme", "netloc", "path", "params", "query", "dir")


def url_resolve(base, href) -> Column:
    """``urljoin(base, href)`` for hierarchical bases (http, https, ...).

    Cases: empty href -> base; href with another scheme (``mailto:``,
    ``javascript:``) -> href; ``//host/x`` -> base scheme + href; path-less
    href (``?q``, ``#f``) -> base path with new query/fragment; ``/x`` and
    relative paths -> merged with the base directory, dot segments removed.

    The base parts are bound once (``let``) and the href goes through the
    same staged resolution as ``resolve_all``. For the many hrefs of a page
    use ``with_base_parts`` + ``resolve_all`` (base split once per page).
    """
    parts = _base_parts(clean_url(base), col_of(base))
    packed = F.struct(*[parts[k].alias(k) for k in BASE_PARTS])
    return let(packed, lambda b: F.try_element_at(
        _resolve_array(F.array(col_of(href)), {k: b[k] for k in BASE_PARTS}), F.lit(1))["url"])


BASE_PREFIX = "_rb_"


def with_base_parts(df: DataFrame, base: str, prefix: str = BASE_PREFIX) -> DataFrame:
    """Add the parts of ``base`` as columns (once per page, before its hrefs are exploded)."""
    df = df.withColumn(prefix + "orig", F.col(base)).withColumn(prefix + "raw", clean_url(base))
    for name, c in _base_parts(F.col(prefix + "raw"), F.col(prefix + "orig")).items():
        if name not in ("raw", "orig"):
            df = df.withColumn(prefix + name, c)
    return df


def resolve_all(hrefs: Column, prefix: str = BASE_PREFIX) -> Column:
    """P3 over an array of hrefs of one page: ``array<struct<href, url>>``.

    The base parts are the ``with_base_parts`` columns. Exploding the result
    makes ``url`` an output of the generator: a later filter or join key on
    ``url`` cannot be rewritten into a copy of this expression below it.
    """
    return _resolve_array(hrefs, {k: F.col(prefix + k) for k in BASE_PARTS})


def _resolve_array(hrefs: Column, b: dict[str, Column]) -> Column:
    """Each stage is one ``transform`` adding the parts of every href as
    struct fields, so each part is computed once."""
    def keep(x, names):
        return [x[k].alias(k) for k in names]

    s1 = F.transform(hrefs, lambda h: F.struct(h.alias("orig"), clean_url(h).alias("raw")))
    s2 = F.transform(s1, lambda x: F.struct(*keep(x, ("orig", "raw")), url_scheme(x["raw"]).alias("scheme")))
    s3 = F.transform(s2, lambda x: F.struct(
        *keep(x, ("orig", "raw", "scheme")), _href_parts(x["raw"], b["scheme"])["rest"].alias("rest")))
    s4 = F.transform(s3, lambda x: F.struct(
        *keep(x, ("orig", "raw", "scheme", "rest")), *[c.alias(k) for k, c in _net_parts(x["rest"]).items()]))
    s5 = F.transform(s4, lambda x: F.struct(
        *keep(x, ("orig", "raw", "scheme", "rest", "has_net", "netloc")),
        *[c.alias(k) for k, c in _rest_parts(x["after"]).items()]))
    names = ("orig", "raw", "scheme", "rest", "has_net", "netloc", "path", "params", "query", "fragment")
    s6 = F.transform(s5, lambda x: F.struct(*keep(x, names), _joined_path(b, {"path": x["path"]}).alias("joined")))
    return F.transform(s6, lambda x: F.struct(
        x["orig"].alias("href"),
        _join(b, {k: x[k] for k in ("orig", "raw", "scheme", "rest")},
              {k: x[k] for k in ("has_net", "netloc", "path", "params", "query", "fragment")},
              x["joined"]).alias("url")))


def robots_url(site) -> Column:
    """P10: ``urljoin(site, 'robots.txt')``."""
    return url_resolve(site, F.lit(ROBOTS_FILE))


def sitemap_urls(site) -> Column:
    """P10: the two sitemap locations tried, in order."""
    return F.array(*[url_resolve(site, F.lit(name)) for name in SITEMAP_FILES])


def cdx_time(ts14) -> Column:
    """``yyyyMMddHHmmss`` -> timestamp (NULL when malformed)."""
    return F.try_to_timestamp(col_of(ts14), F.lit("yyyyMMddHHmmss"))


def urlkey_host(urlkey) -> Column:
    """SURT key ``com,example)/x`` -> ``example.com``; NULL for ``urn:`` keys."""
    k = col_of(urlkey)
    host = F.array_join(F.reverse(F.split(F.split_part(k, F.lit(")"), F.lit(1)), ",")), ".")
    return F.when(~k.startswith("urn:") & k.contains(")"), host)


def is_crawlable(url) -> Column:
    """the crawler takes http:// and https:// URLs only."""
    return F.coalesce(col_of(url).rlike("^https?://"), F.lit(False))
