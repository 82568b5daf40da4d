"""URL functions against the standard library (urljoin / urlsplit / urlparse)."""

import hashlib
import random
from urllib.parse import unquote, urljoin, urlparse, urlsplit

from pyspark.sql import functions as F

from newsarc.functions import urls as U

BASES = [
    "http://a.com/b/c/d;p?q#f",
    "https://www.example-news.com/",
    "https://m.site.example.net/en/25#top",
    "http://ththre.example.com/fr/825?page=2&ref=x",
    "http://h.org",
    "http://h.org/dir/",
]
HREFS = [
    "", "#x", "?q", "?", "/x", "x", "x/", "./x", "../x", "../../x", "../../../x", "/a/../b",
    "/..", ".", "..", "g;x?y#s", "//other.com/p", "https://z.org/a?b", "http:rel", "mailto:a@b.c",
    "javascript:void(0)", "/a//b", "a//b", "/osóciónta", "/no.", "  /lead", "/t\tab", "HTTPS://UP.com/X",
]


def py_valid(u):
    try:
        r = urlsplit(u)
        return bool(r.scheme and r.netloc)
    except ValueError:
        return False


def py_domain(u):
    d = urlparse(unquote(u)).netloc.split("&")[0].split("?")[0]
    d = d[4:] if d.startswith("www.") else d
    return d or None


def py_segments(u):
    return [s for s in urlparse(u).path.split("/") if s]


def test_url_resolve_matches_urljoin(spark):
    rows = [(b, h) for b in BASES for h in HREFS]
    df = spark.createDataFrame(rows, "base string, href string")
    got = df.select("base", "href", U.url_resolve("base", "href").alias("r")).collect()
    bad = [(r.base, r.href, r.r, urljoin(r.base, r.href)) for r in got
           if r.r != urljoin(r.base, r.href)]
    assert not bad, bad[:10]


def test_validity_domain_segments(spark):
    urls = [urljoin(b, h) for b in BASES for h in HREFS] + [
        "notaurl", "http://", "http://[::1", "http://[::1]/x", "http://[v1.x]/", "http://[1.2.3.4]/", "http://a b.com/x y", "ftp://x.org/a|b",
        "http://www.%61dn.com/x", "http://u:p@host:8080/a/b-c", "//h/x", "http://a.com/x;p",
        "http://a.com/a/b/c/d", "", "http://a.com&x=1/y",
    ]
    rnd = random.Random(7)
    alphabet = "ab/.-_?#:%&;w"
    for _ in range(300):
        urls.append("http://" + "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 16))))
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = df.select("u", U.is_valid_url("u").alias("v"), U.domain("u").alias("d"),
                    U.path_segments("u").alias("s")).collect()
    for r in got:
        assert r.v == py_valid(r.u), r.u
        if r.v:
            assert r.d == py_domain(r.u), r.u
            assert list(r.s) == py_segments(r.u), r.u


def test_small_helpers(spark):
    df = spark.createDataFrame([("http://www.example-news.com/",)], "u string")
    r = df.select(U.url_hash("u").alias("h"), U.normalize_url(F.lit("HTTP://A.com/X//")).alias("n"),
                  U.robots_url("u").alias("r"), U.sitemap_urls("u").alias("s"),
                  U.urlkey_host(F.lit("com,example-news)/x")).alias("k"),
                  U.urlkey_host(F.lit("urn:pageinfo:x")).alias("k2"),
                  U.cdx_time(F.lit("20250317150335")).alias("t"),
                  U.archive_path(F.lit("AK"), F.to_timestamp(F.lit("2025-03-07 10:00:00")), "u").alias("p"),
                  ).first()
    assert r.h == hashlib.md5(b"http://www.example-news.com/").hexdigest()
    assert r.n == "http://a.com/x"
    assert r.r == "http://www.example-news.com/robots.txt"
    assert list(r.s) == ["http://www.example-news.com/sitemap.xml", "http://www.example-news.com/sitemap_index.xml"]
    assert r.k == "example-news.com" and r.k2 is None
    assert str(r.t) == "2025-03-17 15:03:35"
    assert r.p == "news/AK/2025/3/7/" + r.h


def test_resolve_all_matches_urljoin(spark):
    df = spark.createDataFrame([(b, HREFS) for b in BASES], "base string, hrefs array<string>")
    df = U.with_base_parts(df, "base")
    got = df.select("base", F.posexplode(U.resolve_all(F.col("hrefs"))).alias("pos", "l")) \
        .select("base", "l.href", "l.url").collect()
    assert len(got) == len(BASES) * len(HREFS)
    bad = [(r.base, r.href, r.url, urljoin(r.base, r.href)) for r in got if r.url != urljoin(r.base, r.href)]
    assert not bad, bad[:10]
