"""Property-based second opinion: generated bases and hrefs against urljoin / urlsplit."""

from urllib.parse import urljoin, urlsplit

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsarc.functions import urls as U

SEG = st.text(alphabet="abc-_.%~;=", min_size=0, max_size=6)
PATH = st.lists(st.one_of(SEG, st.sampled_from([".", ".."])), min_size=0, max_size=5).map("/".join)
QUERY = st.one_of(st.just(""), st.text(alphabet="a=&b?/", max_size=6).map(lambda q: "?" + q))
FRAG = st.one_of(st.just(""), st.text(alphabet="ab#/", max_size=4).map(lambda f: "#" + f))
HOST = st.sampled_from(["a.com", "www.b.org", "c.net:8080", "u@d.io"])
BASE = st.builds(lambda s, h, p, q, f: f"{s}://{h}/{p}{q}{f}", st.sampled_from(["http", "https"]), HOST, PATH,
                 QUERY, FRAG)
HREF = st.one_of(
    st.builds(lambda p, q, f: p + q + f, PATH, QUERY, FRAG),                       # relative
    st.builds(lambda p, q, f: "/" + p + q + f, PATH, QUERY, FRAG),                 # absolute path
    st.builds(lambda h, p: f"//{h}/{p}", HOST, PATH),                             # network path
    st.builds(lambda s, h, p: f"{s}://{h}/{p}", st.sampled_from(["http", "HTTPS", "ftp"]), HOST, PATH),
    st.sampled_from(["", " ", "#", "?", "mailto:x@y", "javascript:void(0)", "http:rel", "  /lead"]),
    QUERY, FRAG)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(BASE, HREF), min_size=60, max_size=60))
def test_resolve_property(spark, pairs):
    df = spark.createDataFrame(pairs, "base string, href string")
    got = df.select("base", "href", U.url_resolve("base", "href").alias("r")).collect()
    bad = [(r.base, r.href, r.r, urljoin(r.base, r.href)) for r in got if r.r != urljoin(r.base, r.href)]
    assert not bad, bad[:5]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(BASE, HREF), min_size=60, max_size=60))
def test_validity_property(spark, pairs):
    urls = [urljoin(b, h) for b, h in pairs] + [h for _, h in pairs]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    for r in df.select("u", U.is_valid_url("u").alias("v"), U.path_segments("u").alias("s")).collect():
        try:
            parts = urlsplit(r.u)
            want = bool(parts.scheme and parts.netloc)
        except ValueError:
            want = False
        assert r.v == want, r.u
