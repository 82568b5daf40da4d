"""Operators on hand-made rows: examples of the report, odd rows, brute force for the ordered helpers."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from newsarc.functions.content import html_text, publication_time, word_count
from newsarc.functions.records import archive_outcome, status_class
from newsarc.operators import aggregates as A
from newsarc.operators import filters as FL
from newsarc.operators import generators as G
from newsarc.operators import joins as J
from newsarc.operators import ordered as O
from newsarc.operators import sets as S
from newsarc.operators import windows as W
from newsarc.plans import jobs as E


def _one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


def test_article_rules_readme_examples(spark):
    cases = [  # url, base, last_segment, depth3
        ("https://example.com/", False, False, False),
        ("https://example.com/foo", False, False, False),
        ("https://example.com/foo/bar", False, False, False),
        ("http://radio.example.org/post/council-votes-on-new-budget", True, True, False),
        ("https://example.com/this-is-a-page", True, True, False),
        ("https://example.com/a/b/c", True, False, True),
        ("https://example.com/news/12345", False, True, False),
        ("https://example.com/news-x/foo", True, False, False),
        ("https://example.com/a/b/c-d.html", True, True, True),
        ("mailto:x@y.z", False, False, False),
        ("javascript:void(0)", False, False, False),
        ("/relative/a-b", False, False, False),
    ]
    df = spark.createDataFrame([(c[0],) for c in cases], "url string")
    got = {r.url: (r.b, r.l, r.d) for r in df.select(
        "url", FL.article_flag("url", "base").alias("b"), FL.article_flag("url", "last_segment").alias("l"),
        FL.article_flag("url", "depth3").alias("d")).collect()}
    for u, b, l, d in cases:
        assert got[u] == (b, l, d), u
    home = spark.createDataFrame([("https://x.com/news/", "https://x.com/news/"),
                                  ("https://x.com/news/", "https://x.com/news-a"),
                                  ("https://x.com/", "http://x.com/")], "website string, url string")
    assert [r.f for r in home.select(FL.article_flag("url", "not_home", "website").alias("f")).collect()] \
        == [False, True, False]


def test_scope_and_seed_types(spark):
    rows = [("https://news-example.org/local/", "https://news-example.org/news-report.html", False),
            ("https://news-example.org/local/", "https://news-example.org/local/local-news-report.html", True),
            ("https://news-example.org/local", "https://news-example.org/news-report.html", True),
            ("https://news-example.org/local", "https://news-example.org/local/local-news-report.html", True),
            ("https://news-example.org/local/", "http://news-example.org/local/x", True),
            ("https://news-example.org/local/", "https://other.org/local/x", False),
            ("https://news-example.org/local/", "ftp://news-example.org/local/x", False)]
    df = spark.createDataFrame(rows, "seed_url string, url string, want boolean")
    for r in df.select("want", FL.in_scope_flag("url", "seed_url").alias("got")).collect():
        assert r.got == r.want
    scopes = spark.createDataFrame([("https://news-example.org/local/", ["^https://cdn\\.x/"], ["\\.pdf$"])],
                                   "seed_url string, include array<string>, exclude array<string>")
    extra = spark.createDataFrame([("https://news-example.org/local/", "https://cdn.x/a.js"),
                                   ("https://news-example.org/local/", "https://news-example.org/local/a.pdf")],
                                  "seed_url string, url string")
    assert [r.url for r in FL.in_scope(extra, scopes).collect()] == ["https://cdn.x/a.js"]
    st = spark.createDataFrame([(0, True, 0), (1, True, 0), (2, False, 1), (1, False, 1)],
                               "depth int, s boolean, hops int")
    got = {k: [r.f for r in st.select(FL.seed_type_flag(k, "depth", "s", "hops").alias("f")).collect()]
           for k in FL.SEED_TYPES}
    assert got == {"standard": [True, True, False, False], "standard_plus": [True, True, True, True],
                   "one_page": [True, False, False, False], "one_page_plus": [True, True, False, True]}


def test_feed_discovery_robots_sitemaps_entries(spark):
    heads = [
        ("https://a.com/", '<head><link rel="alternate" type="application/atom+xml" href="/atom.xml">'
                           '<link type="application/rss+xml" href="/rss.xml"></head>'),
        ("https://b.com/x/", "<link type='application/rss+xml'><link type=text/xml href=feed.xml>"),
        ("https://c.com/", '<LINK TYPE="APPLICATION/RSS+XML" HREF="/up.xml">'),
        ("https://d.com/", "<p>no feed</p>"),
    ]
    df = spark.createDataFrame(heads, "final_url string, body string").withColumn("url", F.col("final_url"))
    got = {r.url: r.feed for r in G.discover_feeds(df).collect()}
    assert got == {"https://a.com/": "https://a.com/rss.xml", "https://b.com/x/": "https://b.com/x/feed.xml"}
    assert {r.feed for r in G.discover_feeds(df, raw=True).collect()} == {"/rss.xml", "feed.xml"}

    robots = spark.createDataFrame(
        [("r1", "User-agent: *\r\nSITEMAP: https://a.com/s1.xml\r\nSitemap:https://a.com/s2.xml \r\nDisallow: /x"),
         ("r2", "User-agent: *\nDisallow: /")], "url string, body string")
    assert [r.sitemap for r in G.robots_sitemaps(robots).orderBy("pos").collect()] == \
        ["https://a.com/s1.xml", "https://a.com/s2.xml"]

    smap = spark.createDataFrame(
        [("s1", '<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'
                "<url><loc> https://a.com/rss </loc></url><url><loc>https://a.com/feed/x</loc></url>"
                "<url><loc>https://a.com/RSS</loc></url><url><loc>https://a.com/page</loc></url></urlset>"),
         ("s2", "<urlset><url><loc>https://b.com/feed</loc></url><url><loc>broken")], "url string, body string")
    locs = G.sitemap_locs(smap)
    assert FL.feed_like(locs).select("loc").orderBy("loc").rdd.map(lambda r: r.loc).collect() == \
        ["https://a.com/feed/x", "https://a.com/rss", "https://b.com/feed"]

    feed = spark.createDataFrame([
        ("f1", "<rss><channel><item><title>a</title><link>https://a.com/1</link>"
               "<pubDate>Mon, 17 Mar 2025 15:03:35 GMT</pubDate></item>"
               "<item><link>https://a.com/2?a=1&amp;b=2</link><pubDate>Mon, 17 Mar 2025 15:03:35 +0500</pubDate></item>"
               "<item><link>https://a.com/3</link><pubDate>Mon, 17 Mar 2025 15:03:35 EST</pubDate></item>"
               "<item><link>https://a.com/4</link></item></channel></rss>"),
        ("f2", '<feed xmlns="http://www.w3.org/2005/Atom"><entry><link href="https://b.com/1"/>'
               "<published>2025-03-17T15:03:35Z</published></entry></feed>"),
        ("f3", "<rss><channel><item><link>https://c.com/1</link>"), ("f4", "<rss><channel></channel></rss>")],
        "url string, body string")
    fallback = dt.datetime(2025, 3, 18)
    ents = G.feed_entries(feed).withColumn("t", publication_time("published", F.lit(fallback)))
    got = {r.link: r.t for r in ents.collect()}
    assert got == {"https://a.com/1": dt.datetime(2025, 3, 17, 15, 3, 35),
                   "https://a.com/2?a=1&b=2": dt.datetime(2025, 3, 17, 10, 3, 35),
                   "https://a.com/3": dt.datetime(2025, 3, 17, 20, 3, 35),
                   "https://a.com/4": fallback,
                   "https://b.com/1": dt.datetime(2025, 3, 17, 15, 3, 35)}


def test_text_outcome_status(spark):
    html = ("<html><head><title>T</title><script>var a='<p>';</script></head><body><!-- c -->"
            "<p>One&nbsp;two &amp; three</p><style>p{}</style><p>four</p></body></html>")
    t = _one(spark, html_text(F.lit(html)))
    assert t == "One two & three four"
    assert _one(spark, word_count(F.lit(t))) == 5 and _one(spark, word_count(F.lit(""))) == 0
    outs = spark.createDataFrame([("https://web.archive.org/web/1/x",), ("Error",), ("520 Server Error: x",), (None,)],
                                 "o string").select(archive_outcome("o").alias("r")).collect()
    assert [(r.r.status, r.r.retryable, r.r.archive_url) for r in outs] == [
        ("archived", False, "https://web.archive.org/web/1/x"), ("failed", False, None),
        ("failed", True, None), ("failed", False, None)]
    codes = spark.createDataFrame([(None,), (200,), (204,), (301,), (404,)], "c int")
    assert [r.s for r in codes.select(status_class("c").alias("s")).collect()] == [None, "2xx", "2xx", "other", "other"]


def test_registry_joins_and_rollups(spark):
    outlets = spark.createDataFrame(
        [("AK", "newspaper", "https://a.com/", None), ("AK", "tv", "https://b.com/", ["https://b.com/rss"]),
         ("VA", "newspaper", "https://c.com/", []), ("VA", "radio", None, None)],
        "state string, media string, website string, rss array<string>")
    fetches = spark.createDataFrame(
        [("https://a.com/", None, 301, dt.datetime(2025, 1, 1), None),
         ("https://a.com/", "https://a.com/", 200, dt.datetime(2025, 1, 2),
          '<link type="application/rss+xml" href="/feed.xml">'),
         ("https://b.com/", "https://b.com/", None, dt.datetime(2025, 1, 2), None),
         ("https://c.com/", "https://c.com/", 204, dt.datetime(2025, 1, 2), "<p>x</p>"),
         ("https://c.com/sitemap.xml", None, 404, dt.datetime(2025, 1, 2), None),
         ("https://c.com/sitemap_index.xml", None, 404, dt.datetime(2025, 1, 2), None),
         ("https://c.com/robots.txt", None, 200, dt.datetime(2025, 1, 2), "Sitemap: https://c.com/sm.xml"),
         ("https://c.com/sm.xml", None, 200, dt.datetime(2025, 1, 2),
          "<urlset><url><loc>https://c.com/feed/news</loc></url><url><loc>https://c.com/x</loc></url></urlset>")],
        "url string, final_url string, status int, fetched_at timestamp, body string")
    st = {r.website: r.website_status for r in J.attach_status(outlets, fetches).collect()}
    assert st == {"https://a.com/": 200, "https://b.com/": None, "https://c.com/": 204, None: None}
    enriched = {r.website: r.rss for r in E.enrich_registry(outlets, fetches).collect()}
    assert enriched["https://a.com/"] == ["https://a.com/feed.xml"]
    assert enriched["https://b.com/"] == ["https://b.com/rss"]
    assert enriched["https://c.com/"] == ["https://c.com/feed/news"]
    o2 = J.attach_status(outlets, fetches)
    assert {r.media: r.n_outlets for r in A.media_counts(o2).collect()} == \
        {"newspaper": 2, "tv": 1, "radio": 1, None: 4}
    cov = {(r.state, r.media): (r.n_outlets, r.n_alive, r.n_with_feed) for r in A.coverage(o2).collect()}
    assert cov[(None, None)] == (4, 2, 1) and cov[("AK", None)] == (2, 1, 1)
    assert [r.website for r in FL.exact_ok(o2).collect()] == ["https://a.com/"]
    assert sorted(r.seed_url for r in G.registry_seeds(spark.createDataFrame(
        [("https://a.com",), ("https://a.com/",), ("https://b.com//",)], "website string")).collect()) == \
        ["https://a.com/", "https://b.com/"]
    cands = spark.createDataFrame([("https://a.com/x",), ("https://www.c.com/y",), ("https://z.com/q",)], "url string")
    assert sorted(r.url for r in J.known_domain(cands, outlets).collect()) == ["https://a.com/x", "https://www.c.com/y"]
    red = spark.createDataFrame([("https://s/1",), ("https://a.com/",)], "url string")
    keep = {r.url: r.expanded_url for r in J.expand_urls(red, fetches).collect()}
    assert keep == {"https://s/1": "https://s/1", "https://a.com/": "https://a.com/"}
    nul = {r.url: r.expanded_url for r in J.expand_urls(red, fetches, failed="null").collect()}
    assert nul["https://s/1"] is None


def _rand_events(n=600, seed=3):
    rnd = random.Random(seed)
    t0 = dt.datetime(2025, 3, 1)
    rows = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.4 else f"k{rnd.randint(0, 5)}"     # one key holds ~40% of rows
        rows.append((i, key, t0 + dt.timedelta(minutes=rnd.randint(0, 6000)), rnd.choice("abc"), rnd.randint(1, 9)))
    return rows


def test_ordered_helpers_match_brute_force(spark):
    rows = _rand_events()
    df = spark.createDataFrame(rows, "id long, urlkey string, ts timestamp, digest string, length long")
    pdf = pd.DataFrame(rows, columns=["id", "urlkey", "ts", "digest", "length"]).sort_values(["urlkey", "ts", "id"])
    pdf["prev"] = pdf.groupby("urlkey")["digest"].shift(1)
    pdf["cum"] = pdf.groupby("urlkey")["length"].cumsum()
    got = {r.id: r.prev_digest for r in W.capture_changes(df, "urlkey", "ts", "digest", "id").collect()}
    assert all(got[i] == (None if pd.isna(p) else p) for i, p in zip(pdf["id"], pdf["prev"]))
    prog = {r.id: r.cum_bytes for r in W.crawl_progress(df, "urlkey", "ts", "length", "id").collect()}
    assert all(prog[i] == c for i, c in zip(pdf["id"], pdf["cum"]))

    req = df.filter(F.col("digest") == "a").select("id", "urlkey", "ts")
    caps = df.filter(F.col("digest") != "a").select("urlkey", "ts", "digest", F.col("id").alias("cid"))
    got = {r.id: (r.capture.cid if r.capture else None)
           for r in J.capture_as_of(req, caps, "urlkey", "ts", ("ts", "cid")).collect()}
    for _, r in pdf[pdf.digest == "a"].iterrows():
        prior = pdf[(pdf.urlkey == r.urlkey) & (pdf.digest != "a") & (pdf.ts <= r.ts)]
        want = None if prior.empty else prior.sort_values(["ts", "id"]).iloc[-1]["id"]
        if want is None:
            assert got[r.id] is None
        else:
            assert pdf.set_index("id").loc[got[r.id], "ts"] == pdf.set_index("id").loc[want, "ts"]

    rn = O.ranked_by_range(df, ["id"], ["urlkey"])
    for key, g in pd.DataFrame([r.asDict() for r in rn.select("urlkey", "id", "rn").collect()]).groupby("urlkey"):
        assert list(g.sort_values("id")["rn"]) == list(range(1, len(g) + 1))


def test_locate_block_brute_force(spark):
    rnd = random.Random(5)
    starts = sorted({"".join(rnd.choice("abcdef,)") for _ in range(rnd.randint(2, 6))) for _ in range(40)})
    blocks = spark.createDataFrame([("idx", s, i * 10, 10) for i, s in enumerate(starts)],
                                   "filename string, urlkey_from string, offset long, length long")
    keys = ["".join(rnd.choice("abcdef,)") for _ in range(rnd.randint(1, 7))) for _ in range(300)]
    kdf = spark.createDataFrame([(k,) for k in keys], "urlkey string")
    got = {r.urlkey: (r.block.urlkey_from if r.block else None) for r in J.locate_block(kdf, blocks).collect()}
    for k in keys:
        le = [s for s in starts if s <= k]
        assert got[k] == (le[-1] if le else None), k


def test_sets_caps_quota(spark):
    links = spark.createDataFrame(
        [("h", "https://a/X", 2, 0), ("h", "https://a/x/", 1, 3), ("h", "https://a/x/", 1, 1), ("h", "https://a/y", 1, 2)],
        "website_hash string, url string, page_id long, pos int")
    d = {r.url: (r.page_id, r.pos) for r in S.distinct_links(links).collect()}
    assert d == {"https://a/X": (2, 0), "https://a/x/": (1, 1), "https://a/y": (1, 2)}
    n = {r.norm_url: (r.url, r.n_variants) for r in S.dedup_normalized(links.distinct(), "url").collect()}
    assert n["https://a/x"] == ("https://a/X", 3)
    today = links.filter("page_id = 2").select("url")
    before = links.filter("page_id = 1").select("url")
    assert S.new_urls(today, before).count() == 1 and S.kept_urls(before, before).count() == 2

    cands = spark.createDataFrame(
        [("h", f"u{i}", 0 if i < 9 else 1, i, 0) for i in range(14)] + [("g", f"v{i}", 1, i, 0) for i in range(3)],
        "website_hash string, url string, origin int, feed_pos long, entry_pos int")
    c5 = W.cap_per_site(cands, 5)
    assert sorted((r.website_hash, r.rank) for r in c5.collect()) == \
        sorted([("h", i) for i in range(1, 6)] + [("g", i) for i in range(1, 4)])
    c11 = {r.url for r in W.cap_first_version(cands, 11, 10).collect() if r.website_hash == "h"}
    assert c11 == {f"u{i}" for i in range(11)}           # 9 feed links < 10: home page links fill to 11
    many = cands.withColumn("origin", F.lit(0))
    assert W.cap_first_version(many, 11, 10).filter("website_hash = 'h'").count() == 11

    q = W.daily_quota(W.cap_per_site(cands, 5).withColumn("day", F.lit("2025-03-17")), n=3)
    rows = sorted((r.quota_rank, r.website_hash, r.rank, r.day_offset) for r in q.collect())
    assert [x[0] for x in rows] == list(range(1, 9))
    assert [(x[1], x[2]) for x in rows[:4]] == [("g", 1), ("h", 1), ("g", 2), ("h", 2)]
    assert [x[3] for x in rows] == [0, 0, 0, 1, 1, 1, 2, 2]
    assert W.top_n(links, "page_id", 1, "url").first().url == "https://a/X"


def test_dedup_duplicates_and_reports(spark):
    caps = spark.createDataFrame(
        [("c1", "https://a.com/x", dt.datetime(2025, 3, 17, 1), "d1", 10, 200, "text/html", None),
         ("c1", "https://a.com/y", dt.datetime(2025, 3, 17, 2), "d1", 10, 200, "text/html", None),
         ("c1", "https://img.a.com/i.jpg", dt.datetime(2025, 3, 18, 1), "d2", 5, 404, None, "https://a.com/x"),
         ("c2", "https://a.com/robots.txt", dt.datetime(2025, 3, 18, 2), "d3", 1, 404, "text/plain", None)],
        "collection string, url string, ts timestamp, digest string, length long, status int, mime string, referrer string")
    assert {r.digest: r.url for r in S.dedup_content(caps).collect()}["d1"] == "https://a.com/x"
    ds = A.duplicate_share(caps).first()
    assert (ds.captures, ds.distinct_digests, ds.duplicate_captures, ds.bytes, ds.duplicate_bytes) == (4, 3, 1, 26, 10)
    assert A.duplicate_share(caps, approx=True).first().distinct_digests == 3
    assert {r.host: r.documents for r in A.host_report(caps).collect()} == {"a.com": 3, "img.a.com": 1}
    assert {r.file_type: r.bytes for r in A.file_type_report(caps).collect()}["unknown"] == 5
    pages = spark.createDataFrame([("c1", "https://a.com/x", True), ("c2", "https://b.com/", True)],
                                  "collection string, url string, seed boolean")
    m = {r.collection: (r.documents, r.client_errors, r.robots_fail, r.seeds) for r in A.seed_metrics(caps, pages).collect()}
    assert m == {"c1": (3, 1, 0, 1), "c2": (1, 1, 1, 1)}
    du = {(str(r.day), r.collection): r.bytes for r in A.daily_usage(caps, budget_bytes=100).collect()}
    assert du[("2025-03-17", "c1")] == 20
    res = {r.url: r.page_mime for r in J.page_resources(caps).collect()}
    assert res["https://img.a.com/i.jpg"] == "text/html" and res["https://a.com/x"] is None
    pc = J.page_captures(pages.withColumn("status", F.lit(1)).withColumn("mime", F.lit("m")), caps)
    assert {(r.url, r.digest) for r in pc.collect()} == {("https://a.com/x", "d1"), ("https://b.com/", None)}
    assert {r.status: r.captures for r in A.status_report(caps).collect()} == {200: 2, 404: 2}
    log = spark.createDataFrame(
        [("c1", "p1", dt.datetime(2025, 3, 17, 1, 0, 0), "info", "worker", "Awaiting page load"),
         ("c1", "p1", dt.datetime(2025, 3, 17, 1, 0, 30), "info", "pageStatus", "Page Finished"),
         ("c1", None, dt.datetime(2025, 3, 17, 1, 1, 0), "error", "general", "x")],
        "collection string, page string, timestamp timestamp, logLevel string, context string, message string")
    assert W.page_durations(log).first().seconds == 30.0
    summ = {(r.logLevel, r.context, r.message): r.rows for r in A.log_summary(log).collect()}
    assert summ[(None, None, None)] == 3 and summ[("info", None, None)] == 2
    outs = spark.createDataFrame([("h", "https://w/1"), ("h", "520 Server Error"), ("g", "Error")],
                                 "website_hash string, output string")
    oc = {r.website_hash: (r.found, r.archived, r.failed, r.server_errors) for r in A.archive_outcomes(outs).collect()}
    assert oc == {"h": (2, 1, 1, 1), "g": (1, 0, 1, 0)}


def test_collect_and_filter_jobs(spark):
    outlets = spark.createDataFrame(
        [("AK", "newspaper", "https://a.com/", ["https://a.com/rss"], 200),
         ("AK", "newspaper", "https://b.com/", None, 200), ("AK", "tv", "https://c.com/", None, 500)],
        "state string, media string, website string, rss array<string>, website_status int")
    words = " ".join(["word"] * 25)
    feed = "<rss><channel>" + "".join(
        f"<item><link>https://a.com/news/story-{i}</link><pubDate>Mon, 17 Mar 2025 0{i}:00:00 GMT</pubDate></item>"
        for i in range(7)) + "</channel></rss>"
    rows = [("https://a.com/rss", None, 200, dt.datetime(2025, 3, 17, 12), feed),
            ("https://b.com/", None, 200, dt.datetime(2025, 3, 17, 12),
             '<a href="/x-y">1</a><a href="/about">2</a><a href="https://b.com/2025/03/17/z">3</a><a href="/short-1">4</a>')]
    rows += [(f"https://a.com/news/story-{i}", None, 200, dt.datetime(2025, 3, 17, 12), f"<p>{words}</p>")
             for i in range(7)]
    rows += [("https://b.com/x-y", None, 200, dt.datetime(2025, 3, 17, 12), f"<p>{words}</p>"),
             ("https://b.com/2025/03/17/z", None, 200, dt.datetime(2025, 3, 17, 12), f"<p>{words}</p>"),
             ("https://b.com/short-1", None, 200, dt.datetime(2025, 3, 17, 12), "<p>too short</p>")]
    fetches = spark.createDataFrame(rows, "url string, final_url string, status int, fetched_at timestamp, body string")
    arch = spark.createDataFrame(
        [(u, ("520 Server Error" if u.endswith("story-1") else f"https://web.archive.org/web/1/{u}"),
          dt.datetime(2025, 3, 17, 13))
         for u in [f"https://a.com/news/story-{i}" for i in range(7)] + ["https://b.com/x-y", "https://b.com/2025/03/17/z"]],
        "url string, output string, called_at timestamp")
    seen = spark.createDataFrame([], "website_hash string, url string")
    arts, new_seen = E.collect_articles(outlets, fetches, arch, "2025-03-17 14:00:00", seen=seen)
    got = sorted((r.website, r.link) for r in arts.collect())
    assert got == sorted([("https://a.com/", f"https://a.com/news/story-{i}") for i in (0, 2, 3, 4, 5)]
                         + [("https://b.com/", "https://b.com/2025/03/17/z"), ("https://b.com/", "https://b.com/x-y")])
    first = arts.filter(F.col("link").endswith("story-0")).first()
    assert first.publication_date == dt.datetime(2025, 3, 17, 0, 0) and (first.year, first.month, first.day) == (2025, 3, 17)
    assert new_seen.count() == 7
    again, _ = E.collect_articles(outlets, fetches, arch, "2025-03-17 15:00:00", seen=new_seen)
    # round two: the five archived links are seen, story-1 fails again, story-6 (over the cap before) is taken
    assert [r.link for r in again.filter(F.col("website") == "https://a.com/").collect()] == \
        ["https://a.com/news/story-6"]
    links = spark.createDataFrame([("https://b.com/x-y",), ("https://B.com/x-y/",), ("https://b.com/short-1",),
                                   ("https://q.com/a-b",)], "url string")
    kept = [r.norm_url for r in E.article_filter(links, fetches, outlets).collect()]
    assert kept == ["https://b.com/x-y"]


def test_feed_for_outlet_chain(spark):
    outlets = spark.createDataFrame(
        [("https://a/", ["https://a/own"]), ("https://b/", []), ("https://c/", None), ("https://d/", None)],
        "website string, rss array<string>")
    html = spark.createDataFrame([("https://b/", "https://b/feed"), ("https://a/", "https://a/other")],
                                 "website string, feed string")
    smap = spark.createDataFrame([("https://b/", "https://b/rss2"), ("https://c/", "https://c/rss"),
                                  ("https://c/", "https://c/feed")], "website string, feed string")
    got = sorted((r.website, r.feed) for r in J.feed_for_outlet(outlets, html, smap).collect())
    assert got == [("https://a/", "https://a/own"), ("https://b/", "https://b/feed"),
                   ("https://c/", "https://c/feed"), ("https://c/", "https://c/rss")]


def test_sessions_brute_force(spark):
    rows = _rand_events(800, seed=11)
    df = spark.createDataFrame(rows, "id long, urlkey string, ts timestamp, digest string, length long")
    got = sorted((r.urlkey, r.session_start, r.events) for r in O.sessions(df, "urlkey", "ts", 3600, "id").collect())
    want = []
    pdf = pd.DataFrame(rows, columns=["id", "urlkey", "ts", "digest", "length"]).sort_values(["urlkey", "ts", "id"])
    for key, g in pdf.groupby("urlkey"):
        start, prev, n = None, None, 0
        for t in g["ts"]:
            if prev is None or (t - prev).total_seconds() >= 3600:
                if start is not None:
                    want.append((key, start.to_pydatetime(), n))
                start, n = t, 0
            n += 1
            prev = t
        want.append((key, start.to_pydatetime(), n))
    assert got == sorted(want)


def test_hot_key_is_cut_into_balanced_ranges(spark):
    """One key with 40% of the rows: hash partitioning by key puts it in one task, ranges do not."""
    n = 20000
    df = spark.range(n).select(
        F.when(F.col("id") % 5 < 2, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string")))
        .alias("key"), F.col("id"))
    per_range = [r["count"] for r in O.ranged(df, ["key"], ["id"], 8).groupBy("_pid").count().collect()]
    assert sum(per_range) == n and max(per_range) < 2.0 * n / 8
    by_key = [r["count"] for r in df.repartition(8, "key").groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(by_key) >= 0.4 * n           # what a plain partitionBy(key) window would have to hold


def test_url_order_by_ranges(spark):
    rows = [(f"com,ex{i % 7})/p{i}", dt.datetime(2025, 3, 17) + dt.timedelta(minutes=i)) for i in range(200)]
    df = spark.createDataFrame(rows, "urlkey string, ts timestamp")
    parts = W.url_order(df, partitions=4).rdd.glom().collect()
    flat = [(r.urlkey, r.ts) for p in parts for r in p]
    assert flat == sorted(flat) and len(flat) == 200          # ranges in order, each sorted
    assert [(r.urlkey, r.ts) for r in W.url_order(df).collect()] == sorted(flat)


# ------------------------------------------------ real markup, scopes, null keys

def _page(spark, body):
    return spark.createDataFrame([("https://h.com/p/", "https://h.com/p/", body)], "url string, final_url string, body string")


def test_links_of_real_markup(spark):
    from newsarc.operators import generators as G
    body = """<a data-href="/wrong" href="/right">1</a><!-- <a href="/comment">2</a> -->
      <script>x = '<a href="/script">3</a>'</script><A title="a > b" HREF='/q?a=1&#38;b=2&amp;c=&#x41;'>4</A>
      <a href=plain>5</a><abbr href="/abbr">6</abbr><a name="x">7</a><a
      class="c"
      href="/lines">8</a>"""
    got = [r.href for r in G.extract_links(_page(spark, body), keep=("url",)).orderBy("pos").collect()]
    assert got == ["/right", "/q?a=1&b=2&c=A", "plain", "/lines"]


def test_feed_links_of_real_markup(spark):
    from newsarc.operators import generators as G
    body = """<link rel="stylesheet" data-type="application/rss+xml" href="/style.css">
      <!-- <link type="application/rss+xml" href="/old"> --><link title="x > y" href='/feed?a=1&amp;b=2' type='application/rss+xml'/>"""
    assert [r.feed for r in G.discover_feeds(_page(spark, body)).collect()] == ["https://h.com/feed?a=1&b=2"]


def test_sitemap_locations(spark):
    from newsarc.operators import generators as G
    body = "<url><loc> https://h/a?x=1&amp;y=2 </loc></url><loc><![CDATA[https://h/b?x&y]]></loc><!--<loc>no</loc>--><loc>https://h/c</loc>"
    got = [r["loc"] for r in G.sitemap_locs(_page(spark, body)).orderBy("pos").collect()]
    assert got == ["https://h/a?x=1&y=2", "https://h/b?x&y", "https://h/c"]


def test_feed_entries_as_feeds_write_them(spark):
    from newsarc.operators import generators as G
    body = """<rss><item><link><![CDATA[ https://h/1?a&b ]]></link><pubDate><![CDATA[Tue, 11 Jun 2024 08:00:00 GMT]]></pubDate></item>
      <item><title>none</title><link></link></item>
      <entry><link rel="self" href="https://h/self"/><link href="https://h/2?a=1&amp;b=2" rel="alternate"/>
        <updated>2024-06-12T00:00:00Z</updated><published>2024-06-11T00:00:00Z</published></entry>
      <entry><link rel="self" href="https://h/s3"/><updated>2024-06-13T00:00:00Z</updated></entry>
      <item><atom:link href="x"/><link>https://h/4&#38;z</link><dc:date>2024-06-14</dc:date></item></rss>"""
    got = [(r.entry_pos, r.link, r.published) for r in G.feed_entries(_page(spark, body)).orderBy("entry_pos").collect()]
    assert got == [(0, "https://h/1?a&b", "Tue, 11 Jun 2024 08:00:00 GMT"), (2, "https://h/2?a=1&b=2", "2024-06-11T00:00:00Z"),
                   (3, "https://h/s3", "2024-06-13T00:00:00Z"), (4, "https://h/4&z", "2024-06-14")]


def test_scope_of_odd_seeds(spark):
    from newsarc.operators import filters as FL
    cases = [("https://h.com", "https://other.org/x", False), ("https://h.com", "https://h.com/x", True),
             ("https://h.com", "http://h.com", True), ("https://h.com", "https://h.com.evil.org/", False),
             ("https://u:p@H.com:8080/a/b", "https://h.com:8080/a/c", True), ("https://h.com:8080/a/", "https://h.com/a/c", False),
             ("https://h.com/a/?q=/z/", "https://h.com/a/x", True), ("https://h.com/a/", "https://h.com/b", False),
             ("nothing", "https://h.com/b", False)]
    df = spark.createDataFrame(cases, "seed string, url string, want boolean")
    assert all(r.want == r.got for r in df.withColumn("got", FL.in_scope_flag("url", "seed")).collect())


def test_ordered_work_with_null_keys_equal_times_and_a_hot_key(spark):
    import random
    from pyspark.sql import Window
    rng = random.Random(4)
    rows = [(i, rng.choice([None, "hot", "hot", "hot", "a", "b"]), rng.choice([None, 1, 2, 3]), rng.randint(0, 40)) for i in range(700)]
    df = spark.createDataFrame(rows, "id long, k string, v int, t int")
    for n in (1, 3, 16):
        w = Window.partitionBy("k").orderBy("t", "id")
        want = sorted(df.withColumn("p", F.lag("v").over(w)).withColumn("had", F.row_number().over(w) > 1)
                      .withColumn("s", F.sum("id").over(w.rowsBetween(Window.unboundedPreceding, 0))).collect(), key=str)
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            got = O.previous_value(df, ["k"], ["t", "id"], "v", out="p", exists="had")
            got = O.running_sums(got, ["k"], ["t", "id"], {"s": "id"})
            assert sorted(got.select("id", "k", "v", "t", "p", "had", "s").collect(), key=str) == want
            facts = df.filter("id % 3 = 0").select("k", "t", "id")
            asked = df.filter("id % 3 = 1").select(F.col("id").alias("q"), "k", "t")
            near = {r.q: r.match for r in O.asof_by_range(asked, facts, ["k"], "t", "id").collect()}
            plain = {i: max(((t2, j) for j, k2, _, t2 in rows if j % 3 == 0 and k2 == k and t2 <= t), default=(0, None))[1]
                     for i, k, _, t in rows if i % 3 == 1}
            assert near == plain
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_changes_with_null_digests(spark):
    from newsarc.operators import windows as W
    df = spark.createDataFrame([(1, "u", None), (2, "u", None), (3, "u", "x"), (4, "u", None), (5, None, "y"), (6, None, "y")],
                               "ts int, urlkey string, digest string")
    got = {r.ts: r.change for r in W.capture_changes(df).collect()}
    assert got == {1: "first", 2: "unchanged", 3: "changed", 4: "changed", 5: "first", 6: "unchanged"}


def test_sessions_of_null_keys(spark):
    df = spark.createDataFrame([(None, dt.datetime(2024, 6, 11, h)) for h in (1, 5, 9)], "urlkey string, ts timestamp")
    assert sorted(r.events for r in O.sessions(df, "urlkey", "ts", 3600).collect()) == [1, 1, 1]


def test_each_visit_has_its_own_finish(spark):
    from newsarc.operators import windows as W
    t = dt.datetime(2024, 6, 11, 8)
    s = lambda n: t + dt.timedelta(seconds=n)
    log = spark.createDataFrame(
        [("c", "p", s(0), "Awaiting page load"), ("c", "p", s(10), "Page Finished"), ("c", "p", s(3600), "Awaiting page load"),
         ("c", "p", s(3605), "Page Finished"), ("c", "q", s(1), "Awaiting page load"), ("c", "r", s(2), "Page Finished")],
        "collection string, page string, timestamp timestamp, message string")
    got = sorted((r.page, r.visit, r.seconds) for r in W.page_durations(log).collect())
    assert got == [("p", 1, 10.0), ("p", 2, 5.0), ("q", 1, None)]


def test_seed_metrics_split_errors_and_flag_robots(spark):
    from newsarc.operators import aggregates as A
    caps = spark.createDataFrame(
        [("a", "https://a/robots.txt", 403, 1), ("a", "https://a/", 404, 2), ("a", "https://a/x", 503, 3),
         ("b", "https://b/robots.txt", 404, 1), ("b", "https://b/", 200, 5)], "collection string, url string, status int, length long")
    pages = spark.createDataFrame([("a", True), ("b", True)], "collection string, seed boolean")
    got = {r.collection: (r.client_errors, r.server_errors, r.robots_fail, r.robots_blocked) for r in A.seed_metrics(caps, pages).collect()}
    assert got == {"a": (2, 1, 1, True), "b": (1, 0, 1, False)}


def test_new_and_kept_over_a_history(spark):
    found = spark.createDataFrame([("s", "a", 1), ("s", "b", 1), ("s", "b", 3), ("s", "c", 3), ("s", "c", 3), ("t", "x", 2)],
                                  "website_hash string, url string, page_id long")
    assert sorted(tuple(r) for r in S.new_in_latest(found).collect()) == [("s", "c"), ("t", "x")]
    assert sorted(tuple(r) for r in S.kept_in_latest(found).collect()) == [("s", "b")]


def test_ranges_by_binary_search_equal_a_plain_count(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, "a", "b", "hot", "hot", "hot"]), rng.randrange(50), i) for i in range(700)]
    df = spark.createDataFrame(rows, "k string, t int, id long").repartition(3)
    for n in (1, 2, 7, 16, 33):
        got = O.ranged(df, ["k"], ["t", "id"], n).collect()
        key = lambda r: ((r.k is not None, r.k or ""), r.t, r.id)
        got.sort(key=key)
        assert [r["_pid"] for r in got] == sorted(r["_pid"] for r in got)      # ranges follow the order
        assert {r["_pid"] for r in got} <= set(range(n + 1))
        starts = {}
        for r in got:
            starts.setdefault(r["_pid"], r)
        borders = {r.k for p, r in starts.items() if p}     # a border is the first row of its range
        assert all(r["_edge"] == (r.k in borders) for r in got)


def test_visits_of_a_hot_page_are_counted_over_ranges(spark):
    rng = random.Random(6)
    t0 = dt.datetime(2025, 3, 17)
    msgs = ["Awaiting page load", "Page Finished", "other"]
    rows = [("c", rng.choice(["hot", "hot", "p1", None]), t0 + dt.timedelta(seconds=rng.randrange(300)), rng.choice(msgs))
            for _ in range(2000)]
    log = spark.createDataFrame(rows, "collection string, page string, timestamp timestamp, message string").repartition(4)
    pages = {}
    for _, page, t, m in rows:
        if page and m != "other":
            pages.setdefault(page, []).append((t, m == msgs[0]))
    want = []
    for page, events in pages.items():
        visits = []
        for t, start in sorted(events):
            if start:
                visits.append([t, None])
            elif visits and visits[-1][1] is None:
                visits[-1][1] = t
        want += [(page, i + 1, a, b) for i, (a, b) in enumerate(visits)]
    got = [(r.page, r.visit, r.started, r.finished) for r in W.page_durations(log).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len(want) > 300


@pytest.mark.parametrize("seed", range(3))
def test_chains_of_redirects_equal_a_walk(spark, seed):
    rng = random.Random(seed)
    hops = {}
    for length in range(1, 21):                              # chains of 1 to 20 hops to an end that is fetched or not
        names = [f"c{length}-{i}" for i in range(length + 1)]
        hops |= dict(zip(names, names[1:]))
        if rng.random() < 0.5:
            hops[names[-1]] = rng.choice([names[-1], None])  # hops to itself, or names no final URL
    for n in (1, 2, 3, 8):                                   # loops, and tails that run into them
        ring = [f"l{n}-{i}" for i in range(n)]
        hops |= dict(zip(ring, ring[1:] + ring[:1]))
        hops |= {f"t{n}-{i}": (f"t{n}-{i + 1}" if i < 4 else ring[0]) for i in range(5)}
    hops |= {f"many-{i}": "c20-0" for i in range(50)}
    hops["l1-0"] = "l1-0"

    def walk(u, most):
        n, seen = 0, set()
        while hops.get(u) not in (None, u):
            if u in seen or n > most:
                return None, None
            seen.add(u)
            u, n = hops[u], n + 1
        return (u, n) if n <= most else (None, None)

    old = dt.datetime(2025, 3, 1)
    rows = [(u, t, 200, old + dt.timedelta(1)) for u, t in hops.items()] + [(u, "stale", 200, old) for u in list(hops)[:30]]
    fetches = spark.createDataFrame(rows, "url string, final_url string, status int, fetched_at timestamp").repartition(3)
    links = sorted(hops) + ["never-fetched"]
    cand = spark.createDataFrame([(u,) for u in links + links[:5]], "url string")
    for most in (30, 7):
        kept = {r.url: (r.expanded_url, r.n_hops) for r in J.expand_chains(cand, fetches, max_hops=most).collect()}
        nulls = {r.url: (r.expanded_url, r.n_hops) for r in J.expand_chains(cand, fetches, failed="null", max_hops=most).collect()}
        for u in links:
            end, n = walk(u, most)
            known = hops.get(u) is not None
            assert kept[u] == (end or u, n if known else 0), u
            assert nulls[u] == ((end, n) if known else (None, None)), u
    assert J.expand_chains(cand, fetches.limit(0)).filter("expanded_url = url AND n_hops = 0").count() == cand.count()


def test_sketches_of_days_unite(spark):
    rng = random.Random(4)
    t0 = dt.datetime(2025, 3, 1)
    rows = [("a" if i % 3 else "b", t0 + dt.timedelta(hours=rng.randrange(240)), f"d{rng.randrange(3000)}", 10) for i in range(9000)]
    caps = spark.createDataFrame(rows, "collection string, ts timestamp, digest string, length long")
    days = A.duplicate_sketches(caps)
    assert days.count() == 20
    old, new = days.filter("day < '2025-03-06'"), days.filter("day >= '2025-03-06'")   # kept and added
    got = {r.collection: r for r in A.duplicate_estimate(old.unionByName(new)).collect()}
    for c in "ab":
        mine = [r for r in rows if r[0] == c]
        exact = len({r[2] for r in mine})
        assert got[c].captures == len(mine) and got[c].bytes == 10 * len(mine)
        assert abs(got[c].distinct_digests - exact) <= 0.024 * exact
        assert abs(got[c].duplicate_bytes - 10 * got[c].duplicate_captures) <= 1


def test_feeds_as_rows(spark):
    outlets = spark.createDataFrame([("w1", ["a", "b", "a"]), ("w2", None), ("w3", [])], "website string, rss array<string>")
    found = spark.createDataFrame([("w1", "b"), ("w1", "c"), ("w1", "c"), ("w2", "d"), ("w9", "e")], "website string, feed string")
    assert sorted(map(tuple, A.feed_rows(outlets, found).collect()), key=str) == [
        ("w1", "a", 0), ("w1", "b", 1), ("w1", "c", None), ("w2", "d", None)]


def test_seen_filter_gives_the_anti_joins_rows(spark):
    rng = random.Random(3)
    d1, d2 = dt.date(2025, 3, 17), dt.date(2025, 3, 18)
    seen = spark.createDataFrame([(f"s{rng.randrange(5)}", rng.choice([d1, d2]), f"u{i}") for i in range(0, 4000, 2)],
                                 "website_hash string, day date, url string")
    cand = spark.createDataFrame([(f"s{rng.randrange(5)}", f"u{i}") for i in range(3000)] + [(None, "u1"), ("s1", None)] +
                                 [tuple(r) for r in seen.select("website_hash", "url").limit(500).collect()],
                                 "website_hash string, url string")
    filters = J.seen_filter(seen.filter("url < 'u2'"), buckets=2).unionByName(J.seen_filter(seen.filter("url >= 'u2'"), buckets=2))
    days = J.seen_filter_union(filters)
    assert days.count() == 4 and days.selectExpr("max(length(bitmap))").first()[0] == 4096
    for day in (d1, d2):
        mine = seen.filter(F.col("day") == F.lit(day))
        got = J.drop_seen_filtered(cand, mine, days.filter(F.col("day") == F.lit(day)), buckets=2)
        want = J.drop_seen(cand, mine)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() < cand.count()
    empty = seen.filter("url IS NULL")
    assert J.drop_seen_filtered(cand, empty, J.seen_filter(empty, buckets=2), buckets=2).count() == cand.count()
    # few of the unseen look seen: only those reach the anti join
    unseen = spark.range(20000).selectExpr("'s9' AS website_hash", "concat('v', id) AS url")
    plan = J.drop_seen_filtered(unseen, seen, days, buckets=2)
    assert plan.count() == 20000


def test_seed_of_equals_trying_all_seeds(spark):
    rng = random.Random(2)
    folders = [f"/{a}/{b}" for a in "abc" for b in range(700)]
    seeds = [f"https://hot.com{f}/index.html" for f in folders] + ["http://hot.com/a", "https://hot.com/a/7/x/y/", "https://U:p@Other.org",
             "nothing", None, "https://other.org/z/", "https://hot.com/b/1/"]
    urls = [f"http://hot.com{rng.choice(folders)}{rng.choice(['', '/', '/x/y/z', '/x'])}" for _ in range(300)]
    urls += ["https://other.org", "https://other.org/z/1", "ftp://other.org/z/1", "https://third.org/", None, "https://hot.com/b/1/", "https://hot.com/b/1/"]
    links = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "id int, url string")
    table = spark.createDataFrame([(x,) for x in seeds], "seed_url string")
    got = {r.id: r.seed_url for r in FL.seed_of(links, table).collect()}
    pairs = links.crossJoin(table).filter(FL.in_scope_flag("url", "seed_url")).withColumn("p", FL.scope_prefix("seed_url"))
    want = {}
    for r in pairs.collect():
        want.setdefault(r.id, []).append((-len(r.p), r.seed_url))
    assert got == {i: min(want[i])[1] if i in want else None for i in range(len(urls))} and len(want) > 290
