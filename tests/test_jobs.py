"""End-to-end jobs E3-E6 on self-made inputs."""

import datetime as dt

from pyspark.sql import functions as F

from newsarc.plans import jobs as E


def _inputs(spark):
    outlets = spark.createDataFrame(
        [("AK", "newspaper", "https://a.com/", None, 200), ("AK", "tv", "https://b.com/", None, 200),
         ("AK", "newspaper", "https://c.com/", None, 404)],
        "state string, media string, website string, rss array<string>, website_status int")
    words = "<p>" + " ".join(["word"] * 25) + "</p>"
    t = dt.datetime(2025, 3, 17, 12)
    rows = [("https://a.com/", None, 200, t,
             '<a href="/2025/03/17/story">1</a><a href="/news/123">2</a><a href="/about">3</a>'),
            ("https://a.com/2025/03/17/story", None, 200, t, words),
            ("https://a.com/news/123", None, 200, t, words),
            ("https://b.com/", None, 200, t, '<a href="/x/y/z-1">1</a>'),
            ("https://b.com/x/y/z-1", None, 200, t, words)]
    fetches = spark.createDataFrame(rows, "url string, final_url string, status int, fetched_at timestamp, body string")
    arch = spark.createDataFrame(
        [(u, f"https://web.archive.org/web/1/{u}", t) for u in
         ("https://a.com/2025/03/17/story", "https://a.com/news/123", "https://b.com/x/y/z-1",
          "https://a.com/", "https://b.com/")], "url string, output string, called_at timestamp")
    return outlets, fetches, arch


def test_collect_html_v2_and_home_pages(spark, tmp_path):
    outlets, fetches, arch = _inputs(spark)
    arts, seen, bodies = E.collect_html(outlets, fetches, arch, "2025-03-17 13:00:00")
    links = sorted(r.link for r in arts.collect())
    # last-segment rule: "story" has no boundary and is not numeric; "123" is numeric; "z-1" has one
    assert links == ["https://a.com/news/123", "https://b.com/x/y/z-1"]
    assert bodies.count() == 2 and seen.count() == 2

    v2 = E.collect_v2(outlets, fetches, arch, "2025-03-17 13:00:00", site_root=str(tmp_path / "sites"))
    assert sorted(r.link for r in v2.collect()) == ["https://a.com/2025/03/17/story", "https://b.com/x/y/z-1"]
    sites = {r.website: r for r in spark.read.parquet(str(tmp_path / "sites")).collect()}
    assert set(sites) == {"https://a.com/", "https://b.com/"}                # alive and archived
    assert sites["https://b.com/"].archived_path == "https://web.archive.org/web/1/https://b.com/"
    assert sites["https://b.com/"].publication_metadata.media == "tv"
    again = E.K.write_site_records(E.site_records(outlets, arch, "2025-03-17 13:00:00"), str(tmp_path / "sites"))
    assert again.count() == 0
    none = E.site_records(outlets, arch.filter("url != 'https://b.com/'"), "2025-03-17 13:00:00")
    assert [r.website for r in none.collect()] == ["https://a.com/"]

    home = E.archive_home_pages(outlets, arch).collect()
    assert [(r.website, r.archived_link) for r in home] == [("https://a.com/", "https://web.archive.org/web/1/https://a.com/")]


def _site(spark, feed_items, home, redirect=False):
    t = dt.datetime(2024, 6, 11, 12)
    words = "<p>" + " ".join(["word"] * 25) + "</p>"
    outlets = spark.createDataFrame([("AK", "tv", "https://a.com/", ["https://a.com/feed"], 200)],
                                    "state string, media string, website string, rss array<string>, website_status int")
    items = "".join(f"<item><link>{u}</link></item>" for u in feed_items)
    rows = [("https://a.com/feed", None, 200, t, f"<rss>{items}</rss>"),
            ("https://a.com/", None, 200, t, "".join(f'<a href="{u}">x</a>' for u in home))]
    for u in [*feed_items, *home]:
        rows.append((u, u.replace("/s/", "/long/story-") if redirect else None, 200, t, words))
    fetches = spark.createDataFrame(rows, "url string, final_url string, status int, fetched_at timestamp, body string")
    arch = spark.createDataFrame([(u, f"https://web.archive.org/web/1/{u}", t) for u in [*feed_items, *home]],
                                 "url string, output string, called_at timestamp")
    return outlets, fetches, arch


def test_home_page_fills_up_a_feed_of_non_articles(spark):
    home = [f"https://a.com/2024/06/11/story-{i}" for i in range(6)]
    args = _site(spark, [f"https://a.com/tag{i}" for i in range(6)], home)
    arts, _ = E.collect_articles(*args, "2024-06-11 13:00:00")
    assert sorted(r.link for r in arts.collect()) == home[:5]


def test_a_redirected_article_keeps_its_content(spark):
    args = _site(spark, ["https://a.com/s/1"], [], redirect=True)
    arts, _, bodies = E.collect_html(*args, "2024-06-11 13:00:00")
    assert [(r.link, r.expanded_url) for r in arts.collect()] == [("https://a.com/s/1", "https://a.com/long/story-1")]
    assert bodies.count() == 1


def test_the_latest_fetch_decides_on_content(spark):
    outlets, fetches, arch = _site(spark, ["https://a.com/x/y/z-1"], [])
    later = fetches.filter("url = 'https://a.com/x/y/z-1'").withColumn("fetched_at", F.col("fetched_at") + F.expr("INTERVAL 1 HOUR")) \
        .withColumn("body", F.lit("gone"))
    arts, _ = E.collect_articles(outlets, fetches.unionByName(later), arch, "2024-06-11 13:00:00")
    assert arts.count() == 0


def test_crawl_report(spark, tmp_path):
    base = tmp_path / "collections"
    (base / "c1" / "warc-cdx").mkdir(parents=True)
    (base / "c1" / "warc-cdx" / "x.cdx").write_text("\n".join([
        'com,ex)/ 20240611081502 {"url":"https://ex.com/","mime":"text/html","status":"200","digest":"d1",'
        '"length":"100","offset":"0","filename":"f"}',
        'com,ex)/a.js 20240611081503 {"url":"https://cdn.ex.com/a.js","mime":"application/javascript",'
        '"status":"200","digest":"d2","length":"10","offset":"100","filename":"f","referrer":"https://ex.com/"}',
        'com,ex)/ 20240611091502 {"url":"https://ex.com/","mime":"text/html","status":"200","digest":"d1",'
        '"length":"100","offset":"110","filename":"f"}']))
    (base / "c1" / "pages").mkdir()
    (base / "c1" / "pages" / "pages.jsonl").write_text(
        '{"format":"json-pages-1.0","id":"pages","title":"Seed Pages","hasText":"false"}\n'
        '{"id":"1","url":"https://ex.com/","ts":"2024-06-11T08:15:02.000Z","status":200,"seed":true,"depth":0}')
    (base / "c1" / "logs").mkdir()
    (base / "c1" / "logs" / "crawl.log").write_text(
        '{"timestamp":"2024-06-11T08:15:02.000Z","logLevel":"info","context":"worker","message":"Awaiting page load",'
        '"details":{"page":"https://ex.com/"}}\n'
        '{"timestamp":"2024-06-11T08:15:12.000Z","logLevel":"info","context":"pageStatus","message":"Page Finished",'
        '"details":{"page":"https://ex.com/"}}\n'
        '{"timestamp":"2024-06-11T08:16:00.000Z","logLevel":"info","context":"crawlStatus","message":"Crawl statistics",'
        '"details":{"crawled":1,"total":1,"pending":0,"failed":0}}')
    (base / "c1" / "crawls").mkdir()
    (base / "c1" / "crawls" / "s.yaml").write_text(
        "state:\n  finished:\n    - https://ex.com/\n  queued:\n"
        """    - '{"added":"2024-06-11T08:15:07.000Z","url":"https://ex.com/b","seedId":0,"depth":1,"extraHops":0}'\n""")
    rep = E.crawl_report(spark, str(base))
    assert rep["seeds"].first().documents == 3 and rep["seeds"].first().bytes == 210
    assert {r.host: r.documents for r in rep["hosts"].collect()} == {"ex.com": 2, "cdn.ex.com": 1}
    d = rep["duplicates"].first()
    assert (d.captures, d.distinct_digests, d.duplicate_captures, d.duplicate_bytes) == (3, 2, 1, 100)
    assert rep["seed_metrics"].first().seeds == 1
    assert rep["page_durations"].first().seconds == 10.0
    assert rep["crawls"].first().crawled == 1
    assert {(r.list, r.depth): r.urls for r in rep["frontier"].collect()} == {("finished", None): 1, ("queued", 1): 1}
    prog = sorted((str(r.ts), r.cum_docs, r.cum_bytes) for r in rep["progress"].collect())
    assert prog[-1][1:] == (3, 210)
    ch = sorted((str(r.ts), r.change) for r in rep["changes"].collect())
    assert [c for _, c in ch] == ["first", "first", "unchanged"]
