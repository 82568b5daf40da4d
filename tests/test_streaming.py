"""Streaming operators: same answer as one batch, across micro-batches and restarts."""

import datetime as dt

from pyspark.sql import functions as F

from newsarc.streaming import jobs as S

CAND_SCHEMA = "website_hash string, round string, url string, origin int, feed_pos long, entry_pos int, seen_at timestamp"


def _files(spark, rows_per_file, schema, root):
    for i, rows in enumerate(rows_per_file):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{root}/f{i:03d}")
    return f"{root}/f*"


def _stream(spark, schema, glob):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(glob)


def _t(h, m=0):
    return dt.datetime(2025, 3, 17, h, m)


def _cands():
    files = []
    for f in range(3):
        rows = []
        for site in ("s1", "s2", "s3"):
            for k in range(3 if site != "s3" else 1):
                rows.append((site, "r1", f"https://{site}/{f}-{k}", k % 2, f, k, _t(10 + f, k)))
        rows.append(("s1", "r1", "https://s1/0-0", 0, 9, 9, _t(10 + f, 30)))  # repeat of a seen URL
        files.append(rows)
    return files


def test_dedup_within_watermark(spark, tmp_path):
    files = _cands()
    glob = _files(spark, files, CAND_SCHEMA, str(tmp_path / "in"))
    q = S.start(S.stream_dedup(_stream(spark, CAND_SCHEMA, glob)), "dedup_t", fmt="parquet",
                path=str(tmp_path / "out"), checkpoint=str(tmp_path / "ck"))
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    want = spark.createDataFrame([r for f in files for r in f], CAND_SCHEMA).select("website_hash", "url").distinct()
    assert got.count() == want.count() == got.select("website_hash", "url").distinct().count()


def test_cap_across_batches_and_restart(spark, tmp_path):
    files = _cands()
    glob = _files(spark, files, CAND_SCHEMA, str(tmp_path / "in"))
    out = str(tmp_path / "capped")

    def run():
        q = S.start(_stream(spark, CAND_SCHEMA, glob), "cap_t", sink=S.cap_batch(out, n=5),
                    checkpoint=str(tmp_path / "ck"))
        q.awaitTermination()

    run()
    got = spark.read.parquet(out)
    rows = sorted((r.website_hash, r.rank, r.url) for r in got.collect())
    # batch answer: per site the first 5 in (file, origin, feed_pos, entry_pos, url) order
    flat = sorted([(r[0], fi, r[3], r[4], r[5], r[2]) for fi, f in enumerate(files) for r in f])
    want = []
    for site in ("s1", "s2", "s3"):
        mine = [x for x in flat if x[0] == site][:5]
        want += [(site, i + 1, x[5]) for i, x in enumerate(mine)]
    assert rows == sorted(want)
    run()                                   # restart from the checkpoint: nothing new
    assert spark.read.parquet(out).count() == len(want)


def _round(spark, stories, home, t):
    words = "<p>" + " ".join(["word"] * 25) + "</p>"
    rows = [("https://a.com/", None, 200, t, "".join(f'<a href="/news/story-{i}">x</a>' for i in home), None)]
    rows += [(f"https://a.com/news/story-{i}", None, 200, t, words, None) for i in stories]
    from newsarc.sources.readers import FETCHES
    return spark.createDataFrame(rows, FETCHES)


def _site(spark):
    return spark.createDataFrame([("AK", "newspaper", "https://a.com/", None, 200)],
                                 "state string, media string, website string, rss array<string>, website_status int")


def _archive(spark, when):
    return spark.createDataFrame([(f"https://a.com/news/story-{i}", f"https://web.archive.org/web/1/{i}", when)
                                  for i in range(12)], "url string, output string, called_at timestamp")


def test_a_replayed_round_writes_the_same(spark, tmp_path):
    arts, seen = str(tmp_path / "articles"), str(tmp_path / "seen")
    sink = S.collect_batch(_site(spark), _archive(spark, _t(9)), arts, seen, n=5, rule="last_segment")

    def tables():
        a = sorted((r.batch_id, r.link) for r in spark.read.parquet(arts).collect())
        s = sorted((r.batch_id, str(r.day), r.url) for r in spark.read.parquet(seen).collect())
        return a, s
    sink(_round(spark, range(8), range(8), _t(10)), 0)
    once = tables()
    sink(_round(spark, range(8), range(8), _t(10)), 0)       # replay after a failure
    assert tables() == once and len(once[0]) == len(once[1]) == 5
    sink(_round(spark, range(8), range(8), _t(11)), 1)
    twice = tables()
    sink(_round(spark, range(8), range(8), _t(11)), 1)
    assert tables() == twice and [len(x) for x in twice] == [8, 8]


def test_links_archived_after_midnight_are_not_taken_again(spark, tmp_path):
    late = dt.datetime(2025, 3, 17, 23, 50)
    arch = _archive(spark, dt.datetime(2025, 3, 18, 0, 10))
    sink = S.collect_batch(_site(spark), arch, str(tmp_path / "a"), str(tmp_path / "s"), n=5, rule="last_segment")
    sink(_round(spark, range(5), range(5), late), 0)
    sink(_round(spark, range(5), range(5), late + dt.timedelta(minutes=5)), 1)
    got = spark.read.parquet(str(tmp_path / "a"))
    assert got.count() == got.select("link").distinct().count() == 5


def test_a_failing_read_is_not_an_empty_table(spark, tmp_path):
    import pytest
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        S.stored(spark, str(tmp_path / "t"))
    assert S.stored(spark, str(tmp_path / "none")) is None


def test_the_same_url_on_the_next_day(spark, tmp_path):
    day2 = dt.datetime(2025, 3, 18, 9)
    files = [[("s", "r", "https://s/x", 0, 0, 0, _t(20)), ("s", "r", "https://s/x", 0, 0, 1, _t(21))],
             [("s", "r", "https://s/x", 0, 0, 0, day2)]]
    glob = _files(spark, files, CAND_SCHEMA, str(tmp_path / "in"))
    q = S.start(S.stream_dedup(_stream(spark, CAND_SCHEMA, glob)), "day_t", fmt="parquet",
                path=str(tmp_path / "out"), checkpoint=str(tmp_path / "ck"))
    q.awaitTermination()
    assert sorted(str(r.day) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["2025-03-17", "2025-03-18"]


def test_site_records_and_usage_and_sessions(spark, tmp_path):
    schema = "website_hash string, fetched_at timestamp, collection string, length long"
    files = [[("a", _t(1), "c1", 10), ("a", _t(2), "c1", 20), ("b", _t(3), "c2", 5)],
             [("a", _t(5), "c1", 1), ("b", dt.datetime(2025, 3, 18, 1), "c2", 7)]]
    glob = _files(spark, files, schema, str(tmp_path / "in"))
    q = S.start(S.stream_site_records(_stream(spark, schema, glob)), "site_t", fmt="parquet",
                path=str(tmp_path / "sites"), checkpoint=str(tmp_path / "ck1"))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "sites")).count() == 3      # a@17, b@17, b@18

    usage = S.stream_usage(_stream(spark, schema, glob).withColumnRenamed("fetched_at", "ts"))
    q = S.start(usage, "usage_t", fmt="memory", mode="complete", checkpoint=str(tmp_path / "ck2"))
    q.awaitTermination()
    got = {(str(r.window_start), r.collection): (r.documents, r.bytes) for r in spark.sql("SELECT * FROM usage_t").collect()}
    assert got == {("2025-03-17 00:00:00", "c1"): (3, 31), ("2025-03-17 00:00:00", "c2"): (1, 5),
                   ("2025-03-18 00:00:00", "c2"): (1, 7)}

    sliding = S.stream_usage(_stream(spark, schema, glob).withColumnRenamed("fetched_at", "ts"),
                             window="2 days", slide="1 day")
    q = S.start(sliding, "slide_t", fmt="memory", mode="complete", checkpoint=str(tmp_path / "ck4"))
    q.awaitTermination()
    got = {(str(r.window_start), r.collection): r.documents for r in spark.sql("SELECT * FROM slide_t").collect()}
    assert got == {("2025-03-16 00:00:00", "c1"): 3, ("2025-03-17 00:00:00", "c1"): 3,
                   ("2025-03-16 00:00:00", "c2"): 1, ("2025-03-17 00:00:00", "c2"): 2,
                   ("2025-03-18 00:00:00", "c2"): 1}

    log_schema = "page string, timestamp timestamp"
    lf = [[("p", _t(1, 0)), ("p", _t(1, 0) + dt.timedelta(seconds=30))],
          [("p", _t(1, 0) + dt.timedelta(seconds=200)), ("q", _t(1, 1))]]
    lglob = _files(spark, lf, log_schema, str(tmp_path / "log"))
    q = S.start(S.stream_sessions(_stream(spark, log_schema, lglob)), "sess_t", fmt="memory",
                mode="complete", checkpoint=str(tmp_path / "ck3"))
    q.awaitTermination()
    sess = sorted((r.page, r.events) for r in spark.sql("SELECT * FROM sess_t").collect())
    assert sess == [("p", 1), ("p", 2), ("q", 1)]


def test_append_is_idempotent_and_retry(spark, tmp_path):
    rows = spark.createDataFrame([("AK", 2025, 3, 17, "h", "https://a/x")],
                                 "state string, year int, month int, day int, website_hash string, link string")
    sink = S.append_batch(str(tmp_path / "tree"))
    sink(rows, 7)
    sink(rows, 7)                           # replay of batch 7
    sink(rows, 8)
    assert spark.read.parquet(str(tmp_path / "tree")).count() == 2

    res = spark.createDataFrame(
        [("https://a/1", "https://web.archive.org/web/1/https://a/1", _t(1)),
         ("https://a/2", "520 Server Error: x", _t(1)),
         ("https://a/3", "Error: refused", _t(1))], "url string, output string, called_at timestamp")
    retry = S.retry_batch(str(tmp_path / "retry"), str(tmp_path / "ok"), delay_minutes=30, max_tries=2)
    retry(res, 0)
    assert spark.read.parquet(str(tmp_path / "ok")).count() == 1
    assert S.due_retries(spark, str(tmp_path / "retry"), _t(1, 10)).count() == 0
    due = S.due_retries(spark, str(tmp_path / "retry"), _t(2)).collect()
    assert [(r.url, r.tries) for r in due] == [("https://a/2", 1)]
    again = res.filter(F.col("url") == "https://a/2").withColumn("tries", F.lit(1))
    retry(again, 1)
    assert S.due_retries(spark, str(tmp_path / "retry"), _t(5)).count() == 0   # gave up after 2 tries


def test_a_retry_that_succeeds_is_no_longer_due(spark, tmp_path):
    retry_root, ok_root = str(tmp_path / "retry"), str(tmp_path / "ok")
    retry = S.retry_batch(retry_root, ok_root, delay_minutes=30, max_tries=5)
    schema = "url string, output string, called_at timestamp, tries int"
    bad = spark.createDataFrame([("https://a/2", "520 Server Error: x", _t(1), 0),
                                 ("https://a/4", "520 Server Error: x", _t(1), 0)], schema)
    good = spark.createDataFrame([("https://a/2", "https://web.archive.org/web/1/https://a/2", _t(2), 1)], schema)
    for _ in range(2):                       # each batch replayed once
        retry(bad, 0)
    assert {r.url for r in S.due_retries(spark, retry_root, _t(3)).collect()} == {"https://a/2", "https://a/4"}
    for _ in range(2):
        retry(good, 1)
    assert {r.url for r in S.due_retries(spark, retry_root, _t(3)).collect()} == {"https://a/4"}
    assert spark.read.parquet(ok_root).count() == 1
    S.compact_retries(spark, retry_root, str(tmp_path / "compact"))
    assert spark.read.parquet(str(tmp_path / "compact")).count() == 1
    assert {r.url for r in S.due_retries(spark, str(tmp_path / "compact"), _t(3)).collect()} == {"https://a/4"}


def test_collect_rounds_as_a_stream(spark, tmp_path):
    from newsarc.sources.readers import FETCHES
    outlets = spark.createDataFrame([("AK", "newspaper", "https://a.com/", None, 200)],
                                    "state string, media string, website string, rss array<string>, website_status int")
    words = "<p>" + " ".join(["word"] * 25) + "</p>"
    home1 = "".join(f'<a href="/news/story-{i}">x</a>' for i in range(4))
    home2 = "".join(f'<a href="/news/story-{i}">x</a>' for i in range(8))
    rounds = []
    for r, home in ((0, home1), (1, home2)):
        t = dt.datetime(2025, 3, 17, 10 + r)
        rows = [("https://a.com/", None, 200, t, home, None)]
        rows += [(f"https://a.com/news/story-{i}", None, 200, t, words, None) for i in range(8)]
        rounds.append(rows)
    glob = _files(spark, rounds, FETCHES, str(tmp_path / "fetches"))
    arch = spark.createDataFrame([(f"https://a.com/news/story-{i}", f"https://web.archive.org/web/1/{i}",
                                   dt.datetime(2025, 3, 17, 9)) for i in range(8)],
                                 "url string, output string, called_at timestamp")
    sink = S.collect_batch(outlets, arch, str(tmp_path / "articles"), str(tmp_path / "seen"), n=5,
                           rule="last_segment")
    from newsarc.sources.readers import stream_fetches
    stream = stream_fetches(spark, glob, max_files=1)
    q = S.start(stream, "collect_t", sink=sink, checkpoint=str(tmp_path / "ck"))
    q.awaitTermination()
    arts = spark.read.parquet(str(tmp_path / "articles"))
    per_batch = {r.batch_id: r.n for r in arts.groupBy("batch_id").agg(F.count("*").alias("n")).collect()}
    # round 1: 4 links (all new); round 2: 8 links, 4 seen, so the 4 new ones (under the cap of 5)
    assert per_batch == {0: 4, 1: 4}
    assert arts.select("link").distinct().count() == 8


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    schema = "ts timestamp, collection string, length long"
    # late rows are judged against the previous batch's watermark (Spark's rule for chains of
    # stateful operators), so the late row comes in the third micro-batch
    files = [[(dt.datetime(2025, 3, 17, 12), "c1", 10), (dt.datetime(2025, 3, 17, 13), "c1", 5)],
             [(dt.datetime(2025, 3, 17, 14), "c1", 1)],
             [(dt.datetime(2025, 3, 15, 9), "c1", 100)]]     # two days before the watermark's base: late
    glob = _files(spark, files, schema, str(tmp_path / "in"))
    q = S.start(S.stream_usage(_stream(spark, schema, glob)), "late_t", fmt="memory", mode="update",
                checkpoint=str(tmp_path / "ck"))
    q.awaitTermination()
    got = {(str(r.window_start), r.documents, r.bytes) for r in spark.sql("SELECT * FROM late_t").collect()}
    assert ("2025-03-17 00:00:00", 3, 16) in got and not any(w.startswith("2025-03-15") for w, _, _ in got)
    dropped = sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"])
    assert dropped == 1
