"""Rounds that outlast a batch, and the keyed forms of the cap and of retries."""

import datetime as dt
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from newsarc.sources.readers import FETCHES, stream_fetches
from newsarc.streaming import jobs as S
from newsarc.streaming.keyed import best_rows, retry_step, stream_cap, stream_retry
from newsarc.streaming.rounds import Rounds

WORDS = "<p>" + " ".join(["word"] * 25) + "</p>"
OUTLETS = "state string, media string, website string, rss array<string>, website_status int"


def _at(h, m=0, d=17):
    return dt.datetime(2025, 3, d, h, m)


def _story(site, i, t, body=WORDS, to=None):
    return (f"https://{site}.com/news/story-{i}", to, 200, t, body, None)


def _home(site, stories, t):
    return (f"https://{site}.com/", None, 200, t, "".join(f'<a href="/news/story-{i}">x</a>' for i in stories), None)


def _files():
    """Bodies before and after their home pages, in other files, over three rounds and midnight."""
    return [
        [_home("a", range(8), _at(10, 5)), _story("a", 0, _at(10, 6)), _story("b", 3, _at(10, 7))],
        [_story("a", i, _at(10, 10 + i)) for i in range(1, 4)] + [_home("b", range(5), _at(10, 20))],
        [_story("a", 9, _at(11, 1)), _home("a", [9, 2, 4], _at(11, 2)), _story("b", 0, _at(10, 50))],
        [_story("a", 4, _at(11, 30)), _story("a", 2, _at(11, 31)), _home("a", [9, 2, 4, 5], _at(11, 40)), _story("a", 5, _at(11, 41))],
        [_home("b", [0, 7], _at(23, 50)), _story("b", 7, _at(23, 55)), _story("b", 0, _at(23, 56)), _story("b", 8, _at(23, 57), "few")],
        [_home("b", [0, 8], _at(0, 10, 18)), _story("b", 0, _at(0, 20, 18)), _story("b", 8, _at(0, 21, 18))],
    ]


def _inputs(spark, tmp_path):
    paths = []
    for i, rows in enumerate(_files()):
        spark.createDataFrame(rows, FETCHES).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / f"in/f{i:02d}"))
        paths.append(str(tmp_path / f"in/f{i:02d}"))
        time.sleep(0.02)                  # the file source reads in the order of the times
    outlets = spark.createDataFrame([("AK", "tv", f"https://{s}.com/", None, 200) for s in "ab"], OUTLETS)
    calls = [(f"https://{s}.com/news/story-{i}", f"https://web.archive.org/web/1/{s}{i}", _at(9)) for s in "ab" for i in range(10)]
    return outlets, spark.createDataFrame(calls, "url string, output string, called_at timestamp")


def _answer(spark, rounds):
    arts = spark.read.parquet(rounds.path("articles")).select("round", "website_hash", "link", "day")
    seen = spark.read.parquet(rounds.path("seen")).select("round", "website_hash", "url", F.col("day").cast("string"))
    return sorted(map(tuple, arts.collect())), sorted(map(tuple, seen.collect()))


@pytest.mark.parametrize("per_batch", [1, 2, 100])
def test_any_number_of_batches_gives_the_same(spark, tmp_path, per_batch):
    outlets, calls = _inputs(spark, tmp_path)
    rounds = Rounds(outlets, calls, str(tmp_path / "state"), delay="30 minutes", rule="last_segment")
    for _ in range(2):                    # a restart adds nothing
        q = S.start(stream_fetches(spark, str(tmp_path / "in/f*"), max_files=per_batch), f"rounds_{per_batch}", sink=rounds,
                    checkpoint=str(tmp_path / "ck"))
        q.awaitTermination()
    assert {r for r, *_ in _answer(spark, rounds)[0]} == {"20250317-100000", "20250317-110000"}    # the rest is open
    for _ in range(2):
        rounds.close(spark)
    arts, seen = _answer(spark, rounds)
    got = {}
    for name, _, link, _ in arts:
        got.setdefault(name, []).append(link[len("https://"):].replace(".com/news/story-", ""))
    assert {k: sorted(v) for k, v in got.items()} == {
        "20250317-100000": ["a0", "a1", "a2", "a3", "b0", "b3"],   # bodies before and after their home page
        "20250317-110000": ["a4", "a5", "a9"],                     # the last home page counts; a2 was taken this day
        "20250317-230000": ["b7"],                                 # b0 was taken at ten; b8 is too short
        "20250318-000000": ["b0", "b8"]}                           # another day
    assert len(seen) == len(arts) == 12
    assert spark.read.parquet(rounds.path("progress")).agg(F.sum("late"), F.sum("rows")).first()[:] == (0, sum(map(len, _files())))


def test_replayed_batches_and_late_rows(spark, tmp_path):
    outlets, calls = _inputs(spark, tmp_path)
    rounds = Rounds(outlets, calls, str(tmp_path / "state"), delay="30 minutes", rule="last_segment")
    batches = [spark.createDataFrame(rows, FETCHES) for rows in _files()]
    for i, b in enumerate(batches):
        rounds(b, i)
        once = _answer(spark, rounds) if i > 2 else None
        rounds(b, i)                      # replayed after a failure
        assert once is None or _answer(spark, rounds) == once
    late = spark.createDataFrame([_story("a", 7, _at(10, 40)), _home("a", [7], _at(10, 45))], FETCHES)
    before = _answer(spark, rounds)
    rounds(late, len(batches))
    assert _answer(spark, rounds) == before
    assert spark.read.parquet(rounds.path("progress")).filter("late > 0").select("batch_id", "late").collect()[0][:] == (len(batches), 2)
    assert rounds.open_rounds(spark) == ["20250317-230000", "20250318-000000"]   # decided rounds are forgotten
    rounds.close(spark)
    assert len(_answer(spark, rounds)[0]) == 12


CAND = "website_hash string, round string, url string, origin int, feed_pos long, entry_pos int, seen_at timestamp"


def _cands():
    files = []
    for f in range(3):
        rows = [(s, r, f"https://{s}/{r}/{f}-{k}", k % 2, f if k % 3 else None, k, _at(10 + f, k))
                for s in ("s1", "s2", "s3") for r in ("r1", "r2") for k in range(4 if s != "s3" else 1)]
        files.append(rows)
    return files


def test_keyed_cap_equals_the_table_form(spark, tmp_path):
    for i, rows in enumerate(_cands()):
        spark.createDataFrame(rows, CAND).coalesce(1).write.parquet(str(tmp_path / f"in/f{i}"))
        time.sleep(0.02)

    def stream():
        return spark.readStream.schema(CAND).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/f*"))

    for _ in range(2):                    # the second run is a restart
        S.start(stream_cap(stream()), "keyed_cap", fmt="parquet", path=str(tmp_path / "keyed"),
                checkpoint=str(tmp_path / "ck1")).awaitTermination()
        S.start(stream(), "table_cap", sink=S.cap_batch(str(tmp_path / "table")), checkpoint=str(tmp_path / "ck2")).awaitTermination()
    cols = ["website_hash", "round", "url", "rank"]
    keyed = spark.read.parquet(str(tmp_path / "keyed")).select(*cols).collect()
    table = spark.read.parquet(str(tmp_path / "table")).select(*cols).collect()
    assert sorted(map(tuple, keyed)) == sorted(map(tuple, table))
    counts = pd.Series([(r.website_hash, r.round) for r in keyed]).value_counts()
    assert counts.max() == 5 and len(keyed) == 4 * 5 + 2 * 3


def test_best_rows_holds_no_more_than_it_needs():
    parts = [pd.DataFrame({"a": [5, None, 1], "b": ["x", "y", "z"]}), pd.DataFrame({"a": [1, 0], "b": ["a", "q"]})]
    assert best_rows(iter(parts), 3, ["a", "b"])["b"].tolist() == ["q", "a", "z"]
    assert best_rows(iter(parts), 9, ["a", "b"])["b"].tolist() == ["q", "a", "z", "x", "y"]
    assert best_rows(iter([]), 3, ["a"]) is None


@pytest.mark.parametrize("tries, outcomes, want", [
    (0, [(False, True)], (1, "wait")), (1, [(False, True)], (2, "wait")), (2, [(False, True)], (3, "gave_up")),
    (0, [(False, False)], (1, "gave_up")), (2, [(True, False)], (0, "done")), (0, [(False, True), (True, False)], (0, "done")),
    (1, [(True, False), (False, True)], (1, "wait")), (0, [(False, True)] * 3, (3, "gave_up")), (2, [], (2, None))])
def test_retry_steps(tries, outcomes, want):
    assert retry_step(tries, outcomes, 3) == want


def test_timers_release_a_url_by_themselves(spark, tmp_path):
    schema = "url string, output string, called_at timestamp"
    spark.createDataFrame([("https://a/1", "520 Server Error: x", _at(1)), ("https://a/2", "https://web.archive.org/web/1/2", _at(1)),
                           ("https://a/3", "Error: refused", _at(1)), ("https://a/4", "520 Server Error: x", _at(1))],
                          schema).coalesce(1).write.parquet(str(tmp_path / "in/f0"))
    results = spark.readStream.schema(schema).parquet(str(tmp_path / "in/f*"))
    q = S.start(stream_retry(results, delay="3 seconds", max_tries=2), "retry_keyed", fmt="memory",
                processing_time="1 second", checkpoint=str(tmp_path / "ck"))

    def state(want, seconds=60):
        end = time.time() + seconds
        while time.time() < end:
            got = sorted((r.url[-1], r.tries, r.state) for r in spark.sql("SELECT * FROM retry_keyed").collect())
            if len(got) >= want:
                return got
            time.sleep(0.5)
        return got
    try:
        first = [("2", 0, "done"), ("3", 1, "gave_up")]
        assert state(2) == first                                              # nothing is due yet
        due = sorted(first + [("1", 1, "due"), ("4", 1, "due")])
        assert state(4) == due                                                # released without any new row
        spark.createDataFrame([("https://a/1", "520 Server Error: x", _at(2)), ("https://a/4", "https://web.archive.org/web/1/4", _at(2))],
                              schema).coalesce(1).write.parquet(str(tmp_path / "in/f1"))
        assert state(6) == sorted(due + [("1", 2, "gave_up"), ("4", 0, "done")])
        time.sleep(5)
        assert len(state(7, 1)) == 6                                          # closed URLs never ring again
    finally:
        q.stop()
