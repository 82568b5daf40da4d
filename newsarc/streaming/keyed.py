"""Low-latency forms of T3 and T8: state per key inside the stream, no table read per batch.

The state of a site's round is one number, that of a URL two. Both live in the stream's state
store (checkpointed with it), so a restarted query goes on where it stopped. ``applyInPandasWithState``
deals the rows by key: rows of one key in one micro-batch meet in one task, which reads them piece by
piece and holds no more than the answer.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import IntegerType, StructField, StructType

from newsarc.functions.records import archive_outcome


def best_rows(parts: Iterable[pd.DataFrame], n: int, order: list[str]) -> pd.DataFrame | None:
    """The first ``n`` rows of all parts in ``order`` (nulls last); never more than one part and n rows at once."""
    best = None
    for part in parts:
        rows = part if best is None else pd.concat([best, part], ignore_index=True)
        best = rows.sort_values(order, na_position="last", kind="stable").head(n)
    return best


def stream_cap(df: DataFrame, n: int = 5, site: str = "website_hash", rnd: str = "round",
               order: tuple[str, ...] = ("origin", "feed_pos", "entry_pos", "url"),
               ts: str = "seen_at", delay: str = "1 day", keep: str = "1 day") -> DataFrame:
    """At most ``n`` links per site and round as a stream, with ``rank`` (1 to n).

    A counter per (site, round) is the state. Inside a micro-batch the links are taken in ``order``; what
    earlier batches took stays. A counter expires ``keep`` after the watermark its round was last
    seen at; rows later than the watermark are dropped, so an expired round cannot start anew.
    """
    schema = StructType([*df.schema.fields, StructField("rank", IntegerType())])
    names = [f.name for f in schema.fields]
    keep_ms = int(pd.Timedelta(keep).total_seconds() * 1000)
    by = list(order)

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        used = state.get[0] if state.exists else 0
        best = best_rows(parts, max(0, n - used), by) if used < n else None
        taken = 0 if best is None else len(best)
        state.update((used + taken,))
        state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs(), 0) + keep_ms)
        if taken:
            best = best.reset_index(drop=True)
            best["rank"] = range(used + 1, used + taken + 1)
            yield best[names]

    return (df.withWatermark(ts, delay).groupBy(site, rnd)
            .applyInPandasWithState(step, schema, "used int", "append", GroupStateTimeout.EventTimeTimeout))


def retry_step(tries: int, outcomes: list[tuple[bool, bool]], max_tries: int) -> tuple[int, str | None]:
    """(tries, what follows) after the outcomes (archived, retryable) of a URL's calls, in order.

    ``done`` and ``gave_up`` close the URL, ``wait`` asks for a timer; None: nothing happened.
    """
    last = None
    for archived, retryable in outcomes:
        if archived:
            tries, last = 0, "done"
        else:
            tries = (0 if last in ("done", "gave_up") else tries) + 1
            last = "wait" if retryable and tries < max_tries else "gave_up"
    return tries, last


def stream_retry(results: DataFrame, delay: str = "60 minutes", max_tries: int = 3, keep: str = "7 days") -> DataFrame:
    """Failed archive calls come back by themselves: rows (url, tries, state, released_at).

    ``results`` are archive results (url, output, called_at). A retryable failure (P14) with tries left
    sets a timer; when it rings the URL is released as ``due`` and its count of tries is kept until the
    result of that call arrives, or for ``keep`` if none does. Other failures leave as ``gave_up``, a success
    as ``done``; both forget the URL. A later result before the timer rings replaces it.
    """
    delay_ms, keep_ms = (int(pd.Timedelta(x).total_seconds() * 1000) for x in (delay, keep))
    o = results.withColumn("_o", archive_outcome("output")).filter(F.col("_o.status").isin("archived", "failed")).select(
        "url", "called_at", (F.col("_o.status") == "archived").alias("archived"),
        F.coalesce(F.col("_o.retryable"), F.lit(False)).alias("retryable"))

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        def row(tries, what):
            return pd.DataFrame({"url": [key[0]], "tries": [tries], "state": [what],
                                 "released_at": [pd.Timestamp(state.getCurrentProcessingTimeMs(), unit="ms")]})
        if state.hasTimedOut:
            tries, waiting = state.get
            if not waiting:            # released long ago and never answered
                state.remove()
                return
            state.update((tries, False))
            state.setTimeoutDuration(keep_ms)
            yield row(tries, "due")
            return
        calls = pd.concat(list(parts), ignore_index=True).sort_values(["called_at", "archived"], kind="stable")
        tries, what = retry_step(state.get[0] if state.exists else 0,
                                 list(zip(calls["archived"], calls["retryable"])), max_tries)
        if what == "wait":
            state.update((tries, True))
            state.setTimeoutDuration(delay_ms)
        else:
            if state.exists:
                state.remove()
            yield row(tries, what)

    return o.groupBy("url").applyInPandasWithState(
        step, "url string, tries int, state string, released_at timestamp", "tries int, waiting boolean", "append",
        GroupStateTimeout.ProcessingTimeTimeout)
