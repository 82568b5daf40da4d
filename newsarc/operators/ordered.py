"""Skew-safe ordered operations over key ranges: previous value, running sums,
row numbers, as-of lookup, sessions.

A window ``partitionBy(key).orderBy(ts)`` sends every row of a key to one
task; with one key holding a third of the rows that task holds a third of
the data. Here the order ``key + order`` is cut into ranges of about equal
size, so even the hottest key is spread over several ranges; each range does
the ordered work for the keys inside it (a window over ``(range, key)``).

The borders are a scalar subquery: a sorted array taken from the rows with the
smallest hashes (a bounded sample, the same in every evaluation). A row's range
is an expression of the row and that array, so nothing is checkpointed, no job
runs before the query itself and a retried task finds the same ranges. Only
the key at a border can reach into the next range: the carry table holds those
keys alone, at most two rows per range, which is why it may be broadcast. Keys
are compared null-safely throughout.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsarc.session import cut

SAMPLE_PER_RANGE = 16


def _cols(xs):
    return [F.col(x) for x in xs]


def _row(xs) -> Column:
    return F.struct(*_cols(xs))


def ranged(df: DataFrame, by: list[str], order: list[str], partitions: int | None = None) -> DataFrame:
    """``df`` plus its range ``_pid`` and ``_edge``: the key reaches over a border of some range.

    A row finds its range by binary search on the sorted borders (14 comparisons for 10,000
    ranges). The borders of its key are neighbours in that order, so the two around the row tell
    whether there is one.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = by + order
    sample = (df.select(_row(keys).alias("k"), F.xxhash64(*_cols(keys)).alias("h"))
              .orderBy("h", "k").limit(n * SAMPLE_PER_RANGE)
              .agg(F.array_sort(F.collect_list("k")).alias("b")))
    every = F.filter("b", lambda _, i: i % SAMPLE_PER_RANGE == SAMPLE_PER_RANGE - 1)
    borders = sample.select(every.alias("b")).scalar()
    out = df.withColumn("_borders", borders).withColumn("_key", _row(keys))
    steps = F.array(*[F.lit(1 << k) for k in range(n.bit_length(), -1, -1)])
    # the number of borders at or below the row; beyond the last border there is no comparison
    out = out.withColumn("_pid", F.aggregate(steps, F.lit(0), lambda lo, step: F.when(
        F.coalesce(F.get("_borders", lo + step - 1) <= F.col("_key"), F.lit(False)), lo + step).otherwise(lo)))

    def same(i: Column) -> Column:
        border = F.get("_borders", i)
        return border.isNotNull() & reduce(lambda x, y: x & y, [border[k].eqNullSafe(F.col(k)) for k in by])

    edge = same(F.col("_pid") - 1) | same(F.col("_pid")) if by else F.lit(True)
    return out.withColumn("_edge", edge).drop("_borders", "_key")


def _with_carry(local: DataFrame, carry: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """Left join of the carry columns on (range, key), null-safe; the carry is at most two rows per range."""
    c = carry.select(F.col("_pid").alias("_cp"), *[F.col(k).alias(f"_c_{k}") for k in by], *cols)
    on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_c_{k}")) for k in by], F.col("_pid") == F.col("_cp"))
    return local.join(F.broadcast(c), on, "left").drop("_cp", *[f"_c_{k}" for k in by])


def _before(by: list[str]):
    """All earlier ranges of the key (over the carry table)."""
    return Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)


def previous_value(df: DataFrame, by: list[str], order: list[str], value: str,
                   out: str = "prev", exists: str | None = None) -> DataFrame:
    """``lag(value)`` over ``partitionBy(by).orderBy(order)``; ``order`` makes rows unique.

    ``exists`` names a column that tells whether there is a previous row (its value may be NULL).
    """
    r = ranged(df, by, order)
    w = Window.partitionBy("_pid", *by).orderBy(*_cols(order))
    local = r.withColumn("_lag", F.lag(value).over(w)).withColumn("_first", F.row_number().over(w) == 1)
    last = r.filter("_edge").groupBy("_pid", *by).agg(
        F.max_by(F.struct(F.col(value).alias("v")), _row(order)).alias("_last"))
    carry = last.withColumn("_carry", F.last("_last").over(_before(by)))
    joined = _with_carry(local, carry, by, ["_carry"])
    joined = joined.withColumn(out, F.when(F.col("_first"), F.col("_carry.v")).otherwise(F.col("_lag")))
    if exists:
        joined = joined.withColumn(exists, ~F.col("_first") | F.col("_carry").isNotNull())
    return joined.drop("_lag", "_first", "_carry", "_pid", "_edge")


def running_sums(df: DataFrame, by: list[str], order: list[str], values: dict[str, str],
                 partitions: int | None = None) -> DataFrame:
    """Cumulative sums ``{out: column}`` over ``partitionBy(by).orderBy(order)``."""
    r = ranged(df, by, order, partitions)
    w = Window.partitionBy("_pid", *by).orderBy(*_cols(order)) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = r
    for o, src in values.items():
        local = local.withColumn(f"_l_{o}", F.sum(src).over(w))
    totals = r.filter("_edge").groupBy("_pid", *by).agg(*[F.sum(src).alias(f"_t_{o}") for o, src in values.items()])
    for o in values:
        totals = totals.withColumn(f"_b_{o}", F.sum(f"_t_{o}").over(_before(by)))
    joined = _with_carry(local, totals, by, [f"_b_{o}" for o in values])
    for o in values:
        joined = joined.withColumn(o, F.coalesce(F.col(f"_b_{o}"), F.lit(0)) + F.col(f"_l_{o}")) \
            .drop(f"_b_{o}", f"_l_{o}")
    return joined.drop("_pid", "_edge")


def ranked_by_range(df: DataFrame, order: list[str], by: list[str] | None = None,
                    partitions: int | None = None, out: str = "rn") -> DataFrame:
    """``row_number()`` over ``partitionBy(by).orderBy(order)`` for groups of any size.

    Inside a range the rows are numbered in order; each range adds the rows of
    its group in the ranges before it. ``order`` must make rows unique.
    """
    out_df = running_sums(df.withColumn("_one", F.lit(1)), by or [], order, {out: "_one"}, partitions)
    return out_df.withColumn(out, F.col(out).cast("long")).drop("_one")


def asof_by_range(left: DataFrame, right: DataFrame, by: list[str], on: str, value: str,
                  out: str = "match", partitions: int | None = None, once: bool = False) -> DataFrame:
    """As-of lookup: for each left row, the ``value`` of the last right row with
    ``right.on <= left.on`` in the same ``by`` group (ties of ``on`` go to the
    right row, among right rows to the largest ``value``).

    Lookups and facts are ranged together; each (range, group) forward-fills
    the last fact; the fact crossing into a range comes from the carry table.
    ``once`` writes both to the shared checkpoint folder first: for narrow rows that are costly
    to make (parsed out of bodies), since they are read four times.
    """
    r = right.select(*by, on, F.col(value).alias("_val")).withColumn("_kind", F.lit(0))
    l_ = left.withColumn("_kind", F.lit(1)).withColumn("_val", F.lit(None).cast(r.schema["_val"].dataType))
    both = l_.unionByName(r, allowMissingColumns=True)
    both = ranged(cut(both) if once else both, by, [on, "_kind"], partitions)
    w = Window.partitionBy("_pid", *by).orderBy(F.col(on), F.col("_kind"), F.col("_val")) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = both.withColumn("_local", F.last("_val", ignorenulls=True).over(w)).filter(F.col("_kind") == 1)
    per = both.filter(F.col("_edge") & (F.col("_kind") == 0)).groupBy("_pid", *by).agg(
        F.max_by(F.col("_val"), F.struct(F.col(on), F.col("_val"))).alias("_last"))
    # every range of a border key needs an entry, also those without a fact
    spans = both.filter("_edge").select("_pid", *by).distinct()
    key = reduce(lambda x, y: x & y, [spans[k].eqNullSafe(per[k]) for k in by], spans["_pid"] == per["_pid"])
    carry = spans.join(per, key, "left").select(spans["_pid"], *[spans[k] for k in by], "_last")
    carry = carry.withColumn("_carry", F.last("_last", ignorenulls=True).over(_before(by)))
    return _with_carry(local, carry, by, ["_carry"]) \
        .withColumn(out, F.coalesce("_local", "_carry")) \
        .drop("_kind", "_val", "_local", "_carry", "_pid", "_edge")


def sessions(df: DataFrame, key: str, ts: str, gap_seconds: int, tiebreak: str | None = None) -> DataFrame:
    """Session windows per key, as ``session_window(ts, gap)`` defines them.

    A row opens a session when the key's previous row is ``gap`` or more
    before it; the session id is the running count of openings. One window
    pass over each (range, key) counts the openings; for the keys at the
    borders the carry table settles whether a range's first row opens a session
    (against the last time of the key's earlier ranges) and how many sessions
    came before it. Sessions are finally an ordinary aggregate.
    """
    order = [ts] + ([tiebreak] if tiebreak else [])
    gap_us = gap_seconds * 1_000_000
    r = ranged(df.withColumn("_us", F.unix_micros(F.col(ts).cast("timestamp"))), [key], order)
    w = Window.partitionBy("_pid", key).orderBy(*_cols(order))
    opens = F.when(F.col("_us") - F.lag("_us").over(w) >= gap_us, 1).otherwise(0)
    rows = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = r.withColumn("_open", opens).withColumn("_cum", F.sum("_open").over(rows))
    per = local.filter("_edge").groupBy("_pid", key).agg(
        F.min("_us").alias("_first_us"), F.max("_us").alias("_last_us"), F.sum("_open").alias("_opens"))
    prev_last = F.lag("_last_us").over(Window.partitionBy(key).orderBy("_pid"))
    per = per.withColumn("_first_open", F.when(prev_last.isNull() | (F.col("_first_us") - prev_last >= gap_us), 1)
                         .otherwise(0))
    per = per.withColumn("_before", F.sum(F.col("_first_open") + F.col("_opens")).over(_before([key])))
    numbered = _with_carry(local, per, [key], ["_first_open", "_before"]).withColumn(
        "_sid", F.coalesce("_before", F.lit(0)) + F.coalesce("_first_open", F.lit(1)) + F.col("_cum"))
    return numbered.groupBy(key, "_sid").agg(
        F.min(ts).alias("session_start"),
        (F.max(ts) + F.make_dt_interval(secs=F.lit(gap_seconds))).alias("session_end"),
        F.count(F.lit(1)).cast("long").alias("events")).drop("_sid")
