"""Set operations and de-duplication.

De-duplication is an aggregation with ``min(struct(...))``, not a window:
the aggregate combines map-side, so a key holding a third of all rows is
folded to one row per map task before the shuffle. ``dropDuplicates`` is not
used because it keeps an arbitrary row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsarc.functions import urls as U


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the smallest ``order`` tuple for each key (deterministic)."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.min(F.struct(*[F.col(c) for c in order + rest])).alias("_m")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col(f"_m.{c}").alias(c) for c in order + rest])


def distinct_links(links: DataFrame, keys: tuple[str, ...] = ("website_hash", "url"),
                   order: tuple[str, ...] = ("page_id", "pos")) -> DataFrame:
    """One row per (site, url): the first page and position it was found at."""
    return first_per_key(links, list(keys), list(order))


def union_candidates(feed: DataFrame, home: DataFrame) -> DataFrame:
    """Feed links, then home-page links; ``origin`` 0 = feed, 1 = home page."""
    return feed.withColumn("origin", F.lit(0)).unionByName(
        home.withColumn("origin", F.lit(1)), allowMissingColumns=True)


def new_urls(today: DataFrame, before: DataFrame) -> DataFrame:
    """Rows of today not in before (set difference, distinct)."""
    return today.subtract(before)


def kept_urls(today: DataFrame, before: DataFrame) -> DataFrame:
    """U4: rows in both (the ones U3 skips)."""
    return today.intersect(before)


def rounds_of(found: DataFrame, keys: tuple[str, ...] = ("website_hash",), url: str = "url",
              rnd: str = "page_id") -> DataFrame:
    """Per (keys, url) its ``first`` and ``last`` round, and the keys' ``latest`` round.

    One aggregate over the found rows; the latest round is taken from its result, with the same columns
    on both sides of the join, so the planner reads (and parses) the input once.
    """
    per = found.groupBy(*keys, url).agg(F.min(rnd).alias("first"), F.max(rnd).alias("last"))
    latest = per.groupBy(*keys).agg(F.max("last").alias("latest"), F.min("first").alias("_first"))
    return per.join(latest, list(keys)).where(F.col("_first") <= F.col("first")).drop("_first")


def new_in_latest(found: DataFrame, **names) -> DataFrame:
    """U3 over a history: URLs of each site's latest round that no earlier round had."""
    r = rounds_of(found, **names)
    return r.filter((F.col("last") == F.col("latest")) & (F.col("first") == F.col("last"))).drop("first", "last", "latest")


def kept_in_latest(found: DataFrame, **names) -> DataFrame:
    """U4 over a history: URLs of the latest round that an earlier round had too."""
    r = rounds_of(found, **names)
    return r.filter((F.col("last") == F.col("latest")) & (F.col("first") < F.col("last"))).drop("first", "last", "latest")


def dedup_normalized(df: DataFrame, url: str = "url", keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per normalized URL (P7), keeping the smallest original URL."""
    return df.groupBy(*keys, U.normalize_url(url).alias("norm_url")) \
        .agg(F.min(url).alias(url), F.count(F.lit(1)).alias("n_variants"))


def dedup_content(captures: DataFrame, digest: str = "digest",
                  order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """One capture per digest, the earliest by ``order``."""
    return first_per_key(captures, [digest], list(order))
