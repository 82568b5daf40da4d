"""Joins (J1-J11).

No join carries a broadcast hint. The planner (with AQE) broadcasts a side
only when its measured size is under ``spark.sql.autoBroadcastJoinThreshold``;
beyond that it shuffles both sides, and AQE splits skewed partitions. Sides
are reduced to one row per key (``max_by``/``min``) before they are joined,
so no join multiplies rows of a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsarc.functions import urls as U
from newsarc.functions.records import archive_outcome
from newsarc.operators import ordered
from newsarc.operators.filters import enough_content_flag
from newsarc.session import cut


def latest_fetch(fetches: DataFrame, url: str = "url", ts: str = "fetched_at",
                 cols: tuple[str, ...] = ("status", "final_url")) -> DataFrame:
    """One row per URL: the values of its latest fetch (map-side combined).

    Of fetches at the same time the one with the largest values wins.
    """
    order = F.struct(F.col(ts), *[F.col(c) for c in cols if c != "body"])
    last = F.max_by(F.struct(*[F.col(c) for c in cols]), order).alias("_f")
    return fetches.groupBy(url).agg(last).select(url, *[F.col(f"_f.{c}").alias(c) for c in cols])


def attach_status(outlets: DataFrame, fetches: DataFrame, website: str = "website") -> DataFrame:
    """Outlets left-joined to the status of the last fetch of their website."""
    last = latest_fetch(fetches, cols=("status",)).withColumnRenamed("status", "website_status")
    return outlets.drop("website_status").join(
        last.withColumnRenamed("url", website), website, "left")


def drop_seen(candidates: DataFrame, seen: DataFrame,
              keys: tuple[str, ...] = ("website_hash", "url"),
              before: tuple[str, str] | None = None) -> DataFrame:
    """Candidates whose (site, url) is not in the seen set (left anti join).

    ``before=(cand_col, seen_col)`` keeps a candidate when the seen row is not
    earlier (``seen_col < cand_col`` means seen). The seen side is reduced to
    its earliest row per key first, so the anti join matches one row per key.
    """
    if before is None:
        return candidates.join(seen.select(*keys).distinct(), list(keys), "left_anti")
    cand_col, seen_col = before
    first = seen.groupBy(*keys).agg(F.min(seen_col).alias("_first_seen"))
    cond = [candidates[k] == first[k] for k in keys] + [first["_first_seen"] < candidates[cand_col]]
    return candidates.join(first, cond, "left_anti")


BLOOM_HASHES, BLOOM_BITS = 4, 1 << 15   # bits of one bitmap bucket (the size Spark's bitmap functions work in)


def _bloom_bits(keys: tuple[str, ...], buckets: int):
    """Array of the bits (numbers below ``buckets`` * 2^15) that a key sets."""
    return F.array(*[F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(i)), F.lit(buckets * BLOOM_BITS))
                     for i in range(BLOOM_HASHES)])


def seen_filter(seen: DataFrame, keys: tuple[str, ...] = ("website_hash", "url"), buckets: int = 64,
                day: str = "day") -> DataFrame:
    """A Bloom filter per day of the seen set, as rows (day, bucket, bitmap of 4 KB).

    Kept as a table beside the seen set; filters of a day are united with ``seen_filter_union``. With 64
    buckets (2 million bits, 256 KB) and 200,000 URLs a day, 1.2 % of the unseen look seen.
    """
    bits = seen.select(F.col(day).alias("day"), F.explode(_bloom_bits(keys, buckets)).alias("_bit"))
    return bits.groupBy("day", F.floor(F.col("_bit") / BLOOM_BITS).cast("int").alias("bucket")).agg(
        F.bitmap_construct_agg(F.pmod(F.col("_bit"), F.lit(BLOOM_BITS))).alias("bitmap"))


def seen_filter_union(filters: DataFrame) -> DataFrame:
    """One filter per day from several (those of batches, say)."""
    return filters.groupBy("day", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def drop_seen_filtered(candidates: DataFrame, seen: DataFrame, day_filter: DataFrame,
                       keys: tuple[str, ...] = ("website_hash", "url"), buckets: int = 64) -> DataFrame:
    """J2 with the day's filter: what it does not know is new and skips the anti join's shuffle.

    ``day_filter`` holds the rows (bucket, bitmap) of the days in ``seen``, at most ``buckets`` bitmaps of 4 KB,
    read by every task as one value. Same rows as ``drop_seen``.
    """
    packed = (day_filter.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
              .agg(F.map_from_entries(F.collect_list(F.struct("bucket", "bitmap"))).alias("m"))).select("m").scalar()

    def is_set(bit):
        place = F.pmod(bit, F.lit(BLOOM_BITS))
        byte = F.conv(F.hex(F.substring(F.try_element_at(F.col("_filter"), F.floor(bit / BLOOM_BITS).cast("int")),
                                        F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.coalesce(F.floor(byte / F.pow(F.lit(2), F.pmod(place, F.lit(8)))).cast("int") % 2 == 1, F.lit(False))

    named = candidates.withColumn("_filter", packed)
    maybe = F.forall(_bloom_bits(keys, buckets), is_set)
    known = named.withColumn("_maybe", maybe).drop("_filter")
    new = known.filter(~F.col("_maybe")).drop("_maybe")
    return new.unionByName(drop_seen(known.filter("_maybe").drop("_maybe"), seen, keys))


def known_domain(candidates: DataFrame, outlets: DataFrame, url: str = "url",
                 website: str = "website") -> DataFrame:
    """Keep links whose domain (P2) is the domain of a registered outlet."""
    domains = outlets.select(U.domain(F.col(website)).alias("_domain")).distinct()
    return candidates.withColumn("_domain", U.domain(F.col(url))) \
        .join(domains, "_domain", "left_semi").drop("_domain")


def expand_urls(candidates: DataFrame, fetches: DataFrame, url: str = "url",
                failed: str = "keep", out: str = "expanded_url") -> DataFrame:
    """The redirect target of each link from its latest fetch.

    Unknown URL, or fetch without a final URL: ``failed='keep'`` keeps the link
    (current collectors), ``failed='null'`` gives NULL (first collector).
    """
    last = latest_fetch(fetches, cols=("final_url",)).withColumnRenamed("url", "_furl")
    joined = candidates.join(last, candidates[url] == last["_furl"], "left")
    target = F.col("final_url")
    if failed == "keep":
        target = F.coalesce(target, F.col(url))
    elif failed != "null":
        raise ValueError("failed must be 'keep' or 'null'")
    return joined.withColumn(out, target).drop("_furl", "final_url")


def chain_ends(hops: DataFrame, url: str = "url", target: str = "target", max_hops: int | None = None) -> DataFrame:
    """(url, end, n_hops) for each URL that redirects: where its chain of single hops ends.

    ``hops`` has one row per URL (the latest fetch); a hop to itself or to nothing is none. A chain
    ends at the first URL without a hop, fetched or not. Chains that run into a loop have no end
    (NULL), nor have those over ``max_hops``. Every round joins the table with itself and doubles the
    distance covered, so n hops take log2(n) rounds, each cut in the shared folder. Distances to an
    end have no gaps: a round that finishes no further URL leaves loops only.
    """
    at = cut(hops.filter(F.col(target).isNotNull() & (F.col(target) != F.col(url)))
             .select(F.col(url).alias("url"), F.col(target).alias("_at"), F.lit(1).cast("long").alias("_n")))
    own = at.select(F.col("url").alias("_u"))
    at = cut(at.join(own, F.col("_at") == F.col("_u"), "left").select("url", "_at", "_n", F.col("_u").isNull().alias("_done")))
    finished = at.filter("_done").count()
    while True:
        ahead = at.select(F.col("url").alias("_u"), F.col("_at").alias("_at2"), F.col("_n").alias("_n2"),
                          F.col("_done").alias("_done2"))
        step = at.filter("NOT _done").join(ahead, F.col("_at") == F.col("_u")).select(
            "url", F.col("_at2").alias("_at"), (F.col("_n") + F.col("_n2")).alias("_n"), F.col("_done2").alias("_done"))
        at = cut(at.filter("_done").unionByName(step))
        now = at.filter("_done").count()
        if now == finished:
            break
        finished = now
    good = F.col("_done") if max_hops is None else F.col("_done") & (F.col("_n") <= max_hops)
    return at.select("url", F.when(good, F.col("_at")).alias("end"), F.when(good, F.col("_n")).alias("n_hops"))


def expand_chains(candidates: DataFrame, fetches: DataFrame, url: str = "url", failed: str = "keep",
                  out: str = "expanded_url", max_hops: int | None = 30) -> DataFrame:
    """J4 where ``fetches`` holds single hops: each link's end of its chain of redirects, and ``n_hops``.

    A link that does not redirect has 0 hops. One whose chain loops or is longer than ``max_hops`` failed
    and has NULL hops: ``failed='keep'`` keeps the link, ``failed='null'`` gives NULL. A link that was never
    fetched, or whose fetch names no final URL, is kept with 0 hops or is NULL in the same way.
    """
    if failed not in ("keep", "null"):
        raise ValueError("failed must be 'keep' or 'null'")
    last = latest_fetch(fetches, cols=("final_url",)).filter(F.col("final_url").isNotNull())
    stay = last.filter(F.col("final_url") == F.col("url")).select("url", F.col("url").alias("end"), F.lit(0).cast("long").alias("n_hops"))
    known = stay.unionByName(chain_ends(last, target="final_url", max_hops=max_hops)).select(
        F.col("url").alias("_furl"), F.col("end").alias("_end"), F.col("n_hops").alias("_hops"))
    joined = candidates.join(known, candidates[url] == known["_furl"], "left")
    end = F.coalesce("_end", F.col(url)) if failed == "keep" else F.col("_end")
    hops = F.when(F.col("_furl").isNotNull(), F.col("_hops")) if failed == "null" else \
        F.when(F.col("_furl").isNull(), 0).otherwise(F.col("_hops"))
    return joined.withColumn(out, end).withColumn("n_hops", hops.cast("long")).drop("_furl", "_end", "_hops")


def feed_for_outlet(outlets: DataFrame, html_feeds: DataFrame | None = None,
                    sitemap_feeds: DataFrame | None = None, website: str = "website") -> DataFrame:
    """Feeds of each outlet by the fallback chain, as rows ``(website, feed, pos)``.

    Own ``rss`` when not empty; else the feed declared in its HTML head
    (``html_feeds(website, feed)``); else the feed-like locations found in its
    sitemap (``sitemap_feeds(website, feed)``, built by J5's caller from
    sitemap.xml, sitemap_index.xml or the robots.txt sitemaps in that order).
    Feeds stay rows: a sitemap may name any number of them.
    """
    out = outlets.filter(F.size("rss") > 0).select(website, F.posexplode("rss").alias("pos", "feed")) \
        .groupBy(website, "feed").agg(F.min("pos").alias("pos"))
    for found in (html_feeds, sitemap_feeds):
        if found is not None:
            rows = found.join(outlets.select(website), website, "left_semi").select(website, "feed").distinct()
            fresh = rows.join(out.select(website).distinct(), website, "left_anti")
            out = out.unionByName(fresh.withColumn("pos", F.lit(0)))
    return out.select(website, "feed", "pos")


def record_captures(selected: DataFrame, archive_results: DataFrame, url: str = "url") -> DataFrame:
    """Only links the archive took become records (inner join on URL).

    The latest call per URL decides; its output is read by P14.
    """
    last = archive_results.groupBy("url").agg(
        F.max_by(F.col("output"), F.struct("called_at", "output")).alias("output"),
        F.max("called_at").alias("archived_time"))
    res = last.withColumn("_o", archive_outcome("output")) \
        .filter(F.col("_o.status") == "archived") \
        .select(F.col("url").alias("_aurl"), F.col("_o.archive_url").alias("archive_ref"),
                "archived_time")
    return selected.join(res, selected[url] == res["_aurl"], "inner").drop("_aurl")


def content_check(candidates: DataFrame, bodies: DataFrame, url: str = "url",
                  unit: str = "words", size: str = "content_size", ts: str | None = None) -> DataFrame:
    """Candidates left-joined to the size of their page text; no body -> rejected.

    ``bodies(url, content_size)`` carries the size computed at the scan, not
    the body, so the wide column never crosses the shuffle. With ``ts`` the
    latest fetch decides, else there must be one row per URL (the largest counts).
    """
    pick = F.max_by(F.col(size), F.struct(ts, size)) if ts else F.max(size)
    b = bodies.groupBy(url).agg(pick.alias(size))
    joined = candidates.join(b, url, "left")
    return joined.withColumn("has_content", enough_content_flag(F.col(size), unit))


def page_captures(pages: DataFrame, captures: DataFrame) -> DataFrame:
    """Each crawled page with its capture(s) (left join on collection and URL)."""
    cap = captures.select("collection", "url", F.col("ts").alias("capture_ts"), "status",
                          "mime", "digest", "length")
    return pages.drop("status", "mime").join(cap, ["collection", "url"], "left")


def page_resources(captures: DataFrame) -> DataFrame:
    """Resources joined to the page named in their referrer (outer on the page side).

    Captures without a referrer (pages themselves, most seeds) take no part in the join: they would
    all meet in one partition.
    """
    pages = latest_fetch(captures.withColumnRenamed("ts", "fetched_at"),
                         cols=("mime", "status")).select(
        F.col("url").alias("page_url"), F.col("mime").alias("page_mime"))
    named = captures.filter(F.col("referrer").isNotNull())
    found = named.join(pages, named["referrer"] == pages["page_url"], "left")
    rest = captures.filter(F.col("referrer").isNull())
    return found.unionByName(rest.withColumns({c: F.lit(None).cast(pages.schema[c].dataType) for c in pages.columns}))


def locate_block(keys: DataFrame, blocks: DataFrame, key: str = "urlkey") -> DataFrame:
    """The block of the second-level index whose key range holds each key.

    An as-of lookup on the sorted key: the last block starting at or before
    the key, over sampled key ranges (SURT keys share long prefixes such as
    ``com,``, so prefix buckets would put most keys in one task). Keys are made
    once (parsing links out of bodies is the costly part) and read back narrow.
    """
    k = keys.withColumn("_on", F.col(key))
    b = blocks.withColumn("_on", F.col("urlkey_from")) \
        .withColumn("_blk", F.struct("filename", "urlkey_from", "offset", "length"))
    return ordered.asof_by_range(k, b, [], "_on", "_blk", out="block", once=True).drop("_on")


def capture_as_of(requests: DataFrame, captures: DataFrame, key: str = "urlkey",
                  ts: str = "ts", value: tuple[str, ...] = ("ts", "digest")) -> DataFrame:
    """For each request, the latest capture of its URL at or before its time.

    Ranges of (urlkey, time) are sampled, so a URL with a third of all
    captures is still cut into balanced pieces.
    """
    c = captures.withColumn("_cap", F.struct(*[F.col(v) for v in value]))
    return ordered.asof_by_range(requests, c.select(key, ts, "_cap"), [key], ts, "_cap", out="capture")
