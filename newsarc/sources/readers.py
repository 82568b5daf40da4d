"""Readers (S1, S8-S12): the archive's files as typed DataFrames.

Every reader declares its schema (no inference) and reads with Spark's file
sources, so a directory of thousands of files is split over the cluster.
The collection (crawl) id comes from the file path (``_metadata.file_path``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsarc.functions.urls import cdx_time

# ------------------------------------------------------------------ schemas

OUTLET_JSON = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("website", T.StringType()),
    T.StructField("us-state", T.StringType()),
    T.StructField("media-class", T.StringType()),
    T.StructField("media-subclass", T.StringType()),
    T.StructField("city-county-name", T.StringType()),
    T.StructField("city-county-lat", T.DoubleType()),
    T.StructField("city-county-long", T.DoubleType()),
    T.StructField("rss", T.ArrayType(T.StringType())),
    T.StructField("open-search", T.ArrayType(T.StringType())),
    T.StructField("twitter", T.StringType()),
    T.StructField("facebook", T.StringType()),
    T.StructField("youtube", T.StringType()),
    T.StructField("video", T.StringType()),
    T.StructField("instagram", T.StringType()),
    T.StructField("wikipedia", T.StringType()),
    T.StructField("extracted-from", T.StringType()),
    T.StructField("website_status", T.IntegerType()),
    T.StructField("response_code", T.IntegerType()),
])
REGISTRY_JSON = T.MapType(T.StringType(), T.MapType(T.StringType(), T.ArrayType(OUTLET_JSON)))

FETCHES = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("final_url", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("fetched_at", T.TimestampType()),
    T.StructField("body", T.StringType()),
    T.StructField("error", T.StringType()),
])

CDX_JSON = T.StructType([T.StructField(n, T.StringType()) for n in (
    "url", "mime", "status", "digest", "length", "offset", "filename", "referrer", "method")])
BLOCK_JSON = T.StructType([
    T.StructField("offset", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("digest", T.StringType()), T.StructField("filename", T.StringType())])

CRAWL_PAGES = T.StructType([
    T.StructField("format", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("loadState", T.IntegerType()),
    T.StructField("ts", T.StringType()),
    T.StructField("mime", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("seed", T.BooleanType()),
    T.StructField("depth", T.IntegerType()),
    T.StructField("favIconUrl", T.StringType()),
])

CRAWL_LOG = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("logLevel", T.StringType()),
    T.StructField("context", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("details", T.StringType()),   # object or list, kept as JSON text
])

FRONTIER_ITEM = T.StructType([
    T.StructField("added", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("seedId", T.IntegerType()), T.StructField("depth", T.IntegerType()),
    T.StructField("extraHops", T.IntegerType())])

# Line layouts of the text files.
CDX_LINE = r"^(\S+) (\d{14}) (\{.*\})$"
SCRAPER_LINE = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}),(\d{3}) - ([A-Z]+) - (.*)$"
FRONTIER_LIST = r"^  ([A-Za-z]+):"
FRONTIER_JSON = r"^\s+- '(\{.*\})'\s*$"
FRONTIER_URL = r"^\s+- (\S+)\s*$"
ISO_MS = "yyyy-MM-dd'T'HH:mm:ss.SSSX"


def _collection(path_col="_metadata.file_path"):
    """Crawl collection id: the folder after ``collections/`` in the file path."""
    return F.regexp_extract(F.col(path_col), r"/collections/([^/]+)/", 1)


def _iso(col):
    return F.coalesce(F.try_to_timestamp(col, F.lit(ISO_MS)),
                      F.try_to_timestamp(col, F.lit("yyyy-MM-dd'T'HH:mm:ssX")))


# ------------------------------------------------------------------ readers

def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Nested registry JSON (plain or .gz) -> one row per outlet.

    One file is one JSON document, so each file is parsed by one task; the
    result is flat and distributed from there on (write it once with S2).
    """
    raw = spark.read.text(path, wholetext=True)
    parsed = raw.select(F.from_json("value", REGISTRY_JSON).alias("r"))
    states = parsed.select(F.explode("r").alias("state", "by_media"))
    media = states.select("state", F.explode("by_media").alias("media", "outlets"))
    flat = media.select("state", "media", F.explode("outlets").alias("o"))
    cols = [F.col(f"o.`{f.name}`").alias(f.name.replace("-", "_")) for f in OUTLET_JSON.fields
            if f.name not in ("website_status", "response_code", "extracted-from")]
    return flat.select(
        "state", "media", *cols,
        F.when(F.col("o.`extracted-from`").isNotNull(),
               F.transform(F.split(F.col("o.`extracted-from`"), ","), lambda x: F.trim(x)))
        .alias("extracted_from"),
        F.coalesce(F.col("o.website_status"), F.col("o.response_code")).alias("website_status"))


def read_fetches(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """S12 batch: fetch results (url, final_url, status, fetched_at, body, error)."""
    return spark.read.schema(FETCHES).format(fmt).load(path)


def stream_fetches(spark: SparkSession, path: str, fmt: str = "parquet",
                   max_files: int | None = None) -> DataFrame:
    """S12 / T1 stream: new fetch files as they land."""
    reader = spark.readStream.schema(FETCHES).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files: ``value`` and ``file_path``; what the ``*_rows`` functions split into columns."""
    return spark.read.text(path).select("value", "_metadata.file_path")


def _cdx_like(lines: DataFrame) -> DataFrame:
    return lines.select(
        _collection("file_path").alias("collection"),
        F.regexp_extract("value", CDX_LINE, 1).alias("urlkey"),
        F.regexp_extract("value", CDX_LINE, 2).alias("ts14"),
        F.regexp_extract("value", CDX_LINE, 3).alias("json"),
        "value")


def cdx_rows(lines: DataFrame) -> DataFrame:
    """S8 on lines (value, file_path): those of another form are left out, odd numbers are NULL."""
    c = _cdx_like(lines).filter(F.col("json") != "")
    j = F.from_json("json", CDX_JSON)
    return c.select(
        "collection", "urlkey", cdx_time("ts14").alias("ts"), j["url"].alias("url"),
        j["mime"].alias("mime"), j["status"].try_cast("int").alias("status"),
        j["digest"].alias("digest"), j["length"].try_cast("long").alias("length"),
        j["offset"].try_cast("long").alias("offset"), j["filename"].alias("filename"),
        j["referrer"].alias("referrer"), j["method"].alias("method"))


def read_cdx(spark: SparkSession, path: str) -> DataFrame:
    """Capture index lines ``urlkey ts14 {json}`` -> typed captures.

    Cookies and request bodies in the JSON are not read (not in the schema).
    """
    return cdx_rows(read_lines(spark, path))


def block_rows(lines: DataFrame) -> DataFrame:
    """S9 on lines (value, file_path)."""
    c = _cdx_like(lines).filter(~F.col("value").startswith("!") & (F.col("json") != ""))
    j = F.from_json("json", BLOCK_JSON)
    return c.select("collection", j["filename"].alias("filename"),
                    F.col("urlkey").alias("urlkey_from"), cdx_time("ts14").alias("ts"),
                    j["offset"].alias("offset"), j["length"].alias("length"), j["digest"].alias("digest"))


def read_block_index(spark: SparkSession, path: str) -> DataFrame:
    """Second-level index (``!meta`` line skipped): one row per block."""
    return block_rows(read_lines(spark, path))


def read_crawl_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page lists; header rows dropped, ``seed`` false when missing."""
    df = spark.read.schema(CRAWL_PAGES).json(path).withColumn("_p", F.col("_metadata.file_path"))
    return df.filter(F.col("format").isNull()).select(
        _collection("_p").alias("collection"), "id", "url", "title", "loadState",
        _iso(F.col("ts")).alias("ts"), "mime", "status",
        F.coalesce("seed", F.lit(False)).alias("seed"), "depth", "favIconUrl")


def crawl_log_rows(lines: DataFrame) -> DataFrame:
    """S11 on JSON lines (value, file_path); a line that is no JSON gives NULL fields, blank lines none."""
    j = lines.filter(F.trim("value") != "").select(_collection("file_path").alias("collection"),
                                                   F.from_json("value", CRAWL_LOG).alias("j"))
    return j.select("collection", _iso(F.col("j.timestamp")).alias("timestamp"), "j.logLevel", "j.context", "j.message",
                    "j.details", F.get_json_object("j.details", "$.page").alias("page"))


def read_crawl_log(spark: SparkSession, path: str) -> DataFrame:
    """JSON crawl log; ``details`` (object or list) kept as JSON text."""
    return crawl_log_rows(read_lines(spark, path))


def scraper_log_rows(lines: DataFrame) -> DataFrame:
    """S11 on text lines (value)."""
    stamp = F.concat(F.regexp_extract("value", SCRAPER_LINE, 1), F.lit("."),
                     F.regexp_extract("value", SCRAPER_LINE, 2))
    return lines.filter(F.col("value").rlike(SCRAPER_LINE)).select(
        F.try_to_timestamp(stamp, F.lit("yyyy-MM-dd HH:mm:ss.SSS")).alias("ts"),
        F.regexp_extract("value", SCRAPER_LINE, 3).alias("level"),
        F.regexp_extract("value", SCRAPER_LINE, 4).alias("message"))


def read_scraper_log(spark: SparkSession, path: str) -> DataFrame:
    """``asctime - LEVEL - message`` text log of a collector run."""
    return scraper_log_rows(read_lines(spark, path))


def read_frontier(spark: SparkSession, path: str) -> DataFrame:
    """Crawl state files -> (collection, list, url, added, seed_id, depth, extra_hops).

    The files are read line by line (a frontier can hold millions of queued
    URLs, so a file is never one task). A line's place in its file is (start
    of its split, row id inside the split); every item takes the list header
    above it by an as-of lookup over range partitions of those places.
    """
    return frontier_rows(spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("_file"),
        F.struct(F.col("_metadata.file_block_start").alias("b"),
                 F.monotonically_increasing_id().alias("n")).alias("_at")))


def frontier_rows(lines: DataFrame) -> DataFrame:
    """The same on lines (line, _file, _at), where ``_at`` orders the lines of a file."""
    from newsarc.operators.ordered import asof_by_range

    headers = lines.filter(F.col("line").rlike(FRONTIER_LIST)) \
        .select("_file", "_at", F.regexp_extract("line", FRONTIER_LIST, 1).alias("_list"))
    items = lines.filter(F.col("line").rlike(r"^\s+- "))
    tagged = asof_by_range(items, headers, ["_file"], "_at", "_list", out="list") \
        .withColumn("collection", _collection("_file"))
    js = F.from_json(F.regexp_extract("line", FRONTIER_JSON, 1), FRONTIER_ITEM)
    is_json = F.col("line").rlike(FRONTIER_JSON)
    return tagged.select(
        "collection", "list",
        F.when(is_json, js["url"]).otherwise(F.regexp_extract("line", FRONTIER_URL, 1)).alias("url"),
        F.when(is_json, _iso(js["added"])).alias("added"),
        F.when(is_json, js["seedId"]).alias("seed_id"),
        F.when(is_json, js["depth"]).alias("depth"),
        F.when(is_json, js["extraHops"]).alias("extra_hops"))
