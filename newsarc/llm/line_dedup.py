"""Removal of repeated passages of whole lines, in any document and across line breaks.

A line is a clause: text up to line breaks or to sentence punctuation and a
blank, both kept, so the lines of a text join to exactly that text.

``dedup_passages`` (the registered query): a passage is a run of neighbouring
lines with ``MIN_WORDS`` words or more that stands earlier too (smaller document,
then place), and all its lines go, wherever it begins and ends, over line breaks
and blank lines. Chunks are windows over the line hashes whose borders the content
chooses: the shortest run of lines with ``MIN_WORDS`` words from each line on, and the
shortest one up to each line. They depend on the lines inside alone (an insertion
shifts no other window), all windows of a repeated passage are repeated, and
together they cover it. A text as a whole is one more chunk, so a copy is one run.
Repeated windows are found by a 64-bit hash on narrow rows and their places joined
to the first one; overlapping ones with the same original become one run. A document
then meets each of its originals once, gets the original's bytes for its runs, and a
run goes only where its bytes are equal (but for blanks and line breaks at the end,
which a text's last line may lack). A run that overlaps its own original in one text
stays, so of a line repeated without end the first ``MIN_WORDS`` words remain. Blank
lines between two runs may stay. Each line that goes stands at an earlier place too,
so no text vanishes from the table.

``dedup_lines`` (not registered) cuts disjoint chunks at local minima of a cyclic
rolling hash over the hashes of ``WINDOW`` neighbouring lines. Such borders leave
repeated short lines and passages that hold no whole chunk: of 51-word passages inside
paragraphs more than half stayed, which is why the windows above have every line as a
border.

DataFrame functions only; the whole text crosses two shuffles by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsarc.llm.common import cut, drop, written

WINDOW = 2
MIN_WORDS = 20
_MARK = "\x01"
WHOLE = -1          # the place of a text as a whole
_END = "[\n.,;:!?](?:(?<=\n)| )\n*+"                 # what ends a line, with the line breaks behind; it belongs to the line
_LINE = r"(?<=\n)(?!\n)|(?<=[.,;:!?] )(?!\n)"       # the same as a place, for texts that hold the mark


def _rotated(h: Column, by: int) -> Column:
    return F.shiftleft(h, by).bitwiseOR(F.shiftrightunsigned(h, 64 - by)) if by else h


def _bare(x: Column) -> Column:
    """Without the blanks and line breaks at the end, which the last line of a text may lack."""
    return F.rtrim(x, F.lit(" \n"))


def _lines(t: Column) -> Column:
    # one pass over the text: the pattern looks back at ends alone, where ``_LINE`` does at each character
    marked = F.regexp_replace(t, _END, "$0" + _MARK)
    pieces = F.when(t.contains(_MARK), F.split(t, _LINE, -1)).otherwise(F.split(marked, _MARK, -1))
    return F.array_remove(pieces, "")


def with_chunks(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``_lines``, their ``_hashes`` and ``_ends`` (the last line of each chunk) of the text."""
    out = docs.withColumn("_lines", _lines(F.col(text)))
    out = out.withColumn("_hashes", F.transform("_lines", lambda x: F.xxhash64(_bare(x))))
    out = out.withColumn("_last", F.transform("_lines", lambda x, i: x.endswith("\n") | (i == F.size("_lines") - 1)))
    def rolling(h: Column, i: Column) -> Column:
        value, open_ = h, F.lit(True)
        for back in range(1, WINDOW):
            open_ = open_ & ~F.coalesce(F.get("_last", i - back), F.lit(True))  # do not look past a paragraph end
            value = F.when(open_, value.bitwiseXOR(_rotated(F.get("_hashes", i - back), back))).otherwise(value)
        return value
    out = out.withColumn("_roll", F.transform("_hashes", rolling))
    def border(i: Column) -> Column:
        inner = (~F.coalesce(F.get("_last", i - 1), F.lit(True)) & ~F.coalesce(F.get("_last", i + 1), F.lit(True))
                 & (F.get("_roll", i) < F.get("_roll", i - 1)) & (F.get("_roll", i) < F.get("_roll", i + 1)))
        return F.get("_last", i) | F.coalesce(inner, F.lit(False))
    places = F.when(F.size("_lines") > 0, F.sequence(F.lit(0), F.size("_lines") - 1))
    return out.withColumn("_ends", F.filter(places, border)).drop("_last", "_roll")


def _start(no: Column) -> Column:
    return F.when(no > 0, F.get("_ends", no - 1) + 1).otherwise(0)


def _chunk(no: Column) -> Column:
    """Text of chunk ``no`` without blanks and line breaks at its end; null beyond the last one."""
    return _bare(_whole_chunk(no))


def _whole_chunk(no: Column) -> Column:
    return F.array_join(F.slice("_lines", _start(no) + 1, F.get("_ends", no) - _start(no) + 1), "")


def _chunk_hash(no: Column) -> Column:
    return F.xxhash64(F.slice("_hashes", _start(no) + 1, F.get("_ends", no) - _start(no) + 1))


def _words(chunk: Column) -> Column:
    return F.length(chunk) - F.length(F.replace(chunk, F.lit(" "), F.lit(""))) + 1


def dedup_lines(docs: DataFrame, text: str = "text", ident: str = "doc_id", min_words: int = MIN_WORDS,
                prefix: str = "") -> DataFrame:
    """``docs`` with the repeated chunks cut out of ``text``, plus removed_chunks and removed_words.

    Every row stays; a document that consists of repeated chunks ends with an
    empty text, null stays null. Rows with the same id are one document given
    twice (a null id is named by its text), so their chunks do not count as
    repeats of each other, only of earlier documents. Columns of ``docs`` that clash with the
    two added ones (``prefix`` stands before both) are replaced.
    """
    own = [c for c in docs.columns if c not in (f"{prefix}removed_chunks", f"{prefix}removed_words")]
    keyed = docs.select(*[F.col(f"`{c}`") for c in own],
                        F.coalesce(F.col(ident).cast("long"), F.xxhash64(text)).alias("_k"))
    split = with_chunks(keyed.select("_k", F.col(text).alias("_t")), "_t")
    number = F.transform("_ends", lambda e, i: F.struct(i.alias("no"), (e - _start(i) + 1).alias("n")))
    chunks = split.select("_k", F.explode(F.transform(
        F.filter(number, lambda c: (c["n"] > 1) | (_words(_chunk(c["no"])) >= min_words)),
        lambda c: F.struct(c["no"].alias("no"), _chunk_hash(c["no"]).alias("hash")))).alias("c"))
    chunks = written(chunks.select("_k", "c.no", "c.hash"), "line-chunks")   # two numbers and a place per chunk

    # repeats by hash, on narrow rows
    repeated = cut(chunks.groupBy("hash").agg(F.count("*").alias("times")).where("times > 1").select("hash"))
    places = cut(chunks.join(repeated.hint("shuffle_merge"), "hash"))
    first = cut(places.groupBy("hash").agg(F.min(F.struct("_k", "no")).alias("f")).select("hash", "f._k", "f.no"))

    # the text of each first occurrence
    wanted = first.groupBy("_k").agg(F.collect_list(F.struct("no", "hash")).alias("_want"))
    kept = (with_chunks(keyed.select("_k", F.col(text).alias("_t")).join(wanted, "_k"), "_t")
            .select(F.explode(F.transform("_want", lambda w: F.struct(
                w["hash"].alias("hash"), F.when(_chunk_hash(w["no"]) == w["hash"], _chunk(w["no"])).alias("same")))).alias("w"))
            .select("w.hash", "w.same").where("same IS NOT NULL"))
    kept = written(kept.groupBy("hash").agg(F.min("same").alias("same")).withColumn("words", _words(F.col("same"))),
                   "line-originals")

    # later occurrences, in runs of neighbouring chunks
    originals = cut(first.select("hash", F.col("_k").alias("_fk"), F.col("no").alias("_fno"))
                    .join(kept.select("hash", "words"), "hash"))
    # both sides are plain exchanges below the join: a chunk with very many places is split by measured size
    later = (places.join(originals.hint("shuffle_merge"), "hash")
             .where((F.col("_k") != F.col("_fk")) | (F.col("no") != F.col("_fno"))))
    # narrow rows of a document together: one exchange serves the windows below
    run = ["_k", "_fk", "_off", "_run"]
    later = (later.repartition("_k").dropDuplicates(["_k", "no"]).withColumn("_off", F.col("_fno") - F.col("no"))
             .withColumn("_run", F.col("no") - F.row_number().over(Window.partitionBy(run[:3]).orderBy("no")))
             .withColumn("_size", F.sum("words").over(Window.partitionBy(run)))
             .withColumn("start", F.min("no").over(Window.partitionBy(run)))
             .where(F.col("_size") >= min_words).select("hash", *run, "start", "no"))
    # only now their text, which crosses one exchange
    runs = (later.join(kept.select("hash", "same").hint("shuffle_merge"), "hash").repartition("_k")
            .groupBy(*run, "start").agg(F.sort_array(F.collect_list(F.struct("no", "same"))).alias("same"))
            .groupBy("_k").agg(F.collect_list(F.struct("start", F.col("same.same").alias("same"))).alias("_runs")))

    joined = with_chunks(keyed.join(runs, "_k", "left").withColumn("_t", F.when(F.col("_runs").isNotNull(), F.col(text))), "_t")
    # byte comparison: a chunk goes only where its bytes equal the first occurrence's
    gone = F.filter(F.transform("_ends", lambda e, i: i), lambda no: F.exists(
        "_runs", lambda r: F.coalesce(F.get(r["same"], no - r["start"]) == _chunk(no), F.lit(False))))
    marked = joined.withColumn("_gone", F.when(F.col("_runs").isNotNull(), gone))
    rest = F.array_join(F.transform(F.array_except(F.transform("_ends", lambda e, i: i), F.col("_gone")), _whole_chunk), "")
    changed = F.col("_runs").isNotNull()
    return marked.select(
        *[F.when(changed, rest).otherwise(F.col(text)).alias(text) if c == text else F.col(f"`{c}`") for c in own],
        F.when(changed, F.size("_gone")).otherwise(0).alias(f"{prefix}removed_chunks"),
        F.when(changed, F.aggregate("_gone", F.lit(0), lambda s, no: s + _words(_chunk(no)))).otherwise(0).alias(f"{prefix}removed_words"))


def _odd(t: Column) -> Column:
    """Does a text hold white space other than one blank between words or line breaks after them?"""
    return (t.contains("  ") | t.contains("\t") | t.contains("\r") | t.contains("\n ") | t.startswith(" ")
            | t.startswith("\n"))


def _line_words(bare: Column, odd: Column) -> Column:
    """Words of a line without blanks and line breaks at its end, of a text that is ``odd`` or not."""
    return (F.when(odd, F.size(F.filter(F.split(bare, "[ \t\r\n]+"), lambda w: w != "")))
            .when(bare == "", 0).otherwise(_words(bare)))


def _plain_bare(x: Column) -> Column:
    """``_bare`` of a line of a text that is not odd: blanks and line breaks stand only at its end."""
    return F.rtrim(F.when(x.endswith("\n"), F.replace(x, F.lit("\n"), F.lit(" "))).otherwise(x))


def _plain_words(bare: Column) -> Column:
    return F.when(bare == "", 0).otherwise(F.octet_length(bare) - F.octet_length(F.replace(bare, F.lit(" "), F.lit(""))) + 1)


def _plain_sum(lines: Column) -> Column:
    """Words of these lines of a text that is not odd: a line with words has a blank less than words, but for one at its end."""
    joined = F.array_join(lines, "")
    blanks = F.octet_length(joined) - F.octet_length(F.replace(joined, F.lit(" "), F.lit("")))
    at_end = F.filter(lines, lambda x: F.when(x.endswith("\n"), x.contains(" \n")).otherwise(x.endswith(" ")))
    return F.size(lines) + blanks - F.size(at_end)


def _part(start: Column, end: Column) -> Column:
    """Text of the lines start to end, the last one without blanks and line breaks at its end (it holds words)."""
    return F.concat(F.array_join(F.slice("_lines", start + 1, end - start), ""), _bare(F.get("_lines", end)))


def _from(c: Column) -> Column:
    """The first line of place ``c``, which holds the numbers of two lines."""
    return F.shiftright(c, 32).cast("int")


def _to(c: Column) -> Column:
    return c.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")


def _windows(docs: DataFrame, text: str, min_words: int) -> DataFrame:
    """One row (_k, c, hash) per shortest run of lines with ``min_words`` words from or up to a line; c is its place.

    One row more, with the place ``WHOLE``, names a text of that many words by its own hash. Arrays by
    line are made first; what is done for each window runs in generated code behind ``explode``.
    """
    t = F.col(text)
    # no filter stands above the arrays: it would be pushed below them and make them twice
    out = docs.where(t.isNotNull()).select("_k", F.xxhash64(t).alias("_text"), _odd(t).alias("_odd"), _lines(t).alias("_lines"))
    out = out.select("_k", "_text", "_odd", F.transform("_lines", lambda x: F.xxhash64(x)).alias("_whole"),
                                     F.when(F.col("_odd"), F.transform("_lines", _bare)).otherwise(F.transform("_lines", _plain_bare)).alias("_bare"))
    count = F.when(F.col("_odd"), F.transform("_bare", lambda b: _line_words(b, F.lit(True)))).otherwise(
        F.transform("_bare", _plain_words))
    out = out.select("_k", "_text", "_whole", F.transform("_bare", lambda b: F.xxhash64(b)).alias("_hashes"), count.alias("_n"))
    out = out.select("_k", "_text", "_whole", "_hashes", "_n",
                     F.flatten(F.transform("_n", lambda n, i: F.array_repeat(i, n))).alias("_of"))    # the line of each word
    # a row per line with words: the number of its first word and its own
    of = lambda w: F.get("_of", w)
    out = out.select("*", F.posexplode(F.when(F.size("_of") >= min_words, F.col("_of"))).alias("_w", "_i"))
    out = out.where(~of(F.col("_w") - 1).eqNullSafe(F.col("_i")))
    line, at = F.col("_i"), F.col("_w")
    first = of(at + F.get("_n", line) - min_words)   # where the run up to this line begins
    same = of(at - min_words)                        # unless it holds that word too, the run from there ends here
    out = out.select("_k", "_text", "_whole", "_hashes", F.inline(F.array(
        F.struct(line.alias("s"), of(at + (min_words - 1)).alias("e")),
        F.struct(F.when(same == first, first).alias("s"), line.alias("e")),
        F.struct(F.when(at == 0, WHOLE).alias("s"), F.lit(WHOLE).alias("e")))))
    # the last line counts without what stands at its end, those before it whole
    s, e = F.col("s"), F.col("e")
    run = F.xxhash64(F.slice("_whole", s + 1, e - s), F.get("_hashes", e))
    return out.where(s.isNotNull() & e.isNotNull()).select(
        "_k", F.when(s == WHOLE, F.lit(WHOLE).cast("long")).otherwise(F.shiftleft(s.cast("long"), 32).bitwiseOR(e.cast("long"))).alias("c"),
        F.when(s == WHOLE, F.col("_text")).otherwise(run).alias("hash"))


def _with_bytes(runs: DataFrame, texts: DataFrame) -> DataFrame:
    """(_k, _runs): the runs of each document with the bytes of their originals, by (document, original).

    The originals' lines are split once; a document meets each of its originals in one row,
    and an original that very many documents repeat is split by measured size below the join.
    """
    pairs = written(runs.groupBy("_k", "_fk").agg(F.collect_list(F.struct("s", "e", "_fs", "_fe")).alias("_r")), "line-pairs")
    wanted = pairs.select(F.col("_fk").alias("_k")).distinct()
    # hinted, so that a small corpus takes the way of a large one; the ids are hashed, so no text is sorted
    originals = written(texts.join(wanted.hint("shuffle_hash"), "_k", "left_semi")
                        .select(F.col("_k").alias("_fk"), _lines(F.col("_t")).alias("_lines")), "line-originals")
    bytes_ = lambda r: F.when(r["_fs"] == WHOLE, F.array_join("_lines", "")).otherwise(_part(r["_fs"], r["_fe"]))
    return (pairs.join(originals.hint("shuffle_merge"), "_fk")
            .select("_k", F.transform("_r", lambda r: F.struct(
                r["s"].alias("s"), r["e"].alias("e"), bytes_(r).alias("bytes"))).alias("r"))
            .groupBy("_k").agg(F.flatten(F.collect_list("r")).alias("_runs")))


def dedup_passages(docs: DataFrame, text: str = "text", ident: str = "doc_id", min_words: int = MIN_WORDS,
                   prefix: str = "") -> DataFrame:
    """``docs`` with the repeated passages cut out of ``text``, plus removed_chunks and removed_words.

    removed_chunks counts the stretches of neighbouring lines that went. Every
    row stays; a document that consists of repeated passages ends with an empty
    text, null stays null. Rows with the same id are one document given twice (a
    null id is named by its text), so their passages do not count as repeats of
    each other, only of earlier places. Columns of ``docs`` that clash with the
    two added ones (``prefix`` stands before both) are replaced.
    """
    own = [c for c in docs.columns if c not in (f"{prefix}removed_chunks", f"{prefix}removed_words")]
    keyed = docs.select(*[F.col(f"`{c}`") for c in own],
                        F.coalesce(F.col(ident).cast("long"), F.xxhash64(text)).alias("_k"))
    texts = keyed.select("_k", F.col(text).alias("_t"))
    windows = written(_windows(texts, "_t", min_words), "line-windows")   # three numbers per window

    # repeats by hash, on narrow rows. The smaller sides have a row per key and are hashed, and a first place is found in
    # two steps (its document, its place there) over numbers, so nothing is sorted; a window with very many places is
    # split by measured size below the joins
    repeated = written(windows.groupBy("hash").agg(F.count("*").alias("times"), F.min("_k").alias("_fk"))
                       .where("times > 1").select("hash", "_fk"), "line-repeats")
    places = written(windows.join(repeated.hint("shuffle_hash"), "hash"), "line-places")
    drop(windows, repeated)
    first = written(places.where("_k = _fk").groupBy("hash").agg(F.min("_fk").alias("_fk"), F.min("c").alias("_fc")),
                    "line-firsts")
    later = places.drop("_fk").join(first.hint("shuffle_hash"), "hash")
    whole = written(later.where((F.col("c") == WHOLE) & (F.col("_fc") == WHOLE) & (F.col("_k") != F.col("_fk")))
                    .select("_k", "_fk").distinct(), "line-copies")
    # a later copy of a whole text needs no other run, unless its id stands at other texts too
    ids = docs.select(F.col(ident).cast("long").alias("_k")).where("_k IS NOT NULL")
    copies = (whole.select("_k").distinct()
              .join(ids.groupBy("_k").agg(F.count("*").alias("n")).where("n > 1"), "_k", "left_anti"))
    parts = (later.where((F.col("c") != WHOLE) & (F.col("_fc") != WHOLE))
             .select("_k", "_fk", _from(F.col("_fc")).alias("_fs"), _from(F.col("c")).alias("s"), _to(F.col("c")).alias("e"))
             .where((F.col("_k") != F.col("_fk")) | (F.col("s") > F.col("_fs") + F.col("e") - F.col("s")))
             .select("_k", "_fk", (F.col("_fs") - F.col("s")).alias("_off"), "s", "e")
             .join(copies.hint("shuffle_hash"), "_k", "left_anti"))

    # overlapping windows with the same original are one run; the exchange by document above serves both steps
    same = ["_k", "_fk", "_off"]
    order = Window.partitionBy(*same).orderBy("s", "e")
    # a run ends where the windows before the next one's first do, so only the first windows pass on
    runs = (parts.withColumn("_before", F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1)))
            .withColumn("_last", F.max("e").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
            .where(F.col("_before").isNull() | (F.col("s") > F.col("_before")))
            .withColumn("e", F.coalesce(F.lead("_before").over(order), F.col("_last")))
            .select("_k", "_fk", "s", "e", (F.col("s") + F.col("_off")).alias("_fs"), (F.col("e") + F.col("_off")).alias("_fe")))
    all_ = F.lit(WHOLE)
    runs = runs.unionByName(whole.select("_k", "_fk", all_.alias("s"), all_.alias("e"), all_.alias("_fs"), all_.alias("_fe")))
    found = _with_bytes(runs, texts)   # it leaves two tables behind, which the result reads
    drop(places, first, whole)

    # a run goes where its bytes equal the original's
    joined = (keyed.join(found.hint("shuffle_merge"), "_k", "left").withColumn("_odd", F.when(F.col("_runs").isNotNull(), _odd(F.col(text))))
              .withColumn("_lines", F.when(F.col("_runs").isNotNull(), _lines(F.col(text)))))
    last = F.size("_lines") - 1
    equal = F.filter("_runs", lambda r: F.when(r["s"] == WHOLE, r["bytes"] == F.col(text)).otherwise(_part(r["s"], r["e"]) == r["bytes"]))
    marked = joined.withColumn("_equal", equal).withColumn("_all", F.exists("_equal", lambda r: r["s"] == WHOLE))
    marked = marked.withColumn("_gone", F.when(F.col("_all"), F.sequence(F.lit(0), last)).otherwise(F.sort_array(F.array_distinct(
        F.flatten(F.transform("_equal", lambda r: F.sequence(r["s"], r["e"])))))))
    rest = F.when(F.col("_all"), "").otherwise(F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), last), F.col("_gone")), lambda i: F.get("_lines", i)), ""))
    stretches = F.size(F.filter("_gone", lambda g, i: (i == 0) | (F.get("_gone", i - 1) != g - 1)))
    cuts = F.when(F.col("_all"), F.col("_lines")).otherwise(F.transform("_gone", lambda i: F.get("_lines", i)))
    changed = F.col("_runs").isNotNull()
    return marked.withColumn("_cuts", F.when(changed, cuts)).select(
        *[F.when(changed, rest).otherwise(F.col(text)).alias(text) if c == text else F.col(f"`{c}`") for c in own],
        F.when(changed, stretches).otherwise(0).alias(f"{prefix}removed_chunks"),
        F.when(changed, F.when(F.col("_odd"), F.aggregate("_cuts", F.lit(0), lambda a, x: a + _line_words(_bare(x), F.lit(True))))
               .otherwise(_plain_sum(F.col("_cuts")))).otherwise(0).alias(f"{prefix}removed_words"))
