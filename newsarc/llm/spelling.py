"""Spelling variants of the corpus vocabulary, found through permuterm rotations.

A word w becomes ``w$``; of each of its rotations two keys are written: the whole
rotation, and the rotation without its last character, which skips that
character. Two words that differ by one replaced character share the skipping key
at that place, and a word that lacks one character of another has a whole rotation
equal to the other's skipping key. So one pass over the sorted keys finds every
pair at distance one, without comparing words.

Keys are dealt by hash and sorted inside the tasks. A key names the letters
before and after one place, so a group holds at most one word per letter of the
alphabet and the one word without it: no group grows with the corpus. Per group
and member only the number of neighbours and the best one are written, never the
pairs. A word with a run of equal letters lacks "one of them" in several places;
only the first of a run counts, so each pair is met exactly once.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsarc.llm.common import LOWER, cut, with_positions

MIN_LENGTH, MIN_COUNT, FACTOR, DROPPED = 7, 2, 10, 31
FLUSH = 200_000     # distinct runs a task holds before it passes its counts on
PART = 1 << 20      # characters of a text that are split at once
SHORT = 64          # bytes of the runs whose checksums are computed together
END = "$"
LONG = 64           # code points of the words whose rotations are written out
_PRIMES, _BASES = (2147483647, 2147483629, 2147483587, 2147483579), (1103515245, 69069, 1664525, 134775813)

_RUN = re.compile("[a-zÀ-ÿ]+")
_GAP = re.compile("[^A-Za-zÀ-ÿ]")


def _byte_steps() -> np.ndarray:
    table = np.arange(256, dtype="uint32")
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_STEP = _byte_steps()  # the CRC-32 register after one zero byte, by its low byte


def parts(text: str, size: int = PART):
    """The text in pieces of about ``size`` characters that cut no run."""
    at = 0
    while len(text) - at > size:
        gap = _GAP.search(text, at + size)
        end = gap.start() if gap else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def runs(text: str) -> list[str]:
    return _RUN.findall(text.encode("utf-8", "surrogatepass").translate(LOWER).decode("utf-8", "surrogatepass"))


def thinned(ident: str, run: str, every: int = DROPPED) -> str:
    """The run, or without one code point where ``every`` divides the checksum of id and run."""
    h = zlib.crc32(f"{ident}:{run}".encode("utf-8", "surrogatepass"))
    return run if h % every else run[:h % len(run)] + run[h % len(run) + 1:]


class Counts(dict):
    """Run -> number, with checksum, byte length and count by number."""

    def __init__(self):
        self.crc, self.bytes, self.words = [], [], []
        self.n, self.other = np.zeros(0, dtype="int64"), {}

    def __missing__(self, run: str) -> int:
        raw = run.encode("utf-8", "surrogatepass")
        self[run] = number = len(self.words)
        self.crc.append(zlib.crc32(raw))
        self.bytes.append(len(raw))
        self.words.append(run)
        return number

    def add(self, idents: list[str], found: list[list[str]], every: int) -> None:
        """Counts the runs of some documents (``idents``, one list of runs each)."""
        sizes = np.array([len(f) for f in found])
        number = np.fromiter((self[r] for f in found for r in f), dtype="int64", count=int(sizes.sum()))
        if not len(number):
            return
        size = len(self.words)
        self.n = np.concatenate([self.n, np.zeros(size - len(self.n), dtype="int64")])
        self.n += np.bincount(number, minlength=size)
        # the checksum of prefix + run is the run's own, changed by the prefix's after as many zero bytes
        shift = np.zeros((len(idents), SHORT + 1), dtype="uint32")
        shift[:, 0] = [zlib.crc32(f"{i}:".encode()) for i in idents]
        for k in range(SHORT):
            shift[:, k + 1] = _STEP[shift[:, k] & 255] ^ (shift[:, k] >> 8)
        doc, length = np.repeat(np.arange(len(idents)), sizes), np.array(self.bytes)[number]
        h = shift[doc, np.minimum(length, SHORT)] ^ np.array(self.crc, dtype="uint32")[number]
        for at in np.flatnonzero((h % every == 0) | (length > SHORT)):
            run = self.words[number[at]]
            new = thinned(idents[doc[at]], run, every)
            if new != run or length[at] <= SHORT:
                self.n[number[at]] -= 1
                self.other[new] = self.other.get(new, 0) + 1

    def rows(self, min_length: int):
        """(words, counts) of at least ``min_length`` code points; a word may stand in both halves."""
        out = [(w, int(n)) for w, n in zip(self.words, self.n) if n and len(w) >= min_length]
        out += [(w, n) for w, n in self.other.items() if len(w) >= min_length]
        return [w for w, _ in out], [n for _, n in out]


def vocabulary(docs: DataFrame, text: str = "text", ident: str = "doc_id", min_length: int = MIN_LENGTH,
               min_count: int = MIN_COUNT, every: int = DROPPED) -> DataFrame:
    """(word, n): the words of all texts; counted inside the tasks before they are shuffled."""
    def run(batches):
        counts, idents, found, held = Counts(), [], [], 0

        def out():
            words, n = counts.rows(min_length)
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], names=["word", "n"])

        for b in batches:
            for i, t in zip(b[0], b[1]):
                if not t.is_valid:
                    continue
                for piece in parts(t.as_py()):
                    idents.append(i.as_py() or "")
                    found.append(runs(piece))
                    held += len(found[-1])
                    if held >= FLUSH or len(idents) >= 4096:
                        counts.add(idents, found, every)
                        idents, found, held = [], [], 0
                        if len(counts.words) + len(counts.other) >= FLUSH:
                            yield out()
                            counts = Counts()
        counts.add(idents, found, every)
        yield out()

    source = docs.select(F.col(f"`{ident}`").cast("string").alias("i"), F.col(f"`{text}`").alias("t"))
    return (source.mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def keys_of(word: str) -> list[tuple[str, str]]:
    """(key, skipped character) of all rotations; a whole rotation skips nothing."""
    size, twice = len(word), word + END + word
    return ([(twice[j:j + size + 1], "") for j in range(size + 1)]
            + [(twice[j:j + size], twice[j - 1]) for j in range(1, size + 1)])


def rotations(words: DataFrame) -> DataFrame:
    """(key, skipped, n): two keys per rotation of each word."""
    def run(batches):
        for b in batches:
            for a in range(0, b.num_rows, 1000):
                part = b.slice(a, 1000)
                keys, skipped, n = [], [], []
                for word, count in zip(part[0].to_pylist(), part[1].to_pylist()):
                    size, twice = len(word), word + END + word
                    keys += [twice[j:j + size + 1] for j in range(size + 1)]
                    keys += [twice[j:j + size] for j in range(1, size + 1)]
                    skipped += [""] * (size + 1)
                    skipped += word
                    n += [count] * (2 * size + 1)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(skipped, pa.string()),
                                                  pa.array(n, pa.int64())], names=["key", "skipped", "n"])

    return words.select("word", "n").mapInArrow(run, "key string, skipped string, n long")


def _near(members: list[tuple]):
    """(name, neighbours, best count, best neighbour) for each member of a key's group that has one.

    Members are (name, count, skipped character, is it the first of a run of equal ones); names sort like words.
    """
    whole = [m for m in members if not m[2]]
    skips = [m for m in members if m[2]]
    first = [m for m in skips if m[3]]
    rank = lambda m: (-m[1], m[0])
    two = sorted(skips, key=rank)[:2]
    for m in skips:
        others = [o for o in two if o is not m][:1]
        count = len(skips) - 1
        if whole and m[3]:
            others, count = others + whole, count + 1
        if others:
            best = min(others, key=rank)
            yield m[0], count, best[1], best[0]
    if whole and first:
        best = min(first, key=rank)
        yield whole[0][0], len(first), best[1], best[0]


def _words_of(key: str, skipped: str) -> tuple[str, bool]:
    """The word behind a key, and whether the skipped character is the first of a run."""
    after, before = key.split(END)
    return before + skipped + after, not before.endswith(skipped) if skipped else False


_FOUND, _FOUND_TYPES = ["word", "n_near", "best_n", "best"], [pa.string(), pa.int64(), pa.int64(), pa.string()]


def _found(rows, types=_FOUND_TYPES) -> pa.RecordBatch:
    rows = list(rows)
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=_FOUND)


def neighbours(keys: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) for each group of equal keys; a word may have several rows."""
    def run(batches):
        key, members = None, []
        for b in batches:
            if not b.num_rows:
                continue
            same = pc.equal(b[0][1:], b[0][:-1]).to_numpy(zero_copy_only=False)
            kept = np.ones(b.num_rows, dtype=bool)   # the first and the last row may belong to the next batch's group
            kept[1:-1] = same[1:] | same[:-1]
            part = b.filter(pa.array(kept))
            out = []
            for k, c, n in zip(*(part[i].to_pylist() for i in range(3))):
                if k != key:
                    if len(members) > 1:
                        out += _near(members)
                    key, members = k, []
                word, first = _words_of(k, c)
                members.append((word, n, c, first))
            yield _found(out)
        yield _found(_near(members) if len(members) > 1 else [])

    return (keys.repartition("key").sortWithinPartitions("key")
            .mapInArrow(run, "word string, n_near long, best_n long, best string"))


def _powers(base: int, mod: int, size: int) -> np.ndarray:
    out = np.ones(size, dtype="uint64")
    filled, step = 1, base % mod
    while filled < size:   # doubling
        part = out[:min(filled, size - filled)] * np.uint64(step) % np.uint64(mod)
        out[filled:filled + len(part)] = part
        filled, step = filled + len(part), step * step % mod
    return out


def digests(word: str) -> tuple[np.ndarray, np.ndarray]:
    """Two longs for each whole rotation, then for each one without its last character (all but the first).

    Four polynomial sums modulo primes under 2^31, taken from running sums, so the work grows with the length.
    """
    size, twice = len(word), np.frombuffer((word + END + word).encode("utf-32-le"), dtype="<u4").astype("uint64")
    at, sums = np.arange(size + 1), []
    for mod, base in zip(_PRIMES, _BASES):
        up, down = _powers(base, mod, len(twice)), _powers(pow(base, -1, mod), mod, size + 1)
        run = np.concatenate([[0], np.cumsum(twice * up % np.uint64(mod))]).astype("uint64")
        whole = (run[at + size + 1] - run[at]) % np.uint64(mod) * down % np.uint64(mod)
        less = (run[at[1:] + size] - run[at[1:]]) % np.uint64(mod) * down[1:] % np.uint64(mod)
        sums.append(np.concatenate([whole, less]))
    return tuple(((a << np.uint64(32)) | b).astype("int64") for a, b in (sums[:2], sums[2:]))


def long_neighbours(words: DataFrame, long: int = LONG) -> DataFrame:
    """The same for words of more than ``long`` code points, whose rotations are named by digests of 124 bits.

    All rotations of a word written out would grow with the square of its length. Words of exactly
    ``long`` take part with their whole rotations alone: their other neighbours are found by ``neighbours``.
    Words are numbered in code-point order, so numbers decide ties as the words would.
    """
    ranged, first = with_positions(words.select("word", "n"), "word")
    starts = words.sparkSession.createDataFrame(sorted(first.items()), "pid int, _start long")   # a row per range
    named = cut(ranged.join(F.broadcast(starts), "pid").select((F.col("_start") + F.col("idx")).alias("id"), "word", "n"))

    def keys(batches):
        for b in batches:
            for ident, word, n in zip(*(b[i].to_pylist() for i in range(3))):
                high, low = digests(word)
                size, letters = len(word), list(word)
                skipped = [""] * (size + 1) + letters
                start = [False] * (size + 2) + [a != z for a, z in zip(letters, letters[1:])]
                start[size + 1] = True
                end = size + 1 if size == long else 2 * size + 1
                for a in range(0, end, 10_000):
                    part = slice(a, min(end, a + 10_000))
                    rows = part.stop - a
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(high[part]), pa.array(low[part]), pa.array([ident] * rows, pa.int64()),
                         pa.array([n] * rows, pa.int64()), pa.array(skipped[part], pa.string()), pa.array(start[part], pa.bool_())],
                        names=["high", "low", "id", "n", "skipped", "start"])

    def scan(batches):
        key, members = None, []
        for b in batches:
            out = []
            for high, low, *member in zip(*(c.to_pylist() for c in b.columns)):
                if (high, low) != key:
                    out += _near(members)
                    key, members = (high, low), []
                members.append(member)
            yield _found(out, [pa.int64()] * 4)
        yield _found(_near(members), [pa.int64()] * 4)

    rows = (named.mapInArrow(keys, "high long, low long, id long, n long, skipped string, start boolean")
            .repartition("high", "low").sortWithinPartitions("high", "low")
            .mapInArrow(scan, "word long, n_near long, best_n long, best long"))
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    rows = rows.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    names = named.select(F.col("id").alias("_id"), F.col("word").alias("_word"))
    own = rows.join(names, rows["word"] == names["_id"]).select(F.col("_word").alias("word"), "n_near", (-F.col("b.less")).alias("best_n"), "b.best")
    return own.join(names, own["best"] == names["_id"]).select("word", "n_near", "best_n", F.col("_word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the end of each chain, by doubling; forms grow in count, so no chain is a loop."""
    at = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = cut(at.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"),
                                                          F.col("_next").isNotNull().alias("_moved")))
        at = moved.select("word", "root")
        if moved.where("_moved").isEmpty():
            return at


def variants(docs: DataFrame, text: str = "text", ident: str = "doc_id", min_length: int = MIN_LENGTH,
             min_count: int = MIN_COUNT, factor: int = FACTOR, every: int = DROPPED,
             long: int = LONG) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row per word of the vocabulary.

    ``form`` is the near word with the largest count (ties: the smallest in
    code-point order) if that is ``factor`` times the word's own, else null;
    ``root`` is the end of the chain of forms, the word itself without one. Null
    and empty texts have no words, a null id counts as the empty string, rows with
    the same id are counted each. Runs of any length are words: those beyond ``long`` code
    points meet by digests of their rotations. Texts of any length are read in pieces; other
    columns are not read. An empty table gives an empty result.
    """
    words = cut(vocabulary(docs, text, ident, min_length, min_count, every))
    near = neighbours(rotations(words.where(F.length("word") <= long)))
    far = words.where(F.length("word") >= long)
    if not far.isEmpty():
        near = near.unionByName(long_neighbours(far, long))
    none = F.lit(None)
    rows = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), none.cast("long").alias("best_n"),
                        none.cast("string").alias("best"))
    rows = rows.unionByName(near.withColumn("n", none.cast("long")))
    # the smallest pair of negated count and word is the best neighbour
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), "best")))
    found = rows.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("b"))
    good = -F.col("b.less") >= factor * F.col("n")
    found = cut(found.select("word", "n", "n_near", F.when(good, F.col("b.best")).alias("form"),
                             F.when(good, -F.col("b.less")).alias("form_n")))
    ends = roots(found.where("form IS NOT NULL"))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
