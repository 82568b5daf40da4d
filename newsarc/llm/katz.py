"""Katz backoff language model: learnt from the training documents, evaluated on all.

P(w | c) is the Good-Turing discounted share of w after context c where the pair
was seen, and alpha(c) P(w | shorter c) elsewhere; alpha is what the discounts left
over, divided by the shorter context's mass of unseen words, so each context
sums to one over the vocabulary and one unknown class. The recursion ends at
discounted word counts, whose free mass is the unknown class's.

Documents are read once into blocks of tokens. Each block asks for its distinct
words, then for its distinct pairs (triples, ...), never for single tokens: the
questions are dealt into buckets by hash, one bucket's questions from all blocks
are merged into that bucket of the n-gram table, and the answers (counts, and
what a context's alpha needs) go back to the block, which evaluates its tokens
recursively. The n-gram tables stay in the shared folder, partitioned by level.
A bucket's size is bounded by hashing; a context with more tokens than a bucket's
even share is dealt by the whole n-gram instead, and its few sums are added up
afterwards (there are at most as many such contexts as buckets).
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsarc.llm.common import blank_words, written

ORDER = 2
CUT = 5                    # counts up to this are discounted
BLOCK_TOKENS = 1 << 20     # a block ends with the document that reaches this
BUCKET_BYTES = 8 << 20     # text per bucket
END = b"\n"                # no word holds a blank, so this names the end token
UNKNOWN = (1 << 62) - 1    # id of the unknown class
START = 0                  # id of the document start, a context only

ROWS = "kind string, block long, bucket int, data binary, stats array<long>, mass double"


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string: smallest type, bytes of equal rank together."""
    import zstandard
    parts = []
    for a in arrays:
        if a.dtype.kind in "iu":
            top = int(a.max()) if len(a) else 0
            a = a.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8")
        elif len(a):
            values, index = np.unique(a, return_inverse=True)
            if 2 * len(values) < len(a):  # few distinct numbers: a list of them and places in it
                body = _pack(values, index.ravel())
                parts.append(b"D" + len(body).to_bytes(8, "little") + body)
                continue
        raw = np.ascontiguousarray(a).view("u1").reshape(-1, a.dtype.itemsize).T.tobytes()
        raw = zstandard.ZstdCompressor(level=1).compress(raw)
        parts.append(a.dtype.str[1:].encode().ljust(4) + len(a).to_bytes(8, "little") + len(raw).to_bytes(8, "little") + raw)
    return b"".join(parts)


def _unpack(data: bytes) -> list[np.ndarray]:
    import zstandard
    out, at = [], 0
    while at < len(data):
        if data[at:at + 1] == b"D":
            size = int.from_bytes(data[at + 1:at + 9], "little")
            values, index = _unpack(data[at + 9:at + 9 + size])
            out.append(values[index])
            at += 9 + size
            continue
        kind = np.dtype("<" + data[at:at + 4].decode().strip())
        n, size = (int.from_bytes(data[at + k:at + k + 8], "little") for k in (4, 12))
        raw = zstandard.ZstdDecompressor().decompress(data[at + 20:at + 20 + size], max_output_size=n * kind.itemsize) if n else b""
        a = np.frombuffer(raw, "u1").reshape(kind.itemsize, -1).T.copy().view(kind).ravel()
        out.append(a.astype("int64") if kind.kind == "u" and kind.itemsize < 8 else a)
        at += 20 + size
    return out


def _gaps(a: np.ndarray) -> np.ndarray:
    """A rising array as differences, which pack better; ``_rising`` gives it back."""
    return np.diff(a, prepend=a.dtype.type(0))


def _rising(gaps: np.ndarray, kind: str) -> np.ndarray:
    return np.cumsum(gaps.astype(kind), dtype=kind)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*((*r, None, None)[:6] for r in rows))) if rows else [()] * 6
    types = [pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)],
                                      names=[f.split()[0] for f in ROWS.split(", ")])


def _mix(x: np.ndarray) -> np.ndarray:
    """A fixed scramble of 64-bit numbers."""
    x = x.astype("uint64")
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _slices(bucket: np.ndarray):
    """(bucket, start, end) of each run of a sorted array."""
    present, first = np.unique(bucket, return_index=True)
    return zip(present.tolist(), first.tolist(), [*first[1:].tolist(), len(bucket)])


def _ids(number: np.ndarray, bucket: int) -> np.ndarray:
    """Names of a bucket's seen entries (numbered from 1); 0 becomes the unknown class."""
    return np.where(number > 0, number.astype("int64") | bucket << 32, UNKNOWN)


def learns(ident) -> bool:
    """Are this document's counts learnt? Null ids are held out."""
    return ident is not None and zlib.crc32(str(ident).encode()) % 5 != 1


# ------------------------------------------------------------------ blocks

def _block(docs, block: int, buckets: int):
    """Rows of one block: its tokens (t) and its distinct words by bucket (q)."""
    from xxhash import xxh64_intdigest
    names: dict[bytes, int] = {}
    tokens = [np.fromiter((names.setdefault(w, len(names)) for w in words), "int32", len(words)) for _, words in docs]
    lengths = np.array([len(t) for t in tokens], dtype="int64")
    flat = np.concatenate(tokens)
    hashes = np.fromiter(map(xxh64_intdigest, names), "uint64", len(names))
    own, first = np.unique(hashes, return_inverse=True)     # words of one hash are one word
    bucket = (own >> np.uint64(32)).astype("int64") * buckets >> 32   # hash ranges: sorted like the hashes
    train = np.array([learns(d) for d, _ in docs], dtype=bool)
    word = first[flat]
    counts = np.bincount(word[np.repeat(train, lengths)], minlength=len(own))
    rank = np.argsort(-np.bincount(word, minlength=len(own)), kind="stable")   # frequent words get small numbers
    place = np.empty_like(rank)
    place[rank] = np.arange(len(rank))
    ids = np.array([d if d is not None else 0 for d, _ in docs], dtype="int64")
    known = np.array([d is not None for d, _ in docs])
    yield ("t", block, -1, _pack(place[word], rank, lengths, train.astype("u1"), known.astype("u1"), ids.view("uint64")),
           [int(train.sum())])
    for k, a, z in _slices(bucket):
        yield ("q", block, k, _pack(_gaps(own[a:z]), counts[a:z]))


def blocks(docs: DataFrame, buckets: int, text: str, ident: str) -> DataFrame:
    def run(batches):
        base, n, held, size = TaskContext.get().partitionId() << 32, 0, [], 0
        for b in batches:
            for d, t in zip(b[0], b[1]):
                words = blank_words(t.as_py())
                words.append(END)
                held.append((d.as_py(), words))
                size += len(words)
                if size >= BLOCK_TOKENS:
                    yield _batch(list(_block(held, base + n, buckets)))
                    held, size, n = [], 0, n + 1
        if held:
            yield _batch(list(_block(held, base + n, buckets)))

    return docs.select(F.col(ident).cast("long").alias("d"), F.col(text).alias("t")).mapInArrow(run, ROWS)


# ------------------------------------------------------------------ tables by bucket

def _histogram(counts: np.ndarray) -> list[int]:
    """n_1 .. n_(CUT+1), number seen, sum."""
    seen = counts[counts > 0]
    return [*(int(np.count_nonzero(seen == r)) for r in range(1, CUT + 2)), len(seen), int(seen.sum())]


def _words(group: pa.Table) -> pa.Table:
    """Merge one bucket's words: table row (m), histogram (h) and an answer (a) per block."""
    k = group["bucket"][0].as_py()
    asked = [_unpack(x.as_py()) for x in group["data"]]
    own, at = np.unique(np.concatenate([_rising(a[0], "uint64") for a in asked]), return_inverse=True)
    counts = np.bincount(at, weights=np.concatenate([a[1] for a in asked]), minlength=len(own)).astype("int64")
    number = np.cumsum(counts > 0)          # 1.. among the bucket's seen words
    rows = [("m", -1, k, _pack(_gaps(own[counts > 0]), counts[counts > 0])), ("h", -1, k, None, _histogram(counts))]
    start = 0
    for block, (h, _) in zip(group["block"].to_pylist(), asked):
        mine = at[start:start + len(h)]
        start += len(h)
        rows.append(("a", block, k, _pack(counts[mine], np.where(counts[mine] > 0, number[mine], 0))))
    return pa.Table.from_batches([_batch(rows)])


def _ngrams(group: pa.Table) -> pa.Table:
    """Merge one bucket's n-grams: table (m), histogram (h), answers (a), sums of dealt contexts (s)."""
    k = group["bucket"][0].as_py()
    asked = [_unpack(x.as_py()) for x in group["data"]]   # contexts, run lengths, heavy, words, counts, lower
    sizes = [len(a[3]) for a in asked]
    context = np.concatenate([np.repeat(_rising(a[0], "int64"), a[1]) for a in asked])
    heavy = np.concatenate([np.repeat(a[2], a[1]) for a in asked]).astype(bool)
    word = np.concatenate([a[3].astype("int64") for a in asked])
    n, lower = (np.concatenate([a[i] for a in asked]) for i in (4, 5))
    order = np.lexsort((word, context))
    c, w = context[order], word[order]
    new = np.append(True, (c[1:] != c[:-1]) | (w[1:] != w[:-1]))
    at = np.empty(len(order), dtype="int64")
    at[order] = np.cumsum(new) - 1                        # entry -> distinct n-gram
    heads = order[new]
    counts = np.bincount(at, weights=n).astype("int64")
    gc, gw, glow, gheavy = context[heads], word[heads], lower[heads], heavy[heads]
    newc = np.append(True, gc[1:] != gc[:-1])
    of = np.cumsum(newc) - 1                              # distinct n-gram -> context
    seen = counts > 0
    m = int(of[-1]) + 1
    stats = np.stack([*(np.bincount(of[counts == r], minlength=m) for r in range(1, CUT + 1)),
                      np.bincount(of[counts > CUT], weights=counts[counts > CUT], minlength=m)]).astype("int64")
    mass = np.bincount(of[seen], weights=glow[seen], minlength=m)
    number = np.cumsum(seen)
    rows = [("m", -1, k, _pack(_gaps(gc[seen]), gw[seen], counts[seen])), ("h", -1, k, None, _histogram(counts))]
    for i in np.nonzero(gheavy[newc])[0].tolist():
        rows.append(("s", int(gc[newc][i]), k, None, stats[:, i].tolist(), float(mass[i])))
    start = 0
    for block, size, a in zip(group["block"].to_pylist(), sizes, asked):
        mine = at[start:start + size]
        start += size
        runs = np.cumsum(a[1])
        ctx = of[mine[runs - 1]]                          # the block's contexts in its order
        plain = stats[:CUT, ctx].sum(axis=0) == 0         # nothing to discount: one count is added
        unseen = np.add.reduceat((counts[mine] == 0).astype("int64"), runs - a[1]) > 0
        rows.append(("a", block, k, _pack(
            counts[mine], np.where(seen[mine], number[mine], 0), plain.astype("u1"),
            *stats[:, ctx[unseen]], mass[ctx[unseen]])))
    return pa.Table.from_batches([_batch(rows)])


class Level:
    """What all blocks need of one level: discounts, and the sums of the contexts that were dealt."""

    def __init__(self, answers: DataFrame, documents: int):
        total = answers.where("kind = 'h'").agg(*[F.sum(F.get("stats", F.lit(i))) for i in range(CUT + 3)]).first()
        total = np.array([x or 0 for x in total], dtype="int64")
        self.n, self.types, self.tokens, self.documents = total[:CUT + 1], int(total[CUT + 1]), int(total[CUT + 2]), documents
        self.discount = discounts(self.n)
        sums = answers.where("kind = 's'").groupBy("block").agg(
            *[F.sum(F.get("stats", F.lit(i))) for i in range(CUT + 1)], F.sum("mass")).orderBy("block").collect()
        self.dealt = np.array([r[0] for r in sums], dtype="int64")
        self.dealt_sums = np.array([r[1:] for r in sums], dtype="float64").reshape(len(sums), CUT + 2)


def discounts(n: np.ndarray) -> np.ndarray:
    """Katz's d_0 .. d_CUT (d_0 unused) from n_1 .. n_(CUT+1); absolute discounting where they leave (0, 1)."""
    d = np.ones(CUT + 1)
    n = n.astype("float64")
    a = (CUT + 1) * n[CUT] / n[0] if n[0] else 1.0
    b = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    for r in range(1, CUT + 1):
        x = ((r + 1) * n[r] / n[r - 1] / r - a) / (1 - a) if n[r - 1] and a != 1 else 0.0
        d[r] = x if 0 < x < 1 else (r - min(max(b, 0.1), 0.9)) / r
    return d


def word_shares(level: Level):
    """(P of a word by its count, as a function; P of the unknown class): they sum to one."""
    k, n = np.arange(1, CUT + 1), level.n[:CUT]
    small, rest = float((level.discount[1:] * k * n).sum()), float(level.tokens - (k * n).sum())
    if not level.tokens:
        return (lambda c: np.ones(len(c))), 1.0
    least = 0.5 / (level.tokens + 0.5 * (level.types + 1))
    mass = (small + rest) / level.tokens
    unknown = max(1 - mass, least)
    scale = (1 - unknown) / mass / level.tokens

    def share(c):
        d = np.where(c <= CUT, level.discount[np.minimum(c, CUT)], 1.0)
        return np.where(c > 0, d * c * scale, unknown)
    return share, unknown


# ------------------------------------------------------------------ evaluation in a block

class Tokens:
    """One block with the answers of the levels so far, in the order of its questions."""

    def __init__(self, group: pa.Table, levels: list[Level], buckets: int):
        kind, level = group["kind"].to_pylist(), group["level"].to_pylist()
        data, bucket = group["data"], group["bucket"].to_pylist()
        place, rank, self.lengths, train, self.known, ids = _unpack(data[kind.index("t")].as_py())
        self.word, self.train = rank[place], train.astype(bool)
        self.ids = ids.astype("uint64").view("int64")
        self.block = group["block"][kind.index("t")].as_py()
        self.levels, self.buckets = levels, buckets
        ends = np.cumsum(self.lengths)
        self.starts = ends - self.lengths
        self.position = (np.arange(len(self.word)) - np.repeat(self.starts, self.lengths)).astype("int32")
        self.learnt = np.repeat(self.train, self.lengths)
        answers: list[dict[int, bytes]] = [{} for _ in levels]
        for i, what in enumerate(kind):
            if what == "a":
                answers[level[i] - 1][bucket[i]] = data[i].as_py()
        # words
        got = [(k, _unpack(answers[0][k])) for k in sorted(answers[0])]
        self.count1 = np.concatenate([a[0] for _, a in got])
        self.id1 = np.concatenate([_ids(a[1], k) for k, a in got])
        share, _ = word_shares(levels[0])
        self.count = self.count1[self.word]                # of the n-gram that ends at each token
        self.node = self.id1[self.word]
        self.p = share(self.count)
        self.c1 = self.count
        for n in range(2, len(levels) + 1):
            self._raise(n, answers[n - 1], levels[n - 1])

    def questions(self, n: int):
        """Distinct n-grams of the block whose context was seen, in the order of (bucket, context, word)."""
        ctx = np.append(START, self.node[:-1])
        seen = np.append(0, self.count[:-1])
        if n == 2:
            ctx[self.starts] = START
            seen[self.starts] = max(1, self.levels[0].documents)
        open_ = (self.position >= n - 2) & (seen > 0) & (ctx != UNKNOWN)
        at = np.nonzero(open_)[0]
        ctx, seen, word = ctx[at], seen[at], self.id1[self.word[at]]
        order = np.lexsort((word, ctx))
        new = np.append(True, (ctx[order][1:] != ctx[order][:-1]) | (word[order][1:] != word[order][:-1])) if len(at) else np.zeros(0, bool)
        of = np.empty(len(at), dtype="int64")
        of[order] = np.cumsum(new) - 1
        heads = order[new]
        counts = np.bincount(of, weights=self.learnt[at], minlength=len(heads)).astype("int64")
        c, w, total, low = ctx[heads], word[heads], seen[heads], self.p[at][heads]
        heavy = total > max(1, self.levels[0].tokens / self.buckets)
        key = np.where(heavy, _mix(c) ^ _mix(_mix(w) + np.uint64(1)), _mix(c))
        bucket = (_mix(key) % np.uint64(self.buckets)).astype("int64")
        sort = np.lexsort((w, c, bucket))
        back = np.empty(len(sort), dtype="int64")
        back[sort] = np.arange(len(sort))
        return at, back[of] if len(at) else of, bucket[sort], c[sort], w[sort], total[sort], heavy[sort], counts[sort], low[sort]

    def ask(self, n: int):
        """Question rows of level n."""
        _, _, bucket, c, w, _, heavy, counts, low = self.questions(n)
        for k, a, z in _slices(bucket):
            new = np.append(True, c[a + 1:z] != c[a:z - 1])
            first = np.nonzero(new)[0]
            yield ("q", self.block, k, _pack(
                _gaps(c[a:z][first]), np.diff(np.append(first, z - a)), heavy[a:z][first].astype("u1"), w[a:z], counts[a:z],
                low[a:z]))

    def _raise(self, n: int, answers: dict[int, bytes], level: Level) -> None:
        """Replaces the probabilities of order n-1 by those of order n."""
        at, of, bucket, c, w, total, heavy, _, low = self.questions(n)
        counts, number = np.zeros(len(c), "int64"), np.zeros(len(c), "int64")
        added, left = np.zeros(len(c)), np.ones(len(c))   # count added to the context, alpha
        d, k = level.discount, np.arange(1, CUT + 1)
        for b, a, z in _slices(bucket):
            r, num, plain, *rest = _unpack(answers[b])
            counts[a:z], number[a:z] = r, _ids(num, b)
            run = np.cumsum(np.append(True, c[a + 1:z] != c[a:z - 1])) - 1
            added[a:z] = plain[run]
            unseen = np.bincount(run, weights=r == 0) > 0
            alpha = np.ones(len(plain))
            alpha[unseen] = backoff(np.stack(rest[:CUT + 1]).astype("float64"), rest[CUT + 1], plain[unseen], d, k)
            left[a:z] = alpha[run]
        if heavy.any():
            i = np.searchsorted(level.dealt, c[heavy])
            sums = level.dealt_sums[i].T
            plain = (sums[:CUT].sum(axis=0) == 0).astype("float64")
            added[heavy] = plain
            left[heavy] = backoff(sums[:CUT + 1], sums[CUT + 1], plain, d, k)
        share = np.where(counts <= CUT, d[np.minimum(counts, CUT)], 1.0) * counts / (total + added)
        p = np.where(counts > 0, share, left * low)
        self.p = self.p.copy()
        self.p[at] = p[of]
        self.node, self.count = np.full(len(self.word), UNKNOWN), np.zeros(len(self.word), "int64")
        self.node[at], self.count[at] = number[of], counts[of]

    def scores(self) -> pa.RecordBatch:
        level = self.levels[0]
        base = np.log10((self.c1 + 0.5) / (level.tokens + 0.5 * (level.types + 1)))
        total = lambda x: np.add.reduceat(x, self.starts)  # noqa: E731  (each document has its end token)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids, mask=~self.known.astype(bool)), pa.array(~self.train), pa.array(self.lengths),
             pa.array(total((self.c1 > 0).astype("int64"))), pa.array(np.full(len(self.ids), level.tokens)),
             pa.array(total(base)), pa.array(total(np.log10(self.p)))], names=[f.split()[0] for f in SCORES.split(", ")])


def backoff(stats: np.ndarray, mass: np.ndarray, plain: np.ndarray, d: np.ndarray, k: np.ndarray) -> np.ndarray:
    """alpha of contexts from n_1 .. n_CUT, the sum of larger counts and the seen words' shorter-context mass."""
    total = (k[:, None] * stats[:CUT]).sum(axis=0) + stats[CUT]
    kept = ((d[1:] * k)[:, None] * stats[:CUT]).sum(axis=0) + stats[CUT]
    return np.where(total > 0, (1 - kept / np.maximum(total + plain, 1)) / np.maximum(1 - mass, 1e-300), 1.0)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scored(docs: DataFrame, order: int = ORDER, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each document.

    Documents whose crc32(id) mod 5 is 1, and those with a null id, are held out.
    Null and empty texts are one end token. Repeated rows are documents of their
    own. Without training documents every token is unknown and every score 0.
    Other columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text) + 1)).first()[0] or 1
    buckets = max(8, -(-size // BUCKET_BYTES))
    base = written(blocks(docs, buckets, text, ident), "lm-blocks", ("kind",))
    tokens = base.where("kind = 't'").withColumn("level", F.lit(0))
    learnt = tokens.agg(F.sum(F.get("stats", F.lit(0)))).first()[0] or 0
    questions = base.where("kind = 'q'")
    levels: list[Level] = []
    for n in range(1, order + 1):
        answers = written(questions.groupBy("bucket").applyInArrow(_words if n == 1 else _ngrams, ROWS),
                          f"lm-level{n}", ("kind",))
        levels.append(Level(answers, learnt))
        tokens = tokens.unionByName(answers.where("kind = 'a'").withColumn("level", F.lit(n)))
        shared = spark.sparkContext.broadcast(list(levels))  # a row per dealt context, at most one per bucket
        if n < order:
            questions = tokens.groupBy("block").applyInArrow(_asking(shared, buckets, n + 1), ROWS)
    return tokens.groupBy("block").applyInArrow(_scoring(shared, buckets), SCORES)


def _asking(shared, buckets: int, n: int):
    def ask(group: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_batch(list(Tokens(group, shared.value, buckets).ask(n)))])
    return ask


def _scoring(shared, buckets: int):
    def score(group: pa.Table) -> pa.Table:
        return pa.Table.from_batches([Tokens(group, shared.value, buckets).scores()])
    return score
