"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics are counted from the whole text's bytes inside Spark tasks. The
trees are grown on at most ``MAX_ROWS`` labelled rows (the documented bound of
the driver's share; rows are taken by the order of a hash of the document id, so
the choice does not depend on partitioning), flattened into arrays and applied
to all documents by vectorised traversal.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsarc.llm.common import blank_words

MAX_ROWS = 20_000
TREES, DEPTH, BINS, RATE, MIN_LEAF, RIDGE = 60, 4, 64, 0.15, 20, 1.0

FEATURES = ["log_bytes", "log_words", "mean_word", "long_words", "short_words", "upper", "lower", "digit", "punct",
            "non_ascii", "blank", "log_lines", "words_per_line", "repeated_lines", "repeated_words", "top_word",
            "bang", "bar", "symbol", "stop_ends", "comma", "capital_words", "shout_words", "compressed",
            "line_ends", "longest_word"]

_CLASSES = np.zeros(256, dtype="int64")  # fixed: class of each byte
_CLASSES[65:91] = 1     # upper
_CLASSES[97:123] = 2    # lower
_CLASSES[48:58] = 3     # digit
_CLASSES[128:] = 4      # non-ASCII
_CLASSES[[9, 10, 11, 12, 13, 32]] = 5  # blank
_SYMBOLS = np.frombuffer(b"#$%&*+/<=>@\\^_`{}~", dtype="u1")
_CAPITAL, _SHOUT = re.compile(rb"(?<![^\s])[A-Z]"), re.compile(rb"(?<![^\s])[A-Z]{3,}")
SAMPLE_BYTES = 1 << 16


def statistics(text: str | None) -> list[float]:
    """The features of one whole text; a null text counts as empty."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = max(1, len(raw))
    counts = np.bincount(np.frombuffer(raw, dtype="u1"), minlength=256)
    upper, lower, digit, high, blank = (counts[_CLASSES == k].sum() / n for k in (1, 2, 3, 4, 5))
    words = raw.split()
    w = max(1, len(words))
    lengths = np.fromiter(map(len, words), dtype="int64", count=len(words))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    m = max(1, len(lines))
    vocabulary = Counter(blank_words(text))
    packed = sum(len(zlib.compress(raw[a:a + SAMPLE_BYTES], 1)) for a in range(0, len(raw), SAMPLE_BYTES))
    letters = max(1e-9, upper + lower)
    return [np.log1p(len(raw)), np.log1p(len(words)), lengths.mean() if len(words) else 0.0, (lengths > 12).sum() / w,
            (lengths < 3).sum() / w, upper / letters, lower, digit, 1 - upper - lower - digit - high - blank if raw else 0.0,
            high, blank, np.log1p(len(lines)), len(words) / m, 1 - len(set(lines)) / m, 1 - len(vocabulary) / w,
            max(vocabulary.values(), default=0) / w, counts[33] / n, counts[124] / n, counts[_SYMBOLS].sum() / n,
            counts[46] / w, counts[44] / w, len(_CAPITAL.findall(raw)) / w, len(_SHOUT.findall(raw)) / w, packed / n,
            sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines) / m, lengths.max() if len(words) else 0]


def features(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns plus ``x``, the statistics as an array of doubles."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema) + ", x array<double>"

    def run(batches):
        for b in batches:
            x = [statistics(t.as_py()) for t in b[b.num_columns - 1]]
            yield pa.RecordBatch.from_arrays([*(b[i] for i in range(b.num_columns - 1)), pa.array(x, pa.list_(pa.float64()))],
                                             names=[*b.schema.names[:-1], "x"])

    return docs.select(*keep, F.col(text).alias("_t")).mapInArrow(run, schema)


class Trees:
    """Boosted trees of one depth, flattened: node i of a tree has the children 2i+1 and 2i+2."""

    def __init__(self, feature, threshold, value, base: float, depth: int):
        self.feature, self.threshold, self.value, self.base, self.depth = feature, threshold, value, base, depth

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        row = np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), dtype="int64")
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[row, f[node]] > t[node])
            out += v[node - len(f)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS,
        rate: float = RATE, min_leaf: int = MIN_LEAF, ridge: float = RIDGE) -> Trees:
    """Logistic boosting on feature histograms, level by level. Without rows of both labels: a constant."""
    inner, leaves = 2 ** depth - 1, 2 ** depth
    if not len(y) or y.min() == y.max():
        base = 0.0 if not len(y) else (4.0 if y[0] else -4.0)
        return Trees([], [], [], base, depth)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], axis=1)  # bin b: x <= edges[b]
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    margin, nf = np.full(len(y), base), x.shape[1]
    all_f, all_t, all_v = [], [], []
    flat = binned + np.arange(nf) * bins
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), dtype="int64")
        feature, threshold = np.zeros(inner, dtype="int64"), np.full(inner, np.inf)
        for level in range(depth):
            width, offset = 2 ** level, 2 ** level - 1
            cell = ((node - offset)[:, None] * (nf * bins) + flat).ravel()
            size = width * nf * bins
            hist = [np.bincount(cell, weights=np.repeat(v, nf), minlength=size).reshape(width, nf, bins).cumsum(axis=2)
                    for v in (g, h, np.ones(len(y)))]
            gl, hl, nl = hist
            gt, ht, nt = (a[:, :, -1:] for a in hist)
            gain = gl ** 2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt ** 2 / (ht + ridge)
            gain[(nl < min_leaf) | (nt - nl < min_leaf)] = -1
            best = gain.reshape(width, -1).argmax(axis=1)
            for k in range(width):
                f, b = divmod(int(best[k]), bins)
                if gain[k, f, b] > 1e-9 and b < len(edges[f]):
                    feature[offset + k], threshold[offset + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        leaf = node - inner
        value = rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + ridge)
        margin += value[leaf]
        all_f.append(feature)
        all_t.append(threshold)
        all_v.append(value)
    return Trees(all_f, all_t, all_v, base, depth)


def held_out(ident: str = "doc_id") -> F.Column:
    """True for the documents whose labels are never learnt from."""
    return F.coalesce(F.pmod(F.crc32(F.col(ident).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, ident: str = "doc_id", label: str = "quality",
          text: str = "text", **options) -> Trees:
    """Trees from the labelled documents that are not held out; at most ``max_rows`` of them."""
    known = (labels.where(F.col(label).isin(0, 1) & ~held_out(ident))
             .groupBy(ident).agg(F.max(label).alias("_y")))
    few = known.orderBy(F.xxhash64(ident), ident).limit(max_rows)  # at most max_rows: a proven bound
    d = docs.select(F.col(ident), F.col(text)).join(F.broadcast(few), ident)
    rows = (features(d, [ident, "_y"], text).orderBy(F.xxhash64(ident), ident, "x").limit(max_rows)
            .select("_y", "x").toPandas())
    if not len(rows):
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0))
    return fit(np.array(rows["x"].tolist()), rows["_y"].to_numpy(dtype="float64"), **options)


def score(docs: DataFrame, model: Trees, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` plus ``name``: probability of label 1 by the text alone. A column of that name is replaced."""
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != name])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{name}` double"
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    def run(batches):
        for b in batches:
            col = b[b.schema.get_field_index(text)]
            for a in range(0, b.num_rows, 1000):
                x = np.array([statistics(t.as_py()) for t in col[a:a + 1000]], dtype="float64")
                s = shared.value.probability(x) if len(x) else np.zeros(0)
                part = b.slice(a, 1000)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(s, pa.float64())],
                                                 names=[*part.schema.names, name])

    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted for each document.

    Null texts count as empty and are scored like any text; a null doc_id counts
    as held out. Repeated rows are scored each. Labels other than 0 and 1 and
    labels of unknown documents are not used; of repeated labels the larger one
    counts. Without labels of both kinds every score is the same constant.
    """
    model = train(docs, labels)
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
