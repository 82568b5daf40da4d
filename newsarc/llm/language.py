"""Language identification in two steps: the family first, then the language within it.

A text becomes the counts of its hashed byte 1- to 3-grams (letters only, A-Z lower-cased),
taken from the whole text in pieces of a fixed size. Families and, inside each family, its
languages are told apart by one-versus-one linear support vector machines: each pair has a
hyperplane of its own, the pairs vote, and the closely related languages of a family never
compete with those of another. The machines are trained by dual coordinate descent on at most
``MAX_ROWS`` labelled documents (the documented bound of the driver's share), dealt evenly
over the languages by a hash of the id; all documents are scored in a scan.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_ROWS = 4_000
BITS = 11                      # 2,048 features
PART = 1 << 19                 # bytes of a text that are counted at once
ROWS = 256                     # texts that are scored at once
PARTS = 64                     # parts of a language when its first rows are chosen
COST, ROUNDS = 1.0, 30
UNKNOWN = "und"

# The family of each language (ISO 639-1). A language that is not listed is its own family.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "fo", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"],
    "romance": ["ca", "es", "fr", "gl", "it", "oc", "pt", "ro"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "baltic": ["lt", "lv"],
    "celtic": ["br", "cy", "ga", "gd"],
    "uralic": ["et", "fi", "hu"],
    "turkic": ["az", "kk", "ky", "tr", "tt", "uz"],
    "indo-aryan": ["bn", "gu", "hi", "mr", "ne", "pa", "ur"],
    "iranian": ["fa", "ku", "ps", "tg"],
    "dravidian": ["kn", "ml", "ta", "te"],
    "semitic": ["am", "ar", "he", "mt"],
    "austronesian": ["id", "jv", "ms", "su", "tl"],
}
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes}

# A-Z lower-cased, all other ASCII bytes but letters blank; bytes of other characters stay.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else (b if 97 <= b <= 122 or b >= 128 else 32) for b in range(256))
_LETTER = re.compile(r"[^\W\d_]")   # and a few signs, such as raised digits
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype="uint32")  # odd multipliers, one per gram length


def family(lang: str) -> str:
    return _FAMILY.get(lang.lower().replace("_", "-").partition("-")[0], f"={lang}")


def has_letter(text: str | None) -> bool:
    return text is not None and any(m.group().isalpha() for m in _LETTER.finditer(text))


def grams(text: str | None, bits: int = BITS) -> np.ndarray:
    """Length-one vector of the damped counts of the text's hashed byte 1- to 3-grams; zero without letters."""
    counts = np.zeros(1 << bits)
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_LETTERS)
    for a in range(0, len(raw), PART):
        piece = np.frombuffer(b" " + raw[a:a + PART] + b" ", dtype="u1").astype("uint32")
        piece = piece[np.append(True, (piece[1:] != 32) | (piece[:-1] != 32))]   # one blank between words
        gram = np.zeros(len(piece), dtype="uint32")
        for n in range(3):
            gram = (gram[:len(piece) - n] << np.uint32(8)) | piece[n:]
            seen = gram[gram != 32] if n == 0 else gram
            counts += np.bincount((seen * _MIX[n]) >> np.uint32(32 - bits), minlength=1 << bits)
            gram = gram[:-1]
    if not counts.any():
        return counts
    counts = np.log1p(counts)
    return counts / np.sqrt(counts @ counts)


def machine(x: np.ndarray, y: np.ndarray, cost: float = COST, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """Weights (the last one is the offset) of a linear machine with squared hinge loss; y is 1 or -1.

    Dual coordinate descent; the two classes weigh alike, whatever their sizes.
    """
    x = np.hstack([x, np.ones((len(x), 1))])
    share = np.where(y > 0, (y > 0).mean(), (y < 0).mean())
    slack = share / cost                       # 1 / (2 C) of each row, with C divided by twice its class's share
    norm = (x * x).sum(axis=1) + slack
    w, alpha, rng = np.zeros(x.shape[1]), np.zeros(len(x)), np.random.default_rng(seed)
    for _ in range(rounds):
        most = 0.0
        for i in rng.permutation(len(x)):
            slope = y[i] * (x[i] @ w) - 1 + slack[i] * alpha[i]
            new = max(0.0, alpha[i] - slope / norm[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                most = max(most, abs(new - alpha[i]))
                alpha[i] = new
        if most < 1e-3:
            break
    return w


class Duel:
    """One-versus-one machines over some classes: votes decide, the summed margins break ties."""

    def __init__(self, x: np.ndarray, labels: np.ndarray, **options):
        self.names = sorted(set(labels.tolist()))
        self.pairs = [(a, b) for a in range(len(self.names)) for b in range(a + 1, len(self.names))]
        self.weights, self.steep = [], []
        for a, b in self.pairs:
            rows = np.isin(labels, [self.names[a], self.names[b]])
            y = np.where(labels[rows] == self.names[a], 1.0, -1.0)
            w = machine(x[rows], y, **options)
            self.weights.append(w)
            margin = np.abs(x[rows] @ w[:-1] + w[-1])
            self.steep.append(3.0 / max(1e-6, float(np.median(margin))))   # a usual margin counts as 95 % sure

    def decide(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The winner's number for each row of x and how sure it is (0 to 1: the mean over its duels)."""
        k = len(self.names)
        if k == 1:
            return np.zeros(len(x), dtype="int64"), np.ones(len(x))
        margin = x @ np.array(self.weights)[:, :-1].T + np.array(self.weights)[:, -1]
        votes, sums, sure = (np.zeros((len(x), k)) for _ in range(3))
        for n, (a, b) in enumerate(self.pairs):
            m = margin[:, n]
            votes[:, a] += m >= 0
            votes[:, b] += m < 0
            sums[:, a] += m
            sums[:, b] -= m
            p = 1 / (1 + np.exp(-np.clip(self.steep[n] * m, -30, 30)))
            sure[:, a] += p / (k - 1)
            sure[:, b] += (1 - p) / (k - 1)
        best = (votes + 0.5 * sums / (1 + np.abs(sums).max(axis=1, keepdims=True))).argmax(axis=1)
        return best, sure[np.arange(len(x)), best]


class Tree:
    """Families over languages."""

    def __init__(self, x: np.ndarray, langs: np.ndarray, **options):
        of = np.array([family(a) for a in langs.tolist()], dtype=object)
        self.families = Duel(x, of, **options) if len(langs) else None
        self.languages = [Duel(x[of == f], langs[of == f], **options) for f in self.families.names] if len(langs) else []

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of each row; without learnt languages all are unknown, with score 0."""
        names, score = [UNKNOWN] * len(x), np.zeros(len(x))
        if self.families is None or not len(x):
            return names, score
        group, sure = self.families.decide(x)
        for g in np.unique(group):
            at = np.flatnonzero(group == g)
            best, own = self.languages[g].decide(x[at])
            score[at] = sure[at] * own
            for i, b in zip(at, best):
                names[i] = self.languages[g].names[b]
        return names, score


def held_out(ident: str = "doc_id") -> F.Column:
    """True for the documents whose languages are never learnt from."""
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{ident}`").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(True))


def train(docs: DataFrame, max_rows: int = MAX_ROWS, ident: str = "doc_id", text: str = "text", lang: str = "lang",
          **options) -> Tree:
    """A tree from documents that are not held out and have a language and a letter; at most ``max_rows`` of them."""
    known = docs.where(F.col(lang).isNotNull() & ~held_out(ident) & F.col(text).rlike(r"\p{L}"))
    langs = known.select(lang).distinct().count()
    if not langs:
        return Tree(np.zeros((0, 1 << BITS)), np.array([], dtype=object))
    # the first rows of each language by a hash of the id; the ids alone are ranked, the texts follow for these only.
    # Parts of a language first, so that the last ranking meets at most PARTS times the quota, however large it is
    most = max(1, max_rows // langs)
    few = known.select(F.col(ident).alias("_i"), F.col(lang).alias("_l")).withColumn("_p", F.pmod(F.hash("_i"), F.lit(PARTS)))
    for group in (["_l", "_p"], ["_l"]):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.xxhash64("_i"), "_i"))
        few = few.withColumn("_n", rank).where(F.col("_n") <= most).drop("_n")
    few = few.select("_i", "_l").distinct()
    rows = (known.select(F.col(ident).alias("_i"), F.col(lang).alias("_l"), F.col(text).alias("_t"))
            .join(F.broadcast(few), ["_i", "_l"]))   # at most max_rows ids

    def run(batches):
        for b in batches:
            x = [grams(t.as_py()).astype("float32").tobytes() for t in b[2]]
            yield pa.RecordBatch.from_arrays([b[0], b[1], pa.array(x, pa.binary())], names=["h", "l", "x"])

    order = F.xxhash64("_i", "_t").alias("h")
    got = (rows.select(order, "_l", "_t").mapInArrow(run, "h long, l string, x binary")
           .orderBy("h", "l", "x").limit(max(max_rows, langs)).toPandas())
    x = np.frombuffer(b"".join(bytes(v) for v in got["x"]), dtype="float32").reshape(len(got), -1).astype("float64")
    return Tree(x, got["l"].to_numpy(dtype=object), **options)


def predict(docs: DataFrame, model: Tree, text: str = "text", name: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` plus the language ``name`` and its ``score``, by the text alone. Columns of these names are replaced."""
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in (name, score)])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{name}` string, `{score}` double"
    shared = docs.sparkSession.sparkContext.broadcast(model)   # languages squared by 2^BITS weights

    def run(batches):
        for b in batches:
            col = b[b.schema.get_field_index(text)]
            for a in range(0, b.num_rows, ROWS):
                part = b.slice(a, ROWS)
                texts = [t.as_py() for t in col[a:a + ROWS]]
                lettered = np.array([has_letter(t) for t in texts])
                x = np.array([grams(t) for t in texts])
                found, sure = shared.value.predict(x)
                found = [f if ok else UNKNOWN for f, ok in zip(found, lettered)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(found, pa.string()), pa.array(np.where(lettered, sure, 0.0), pa.float64())],
                    names=[*part.schema.names, name, score])

    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each document.

    A null text or one without a letter is ``und`` with score 0, as is every text if no
    language could be learnt. A null doc_id counts as held out; repeated rows are scored
    each, and an id that is given with several texts or languages is learnt from once per
    row. With a single language all lettered texts get it, with score 1. Other columns are
    not read.
    """
    model = train(docs, **options)
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
