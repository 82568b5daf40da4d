"""Both packings: losslessness, capacity, padding, offsets; the searches against plain versions."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from newsarc.llm import bfd_packing, kk_packing
from newsarc.llm.tokens import Encoder, default_path

ODD = ["a  b\n\n c\t d", " lead", "trail ", "x y <|endoftext|> z", "it's we'll  \n", "日本語 テスト　x", "\n", "a\x00b",
       "é ñ 😀 9.5%", "'s 't\nre", ".\n,", "", None, "word " * 6000, "x" * 5000]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_path())


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def frame(spark, texts):
    rows = [(i if i else None, t, "c") for i, t in enumerate(texts)] + [(3, texts[3], "again")]
    return spark.createDataFrame(rows, "doc_id long, text string, length string").repartition(3), rows


def test_pieces_equal_the_whole_tokenizer(tokenizer):
    texts = [t for t in ODD if t]
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    enc = Encoder(default_path())
    assert enc.batch(texts) == want == enc.batch(texts)


def test_differencing_packs_every_id_once(spark, tokenizer):
    docs, rows = frame(spark, ODD + [f"text {i} " * (i * 7 % 900) for i in range(60)])
    got = kk_packing.pack(docs, block_windows=8).collect()
    per_doc, per_seq = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4")
        assert r["length"] == len(ids) > 0 and r["ids_crc32"] == zlib.crc32(r["ids"])
        per_doc[r["doc_id"]].append((r["start"], r["doc_tokens"], ids.tolist()))
        per_seq[r["sequence_id"]].append((r["offset"], r["length"], r["seq_len"]))
    for i, t, kind in rows:
        own, want = sorted(per_doc[i]), ids_of(tokenizer, t)
        if i == 3:   # given twice: two documents
            own = own[::2]
        assert [x for _, _, p in own for x in p] == want
        assert {n for _, n, _ in own} == {len(want)}
        assert [s for s, _, _ in own] == np.cumsum([0] + [len(p) for _, _, p in own])[:-1].tolist()
    for parts in per_seq.values():
        at = 0
        for offset, length, total in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048 and {x[2] for x in parts} == {at}


def test_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").coalesce(1)
    r = kk_packing.pack(docs).selectExpr("sum(length) AS n", "count(DISTINCT sequence_id) AS s").first()
    assert r["n"] / 2048 / r["s"] > 0.97


def test_differencing_balances_and_rises():
    rng = random.Random(2)
    for _ in range(30):
        lengths = [rng.randint(1, 512) for _ in range(rng.randint(1, 300))]
        k = max(1, len(lengths) // 6)
        where = kk_packing.differencing(lengths, k)
        sums = np.bincount(where, weights=lengths, minlength=k)
        assert sums.sum() == sum(lengths)
        greedy = np.zeros(k)
        for x in sorted(lengths, reverse=True):
            greedy[greedy.argmin()] += x
        assert np.ptp(sums) <= max(np.ptp(greedy), max(lengths))
        packed = kk_packing.pack_block(lengths, 600)
        assert np.bincount(packed, weights=lengths).max() <= 600
    assert kk_packing.pack_block([600] * 5, 600).tolist() == [0, 1, 2, 3, 4] or len(set(kk_packing.pack_block([600] * 5, 600))) == 5


def test_best_fit_equals_a_plain_search():
    rng = random.Random(4)
    for _ in range(40):
        lengths = [rng.randint(1, 100) for _ in range(rng.randint(1, 120))]
        got = bfd_packing.best_fit(lengths, 100)
        rooms, free = {}, []
        for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
            fits = [r for r in free if r >= lengths[i]]
            room = min(fits) if fits else 100
            if fits:
                free.remove(room)
            free.append(room - lengths[i])
        used = np.bincount(got, weights=lengths)
        assert sorted(100 - used) == sorted(free)   # the same rooms are left


def test_matrix_round_trip(spark, tokenizer):
    docs, rows = frame(spark, ODD)
    per_doc = defaultdict(list)
    for r in bfd_packing.pack(docs, window=256, block_ids=2000).collect():
        ids, pos = np.frombuffer(r["input_ids"], "<u4"), np.frombuffer(r["position_ids"], "<u2")
        assert len(ids) == len(pos) == 256 and r["cu_seqlens"][0] == 0 and r["cu_seqlens"][-1] == r["n_ids"]
        assert not ids[r["n_ids"]:].any() and not pos[r["n_ids"]:].any()
        for d, s, a, z in zip(r["doc_ids"], r["doc_starts"], r["cu_seqlens"], r["cu_seqlens"][1:]):
            assert pos[a:z].tolist() == list(range(z - a))
            per_doc[d].append((s, ids[a:z].tolist()))
    for i, t, _ in rows:
        own = sorted(per_doc[i])
        own = own[::2] if i == 3 else own
        assert [x for _, p in own for x in p] == ids_of(tokenizer, t)


def test_written_matrix_and_empty_table(spark, tmp_path):
    docs, _ = frame(spark, ODD)
    bfd_packing.write(docs, str(tmp_path / "packed"))
    assert spark.read.parquet(str(tmp_path / "packed")).columns[:2] == ["window_id", "input_ids"]
    none = docs.where("false")
    assert bfd_packing.pack(none).count() == 0 and kk_packing.pack(none).count() == 0


def plain_differencing(lengths, k):
    """Partial partitions as lists of (sum, members), the two most uneven merged with opposing orders."""
    parts = [(i, [(x, [i])] + [(0, [])] * (k - 1)) for i, x in enumerate(lengths)]
    node = len(lengths)
    while len(parts) > 1:
        parts.sort(key=lambda p: (-(p[1][0][0] - p[1][-1][0]), p[0]))
        (_, a), (_, b) = parts[:2]
        merged = [(x[0] + y[0], x[1] + y[1]) for x, y in zip(a, reversed(b))]
        merged.sort(key=lambda s: -s[0])        # stable, as the order inside a window is of no account
        parts = parts[2:] + [(node, merged)]
        node += 1
    return sorted(s for s, _ in parts[0][1]), parts[0][1]


def test_differencing_equals_a_plain_one():
    rng = random.Random(7)
    for _ in range(60):
        lengths = [rng.randint(1, rng.choice([3, 40, 512])) for _ in range(rng.randint(2, 60))]
        k = rng.randint(2, 9)
        where = kk_packing.differencing(lengths, k)
        sums = np.bincount(where, weights=lengths, minlength=k).astype(int)
        want, windows = plain_differencing(lengths, k)
        assert sorted(sums.tolist()) == want
        members = {i: w for w, (_, ids) in enumerate(windows) for i in ids}
        assert sorted(members) == list(range(len(lengths)))
