"""Token ids of whole texts by a public tokenizer file, with a bounded cache of pieces.

A blank between two words and a line break between two words are always token
borders of the byte-level tokenizer, so a text without runs of blanks is split
there and each distinct piece is encoded once per worker while the cache holds
it. Pieces are encoded with the file's own vocabulary and merge order; texts with
other white space, control characters or special tokens go whole through the
tokenizer itself.
"""

from __future__ import annotations

import json
import os
from array import array

import numpy as np

CACHE_PIECES = 600_000  # pieces kept per worker; emptied when full
CACHED_CHARS = 64       # longer pieces are not kept
# Fixed value: how the byte-level tokenizer splits a text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of() -> dict[str, int]:
    """The character that a byte-level vocabulary writes for each byte: printable ones for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """ids(text) as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["id"] for t in spec.get("added_tokens", [])}
        byte = _byte_of()
        ranks = {bytes(byte[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if i not in special}
        self.piece = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.cache: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def batch(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, as bytes; a null text has none."""
        cache, piece, out = self.cache, self.piece, []
        if len(cache) > CACHE_PIECES:
            cache.clear()
        long = []
        for t in texts:
            if not t:
                out.append(b"")
            elif ("  " in t or "\n\n" in t or " \n" in t or "\n " in t or "<|" in t
                  or not t.replace("\n", "").isprintable()):
                out.append(self._whole(t))
            else:
                parts = t.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")
                for x in set(parts).difference(cache):
                    cache[x] = array("I", piece(x)).tobytes()
                    if len(x) > CACHED_CHARS:
                        long.append(x)
                out.append(b"".join(map(cache.__getitem__, parts)))
        for x in long:
            cache.pop(x, None)
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def documents_ids(batches, path: str, text: str, end: int | None, chars: int = 2_000_000):
    """(record batch, row, ids) for every row; ``end`` is appended to each document."""
    enc = encoder(path)
    tail = b"" if end is None else np.array([end], "<u4").tobytes()
    for b in batches:
        col, at = b[text], 0
        while at < b.num_rows:
            texts, n = [], 0
            while at + len(texts) < b.num_rows and n < chars and len(texts) < 256:
                texts.append(col[at + len(texts)].as_py())
                n += len(texts[-1] or "")
            for k, ids in enumerate(enc.batch(texts)):
                yield b, at + k, np.frombuffer(ids + tail, "<u4")
            at += len(texts)
