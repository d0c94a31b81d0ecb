"""Byte-level BPE in batched numpy merge rounds.

The distinct pieces of a batch are laid out as one flat array of symbols. In each round all adjacent pairs of all pieces
look up their rank together by binary search over the sorted pair keys; each piece merges its lowest-ranked pair wherever
that pair stands, left to right, and the array is compacted. Rounds end when no piece holds a known pair.

A null or empty text has no ids and decodes to the empty text. Repeated rows give equal ids.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.common import text_steps

#: Pieces whose ids a worker keeps, and the longest piece worth keeping.
CACHE_PIECES, CACHE_CHARS = 300_000, 40


@lru_cache(4)
def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte: itself where printable, else from 256 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Codec:
    """Encodes and decodes with a byte-level BPE vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        import regex

        import public_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        symbols = byte_symbols()
        self.first = np.array([vocab[symbols[b]] for b in range(256)], dtype=np.int64)
        self.base = int(max(vocab.values())) + 1
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        keys = np.array([vocab[a] * self.base + vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        back = {c: b for b, c in symbols.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of = {i: bytes(back[c] for c in s) for s, i in vocab.items() if all(c in back for c in s)}
        self.bytes_of |= {i: c.encode() for c, i in self.special.items()}
        self.pieces = regex.compile(public_tokenizers.PATTERN).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.cache: dict[str, bytes] = {}

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece."""
        n = np.array([len(p) for p in pieces], dtype=np.int64)
        sym = self.first[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), n)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        none = len(self.made)
        while len(sym) > 1:
            key = sym[:-1] * self.base + sym[1:]
            at = np.searchsorted(self.keys, key)
            at[at == len(self.keys)] = 0
            rank = np.where((self.keys[at] == key) & (owner[:-1] == owner[1:]), self.ranks[at], none)
            heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            low = np.minimum.reduceat(np.r_[rank, none], heads)
            width = np.diff(np.r_[heads, len(sym)])
            live = np.repeat(low < none, width)
            if not live.all():  # finished pieces leave the array
                done.append((owner[~live], sym[~live]))
                if not live.any():
                    sym = sym[:0]
                    break
                keep = np.r_[rank, none][live]
                sym, owner, low, width = sym[live], owner[live], low[low < none], width[low < none]
                rank = keep[:-1]
            hit = rank == np.repeat(low, width)[:-1]
            hit &= owner[:-1] == owner[1:]
            if (hit[1:] & hit[:-1]).any():  # runs such as a a a: every second one from the left
                i = np.arange(len(hit))
                start = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], i, -1))
                hit &= (i - start) % 2 == 0
            where = np.flatnonzero(hit)
            sym[where] = self.made[rank[where]]
            stay = np.ones(len(sym), dtype=bool)
            stay[where + 1] = False
            sym, owner = sym[stay], owner[stay]
        if len(sym):
            done.append((owner, sym))
        owner, sym = np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])
        order = np.argsort(owner, kind="stable")
        return np.split(sym[order].astype("<u4"), np.cumsum(np.bincount(owner, minlength=len(pieces)))[:-1])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cache, split = self.cache, []
        fresh: dict[str, None] = {}
        for t in texts:
            parts = self.cut.split(t) if self.cut and any(s in t for s in self.special) else (t,)
            row = []
            for p in parts:
                if p in self.special:
                    row.append(p)
                else:
                    row += self.pieces(p)
            split.append(row)
            fresh.update(dict.fromkeys(row))
        local: dict[str, bytes] = {s: int(i).to_bytes(4, "little") for s, i in self.special.items()}
        new = [p for p in fresh if p not in cache and p not in local]
        if new:
            ids = self.merge([p.encode() for p in new])
            local |= dict(zip(new, (x.tobytes() for x in ids)))
        out = []
        for row in split:
            out.append(b"".join([cache.get(p) or local[p] for p in row]))
        for p in new:
            if len(cache) >= CACHE_PIECES:
                break
            if len(p) <= CACHE_CHARS:
                cache[p] = local[p]
        return out

    def decode(self, ids: bytes) -> str:
        of = self.bytes_of
        return b"".join([of.get(i, b"") for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", "replace")


@lru_cache(2)
def codec(path: str) -> Codec:
    return Codec(path)


def encoded(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids (binary, unsigned 32-bit little-endian) and the decoded text."""

    def rows(batches):
        c = codec(path)
        for keys, texts in text_steps(batches, key, text=text):
            ids = c.encode(texts)
            yield pa.RecordBatch.from_pydict({key: pa.array(keys, pa.int64()), "ids": pa.array(ids, pa.binary()), "decoded": pa.array([c.decode(x) for x in ids], pa.string())})

    return df.select(F.col(key).cast("long"), text).mapInArrow(rows, f"{key} long, ids binary, decoded string")


def query(documents: DataFrame, path: str) -> DataFrame:
    """Digests are taken in the task that encodes, so ids never leave it."""

    def rows(batches):
        c = codec(path)
        for keys, texts in text_steps(batches, "doc_id"):
            ids = c.encode(texts)
            hexed = lambda xs: pa.array([hashlib.sha256(x).hexdigest() for x in xs], pa.string())
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(keys, pa.int64()), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "ids_sha256": hexed(ids), "decoded_sha256": hexed(c.decode(x).encode() for x in ids)})

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
