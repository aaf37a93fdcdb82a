"""Hashing embedder: lower-case character n-grams within words, signed 32-bit Murmur3 buckets, unit rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIM, NGRAM_MIN, NGRAM_MAX = 512, 3, 5


def murmur3(data: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int = 0) -> np.ndarray:
    """Signed 32-bit Murmur3 of many byte ranges of one buffer at once."""
    c1, c2 = np.uint32(0xCC9E2D51), np.uint32(0x1B873593)
    rotl = lambda x, r: (x << np.uint32(r)) | (x >> np.uint32(32 - r))
    padded = np.concatenate([data.astype(np.uint32), np.zeros(4, dtype=np.uint32)])
    h = np.full(len(start), seed, dtype=np.uint32)
    with np.errstate(over="ignore"):
        for block in range(int(size.max(initial=0)) // 4 + 1):
            at, left = start + 4 * block, size - 4 * block
            safe = np.minimum(at, len(data))
            word = np.zeros(len(start), dtype=np.uint32)
            for k in range(4):
                word |= np.where(left > k, padded[np.minimum(safe + k, len(padded) - 1)] << np.uint32(8 * k), np.uint32(0))
            word = rotl(word * c1, 15) * c2
            whole = left >= 4
            h = np.where(left > 0, h ^ word, h)
            h = np.where(whole, rotl(h, 13) * np.uint32(5) + np.uint32(0xE6546B64), h)
        h ^= size.astype(np.uint32)
        h ^= h >> np.uint32(16)
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
        h *= np.uint32(0xC2B2AE35)
        h ^= h >> np.uint32(16)
    return h.view(np.int32)


def embed(texts: list[str | None], dim: int = DIM) -> np.ndarray:
    """Unit rows of the texts; a text without any word is a zero row."""
    words, owner = [], []
    for i, t in enumerate(texts):
        mine = (t or "").lower().split()
        words += mine
        owner += [i] * len(mine)
    out = np.zeros((len(texts), dim))
    if not words:
        return out
    joined = "".join(f" {w} " for w in words)
    chars = np.array([len(w) + 2 for w in words], dtype=np.int64)
    ends = np.repeat(np.cumsum(chars), chars)
    whose = np.repeat(np.array(owner, dtype=np.int64), chars)
    raw = np.frombuffer(joined.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    first = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
    place = np.arange(len(joined))
    for n in range(NGRAM_MIN, NGRAM_MAX + 1):
        at = place[place + n <= ends]
        h = murmur3(raw, first[at], first[at + n] - first[at])
        np.add.at(out, (whose[at], np.abs(h.astype(np.int64)) % dim), np.where(h >= 0, 1.0, -1.0))
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return np.divide(out, norm, out=out, where=norm > 0)


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def embed_col(texts: pa.Array) -> pa.Array:
    rows = embed(texts.to_pylist())
    return pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, DIM, dtype=np.int32)), pa.array(rows.reshape(-1)))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays, in [-1, 1]; null where one is all zero."""
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))))
