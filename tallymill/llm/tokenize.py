"""Token ids of a whole corpus by a public byte-level BPE (problem 7), by content-defined chunk reuse.

Texts are cut wherever a rolling hash over the last characters hits, inside words or not, so that shared passages give
the same chunks wherever they stand. A chunk is taken apart at the places in it where a pre-token surely starts: the body
between the first and the last of them is encoded once per worker and looked up after that. What lies between two
bodies is a join. It is re-encoded together with the last pre-tokens of the body before and the first ones of the body
after; if the ids of those come out unchanged the join is repaired, else it grows over the whole bodies and at last over
the whole text.
"""

from __future__ import annotations

import base64
import functools
import os

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZERS = os.environ.get("TALLYMILL_TOKENIZERS", "/opt/tokenizers")
WINDOW = 6
CUT_BITS = 8  # chunks of 256 characters on average
CACHE = 40_000  # chunks of each of the two generations of a worker's memory
_SLAB = 2_000_000


# Fixed value: the split pattern that sure_starts() and _classes() are written for.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.lru_cache(maxsize=2)
def _encoder(directory: str, name: str):
    import sys

    import tiktoken

    parent, package = os.path.split(os.path.realpath(directory.rstrip("/")))
    if parent not in sys.path:
        sys.path.append(parent)
    pattern = __import__(package).PATTERN
    if pattern != SPLIT:
        raise ValueError("the tokenizer splits texts by another pattern than sure_starts() knows")
    with open(os.path.join(directory, name + ".tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """0 white space, 1 letter, 2 number, 3 other, 4 apostrophe: of every code point."""
    out = np.full(0x110000, 3, dtype=np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for k, kind in ((0, r"\s+"), (1, r"\p{L}+"), (2, r"\p{N}+")):
        for m in regex.finditer(kind, every):
            i, j = ord(m[0][0]), ord(m[0][-1])
            if j - i == len(m[0]) - 1:
                out[i : j + 1] = k
            else:
                for c in m[0]:
                    out[ord(c)] = k
    out[ord("'")] = 4
    return out


@functools.lru_cache(maxsize=1)
def _gear() -> np.ndarray:
    return np.random.default_rng(7).integers(0, 1 << 32, size=4096, dtype=np.uint32)


def cuts(codes: np.ndarray) -> np.ndarray:
    """Ascending places (0 < place < len) after characters whose rolling hash hits: by content alone, anywhere."""
    gear = _gear()[codes & 4095]
    h = gear.copy()
    for k in range(1, WINDOW):
        h[k:] += gear[:-k] << np.uint32(k)
    at = np.flatnonzero((h >> np.uint32(WINDOW)) & np.uint32((1 << CUT_BITS) - 1) == 0) + 1
    return at[at < len(codes)]


def sure_starts(codes: np.ndarray) -> np.ndarray:
    """Ascending places (0 < place < len) where a pre-token of SPLIT starts whatever stands further left or right."""
    kind = _classes()[codes]
    before, after = kind[:-1], kind[1:]
    return np.flatnonzero((before != after) & (before != 0) & (before != 4) & ~((before == 3) & (after == 4))) + 1


class _Memory:
    """What was met lately: two generations, the older one dropped when the newer is full."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def get(self, key: str):
        got = self.new.get(key)
        if got is None:
            got = self.old.get(key)
            if got is not None:
                self.put(key, got)
        return got

    def put(self, key: str, value) -> None:
        if len(self.new) >= self.size:
            self.old, self.new = self.new, {}
        self.new[key] = value


class ChunkEncoder:
    """Ids of texts, with a bounded memory of the chunks met so far; `met` and `encoded` count chunks."""

    def __init__(self, directory: str = TOKENIZERS, name: str = "byte_bpe_50k"):
        self.encode = _encoder(directory, name).encode_ordinary
        self.bodies, self.joins = _Memory(CACHE), _Memory(CACHE)
        self.met = self.encoded = self.widened = 0

    def ids(self, text: str | None) -> list[int]:
        return self.batch([text])[0]

    def batch(self, texts: list[str | None]) -> list[list[int]]:
        out: list[list[int]] = []
        # slabs of texts joined by a line feed, so that one vector pass finds the places of many texts
        start = 0
        while start < len(texts):
            stop, size = start, 0
            while stop < len(texts) and (size == 0 or size < _SLAB):
                size += len(texts[stop] or "") + 1
                stop += 1
            out += self._slab([t or "" for t in texts[start:stop]])
            start = stop
        return out

    def _slab(self, texts: list[str]) -> list[list[int]]:
        joined = "\n".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.cumsum(np.array([len(t) + 1 for t in texts], dtype=np.int64)) - 1
        begins = np.append(0, ends[:-1] + 1)
        if len(codes) < 2:
            return [self.encode(t) if t else [] for t in texts]
        # chunk borders: hash cuts, and both ends of every text
        borders = np.unique(np.concatenate([cuts(codes), begins, ends]))
        starts = sure_starts(codes)
        # of every chunk the first two and the last two sure starts strictly inside it
        low, high = np.searchsorted(starts, borders[:-1], side="right"), np.searchsorted(starts, borders[1:], side="left")
        last = max(0, len(starts) - 1)
        places = np.stack([starts[np.clip(k, 0, last)] for k in (low, low + 1, high - 2, high - 1)], axis=1) if len(starts) else np.zeros((len(low), 4), dtype=np.int64)
        whole = (high - low >= 4).tolist()
        first = np.searchsorted(borders, begins).tolist()
        final = np.searchsorted(borders, ends).tolist()
        at, of = borders.tolist(), places.tolist()
        return [self._text(joined, at, of, whole, i, j) if t else [] for t, i, j in zip(texts, first, final)]

    def _body(self, chunk: str, a: int, place: list[int]) -> tuple[list[int], list[int], list[int]]:
        """Ids of a chunk's body: its first pre-tokens, the middle, its last pre-tokens."""
        got = self.bodies.get(chunk)
        self.met += 1
        if got is None:
            p, q, r, s = (x - a for x in place)
            got = self.encode(chunk[p:q]), self.encode(chunk[q:r]), self.encode(chunk[r:s])
            self.encoded += 1
            self.bodies.put(chunk, got)
        return got

    def _text(self, joined: str, at: list[int], of: list[list[int]], whole: list[bool], i: int, j: int) -> list[int]:
        begin, end = at[i], at[j]
        out: list[int] = []
        left, edge, known = begin, begin, []  # join from `left` on; text[edge:left] has the ids `known`, already in out
        for k in range(i, j):
            if not whole[k]:
                continue  # a chunk without a body lies in the join
            p, q, r, s = of[k]
            head, middle, tail = self._body(joined[at[k] : at[k + 1]], at[k], of[k])
            seam = self._repair(joined[edge:q], known, head)
            if seam is None:
                self.widened += 1
                return self.encode(joined[begin:end])
            out += seam
            out += middle
            out += tail
            left, edge, known = s, r, tail
        if left == begin:
            return self.encode(joined[begin:end])
        seam = self._repair(joined[edge:end], known, [])
        if seam is None:
            self.widened += 1
            return self.encode(joined[begin:end])
        return out + seam

    def _repair(self, window: str, before: list[int], after: list[int]) -> list[int] | None:
        """Ids of a join and of what follows it in the window, if the known ids on both its sides come out unchanged."""
        got = self.joins.get(window)
        if got is None:
            got = self.encode(window)
            self.joins.put(window, got)
        n = len(before)
        if len(got) >= n + len(after) and got[:n] == before and got[len(got) - len(after) :] == after:
            return got[n:]
        return None


def _encode_batches(directory: str, name: str):
    def run(batches):
        encoder = ChunkEncoder(directory, name)
        for b in batches:
            for k in range(0, b.num_rows, 1000):
                part = b.slice(k, 1000)
                ids = encoder.batch(part.column(1).to_pylist())
                offsets = np.zeros(len(ids) + 1, dtype=np.int32)
                np.cumsum([len(x) for x in ids], out=offsets[1:])
                flat = np.fromiter((x for one in ids for x in one), dtype=np.int32, count=int(offsets[-1]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["doc_id", "ids"])

    return run


def token_ids(documents: DataFrame, key: str = "doc_id", text: str = "text", name: str = "byte_bpe_50k", directory: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>), one row per document, without special tokens; null and empty texts have the empty list.

    directory holds the tokenizer files and must be readable on every executor. Whole texts are encoded, blanks and
    repeated rows included; strings that look like special tokens are ordinary text. Further columns aren't read.
    """
    run = _encode_batches(directory or TOKENIZERS, name)
    return documents.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id bigint, ids array<int>")
