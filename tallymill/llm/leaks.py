"""Evaluation passages inside training text (problem 8): rare n-gram seeds, then Smith-Waterman alignment of words.

Every document is read once: its words become numbers of the items' vocabulary, which are written. The n-grams of the
test items are counted over all of them; those not much more frequent than the rare ones of their stretch of an item are its seeds, so that
a part that leaks often isn't outdone by parts that never occur. Each (document, item) with enough seeds is aligned word
by word around its n-grams. The item's share inside the best one or two passages decides.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.functions.text import fold, words
from tallymill.session import materialize

GRAM = 3
MIN_SHARE = 0.5
STRETCHES = 8
# Shares of an item's n-grams that a document must have to be aligned: of all, on its two best diagonals, on the best one,
# and of the seeds. An item half of whose text stands with every fifth word changed keeps 0.2 of its n-grams, a whole one
# with every fourth word changed a quarter.
MIN_GRAM_SHARE = 0.19
MIN_RUNS_SHARE = 0.19
MIN_RUN_SHARE = 0.08
MIN_SEED_SHARE = 0.06
SECOND_SHARE = 0.08  # share of an item's words that a second passage must match
_BAND = 12
RARE = 2
ITEMS_AT_ONCE = 5_000
BYTES_AT_ONCE = 8 << 20  # what goes to the tasks at once is bounded in items and in their text
_MATCH, _MISS, _GAP = 2, -2, -2
_WIDE = 1 << 21
_WINDOW = 4096  # new document words of a window of the alignment
_CELLS = 4_000_000  # cells of the alignment held at once


def _plain(word: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c))


def _tokens(text: str | None) -> list[str]:
    found = words(fold(text))
    if not found or max(text) < "\u2e80":
        return found
    out = []
    for w in found:
        # scripts without spaces: one token a character
        if w[0] >= "\u2e80" and len(w) > 1:
            out.extend(w)
        else:
            out.append(w)
    return out


class ItemIndex:
    """Vocabulary and n-grams of a bounded block of test items."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids: list[int] = []
        self.vocabulary: dict[str, int] = {}
        self.words: list[np.ndarray] = []
        for item, text in items:
            tokens = _tokens(text)
            if len(tokens) < GRAM:
                continue
            codes = []
            for w in tokens:
                p = _plain(w)
                code = self.vocabulary.setdefault(p, len(self.vocabulary) + 1)
                self.vocabulary.setdefault(w, code)
                codes.append(code)
            self.ids.append(item)
            self.words.append(np.array(codes, dtype=np.int64))
        owner, keys, stretch, place = [], [], [], []
        for k, codes in enumerate(self.words):
            g, at = np.unique(self.grams(codes), return_index=True)
            owner.append(np.full(len(g), k, dtype=np.int64))
            keys.append(g)
            stretch.append(at * STRETCHES // max(1, len(codes) - GRAM + 1))
            place.append(at)
        self.n_grams = np.array([len(k) for k in keys], dtype=np.int64)
        every = np.concatenate(keys) if keys else np.zeros(0, dtype=np.int64)
        who = np.concatenate(owner) if owner else np.zeros(0, dtype=np.int64)
        order = np.argsort(every, kind="stable")
        self.keys, first = np.unique(every[order], return_index=True)
        self.owner = who[order]
        self.stretch = (np.concatenate(stretch) if stretch else np.zeros(0, dtype=np.int64))[order]
        self.place = (np.concatenate(place) if place else np.zeros(0, dtype=np.int64))[order]
        self.first = np.append(first, len(every))
        self.rare = np.ones(len(every), dtype=bool)

    @staticmethod
    def grams(codes: np.ndarray) -> np.ndarray:
        """Keys of the n-grams of known words, -1 where a word is unknown."""
        if len(codes) < GRAM:
            return np.zeros(0, dtype=np.int64)
        key = np.zeros(len(codes) - GRAM + 1, dtype=np.int64)
        known = np.ones(len(key), dtype=bool)
        for k in range(GRAM):
            part = codes[k : len(codes) - GRAM + 1 + k]
            key = key * _WIDE + part
            known &= part > 0
        return np.where(known, key, -1)

    def codes(self, text: str | None) -> np.ndarray:
        get = self.vocabulary.get
        tokens = _tokens(text)
        if text and not text.isascii():
            # accents don't count on either side
            return np.array([get(w, 0) or (0 if w.isascii() else get(_plain(w), 0)) for w in tokens], dtype=np.int64)
        return np.array([get(w, 0) for w in tokens], dtype=np.int64)

    def places(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word positions of the document's n-grams that items have, and their places in keys."""
        g = self.grams(codes)
        if not len(g) or not len(self.keys):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, g), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[at] == g)
        return hit, at[hit]

    def weigh(self, df: np.ndarray) -> None:
        """Marks as seeds the n-grams at most RARE times as frequent as the lower quartile of those met in their stretch."""
        counts = np.repeat(df, np.diff(self.first))
        group = self.owner * STRETCHES + self.stretch
        order = np.lexsort((counts, counts == 0, group))
        size = np.bincount(group, minlength=len(self.ids) * STRETCHES)
        met = np.bincount(group[counts > 0], minlength=len(self.ids) * STRETCHES)
        quarter = np.cumsum(size) - size + np.maximum(0, (met - 1) // 4)
        typical = np.where(met > 0, counts[order[np.minimum(quarter, len(order) - 1)]], 0) if len(order) else np.zeros(0, dtype=np.int64)
        self.rare = counts <= RARE * typical[group]


def _align(pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int, int, int, int]]:
    """Best local alignment of each (item words, document words): matches, item span and document span.

    A long document goes in windows. An alignment that scores has fewer misses and gaps than matches, so it spans less
    than twice the item's words; windows that share as many lose none, whatever the document's length.
    """
    best: list[tuple[int, int, int, int, int, int]] = [(0, 0, 0, 0, 0, 0)] * len(pairs)
    windows = []
    for k, (a, b) in enumerate(pairs):
        shared = 2 * len(a)
        step = max(_WINDOW, shared)
        for at in range(0, max(1, len(b) - shared), step):
            windows.append((k, at, (a, b[at : at + step + shared])))
    i = 0
    while i < len(windows):
        n, rows, cols = 0, 0, 0
        while i + n < len(windows):
            a, b = windows[i + n][2]
            rows, cols = max(rows, len(a)), max(cols, len(b))
            if n and (n + 1) * (rows + 1) * (cols + 1) > _CELLS:
                break
            n += 1
        for (k, at, _), (score, m, i0, i1, j0, j1) in zip(windows[i : i + n], _align_whole([w[2] for w in windows[i : i + n]])):
            # equal scores go to the one that ends first in the item, then in the document
            if (score, -i1, -(j1 + at)) > (best[k][0], -best[k][3], -best[k][5]):
                best[k] = (score, m, i0, i1, j0 + at, j1 + at)
        i += n
    return [found[1:] for found in best]


def _align_whole(pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int, int, int, int, int]]:
    """Score of the best local alignment of each pair, and what _align says of it.

    All pairs go through the recurrence together; gaps along the document are a running maximum.
    """
    n = len(pairs)
    rows = max(len(a) for a, _ in pairs)
    cols = max(len(b) for _, b in pairs)
    item = np.full((n, rows), -1, dtype=np.int32)
    doc = np.full((n, cols), -2, dtype=np.int32)
    for k, (a, b) in enumerate(pairs):
        item[k, : len(a)] = a
        doc[k, : len(b)] = b
    # no sum of a score and the slope exceeds the match of every word and a gap at every column
    kind = np.int16 if _MATCH * rows - _GAP * (cols + 1) <= np.iinfo(np.int16).max else np.int32
    h = np.zeros((rows + 1, n, cols + 1), dtype=kind)
    slope = (np.arange(cols + 1) * -_GAP).astype(kind)
    for i in range(rows):
        same = doc == item[:, i : i + 1]
        t = np.maximum(h[i] + _GAP, 0)
        np.maximum(t[:, 1:], h[i][:, :-1] + np.where(same, _MATCH, _MISS).astype(kind), out=t[:, 1:])
        h[i + 1] = np.maximum.accumulate(t + slope, axis=1) - slope
    out = []
    for k in range(n):
        mine = h[:, k, :]
        i, j = np.unravel_index(int(mine.argmax()), mine.shape)
        i1, j1, matches = int(i), int(j), 0
        score = int(mine[i1, j1])
        a, b = pairs[k]
        i, j = i1, j1
        while i > 0 and j > 0 and mine[i, j] > 0:
            v = int(mine[i, j])
            same = a[i - 1] == b[j - 1] if i <= len(a) and j <= len(b) else False
            if v == int(mine[i - 1, j - 1]) + (_MATCH if same else _MISS):
                matches += bool(same)
                i, j = i - 1, j - 1
            elif v == int(mine[i - 1, j]) + _GAP:
                i -= 1
            else:
                j -= 1
        out.append((score, matches, int(i), i1, int(j), j1))
    return out


def held_shares(pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[float]:
    """Share of each item's words inside the best one or two passages of the document."""
    first = _align(pairs)
    again, rest = [], []
    shares = []
    for k, ((a, b), (m, i0, i1, j0, j1)) in enumerate(zip(pairs, first)):
        share = (i1 - i0) / len(a)
        shares.append(share)
        if share < 1.0:
            a2, b2 = a.astype(np.int64).copy(), b.astype(np.int64).copy()
            a2[i0:i1] = -1
            b2[j0:j1] = 0
            again.append(k)
            rest.append((a2, b2))
    if rest:
        for k, (m, i0, i1, _, _) in zip(again, _align(rest)):
            if m >= SECOND_SHARE * len(pairs[k][0]):
                shares[k] += (i1 - i0) / len(pairs[k][0])
    return shares


def leaks_of(index: ItemIndex, coded: list[tuple[int, np.ndarray]], share: float = MIN_SHARE) -> list[tuple[int, int, float]]:
    """(item_id, doc_id, share) of the documents, given as index.codes() of their texts, that hold at least `share` of an item."""
    wanted = []
    for doc, codes in coded:
        at, key = index.places(codes)
        if not len(key):
            continue
        distinct = np.unique(key)
        count = index.first[distinct + 1] - index.first[distinct]
        span = np.arange(int(count.sum())) + np.repeat(index.first[distinct] - np.cumsum(count) + count, count)
        owner = index.owner[span]
        seeds = np.bincount(owner[index.rare[span]], minlength=len(index.ids))
        grams = np.bincount(owner, minlength=len(index.ids))
        for k in np.flatnonzero((seeds > 0) & (seeds >= MIN_SEED_SHARE * index.n_grams) & (grams >= MIN_GRAM_SHARE * index.n_grams)):
            mine = span[owner == k]
            keys = np.searchsorted(index.first, mine, side="right") - 1
            where = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = keys[where] == key
            # n-grams of a passage lie on one diagonal, those of usual wording are strewn
            diagonal = at[hit] - index.place[mine[where[hit]]]
            band = diagonal // _BAND
            band -= band.min()
            size = np.bincount(band)
            if len(size) > 1:
                size = size[:-1] + size[1:]
            top = int(size.argmax())
            best = int(size[top])
            size[max(0, top - 1) : top + 2] = 0
            if best < MIN_RUN_SHARE * index.n_grams[k] or best + int(size.max()) < MIN_RUNS_SHARE * index.n_grams[k]:
                continue
            places = at[hit]
            words_of = index.words[k]
            # the stretches around the n-grams met, parts without any left out
            margin = GRAM + 8
            keep = np.zeros(len(codes), dtype=np.int32)
            lo, hi = np.maximum(places - margin, 0), np.minimum(places + margin, len(codes))
            np.add.at(keep, lo, 1)
            np.add.at(keep, hi[hi < len(codes)], -1)
            wanted.append((k, doc, words_of, codes[np.cumsum(keep) > 0]))
    wanted.sort(key=lambda w: (len(w[3]), len(w[2])))
    found, k = [], 0
    while k < len(wanted):
        step = max(1, min(64, 2_000_000 // ((len(wanted[min(k + 63, len(wanted) - 1)][3]) + 1) * 140)))
        block = wanted[k : k + step]
        for (item, doc, _, _), s in zip(block, held_shares([(a, b) for _, _, a, b in block])):
            if s >= share:
                found.append((index.ids[item], doc, s))
        k += step
    return found


def find_leaks(documents: DataFrame, items: DataFrame, share: float = MIN_SHARE) -> DataFrame:
    """(item_id, doc_id, share): documents that hold at least `share` of an item's words, in order, in one or two passages.

    items is the held-out set; it goes to the tasks in blocks of at most ITEMS_AT_ONCE items and about BYTES_AT_ONCE of text,
    one pass over the texts each, so that what is sent stays bounded. Case, accents, punctuation, layout and single words may differ. Items and
    documents with null, empty or shorter text than an n-gram are in no case; repeated documents each count.

    A second passage counts if it matches at least SECOND_SHARE of the item's words. Before the alignment a document must
    hold the shares of the item's n-grams named at the top; a passage changed so often that fewer are left isn't found.
    """
    spark = documents.sparkSession
    base = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    listed = items.select(F.col("item_id").cast("bigint"), F.col("text").cast("string")).where("text is not null").dropDuplicates().orderBy("item_id", "text")
    out, block, held = None, [], 0

    def one(block: list[tuple[int, str]]) -> DataFrame:
        index = ItemIndex(block)

        def code(batches):
            for b in batches:
                for k in range(0, b.num_rows, 1000):
                    part = b.slice(k, 1000)
                    found = [index.codes(t) for t in part.column("text").to_pylist()]
                    offsets = np.zeros(len(found) + 1, dtype=np.int32)
                    np.cumsum([len(c) for c in found], out=offsets[1:])
                    flat = np.concatenate([*found, np.zeros(0, dtype=np.int64)]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["doc_id", "codes"])

        coded = materialize(base.mapInArrow(code, "doc_id bigint, codes array<int>"), "leak-codes")

        def arrays(b: pa.RecordBatch) -> list[tuple[int, np.ndarray]]:
            lists = b.column("codes")
            flat, at = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            return [(doc, flat[x:y]) for doc, x, y in zip(b.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist())]

        def count(batches):
            total = np.zeros(len(index.keys), dtype=np.int64)
            for b in batches:
                for _, codes in arrays(b):
                    total[np.unique(index.places(codes)[1])] += 1
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["k", "n"])

        counted = coded.mapInArrow(count, "k bigint, n bigint").groupBy("k").agg(F.sum("n").alias("n")).toPandas()
        df = np.zeros(len(index.keys), dtype=np.int64)
        df[counted["k"].to_numpy()] = counted["n"].to_numpy()
        index.weigh(df)

        def search(batches):
            for b in batches:
                got = leaks_of(index, arrays(b), share)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64()), pa.array([g[2] for g in got], pa.float64())],
                    names=["item_id", "doc_id", "share"],
                )

        return coded.mapInArrow(search, "item_id bigint, doc_id bigint, share double")

    for row in listed.toLocalIterator():
        block.append((row[0], row[1]))
        held += len(row[1].encode("utf-8", "surrogatepass"))
        if len(block) == ITEMS_AT_ONCE or held >= BYTES_AT_ONCE:
            part, block, held = one(block), [], 0
            out = part if out is None else out.unionByName(part)
    if block:
        part = one(block)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], "item_id bigint, doc_id bigint, share double")


def found_leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, doc_id) of every leak."""
    return find_leaks(documents, items).select("item_id", "doc_id").distinct()
