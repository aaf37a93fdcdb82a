"""Groups of records that differ by small edits (problem 1): exact set similarity join and its components.

Two records are alike if at least 0.65 of all their words are common. Words are known by 32-bit hashes (two of one
pair's words share one about once in a million pairs). Each distinct word set is written under the rarest of its words,
as many as a partner could miss, each time with a parity sketch of the words that follow in the order of rarity.
Records that share a word meet in tiles, where exclusive-or and bit counts of the sketches bound their distance from
below; tile pairs whose counts of following words differ beyond the radius are skipped. In a large block sets that may
differ by few words meet only where a stretch of their sketches is equal, since r differing words can't reach each of
r + 1 stretches. What is left is compared word by word.

With sizes m and n, alike means 33 common >= 13 (m + n), that is a difference of at most 7 (m + n) / 33. If the first
common word in the order of rarity stands at p and q, then p + q words differ before it, so the words after it differ
by at most (7 m - 33 p + 7 n - 33 q) / 33: that is the radius. It is negative unless 33 p <= 7 m on at least one side
(the short prefix) and 20 q <= 7 n on the other (the long one). Nor is a set written under a frequent word if no set of
that word, with the largest 7 m - 33 p among those with about as many words to follow, makes a radius with it that
reaches their difference in number. No link is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.functions.bitmap import hits, member_bits
from tallymill.functions.text import fold, words
from tallymill.llm.copies import exchange_key, named_fields
from tallymill.operators.components import connected_components
from tallymill.operators.skew import join_counted
from tallymill.session import materialize

_HEIGHT, _WIDTH = 128, 2048
_SMALL, _MEDIUM = 24, 1024
_FLUSH = 40_000
_BLOCK = 1 << 19  # rows of a word's shard: a block is worked in pairs of shards, so no task needs more than two of them
_LEVELS = ((4, 1 << 14), (7, 1 << 15), (9, 1 << 19))  # radius up to which stretches are compared, rows from which that pays
_PROBE = 400_000  # pairs looked at together
_FOLLOW, _SPAN = 32, 8  # steps of the number of words that follow, words of a step
_ROWS = 100_000  # prefix rows of a shuffle partition, so that partitions don't grow with the data
_PARTS = 20_000
_WORD_CACHE = 200_000
_NONE = -(1 << 40)
_KEYS = "tok bigint, meta bigint, sk bigint, s0 bigint, s1 bigint"


def alike(common: int, m: int, n: int) -> bool:
    """At least 0.65 of the words of two sets of m and n words, `common` of them shared, occur in both."""
    return m + n > 0 and 33 * common >= 13 * (m + n)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _profiles(batches):
    """Keys of each record; its word hashes only where its word set is new to the partition."""
    known: dict[str, int] = {}
    seen: set[int] = set()
    digest = xxhash.xxh3_64_intdigest
    for b in batches:
        flat: list[int] = []
        sizes, k1, ck, taken = [], [], [], []
        for q, a in zip(b.column("q").to_pylist(), b.column("a").to_pylist()):
            wq, wa = words(fold(q)), words(fold(a))
            both = set(wq)
            both.update(wa)
            new = both.difference(known)
            if new:
                if len(known) >= _WORD_CACHE:
                    known.clear()
                    new = both
                for w in new:
                    known[w] = xxhash.xxh32_intdigest(w.encode("utf-8", "surrogatepass"))
            flat += map(known.__getitem__, both)
            sizes.append(len(both))
            key = digest(("".join(wq) + "\x1f" + "".join(wa)).encode("utf-8", "surrogatepass"))
            k1.append(key)
            if named_fields(q) or named_fields(a):
                key, n = exchange_key(q, a)
                ck.append(key)
                taken.append(n)
            else:
                ck.append(key)
                taken.append(0)
        n = np.array(sizes, dtype=np.int64)
        tok = np.array(flat, dtype=np.uint32)
        start = np.zeros(len(n) + 1, dtype=np.int64)
        np.cumsum(n, out=start[1:])
        total = np.zeros(len(tok) + 1, dtype=np.uint64)
        np.cumsum(_mix(tok.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)), out=total[1:])
        sk = _mix(total[start[1:]] - total[start[:-1]] + n.astype(np.uint64)).view(np.int64)
        fresh = np.zeros(len(n), dtype=bool)
        for i, s in enumerate(sk.tolist()):
            if s not in seen and n[i]:
                seen.add(s)
                fresh[i] = True
        lengths = np.where(fresh, n, 0)
        offsets = np.zeros(len(n) + 1, dtype=np.int32)
        np.cumsum(lengths, out=offsets[1:])
        kept = tok[np.repeat(fresh, n)].view(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                b.column("rid"),
                pa.array(sk),
                pa.array(n.astype(np.int32)),
                pa.array(np.array(k1, dtype=np.uint64).view(np.int64)),
                pa.array(np.array(ck, dtype=np.uint64).view(np.int64)),
                pa.array(taken, pa.int32()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(kept)),
            ],
            names=["rid", "sk", "n", "k1", "ck", "taken", "toks"],
        )


def _flat(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    toks = b.column("toks")
    return toks.flatten().to_numpy(zero_copy_only=False).view(np.uint32), np.diff(toks.offsets.to_numpy())


def _counts(batches):
    for b in batches:
        tok, n = np.unique(_flat(b)[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(tok.astype(np.int64)), pa.array(n)], names=["tok", "n"])


def _hot_prefixes(hot: np.ndarray, rank: np.ndarray):
    """(k, f, n, top): prefixes that hold each frequent word, by its place in `hot` and the step of how many words follow.

    n is their number, top the largest 7 m - 33 p among them.
    """

    def run(batches):
        total = np.zeros(len(hot) * _FOLLOW, dtype=np.int64)
        top = np.full(len(total), _NONE, dtype=np.int64)
        for b in batches:
            tok, n = _flat(b)
            if not len(tok):
                continue
            owner = np.repeat(np.arange(len(n), dtype=np.int64), n)
            at = np.minimum(np.searchsorted(hot, tok), len(hot) - 1)
            is_hot = hot[at] == tok
            # a set's frequent words stand behind its rare ones, in the order of their ranks
            rare = np.bincount(owner[~is_hot], minlength=len(n))
            owner, at = owner[is_hot], at[is_hot]
            perm = np.argsort((owner << 33) | rank[at], kind="stable")
            owner, at = owner[perm], at[perm]
            held = np.bincount(owner, minlength=len(n))
            place = rare[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(held) - held, held)
            size = n[owner].astype(np.int64)
            long = 20 * place <= 7 * size
            k = (at * _FOLLOW + _follow(size - place))[long]
            total += np.bincount(k, minlength=len(total))
            np.maximum.at(top, k, (7 * size - 33 * place)[long])
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k // _FOLLOW), pa.array(k % _FOLLOW), pa.array(total[k]), pa.array(top[k])], names=["k", "f", "n", "top"])

    return run


def _follow(rest: np.ndarray) -> np.ndarray:
    """Step of the number of words that follow."""
    return np.minimum(rest // _SPAN, _FOLLOW - 1)


def _reach(top: np.ndarray) -> np.ndarray:
    """Largest 7 m - 33 p of a partner for each word and step, less what the difference in words that follow takes."""
    steps = np.arange(_FOLLOW)
    gap = np.abs(steps[:, None] - steps)
    least = np.where(gap > 0, _SPAN * (gap - 1) + 1, 0)
    return np.stack([(top - 33 * least[f]).max(axis=1) for f in range(_FOLLOW)], axis=1)


def _prefixes(hot: np.ndarray, rank: np.ndarray, shards: np.ndarray, reach: np.ndarray, twice: np.ndarray):
    """Rows (tok, meta, sk, sketch) of the prefixes; meta is size, place and whether the place is in the short prefix.

    A frequent word's sets are spread over `shards` by their key, and each is written once for every pair of shards it
    is in: any two sets of the word still meet, and a block's size is that of two shards.
    """

    def run(batches):
        for b in batches:
            tok, n = _flat(b)
            rows = len(n)
            owner = np.repeat(np.arange(rows, dtype=np.int64), n)
            start = np.zeros(rows + 1, dtype=np.int64)
            np.cumsum(n, out=start[1:])
            at = np.minimum(np.searchsorted(hot, tok), max(0, len(hot) - 1))
            is_hot = hot[at] == tok if len(hot) else np.zeros(len(tok), dtype=bool)
            order = np.where(is_hot, (1 << 32) + rank[at], tok.astype(np.int64)) if len(hot) else tok.astype(np.int64)
            perm = np.argsort((owner << 33) | order, kind="stable")
            tok, is_hot, at = tok[perm], is_hot[perm], at[perm]
            bit = _mix(tok.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) & np.uint64(127)
            one = np.uint64(1) << (bit & np.uint64(63))
            # parity of the words up to each place; the rest of the row is the row's total without it
            so_far = [np.bitwise_xor.accumulate(np.where(bit >> np.uint64(6) == k, one, np.uint64(0))) for k in (0, 1)]
            place = np.arange(len(tok)) - start[owner]
            size = n[owner].astype(np.int64)
            short = 33 * place <= 7 * size
            keep = np.flatnonzero((short | (20 * place <= 7 * size)) & hits(tok & np.uint32((64 * len(twice)) - 1), twice))
            if len(hot):
                p = place[keep]
                keep = keep[~is_hot[keep] | (7 * size[keep] - 33 * p + reach[at[keep], _follow(size[keep] - p)] >= 0)]
            many = np.where(is_hot[keep], shards[at[keep]] if len(hot) else 1, 1)
            copies = np.repeat(np.arange(len(keep)), many)
            other = np.arange(len(copies)) - np.repeat(np.cumsum(many) - many, many)
            k = keep[copies]
            mine = owner[k]
            sk = b.column("sk").to_numpy()[mine]
            own = sk % many[copies]
            which = np.minimum(own, other) * many[copies] + np.maximum(own, other)
            meta = (size[k] << 32) | (place[k] << 1) | short[k]
            last = start[mine + 1] - 1
            columns = [tok[k].astype(np.int64) | (which << 32), meta, sk, *((f[last] ^ f[k]).view(np.int64) for f in so_far)]
            for i in range(0, len(k), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[i : i + 50_000]) for c in columns], names=["tok", "meta", "sk", "s0", "s1"])

    return run


def _near(s, slack, first, sk, i, j) -> np.ndarray:
    """Which of the pairs (i, j) of rows may be alike."""
    radius = slack[i] + slack[j]
    ok = (radius >= 0) & (first[i] | first[j]) & (sk[i] != sk[j])
    i, j, radius = i[ok], j[ok], radius[ok]
    d = np.bitwise_count(s[0, i] ^ s[0, j]).astype(np.int32) + np.bitwise_count(s[1, i] ^ s[1, j])
    good = 33 * d <= radius
    i, j = sk[i[good]], sk[j[good]]
    return np.stack([np.minimum(i, j), np.maximum(i, j)]) if len(i) else np.zeros((2, 0), dtype=np.int64)


def _square(s, slack, first, sk) -> list[np.ndarray]:
    """Candidate pairs of a block that is one tile."""
    d = np.bitwise_count(s[0][:, None] ^ s[0])
    d += np.bitwise_count(s[1][:, None] ^ s[1])
    slack = slack.astype(np.int32)
    near = np.flatnonzero(d.astype(np.int32) * 33 <= slack[:, None] + slack)
    i, j = near // len(sk), near % len(sk)
    keep = i < j
    return [_near(s, slack, first, sk, i[keep], j[keep])] if keep.any() else []


def _tiles(s, slack, rest, first, sk) -> list[np.ndarray]:
    """Candidate pairs of a large block: rows in bands of like slack, within a band by the number of words that follow."""
    keep = np.unique(sk, return_index=True)[1]
    band = -(slack[keep] // 33)
    keep = keep[np.lexsort((rest[keep], band))]
    s, slack, rest, first, sk = np.ascontiguousarray(s[:, keep]), slack[keep], rest[keep], first[keep], sk[keep]
    band = -(slack // 33)
    begin = np.flatnonzero(np.append(True, band[1:] != band[:-1]))
    bands = [(a, b, int(slack[a:b].max())) for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(band)])]
    x = np.empty((_HEIGHT, _WIDTH), dtype=np.uint64)
    d = np.empty((_HEIGHT, _WIDTH), dtype=np.uint8)
    out, left_of, right_of, held = [], [], [], 0
    done = -1  # pairs whose bands make at most this radius are found
    for most_apart, least in _LEVELS:
        if len(sk) < least or not _equal_stretches(s, slack, first, sk, done + 1, most_apart, out):
            break
        done = most_apart
    for a, b, top in bands:
        lead = a + np.flatnonzero(first[a:b])
        for k in range(0, len(lead), _HEIGHT):
            i = lead[k : k + _HEIGHT]
            r, fewest, most = len(i), rest[i[0]], rest[i[-1]]
            left = s[0, i][:, None]
            for a2, b2, top2 in bands:
                radius = (top + top2) // 33
                if radius < 0 or 1 - int(band[a]) - int(band[a2]) <= done:
                    break
                lo = a2 + int(np.searchsorted(rest[a2:b2], fewest - radius))  # beyond it the counts differ too much
                hi = a2 + int(np.searchsorted(rest[a2:b2], most + radius, side="right"))
                for c in range(lo, hi, _WIDTH):
                    w = min(_WIDTH, hi - c)
                    np.bitwise_xor(left, s[0, c : c + w], out=x[:r, :w])
                    np.bitwise_count(x[:r, :w], out=d[:r, :w])
                    near = np.flatnonzero(d[:r, :w] <= min(radius, 255))
                    if len(near):
                        left_of.append(i[near // w])
                        right_of.append(c + near % w)
                        held += len(near)
                        if held > 200_000:
                            out.append(_near(s, slack, first, sk, np.concatenate(left_of), np.concatenate(right_of)))
                            left_of, right_of, held = [], [], 0
    if held:
        out.append(_near(s, slack, first, sk, np.concatenate(left_of), np.concatenate(right_of)))
    return out


def _equal_stretches(s, slack, first, sk, low: int, high: int, out: list[np.ndarray]) -> bool:
    """Adds the candidate pairs of rows whose slacks make a radius of low to high, by their equal stretches of sketch.

    Whole slacks count, so that the radius is at most their sum and one. False, with pairs left out, where stretches are
    equal so often that comparing tiles is less work.
    """
    whole = slack // 33
    if np.abs(whole).max() >= 1 << 18:
        return False
    values, counts = np.unique(whole, return_counts=True)
    upto = np.append(0, np.cumsum(counts))
    span = lambda r: upto[np.searchsorted(values, r - 1 - values, side="right")]
    work = int((counts * (span(high) - span(low - 1))).sum()) // 2
    width = 128 // (high + 1)
    bits = min(width, 40)
    for k in range(0, (high + 1) * width, width):
        if k >= 64:
            part = s[1] >> np.uint64(k - 64)
        else:
            part = s[0] >> np.uint64(k)
            if k + bits > 64:
                part = part | (s[1] << np.uint64(64 - k))
        key = ((part & np.uint64((1 << bits) - 1)).astype(np.int64) << 20) | (whole + (1 << 19))
        order = np.argsort(key)
        key = key[order]
        mid = (key >> 20 << 20) + (1 << 20) - (key & ((1 << 20) - 1)) - 1  # the same stretch, the whole slack that makes a radius of 0
        begin = np.maximum(np.searchsorted(key, mid + low), np.arange(1, len(key) + 1))
        many = np.maximum(np.searchsorted(key, mid + high, side="right") - begin, 0)
        total = np.cumsum(many)
        if 12 * (high + 1) * int(total[-1]) > work:
            return False
        s0, s1, own = s[0][order], s[1][order], slack[order]
        a = 0
        while a < len(key) and total[-1] > (before := int(total[a - 1]) if a else 0):
            b = max(a + 1, int(np.searchsorted(total, before + _PROBE, side="right")))
            n = many[a:b]
            i = np.repeat(np.arange(a, b), n)
            j = np.arange(len(i)) + np.repeat(begin[a:b] - (total[a:b] - n - before), n)
            d = np.bitwise_count(s0[i] ^ s0[j])
            near = np.flatnonzero(d <= high)
            i, j = i[near], j[near]
            near = 33 * (d[near].astype(np.int64) + np.bitwise_count(s1[i] ^ s1[j])) <= own[i] + own[j]
            if near.any():
                out.append(_near(s, slack, first, sk, order[i[near]], order[j[near]]))
            a = b
    return True


def _blocks(tok, meta, sk, s) -> np.ndarray:
    """Distinct candidate pairs of rows sorted by tok."""
    size, place, first = meta >> 32, (meta & 0xFFFFFFFF) >> 1, (meta & 1) == 1
    slack, rest = 7 * size - 33 * place, size - place
    start = np.flatnonzero(np.append(True, tok[1:] != tok[:-1]))
    end = np.append(start[1:], len(tok))
    found = []
    large = end - start > _SMALL
    for a, b in zip(start[large].tolist(), end[large].tolist()):
        if b - a <= _MEDIUM:
            found += _square(s[:, a:b], slack[a:b], first[a:b], sk[a:b])
        else:
            found += _tiles(s[:, a:b], slack[a:b], rest[a:b], first[a:b], sk[a:b])
    stop = np.repeat(np.where(large, start, end), end - start)
    i = np.arange(len(tok))
    step = 1
    while True:
        i = i[i + step < stop[i]]
        if not len(i):
            break
        for k in range(0, len(i), 100_000):
            found.append(_near(s, slack, first, sk, i[k : k + 100_000], i[k : k + 100_000] + step))
        step += 1
    pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), dtype=np.int64)
    if pairs.shape[1] > 1:
        pairs = pairs[:, np.lexsort(pairs)]
        new = np.append(True, (pairs[:, 1:] != pairs[:, :-1]).any(axis=0))
        pairs = pairs[:, new]
    return pairs


def _candidates(batches):
    held: list[tuple[np.ndarray, ...]] = []
    rows = 0

    def flush(upto: int | None):
        nonlocal held, rows
        cols = [np.concatenate(c) for c in zip(*held)]
        if upto is None:
            now, held, rows = cols, [], 0
        else:
            cut = int(np.searchsorted(cols[0], upto))
            now = [c[:cut] for c in cols]
            held, rows = [tuple(c[cut:] for c in cols)], len(cols[0]) - cut
        if not len(now[0]):
            return None
        pairs = _blocks(now[0], now[1], now[2], np.stack([c.view(np.uint64) for c in now[3:]]))
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    limit = _FLUSH
    for b in batches:
        held.append(tuple(b.column(k).to_numpy() for k in range(5)))
        rows += b.num_rows
        if rows >= limit:
            out = flush(int(held[-1][0][-1]))
            limit = max(_FLUSH, 2 * rows)
            if out is not None:
                yield out
    if rows:
        out = flush(None)
        if out is not None:
            yield out


def profiles_of(rows: DataFrame, key: str = "line_no", q: str = "q", a: str = "a") -> DataFrame:
    """Written table of one row per record: (rid, sk, n, k1, ck, taken, toks); sk is the key of its word set."""
    base = rows.select(F.col(key).cast("bigint").alias("rid"), F.col(q).cast("string").alias("q"), F.col(a).cast("string").alias("a"))
    return materialize(base.mapInArrow(_profiles, "rid bigint, sk bigint, n int, k1 bigint, ck bigint, taken int, toks array<int>"), "near-profiles")


def similar_sets(profiles: DataFrame) -> DataFrame:
    """(a, b): keys of every two different word sets that are alike."""
    sets = profiles.where("size(toks) > 0").select("sk", "n", "toks")
    n, written = sets.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    n = max(1, n)
    counted = materialize(sets.select("toks").mapInArrow(_counts, "tok bigint, n bigint").groupBy("tok").agg(F.sum("n").alias("n")).where("n > 1"), "near-words")
    # words more frequent than one in a thousand sets: at most a thousand times the words of a set
    top = counted.where(F.col("n") > max(16, n // 1000)).toPandas().sort_values(["tok"])
    hot = top["tok"].to_numpy(dtype=np.uint32)
    count = top["n"].to_numpy(dtype=np.int64)
    rank = np.empty(len(hot), dtype=np.int64)
    rank[np.lexsort((hot, count))] = np.arange(len(hot))
    held, top = np.zeros((len(hot), _FOLLOW), dtype=np.int64), np.full((len(hot), _FOLLOW), _NONE, dtype=np.int64)
    if len(hot):
        made = sets.select("toks").mapInArrow(_hot_prefixes(hot, rank), "k bigint, f bigint, n bigint, top bigint")
        got = made.groupBy("k", "f").agg(F.sum("n").alias("n"), F.max("top").alias("top")).toPandas()
        at = got["k"].to_numpy(dtype=np.int64), got["f"].to_numpy(dtype=np.int64)
        held[at], top[at] = got["n"].to_numpy(dtype=np.int64), got["top"].to_numpy(dtype=np.int64)
    shards = np.maximum(1, -(-held.sum(axis=1) // _BLOCK))
    bits = np.zeros(1 << 19, dtype=np.uint64)
    place = F.col("tok").bitwiseAND((64 << 19) - 1)
    got = counted.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("b")).toPandas()
    bits[got["w"].to_numpy(dtype=np.int64)] = got["b"].to_numpy(dtype=np.int64).view(np.uint64)
    keys = sets.select("sk", "toks").mapInArrow(_prefixes(hot, rank, shards, _reach(top), bits), _KEYS)
    # a prefix holds about 7 / 20 of a set's words
    parts = max(int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(_PARTS, -(-7 * written // (20 * _ROWS))))
    met = keys.repartition(parts, "tok").sortWithinPartitions("tok").mapInArrow(_candidates, "a bigint, b bigint")
    pairs = materialize(met.distinct(), "near-pairs")
    wanted = member_bits(pairs.select(F.explode(F.array("a", "b")).alias("sk")), "sk")

    def some(batches):
        for b in batches:
            b = b.filter(pa.array(hits(b.column("place").to_numpy(zero_copy_only=False), wanted)))
            if b.num_rows:
                yield b.select(["sk", "n", "toks"])

    few = sets.withColumn("place", F.pmod(F.xxhash64("sk"), F.lit(64 * len(wanted)))).mapInArrow(some, "sk bigint, n int, toks array<int>").dropDuplicates(["sk"])
    x = few.select(F.col("sk").alias("a"), F.col("n").alias("na"), F.col("toks").alias("ta"))
    y = few.select(F.col("sk").alias("b"), F.col("n").alias("nb"), F.col("toks").alias("tb"))
    common = F.size(F.array_intersect("ta", "tb"))
    return pairs.join(x, "a").join(y, "b").where(33 * common >= 13 * (F.col("na") + F.col("nb"))).select("a", "b")


def near_groups(rows: DataFrame, key: str = "line_no", q: str = "q", a: str = "a") -> DataFrame:
    """(rid, grp, copy): records that have a record like them, with the group and the class of copies they are in.

    rows needs a unique bigint `key`; null texts are empty, records without any word are in no group, and other columns
    aren't read. Equal word sets are one node of the graph, so that a third of the rows being copies costs nothing.
    """
    profiles = profiles_of(rows, key, q, a)
    nodes = connected_components(materialize(similar_sets(profiles), "near-links"))
    # one word set, several texts: alike without any further link
    keyed = profiles.where("n > 0").select("rid", "sk", "k1", "ck", "taken")
    varied = keyed.groupBy("sk", "k1").agg(F.lit(1).alias("x")).groupBy("sk").agg(F.count("*").alias("texts")).where("texts > 1")
    groups = materialize(nodes.join(varied, nodes["node"] == varied["sk"], "full").select(F.coalesce("node", "sk").alias("sk"), F.coalesce("component", "sk").alias("grp")), "near-groups")
    counted = keyed.groupBy("sk").agg(F.count("*").alias("held"))
    members = join_counted(keyed, materialize(groups.join(counted, "sk"), "near-counted"), "sk", "held").drop("held")
    copies = members.groupBy("grp", "k1").agg(F.max_by("ck", F.struct("taken", "ck")).alias("copy"))
    return members.join(copies, ["grp", "k1"]).select("rid", "grp", "copy")


def group_pairs(groups: DataFrame) -> DataFrame:
    """(key_a, key_b): every two records of one group that are no copies of each other.

    Classes of copies are paired first, so that the many copies of one text meet only the other texts of their group.
    """
    groups = materialize(groups, "near-members")
    classes = groups.groupBy("grp", "copy").agg(F.count("*").alias("k")).select("grp", "copy")
    two = classes.select("grp", F.col("copy").alias("c1")).join(classes.select("grp", F.col("copy").alias("c2")), "grp").where("c1 < c2")
    left = groups.select("grp", F.col("copy").alias("c1"), F.col("rid").alias("r1"))
    right = groups.select("grp", F.col("copy").alias("c2"), F.col("rid").alias("r2"))
    pairs = two.join(left, ["grp", "c1"]).join(right, ["grp", "c2"])
    return pairs.select(F.least("r1", "r2").alias("key_a"), F.greatest("r1", "r2").alias("key_b"))


def _row_pairs(batches):
    for b in batches:
        keep = []
        for x, y in zip(b.column("text_a").to_pylist(), b.column("text_b").to_pylist()):
            x, y = set(words(fold(x))), set(words(fold(y)))
            keep.append(x != y and alike(len(x & y), len(x), len(y)))
        yield b.filter(pa.array(keep, pa.bool_())).select(["key_a", "key_b"])


def alike_rows(pairs: DataFrame) -> DataFrame:
    """(key_a, key_b) of the rows whose own two texts are alike and don't have the same words."""
    base = pairs.select(F.col("no_a").cast("bigint").alias("key_a"), F.col("no_b").cast("bigint").alias("key_b"), "text_a", "text_b")
    return base.mapInArrow(_row_pairs, "key_a bigint, key_b bigint")


def found_near(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """(tab, key_a, key_b) of both tables."""
    one = group_pairs(near_groups(rows)).select(F.lit("cluster_demo").alias("tab"), "key_a", "key_b")
    two = alike_rows(pairs).select(F.lit("neardup_pairs").alias("tab"), "key_a", "key_b")
    return one.unionByName(two)
