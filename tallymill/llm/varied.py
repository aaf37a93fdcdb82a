"""A subset that covers the variety of the data (problem 4): density from repeated hash buckets, inverse-density sample.

Each question is signed by minima of hashes over its five-word shingles. Several independent repetitions of three minima
each give buckets in which questions of a similarity of 0.8 meet with even odds; the mean size of a question's buckets is
its local density. A fixed number of rows is then drawn without replacement with probability inverse to density, after
every channel has had its share of places.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymill.functions.text import fold, words
from tallymill.operators.skew import join_counted
from tallymill.session import materialize

REPETITIONS = 6
MINIMA = 3
SHINGLE = 5
_SCALE = 256


def _shingles(text: str | None) -> list[int]:
    ws = words(fold(text))
    if len(ws) <= SHINGLE:
        return [xxhash.xxh32_intdigest(" ".join(ws).encode("utf-8", "surrogatepass"))]
    return [xxhash.xxh32_intdigest(" ".join(ws[i : i + SHINGLE]).encode("utf-8", "surrogatepass")) for i in range(len(ws) - SHINGLE + 1)]


def _buckets(batches):
    rng = np.random.default_rng(1750)
    m = rng.integers(1, 1 << 62, size=REPETITIONS * MINIMA, dtype=np.uint64) | np.uint64(1)
    c = rng.integers(0, 1 << 62, size=REPETITIONS * MINIMA, dtype=np.uint64)
    for b in batches:
        for k in range(0, b.num_rows, 2000):
            part = b.slice(k, 2000)
            flat, sizes = [], []
            for t in part.column("q").to_pylist():
                s = _shingles(t)
                flat += s
                sizes.append(len(s))
            x = np.array(flat, dtype=np.uint64)
            start = np.zeros(len(sizes), dtype=np.int64)
            np.cumsum(sizes[:-1], out=start[1:])
            keys = []
            for r in range(REPETITIONS):
                key = np.full(len(sizes), r + 1, dtype=np.uint64)
                for j in range(MINIMA):
                    h = x * m[r * MINIMA + j] + c[r * MINIMA + j]
                    h ^= h >> np.uint64(29)
                    h *= np.uint64(0xBF58476D1CE4E5B9)
                    key = (key ^ np.minimum.reduceat(h, start)) * np.uint64(0x9E3779B97F4A7C15)
                keys.append(pa.array(key.view(np.int64)))
            yield pa.RecordBatch.from_arrays([part.column("rid"), part.column("channel"), *keys], names=["rid", "channel", *(f"b{r}" for r in range(REPETITIONS))])


def channel_key(channel: Column) -> Column:
    """Spelling-free form of a channel: lower case, letters and digits only; null and blank are one channel ''."""
    return F.regexp_replace(F.lower(F.coalesce(channel, F.lit(""))), r"[^\p{L}\p{N}]+", "")


def densities(rows: DataFrame, key: str = "line_no", q: str = "q", channel: str = "channel") -> DataFrame:
    """(rid, channel, density): mean number of rows in the hash buckets of the row's question.

    Equal signatures are counted as one before any shuffle by bucket, so a question that fills a third of the table is
    one row of a bucket.
    """
    base = rows.select(F.col(key).cast("bigint").alias("rid"), channel_key(F.col(channel)).alias("channel"), F.col(q).cast("string").alias("q"))
    columns = [f"b{r}" for r in range(REPETITIONS)]
    signed = base.mapInArrow(_buckets, "rid bigint, channel string, " + ", ".join(f"{c} bigint" for c in columns))
    signed = materialize(signed.withColumn("sig", F.xxhash64(*columns)), "varied-signatures")
    kinds = signed.groupBy("sig").agg(F.count("*").alias("n"), *(F.first(c).alias(c) for c in columns))
    spread = kinds.select("sig", "n", F.explode(F.array(*columns)).alias("bucket"))
    sizes = spread.groupBy("bucket").agg(F.sum("n").alias("size"))
    dense = materialize(spread.join(sizes, "bucket").groupBy("sig").agg(F.first("n").alias("n"), F.avg("size").alias("density")), "varied-density")
    return join_counted(signed.select("rid", "channel", "sig"), dense, "sig").select("rid", "channel", "density")


def _uniform(rid: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the row and the seed only."""
    return (F.shiftrightunsigned(F.xxhash64(rid, F.lit(seed)), 11).cast("double") + 0.5) / F.lit(float(1 << 53))


def _first_of_each(drawn: DataFrame, share: int) -> DataFrame:
    """The `share` rows of least race of every channel, found by a histogram: only the step with the last place is ordered."""
    steps = drawn.groupBy("channel", "step").agg(F.count("*").alias("k"))
    upto = F.sum("k").over(Window.partitionBy("channel").orderBy("step"))
    placed = steps.withColumn("before", upto - F.col("k"))
    edges = placed.groupBy("channel").agg(F.sum("k").alias("n"), F.max_by("step", F.when(F.col("before") < share, F.col("step"))).alias("edge"), F.max(F.when(F.col("before") < share, F.col("before"))).alias("before"))
    near = join_counted(drawn, materialize(edges, "varied-edges"), "channel").where("step <= edge")
    by_channel = Window.partitionBy("channel").orderBy("race", "rid")
    last = near.where("step = edge").withColumn("k", F.row_number().over(by_channel)).where(F.col("k") + F.col("before") <= share)
    return near.where("step < edge").select(*drawn.columns).unionByName(last.select(*drawn.columns))


def varied_subset(rows: DataFrame, size: int, key: str = "line_no", q: str = "q", channel: str = "channel", seed: int = 1750) -> DataFrame:
    """(line_no, channel, density): exactly min(size, rows) rows, drawn with probability inverse to local density.

    A quarter of the places goes to the channels in equal shares, at least one each, as far as a channel has rows; with
    more channels than places each place goes to another channel, the largest ones first. The other places go to the
    whole table. Null and blank questions are one kind of question. The draw depends on seed and key only: the same rows
    give the same subset in any order and partitioning.
    """
    dense = densities(rows, key, q, channel)
    race = -F.log(_uniform(F.col("rid"), seed)) * F.col("density")
    step = F.floor(F.log2(F.greatest(F.col("race"), F.lit(1e-30))) * _SCALE)
    drawn = materialize(dense.withColumn("race", race).withColumn("step", step), "varied-race")
    sizes = drawn.groupBy("channel").agg(F.count("*").alias("n"))
    channels = sizes.count()
    share = max(1, size // (4 * max(1, channels)))
    floor = _first_of_each(drawn, share)
    if channels > size:
        floor = floor.join(sizes, "channel").orderBy(F.desc("n"), "channel").limit(size).select(*drawn.columns)
    floor = materialize(floor, "varied-floor")
    left = size - floor.count()
    rest = drawn.join(floor.select("rid"), "rid", "left_anti")
    # a histogram of the races finds where the last place falls; only that step is ordered row by row
    total, edge, before = 0, None, 0
    for s, n in sorted((r[0], r[1]) for r in rest.groupBy("step").count().collect()):
        if total + n >= left:
            edge, before = s, total
            break
        total += n
    if edge is None:
        return floor.unionByName(rest).select(F.col("rid").alias("line_no"), "channel", "density")
    sure = rest.where(F.col("step") < edge)
    last = rest.where(F.col("step") == edge).orderBy("race", "rid").limit(left - before)
    return floor.unionByName(sure).unionByName(last).select(F.col("rid").alias("line_no"), "channel", "density")
