"""Row numbers and running sums over a whole table, without a task that sees all of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymill.session import materialize


def ranged(df: DataFrame, by: list[str]) -> DataFrame:
    """df sorted over ranges of `by` and written, with the number of its range in __p and its place there in __k."""
    placed = df.sort(*by).withColumn("__m", F.monotonically_increasing_id())
    written = materialize(placed, "ranged")
    return written.withColumn("__p", F.shiftright("__m", 33)).withColumn("__k", F.col("__m").bitwiseAND((1 << 33) - 1)).drop("__m")


def numbered(df: DataFrame, by: list[str], name: str = "i") -> DataFrame:
    """df with its place 0, 1, 2 … in the order of `by`; only the ranges' sizes reach the driver, one a partition."""
    rows = ranged(df, by)
    sizes, at = [], 0
    for p, n in sorted(tuple(r) for r in rows.groupBy("__p").count().collect()):
        sizes.append((p, at))
        at += n
    starts = df.sparkSession.createDataFrame(sizes, "__p bigint, __s bigint")
    return rows.join(F.broadcast(starts), "__p").withColumn(name, F.col("__s") + F.col("__k")).drop("__p", "__k", "__s")


def running(df: DataFrame, by: str, sums: list[str]) -> DataFrame:
    """df, whose `by` is unique, with running sums `<name>_upto` in its order and `next`, the value of `by` that follows."""
    rows = ranged(df, [by])
    facts = rows.groupBy("__p").agg(F.min(by).alias("low"), *[F.sum(c).alias(c) for c in sums]).collect()
    offsets, carried, lows = [], [0] * len(sums), [r["low"] for r in sorted(facts, key=lambda r: r["__p"])[1:]] + [None]
    for r, low in zip(sorted(facts, key=lambda r: r["__p"]), lows):
        offsets.append((r["__p"], low, *carried))
        carried = [x + r[c] for x, c in zip(carried, sums)]
    kind = df.schema[by].dataType.simpleString()
    starts = df.sparkSession.createDataFrame(offsets, f"__p bigint, __low {kind}, " + ", ".join(f"__{c} bigint" for c in sums))
    up = Window.partitionBy("__p").orderBy(by)
    out = rows.join(F.broadcast(starts), "__p").withColumn("next", F.coalesce(F.lead(by).over(up), "__low"))
    for c in sums:
        out = out.withColumn(c + "_upto", F.sum(c).over(up) + F.col("__" + c))
    return out.drop("__p", "__k", "__low", *["__" + c for c in sums])
