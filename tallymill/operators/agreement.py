"""Agreement of two raters: join ledger, confusion, Cohen's kappa over all and per class, bootstrap interval."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def match_accounting(judged: DataFrame, human: DataFrame, key: str = "record_id") -> DataFrame:
    """One row: judged_in, human_in, n_matched, judge_only, human_only, from a single full join of distinct ids."""
    j = judged.select(key).distinct().withColumn("j", F.lit(1))
    h = human.select(key).distinct().withColumn("h", F.lit(1))
    return j.join(h, key, "full").agg(
        F.count("j").alias("judged_in"), F.count("h").alias("human_in"), F.count_if(F.col("j").isNotNull() & F.col("h").isNotNull()).alias("n_matched"),
        F.count_if(F.col("h").isNull()).alias("judge_only"), F.count_if(F.col("j").isNull()).alias("human_only"),
    )


def human_only_causes(buckets: DataFrame, human: DataFrame, key: str = "record_id") -> DataFrame:
    """(record_id, cause) of labels without a judged partner; a record of no bucket was not in the run."""
    routed = buckets.select(key, "bucket").dropDuplicates([key])
    return human.select(key).distinct().join(routed, key, "left").where(F.coalesce("bucket", F.lit("")) != "labeled").select(key, F.coalesce("bucket", F.lit("not_in_run")).alias("cause"))


def confusion(pairs: DataFrame, classes: tuple[str, ...], human: str = "human", judge: str = "judge") -> DataFrame:
    """(human, judge, n) for every cell of the class grid, zeros included."""
    spark = pairs.sparkSession
    h = spark.createDataFrame([(c,) for c in classes], "human string")
    grid = h.crossJoin(h.withColumnRenamed("human", "judge"))
    counts = pairs.groupBy(F.col(human).alias("human"), F.col(judge).alias("judge")).agg(F.count("*").alias("n"))
    return grid.join(counts, ["human", "judge"], "left").select("human", "judge", F.coalesce("n", F.lit(0)).alias("n"))


def _kappa(n: Column, agree: Column, chance: Column) -> Column:
    """Kappa from n, the diagonal and the sum of products of marginals, null where both raters used one class only."""
    return F.when(n * n == chance, None).otherwise((n * agree - chance) / (n * n - chance))


def marginals(cells: DataFrame) -> DataFrame:
    """(class, h, j, a): how often each rater used a class and how often both did, in one pass over the cells."""
    sides = F.array(F.struct(F.col("human").alias("class"), F.col("n").alias("h"), F.lit(0).cast("bigint").alias("j")), F.struct(F.col("judge").alias("class"), F.lit(0).cast("bigint").alias("h"), F.col("n").alias("j")))
    twice = cells.select(F.explode(sides).alias("s"), F.when(F.col("human") == F.col("judge"), F.col("n")).otherwise(0).alias("a"))
    return twice.groupBy("s.class").agg(F.sum("s.h").alias("h"), F.sum("s.j").alias("j"), (F.sum("a") / 2).cast("bigint").alias("a"))


def global_kappa(cells: DataFrame) -> DataFrame:
    """One row (n, po, pe, kappa, status) from confusion cells, read once."""
    all_ = marginals(cells).agg(F.coalesce(F.sum("h"), F.lit(0)).alias("n"), F.coalesce(F.sum("a"), F.lit(0)).alias("d"), F.coalesce(F.sum((F.col("h") * F.col("j")).cast("decimal(38,0)")), F.lit(0)).cast("double").alias("s"))
    n, d, s = F.col("n").cast("double"), F.col("d").cast("double"), F.col("s")
    kappa = _kappa(n, d, s)
    return all_.select(
        F.col("n"), F.round(d / F.nullif(n, F.lit(0.0)), 6).alias("po"), F.round(s / F.nullif(n * n, F.lit(0.0)), 6).alias("pe"), F.round(kappa, 6).alias("kappa"),
        F.when(F.col("n") == 0, "absent").when(kappa.isNull(), "undefined_single_class").otherwise("ok").alias("status"),
    )


def class_kappa(cells: DataFrame, min_support: int = 5) -> DataFrame:
    """(class, human_n, judge_n, both_n, status, kappa) one class against the rest, statuses in their fixed precedence."""
    t = marginals(cells).withColumn("n", F.sum("h").over(Window.partitionBy()))  # a row a class of a closed vocabulary
    n, h, j, a = (F.col(c).cast("double") for c in ("n", "h", "j", "a"))
    agree, chance = n - h - j + 2 * a, h * j + (n - h) * (n - j)
    status = F.when(h + j == 0, "absent").when(a == n, "undefined_single_class").when(h + j < min_support, "insufficient_support").otherwise("ok")
    return t.select("class", F.col("h").alias("human_n"), F.col("j").alias("judge_n"), F.col("a").alias("both_n"), status.alias("status"), F.when(status == "ok", F.round(_kappa(n, agree, chance), 6)).alias("kappa"))


def disagreements(pairs: DataFrame, key: str = "record_id", human: str = "human", judge: str = "judge") -> DataFrame:
    return pairs.where(F.col(human) != F.col(judge)).select(F.col(human).alias("human"), F.col(judge).alias("judge"), key).orderBy("human", "judge", key)


def landis_koch(kappa: Column) -> Column:
    """The usual words for ranges of kappa."""
    k = kappa
    return (
        F.when(k.isNull(), None).when((k < -1) | (k > 1), F.raise_error(F.lit("kappa outside [-1, 1]"))).when(k < 0, "poor").when(k <= 0.2, "slight")
        .when(k <= 0.4, "fair").when(k <= 0.6, "moderate").when(k <= 0.8, "substantial").otherwise("almost perfect")
    )


DRAWS_AT_ONCE = 1_000_000


def draws(seed: int, resamples: int, n: int) -> np.ndarray:
    """The resampling matrix (resamples, n) of one seeded generator."""
    return np.random.Generator(np.random.PCG64(seed)).integers(0, n, size=(resamples, n))


def resample_rows(spark, seed: int, resamples: int, n: int, slices: int = 32) -> DataFrame:
    """(b, i): the same matrix as rows. Every slice runs the one stream from its start, a bounded part at a time, and writes its own rows.

    The generator rejects some draws, so its state can't be jumped ahead exactly; what a slice skips it draws and drops.
    """
    per = -(-resamples // slices)
    at_once = max(1, DRAWS_AT_ONCE // max(1, n))

    def run(batches):
        import pandas as pd

        for pdf in batches:
            for lo in pdf["lo"]:
                hi = min(resamples, lo + per)
                stream = np.random.Generator(np.random.PCG64(seed))
                b = 0
                while b < hi:
                    k = min(at_once, (lo if b < lo else hi) - b)
                    part = stream.integers(0, n, size=(k, n))
                    if b >= lo:
                        yield pd.DataFrame({"b": np.repeat(np.arange(b, b + k), n), "i": part.reshape(-1)})
                    b += k

    starts = spark.createDataFrame([(k * per,) for k in range(slices)], "lo bigint").repartition(slices)
    return starts.mapInPandas(run, "b bigint, i bigint")


def _resampled_cells(pairs: DataFrame, resampled: DataFrame, human: str, judge: str, index: str) -> DataFrame:
    """(b, h, j, n): confusion cells of every resample."""
    rated = pairs.select(index, F.col(human).alias("h"), F.col(judge).alias("j"))
    rated = F.broadcast(rated) if pairs.count() <= 100_000 else rated
    return resampled.join(rated, index).groupBy("b", "h", "j").agg(F.count("*").alias("n"))


def _interval() -> list[Column]:
    return [
        F.count("*").alias("resamples"), F.count_if(F.col("kappa").isNull()).alias("degenerate"),
        F.round(F.percentile("kappa", F.lit(0.025)), 6).alias("lower"), F.round(F.percentile("kappa", F.lit(0.975)), 6).alias("upper"),
    ]


def bootstrap_per_class(pairs: DataFrame, resampled: DataFrame, classes: tuple[str, ...], human: str = "human", judge: str = "judge", index: str = "i") -> DataFrame:
    """(class, resamples, degenerate, lower, upper): the interval of each class against the rest, over the same resamples.

    A resample without the class, or with nothing but it, has no kappa: it is counted as degenerate and left out.
    """
    cells = _resampled_cells(pairs, resampled, human, judge, index)
    sides = F.array(F.struct(F.col("h").alias("class"), F.col("n").alias("r"), F.lit(0).cast("bigint").alias("k")), F.struct(F.col("j").alias("class"), F.lit(0).cast("bigint").alias("r"), F.col("n").alias("k")))
    both = cells.select("b", F.explode(sides).alias("s"), F.when(F.col("h") == F.col("j"), F.col("n")).otherwise(0).alias("a"))
    used = both.groupBy("b", "s.class").agg(F.sum("s.r").alias("r"), F.sum("s.k").alias("k"), (F.sum("a") / 2).alias("a"))
    whole = cells.groupBy("b").agg(F.sum("n").alias("n"), F.lit(list(classes)).alias("c")).select("b", "n", F.explode("c").alias("class"))
    full = whole.join(used, ["b", "class"], "left").na.fill(0, ["r", "k", "a"])
    n, r, k, a = (F.col(c).cast("double") for c in ("n", "r", "k", "a"))
    each = full.select("class", _kappa(n, n - r - k + 2 * a, r * k + (n - r) * (n - k)).alias("kappa"))
    return each.groupBy("class").agg(*_interval())


def bootstrap_kappa(pairs: DataFrame, resampled: DataFrame, human: str = "human", judge: str = "judge", index: str = "i") -> DataFrame:
    """One row (resamples, degenerate, lower, upper): percentile interval of kappa over paired resamples.

    pairs has one row per position `index`; resampled has (b, index). Each resample is counted into cells before kappa,
    so the widest table after the join is resamples times cells. Resamples without a kappa are left out and counted.
    """
    cells = _resampled_cells(pairs, resampled, human, judge, index)
    rows = cells.groupBy("b", F.col("h").alias("c")).agg(F.sum("n").alias("r"))
    cols = cells.groupBy("b", F.col("j").alias("c")).agg(F.sum("n").alias("k"))
    chance = rows.join(cols, ["b", "c"], "left").groupBy("b").agg(F.sum(F.col("r") * F.coalesce("k", F.lit(0))).alias("s"))
    whole = cells.groupBy("b").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("h") == F.col("j"), F.col("n")).otherwise(0)).alias("d"))
    each = whole.join(chance, "b").select(_kappa(F.col("n").cast("double"), F.col("d").cast("double"), F.col("s").cast("double")).alias("kappa"))
    return each.agg(*_interval())
