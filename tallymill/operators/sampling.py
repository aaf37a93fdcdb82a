"""Stratified sampling with a floor of one: largest-remainder quotas in integers, ranking by a seeded hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def stratum_quotas(strata: DataFrame, size: int) -> DataFrame:
    """(stratum, size, quota) for a table of (stratum, size): quotas add up to min(size, all rows).

    With fewer places than strata the largest strata get one each; otherwise every stratum has one and the rest is dealt
    in proportion to what is left of each, remainders going by (remainder, size, name). Strata are few, so the ranking
    window is over the stratum table and never over rows.
    """
    every = Window.partitionBy()
    s = strata.select("stratum", F.col("size").cast("bigint").alias("size")).where("size > 0")
    s = s.withColumn("m", F.count("*").over(every)).withColumn("n", F.sum("size").over(every)).withColumn("k", F.least(F.lit(size).cast("bigint"), F.col("n")))
    s = s.withColumn("w", F.col("size") - 1).withColumn("cap", F.col("n") - F.col("m")).withColumn("rem", F.greatest(F.lit(0), F.col("k") - F.col("m")))
    base = F.expr("CASE WHEN cap > 0 THEN 1 + (rem * w) div cap ELSE 1 END")
    left = F.expr("CASE WHEN cap > 0 THEN (rem * w) % cap ELSE 0 END")
    s = s.withColumn("base", base).withColumn("r", left)
    s = s.withColumn("extra", F.row_number().over(Window.orderBy(F.desc("r"), F.desc("size"), "stratum"))).withColumn("place", F.row_number().over(Window.orderBy(F.desc("size"), "stratum")))
    s = s.withColumn("open", F.col("k") - F.sum("base").over(every))
    quota = F.when(F.col("k") <= F.col("m"), (F.col("place") <= F.col("k")).cast("bigint")).otherwise(F.col("base") + ((F.col("extra") <= F.col("open")) & (F.col("base") < F.col("size"))).cast("bigint"))
    return s.select("stratum", "size", quota.cast("bigint").alias("quota"))


def stratified_sample(rows: DataFrame, size: int, seed: int, stratum: str = "stratum", key: str = "record_id") -> DataFrame:
    """(stratum, key, score) of the sampled rows: in each stratum the `quota` rows of least seeded hash.

    A null stratum is a stratum of its own. The number of rows per stratum that could be taken is bounded by `size`, so a
    filter on the hash alone cuts each stratum to a few times its quota before the ranking window sees it; the exact rank
    decides within that.
    """
    from tallymill.schema import sample_score

    named = rows.select(F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), F.col(key).alias("key"), sample_score(seed, F.col(key)).alias("score"))
    quotas = stratum_quotas(named.groupBy("stratum").agg(F.count("*").alias("size")), size)
    # the quota-th least of `size` uniform hashes lies below (quota + 6 sqrt(quota) + 12) / size in all but freak cases;
    # a stratum whose cut kept too few rows is ranked whole instead
    share = (F.col("quota") + 6 * F.sqrt("quota") + 12) / F.col("size")
    point = F.conv(F.substring("score", 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))
    placed = named.join(quotas.where("quota > 0"), "stratum").withColumn("low", point < share)
    enough = placed.groupBy("stratum").agg(F.count_if("low").alias("kept")).select("stratum", "kept")
    cut = placed.join(enough, "stratum").where(F.col("low") | (F.col("kept") < F.col("quota")))
    ranked = cut.withColumn("rank", F.row_number().over(Window.partitionBy("stratum").orderBy("score", "key")))
    return ranked.where(F.col("rank") <= F.col("quota")).select("stratum", "key", "score")
