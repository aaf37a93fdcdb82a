"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.session import discard, materialize


def connected_components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 50) -> DataFrame:
    """(node, component): every node that occurs in links with the smallest node it reaches.

    Links may repeat, point either way or point to themselves; null ends are dropped. Each round is written to the
    shared folder, so the lineage stays short and lost executors cost one round. No node's neighbours are gathered in
    one place: both steps are a minimum per node and a join.
    """
    x, y = F.col(a), F.col(b)
    edges = links.where(x.isNotNull() & y.isNotNull()).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct()
    edges = materialize(edges, "cc")
    before = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: neighbours at least as large as a node are tied to the least node of its surroundings
        large = both.join(least, "u").where("v >= u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        # small star: smaller neighbours are tied to the least of them
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").distinct()
        step = materialize(small, "cc")
        now = step.agg(F.count("*"), F.sum(F.hash("u", "v").cast("bigint")), F.count_if(F.col("u") == F.col("v"))).first()
        discard(edges)
        edges = step
        if before == tuple(now):
            break
        before = tuple(now)
    else:
        raise RuntimeError("components did not settle")
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
