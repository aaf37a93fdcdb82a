"""Exact and near de-duplication with traceable survivors.

The survivor of a group is always its first member in the canonical order (source_name, line_no, record_id), so results
do not depend on the order of the input. Records need these three columns; others ride along untouched.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill import schema
from tallymill.operators.components import connected_components
from tallymill.operators.order import running
from tallymill.session import materialize

ORDER = ("source_name", "line_no", "record_id")
BLOCK_ROWS = 2048


def order_struct() -> Column:
    return F.struct(*ORDER)


def collapse_ids(records: DataFrame, key: str = "record_id") -> DataFrame:
    """One row per id, the least in canonical order and content; `copies` counts what was folded into it.

    Rows that share a null id are one group. Aggregation is partial before the shuffle, so a heavily repeated id is no hot
    spot.
    """
    rest = [c for c in records.columns if c not in ("source_name", "line_no", key)]
    is_map = {c for c in rest if records.schema[c].dataType.typeName() == "map"}
    ordered = [F.array_sort(F.map_entries(c)).alias(c) if c in is_map else F.col(c) for c in rest]  # maps have no order, their entries do
    ahead = [c for c in ("source_name", "line_no") if c != key]
    least = records.groupBy(key).agg(F.min(F.struct(*ahead, *ordered)).alias("__m"), F.count("*").alias("copies"))
    back = [F.map_from_entries(f"__m.{c}").alias(c) if c in is_map else F.col(f"__m.{c}").alias(c) for c in [*ahead, *rest]]
    return least.select(key, *back, "copies")


def exact_survivors(records: DataFrame, input_text: str = "input_text", output_text: str = "output_text") -> DataFrame:
    """(content_hash, kept_record_id, members): the first record of each distinct exchange and how many share it."""
    hashed = records.select(*ORDER, schema.content_hash(F.col(input_text), F.col(output_text)).alias("content_hash"))
    return hashed.groupBy("content_hash").agg(F.min(order_struct()).alias("m"), F.count("*").alias("members")).select("content_hash", F.col("m.record_id").alias("kept_record_id"), "members")


def exact_entries(records: DataFrame, input_text: str = "input_text", output_text: str = "output_text") -> DataFrame:
    """(dropped_record_id, kept_record_id, content_hash) of every record with an earlier twin."""
    hashed = records.select("record_id", schema.content_hash(F.col(input_text), F.col(output_text)).alias("content_hash"))
    many = exact_survivors(records, input_text, output_text).where("members > 1").drop("members")
    return hashed.join(many, "content_hash").where("record_id <> kept_record_id").select(F.col("record_id").alias("dropped_record_id"), "kept_record_id", "content_hash")


def exact_kept(records: DataFrame, input_text: str = "input_text", output_text: str = "output_text") -> DataFrame:
    return records.join(exact_entries(records, input_text, output_text).select(F.col("dropped_record_id").alias("record_id")), "record_id", "left_anti")


def cosine_pairs(vectors: DataFrame, threshold: float, key: str = "id", vec: str = "vec", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(a, b, similarity): every pair a < b of rows whose cosine reaches the threshold, by exact block products.

    Rows are spread over blocks by the hash of their key; each pair of blocks is one matrix product in one task, so no
    pair is missed and memory stays at two blocks. All-zero, null and empty vectors are similar to nothing.
    """
    n = vectors.count()
    blocks = max(1, -(-n // block_rows))
    placed = vectors.where(F.col(vec).isNotNull() & (F.size(vec) > 0)).select(F.col(key).alias("id"), F.col(vec).cast("array<double>").alias("vec"), F.pmod(F.xxhash64(F.col(key)), F.lit(blocks)).cast("int").alias("block"))
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    met = placed.withColumn("o", other).withColumn("i", F.least("block", "o")).withColumn("j", F.greatest("block", "o"))
    kind = vectors.schema[key].dataType.simpleString()

    def product(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = pdf["i"].iloc[0], pdf["j"].iloc[0]
        left, right = pdf[pdf["block"] == i], pdf[pdf["block"] == j]
        empty = pd.DataFrame({"a": pdf["id"].iloc[:0], "b": pdf["id"].iloc[:0], "similarity": np.zeros(0)})
        if not len(left) or not len(right):
            return empty
        x, y = np.stack(left["vec"].to_numpy()), np.stack(right["vec"].to_numpy())
        nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
        s = np.clip((x @ y.T) / np.maximum(np.outer(nx, ny), 1e-300), -1.0, 1.0)
        s[nx == 0] = -2.0
        s[:, ny == 0] = -2.0
        p, q = np.nonzero(s >= threshold)
        a, b = left["id"].to_numpy()[p], right["id"].to_numpy()[q]
        keep = a < b if i == j else np.ones(len(a), dtype=bool)
        a, b, v = a[keep], b[keep], s[p, q][keep]
        swap = a > b
        return pd.DataFrame({"a": np.where(swap, b, a), "b": np.where(swap, a, b), "similarity": v})

    return met.groupBy("i", "j").applyInPandas(product, f"a {kind}, b {kind}, similarity double")


def near_entries(vectors: DataFrame, pairs: DataFrame, threshold: float, key: str = "id", vec: str = "vec", rank: Column | None = None) -> DataFrame:
    """(dropped, kept, similarity, via_chain) of every row in a component of near pairs but its survivor.

    The survivor has the least rank (default the key); similarity is to the survivor, and via_chain says that only a
    chain of pairs connects them. It is an error if rounding to six places would put a similarity on the other side of
    the threshold.
    """
    from tallymill.functions.embed import cosine

    nodes = connected_components(pairs, "a", "b")
    ranked = vectors.select(F.col(key).alias("node"), F.col(vec).alias("vec"), (F.col(key) if rank is None else rank).alias("rank"))
    members = nodes.join(ranked, "node")
    kept = members.groupBy("component").agg(F.min_by(F.struct("node", "vec"), F.struct("rank", "node")).alias("k"))
    sim = cosine(F.col("vec"), F.col("k.vec"))
    checked = F.when((F.round(sim, 6) >= threshold) != (sim >= threshold), F.raise_error(F.lit("rounding moves a similarity over the threshold"))).otherwise(sim)
    return (
        members.join(kept, "component")
        .where(F.col("node") != F.col("k.node"))
        .select(F.col("node").alias("dropped"), F.col("k.node").alias("kept"), F.round(checked.cast("double"), 6).alias("similarity"), (sim < threshold).alias("via_chain"))
    )


def remap_entries(exact: DataFrame, near: DataFrame) -> DataFrame:
    """Exact entries whose survivor fell to a near duplicate point to the final survivor instead."""
    hop = near.select(F.col("dropped").alias("kept_record_id"), F.col("kept").alias("__final"))
    return exact.join(hop, "kept_record_id", "left").select("dropped_record_id", F.coalesce("__final", "kept_record_id").alias("kept_record_id"), "content_hash")


def dedup_report(records_in: DataFrame, collapsed: DataFrame, exact: DataFrame, near: DataFrame) -> DataFrame:
    """One row of counts: in = out + id_collapsed + exact + near."""
    one = lambda df, name, e=F.count("*"): df.agg(e.alias(name))
    out = one(records_in, "records_in").crossJoin(one(collapsed, "after_ids")).crossJoin(one(exact, "exact_dropped"))
    out = out.crossJoin(near.agg(F.count("*").alias("near_dropped"), F.count_if("via_chain").alias("chain_dropped")))
    return out.select("records_in", (F.col("records_in") - F.col("after_ids")).alias("id_collapsed"), "exact_dropped", "near_dropped", "chain_dropped", (F.col("after_ids") - F.col("exact_dropped") - F.col("near_dropped")).alias("records_out"))


def run_dedup(records: DataFrame, threshold: float = 0.92, embedder: Callable[[Column], Column] | None = None) -> dict[str, DataFrame]:
    """Whole de-duplication of records with input_text and output_text: kept rows, exact and near entries, report.

    embedder maps a text column to one of unit vectors; the hashing embedder is the default.
    """
    from tallymill.functions.embed import embed_col

    embed = embedder or embed_col
    collapsed = materialize(collapse_ids(records), "dedup-ids")
    exact = materialize(exact_entries(collapsed), "dedup-exact")
    once = collapsed.join(exact.select(F.col("dropped_record_id").alias("record_id")), "record_id", "left_anti")
    vectors = materialize(once.select(F.col("record_id").alias("id"), order_struct().alias("rank"), embed(F.concat_ws(schema.SEP, "input_text", "output_text")).alias("vec")), "dedup-vectors")
    pairs = cosine_pairs(vectors, threshold)
    near = materialize(near_entries(vectors, pairs, threshold, rank=F.col("rank")), "dedup-near")
    kept = once.join(near.select(F.col("dropped").alias("record_id")), "record_id", "left_anti")
    return {"kept": kept, "exact": remap_entries(exact, near), "near": near, "report": dedup_report(records, collapsed, exact, near)}


def calibration_sweep(scored: DataFrame, similarity: str = "similarity", duplicate: str = "duplicate") -> DataFrame:
    """(threshold, tp, fp, fn, precision, recall, f1) at the midpoints between neighbouring distinct similarities.

    Pairs are counted per similarity first; each candidate's counts are running sums over ranges of that table, so the
    work is one sort of the distinct similarities rather than candidates times pairs, and no task sees all of them.
    """
    steps = scored.where(F.col(similarity).isNotNull()).groupBy(F.col(similarity).alias("s")).agg(F.count_if(F.col(duplicate)).alias("d"), F.count_if(~F.col(duplicate)).alias("x"))
    cumulated = running(steps, "s", ["d", "x"])
    whole = steps.agg(F.sum("d").alias("all_d"), F.sum("x").alias("all_x"))
    at = cumulated.where("next IS NOT NULL").crossJoin(F.broadcast(whole)).select(
        F.round((F.col("s") + F.col("next")) / 2, 6).alias("threshold"), (F.col("all_d") - F.col("d_upto")).alias("tp"), (F.col("all_x") - F.col("x_upto")).alias("fp"), F.col("d_upto").alias("fn")
    )
    once = at.groupBy("threshold").agg(F.max("tp").alias("tp"), F.max("fp").alias("fp"), F.min("fn").alias("fn"))
    precision = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
    recall = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0)
    f1 = F.when(2 * F.col("tp") + F.col("fp") + F.col("fn") > 0, 2 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn"))).otherwise(0.0)
    return once.select("threshold", "tp", "fp", "fn", F.round(precision, 6).alias("precision"), F.round(recall, 6).alias("recall"), F.round(f1, 6).alias("f1"))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The candidate of the best F1; the highest of several."""
    return sweep.groupBy().agg(F.max_by(F.struct("threshold", "tp", "fp", "fn", "precision", "recall", "f1"), F.struct("f1", "threshold")).alias("b")).where("b IS NOT NULL").select("b.*")
