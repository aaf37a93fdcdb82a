"""Integrity rules as queries: each gives (entity, rule, detail) rows, and a sound table gives none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill import schema

HEX64 = "^[0-9a-f]{64}$"


def _rule(df: DataFrame, bad: Column, entity: str, rule: str, detail: Column) -> DataFrame:
    return df.where(F.coalesce(bad, F.lit(True))).select(F.lit(entity).alias("entity"), F.lit(rule).alias("rule"), detail.cast("string").alias("detail"))


def _twice(df: DataFrame, key: str, entity: str) -> DataFrame:
    return df.groupBy(key).count().where("count > 1").select(F.lit(entity).alias("entity"), F.lit(f"{key} unique").alias("rule"), F.col(key).cast("string").alias("detail"))


def check_records(records: DataFrame) -> DataFrame:
    """Ids are their content's, names are base names, lines count from 1, both sides have text."""
    own = schema.record_id(F.col("source_kind"), F.col("source_name"), F.col("line_no"), F.col("input_text"), F.col("output_text"))
    rid = F.col("record_id")
    return (
        _rule(records, own != rid, "record", "id is its content's", rid)
        .unionByName(_rule(records, F.col("source_name").rlike(r"[/\\]"), "record", "source is a base name", rid))
        .unionByName(_rule(records, F.col("line_no") < 1, "record", "line_no from 1", rid))
        .unionByName(_rule(records, ~F.col("input_text").rlike(r"\S") | ~F.col("output_text").rlike(r"\S"), "record", "both sides have text", rid))
        .unionByName(_twice(records, "record_id", "record"))
    )


def check_ingest(report: DataFrame) -> DataFrame:
    reasons = sum((F.col(r) for r in schema.REJECT_REASONS), F.lit(0)), sum((F.col(r) for r in schema.SKIP_REASONS), F.lit(0))
    name = F.col("source_name")
    return (
        _rule(report, F.col("lines_read") != F.col("normalized") + F.col("rejected") + F.col("skipped"), "ingest", "buckets add up", name)
        .unionByName(_rule(report, F.col("rejected") != reasons[0], "ingest", "reject reasons add up", name))
        .unionByName(_rule(report, F.col("skipped") != reasons[1], "ingest", "skip reasons add up", name))
    )


def check_dedup(report: DataFrame, kept: DataFrame, entries: DataFrame, entity: str = "dedup") -> DataFrame:
    """entries has (dropped, kept): sums hold, nothing dropped is kept, no survivor is dropped, nobody drops itself."""
    out = _rule(report, F.col("records_in") != F.col("records_out") + F.col("id_collapsed") + F.col("exact_dropped") + F.col("near_dropped"), entity, "counts add up", F.col("records_in"))
    ids = kept.select(F.col("record_id").alias("id"))
    dropped = entries.select(F.col("dropped").alias("id"))
    survivors = entries.select(F.col("kept").alias("id")).distinct()
    row = lambda df, rule: df.select(F.lit(entity).alias("entity"), F.lit(rule).alias("rule"), F.col("id").cast("string").alias("detail"))
    return (
        out.unionByName(row(ids.join(dropped, "id", "left_semi"), "dropped and kept"))
        .unionByName(row(survivors.join(ids, "id", "left_anti"), "survivor isn't kept"))
        .unionByName(_rule(entries, F.col("dropped") == F.col("kept"), entity, "drops itself", F.col("kept")))
        .unionByName(_twice(entries, "dropped", entity))
    )


def check_partition(assigned: DataFrame, records: DataFrame, key: str = "key") -> DataFrame:
    """Every record in exactly one cluster."""
    row = lambda df, rule: df.select(F.lit("clusters").alias("entity"), F.lit(rule).alias("rule"), F.col("id").cast("string").alias("detail"))
    a, r = assigned.select(F.col(key).alias("id")), records.select(F.col("record_id").alias("id"))
    return row(r.join(a, "id", "left_anti"), "no cluster").unionByName(row(a.join(r, "id", "left_anti"), "unknown record")).unionByName(_twice(a, "id", "clusters"))


def check_quotas(quotas: DataFrame, requested: int) -> DataFrame:
    total = quotas.agg(F.coalesce(F.sum("quota"), F.lit(0)).alias("q"), F.coalesce(F.sum("size"), F.lit(0)).alias("n"))
    return _rule(quotas, (F.col("quota") > F.col("size")) | (F.col("quota") < 0), "sampling", "quota within stratum", F.col("stratum")).unionByName(
        _rule(total, F.col("q") != F.least(F.lit(requested), F.col("n")), "sampling", "quotas add up", F.col("q"))
    )


def check_labels(labels: DataFrame, max_labels: int) -> DataFrame:
    """Buckets are known and disjoint, the budget holds, a verdict is there exactly where a record is labelled."""
    from tallymill.operators.labeling import BUCKETS

    called = labels.agg(F.count_if(F.col("bucket").isin("labeled", "refused", "failed")).alias("n"))
    return (
        _rule(labels, ~F.col("bucket").isin(*BUCKETS), "labels", "known bucket", F.col("record_id"))
        .unionByName(_rule(labels, (F.col("bucket") == "labeled") != F.col("verdict").isNotNull(), "labels", "verdict where labelled", F.col("record_id")))
        .unionByName(_rule(called, F.col("n") > max_labels, "labels", "within budget", F.col("n")))
        .unionByName(_twice(labels, "record_id", "labels"))
    )


def check_golden(golden: DataFrame, hashes: DataFrame) -> DataFrame:
    """Exported lines verify themselves and none is a few-shot example."""
    p = F.col("provenance")
    own = schema.record_id(p["source_kind"], p["source_name"], p["line_no"], F.col("input_text"), F.col("output_text"))
    rid = F.col("record_id")
    leaked = golden.select("record_id", p["content_hash"].alias("h")).join(hashes.select("h").distinct(), "h", "left_semi")
    return (
        _rule(golden, own != rid, "golden", "id is its content's", rid)
        .unionByName(_rule(golden, p["content_hash"] != schema.content_hash(F.col("input_text"), F.col("output_text")), "golden", "hash is its content's", rid))
        .unionByName(_rule(golden, ~p["content_hash"].rlike(HEX64), "golden", "hash is sha256", rid))
        .unionByName(leaked.select(F.lit("golden").alias("entity"), F.lit("few-shot example").alias("rule"), F.col("record_id").alias("detail")))
        .unionByName(_twice(golden, "record_id", "golden"))
    )


def require_sound(violations: DataFrame) -> None:
    found = violations.take(5)
    if found:
        raise AssertionError("; ".join(f"{r['entity']}: {r['rule']} ({r['detail']})" for r in found))
