"""Text and JSON reports of a run, from its one-row facts and small tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill import schema
from tallymill.operators import agreement, cluster, labeling
from tallymill.operators.contracts import distinct_sets, label_fingerprint
from tallymill.operators.export import Manifest
from tallymill.sources.jsonl import canonical_json
from tallymill.sources.sinks import preview, render_table, wrap_words, write_text_whole

AXES = (("task_type", schema.TASK_TYPES), ("outcome", schema.OUTCOMES))
MAX_RATIONALE = 2000
BANNER = "*** SYNTHETIC: these figures prove the machinery, they measure no judge and no human ***"


def cluster_heads(clusters: DataFrame, records: DataFrame) -> DataFrame:
    """(cluster_id, size, record_id, head): the first member of every cluster in canonical order, with a preview."""
    members = clusters.select("cluster_id", F.col("key").alias("record_id")).join(records.select("record_id", "source_name", "line_no", "input_text"), "record_id")
    first = F.min_by(F.struct("record_id", "input_text"), F.struct("source_name", "line_no", "record_id"))
    return members.groupBy("cluster_id").agg(F.count("*").alias("size"), first.alias("m")).select("cluster_id", "size", "m.record_id", preview(F.col("m.input_text")).alias("head"))


def degenerate_total(intervals: DataFrame) -> DataFrame:
    """One row: how many resamples of all intervals had no kappa."""
    return intervals.agg(F.coalesce(F.sum("degenerate"), F.lit(0)).alias("degenerate"), F.coalesce(F.sum("resamples"), F.lit(0)).alias("resamples"))


def synthetic_reasons(run, human: DataFrame | None = None) -> list[str]:
    """Why a run's figures mean nothing outside a test: the offline judge, or labels that are a copy of the judge's own."""
    found = []
    if run.facts["judge"]["model_id"] == labeling.FAKE_MODEL:
        found.append("the offline judge gave the labels")
    if human is not None:
        judged = run.tables["labels"].where("bucket = 'labeled'").select("record_id", "verdict.task_type", "verdict.outcome").join(human.select("record_id"), "record_id", "left_semi")
        if label_fingerprint(judged).first() == label_fingerprint(human.select("record_id", "task_type", "outcome")).first():
            found.append("the human labels equal the judge's")
    return found


def preflight(run, price_per_call: float | None = None) -> str:
    """What a judge would be asked, before it is: calls, budget, model."""
    n = min(run.tables["sampled"].count(), run.settings.max_labels)
    cost = "" if price_per_call is None else f", about {n * price_per_call:.2f} in all"
    return f"{n} calls to {run.facts['judge']['model_id']} (budget {run.settings.max_labels}){cost}\n"


def demo_report(run, ingest: DataFrame) -> str:
    """Ingest, de-duplication, clusters with their heads, sample and labels."""
    t = run.tables
    heads = cluster_heads(t["clusters"].where(F.col("cluster_id") != schema.NOISE), t["kept"]).orderBy(F.desc("size"), "cluster_id")
    labeled = t["labels"].where("bucket = 'labeled'")
    parts = [render_table(ingest.orderBy("source_name"), "ingest"), render_table(t["dedup_report"], "dedup"), render_table(cluster.clustering_report(t["clusters"]), "clusters"), render_table(heads, "first of each cluster", 20)]
    parts += [render_table(t["sample"].groupBy("stratum").count().orderBy(F.desc("count"), "stratum"), "sample"), render_table(t["labels"].groupBy("bucket").count().orderBy("bucket"), "labels")]
    for axis, classes in AXES:
        parts.append(render_table(labeling.label_distribution(labeled.select(F.col("verdict." + axis).alias(axis)), axis, classes).orderBy("pos").drop("pos"), f"labels by {axis}"))
    return "\n".join(parts)


def _headline(axis: str, h: dict) -> str:
    """A kappa is never printed without its n and its interval."""
    if h["kappa"] is None:
        return f"{axis}: no kappa ({h['status']}), n={h['n']}"
    interval = "no interval" if h["lower"] is None else f"[{h['lower']}, {h['upper']}]"
    return f"{axis}: kappa {h['kappa']} {interval} n={h['n']} po={h['po']} pe={h['pe']}, {h['degenerate']} of {h['resamples']} resamples without a kappa"


def agreement_report(run, found: dict, human: DataFrame | None = None) -> str:
    """Ledger, both axes with intervals and classes, disagreements, and the banner where the figures are synthetic."""
    why = synthetic_reasons(run, human)
    a = found["accounting"]
    parts = [BANNER, wrap_words(why)] if why else []
    parts.append(f"judged {a['judged_in']}, human {a['human_in']}: {a['n_matched']} matched, {a['judge_only']} only judged, {a['human_only']} only human")
    parts.append(render_table(found["human_only"].groupBy("cause").count().orderBy("cause"), "human labels without a verdict"))
    parts.append(f"human labels sha256 {found['labels_sha256'] or 'not given'}; headline {'ready' if found['headline_ready'] else 'not ready'}")
    for axis, _ in AXES:
        one = found[axis]
        parts += [_headline(axis, one["headline"]), render_table(one["per_class"].withColumn("band", agreement.landis_koch(F.col("kappa"))).orderBy("class"), f"{axis} by class"), render_table(one["disagreements"], f"{axis} disagreements", 20)]
    return "\n".join(parts) + "\n"


def export_report(manifest: Manifest) -> str:
    """Funnel, inputs, gate with its five checks, contamination and result of an export."""
    d = manifest.decision
    funnel = f"{manifest.records_in} read, {manifest.records_kept} kept, {manifest.sampled} sampled, {manifest.labeled} labelled, {manifest.blocked} blocked as examples, {manifest.exported} exported"
    checks = [f"  {'ok  ' if ok else 'FAIL'} {name}" for name, ok in d.checks]
    why = [f"  override: {d.override}"] if d.override else []
    straddle = ["  the interval reaches below the threshold"] if d.straddles else []
    inputs = [f"  {role}: {name} {sha}" for role, name, sha in manifest.inputs] or ["  -"]
    return "\n".join([funnel, "inputs", *inputs, f"gate: {d.verdict}, kappa {d.kappa} [{d.ci_lower}, {d.ci_upper}]", *checks, *why, *straddle, f"golden sha256 {manifest.golden_sha256}"]) + "\n"


def annotation_report(run) -> str:
    """What a human gets: how many records, which were left out, and the questionnaire's id. No verdicts."""
    n, out = (run.tables["labels"].where(w).count() for w in ("bucket <> 'fewshot_collision'", "bucket = 'fewshot_collision'"))
    return f"{n} records to label under {run.taxonomy.taxonomy_id}; {out} left out as examples of the judge\n"


def run_report(run, found: dict) -> dict:
    """The facts of an agreement run as one JSON-able value; what a re-run must reproduce stands apart from what it can't."""
    models = [r["value"] for r in distinct_sets(run.tables["labels"], ("model_id",)).orderBy("value").collect()]
    axes = {}
    for axis, _ in AXES:
        one = found[axis]
        axes[axis] = {
            "headline": one["headline"],
            "confusion": [r.asDict() for r in one["confusion"].orderBy("human", "judge").collect()],
            "per_class": [r.asDict() for r in one["per_class"].orderBy("class").collect()],
        }
    body = {"accounting": found["accounting"], "axes": axes, "judge": found["judge"], "labels_sha256": found["labels_sha256"], "headline_ready": found["headline_ready"], "served_models": models, "settings": [list(x) for x in run.settings.snapshot()], "synthetic": synthetic_reasons(run)}
    return {"deterministic": body, "volatile": {"written_at": datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%SZ")}}


def write_run_report(spark: SparkSession, run, found: dict, out_dir: str) -> str:
    """run_report.<time>-<digest>.json for a paid judge, so that no run overwrites another; run_report.json for the offline one."""
    report = run_report(run, found)
    text = canonical_json(report, indent=2) + "\n"
    live = found["judge"]["model_id"] != labeling.FAKE_MODEL
    from tallymill.sources.sinks import sha256_hex

    name = f"run_report.{report['volatile']['written_at']}-{sha256_hex(canonical_json(report['deterministic']))[:8]}.json" if live else "run_report.json"
    path = f"{out_dir.rstrip('/')}/{name}"
    write_text_whole(spark, path, text)
    return path
