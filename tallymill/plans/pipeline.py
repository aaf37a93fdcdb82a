"""The whole run: sources to records, dedup, clusters, sample, labels, agreement, gate, export.

Every stage is lazy until its result is written for the next; what comes to the driver are one-row reports.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill import schema
from tallymill.functions.embed import embed_col
from tallymill.functions.taxonomy import DEFAULT, Taxonomy, annotator_instructions, fingerprint
from tallymill.operators import agreement, checks, cluster, dedup, export, labeling, sampling
from tallymill.operators.order import numbered
from tallymill.plans.settings import Settings
from tallymill.session import materialize
from tallymill.sources import jsonl, sinks


class TaxonomyMismatch(ValueError):
    """Labels of another questionnaire than the run's."""


class NoMatchedPairs(ValueError):
    """No record was labelled by both raters."""


@dataclass
class Run:
    settings: Settings
    taxonomy: Taxonomy
    tables: dict[str, DataFrame] = field(default_factory=dict)
    facts: dict[str, object] = field(default_factory=dict)


def ingest(spark: SparkSession, sources: list[tuple[str, str, jsonl.Mapping | None]]) -> tuple[DataFrame, DataFrame]:
    """(records, report) of the sources: (path, kind, mapping), kind being generic_jsonl or tracespan."""
    parsed = None
    for path, kind, mapping in sources:
        lines = jsonl.read_lines(spark, path)
        part = jsonl.parse_tracespan(lines) if kind == "tracespan" else jsonl.parse_generic(lines, mapping)
        parsed = part if parsed is None else parsed.unionByName(part)
    parsed = materialize(parsed, "ingest")
    return jsonl.records_of(parsed), jsonl.ingest_report(parsed)


def curate(records: DataFrame, settings: Settings, taxonomy: Taxonomy = DEFAULT, shots: DataFrame | None = None, judge: Callable | None = None, group: str | None = None, embedder: Callable[[Column], Column] | None = None, sanitizer: Callable[[Column], Column] | None = None, model: str | None = None) -> Run:
    """Records through dedup, clustering, sampling and labelling; group names a column to cluster within.

    embedder maps a text column to unit vectors, sanitizer a text column to the one a judge may see, judge a pair of
    texts to a verdict; each has its default.
    """
    run = Run(settings, taxonomy)
    spark = records.sparkSession
    shots = shots if shots is not None else spark.createDataFrame([], "few_shot_id string, input_text string, output_text string")
    if sanitizer is not None:
        records = records.withColumns({c: sanitizer(F.col(c)) for c in ("input_text", "output_text")})
        own = schema.record_id(F.col("source_kind"), F.col("source_name"), F.col("line_no"), F.col("input_text"), F.col("output_text"))
        records = records.withColumn("record_id", own)
    out = dedup.run_dedup(records, settings.near_dup_threshold, embedder)
    kept = materialize(out["kept"], "kept")
    vectors = materialize(kept.select(*dedup.ORDER, *([group] if group else []), (embedder or embed_col)(F.col("input_text")).alias("vec")), "cluster-vectors")
    assigned = materialize(cluster.cluster_ids(cluster.cluster_rows(vectors, "record_id", "vec", group, dedup.ORDER, settings.min_cluster_size)), "clusters")
    chosen = materialize(sampling.stratified_sample(assigned.select(F.col("cluster_id").alias("stratum"), F.col("key").alias("record_id")), settings.sample_size, settings.seed), "sample")
    sampled = kept.join(chosen.select(F.col("key").alias("record_id")), "record_id", "left_semi")
    labels = labeling.run_labeling(sampled, shots, settings.max_labels, judge, taxonomy.taxonomy_id)
    run.tables = {"records": records, "kept": kept, "exact": out["exact"], "near": out["near"], "dedup_report": out["report"], "clusters": assigned, "sample": chosen, "sampled": sampled, "labels": labels, "shots": shots}
    run.facts["used"] = {"near_dup_threshold": settings.near_dup_threshold, "min_cluster_size": settings.min_cluster_size, "sample_size": settings.sample_size, "seed": settings.seed, "max_labels": settings.max_labels}
    run.facts["judge"] = fingerprint(taxonomy, [r.asDict(True) for r in shots.collect()] if "verdict" in shots.columns else [], model or (labeling.FAKE_MODEL if judge is None else "custom"))
    checks.require_sound(checks.check_partition(assigned, kept).unionByName(checks.check_labels(labels, settings.max_labels)))
    return run


def measure(run: Run, human: DataFrame, labels_sha256: str | None = None) -> dict[str, object]:
    """Agreement of the run's labels with a human's: ledger, kappa of both axes, per class, interval, disagreements."""
    other = human.where(F.col("taxonomy_id") != run.taxonomy.taxonomy_id).head(1)
    if other:
        raise TaxonomyMismatch(f"labels of {other[0]['taxonomy_id']}, run of {run.taxonomy.taxonomy_id}")
    labels = run.tables["labels"]
    judged = labels.where("bucket = 'labeled'").select("record_id", F.col("verdict.task_type").alias("j_task_type"), F.col("verdict.outcome").alias("j_outcome"))
    both = materialize(judged.join(human.select("record_id", "task_type", "outcome"), "record_id"), "matched")
    n = both.count()
    if not n:
        raise NoMatchedPairs("no record was labelled by both raters")
    found: dict[str, object] = {"accounting": agreement.match_accounting(judged, human).first().asDict(), "human_only": agreement.human_only_causes(labels, human), "labels_sha256": labels_sha256, "judge": run.facts["judge"]}
    resampled = materialize(agreement.resample_rows(human.sparkSession, run.settings.seed, run.settings.bootstrap_resamples, n), "resamples")
    placed = materialize(numbered(both, ["record_id"]), "placed")
    for axis, classes in (("task_type", schema.TASK_TYPES), ("outcome", schema.OUTCOMES)):
        pairs = placed.select("i", "record_id", F.col(axis).alias("human"), F.col("j_" + axis).alias("judge"))
        cells = materialize(agreement.confusion(pairs, classes), "cells")
        headline = agreement.global_kappa(cells).first().asDict() | agreement.bootstrap_kappa(pairs, resampled).first().asDict()
        found[axis] = {"headline": headline, "confusion": cells, "per_class": agreement.class_kappa(cells, run.settings.min_class_support), "disagreements": agreement.disagreements(pairs)}
    found["headline_ready"] = n >= run.settings.min_human_labels
    return found


def _chain(run: Run, found: dict[str, object]) -> tuple[tuple[str, str], ...]:
    judges = {"labels": run.facts["judge"], "agreement": found.get("judge") or {}}
    return tuple((k + end, jsonl.canonical_json(v) if not end else str(v.get("taxonomy_id"))) for k, v in judges.items() for end in ("", "_taxonomy"))


def _gate_facts(run: Run, found: dict[str, object]) -> tuple[tuple[str, object], ...]:
    h = found["outcome"]["headline"]
    facts = {k: h.get(k) for k in ("status", "kappa", "lower", "upper")} | {"ready": bool(found["headline_ready"]), "same_instrument": found.get("judge") == run.facts["judge"], "labels_sha256": found["labels_sha256"]}
    return tuple(sorted(facts.items()))


def publish(run: Run, found: dict[str, object], out_dir: str, inputs: tuple = (), override: str | None = None, volatile: dict | None = None, sources: tuple[str, ...] | None = None) -> export.Manifest:
    """Golden export behind its gate: refuses when blocked, empty or incoherent.

    found carries the fingerprint of the judge it was measured with; without one, or with another than the run's, the
    gate's check of the instrument fails.
    """
    s, t = run.settings, run.tables
    sinks.refuse_mixed(t["labels"].sparkSession, out_dir, "judge")
    decision = export.evaluate_gate(found["outcome"]["headline"], ready=bool(found["headline_ready"]), same_instrument=found.get("judge") == run.facts["judge"], labels_sha256=found["labels_sha256"], min_kappa=s.min_export_kappa, override=override)
    if decision.verdict == "blocked":
        raise export.ExportBlocked(decision)
    hashes = t["shots"].select(schema.content_hash(F.col("input_text"), F.col("output_text")).alias("h"))
    golden = materialize(export.golden_records(t["kept"], t["labels"], t["clusters"].select(F.col("key").alias("record_id"), "cluster_id"), hashes), "golden")
    n = golden.count()
    if not n:
        raise export.NothingToExport("every candidate was blocked")
    checks.require_sound(checks.check_golden(golden, hashes))
    report = t["dedup_report"].first()
    labeled = t["labels"].where("bucket = 'labeled'").count()
    digest = export.golden_lines(golden).select(F.sha2("value", 256).alias("d")).agg(F.sha2(F.concat_ws("", F.array_sort(F.collect_list("d"))), 256)).first()[0]
    manifest = export.Manifest(s.seed, report["records_in"], report["id_collapsed"], report["exact_dropped"], report["near_dropped"], report["records_out"], t["clusters"].count(), t["sample"].count(), labeled, labeled - n, n, digest, tuple(sorted(inputs)), s.snapshot(), decision, tuple(sorted(run.facts["used"].items())), _chain(run, found), sources, _gate_facts(run, found))
    wrong = manifest.coherent()
    if wrong:
        raise export.ExportInputError("; ".join(wrong))
    sinks.write_export(golden, manifest.render(volatile), out_dir)
    return manifest


def annotate(run: Run, out_dir: str) -> None:
    """Blank sheet and instructions for a human: labelable records only, no verdicts."""
    sinks.refuse_mixed(run.tables["labels"].sparkSession, out_dir, "annotation")
    labelable = run.tables["labels"].where("bucket <> 'fewshot_collision'").select("record_id")
    rows = run.tables["sampled"].join(labelable, "record_id", "left_semi")
    sinks.annotation_sheet(rows, run.taxonomy.taxonomy_id).write.mode("errorifexists").text(f"{out_dir}/sheet.jsonl")
    rows.sparkSession.createDataFrame([(annotator_instructions(run.taxonomy),)], "value string").coalesce(1).write.mode("errorifexists").text(f"{out_dir}/instructions")


def report_text(run: Run, found: dict[str, object] | None = None) -> str:
    """Text report of a run's counts."""
    t = run.tables
    parts = [
        sinks.render_table(t["dedup_report"], "dedup"),
        sinks.render_table(cluster.clustering_report(t["clusters"]), "clusters"),
        sinks.render_table(t["labels"].groupBy("bucket").count().orderBy("bucket"), "labels"),
    ]
    if found:
        for axis in ("task_type", "outcome"):
            h = found[axis]["headline"]
            parts.append(f"{axis}: kappa {h['kappa']} [{h['lower']}, {h['upper']}] n={h['n']} po={h['po']} pe={h['pe']} status={h['status']}\n")
            parts.append(sinks.render_table(found[axis]["per_class"].withColumn("band", agreement.landis_koch(F.col("kappa"))), f"{axis} by class"))
    return "\n".join(parts)
