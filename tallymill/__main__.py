"""Command line: run | calibrate | annotate over JSONL sources."""

from __future__ import annotations

import argparse
import sys

from tallymill.plans import pipeline
from tallymill.plans.settings import Settings
from tallymill.session import build_session
from tallymill.sources import jsonl


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tallymill")
    p.add_argument("task", choices=("run", "calibrate", "annotate"))
    p.add_argument("--generic", action="append", default=[], help="path of a generic JSONL source")
    p.add_argument("--spans", action="append", default=[], help="path of a span JSONL source")
    p.add_argument("--input-key", default="q")
    p.add_argument("--output-key", default="a")
    p.add_argument("--timestamp-key")
    p.add_argument("--pairs", help="labelled pairs, for calibrate")
    p.add_argument("--few-shots")
    p.add_argument("--labels", help="human labels")
    p.add_argument("--out", help="folder of the export or the annotation sheet")
    p.add_argument("--override", help="reason to export below the threshold")
    o = p.parse_args(args)
    spark = build_session()
    if o.task == "calibrate":
        from pyspark.sql import functions as F

        from tallymill.functions.embed import dot, embed_col
        from tallymill.operators.dedup import best_threshold, calibration_sweep
        from tallymill.session import materialize

        scored = materialize(jsonl.load_labeled_pairs(spark, o.pairs).select(embed_col("text_a").alias("x"), embed_col("text_b").alias("y"), (F.col("label") == "duplicate").alias("duplicate")), "pairs")
        best = best_threshold(calibration_sweep(scored.select(dot(F.col("x"), F.col("y")).alias("similarity"), "duplicate"))).first()
        if best is None:
            print("at least two different similarities are needed", file=sys.stderr)
            return 2
        print(jsonl.canonical_json(best.asDict()))
        return 0
    mapping = jsonl.Mapping(o.input_key, o.output_key, o.timestamp_key)
    records, report = pipeline.ingest(spark, [(x, "generic_jsonl", mapping) for x in o.generic] + [(x, "tracespan", None) for x in o.spans])
    shots = jsonl.load_few_shots(spark, o.few_shots) if o.few_shots else None
    run = pipeline.curate(records, Settings.from_env(), shots=shots)
    from tallymill.plans import reports
    from tallymill.sources.sinks import ArtifactsPresent

    try:
        if o.task == "annotate":
            pipeline.annotate(run, o.out)
            print(reports.annotation_report(run))
            return 0
        return _measure(spark, o, run, report)
    except ArtifactsPresent as e:
        print(f"refused: {e}", file=sys.stderr)
        return 2


def _measure(spark, o, run, report) -> int:
    from tallymill.operators.export import ExportError
    from tallymill.plans import reports

    given = [("source_log", x) for x in (*o.generic, *o.spans)] + [("few_shot_store", o.few_shots), ("human_labels", o.labels)]
    inputs = tuple((role, r["name"], r["sha256"]) for role, path in given if path for r in jsonl.file_digests(spark, path).collect())
    found = None
    if o.labels:
        digest = next(sha for role, _, sha in inputs if role == "human_labels")
        found = pipeline.measure(run, jsonl.load_human_labels(spark, o.labels), digest)
    print(reports.demo_report(run, report))
    if found:
        print(reports.agreement_report(run, found))
    if found and o.out:
        try:
            sources = tuple(sorted(r[0] for r in report.select("source_name").collect()))
            manifest = pipeline.publish(run, found, o.out, inputs=inputs, override=o.override, sources=sources)
        except ExportError as e:
            print(f"no export: {e}", file=sys.stderr)
            return 2
        reports.write_run_report(spark, run, found, o.out)
        print(reports.export_report(manifest))
    return 0


if __name__ == "__main__":
    sys.exit(main())
