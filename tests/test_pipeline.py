import json

import pytest
from pyspark.sql import functions as F

from tallymill.functions.taxonomy import DEFAULT, Axis, Taxonomy, annotator_instructions, fingerprint, system_prompt
from tallymill.operators import export
from tallymill.plans import pipeline
from tallymill.plans.settings import Settings
from tallymill.sources import jsonl


def test_settings_bounds(monkeypatch):
    monkeypatch.setenv("TALLYMILL_SAMPLE_SIZE", "7")
    assert Settings.from_env(seed=2) == Settings(seed=2, sample_size=7)
    for bad in ({"near_dup_threshold": 1.5}, {"max_labels": 0}, {"min_cluster_size": 1}):
        with pytest.raises(ValueError):
            Settings(**bad)


def test_taxonomy_identity_and_prompt():
    shots = [{"few_shot_id": f"fs-{i}", "input_text": "q{x}", "output_text": "a", "verdict": {"task_type": "other", "outcome": "correct", "confidence": "low", "rationale": "r"}} for i in (2, 1)]
    assert system_prompt(DEFAULT, shots) == system_prompt(DEFAULT, shots[::-1]) and fingerprint(DEFAULT, shots, "m") == fingerprint(DEFAULT, shots[::-1], "m")
    other = Taxonomy("x", "1", (Axis("task_type", "?", (("a", "b"),)),))
    assert other.taxonomy_id != DEFAULT.taxonomy_id and DEFAULT.taxonomy_id in annotator_instructions(DEFAULT)
    with pytest.raises(ValueError):
        Axis("a", "?", (("c", "1"), ("c", "2")))


def test_sources_to_export(spark, tmp_path):
    topics = ["capteur de vitesse sur la route numéro", "tarif du parking de la gare centrale", "fermeture du pont pendant les travaux"]
    log = [{"q": f"{topics[i % 3]} {i // 3} aujourd'hui", "a": f"réponse {i}"} for i in range(45)] + [{"q": f"{topics[0]} 0 aujourd'hui", "a": "réponse 0"}]
    (tmp_path / "log.jsonl").write_text("\n".join([*map(json.dumps, log), "{cut", ""]))
    records, report = pipeline.ingest(spark, [(f"file://{tmp_path}/log.jsonl", "generic_jsonl", jsonl.Mapping("q", "a"))])
    r = report.first()
    assert (r.lines_read, r.normalized, r.invalid_json) == (47, 46, 1)
    settings = Settings(sample_size=30, max_labels=25, min_human_labels=5, bootstrap_resamples=50, near_dup_threshold=0.999)
    run = pipeline.curate(records, settings)
    assert run.tables["dedup_report"].first()["exact_dropped"] == 1 and run.tables["sample"].count() == 30
    labels = run.tables["labels"]
    assert labels.where("bucket = 'labeled'").count() == 25
    human = labels.where("bucket = 'labeled'").select("record_id", F.lit(run.taxonomy.taxonomy_id).alias("taxonomy_id"), "verdict.task_type", "verdict.outcome").limit(20)
    found = pipeline.measure(run, human, "f" * 64)
    assert found["outcome"]["headline"]["kappa"] == 1.0 and found["accounting"]["n_matched"] == 20
    manifest = pipeline.publish(run, found, f"file://{tmp_path}/out")
    assert manifest.exported == 25 and json.loads(next((tmp_path / "out").glob("export-*/meta.json")).read_text())["deterministic"]["exported"] == 25
    with pytest.raises(export.ExportBlocked, match="instrument_binding"):
        pipeline.publish(run, {k: v for k, v in found.items() if k != "judge"}, f"file://{tmp_path}/out2")
    assert "kappa 1.0" in pipeline.report_text(run, found)
    with pytest.raises(export.ExportBlocked):
        pipeline.publish(run, found | {"headline_ready": False}, f"file://{tmp_path}/out2")
    with pytest.raises(pipeline.TaxonomyMismatch):
        pipeline.measure(run, human.withColumn("taxonomy_id", F.lit("tax-0")))
    with pytest.raises(pipeline.NoMatchedPairs):
        pipeline.measure(run, human.withColumn("record_id", F.lit("nobody")))
    pipeline.annotate(run, f"file://{tmp_path}/sheet")
    assert spark.read.text(f"file://{tmp_path}/sheet/sheet.jsonl").count() == 30
