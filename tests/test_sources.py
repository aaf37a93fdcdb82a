import json

import pytest
from pyspark.sql import functions as F

from tallymill import schema
from tallymill.operators import checks
from tallymill.sources import jsonl
from tallymill.streaming.ingest import stream_counts, stream_exchanges


def test_lines_of_bytes():
    got = jsonl.split_lines(b"a\r\n\nb\xff\nc")
    assert [(n, t) for n, t, _ in got] == [(1, "a"), (2, ""), (3, None), (4, "c")] and got[2][2]
    assert jsonl.split_lines(b"") == [] and jsonl.split_lines(b"x\n") == [(1, "x", None)]


GENERIC = [
    ({"meta": {"id": "i1", "ts": "2025-01-06T10:00:00"}, "q": "hello", "a": "you", "n": 1.5, "b": True}, "normalized"),
    ({"meta": {"ts": "yesterday"}, "q": "x", "a": 4}, "normalized"),
    ({"q": "x"}, "missing_field"),
    ({"q": "​", "a": "y"}, "no_exchange"),
    ({"q": None, "a": "y"}, "no_exchange"),
    ("q;a;text", "invalid_json"),
    ("42", "schema_mismatch"),
    ("   ", "blank_line"),
]


def test_generic_lines_into_buckets(spark, tmp_path):
    body = b"\n".join([json.dumps(x).encode() if isinstance(x, dict) else x.encode() for x, _ in GENERIC] + [b"\xff\xfe"])
    (tmp_path / "log.jsonl").write_bytes(body)
    lines = jsonl.read_lines(spark, f"file://{tmp_path}/log.jsonl")
    parsed = jsonl.parse_generic(lines, jsonl.Mapping("q", "a", "meta.ts", "meta.id", None, ("n", "b"))).cache()
    assert [r.bucket for r in parsed.orderBy("line_no").collect()] == [b for _, b in GENERIC] + ["invalid_encoding"]
    first = jsonl.records_of(parsed).orderBy("line_no").first()
    assert (first.source_name, first.span_id, first.timestamp, first.metadata) == ("log.jsonl", "i1", "2025-01-06T10:00:00", {"b": "True", "n": "1.5"})
    report = jsonl.ingest_report(parsed)
    r = report.first()
    assert (r.lines_read, r.normalized, r.rejected, r.skipped, r.timestamps_unparsed) == (9, 2, 4, 3, 1)
    checks.require_sound(checks.check_ingest(report).unionByName(checks.check_records(jsonl.records_of(parsed))))
    assert jsonl.reject_samples(parsed, 2).count() == 2
    assert jsonl.file_digests(spark, f"file://{tmp_path}/log.jsonl").first().name == "log.jsonl"


def test_spans_into_buckets(spark):
    base = {"span_id": "s", "task_id": "t", "agent": "g", "action": "plan", "status": "ok", "payload": {"prompt": "p", "result": "r"}}
    cases = [
        (base, "normalized"),
        ({**base, "action": "other"}, "action_not_candidate"),
        ({**base, "status": "error"}, "status_not_ok"),
        ({**base, "status": "odd"}, "schema_mismatch"),
        ({**base, "tokens_in": -1}, "schema_mismatch"),
        ({**base, "tokens_in": 3, "cost_usd": 0.5}, "normalized"),
        ({k: v for k, v in base.items() if k != "agent"}, "schema_mismatch"),
        ({**base, "payload": {"input": " ", "prompt": "p", "result": "r"}}, "no_exchange"),
        ({**base, "payload": {"input": 3, "prompt": "p", "result": "r"}}, "normalized"),
        ({k: v for k, v in base.items() if k != "payload"}, "no_exchange"),
    ]
    lines = spark.createDataFrame([("f", i, json.dumps(c), None) for i, (c, _) in enumerate(cases, 1)], schema.LINE)
    parsed = jsonl.parse_tracespan(lines)
    assert [r.bucket for r in parsed.orderBy("line_no").collect()] == [b for _, b in cases]
    assert parsed.where("line_no = 6").first().metadata == {"action": "plan", "agent": "g", "cost_usd": "0.5", "status": "ok", "tokens_in": "3"}


def test_strict_loaders(spark, tmp_path):
    def write(name, lines):
        (tmp_path / name).write_text("\n".join(json.dumps(x) if not isinstance(x, str) else x for x in lines))
        return f"file://{tmp_path}/{name}"

    pair = {"pair_id": "p", "text_a": "a", "text_b": "b", "label": "duplicate"}
    assert jsonl.load_labeled_pairs(spark, write("ok.jsonl", [pair])).count() == 1
    for bad in ([{**pair, "label": "maybe"}], ["{cut"], [{**pair, "text_a": None}]):
        with pytest.raises(jsonl.LabelFormatError):
            jsonl.load_labeled_pairs(spark, write("bad.jsonl", bad))
    label = {"record_id": "r1", "taxonomy_id": "t", "task_type": "other", "outcome": "correct", "annotator": "x"}
    assert jsonl.load_human_labels(spark, write("l.jsonl", [label])).count() == 1
    for bad in ([label, label], [label, {**label, "record_id": "r2", "taxonomy_id": "u"}], [{**label, "outcome": ""}], [{**label, "outcome": "odd"}]):
        with pytest.raises(jsonl.LabelFormatError):
            jsonl.load_human_labels(spark, write("lb.jsonl", bad))
    v = {"task_type": "other", "outcome": "correct", "confidence": "high", "rationale": "r"}
    import hashlib

    fid = "fs-" + hashlib.sha256("\x1f".join(["q", "a", *v.values()]).encode()).hexdigest()[:16]
    shot = {"few_shot_id": fid, "input_text": "q", "output_text": "a", "verdict": v, "note": None}
    assert jsonl.load_few_shots(spark, write("s.jsonl", [shot])).count() == 1
    with pytest.raises(jsonl.LabelFormatError):
        jsonl.load_few_shots(spark, write("sb.jsonl", [{**shot, "few_shot_id": "fs-0"}]))


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame([("s", 1, "q", "a", "2025-01-01 00:00:00"), ("s", 2, "q", "a", "2025-01-01 01:00:00"), ("s", 3, " ", "a", "2025-01-01 02:00:00"), ("t", 4, "q2", "a", "2025-01-02 02:00:00")], "source_name string, line_no bigint, q string, a string, t string").withColumn("ingested_at", F.to_timestamp("t"))
    rows.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    for name, df, mode in (("x", stream_exchanges(stream), "append"), ("c", stream_counts(stream), "complete")):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).start()
        q.processAllAvailable()
        q.stop()
    assert spark.sql("SELECT count(*) FROM x").first()[0] == 2 and spark.sql("SELECT sum(n) FROM c").first()[0] == 4
