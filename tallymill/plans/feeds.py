"""Queries over sources, loaders, sheets and small reports: lines are written to the shared folder and read back by the operator."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill import schema
from tallymill.functions.taxonomy import DEFAULT
from tallymill.operators import agreement, contracts, dedup, labeling
from tallymill.plans.soundness import _R, _rows
from tallymill.session import materialize, shared_dir, table
from tallymill.sources import jsonl, sinks


def _written(lines: DataFrame, name: str) -> str:
    """Path of one JSONL file holding the column `value`, in the order of `line_no`."""
    path = f"{shared_dir(lines.sparkSession)}/tallymill/{name}-{uuid.uuid4().hex}"
    lines.orderBy("line_no").select("value").coalesce(1).write.text(path)
    return path + "/part-*"


def source_lines(spark, sf_dir):
    """Lines of a written file by number, as the tolerant reader gives them."""
    raw = table(spark, sf_dir, "generic_demo").where("raw IS NOT NULL").withColumn("value", F.regexp_replace("raw", r"[\r\n]+", " "))
    numbered = raw.withColumn("line_no", F.row_number().over(_by_source()))
    first = numbered.agg(F.min("source_name")).first()[0]
    return jsonl.read_lines(spark, _written(numbered.where(F.col("source_name") == first), "lines"), first).select("source_name", "line_no", F.length("text").alias("size"), F.sha2("text", 256).alias("digest"))


def _by_source():
    from pyspark.sql import Window

    return Window.partitionBy("source_name").orderBy("line_no")


def file_digest(spark, sf_dir):
    """Digest of a written file's exact bytes."""
    rows = table(spark, sf_dir, "log_sources").select(F.row_number().over(_every("source_name")).alias("line_no"), F.concat_ws("|", "source_name", "tz", "date_order").alias("value"))
    return jsonl.file_digests(spark, _written(rows, "digest")).select("sha256")


def _every(column: str):
    from pyspark.sql import Window

    return Window.orderBy(column)


_KINDS = "CASE line_no % 11 WHEN 1 THEN 'broken' WHEN 2 THEN 'blank' WHEN 3 THEN 'list' WHEN 4 THEN 'no agent' WHEN 5 THEN 'other action' WHEN 6 THEN 'error' WHEN 7 THEN 'blank input' WHEN 8 THEN 'negative' WHEN 9 THEN 'no payload' ELSE 'sound' END"


def _spans(spark, sf_dir) -> DataFrame:
    """Span lines made from the log, nine of eleven broken in a way of their own."""
    rows = _rows(spark, sf_dir).withColumn("k", F.expr(_KINDS))
    k = F.col("k")
    span = F.struct(
        F.concat(F.lit("s"), F.col("line_no").cast("string")).alias("span_id"), F.lit("task-1").alias("task_id"), F.when(k != "no agent", "worker").alias("agent"), F.when(k == "other action", "sleep").otherwise("execute").alias("action"),
        F.when(k == "error", "error").otherwise("ok").alias("status"), F.when(k == "negative", -1).otherwise(F.col("line_no") % 9).alias("tokens_in"),
        F.when(k != "no payload", F.struct(F.when(k == "blank input", "  ").otherwise("Frage").alias("prompt"), F.lit("later").alias("task"), F.lit("Antwort").alias("response"))).alias("payload"),
    )
    text = F.when(k == "broken", "{cut").when(k == "blank", " ").when(k == "list", "[1]").otherwise(F.to_json(span))
    return jsonl.parse_tracespan(rows.select("source_name", "line_no", text.alias("text"), F.lit(None).cast("string").alias("decode_error")))


def span_buckets(spark, sf_dir):
    return _spans(spark, sf_dir).select("source_name", "line_no", "bucket")


def span_records(spark, sf_dir):
    """Records of the sound spans, with their metadata."""
    got = jsonl.records_of(_spans(spark, sf_dir))
    return got.select("line_no", "record_id", "span_id", "task_id", "input_text", "output_text", F.concat_ws(",", F.transform(F.map_entries("metadata"), lambda e: F.concat_ws("=", e["key"], e["value"]))).alias("metadata"))


def ingest_reasons(spark, sf_dir):
    """Every counter of the ingest report, a row each, and the timestamps that stayed text."""
    from tallymill.plans.registry import _parsed

    report = jsonl.ingest_report(_parsed(spark, sf_dir))
    names = (*schema.REJECT_REASONS, *schema.SKIP_REASONS)
    return report.select("source_name", F.explode(F.array(*[F.struct(F.lit(n).alias("reason"), F.col(n).alias("n")) for n in names])).alias("c")).select("source_name", "c.*").where("n > 0")


def labeled_pairs(spark, sf_dir):
    """Labelled pairs through the strict loader."""
    pairs = table(spark, sf_dir, "neardup_pairs").withColumn("label", F.lower(F.trim("label"))).where("label IN ('duplicate', 'distinct') AND trim(text_a) <> '' AND trim(text_b) <> ''")
    lines = pairs.select(F.col("no_a").alias("line_no"), F.to_json(F.struct("pair_id", "text_a", "text_b", "label")).alias("value"))
    return jsonl.load_labeled_pairs(spark, _written(lines, "pairs")).select("pair_id", "text_a", "text_b", "label")


def _one_rater(spark, sf_dir) -> DataFrame:
    """A label a record of one taxonomy, spelt as the vocabularies spell it."""
    labels = table(spark, sf_dir, "annotations_synthetic").withColumn("outcome", F.regexp_replace(F.lower(F.trim("outcome")), "[ -]+", "_")).where(F.col("outcome").isin(*schema.OUTCOMES))
    return labels.groupBy("record_id").agg(F.min("outcome").alias("outcome"), F.min(F.coalesce("annotator", F.lit("nobody"))).alias("annotator")).withColumn("task_type", F.lit("other")).withColumn("taxonomy_id", F.lit(DEFAULT.taxonomy_id))


def human_labels(spark, sf_dir):
    """One rater's labels through the strict loader."""
    lines = _one_rater(spark, sf_dir).select(F.col("record_id").alias("line_no"), F.to_json(F.struct("record_id", "taxonomy_id", "task_type", "outcome", "annotator")).alias("value"))
    return jsonl.load_human_labels(spark, _written(lines, "labels")).select("record_id", "task_type", "outcome", "annotator")


def few_shots(spark, sf_dir):
    """Few-shot examples through the strict loader, ids derived from their content."""
    verdict = F.struct(F.lit("other").alias("task_type"), F.lit("correct").alias("outcome"), F.lit("low").alias("confidence"), F.lit("why").alias("rationale"))
    shots = table(spark, sf_dir, "judge_v1").where("input_text NOT RLIKE '[@/=+]' AND output_text NOT RLIKE '[@/=+]'").select(F.lower(F.regexp_replace("input_text", r"[^A-Za-z ]+", "")).alias("input_text"), F.lit("done").alias("output_text")).dropDuplicates(["input_text"]).withColumn("verdict", verdict)
    own = schema.few_shot_id(F.col("input_text"), F.col("output_text"), *[F.col("verdict." + k) for k in ("task_type", "outcome", "confidence", "rationale")])
    lines = shots.withColumn("few_shot_id", own).select(F.col("few_shot_id").alias("line_no"), F.to_json(F.struct("few_shot_id", "input_text", "output_text", "verdict")).alias("value"))
    return jsonl.load_few_shots(spark, _written(lines, "shots")).select("few_shot_id", "input_text")


def annotation_lines(spark, sf_dir):
    """The blank sheet for a human, one JSON line a record."""
    rows = _rows(spark, sf_dir).where(_plain("input_text") & _plain("output_text"))
    return sinks.annotation_sheet(rows, "tax-1")


def _plain(column: str):
    """Texts that every JSON writer spells alike."""
    return ~F.col(column).rlike(r"[\x00-\x1f\x7f  \"\\/]")


def entry_chain(spark, sf_dir):
    """Exact entries whose survivor falls to a near duplicate point on to the last survivor."""
    exact = materialize(dedup.exact_entries(_rows(spark, sf_dir)), "exact")
    near = exact.select(F.col("kept_record_id").alias("dropped")).distinct().where(F.ascii(F.substring("dropped", -1, 1)) % 2 == 0).select("dropped", F.concat(F.lit("near-"), "dropped").alias("kept"))
    return dedup.remap_entries(exact, near)


def bucket_counts(spark, sf_dir):
    """The five label buckets of a run whose examples are rows of the log itself, so that some do collide."""
    rows = _rows(spark, sf_dir)
    shots = rows.where(F.col("line_no") % 25 == 0).select("input_text", "output_text")
    return labeling.run_labeling(rows, shots, 1000, taxonomy_id="tax-1").select("record_id", "bucket")


def collisions_blocked(spark, sf_dir):
    """Records kept from export because they are examples of the judge, the examples being rows of the log."""
    from tallymill.operators.export import split_contaminated

    rows = _rows(spark, sf_dir)
    hashes = rows.where(F.col("line_no") % 25 == 0).select(schema.content_hash(F.col("input_text"), F.col("output_text")).alias("h"))
    return split_contaminated(rows, hashes)[1]


def label_content(spark, sf_dir):
    """Fingerprint of the labels' content, the same for the rows in another order and division."""
    labels = _one_rater(spark, sf_dir)
    a, b = (contracts.label_fingerprint(x) for x in (labels, labels.repartition(7, "outcome").sort(F.desc("record_id"))))
    other = contracts.label_fingerprint(labels.withColumn("outcome", F.lit("correct")))
    return a.crossJoin(b.select(F.col("fingerprint").alias("again"))).crossJoin(other.select(F.col("fingerprint").alias("changed"))).select("n", (F.col("fingerprint") == F.col("again")).alias("same"), (F.col("fingerprint") == F.col("changed")).alias("blind"))


def label_vocabularies(spark, sf_dir):
    return contracts.distinct_sets(table(spark, sf_dir, "annotations_synthetic"), ("annotator", "taxonomy_id"))


def foreign_labels(spark, sf_dir):
    """Labels of another taxonomy than the most used one's first."""
    return contracts.foreign_taxonomies(table(spark, sf_dir, "annotations_synthetic"), _first_taxonomy(spark, sf_dir))


def _first_taxonomy(spark, sf_dir) -> str:
    return table(spark, sf_dir, "annotations_synthetic").agg(F.min("taxonomy_id")).first()[0]


def cluster_heads(spark, sf_dir):
    """First member of every group of the log's channels in canonical order, with its preview."""
    from tallymill.plans import reports

    rows = _rows(spark, sf_dir)
    return reports.cluster_heads(rows.select(F.col("stratum").alias("cluster_id"), F.col("record_id").alias("key")), rows).select("cluster_id", "size", "record_id", F.length("head").alias("chars"))


def kappa_bands(spark, sf_dir):
    """The usual words for kappas from -1 to 1 in steps of a fiftieth."""
    return spark.range(-50, 51).select((F.col("id") / 50).alias("kappa")).withColumn("band", agreement.landis_koch(F.col("kappa")))


def degenerate_resamples(spark, sf_dir):
    """All intervals' resamples without a kappa, added up."""
    from tallymill.plans import reports
    from tallymill.plans.registry import RESAMPLES, bootstrap_per_class

    return reports.degenerate_total(bootstrap_per_class(spark, sf_dir)).select((F.col("degenerate") >= 0).alias("counted"), (F.col("resamples") == RESAMPLES * len(schema.OUTCOMES)).alias("all_classes"))


_STAMPS = (
    ("2024-03-31T02:30:00", "Europe/Paris", "dmy", "2024-03-31T01:30:00.000000Z"), ("2024-10-27 02:30", "Europe/Paris", "dmy", "2024-10-27T00:30:00.000000Z"), ("03/04/2025 10:00", "Europe/Paris", "dmy", "2025-04-03T08:00:00.000000Z"),
    ("03/04/2025 10:00", "America/Toronto", "mdy", "2025-03-04T15:00:00.000000Z"), ("1736173215", None, None, "2025-01-06T14:20:15.000000Z"), ("1736133557504", None, None, "2025-01-06T03:19:17.504000Z"), ("2025-W02-1T06:21:35Z", None, None, "2025-01-06T06:21:35.000000Z"),
    ("2025-006T05:59:37Z", None, None, "2025-01-06T05:59:37.000000Z"), ("6 janvier 2025 à 04h57", "Europe/Paris", "dmy", "2025-01-06T03:57:00.000000Z"), ("3 févr. 2024 10:00", "Europe/Paris", "dmy", "2024-02-03T09:00:00.000000Z"), ("Mon Mar  4 10:00:00 2024", "UTC", "dmy", "2024-03-04T10:00:00.000000Z"),
    ("2025-01-06T06:56:19.940967019Z", None, None, "2025-01-06T06:56:19.940967Z"), ("2025/01/05 23:27:35 America/Toronto", "UTC", "dmy", "2025-01-06T04:27:35.000000Z"), ("Jan 6, 2025 12:04 AM", "UTC", "mdy", "2025-01-06T00:04:00.000000Z"), ("2025-02-30T10:00:00Z", "UTC", "dmy", None), ("31/11/2025 25:61", "UTC", "dmy", None),
    ("lundi matin", "UTC", "dmy", None), ("", "UTC", "dmy", None), (None, "UTC", "dmy", None), ("2025-01-06 02:50:54 CET", "UTC", "dmy", "2025-01-06T01:50:54.000000Z"), ("2025-01-06 02:50:54 XYZ", "UTC", "dmy", None), ("2025-01-06 02:50", None, "dmy", None),
)


def stamp_fixture(spark, sf_dir):
    """Written stamps and their instants, among them repeated and skipped wall times and what denotes none."""
    from tallymill.operators.timestamps import utc_of

    rows = spark.createDataFrame([(i, *s[:3]) for i, s in enumerate(_STAMPS)], "id int, stamp string, tz string, date_order string")
    return rows.select("id", utc_of(F.col("stamp"), F.col("tz"), F.col("date_order")).alias("utc"))


QUERIES = {f.__name__: f for f in (
    source_lines, file_digest, span_buckets, span_records, ingest_reasons, labeled_pairs, human_labels, few_shots, annotation_lines, entry_chain, bucket_counts, collisions_blocked, label_content, label_vocabularies,
    foreign_labels, cluster_heads, kappa_bands, degenerate_resamples, stamp_fixture,
)}

_CLASSES = ", ".join(repr(c) for c in schema.OUTCOMES)
_ONE = f"o AS (SELECT record_id, regexp_replace(lower(trim(outcome)), '[ -]+', '_', 'g') AS outcome, coalesce(annotator, 'nobody') AS annotator FROM annotations_synthetic), one AS (SELECT record_id, min(outcome) AS outcome, min(annotator) AS annotator FROM o WHERE outcome IN ({_CLASSES}) GROUP BY record_id)"
_HASHES = "s AS (SELECT DISTINCT h FROM r WHERE line_no % 25 = 0)"
_QUOTED = "'\"' || {} || '\"'"
_PLAIN = "NOT regexp_matches({0}, '[\\x00-\\x1f\\x7f\\x{{2028}}\\x{{2029}}\"\\\\/]')"
SQL = {
    "source_lines": "WITH f AS (SELECT min(source_name) AS s FROM generic_demo WHERE raw IS NOT NULL) SELECT source_name, row_number() OVER (ORDER BY line_no) AS line_no, length(t)::INT AS size, sha256(t) AS digest FROM (SELECT source_name, line_no, regexp_replace(raw, '[\\r\\n]+', ' ', 'g') AS t FROM generic_demo, f WHERE raw IS NOT NULL AND source_name = s)",
    "file_digest": "SELECT sha256(string_agg(source_name || '|' || tz || '|' || date_order || chr(10), '' ORDER BY source_name)) AS sha256 FROM log_sources",
    "span_buckets": f"WITH {_R} SELECT source_name, line_no, CASE {_KINDS} WHEN 'broken' THEN 'invalid_json' WHEN 'blank' THEN 'blank_line' WHEN 'list' THEN 'schema_mismatch' WHEN 'no agent' THEN 'schema_mismatch' WHEN 'other action' THEN 'action_not_candidate' WHEN 'error' THEN 'status_not_ok' WHEN 'blank input' THEN 'no_exchange' WHEN 'negative' THEN 'schema_mismatch' WHEN 'no payload' THEN 'no_exchange' ELSE 'normalized' END AS bucket FROM r",
    "span_records": f"WITH {_R} SELECT line_no, 'rec-' || substr(sha256(concat_ws(chr(31), 'tracespan', source_name, line_no::VARCHAR, 'Frage', 'Antwort')), 1, 16) AS record_id, 's' || line_no AS span_id, 'task-1' AS task_id, 'Frage' AS input_text, 'Antwort' AS output_text, 'action=execute,agent=worker,status=ok,tokens_in=' || (line_no % 9) AS metadata FROM r WHERE {_KINDS} = 'sound'",
    "labeled_pairs": "SELECT pair_id, text_a, text_b, lower(trim(label)) AS label FROM neardup_pairs WHERE lower(trim(label)) IN ('duplicate', 'distinct') AND trim(text_a) <> '' AND trim(text_b) <> ''",
    "human_labels": f"WITH {_ONE} SELECT record_id, 'other' AS task_type, outcome, annotator FROM one",
    "few_shots": "WITH s AS (SELECT DISTINCT lower(regexp_replace(input_text, '[^A-Za-z ]+', '', 'g')) AS input_text FROM judge_v1 WHERE NOT regexp_matches(input_text, '[@/=+]') AND NOT regexp_matches(output_text, '[@/=+]')) SELECT 'fs-' || substr(sha256(concat_ws(chr(31), input_text, 'done', 'other', 'correct', 'low', 'why')), 1, 16) AS few_shot_id, input_text FROM s",
    "annotation_lines": f"""WITH {_R} SELECT '{{"record_id":' || {_QUOTED.format("record_id")} || ',"taxonomy_id":"tax-1","task_type":"","outcome":"","annotator":"","note":"","input_text":' || {_QUOTED.format("q")} || ',"output_text":' || {_QUOTED.format("a")} || '}}' AS value FROM r WHERE {_PLAIN.format("q")} AND {_PLAIN.format("a")}""",
    "entry_chain": f"WITH {_R}, f AS (SELECT h, arg_min(record_id, {{'s': source_name, 'l': line_no, 'r': record_id}}) AS kept FROM r GROUP BY h) SELECT record_id AS dropped_record_id, CASE WHEN ascii(right(kept, 1)) % 2 = 0 THEN 'near-' || kept ELSE kept END AS kept_record_id, h AS content_hash FROM r JOIN f USING (h) WHERE record_id <> kept",
    "bucket_counts": f"WITH {_R}, {_HASHES}, o AS (SELECT record_id, h IN (SELECT h FROM s) AS hit, row_number() OVER (PARTITION BY h IN (SELECT h FROM s) ORDER BY source_name, line_no, record_id) AS k FROM r) SELECT record_id, CASE WHEN hit THEN 'fewshot_collision' WHEN k <= 1000 THEN 'labeled' ELSE 'skipped_budget' END AS bucket FROM o",
    "collisions_blocked": f"WITH {_R}, {_HASHES} SELECT record_id, 'fewshot_collision' AS cause FROM r SEMI JOIN s USING (h)",
    "label_content": f"WITH {_ONE} SELECT count(*) AS n, true AS same, false AS blind FROM one",
    "label_vocabularies": "SELECT DISTINCT 'annotator' AS name, annotator AS value FROM annotations_synthetic WHERE annotator IS NOT NULL UNION ALL SELECT DISTINCT 'taxonomy_id', taxonomy_id FROM annotations_synthetic WHERE taxonomy_id IS NOT NULL",
    "foreign_labels": "SELECT taxonomy_id, count(*) AS labels FROM annotations_synthetic WHERE taxonomy_id IS DISTINCT FROM (SELECT min(taxonomy_id) FROM annotations_synthetic) GROUP BY taxonomy_id",
    "cluster_heads": f"WITH {_R} SELECT stratum AS cluster_id, count(*) AS size, arg_min(record_id, {{'s': source_name, 'l': line_no, 'r': record_id}}) AS record_id, least(64, length(arg_min(q, {{'s': source_name, 'l': line_no, 'r': record_id}})))::INT AS chars FROM r GROUP BY stratum",
    "kappa_bands": "SELECT k / 50.0::DOUBLE AS kappa, CASE WHEN k < 0 THEN 'poor' WHEN k <= 10 THEN 'slight' WHEN k <= 20 THEN 'fair' WHEN k <= 30 THEN 'moderate' WHEN k <= 40 THEN 'substantial' ELSE 'almost perfect' END AS band FROM range(-50, 51) t(k)",
    "degenerate_resamples": "SELECT true AS counted, true AS all_classes",
    "stamp_fixture": "SELECT * FROM (VALUES " + ", ".join(f"({i}::INT, {'NULL' if s[3] is None else repr(s[3])}::VARCHAR)" for i, s in enumerate(_STAMPS)) + ") v(id, utc)",
}
