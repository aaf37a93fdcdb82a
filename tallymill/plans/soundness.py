"""Queries that plant breaks in sound tables and show which rule finds each; the SQL names the planted rows."""

from __future__ import annotations

from dataclasses import replace
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill import schema
from tallymill.operators import agreement, checks, contracts, dedup, export
from tallymill.operators.order import numbered
from tallymill.session import materialize, table

_R = "r AS (SELECT *, coalesce(lang, '') AS stratum, sha256(q || chr(31) || a) AS h FROM cluster_demo WHERE regexp_matches(q, '[^ \\t\\n\\x0B\\f\\r]') AND regexp_matches(a, '[^ \\t\\n\\x0B\\f\\r]'))"


def _rows(spark, sf_dir) -> DataFrame:
    text = r"[^ \t\n\x0B\f\r]"
    rows = table(spark, sf_dir, "cluster_demo").where(F.col("q").rlike(text) & F.col("a").rlike(text))
    return rows.select(F.lit("generic_jsonl").alias("source_kind"), "source_name", "line_no", F.col("q").alias("input_text"), F.col("a").alias("output_text"), F.coalesce("lang", F.lit("")).alias("stratum"), "record_id")


def _nth(n: int) -> F.Column:
    return F.col("line_no") % 50 == n


def violations_records(spark, sf_dir):
    """Wrong ids, whole paths, blank sides and repeated records, one row in fifty each."""
    rows = _rows(spark, sf_dir).drop("record_id")
    rows = rows.withColumn("source_name", F.when(_nth(2), F.concat(F.lit("/tmp/"), "source_name")).otherwise(F.col("source_name"))).withColumn("output_text", F.when(_nth(3), " \t ").otherwise(F.col("output_text")))
    own = schema.record_id(F.col("source_kind"), F.col("source_name"), F.col("line_no"), F.col("input_text"), F.col("output_text"))
    rows = rows.withColumn("record_id", F.when(_nth(1), F.concat(F.lit("rec-x"), F.col("line_no").cast("string"))).otherwise(own))
    return checks.check_records(materialize(rows.unionByName(rows.where(_nth(4))), "planted"))


def violations_lines(spark, sf_dir):
    """Lines with both a text and a decoding error, or neither."""
    lines = table(spark, sf_dir, "generic_demo").select("source_name", "line_no", F.col("raw").alias("text"), F.when((F.col("line_no") % 7 == 1) | F.col("raw").isNull() & (F.col("line_no") % 7 != 2), "bad byte").alias("decode_error"))
    return contracts.check_lines(lines)


def _ingest(spark, sf_dir) -> DataFrame:
    """A sound report per source, by arithmetic on the rows."""
    per = numbered(table(spark, sf_dir, "cluster_demo").groupBy("source_name").agg(F.count("*").alias("lines_read")), ["source_name"], "k")
    zero = {r: F.lit(0).cast("bigint") for r in (*schema.REJECT_REASONS, *schema.SKIP_REASONS)}
    return per.withColumns(zero | {"normalized": F.col("lines_read") - 3, "rejected": F.lit(2).cast("bigint"), "skipped": F.lit(1).cast("bigint")}).withColumns({"invalid_json": F.lit(2).cast("bigint"), "blank_line": F.lit(1).cast("bigint")})


def violations_ingest(spark, sf_dir):
    """Buckets and reasons that don't add up, and more samples than rejected lines, by the place of the source."""
    report = _ingest(spark, sf_dir)
    bad = report.withColumn("lines_read", F.col("lines_read") + (F.col("k") % 5 == 0).cast("int")).withColumn("missing_field", F.when(F.col("k") % 5 == 1, 1).otherwise(0)).withColumn("no_exchange", F.when(F.col("k") % 5 == 2, 4).otherwise(0))
    samples = report.select("source_name", F.explode(F.sequence(F.lit(1), F.when(F.col("k") % 5 == 3, 3).otherwise(2))).alias("line_no"))
    return checks.check_ingest(bad).unionByName(contracts.check_samples(bad, samples))


def violations_dedup(spark, sf_dir):
    """A record that drops itself, a survivor nobody knows, one dropped twice, a bad digest, wrong counts and wrong chain flags."""
    rows = _rows(spark, sf_dir)
    exact = materialize(dedup.exact_entries(rows).select(F.col("dropped_record_id").alias("dropped"), F.col("kept_record_id").alias("kept"), "content_hash"), "entries")
    kept = materialize(rows.join(exact.select(F.col("dropped").alias("record_id")), "record_id", "left_anti").select("record_id"), "kept")
    first = kept.agg(F.min("record_id").alias("f"))
    planted = first.select(F.explode(F.array(*[F.struct(d.alias("dropped"), k.alias("kept"), F.lit(h).alias("content_hash")) for d, k, h in (
        (F.col("f"), F.col("f"), "0" * 64), (F.lit("gone-1"), F.lit("gone-2"), "0" * 64), (F.lit("gone-1"), F.col("f"), "0" * 63 + "G"),
    )])).alias("e")).select("e.*")
    entries = exact.unionByName(planted)
    report = dedup.dedup_report(rows, rows, exact, _near(spark, sf_dir, 1)).withColumn("records_out", F.col("records_out") + 1)
    return checks.check_dedup(report, kept, entries).unionByName(contracts.check_entries(entries)).unionByName(contracts.check_chain_flags(report, _near(spark, sf_dir, 0), 0.5))


def _near(spark, sf_dir, k: int) -> DataFrame:
    """Near entries by arithmetic: similarity from the number, the flag wrong for two of them, k left out."""
    rows = table(spark, sf_dir, "neardup_pairs").select(F.floor((F.col("no_a") + 1) / 2).alias("n"))
    flagged = rows.select(F.concat(F.lit("t"), F.col("n").cast("string")).alias("dropped"), (F.col("n") % 100 / 100).alias("similarity"), (((F.col("n") % 100) / 100 < 0.5) != (F.col("n") % 10 == 8)).alias("via_chain"))
    return flagged.orderBy("dropped").offset(k) if k else flagged


def violations_clusters(spark, sf_dir):
    """Members out of order, a foreign id, a record in two clusters, one in none, one unknown."""
    rows = materialize(_rows(spark, sf_dir), "rows")
    grouped = rows.groupBy(F.col("source_name").alias("s"), (F.col("line_no") % 40).alias("m")).agg(F.array_sort(F.collect_list("record_id")).alias("members")).where("size(members) >= 2")
    clusters = grouped.withColumn("cluster_id", schema.cluster_id(F.col("members")))
    clusters = clusters.withColumn("members", F.when(F.col("m") == 1, F.reverse("members")).otherwise(F.col("members")))
    clusters = materialize(clusters.withColumn("cluster_id", F.when(F.col("m") == 3, "cl-000000000000").otherwise(F.col("cluster_id"))), "clusters")
    extra = clusters.where("m = 4").select("s", "m", F.slice("members", 1, 1).alias("members")).withColumn("cluster_id", schema.cluster_id(F.col("members")))
    return contracts.check_clusters(clusters.unionByName(extra))


def violations_partition(spark, sf_dir):
    """Records without a cluster, unknown records and records in two clusters."""
    rows = _rows(spark, sf_dir)
    assigned = rows.select(F.col("record_id").alias("key"), "line_no").where(F.col("line_no") % 50 != 1).withColumn("key", F.when(_nth(2), F.concat(F.lit("new-"), "key")).otherwise(F.col("key")))
    assigned = materialize(assigned.unionByName(assigned.where(_nth(3))), "assigned")
    return checks.check_partition(assigned, rows)


def violations_quotas(spark, sf_dir):
    """Quotas beyond their stratum, and a total that isn't the request."""
    sizes = _rows(spark, sf_dir).groupBy("stratum").agg(F.count("*").alias("size"))
    return checks.check_quotas(sizes.withColumn("quota", F.col("size") + F.when(F.col("stratum") == "", 1).otherwise(0)), 10)


def violations_labels(spark, sf_dir):
    """Unknown buckets, verdicts where there is none to be, repeated records, a report that doesn't fit, a foreign taxonomy, a broken budget."""
    verdict = F.struct(F.lit("other").alias("task_type"))
    kind = F.col("line_no") % 5
    bucket = F.when(kind == 0, "labeled").when(kind == 1, "refused").when(kind == 2, "failed").when(kind == 3, "skipped_budget").otherwise("fewshot_collision")
    labels = _rows(spark, sf_dir).select("record_id", "line_no", F.when(_nth(7), "lost").otherwise(bucket).alias("bucket"), F.when((kind == 0) | _nth(8), verdict).alias("verdict"), F.when(_nth(9), "tax-other").otherwise("tax-own").alias("taxonomy_id"))
    labels = materialize(labels.unionByName(labels.where(_nth(6))), "labels")
    names = ("labeled", "refused", "failed", "skipped_budget", "fewshot_collision")
    report = labels.agg(F.count("*").alias("records_in"), *[F.count_if(F.col("bucket") == b).alias(b) for b in names]).withColumn("failed", F.col("failed") + 1).withColumn("taxonomy_id", F.lit("tax-own"))
    return checks.check_labels(labels, 10).unionByName(contracts.check_label_report(report, labels, 10))


def _cells(spark, sf_dir, runs: list[str]) -> DataFrame:
    """Confusion cells of a fixed mixture of the languages of questions, under several run names."""
    rows = _rows(spark, sf_dir).select(F.element_at(F.lit(list(schema.OUTCOMES)), (F.col("line_no") % 4 + 1).cast("int")).alias("human"), F.element_at(F.lit(list(schema.OUTCOMES)), (F.floor(F.col("line_no") / 3) % 4 + 1).cast("int")).alias("judge"), "record_id")
    return rows.withColumn("run", F.explode(F.lit(runs)))


def violations_agreement(spark, sf_dir):
    """Six reports over the same ratings: a sound one, and five with one break each."""
    rated = materialize(_cells(spark, sf_dir, ["sound", "kappa", "count", "class", "same", "lost"]), "rated")
    cells = materialize(rated.groupBy("run", "human", "judge").agg(F.count("*").alias("n")), "cells")
    one = agreement.global_kappa(cells.where("run = 'sound'")).select("n", "kappa")
    headline = cells.select("run").distinct().crossJoin(F.broadcast(one)).withColumn("kappa", F.col("kappa") + F.when(F.col("run") == "kappa", 0.1).otherwise(0.0)).withColumn("n", F.col("n") + F.when(F.col("run") == "count", 1).otherwise(0))
    per = cells.select("run").distinct().crossJoin(F.broadcast(agreement.marginals(cells.where("run = 'sound'")))).select("run", "class", F.col("h").alias("human_n"), F.col("j").alias("judge_n"), F.when((F.col("run") == "class") & (F.col("class") == "correct"), F.col("h") + F.col("j")).otherwise(F.col("a")).alias("both_n"))
    entries = rated.where("human <> judge").select("run", "human", "judge", "record_id")
    same = F.lit("correct")
    entries = entries.unionByName(spark.createDataFrame([("same", "x")], "run string, record_id string").select("run", same.alias("human"), same.alias("judge"), "record_id"))
    lost = entries.where("run = 'lost' AND human = 'correct' AND judge = 'incorrect'").agg(F.min("record_id").alias("record_id"), F.lit("lost").alias("run"))
    return contracts.check_axis(cells, headline, per, entries.join(F.broadcast(lost), ["run", "record_id"], "left_anti"))


_REPORTS = (
    # run, judged_in, human_in, n_matched, judge_only, human_only, resamples, degenerate, lower, upper, kappa, status
    ("sound", 10, 8, 6, 4, 2, 100, 3, 0.1, 0.9, 0.5, "ok"),
    ("judged", 11, 8, 6, 4, 2, 100, 3, 0.1, 0.9, 0.5, "ok"),
    ("human", 10, 9, 6, 4, 2, 100, 3, 0.1, 0.9, 0.5, "ok"),
    ("none left", 10, 8, 6, 4, 2, 100, 100, 0.1, 0.9, 0.5, "ok"),
    ("all left", 10, 8, 6, 4, 2, 100, 100, None, None, 0.5, "ok"),
    ("one bound", 10, 8, 6, 4, 2, 100, 3, 0.1, None, 0.5, "ok"),
    ("crossed", 10, 8, 6, 4, 2, 100, 3, 0.9, 0.1, 0.5, "ok"),
    ("too high", 10, 8, 6, 4, 2, 100, 3, 0.1, 1.5, 0.5, "ok"),
    ("many", 10, 8, 6, 4, 2, 100, 101, 0.1, 0.9, 0.5, "ok"),
    ("no value", 10, 8, 6, 4, 2, 100, 3, 0.1, 0.9, None, "ok"),
    ("value", 10, 8, 6, 4, 2, 100, 3, 0.1, 0.9, 0.5, "absent"),
    ("status", 10, 8, 6, 4, 2, 100, 3, 0.1, 0.9, None, "fine"),
)


def violations_reports(spark, sf_dir):
    """Ledgers, intervals and statuses that contradict themselves."""
    rows = spark.createDataFrame(_REPORTS, "run string, judged_in long, human_in long, n_matched long, judge_only long, human_only long, resamples long, degenerate long, lower double, upper double, kappa double, status string")
    return contracts.check_ledger(rows).unionByName(contracts.check_interval(rows)).unionByName(contracts.check_kappa_status(rows))


def violations_ledger_ids(spark, sf_dir):
    """Records that stand in two parts of a ledger."""
    rows = _rows(spark, sf_dir).select("record_id", "line_no")
    return contracts.check_ledger_ids(rows.where(F.col("line_no") % 3 == 0), rows.where((F.col("line_no") % 3 == 1) | _nth(0)), rows.where(F.col("line_no") % 3 == 2))


def violations_calibration(spark, sf_dir):
    """A sweep whose chosen threshold isn't the best, and one with a repeated candidate."""
    sweep = spark.createDataFrame([("sound", 0.3, 0.8), ("sound", 0.7, 1.0), ("sound", 0.9, 1.0), ("worse", 0.3, 0.8), ("worse", 0.7, 1.0), ("lower tie", 0.7, 1.0), ("lower tie", 0.9, 1.0), ("twice", 0.5, 0.5), ("twice", 0.5, 0.5)], "sweep string, threshold double, f1 double")
    chosen = spark.createDataFrame([("sound", 0.9), ("worse", 0.3), ("lower tie", 0.7), ("twice", 0.5)], "sweep string, threshold double")
    return contracts.check_calibration(sweep, chosen)


def violations_order(spark, sf_dir):
    """Rows of the log in canonical order with every fiftieth put one place too late, compared over ranges."""
    rows = numbered(table(spark, sf_dir, "cluster_demo").select("source_name", "line_no", "record_id"), ["source_name", "line_no", "record_id"], "place")
    moved = rows.withColumn("place", F.when(F.col("place") % 50 == 10, F.col("place") + 1).when(F.col("place") % 50 == 11, F.col("place") - 1).otherwise(F.col("place")))
    return contracts.check_order(moved, part=700)


def violations_inputs(spark, sf_dir):
    """Whole paths and bad digests among input files."""
    names = table(spark, sf_dir, "log_sources").select("source_name", F.sha2("source_name", 256).alias("d"))
    first = F.substring("source_name", 1, 1)
    return contracts.check_names(names.select(F.when(first < "f", F.concat(F.lit("in/"), "source_name")).otherwise(F.col("source_name")).alias("name"), F.when(first > "m", F.upper("d")).otherwise(F.col("d")).alias("sha256")))


def source_mismatches(spark, sf_dir):
    """Sources that only the input digests or only the ingest report know."""
    digests = table(spark, sf_dir, "log_sources").where("source_name < 'l'").select(F.col("source_name").alias("name"))
    report = table(spark, sf_dir, "cluster_demo").where("source_name > 'b'").select("source_name")
    return contracts.unmatched_sources(digests, report)


def _manifest() -> export.Manifest:
    facts = {"ready": True, "status": "ok", "kappa": 0.7, "lower": 0.5, "upper": 0.9, "same_instrument": True, "labels_sha256": "a" * 64}
    decision = export.evaluate_gate({k: facts[k] for k in ("status", "kappa", "lower", "upper")}, ready=True, same_instrument=True, labels_sha256="a" * 64)
    inputs = (("few_shot_store", "shots.jsonl", "b" * 64), ("human_labels", "labels.jsonl", "a" * 64), ("source_log", "log.jsonl", "c" * 64))
    prints = (("labels", "j"), ("agreement", "j"), ("labels_taxonomy", "t"), ("agreement_taxonomy", "t"))
    settings = (("min_export_kappa", 0.6), ("seed", 1750), ("near_dup_threshold", 0.92))
    return export.Manifest(1750, 64, 1, 3, 4, 56, 56, 50, 49, 2, 47, "d" * 64, inputs, settings, decision, (("seed", 1750), ("near_dup_threshold", 0.92)), prints, ("log.jsonl",), tuple(sorted(facts.items())))


def manifest_violations(spark, sf_dir):
    """(case, rule): what coherent() says of a manifest with one planted break each; the sound one is in no row."""
    m = _manifest()
    d = m.decision
    cases = {
        "sound": m,
        "dedup": replace(m, exact_dropped=4),
        "clusters": replace(m, clustered=55),
        "funnel": replace(m, sampled=60),
        "export": replace(m, exported=46),
        "digest": replace(m, golden_sha256="D" * 64),
        "path": replace(m, inputs=(("few_shot_store", "shots.jsonl", "b" * 64), ("human_labels", "x/labels.jsonl", "a" * 64), ("source_log", "log.jsonl", "c" * 64))),
        "role": replace(m, inputs=(*m.inputs[:2], ("other", "log.jsonl", "c" * 64)), sources=()),
        "two labels": replace(m, inputs=(m.inputs[0], m.inputs[1], ("human_labels", "more.jsonl", "e" * 64), m.inputs[2])),
        "source": replace(m, sources=("log.jsonl", "more.jsonl")),
        "knob": replace(m, echoes=(("seed", 1751),)),
        "judge": replace(m, fingerprints=(("labels", "j"), ("agreement", "k"), ("labels_taxonomy", "t"), ("agreement_taxonomy", "t"))),
        "verdict": replace(m, decision=replace(d, verdict="blocked"), facts=()),
        "override": replace(m, decision=replace(d, override="why not"), facts=()),
        "straddle": replace(m, decision=replace(d, straddles=False), facts=()),
        "gate": replace(m, facts=tuple(sorted((dict(m.facts) | {"kappa": 0.8}).items()))),
    }
    return spark.createDataFrame([(case, rule) for case, x in cases.items() for rule in x.coherent()], "case string, rule string")


def gate_decisions(spark, sf_dir):
    """The gate over a grid of facts: every combination of flags, kappas and overrides."""
    values = [("ok", 0.6, 0.5), ("ok", 0.599999, 0.2), ("ok", 0.9, 0.7), ("absent", None, None), ("insufficient_support", 0.8, 0.7)]
    bindings = [("a" * 64, None), ("a" * 64, "agreed"), (None, None)]
    grid = [(r, i, *v, *b) for r, i, v, b in product((True, False), (True, False), values, bindings)]
    out = export.gate_table(spark.createDataFrame(grid, "ready boolean, same_instrument boolean, status string, kappa double, lower double, labels_sha256 string, override string"))
    return out.select("ready", "same_instrument", "status", "kappa", F.col("labels_sha256").isNotNull().alias("bound"), F.coalesce("override", F.lit("")).alias("override"), F.concat_ws(",", "failed").alias("failed"), "verdict", "straddles")


QUERIES = {f.__name__: f for f in (
    violations_records, violations_lines, violations_ingest, violations_dedup, violations_clusters, violations_partition, violations_quotas, violations_labels, violations_agreement, violations_reports,
    violations_ledger_ids, violations_calibration, violations_order, violations_inputs, source_mismatches, manifest_violations, gate_decisions,
)}


def _values(columns: str, rows: list[tuple[str, ...]]) -> str:
    return "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in r) + ")" for r in rows) + f") v({columns})"


_NEAR = "n AS (SELECT n, 't' || n AS d, (n % 100) / 100.0 AS s FROM (SELECT (no_a + 1) // 2 AS n FROM neardup_pairs)), nf AS (SELECT *, (s < 0.5) <> (n % 10 = 8) AS c FROM n)"
_PLANTED = "'record' AS entity, 'id is its content''s' AS rule"
SQL = {
    "violations_records": f"""WITH {_R} SELECT {_PLANTED}, 'rec-x' || line_no AS detail FROM r WHERE line_no % 50 = 1
UNION ALL SELECT 'record', 'source is a base name', 'rec-' || substr(sha256(concat_ws(chr(31), 'generic_jsonl', '/tmp/' || source_name, line_no::VARCHAR, q, a)), 1, 16) FROM r WHERE line_no % 50 = 2
UNION ALL SELECT 'record', 'both sides have text', 'rec-' || substr(sha256(concat_ws(chr(31), 'generic_jsonl', source_name, line_no::VARCHAR, q, ' ' || chr(9) || ' ')), 1, 16) FROM r WHERE line_no % 50 = 3
UNION ALL SELECT 'record', 'record_id unique', 'rec-' || substr(sha256(concat_ws(chr(31), 'generic_jsonl', source_name, line_no::VARCHAR, q, a)), 1, 16) FROM r WHERE line_no % 50 = 4""",
    "violations_lines": "SELECT 'line' AS entity, 'text or error' AS rule, concat_ws(':', source_name, line_no::VARCHAR) AS detail FROM generic_demo WHERE (raw IS NOT NULL AND line_no % 7 = 1) OR (raw IS NULL AND line_no % 7 = 2)",
    "violations_ingest": """WITH s AS (SELECT source_name, row_number() OVER (ORDER BY source_name NULLS FIRST) - 1 AS k FROM (SELECT DISTINCT source_name FROM cluster_demo))
SELECT 'ingest' AS entity, CASE k % 5 WHEN 0 THEN 'buckets add up' WHEN 1 THEN 'reject reasons add up' WHEN 2 THEN 'skip reasons add up' ELSE 'samples within rejected' END AS rule, source_name AS detail FROM s WHERE k % 5 < 4""",
    "violations_dedup": f"""WITH {_R}, f AS (SELECT h, arg_min(record_id, {{'s': source_name, 'l': line_no, 'r': record_id}}) AS kept FROM r GROUP BY h), m AS (SELECT min(kept) AS f FROM f), {_NEAR}
SELECT * FROM (SELECT 'dedup' AS entity, 'counts add up' AS rule, (SELECT count(*) FROM r)::VARCHAR AS detail UNION ALL SELECT 'dedup', 'dropped and kept', f FROM m UNION ALL SELECT 'dedup', 'survivor isn''t kept', 'gone-2' UNION ALL SELECT 'dedup', 'drops itself', f FROM m
UNION ALL SELECT 'dedup', 'dropped unique', 'gone-1' UNION ALL SELECT 'exact entry', 'hash is sha256', 'gone-1' UNION ALL SELECT 'exact entry', 'drops itself', f FROM m UNION ALL SELECT 'near entry', 'chain flag', d FROM nf WHERE n % 10 = 8 UNION ALL SELECT 'dedup', 'near entries counted', (SELECT count(*) FROM n)::VARCHAR)""",
    "violations_clusters": f"""WITH {_R}, g AS (SELECT source_name AS s, line_no % 40 AS m, list_sort(list(record_id)) AS ids FROM r GROUP BY ALL HAVING count(*) >= 2)
SELECT 'cluster' AS entity, 'members sorted and unique' AS rule, 'cl-' || substr(sha256(array_to_string(ids, chr(31))), 1, 12) AS detail FROM g WHERE m = 1
UNION ALL SELECT 'cluster', 'id is its members''', ids[1] FROM g WHERE m = 3 UNION ALL SELECT 'cluster', 'member unique', ids[1] FROM g WHERE m = 4""",
    "violations_partition": f"WITH {_R} SELECT 'clusters' AS entity, 'no cluster' AS rule, record_id AS detail FROM r WHERE line_no % 50 IN (1, 2) UNION ALL SELECT 'clusters', 'unknown record', 'new-' || record_id FROM r WHERE line_no % 50 = 2 UNION ALL SELECT 'clusters', 'id unique', record_id FROM r WHERE line_no % 50 = 3",
    "violations_quotas": f"WITH {_R} SELECT 'sampling' AS entity, 'quota within stratum' AS rule, stratum AS detail FROM r WHERE stratum = '' GROUP BY stratum UNION ALL SELECT 'sampling', 'quotas add up', (count(*) + (count(*) FILTER (stratum = '') > 0)::INT)::VARCHAR FROM r",
    "violations_labels": f"""WITH {_R}, l AS (SELECT record_id, line_no, CASE WHEN line_no % 50 = 7 THEN 'lost' ELSE ['labeled', 'refused', 'failed', 'skipped_budget', 'fewshot_collision'][line_no % 5 + 1] END AS b, line_no % 5 = 0 OR line_no % 50 = 8 AS v FROM r), e AS (SELECT * FROM l UNION ALL SELECT * FROM l WHERE line_no % 50 = 6)
SELECT 'labels' AS entity, 'known bucket' AS rule, record_id AS detail FROM e WHERE b = 'lost' UNION ALL SELECT 'labels', 'verdict where labelled', record_id FROM e WHERE (b = 'labeled') <> v UNION ALL SELECT 'labels', 'within budget', (count(*) FILTER (b IN ('labeled', 'refused', 'failed')))::VARCHAR FROM e
UNION ALL SELECT 'labels', 'record_id unique', record_id FROM l WHERE line_no % 50 = 6 UNION ALL SELECT 'labeling', 'buckets add up', count(*)::VARCHAR FROM e HAVING count(*) <> count(*) FILTER (b <> 'lost') + 1 UNION ALL SELECT 'labeling', 'rows fit the report', count(*)::VARCHAR FROM e
UNION ALL SELECT 'labeling', 'within budget', (count(*) FILTER (b = 'labeled'))::VARCHAR FROM e UNION ALL SELECT 'labeling', 'one taxonomy', record_id FROM l WHERE line_no % 50 = 9""",
    "violations_agreement": _values("entity, rule, detail", [("axis", "kappa is its cells'", "kappa"), ("axis", "n is its cells'", "count"), ("axis", "class counts are its cells'", "class:correct"), ("axis", "diagonal within marginals", "class:correct"), ("axis", "an entry disagrees", "same:x"), ("axis", "as many entries as the cell", "lost:correct:incorrect")]),
    "violations_reports": _values("entity, rule, detail", [("ledger", "judged adds up", "judged"), ("ledger", "human adds up", "human"), ("interval", "bounds unless all degenerate", "none left"), ("interval", "bounds unless all degenerate", "one bound"), ("interval", "bounds in order", "crossed"), ("interval", "bounds in order", "too high"), ("interval", "degenerate within resamples", "many"), ("kappa", "value where ok", "no value"), ("kappa", "value where ok", "value"), ("kappa", "known status", "status")]),
    "violations_ledger_ids": f"WITH {_R} SELECT 'ledger' AS entity, 'record_id unique' AS rule, record_id AS detail FROM r WHERE line_no % 50 = 0 AND line_no % 3 <> 1",
    "violations_calibration": _values("entity, rule, detail", [("calibration", "chosen is the best", "worse"), ("calibration", "chosen is the best", "lower tie"), ("calibration", "candidates distinct", "twice")]),
    "violations_order": "WITH p AS (SELECT record_id, row_number() OVER (ORDER BY source_name NULLS FIRST, line_no, record_id) - 1 AS k, count(*) OVER () AS n FROM cluster_demo) SELECT 'order' AS entity, 'strictly ascending' AS rule, record_id AS detail FROM p WHERE k % 50 = 10 AND k + 1 < n",
    "violations_inputs": "SELECT 'input' AS entity, 'name is a base name' AS rule, 'in/' || source_name AS detail FROM log_sources WHERE substr(source_name, 1, 1) < 'f' UNION ALL SELECT 'input', 'digest is sha256', source_name FROM log_sources WHERE substr(source_name, 1, 1) > 'm'",
    "source_mismatches": "WITH d AS (SELECT source_name FROM log_sources WHERE source_name < 'l'), r AS (SELECT DISTINCT source_name FROM cluster_demo WHERE source_name > 'b') SELECT coalesce(d.source_name, r.source_name) AS source_name, CASE WHEN r.source_name IS NULL THEN 'digest' ELSE 'report' END AS side FROM d FULL JOIN r ON d.source_name = r.source_name WHERE d.source_name IS NULL OR r.source_name IS NULL",
    "manifest_violations": _values('"case", rule', [("dedup", "dedup counts"), ("clusters", "clustering input"), ("funnel", "funnel order"), ("export", "export counts"), ("digest", "golden digest"), ("path", "input files"), ("role", "input roles"), ("two labels", "one file a role"), ("source", "sources of the ingest report"), ("knob", "knob echoes"), ("judge", "fingerprint chain"), ("verdict", "exported although blocked"), ("verdict", "verdict follows from checks"), ("override", "override covers the threshold only"), ("straddle", "straddle follows from the interval"), ("gate", "gate recomputed")]),
    "gate_decisions": """WITH f AS (SELECT unnest([true, false]) AS f), v AS (SELECT * FROM (VALUES ('ok', 0.6::DOUBLE, 0.5::DOUBLE), ('ok', 0.599999, 0.2), ('ok', 0.9, 0.7), ('absent', NULL, NULL), ('insufficient_support', 0.8, 0.7)) t(status, kappa, lower)), o AS (SELECT * FROM (VALUES (true, ''), (true, 'agreed'), (false, '')) t(bound, override)),
g AS (SELECT a.f AS ready, b.f AS same_instrument, status, kappa, lower, bound, override, status = 'ok' AND coalesce(kappa >= 0.6, false) AS high FROM f a, f b, v, o), h AS (SELECT *, concat_ws(',', CASE WHEN NOT ready THEN 'headline_ready' END, CASE WHEN status <> 'ok' THEN 'headline_status' END, CASE WHEN NOT same_instrument THEN 'instrument_binding' END, CASE WHEN NOT bound THEN 'ground_truth_bound' END, CASE WHEN NOT high THEN 'kappa_threshold' END) AS failed FROM g)
SELECT ready, same_instrument, status, kappa, bound, override, failed, CASE WHEN failed = '' THEN 'passed' WHEN failed = 'kappa_threshold' AND override <> '' THEN 'passed_with_override' ELSE 'blocked' END AS verdict, high AND coalesce(lower < 0.6, false) AS straddles FROM h""",
}
