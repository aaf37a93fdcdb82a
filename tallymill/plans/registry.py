"""Names of the core queries: what each runs and, where SQL can say it, the SQL to hold it against."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill import schema
from tallymill.operators import agreement, checks, cluster, dedup, export, labeling, sampling
from tallymill.operators.timestamps import found_instants
from tallymill.operators.order import numbered
from tallymill.plans import feeds, soundness
from tallymill.plans.settings import Settings
from tallymill.session import materialize, table

MAX_LABELS = 3000
SAMPLE = 500
NEAR = 0.30
RESAMPLES = Settings().bootstrap_resamples


def _exchanges(spark, sf_dir) -> DataFrame:
    """Records of the log table: rows with text on both sides."""
    rows = table(spark, sf_dir, "cluster_demo").where("trim(q) <> '' AND trim(a) <> ''")
    return rows.select("record_id", F.lit("generic_jsonl").alias("source_kind"), "source_name", "line_no", F.col("q").alias("input_text"), F.col("a").alias("output_text"), F.coalesce("lang", F.lit("")).alias("stratum"))


def _shots(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "judge_v1")


def _buckets(spark, sf_dir) -> DataFrame:
    return labeling.budget_buckets(_exchanges(spark, sf_dir), _shots(spark, sf_dir), MAX_LABELS)


def _class(column: str) -> F.Column:
    return F.regexp_replace(F.lower(F.trim(column)), "[ -]+", "_")


def _human(spark, sf_dir) -> DataFrame:
    """One usable label per record: spelling evened out, the least of several."""
    labels = table(spark, sf_dir, "annotations_synthetic").withColumn("outcome", _class("outcome"))
    return labels.where(F.col("outcome").isin(*schema.OUTCOMES)).groupBy("record_id").agg(F.min("outcome").alias("human"))


def _rated(spark, sf_dir) -> DataFrame:
    """(record_id, human, judge) of the records both rated."""
    judged = _buckets(spark, sf_dir).where("bucket = 'to_judge'").select("record_id", labeling.fake_verdict(F.col("input_text"), F.col("output_text"))["outcome"].alias("judge"))
    return judged.join(_human(spark, sf_dir), "record_id")


def p3_found(spark, sf_dir):
    return found_instants(table(spark, sf_dir, "cluster_demo"), table(spark, sf_dir, "log_sources"))


def record_ids(spark, sf_dir):
    r = _exchanges(spark, sf_dir)
    return r.select("line_no", schema.record_id(F.col("source_kind"), F.col("source_name"), F.col("line_no"), F.col("input_text"), F.col("output_text")).alias("derived_id"))


def exact_dedup_entries(spark, sf_dir):
    return dedup.exact_entries(_exchanges(spark, sf_dir))


def exact_dedup_kept(spark, sf_dir):
    return dedup.exact_kept(_exchanges(spark, sf_dir)).select("record_id", "source_name", "line_no")


def exact_dedup_groups(spark, sf_dir):
    return dedup.exact_survivors(_exchanges(spark, sf_dir))


def document_twins(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    named = docs.select(F.coalesce("source", F.lit("")).alias("source_name"), F.col("doc_id").alias("line_no"), F.col("doc_id").cast("string").alias("record_id"), F.col("text").alias("input_text"), F.lit("").alias("output_text"))
    return dedup.exact_entries(named)


def id_collapse(spark, sf_dir):
    rows = table(spark, sf_dir, "cluster_demo").select(F.col("meta.id").alias("delivery"), "source_name", "line_no", "record_id")
    return dedup.collapse_ids(rows, "delivery").select("delivery", "source_name", "line_no", "record_id", "copies")


def contamination_blocked(spark, sf_dir):
    hashes = _shots(spark, sf_dir).select(schema.content_hash(F.col("input_text"), F.col("output_text")).alias("h"))
    return export.split_contaminated(_exchanges(spark, sf_dir), hashes)[1]


def contamination_clean(spark, sf_dir):
    hashes = _shots(spark, sf_dir).select(schema.content_hash(F.col("input_text"), F.col("output_text")).alias("h"))
    return export.split_contaminated(_exchanges(spark, sf_dir), hashes)[0].select("record_id")


def stratum_quotas(spark, sf_dir):
    return sampling.stratum_quotas(_exchanges(spark, sf_dir).groupBy("stratum").agg(F.count("*").alias("size")), SAMPLE)


def stratified_sample(spark, sf_dir):
    return sampling.stratified_sample(_exchanges(spark, sf_dir), SAMPLE, schema.SEED).select("stratum", F.col("key").alias("record_id"))


def fake_judge_labels(spark, sf_dir):
    v = labeling.fake_verdict(F.col("input_text"), F.col("output_text"))
    return _exchanges(spark, sf_dir).select("record_id", v.alias("v")).select("record_id", "v.task_type", "v.outcome", "v.confidence", "v.rationale")


def label_distribution(spark, sf_dir):
    return labeling.label_distribution(fake_judge_labels(spark, sf_dir), "outcome", schema.OUTCOMES)


def budget_buckets(spark, sf_dir):
    return _buckets(spark, sf_dir).select("record_id", "bucket")


def match_accounting(spark, sf_dir):
    return agreement.match_accounting(_buckets(spark, sf_dir).where("bucket = 'to_judge'"), _human(spark, sf_dir))


def human_only_causes(spark, sf_dir):
    b = _buckets(spark, sf_dir).select("record_id", F.when(F.col("bucket") == "to_judge", "labeled").otherwise(F.col("bucket")).alias("bucket"))
    return agreement.human_only_causes(b, _human(spark, sf_dir))


def confusion_long(spark, sf_dir):
    return agreement.confusion(_rated(spark, sf_dir), schema.OUTCOMES)


def kappa_global(spark, sf_dir):
    return agreement.global_kappa(confusion_long(spark, sf_dir))


def kappa_per_class(spark, sf_dir):
    return agreement.class_kappa(confusion_long(spark, sf_dir))


def disagreements(spark, sf_dir):
    return agreement.disagreements(_rated(spark, sf_dir))


def bootstrap_ci(spark, sf_dir):
    """Interval over a resampling table written by arithmetic, so that SQL can repeat it."""
    rated = materialize(numbered(_rated(spark, sf_dir), ["record_id"]), "rated")
    return agreement.bootstrap_kappa(rated, _arithmetic_draws(spark, rated.count()))


def _arithmetic_draws(spark, n: int) -> DataFrame:
    b = spark.range(RESAMPLES).select(F.col("id").alias("b"))
    k = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))).alias("k")
    return b.select("b", k).select("b", F.pmod(F.col("b") * 7919 + F.col("k") * 104729 + F.col("b") * F.col("k") * 31, F.lit(n)).alias("i"))


def bootstrap_per_class(spark, sf_dir):
    """Intervals of every class against the rest, over the same resampling table."""
    rated = materialize(numbered(_rated(spark, sf_dir), ["record_id"]), "rated")
    return agreement.bootstrap_per_class(rated, _arithmetic_draws(spark, rated.count()), schema.OUTCOMES)


def bootstrap_seeded(spark, sf_dir):
    """The same interval over the seeded generator's draws."""
    rated = materialize(numbered(_rated(spark, sf_dir), ["record_id"]), "rated")
    return agreement.bootstrap_kappa(rated, agreement.resample_rows(spark, schema.SEED, RESAMPLES, rated.count()))


def _pairs(spark, sf_dir) -> DataFrame:
    pairs = table(spark, sf_dir, "neardup_pairs").withColumn("label", F.lower(F.trim("label")))
    return pairs.where("label IN ('duplicate', 'distinct') AND text_a IS NOT NULL AND text_b IS NOT NULL")


def calibration_sweep(spark, sf_dir):
    words = lambda c: F.array_distinct(F.split(F.lower(c), " ", -1))
    a, b = words("text_a"), words("text_b")
    return dedup.calibration_sweep(_pairs(spark, sf_dir).select((F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))).alias("similarity"), (F.col("label") == "duplicate").alias("duplicate")))


def calibration_best(spark, sf_dir):
    return dedup.best_threshold(calibration_sweep(spark, sf_dir))


def calibration_embedder(spark, sf_dir):
    """The sweep on cosines of the hashing embedder."""
    from tallymill.functions.embed import dot, embed_col

    scored = materialize(_pairs(spark, sf_dir).select(embed_col("text_a").alias("x"), embed_col("text_b").alias("y"), (F.col("label") == "duplicate").alias("duplicate")), "embedded")
    return dedup.calibration_sweep(scored.select(dot(F.col("x"), F.col("y")).alias("similarity"), "duplicate"))


def near_pairs(spark, sf_dir):
    pairs = dedup.cosine_pairs(table(spark, sf_dir, "embeddings"), NEAR, "vec_id", "embedding")
    return pairs.select("a", "b", F.round("similarity", 6).alias("similarity"))


def near_components(spark, sf_dir):
    from tallymill.operators.components import connected_components

    return connected_components(dedup.cosine_pairs(table(spark, sf_dir, "embeddings"), NEAR, "vec_id", "embedding"))


def near_entries(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("vec"))
    pairs = materialize(dedup.cosine_pairs(vectors, NEAR, "vec_id", "vec"), "near")
    return dedup.near_entries(vectors, pairs, NEAR, "vec_id", "vec")


def text_dedup_report(spark, sf_dir):
    """Whole de-duplication of both sides of the labelled pairs, as records."""
    rows = table(spark, sf_dir, "neardup_pairs")
    side = lambda n: rows.select(F.lit("pairs").alias("source_name"), F.col(f"no_{n}").alias("line_no"), F.concat_ws("-", F.lit("t"), f"no_{n}").alias("record_id"), F.col(f"text_{n}").alias("input_text"), F.lit("").alias("output_text"))
    return dedup.run_dedup(side("a").unionByName(side("b")).where("input_text IS NOT NULL"))["report"]


MAPPING = dict(input_key="q", output_key="a", timestamp_key="meta.ts", id_key="meta.id", task_key="meta.conv", metadata_keys=("channel", "lang"))


def _parsed(spark, sf_dir) -> DataFrame:
    from tallymill.sources.jsonl import Mapping, parse_generic

    lines = table(spark, sf_dir, "generic_demo").select("source_name", "line_no", F.col("raw").alias("text"), F.when(F.col("raw").isNull(), "null line").alias("decode_error"))
    return parse_generic(lines, Mapping(**MAPPING))


def ingest_buckets(spark, sf_dir):
    return _parsed(spark, sf_dir).select("source_name", "line_no", "bucket")


def ingest_report(spark, sf_dir):
    from tallymill.sources.jsonl import ingest_report

    return ingest_report(_parsed(spark, sf_dir)).select("source_name", "lines_read", "normalized", "rejected", "skipped")


def ingest_records(spark, sf_dir):
    from tallymill.sources.jsonl import records_of

    return records_of(_parsed(spark, sf_dir))


def reject_samples(spark, sf_dir):
    from tallymill.sources.jsonl import reject_samples

    return reject_samples(_parsed(spark, sf_dir))


def redaction_counts(spark, sf_dir):
    """(category, texts): how many texts of the log hold something of each category."""
    from tallymill.functions.redact import PATTERNS, sanitize_wide

    rows = table(spark, sf_dir, "cluster_demo").select(F.explode(F.array("q", "a")).alias("t")).where("t IS NOT NULL")
    clean = rows.select(sanitize_wide("t").alias("t")).agg(*[F.count_if(F.contains("t", F.lit(f"[REDACTED:{k}]"))).alias(k) for k, _ in PATTERNS])
    return clean.select(F.explode(F.array(*[F.struct(F.lit(k).alias("category"), F.col(k).alias("texts")) for k, _ in PATTERNS])).alias("c")).select("c.*")


def hdbscan_clusters(spark, sf_dir):
    labels = cluster.cluster_rows(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return cluster.cluster_ids(materialize(labels, "labels"))


def _golden(spark, sf_dir) -> DataFrame:
    records = _exchanges(spark, sf_dir).withColumns({"span_id": F.lit(None).cast("string"), "task_id": F.lit(None).cast("string"), "timestamp": F.lit(None).cast("string"), "metadata": F.create_map().cast("map<string,string>")})
    ids = schema.record_id(F.col("source_kind"), F.col("source_name"), F.col("line_no"), F.col("input_text"), F.col("output_text"))
    records = records.withColumn("record_id", ids)
    labels = labeling.run_labeling(records, _shots(spark, sf_dir), MAX_LABELS)
    hashes = _shots(spark, sf_dir).select(schema.content_hash(F.col("input_text"), F.col("output_text")).alias("h"))
    return export.golden_records(records, labels, records.select("record_id", F.concat(F.lit("lang-"), F.col("stratum")).alias("cluster_id")), hashes)


def golden_export(spark, sf_dir):
    return export.golden_lines(_golden(spark, sf_dir))


def integrity(spark, sf_dir):
    """Violations of the integrity rules over the stages above; sound data has none."""
    hashes = _shots(spark, sf_dir).select(schema.content_hash(F.col("input_text"), F.col("output_text")).alias("h"))
    entries = exact_dedup_entries(spark, sf_dir).select(F.col("dropped_record_id").alias("dropped"), F.col("kept_record_id").alias("kept"))
    report = dedup.dedup_report(_exchanges(spark, sf_dir), _exchanges(spark, sf_dir), entries, entries.limit(0).withColumn("via_chain", F.lit(False)))
    out = checks.check_golden(_golden(spark, sf_dir), hashes)
    out = out.unionByName(checks.check_dedup(report, dedup.exact_kept(_exchanges(spark, sf_dir)), entries))
    return out.unionByName(checks.check_quotas(stratum_quotas(spark, sf_dir), SAMPLE)).unionByName(checks.check_ingest(_full_report(spark, sf_dir)))


def _full_report(spark, sf_dir) -> DataFrame:
    from tallymill.sources.jsonl import ingest_report

    return ingest_report(_parsed(spark, sf_dir))


_NAMES = (
    "p3_found record_ids exact_dedup_entries exact_dedup_kept exact_dedup_groups document_twins id_collapse contamination_blocked contamination_clean "
    "stratum_quotas stratified_sample fake_judge_labels label_distribution budget_buckets match_accounting human_only_causes confusion_long kappa_global "
    "kappa_per_class disagreements bootstrap_ci bootstrap_per_class bootstrap_seeded calibration_sweep calibration_best calibration_embedder near_pairs near_components near_entries "
    "text_dedup_report ingest_buckets ingest_report ingest_records reject_samples redaction_counts hdbscan_clusters golden_export integrity"
).split()
QUERIES = {name: globals()[name] for name in _NAMES} | soundness.QUERIES | feeds.QUERIES

_R = "r AS (SELECT record_id, source_name, line_no, q, a, coalesce(lang, '') AS stratum, sha256(q || chr(31) || a) AS h FROM cluster_demo WHERE trim(q) <> '' AND trim(a) <> '')"
_FIRST = "f AS (SELECT h, arg_min(record_id, {'s': source_name, 'l': line_no, 'r': record_id}) AS kept, count(*) AS n FROM r GROUP BY h)"
_SHOT = "s AS (SELECT DISTINCT sha256(input_text || chr(31) || output_text) AS h FROM judge_v1)"
_DIGEST = "sha256('fake-judge' || chr(31) || q || chr(31) || a)"


def _pick(at: int, names: tuple[str, ...]) -> str:
    return f"list_extract([{', '.join(repr(n) for n in names)}], ('0x' || substr(d, {at}, 2))::INT % {len(names)} + 1)"


_BUCKETS = f"""{_R}, {_SHOT}, hit AS (SELECT record_id FROM r SEMI JOIN s USING (h)),
o AS (SELECT *, row_number() OVER (ORDER BY source_name, line_no, record_id) AS k FROM r WHERE record_id NOT IN (SELECT record_id FROM hit)),
b AS (SELECT record_id, q, a, CASE WHEN k <= {MAX_LABELS} THEN 'to_judge' ELSE 'skipped_budget' END AS bucket FROM o UNION ALL SELECT record_id, q, a, 'fewshot_collision' FROM r WHERE record_id IN (SELECT record_id FROM hit))"""
_CLASSES = ", ".join(repr(c) for c in schema.OUTCOMES)
_HUMAN = f"h AS (SELECT record_id, min(o) AS human FROM (SELECT record_id, regexp_replace(lower(trim(outcome)), '[ -]+', '_', 'g') AS o FROM annotations_synthetic) WHERE o IN ({_CLASSES}) GROUP BY record_id)"
_RATED = f"""{_BUCKETS}, {_HUMAN}, j AS (SELECT record_id, {_pick(3, schema.OUTCOMES)} AS judge FROM (SELECT record_id, {_DIGEST} AS d FROM b WHERE bucket = 'to_judge')),
x AS (SELECT record_id, human, judge FROM j JOIN h USING (record_id)), c AS (SELECT unnest([{_CLASSES}]) AS c),
cells AS (SELECT g.human, g.judge, coalesce(n, 0) AS n FROM (SELECT c.c AS human, d.c AS judge FROM c, c AS d) g LEFT JOIN (SELECT human, judge, count(*) AS n FROM x GROUP BY ALL) k USING (human, judge))"""
_QUOTAS = f"""{_R}, t AS (SELECT stratum, count(*) AS size FROM r GROUP BY stratum),
u AS (SELECT *, count(*) OVER () AS m, sum(size) OVER () AS n FROM t), v AS (SELECT *, least({SAMPLE}, n)::BIGINT AS k, (size - 1)::BIGINT AS w, (n - m)::BIGINT AS cap FROM u),
y AS (SELECT *, CASE WHEN cap > 0 THEN 1 + (greatest(0, k - m) * w) // cap ELSE 1 END AS base, CASE WHEN cap > 0 THEN (greatest(0, k - m) * w) % cap ELSE 0 END AS r FROM v),
z AS (SELECT *, row_number() OVER (ORDER BY r DESC, size DESC, stratum) AS e, row_number() OVER (ORDER BY size DESC, stratum) AS p, k - sum(base) OVER () AS open FROM y),
quotas AS (SELECT stratum, size::BIGINT AS size, (CASE WHEN k <= m THEN (p <= k)::INT ELSE base + (e <= open AND base < size)::INT END)::BIGINT AS quota FROM z)"""
_SWEEP = """p AS (SELECT lower(trim(label)) = 'duplicate' AS dup, list_distinct(string_split(lower(text_a), ' ')) AS x, list_distinct(string_split(lower(text_b), ' ')) AS y FROM neardup_pairs WHERE lower(trim(label)) IN ('duplicate', 'distinct') AND text_a IS NOT NULL AND text_b IS NOT NULL),
sc AS (SELECT dup, len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y)))::DOUBLE AS sim FROM p),
c AS (SELECT DISTINCT round((sim + nxt) / 2, 6) AS t FROM (SELECT sim, lead(sim) OVER (ORDER BY sim) AS nxt FROM (SELECT DISTINCT sim FROM sc)) WHERE nxt IS NOT NULL),
w AS (SELECT t, count(*) FILTER (dup AND sim >= t) AS tp, count(*) FILTER (NOT dup AND sim >= t) AS fp, count(*) FILTER (dup AND sim < t) AS fn FROM c, sc GROUP BY t),
sweep AS (SELECT t AS threshold, tp, fp, fn, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0 END, 6) AS precision, round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0 END, 6) AS recall,
round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn)::DOUBLE ELSE 0 END, 6) AS f1 FROM w)"""
_NEAR = f"""e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
pr AS (SELECT x.vec_id AS a, y.vec_id AS b, list_cosine_similarity(x.v, y.v) AS s FROM e x JOIN e y ON x.vec_id < y.vec_id WHERE list_cosine_similarity(x.v, y.v) >= {NEAR})"""
_COMPONENTS = f"""{_NEAR}, both_ways AS (SELECT a, b FROM pr UNION ALL SELECT b, a FROM pr),
reach AS (SELECT a AS node, a AS other FROM both_ways UNION SELECT node, b FROM reach JOIN both_ways ON other = a), comp AS (SELECT node, min(other) AS component FROM reach GROUP BY node)"""
_BLANK = r"regexp_replace(v, '[\p{Cf}\s]+', '', 'g')"
_LINES = f"""i AS (SELECT source_name, line_no, raw, CASE WHEN json_valid(raw) THEN raw::JSON END AS j FROM generic_demo),
k AS (SELECT source_name, line_no, raw, j, json_type(j) AS t, json_type(j, '$.q') AS tq, json_type(j, '$.a') AS ta, json_extract_string(j, '$.q') AS q, json_extract_string(j, '$.a') AS a FROM i),
bk AS (SELECT source_name, line_no, CASE WHEN raw IS NULL THEN 'invalid_encoding' WHEN trim(raw, ' ' || chr(9) || chr(10) || chr(13)) = '' THEN 'blank_line' WHEN j IS NULL THEN 'invalid_json' WHEN t <> 'OBJECT' THEN 'schema_mismatch'
WHEN tq IS NULL OR ta IS NULL THEN 'missing_field'
WHEN tq IN ('NULL', 'OBJECT', 'ARRAY') OR ta IN ('NULL', 'OBJECT', 'ARRAY') OR {_BLANK.replace('(v,', '(q,')} = '' OR {_BLANK.replace('(v,', '(a,')} = '' THEN 'no_exchange' ELSE 'normalized' END AS bucket FROM k)"""

SQL = {
    "record_ids": f"WITH {_R} SELECT line_no, 'rec-' || substr(sha256(concat_ws(chr(31), 'generic_jsonl', source_name, line_no::VARCHAR, q, a)), 1, 16) AS derived_id FROM r",
    "exact_dedup_entries": f"WITH {_R}, {_FIRST} SELECT record_id AS dropped_record_id, kept AS kept_record_id, h AS content_hash FROM r JOIN f USING (h) WHERE record_id <> kept",
    "exact_dedup_kept": f"WITH {_R}, {_FIRST} SELECT record_id, source_name, line_no FROM r JOIN f USING (h) WHERE record_id = kept",
    "exact_dedup_groups": f"WITH {_R}, {_FIRST} SELECT h AS content_hash, kept AS kept_record_id, n AS members FROM f",
    "document_twins": "WITH d AS (SELECT doc_id, coalesce(source, '') AS s, sha256(text || chr(31)) AS h FROM documents WHERE text IS NOT NULL), f AS (SELECT h, arg_min(doc_id, {'s': s, 'd': doc_id}) AS k FROM d GROUP BY h) SELECT doc_id::VARCHAR AS dropped_record_id, k::VARCHAR AS kept_record_id, h AS content_hash FROM d JOIN f USING (h) WHERE doc_id <> k",
    "id_collapse": "SELECT meta.id AS delivery, arg_min(source_name, {'s': source_name, 'l': line_no}) AS source_name, arg_min(line_no, {'s': source_name, 'l': line_no}) AS line_no, arg_min(record_id, {'s': source_name, 'l': line_no}) AS record_id, count(*) AS copies FROM cluster_demo GROUP BY meta.id",
    "contamination_blocked": f"WITH {_R}, {_SHOT} SELECT record_id, 'fewshot_collision' AS cause FROM r SEMI JOIN s USING (h)",
    "contamination_clean": f"WITH {_R}, {_SHOT} SELECT record_id FROM r ANTI JOIN s USING (h)",
    "stratum_quotas": f"WITH {_QUOTAS} SELECT * FROM quotas",
    "stratified_sample": f"WITH {_QUOTAS} SELECT stratum, record_id FROM (SELECT q.stratum, record_id, quota, row_number() OVER (PARTITION BY q.stratum ORDER BY sha256('{schema.SEED}' || chr(31) || record_id), record_id) AS i FROM r JOIN quotas q ON r.stratum = q.stratum) WHERE i <= quota",
    "fake_judge_labels": f"WITH {_R} SELECT record_id, {_pick(1, schema.TASK_TYPES)} AS task_type, {_pick(3, schema.OUTCOMES)} AS outcome, {_pick(5, schema.CONFIDENCES)} AS confidence, 'synthetic fake-judge verdict (digest ' || substr(d, 1, 8) || ') — offline demo/tests only' AS rationale FROM (SELECT record_id, {_DIGEST} AS d FROM r)",
    "label_distribution": f"WITH {_R}, v AS (SELECT {_pick(3, schema.OUTCOMES)} AS o FROM (SELECT {_DIGEST} AS d FROM r)) SELECT (p - 1)::INT AS pos, list_extract([{_CLASSES}], p) AS class, (SELECT count(*) FROM v WHERE o = list_extract([{_CLASSES}], p)) AS n FROM range(1, {len(schema.OUTCOMES) + 1}) t(p)",
    "budget_buckets": f"WITH {_BUCKETS} SELECT record_id, bucket FROM b",
    "match_accounting": f"WITH {_BUCKETS}, {_HUMAN}, j AS (SELECT record_id FROM b WHERE bucket = 'to_judge') SELECT count(j.record_id) AS judged_in, count(h.record_id) AS human_in, count(*) FILTER (j.record_id IS NOT NULL AND h.record_id IS NOT NULL) AS n_matched, count(*) FILTER (h.record_id IS NULL) AS judge_only, count(*) FILTER (j.record_id IS NULL) AS human_only FROM j FULL JOIN h ON j.record_id = h.record_id",
    "human_only_causes": f"WITH {_BUCKETS}, {_HUMAN} SELECT h.record_id, coalesce(bucket, 'not_in_run') AS cause FROM h LEFT JOIN b ON h.record_id = b.record_id WHERE coalesce(bucket, '') <> 'to_judge'",
    "confusion_long": f"WITH {_RATED} SELECT human, judge, n FROM cells",
    "kappa_global": f"""WITH {_RATED}, r1 AS (SELECT human AS c, sum(n) AS r FROM cells GROUP BY 1), c1 AS (SELECT judge AS c, sum(n) AS k FROM cells GROUP BY 1), s1 AS (SELECT sum(r * k)::DOUBLE AS s FROM r1 JOIN c1 USING (c)),
t1 AS (SELECT sum(n)::DOUBLE AS n, sum(CASE WHEN human = judge THEN n ELSE 0 END)::DOUBLE AS d FROM cells) SELECT n::BIGINT AS n, round(d / n, 6) AS po, round(s / (n * n), 6) AS pe, round((n * d - s) / nullif(n * n - s, 0), 6) AS kappa, CASE WHEN n = 0 THEN 'absent' WHEN n * n = s THEN 'undefined_single_class' ELSE 'ok' END AS status FROM t1, s1""",
    "kappa_per_class": f"""WITH {_RATED}, r1 AS (SELECT human AS class, sum(n) AS h, sum(CASE WHEN human = judge THEN n ELSE 0 END) AS a FROM cells GROUP BY 1), c1 AS (SELECT judge AS class, sum(n) AS j FROM cells GROUP BY 1), t1 AS (SELECT sum(n) AS n FROM cells),
u AS (SELECT class, h::DOUBLE AS h, j::DOUBLE AS j, a::DOUBLE AS a, n::DOUBLE AS n FROM r1 JOIN c1 USING (class), t1), v AS (SELECT *, n - h - j + 2 * a AS g, h * j + (n - h) * (n - j) AS s, CASE WHEN h + j = 0 THEN 'absent' WHEN a = n THEN 'undefined_single_class' WHEN h + j < 5 THEN 'insufficient_support' ELSE 'ok' END AS status FROM u)
SELECT class, h::BIGINT AS human_n, j::BIGINT AS judge_n, a::BIGINT AS both_n, status, CASE WHEN status = 'ok' THEN round((n * g - s) / nullif(n * n - s, 0), 6) END AS kappa FROM v""",
    "disagreements": f"WITH {_RATED} SELECT human, judge, record_id FROM x WHERE human <> judge",
    "bootstrap_ci": f"""WITH {_RATED}, ri AS (SELECT human, judge, row_number() OVER (ORDER BY record_id) - 1 AS i FROM x), nn AS (SELECT count(*) AS n FROM ri),
dr AS (SELECT b.range AS b, (b.range * 7919 + k.range * 104729 + b.range * k.range * 31) % n AS i FROM range({RESAMPLES}) b, nn, range((SELECT n FROM nn)) k), ce AS (SELECT b, human, judge, count(*) AS n FROM dr JOIN ri USING (i) GROUP BY ALL),
rr AS (SELECT b, human AS c, sum(n) AS r FROM ce GROUP BY ALL), cc AS (SELECT b, judge AS c, sum(n) AS k FROM ce GROUP BY ALL), ss AS (SELECT b, sum(r * coalesce(k, 0))::DOUBLE AS s FROM rr LEFT JOIN cc USING (b, c) GROUP BY b),
tt AS (SELECT b, sum(n)::DOUBLE AS n, sum(CASE WHEN human = judge THEN n ELSE 0 END)::DOUBLE AS d FROM ce GROUP BY b), kk AS (SELECT (n * d - s) / nullif(n * n - s, 0) AS k FROM tt JOIN ss USING (b))
SELECT count(*) AS resamples, count(*) FILTER (k IS NULL) AS degenerate, round(quantile_cont(k, 0.025), 6) AS lower, round(quantile_cont(k, 0.975), 6) AS upper FROM kk""",
    "bootstrap_per_class": f"""WITH {_RATED}, ri AS (SELECT human, judge, row_number() OVER (ORDER BY record_id) - 1 AS i FROM x), nn AS (SELECT count(*) AS n FROM ri),
dr AS (SELECT b.range AS b, (b.range * 7919 + k.range * 104729 + b.range * k.range * 31) % n AS i FROM range({RESAMPLES}) b, nn, range((SELECT n FROM nn)) k), ce AS (SELECT b, human, judge, count(*) AS n FROM dr JOIN ri USING (i) GROUP BY ALL),
pc AS (SELECT b, c.c AS class, sum(n)::DOUBLE AS n, sum(n) FILTER (human = c.c)::DOUBLE AS h, sum(n) FILTER (judge = c.c)::DOUBLE AS j, sum(n) FILTER (human = c.c AND judge = c.c)::DOUBLE AS a FROM ce, c GROUP BY ALL),
pk AS (SELECT class, n, coalesce(h, 0) AS h, coalesce(j, 0) AS j, coalesce(a, 0) AS a FROM pc), kk AS (SELECT class, (n * (n - h - j + 2 * a) - (h * j + (n - h) * (n - j))) / nullif(n * n - (h * j + (n - h) * (n - j)), 0) AS k FROM pk)
SELECT class, count(*) AS resamples, count(*) FILTER (k IS NULL) AS degenerate, round(quantile_cont(k, 0.025), 6) AS lower, round(quantile_cont(k, 0.975), 6) AS upper FROM kk GROUP BY class""",
    "calibration_sweep": f"WITH {_SWEEP} SELECT * FROM sweep",
    "calibration_best": f"WITH {_SWEEP} SELECT * FROM sweep ORDER BY f1 DESC, threshold DESC LIMIT 1",
    "near_pairs": f"WITH {_NEAR} SELECT a, b, round(s, 6) AS similarity FROM pr",
    "near_components": f"WITH RECURSIVE {_COMPONENTS} SELECT node, component FROM comp",
    "near_entries": f"WITH RECURSIVE {_COMPONENTS}, sim AS (SELECT node AS dropped, component AS kept, list_cosine_similarity(x.v, y.v) AS s FROM comp JOIN e x ON node = x.vec_id JOIN e y ON component = y.vec_id WHERE node <> component) SELECT dropped, kept, round(s, 6) AS similarity, s < {NEAR} AS via_chain FROM sim",
    "ingest_buckets": f"WITH {_LINES} SELECT source_name, line_no, bucket FROM bk",
    "ingest_report": f"WITH {_LINES} SELECT source_name, count(*) AS lines_read, count(*) FILTER (bucket = 'normalized') AS normalized, count(*) FILTER (bucket IN ('invalid_encoding', 'invalid_json', 'schema_mismatch', 'missing_field')) AS rejected, count(*) FILTER (bucket IN ('blank_line', 'no_exchange')) AS skipped FROM bk GROUP BY source_name",
    "ingest_reasons": f"WITH {_LINES} SELECT source_name, bucket AS reason, count(*) AS n FROM bk WHERE bucket <> 'normalized' GROUP BY ALL",
    "integrity": "SELECT '' AS entity, '' AS rule, '' AS detail WHERE false",
} | soundness.SQL | feeds.SQL
