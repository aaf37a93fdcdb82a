"""Tolerant line sources: every physical line lands in exactly one counted bucket.

Files are split at line feeds after decoding line by line; parsing is a VARIANT column and one chained CASE, so the
whole ingest is a projection that Catalyst can prune.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymill import schema
from tallymill.functions.redact import iso_timestamp_ok, sanitize, sanitize_col

MAX_DETAIL = 200
MAX_SAMPLES = 20
# Payload keys of the two sides of an exchange, by preference.
INPUT_KEYS = ("input", "prompt", "task", "question")
OUTPUT_KEYS = ("output", "response", "content", "answer", "result")


def split_lines(raw: bytes) -> list[tuple[int, str | None, str | None]]:
    """(line_no, text, decode_error) of a file's bytes: one of the two is null; an empty tail is no line."""
    chunks = raw.split(b"\n")
    if chunks and not chunks[-1]:
        chunks.pop()
    out = []
    for n, chunk in enumerate(chunks, 1):
        try:
            out.append((n, chunk.removesuffix(b"\r").decode("utf-8"), None))
        except UnicodeDecodeError as e:
            out.append((n, None, str(e)))
    return out


def read_lines(spark: SparkSession, path: str, source_name: str | None = None) -> DataFrame:
    """(source_name, line_no, text, decode_error) of the files at path; names are base names, never whole paths."""
    files = spark.read.format("binaryFile").load(path)

    def run(batches):
        for b in batches:
            for file, raw in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                got = split_lines(raw)
                name = source_name or file.rsplit("/", 1)[-1]
                for k in range(0, len(got), 10_000):
                    part = got[k : k + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(part), pa.string()), pa.array([p[0] for p in part], pa.int64()), *(pa.array([p[i] for p in part], pa.string()) for i in (1, 2))],
                        names=schema.LINE.fieldNames(),
                    )

    return files.select("path", "content").mapInArrow(run, schema.LINE)


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(name, sha256) of the exact bytes of the files at path."""
    return spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("sha256"))


@dataclass(frozen=True)
class Mapping:
    """Where a generic JSON source keeps what; keys are dot paths."""

    input_key: str
    output_key: str
    timestamp_key: str | None = None
    id_key: str | None = None
    task_key: str | None = None
    metadata_keys: tuple[str, ...] = field(default=())


def _path(dotted: str) -> str:
    return "$" + "".join(f"['{p}']" for p in dotted.split("."))


def _variant(v: Column, dotted: str) -> Column:
    return F.try_variant_get(v, _path(dotted), "variant")


def _scalar_text(v: Column) -> Column:
    """Text of a scalar in its usual spelling (True, False for booleans); null for null, arrays and objects."""
    kind = F.schema_of_variant(v)
    return (
        F.when(v.isNull() | F.is_variant_null(v), None)
        .when(kind == "BOOLEAN", F.initcap(F.try_variant_get(v, "$", "string")))
        .when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), None)
        .otherwise(F.try_variant_get(v, "$", "string"))
    )


def _clean(text: Column) -> Column:
    """Sanitized text, null where nothing but white space is left."""
    clean = sanitize_col(text)
    return F.when(clean.rlike(r"(?U)\S"), clean)


def parse_generic(lines: DataFrame, mapping: Mapping, kind: str = "generic_jsonl") -> DataFrame:
    """One row per line: bucket, reason and, where normalized, the record.

    Buckets, first match first: invalid_encoding, blank_line, invalid_json, schema_mismatch (no object), missing_field,
    no_exchange, normalized. A timestamp that isn't ISO 8601 text keeps the row and sets timestamp_unparsed.
    """
    v = F.try_parse_json("text")
    parsed = lines.withColumn("__v", v).withColumn("__kind", F.schema_of_variant("__v"))
    got = parsed.withColumn("__q", _variant(F.col("__v"), mapping.input_key)).withColumn("__a", _variant(F.col("__v"), mapping.output_key))
    is_object = F.col("__kind").startswith("OBJECT")
    got = got.withColumn("__in", F.when(is_object, _clean(_scalar_text(F.col("__q"))))).withColumn("__out", F.when(is_object, _clean(_scalar_text(F.col("__a")))))
    bucket = (
        F.when(F.col("text").isNull(), "invalid_encoding")
        .when(~F.col("text").rlike(r"(?U)[^\s\x1c-\x1f]"), "blank_line")
        .when(F.col("__v").isNull(), "invalid_json")
        .when(~is_object, "schema_mismatch")
        .when(F.col("__q").isNull() | F.col("__a").isNull(), "missing_field")
        .when(F.col("__in").isNull() | F.col("__out").isNull(), "no_exchange")
        .otherwise("normalized")
    )
    stamp = F.try_variant_get("__v", _path(mapping.timestamp_key), "string") if mapping.timestamp_key else F.lit(None).cast("string")
    stamp_kind = F.schema_of_variant(_variant(F.col("__v"), mapping.timestamp_key)) if mapping.timestamp_key else F.lit("VOID")
    ok = (stamp_kind == "STRING") & iso_timestamp_ok(stamp)
    text_of = lambda key: sanitize_col(_scalar_text(_variant(F.col("__v"), key))) if key else F.lit(None).cast("string")
    meta = F.map_from_entries(
        F.array_sort(F.filter(F.array(*[F.struct(F.lit(k).alias("key"), text_of(k).alias("value")) for k in mapping.metadata_keys]), lambda e: e["value"].isNotNull()))
    ) if mapping.metadata_keys else F.create_map().cast("map<string,string>")
    full = got.withColumn("bucket", bucket)
    return _records(full, kind, F.when(ok, stamp), text_of(mapping.id_key), text_of(mapping.task_key), meta, F.coalesce(~ok, F.lit(True)) if mapping.timestamp_key else F.lit(False))


def parse_tracespan(lines: DataFrame, actions: tuple[str, ...] = schema.CANDIDATE_ACTIONS) -> DataFrame:
    """One row per span line; candidacy is action, then status ok, then a payload with both sides of an exchange."""
    v = F.col("__v")
    get = lambda k, t="string": F.try_variant_get(v, f"$.{k}", t)
    kind_of = lambda k: F.schema_of_variant(F.try_variant_get(v, f"$.{k}", "variant"))
    parsed = lines.withColumn("__v", F.try_parse_json("text")).withColumn("__kind", F.schema_of_variant("__v"))
    strings = F.lit(True)
    for k in ("span_id", "task_id", "agent", "action"):
        strings = strings & F.coalesce(kind_of(k) == "STRING", F.lit(False))
    for k in ("parent_span_id", "model_id"):
        strings = strings & F.coalesce(kind_of(k).isin("STRING", "VOID"), F.lit(True))
    for k in ("tokens_in", "tokens_out", "cost_usd", "latency_ms"):
        strings = strings & (F.coalesce(kind_of(k) == "VOID", F.lit(True)) | F.coalesce(get(k, "double") >= 0, F.lit(False)))
    strings = strings & F.coalesce(get("status").isin(*schema.SPAN_STATUS), F.lit(False)) & F.coalesce(kind_of("payload").startswith("OBJECT"), kind_of("payload").isNull())

    def side(keys: tuple[str, ...]) -> Column:
        texts = [F.when(kind_of(f"payload.{k}") == "STRING", get(f"payload.{k}")) for k in keys]
        return _clean(F.coalesce(*texts))  # the first present text decides, even if it is blank

    full = (
        parsed.withColumn("__in", side(INPUT_KEYS))
        .withColumn("__out", side(OUTPUT_KEYS))
        .withColumn(
            "bucket",
            F.when(F.col("text").isNull(), "invalid_encoding")
            .when(~F.col("text").rlike(r"(?U)[^\s\x1c-\x1f]"), "blank_line")
            .when(v.isNull(), "invalid_json")
            .when(~F.col("__kind").startswith("OBJECT") | ~F.coalesce(strings, F.lit(False)), "schema_mismatch")
            .when(~get("action").isin(*actions), "action_not_candidate")
            .when(get("status") != "ok", "status_not_ok")
            .when(F.col("__in").isNull() | F.col("__out").isNull(), "no_exchange")
            .otherwise("normalized"),
        )
    )
    names = ("agent", "action", "status", "model_id", "tokens_in", "tokens_out", "cost_usd", "latency_ms")
    meta = F.map_from_entries(F.array_sort(F.filter(F.array(*[F.struct(F.lit(k).alias("key"), sanitize_col(get(k)).alias("value")) for k in names]), lambda e: e["value"].isNotNull())))
    return _records(full, "tracespan", F.lit(None).cast("string"), sanitize_col(get("span_id")), sanitize_col(get("task_id")), meta, F.lit(False))


def _records(full: DataFrame, kind: str, stamp: Column, span: Column, task: Column, meta: Column, unparsed: Column) -> DataFrame:
    good = F.col("bucket") == "normalized"
    source = sanitize_col(F.col("source_name"))
    out = full.select(
        "source_name",
        "line_no",
        "bucket",
        F.when(F.col("bucket").isin(*schema.REJECT_REASONS), F.substring(sanitize_col(F.coalesce("decode_error", "text")), 1, MAX_DETAIL)).alias("detail"),
        (good & unparsed).alias("timestamp_unparsed"),
        F.when(good, source).alias("clean_source"),
        F.when(good, span).alias("span_id"),
        F.when(good, task).alias("task_id"),
        F.when(good, stamp).alias("timestamp"),
        F.when(good, F.col("__in")).alias("input_text"),
        F.when(good, F.col("__out")).alias("output_text"),
        F.when(good, meta).alias("metadata"),
    )
    return out.select(
        F.when(good, schema.record_id(F.lit(kind), F.col("clean_source"), F.col("line_no"), F.col("input_text"), F.col("output_text"))).alias("record_id"),
        F.lit(kind).alias("source_kind"),
        "source_name", "line_no", "span_id", "task_id", "timestamp", "input_text", "output_text", "metadata", "bucket", "detail", "timestamp_unparsed",
    )


def records_of(parsed: DataFrame) -> DataFrame:
    """The normalized rows, as records."""
    return parsed.where("bucket = 'normalized'").select(*schema.RECORD.fieldNames())


def ingest_report(parsed: DataFrame) -> DataFrame:
    """Counters per source: read = normalized + rejected + skipped, with reasons and unparsed timestamps."""
    rejected, skipped = F.col("bucket").isin(*schema.REJECT_REASONS), F.col("bucket").isin(*schema.SKIP_REASONS)
    return parsed.groupBy("source_name").agg(
        F.count("*").alias("lines_read"),
        F.count_if(F.col("bucket") == "normalized").alias("normalized"),
        F.count_if(rejected).alias("rejected"),
        F.count_if(skipped).alias("skipped"),
        *[F.count_if(F.col("bucket") == r).alias(r) for r in (*schema.REJECT_REASONS, *schema.SKIP_REASONS)],
        F.count_if("timestamp_unparsed").alias("timestamps_unparsed"),
    )


def reject_samples(parsed: DataFrame, most: int = MAX_SAMPLES) -> DataFrame:
    """The first rejected lines of each source, at most `most` (a report, so its limit is the feature)."""
    from pyspark.sql import Window

    by_line = Window.partitionBy("source_name").orderBy("line_no")
    rejected = parsed.where(F.col("bucket").isin(*schema.REJECT_REASONS))
    return rejected.withColumn("k", F.row_number().over(by_line)).where(F.col("k") <= most).select("source_name", "line_no", "bucket", "detail")


class LabelFormatError(ValueError):
    """A label file that can't be taken as it is."""


def _strict(spark: SparkSession, path: str, kind: T.StructType, required: tuple[str, ...]) -> DataFrame:
    wide = T.StructType([*kind.fields, T.StructField("_bad", T.StringType())])
    rows = spark.read.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)
    missing = F.lit(False)
    for k in required:
        missing = missing | F.col(k).isNull() | (F.trim(F.col(k).cast("string")) == "")
    bad = rows.cache().where(F.col("_bad").isNotNull() | missing).select(F.coalesce("_bad", F.to_json(F.struct(*kind.fieldNames()))).alias("line")).head(1)
    if bad:
        raise LabelFormatError(f"bad or unfilled line: {sanitize(bad[0]['line'] or '')[:MAX_DETAIL]}")
    return rows.drop("_bad")


def load_labeled_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Pairs for calibration; a malformed line or an unknown label is an error."""
    pairs = _strict(spark, path, schema.PAIR, ("pair_id", "text_a", "text_b", "label"))
    if pairs.where(~F.col("label").isin("duplicate", "distinct")).head(1):
        raise LabelFormatError("label must be duplicate or distinct")
    return pairs


def load_human_labels(spark: SparkSession, path: str) -> DataFrame:
    """One rater's labels, sorted by record; refuses unfilled lines, an empty file, repeated records, mixed taxonomies."""
    labels = _strict(spark, path, schema.LABEL, ("record_id", "taxonomy_id", "task_type", "outcome"))
    check_labels(labels)
    return labels.orderBy("record_id")


def check_labels(labels: DataFrame) -> None:
    facts = labels.agg(F.count("*").alias("n"), F.countDistinct("record_id").alias("d"), F.countDistinct("taxonomy_id").alias("t"), F.count_if(~F.col("task_type").isin(*schema.TASK_TYPES) | ~F.col("outcome").isin(*schema.OUTCOMES)).alias("odd")).first()
    if not facts["n"]:
        raise LabelFormatError("no labels")
    if facts["n"] != facts["d"]:
        raise LabelFormatError("a record is labelled twice")
    if facts["t"] != 1:
        raise LabelFormatError("labels of several taxonomies")
    if facts["odd"]:
        raise LabelFormatError("a class outside the vocabulary")


def load_few_shots(spark: SparkSession, path: str) -> DataFrame:
    """Few-shot examples by id; each must carry its own content id and hold nothing that redaction would change."""
    verdict = T.StructType([T.StructField(k, T.StringType()) for k in ("task_type", "outcome", "confidence", "rationale")])
    kind = T.StructType([*(T.StructField(k, T.StringType()) for k in ("few_shot_id", "input_text", "output_text")), T.StructField("verdict", verdict), T.StructField("note", T.StringType())])
    shots = _strict(spark, path, kind, ("few_shot_id", "input_text", "output_text"))
    check_few_shots(shots)
    return shots.orderBy("few_shot_id")


def check_few_shots(shots: DataFrame) -> None:
    own = schema.few_shot_id(F.col("input_text"), F.col("output_text"), F.col("verdict.task_type"), F.col("verdict.outcome"), F.col("verdict.confidence"), F.col("verdict.rationale"))
    if shots.where(own != F.col("few_shot_id")).head(1):
        raise LabelFormatError("a few-shot id that isn't its content's")
    if shots.where((sanitize_col("input_text") != F.col("input_text")) | (sanitize_col("output_text") != F.col("output_text"))).head(1):
        raise LabelFormatError("a few-shot text that redaction would change")
    hashes = shots.select(schema.content_hash(F.col("input_text"), F.col("output_text")).alias("h"))
    if shots.groupBy("few_shot_id").count().where("count > 1").head(1) or hashes.groupBy("h").count().where("count > 1").head(1):
        raise LabelFormatError("a few-shot example twice")


def canonical_json(value: object, indent: int | None = None) -> str:
    """The one JSON spelling: sorted keys, no ASCII escapes."""
    separators = (",", ": ") if indent else (",", ":")
    return json.dumps(value, sort_keys=True, ensure_ascii=False, separators=separators, indent=indent)
