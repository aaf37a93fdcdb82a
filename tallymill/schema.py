"""Schemas, closed vocabularies and content-derived identities, as Spark types and column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEP = "\x1f"
SEED = 1750

# Closed vocabularies in declared order; matrices and the offline judge depend on the order.
SOURCE_KINDS = ("tracespan", "generic_jsonl")
SPAN_STATUS = ("ok", "error", "blocked")
REJECT_REASONS = ("invalid_encoding", "invalid_json", "schema_mismatch", "missing_field")
SKIP_REASONS = ("blank_line", "action_not_candidate", "status_not_ok", "no_exchange")
TASK_TYPES = ("factual_query", "procedural_request", "troubleshooting", "planning_or_reasoning", "other")
OUTCOMES = ("correct", "partially_correct", "incorrect", "unjudgeable")
CONFIDENCES = ("high", "medium", "low")
FAILURES = ("refusal", "parse_error", "api_error")
KAPPA_STATUS = ("ok", "undefined_single_class", "absent", "insufficient_support")
HUMAN_ONLY = ("refused", "failed", "skipped_budget", "fewshot_collision", "not_in_run")
# Actions that may carry an exchange.
CANDIDATE_ACTIONS = ("plan", "execute", "verdict")
NOISE = "noise"

LINE = T.StructType(
    [
        T.StructField("source_name", T.StringType()),
        T.StructField("line_no", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("decode_error", T.StringType()),
    ]
)
RECORD = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("source_kind", T.StringType()),
        T.StructField("source_name", T.StringType()),
        T.StructField("line_no", T.LongType()),
        T.StructField("span_id", T.StringType()),
        T.StructField("task_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("input_text", T.StringType()),
        T.StructField("output_text", T.StringType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    ]
)
LABEL = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("taxonomy_id", T.StringType()),
        T.StructField("task_type", T.StringType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("annotator", T.StringType()),
        T.StructField("labeled_on", T.DateType()),
        T.StructField("note", T.StringType()),
    ]
)
PAIR = T.StructType([T.StructField(k, T.StringType()) for k in ("pair_id", "text_a", "text_b", "label")])


def _joined(*parts: Column | str) -> Column:
    """Parts under the separator that cannot occur in sanitized text; a null part is empty."""
    return F.concat_ws(SEP, *[F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts])


def record_id(kind: Column, source: Column, line: Column, input_text: Column, output_text: Column) -> Column:
    return F.concat(F.lit("rec-"), F.substring(F.sha2(_joined(kind, source, line, input_text, output_text), 256), 1, 16))


def content_hash(input_text: Column, output_text: Column) -> Column:
    return F.sha2(_joined(input_text, output_text), 256)


def cluster_id(members: Column) -> Column:
    """Identity of a cluster from an array of its record ids."""
    return F.concat(F.lit("cl-"), F.substring(F.sha2(F.concat_ws(SEP, F.array_sort(members)), 256), 1, 12))


def few_shot_id(*parts: Column) -> Column:
    return F.concat(F.lit("fs-"), F.substring(F.sha2(_joined(*parts), 256), 1, 16))


def sample_score(seed: int, rid: Column) -> Column:
    return F.sha2(_joined(F.lit(str(seed)), rid), 256)
