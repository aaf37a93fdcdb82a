"""Golden records, the gate before them, and the manifest that ties a run together."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill import schema
from tallymill.operators.contracts import HEX64
from tallymill.sources.jsonl import canonical_json

CHECKS = ("headline_ready", "headline_status", "instrument_binding", "ground_truth_bound", "kappa_threshold")


INPUT_ROLES = ("source_log", "few_shot_store", "human_labels")
MAX_REASON = 500


class ExportError(Exception):
    pass


class ExportInputError(ExportError):
    pass


class NothingToExport(ExportError):
    pass


class ExportBlocked(ExportError):
    def __init__(self, decision: Decision):
        super().__init__(", ".join(k for k, ok in decision.checks if not ok))
        self.decision = decision


@dataclass(frozen=True)
class Decision:
    checks: tuple[tuple[str, bool], ...]
    kappa: float | None
    ci_lower: float | None
    ci_upper: float | None
    straddles: bool
    verdict: str
    override: str | None = None

    def incoherent(self, min_kappa: float) -> list[str]:
        """What in a decision doesn't follow from its own checks."""
        failed = {k for k, ok in self.checks if not ok}
        wrong = []
        if tuple(k for k, _ in self.checks) != CHECKS:
            wrong.append("five checks in order")
        want = "passed" if not failed else "passed_with_override" if failed == {"kappa_threshold"} and self.override is not None else "blocked"
        if self.verdict != want:
            wrong.append("verdict follows from checks")
        if self.override is not None and (failed != {"kappa_threshold"} or not 1 <= len(self.override) <= MAX_REASON):
            wrong.append("override covers the threshold only")
        if self.straddles != (self.kappa is not None and self.ci_lower is not None and self.ci_lower < min_kappa <= self.kappa):
            wrong.append("straddle follows from the interval")
        if (self.kappa is None) and (self.ci_lower is not None or self.ci_upper is not None):
            wrong.append("no interval without kappa")
        return wrong


def gate_table(facts: DataFrame, min_kappa: float = 0.6) -> DataFrame:
    """facts plus (failed, verdict, straddles): the gate over many runs at once.

    facts has ready, status, kappa, lower, same_instrument, labels_sha256 and override; a null flag is a failed check. An
    override that can't be granted gives the verdict blocked.
    """
    kappa = F.when(F.col("status") == "ok", F.col("kappa"))
    passed = (F.col("ready"), F.col("status") == "ok", F.col("same_instrument"), F.col("labels_sha256").isNotNull(), kappa >= min_kappa)
    failed = F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(k)) for k, ok in zip(CHECKS, passed)]), lambda x: x.isNotNull())
    only_threshold = (F.size("failed") == 1) & F.array_contains("failed", "kappa_threshold") & F.col("override").isNotNull()
    verdict = F.when(F.size("failed") == 0, "passed").when(only_threshold, "passed_with_override").otherwise("blocked")
    return facts.withColumn("failed", failed).withColumn("verdict", verdict).withColumn("straddles", F.coalesce((F.col("lower") < min_kappa) & (kappa >= min_kappa), F.lit(False)))


def evaluate_gate(headline: dict, *, ready: bool, same_instrument: bool, labels_sha256: str | None, min_kappa: float = 0.6, override: str | None = None) -> Decision:
    """Decision from the stored headline (kappa, status, lower, upper).

    The bound itself passes. An override lifts the threshold only: with any other failed check, or none, it is an error.
    An interval that reaches below the threshold is stated and blocks nothing.
    """
    fine = headline.get("status") == "ok"
    kappa = headline.get("kappa") if fine else None
    lower, upper = (headline.get("lower"), headline.get("upper")) if kappa is not None else (None, None)
    if lower is None or upper is None:
        lower = upper = None
    passed = (ready, fine, same_instrument, labels_sha256 is not None, kappa is not None and kappa >= min_kappa)
    failed = {k for k, ok in zip(CHECKS, passed) if not ok}
    if override is not None and failed != {"kappa_threshold"}:
        raise ExportInputError("nothing to override" if not failed else f"an override can't cover {sorted(failed - {'kappa_threshold'})[0]}")
    verdict = "passed" if not failed else "passed_with_override" if override is not None else "blocked"
    return Decision(tuple(zip(CHECKS, passed)), kappa, lower, upper, kappa is not None and lower is not None and lower < min_kappa <= kappa, verdict, override)


def split_contaminated(records: DataFrame, hashes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, blocked) records by whether their content hash is among `hashes` (column h): anti and semi join."""
    hashed = records.withColumn("h", schema.content_hash(F.col("input_text"), F.col("output_text")))
    h = hashes.select("h").distinct()
    return hashed.join(h, "h", "left_anti").drop("h"), hashed.join(h, "h", "left_semi").select("record_id", F.lit("fewshot_collision").alias("cause"))


def golden_records(records: DataFrame, labels: DataFrame, strata: DataFrame, hashes: DataFrame) -> DataFrame:
    """One row per exported record, in canonical order; fields stand in the order of their sorted names.

    labels has the labeled rows of run_labeling, strata (record_id, cluster_id). A labelled record without text or
    stratum is an error, as is an export without rows; records that are few-shot examples are left out.
    """
    done = labels.where("bucket = 'labeled'").select("record_id", "taxonomy_id", "model_id", "verdict")
    full = done.join(records, "record_id", "left").join(strata.select("record_id", "cluster_id"), "record_id", "left")
    lost = F.col("input_text").isNull() | F.col("cluster_id").isNull()
    full = full.withColumn("record_id", F.when(lost, F.raise_error(F.lit("a labelled record without text or stratum"))).otherwise(F.col("record_id")))
    clean, _ = split_contaminated(full, hashes)
    hash_ = schema.content_hash(F.col("input_text"), F.col("output_text"))
    provenance = F.struct(F.col("cluster_id"), hash_.alias("content_hash"), F.col("line_no"), F.col("source_kind"), F.col("source_name"), F.col("span_id"), F.col("task_id"), F.col("timestamp"))
    return clean.select(
        "input_text", F.col("verdict.confidence").alias("judge_confidence"), F.col("model_id").alias("judge_model_id"), F.col("verdict.rationale").alias("judge_rationale"), "metadata",
        F.col("verdict.outcome").alias("outcome"), "output_text", provenance.alias("provenance"), "record_id", F.col("verdict.task_type").alias("task_type"), "taxonomy_id",
    ).orderBy("provenance.source_name", "provenance.line_no", "record_id")


def golden_lines(golden: DataFrame) -> DataFrame:
    """The export's text column: one compact JSON object a record, keys sorted, nulls written."""
    return golden.select(F.to_json(F.struct(*golden.columns), {"ignoreNullFields": "false"}).alias("value"))


@dataclass(frozen=True)
class Manifest:
    """Counts and digests of one run; coherent() names what doesn't add up."""

    seed: int
    records_in: int
    id_collapsed: int
    exact_dropped: int
    near_dropped: int
    records_kept: int
    clustered: int
    sampled: int
    labeled: int
    blocked: int
    exported: int
    golden_sha256: str
    inputs: tuple[tuple[str, str, str], ...]  # role, name, sha256
    settings: tuple[tuple[str, object], ...]
    decision: Decision
    echoes: tuple[tuple[str, object], ...] = ()  # knobs as the stages report having used them
    fingerprints: tuple[tuple[str, str], ...] = ()  # judge of the labels and of the agreement, taxonomy of each
    sources: tuple[str, ...] | None = None  # names in the ingest report
    facts: tuple[tuple[str, object], ...] = ()  # what the gate was decided on

    def coherent(self) -> list[str]:
        wrong = []
        if self.records_in != self.records_kept + self.id_collapsed + self.exact_dropped + self.near_dropped:
            wrong.append("dedup counts")
        if self.clustered != self.records_kept:
            wrong.append("clustering input")
        if self.sampled > self.clustered or self.labeled > self.sampled:
            wrong.append("funnel order")
        if self.exported + self.blocked != self.labeled:
            wrong.append("export counts")
        if self.decision.verdict == "blocked" and self.exported:
            wrong.append("exported although blocked")
        if list(self.inputs) != sorted(self.inputs) or any(len(s) != 64 or "/" in n for _, n, s in self.inputs):
            wrong.append("input files")
        if any(role not in INPUT_ROLES for role, _, _ in self.inputs):
            wrong.append("input roles")
        if any(sum(r == role for r, _, _ in self.inputs) > 1 for role in ("few_shot_store", "human_labels")):
            wrong.append("one file a role")
        if self.sources is not None and {n for r, n, _ in self.inputs if r == "source_log"} != set(self.sources):
            wrong.append("sources of the ingest report")
        if not HEX64.fullmatch(self.golden_sha256):
            wrong.append("golden digest")
        known = dict(self.settings)
        if any(k not in known or known[k] != v for k, v in self.echoes):
            wrong.append("knob echoes")
        prints = dict(self.fingerprints)
        if prints and (prints.get("labels") != prints.get("agreement") or prints.get("labels_taxonomy") != prints.get("agreement_taxonomy")):
            wrong.append("fingerprint chain")
        wrong += self.decision.incoherent(known.get("min_export_kappa", 0.6))
        if self.facts:
            f = dict(self.facts)
            headline = {k: f.get(k) for k in ("status", "kappa", "lower", "upper")}
            try:
                again = evaluate_gate(headline, ready=bool(f.get("ready")), same_instrument=bool(f.get("same_instrument")), labels_sha256=f.get("labels_sha256"), min_kappa=known.get("min_export_kappa", 0.6), override=self.decision.override)
            except ExportInputError:
                again = None
            if again != self.decision:
                wrong.append("gate recomputed")
        return wrong

    def render(self, volatile: dict | None = None) -> str:
        """meta.json: what a re-run must reproduce byte for byte, and what it can't."""
        body = asdict(self)
        for k in ("inputs", "settings", "echoes", "fingerprints", "facts"):
            body[k] = [list(x) for x in body[k]]
        body["sources"] = None if self.sources is None else list(self.sources)
        return canonical_json({"deterministic": body, "volatile": volatile}, indent=2) + "\n"


def deterministic_bytes(meta_text: str) -> bytes:
    """The part of a meta.json that a re-run must reproduce, in its one spelling, to compare two runs byte by byte."""
    import json

    return canonical_json(json.loads(meta_text)["deterministic"]).encode()
