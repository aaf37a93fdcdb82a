"""Contracts of the reports: each gives (entity, rule, detail) rows as a query, and a sound report gives none."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymill import schema
from tallymill.operators.checks import _rule, _twice

HEX64 = re.compile(r"[0-9a-f]{64}")


def check_lines(lines: DataFrame) -> DataFrame:
    """A source line has text or a decoding error, never both or neither."""
    return _rule(lines, F.col("text").isNull() == F.col("decode_error").isNull(), "line", "text or error", F.concat_ws(":", "source_name", "line_no"))


def check_samples(report: DataFrame, samples: DataFrame, most: int = 20) -> DataFrame:
    """No more samples of rejected lines than rejected lines, and never more than `most`."""
    got = samples.groupBy("source_name").agg(F.count("*").alias("k")).join(report.select("source_name", "rejected"), "source_name", "left")
    return _rule(got, F.col("k") > F.least(F.lit(most), F.coalesce("rejected", F.lit(0))), "ingest", "samples within rejected", F.col("source_name"))


def check_entries(entries: DataFrame, entity: str = "exact entry") -> DataFrame:
    """entries has (dropped, kept, content_hash): a hash is 64 lower-case hex digits, nobody drops itself."""
    return _rule(entries, ~F.col("content_hash").rlike("^[0-9a-f]{64}$"), entity, "hash is sha256", F.col("dropped")).unionByName(
        _rule(entries, F.col("dropped") == F.col("kept"), entity, "drops itself", F.col("dropped"))
    )


def check_chain_flags(report: DataFrame, near: DataFrame, threshold: float) -> DataFrame:
    """near entries are flagged as reached by a chain exactly where their similarity is below the threshold, and are counted so."""
    counted = near.agg(F.count("*").alias("n"), F.count_if("via_chain").alias("c"))
    return _rule(near, F.col("via_chain") != (F.col("similarity") < threshold), "near entry", "chain flag", F.col("dropped")).unionByName(
        _rule(report.crossJoin(counted), (F.col("near_dropped") != F.col("n")) | (F.col("chain_dropped") != F.col("c")), "dedup", "near entries counted", F.col("n"))
    )


def check_calibration(sweep: DataFrame, chosen: DataFrame, by: str = "sweep") -> DataFrame:
    """Candidates of a sweep are distinct; the chosen threshold has the best F1, and is the highest of several."""
    best = sweep.groupBy(by).agg(F.max_by("threshold", F.struct("f1", "threshold")).alias("best"))
    twice = sweep.groupBy(by, "threshold").agg(F.count("*").alias("k")).where("k > 1").select(by).distinct()
    return _rule(chosen.join(best, by, "left"), F.col("threshold") != F.col("best"), "calibration", "chosen is the best", F.col(by)).unionByName(
        twice.select(F.lit("calibration").alias("entity"), F.lit("candidates distinct").alias("rule"), F.col(by).cast("string").alias("detail"))
    )


def check_clusters(clusters: DataFrame) -> DataFrame:
    """clusters has (cluster_id, members): members sorted and unique, id their content's, no record in two clusters."""
    m = F.col("members")
    placed = clusters.select(F.explode(F.array_distinct(m)).alias("member"))
    return (
        _rule(clusters, m != F.array_sort(F.array_distinct(m)), "cluster", "members sorted and unique", F.col("cluster_id"))
        .unionByName(_rule(clusters, F.col("cluster_id") != schema.cluster_id(m), "cluster", "id is its members'", F.array_min(m)))
        .unionByName(_twice(placed, "member", "cluster"))
    )


def check_order(rows: DataFrame, by: tuple[str, ...] = ("source_name", "line_no", "record_id"), place: str = "place", part: int = 1 << 16) -> DataFrame:
    """Rows numbered 0, 1, 2 … by `place` ascend strictly by `by`.

    Places are compared within ranges of `part` places, and the first row of every range with the last of the range
    before, so that no task sees more than one range.
    """
    key = F.struct(*by)
    ranged = rows.select(F.col(place).alias("p"), key.alias("k"), F.col(by[-1]).cast("string").alias("d")).withColumn("r", F.floor(F.col("p") / part))
    inside = ranged.withColumn("before", F.lag("k").over(Window.partitionBy("r").orderBy("p")))
    heads = ranged.groupBy("r").agg(F.min_by(F.struct("k", "d"), "p").alias("h"), F.max_by("k", "p").alias("t"))
    ends = heads.select((F.col("r") + 1).alias("r"), F.col("t").alias("before"))
    across = heads.join(ends, "r").select(F.col("h.k").alias("k"), F.col("h.d").alias("d"), "before")
    broken = inside.where("before IS NOT NULL").select("k", "d", "before").unionByName(across)
    return _rule(broken, F.col("before") >= F.col("k"), "order", "strictly ascending", F.col("d"))


def check_label_report(report: DataFrame, labels: DataFrame, max_labels: int) -> DataFrame:
    """report has one row (records_in, labeled, refused, failed, skipped_budget, fewshot_collision, taxonomy_id): buckets add up, fit the rows and the taxonomy."""
    names = ("labeled", "refused", "failed", "skipped_budget", "fewshot_collision")
    had = labels.agg(*[F.count_if(F.col("bucket") == b).alias("has_" + b) for b in names])
    both = report.crossJoin(had)
    differ = F.lit(False)
    for b in names:
        differ = differ | (F.col(b) != F.col("has_" + b))
    other = labels.join(report.select(F.col("taxonomy_id").alias("t")), F.col("taxonomy_id") != F.col("t"))
    return (
        _rule(both, F.col("records_in") != sum((F.col(b) for b in names), F.lit(0)), "labeling", "buckets add up", F.col("records_in"))
        .unionByName(_rule(both, differ, "labeling", "rows fit the report", F.col("records_in")))
        .unionByName(_rule(both, F.col("labeled") + F.col("refused") + F.col("failed") > max_labels, "labeling", "within budget", F.col("labeled")))
        .unionByName(other.select(F.lit("labeling").alias("entity"), F.lit("one taxonomy").alias("rule"), F.col("record_id").alias("detail")))
    )


def check_ledger(ledger: DataFrame) -> DataFrame:
    """ledger has (run, judged_in, human_in, n_matched, judge_only, human_only): both sides add up."""
    return _rule(ledger, F.col("judged_in") != F.col("n_matched") + F.col("judge_only"), "ledger", "judged adds up", F.col("run")).unionByName(
        _rule(ledger, F.col("human_in") != F.col("n_matched") + F.col("human_only"), "ledger", "human adds up", F.col("run"))
    )


def check_ledger_ids(matched: DataFrame, judge_only: DataFrame, human_only: DataFrame, key: str = "record_id") -> DataFrame:
    """No record stands in two of the three parts of a ledger."""
    every = matched.select(key).unionByName(judge_only.select(key)).unionByName(human_only.select(key))
    return _twice(every, key, "ledger")


def check_interval(rows: DataFrame) -> DataFrame:
    """rows has (run, resamples, degenerate, lower, upper): bounds are there unless every resample is degenerate, and lie in order in [-1, 1]."""
    none = F.col("lower").isNull() & F.col("upper").isNull()
    lacking = F.col("lower").isNull() | F.col("upper").isNull()
    return (
        _rule(rows, (F.col("degenerate") < 0) | (F.col("degenerate") > F.col("resamples")), "interval", "degenerate within resamples", F.col("run"))
        .unionByName(_rule(rows, F.when(F.col("degenerate") == F.col("resamples"), ~none).otherwise(lacking), "interval", "bounds unless all degenerate", F.col("run")))
        .unionByName(_rule(rows.where(~lacking), (F.col("lower") > F.col("upper")) | (F.col("lower") < -1) | (F.col("upper") > 1), "interval", "bounds in order", F.col("run")))
    )


def check_kappa_status(rows: DataFrame) -> DataFrame:
    """rows has (run, kappa, status): a kappa is there exactly where the status is ok, and the status is a known one."""
    return _rule(rows, (F.col("status") == "ok") != F.col("kappa").isNotNull(), "kappa", "value where ok", F.col("run")).unionByName(
        _rule(rows, ~F.col("status").isin(*schema.KAPPA_STATUS), "kappa", "known status", F.col("run"))
    )


def _marginals(cells: DataFrame, by: str) -> DataFrame:
    """(run, class, h, j, a, n): both raters' uses of each class, their agreements and the total, in one aggregation."""
    both = cells.select(by, F.explode(F.array(F.struct(F.col("human").alias("class"), F.col("n").alias("h"), F.lit(0).cast("bigint").alias("j")), F.struct(F.col("judge").alias("class"), F.lit(0).cast("bigint").alias("h"), F.col("n").alias("j")))).alias("e"), F.when(F.col("human") == F.col("judge"), F.col("n")).otherwise(0).alias("a2"))
    per = both.groupBy(by, "e.class").agg(F.sum("e.h").alias("h"), F.sum("e.j").alias("j"), (F.sum("a2") / 2).cast("bigint").alias("a"))
    return per.withColumn("n", F.sum("h").over(Window.partitionBy(by)))


def check_axis(cells: DataFrame, headline: DataFrame, per_class: DataFrame, entries: DataFrame, by: str = "run") -> DataFrame:
    """A report fits its own confusion cells (run, human, judge, n).

    headline (run, n, kappa), per_class (run, class, human_n, judge_n, both_n) and entries (run, human, judge,
    record_id), the list of disagreements, are each recomputed from the cells.
    """
    per = _marginals(cells, by)
    n, d, s = F.sum("h").cast("double"), F.sum("a").cast("double"), F.sum(F.col("h") * F.col("j")).cast("double")
    own = per.groupBy(by).agg(F.sum("h").alias("own_n"), F.round((n * d - s) / F.nullif(n * n - s, F.lit(0.0)), 6).alias("own_kappa"))
    off = headline.join(own, by, "left")
    classes = per_class.join(per.select(by, "class", "h", "j", "a"), [by, "class"], "full")
    listed = entries.groupBy(by, "human", "judge").agg(F.count("*").alias("k"))
    many = cells.where("human <> judge AND n > 0").join(listed.where("human <> judge"), [by, "human", "judge"], "full")
    cell = F.concat_ws(":", F.col(by), "human", "judge")
    return (
        _rule(off, ~F.col("kappa").eqNullSafe(F.col("own_kappa")), "axis", "kappa is its cells'", F.col(by))
        .unionByName(_rule(off, F.col("n") != F.col("own_n"), "axis", "n is its cells'", F.col(by)))
        .unionByName(_rule(classes, ~(F.col("human_n").eqNullSafe(F.col("h")) & F.col("judge_n").eqNullSafe(F.col("j")) & F.col("both_n").eqNullSafe(F.col("a"))), "axis", "class counts are its cells'", F.concat_ws(":", F.col(by), "class")))
        .unionByName(_rule(per_class, F.col("both_n") > F.least("human_n", "judge_n"), "axis", "diagonal within marginals", F.concat_ws(":", F.col(by), "class")))
        .unionByName(_rule(entries, F.col("human") == F.col("judge"), "axis", "an entry disagrees", F.concat_ws(":", F.col(by), "record_id")))
        .unionByName(_rule(many, F.coalesce("n", F.lit(0)) != F.coalesce("k", F.lit(0)), "axis", "as many entries as the cell", cell))
    )


def check_names(digests: DataFrame) -> DataFrame:
    """digests has (name, sha256): base names, hex digests."""
    return _rule(digests, F.col("name").rlike(r"[/\\]") | (F.col("name") == ""), "input", "name is a base name", F.col("name")).unionByName(
        _rule(digests, ~F.col("sha256").rlike("^[0-9a-f]{64}$"), "input", "digest is sha256", F.col("name"))
    )


def unmatched_sources(digests: DataFrame, report: DataFrame) -> DataFrame:
    """(source_name, side): sources that only the input digests or only the ingest report name."""
    d = digests.select(F.col("name").alias("source_name")).distinct().withColumn("d", F.lit(1))
    r = report.select("source_name").distinct().withColumn("r", F.lit(1))
    return d.join(r, "source_name", "full").where("d IS NULL OR r IS NULL").select("source_name", F.when(F.col("r").isNull(), "digest").otherwise("report").alias("side"))


def label_fingerprint(labels: DataFrame, key: str = "record_id", columns: tuple[str, ...] = ("task_type", "outcome")) -> Column | DataFrame:
    """One row (n, fingerprint) of the labels' content, whatever their order and their other columns.

    Rows are hashed and the hashes folded by sums over four words each, so nothing is gathered; equal content gives equal
    fingerprints in any order.
    """
    digest = F.sha2(F.concat_ws(schema.SEP, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (key, *columns)]), 256)
    word = lambda at: F.sum(F.conv(F.substring(digest, at, 12), 16, 10).cast("decimal(38,0)"))
    return labels.agg(F.count("*").alias("n"), *[word(at).alias(f"w{at}") for at in (1, 13, 25, 37)]).select(
        "n", F.sha2(F.concat_ws(":", "n", *[F.coalesce(F.col(f"w{at}").cast("string"), F.lit("0")) for at in (1, 13, 25, 37)]), 256).alias("fingerprint")
    )


def distinct_sets(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(name, value): the distinct non-null values of small vocabularies, such as annotators, models and taxonomies."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns]))
    return rows.select(pairs.alias("p")).select("p.*").where("value IS NOT NULL").distinct()


def foreign_taxonomies(labels: DataFrame, taxonomy_id: str) -> DataFrame:
    """(taxonomy_id, labels): taxonomies of labels that aren't the run's; a run may go on only if there is none."""
    return labels.where(~F.col("taxonomy_id").eqNullSafe(F.lit(taxonomy_id))).groupBy("taxonomy_id").agg(F.count("*").alias("labels"))


@dataclass(frozen=True)
class EmbedderFingerprint:
    """What an embedder was; two runs may be compared only if these are equal."""

    name: str
    dim: int
    ngram_min: int
    ngram_max: int

    def __post_init__(self) -> None:
        if self.dim < 2:
            raise ValueError("dim must be at least 2")
        if not 1 <= self.ngram_min <= self.ngram_max:
            raise ValueError("ngram_min must not exceed ngram_max")


@dataclass(frozen=True)
class JudgeFingerprint:
    """What a judge was: model, questionnaire, prompt and examples."""

    model_id: str
    taxonomy_id: str
    prompt_sha256: str
    few_shot_ids: tuple[str, ...] = ()
    few_shot_content_hashes: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if not HEX64.fullmatch(self.prompt_sha256) or not all(HEX64.fullmatch(h) for h in self.few_shot_content_hashes):
            raise ValueError("digests must be 64 lower-case hex digits")
        for values in (self.few_shot_ids, self.few_shot_content_hashes):
            if list(values) != sorted(set(values)):
                raise ValueError("few-shot sets must be sorted and unique")
        if len(self.few_shot_ids) != len(self.few_shot_content_hashes):
            raise ValueError("as many few-shot ids as content hashes")

    def first_divergence(self, other: JudgeFingerprint) -> str | None:
        """Name of the first field in which two judges differ."""
        return next((k for k in self.__dataclass_fields__ if getattr(self, k) != getattr(other, k)), None)
