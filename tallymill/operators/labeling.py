"""Labelling under a call budget: contamination guard, then budget, then the judge; every record in one bucket."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill import schema
from tallymill.session import materialize

FAKE_MODEL = "fake-judge"
BUCKETS = ("labeled", "refused", "failed", "skipped_budget", "fewshot_collision")


class JudgeError(Exception):
    """A judge's typed failure; it is counted and the run goes on."""


class JudgeRefusal(JudgeError):
    pass


class JudgeParse(JudgeError):
    pass


class JudgeApi(JudgeError):
    pass


def fake_verdict(input_text: Column, output_text: Column, model: str = FAKE_MODEL) -> Column:
    """The offline judge as one expression: classes by bytes of a digest of the exchange."""
    digest = F.sha2(F.concat_ws(schema.SEP, F.lit(model), input_text, output_text), 256)
    pick = lambda at, names: F.element_at(F.array(*[F.lit(n) for n in names]), (F.conv(F.substring(digest, at, 2), 16, 10).cast("int") % len(names)) + 1)
    return F.struct(
        pick(1, schema.TASK_TYPES).alias("task_type"),
        pick(3, schema.OUTCOMES).alias("outcome"),
        pick(5, schema.CONFIDENCES).alias("confidence"),
        F.concat(F.lit("synthetic fake-judge verdict (digest "), F.substring(digest, 1, 8), F.lit(") — offline demo/tests only")).alias("rationale"),
    )


def collisions(records: DataFrame, shots: DataFrame) -> DataFrame:
    """record_id of the records whose exchange is one of the few-shot examples (semi join on the content hash)."""
    hashes = shots.select(schema.content_hash(F.col("input_text"), F.col("output_text")).alias("h"))
    return records.withColumn("h", schema.content_hash(F.col("input_text"), F.col("output_text"))).join(hashes, "h", "left_semi").select("record_id")


def budget_buckets(records: DataFrame, shots: DataFrame, max_labels: int) -> DataFrame:
    """records plus `bucket`: fewshot_collision, to_judge for the first max_labels others in canonical order, skipped_budget.

    The cut is found by a limited sort (a top-k per task), not by a window over all rows.
    """
    if max_labels < 1:
        raise ValueError("max_labels must be at least 1")
    hit = collisions(records, shots).distinct().withColumn("__hit", F.lit(True))
    marked = records.join(hit, "record_id", "left")
    first = marked.where("__hit IS NULL").select("source_name", "line_no", "record_id").orderBy("source_name", "line_no", "record_id").limit(max_labels).select("record_id").withColumn("__in", F.lit(True))
    bucket = F.when(F.col("__hit"), "fewshot_collision").when(F.col("__in"), "to_judge").otherwise("skipped_budget")
    return marked.join(first, "record_id", "left").withColumn("bucket", bucket).drop("__hit", "__in")


def run_labeling(records: DataFrame, shots: DataFrame, max_labels: int, judge: Callable[[str, str], dict] | None = None, taxonomy_id: str = "", model: str = FAKE_MODEL) -> DataFrame:
    """(record_id, bucket, taxonomy_id, model_id, verdict, detail), one row per record, bucket of BUCKETS.

    judge(input, output) returns a dict of the verdict's fields or raises a JudgeError; without one the offline judge
    labels inside the plan. The result is written before it is returned: a judge that costs money is called once per
    record however often the result is read. Repeated record ids are an error.
    """
    if records.groupBy("record_id").count().where("count > 1").head(1):
        raise ValueError("record ids must be unique")
    routed = budget_buckets(records, shots, max_labels)
    verdict = "struct<task_type:string,outcome:string,confidence:string,rationale:string>"
    kept = routed.where("bucket <> 'to_judge'").select("record_id", "bucket", F.lit(None).cast("string").alias("model_id"), F.lit(None).cast(verdict).alias("verdict"), F.lit(None).cast("string").alias("detail"))
    due = routed.where("bucket = 'to_judge'").select("record_id", "input_text", "output_text")
    if judge is None:
        judged = due.select("record_id", F.lit("labeled").alias("bucket"), F.lit(model).alias("model_id"), fake_verdict(F.col("input_text"), F.col("output_text"), model).alias("verdict"), F.lit(None).cast("string").alias("detail"))
    else:

        def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                out = []
                for rid, q, a in pdf.itertuples(index=False):
                    try:
                        v = judge(q, a)
                        out.append((rid, "labeled", v.get("model_id", model), {k: v[k] for k in ("task_type", "outcome", "confidence", "rationale")}, None))
                    except JudgeRefusal as e:
                        out.append((rid, "refused", None, None, str(e)[:200]))
                    except JudgeError as e:
                        out.append((rid, "failed", None, None, f"{type(e).__name__}: {e}"[:200]))
                yield pd.DataFrame(out, columns=["record_id", "bucket", "model_id", "verdict", "detail"])

        judged = due.mapInPandas(ask, f"record_id string, bucket string, model_id string, verdict {verdict}, detail string")
    return materialize(kept.unionByName(judged).withColumn("taxonomy_id", F.lit(taxonomy_id)), "labels")


def label_distribution(labels: DataFrame, column: str, classes: tuple[str, ...]) -> DataFrame:
    """(class, n) over the whole vocabulary, zeros included, in declared order."""
    grid = labels.sparkSession.createDataFrame([(i, c) for i, c in enumerate(classes)], "pos int, class string")
    counts = labels.groupBy(F.col(column).alias("class")).agg(F.count("*").alias("n"))
    return grid.join(counts, "class", "left").select("pos", "class", F.coalesce("n", F.lit(0)).alias("n"))
