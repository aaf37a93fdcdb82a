"""The row-local and key-local part of the pipeline as a stream: parse, redact, identify, drop exchanges already seen.

Batch stays the authority for survivors: a later row can precede an earlier one in canonical order, which an append-only
stream can't take back. The stream keeps the first arrival of an exchange within the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill import schema
from tallymill.functions.redact import sanitize_wide


def stream_exchanges(rows: DataFrame, event_time: str = "ingested_at", delay: str = "2 days", q: str = "q", a: str = "a") -> DataFrame:
    """Distinct sanitized exchanges of a stream of log rows; blank sides are dropped, late repeats within `delay` too."""
    clean = rows.withColumn("input_text", sanitize_wide(q)).withColumn("output_text", sanitize_wide(a))
    full = clean.where(F.col("input_text").rlike(r"\S") & F.col("output_text").rlike(r"\S"))
    hashed = full.withColumn("content_hash", schema.content_hash(F.col("input_text"), F.col("output_text"))).withWatermark(event_time, delay)
    return hashed.dropDuplicatesWithinWatermark(["content_hash"]).select("source_name", "line_no", event_time, "input_text", "output_text", "content_hash")


def stream_counts(rows: DataFrame, event_time: str = "ingested_at", window: str = "1 day", delay: str = "2 days") -> DataFrame:
    """Arrivals per window and source, late rows counted within the watermark."""
    return rows.withWatermark(event_time, delay).groupBy(F.window(event_time, window), "source_name").agg(F.count("*").alias("n"))
