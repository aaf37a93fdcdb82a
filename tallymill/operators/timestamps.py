"""Mixed timestamp spellings as one UTC form (DataFrame operator)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymill.functions.timestamps import CANONICAL, to_utc


@F.arrow_udf(T.StringType())
def _utc(ts: pa.Array, zone: pa.Array, order: pa.Array) -> pa.Array:
    return to_utc(ts, zone, order)


# evaluated once per row, not once in the filter and again in the projection
_utc = _utc.asNondeterministic() if hasattr(_utc, "asNondeterministic") else _utc


def utc_of(ts: Column, zone: Column, order: Column) -> Column:
    """UTC text of a stamp read with the zone and date order of its source.

    Null, blank, words, impossible dates and times, and wall times of an unknown zone give null.
    """
    return _utc(ts.cast("string"), zone.cast("string"), order.cast("string"))


def normalize_timestamps(rows: DataFrame, sources: DataFrame, ts: Column | None = None, out: str = "utc") -> DataFrame:
    """rows plus the column `out`, the instant of `ts` (default meta.ts) in UTC.

    sources has one row per source_name with tz and date_order; it is a setting of fixed size and joins by whatever
    way the planner picks. Rows of an unlisted or null source keep stamps that carry their own offset; their wall
    times give null. Other columns of sources are dropped, so clashing names do no harm; an empty table gives an
    empty table.
    """
    ts = F.col("meta.ts") if ts is None else ts
    clock = sources.select(F.col("source_name").alias("__source"), F.col("tz").alias("__tz"), F.col("date_order").alias("__order")).dropDuplicates(["__source"])
    joined = rows.withColumn("__ts", ts).join(clock, F.col("source_name") == F.col("__source"), "left")
    return joined.withColumn(out, utc_of(F.col("__ts"), F.col("__tz"), F.col("__order"))).drop("__ts", "__source", "__tz", "__order")


def found_instants(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """(line_no, utc) of every row whose meta.ts denotes an instant and isn't yet `YYYY-MM-DDTHH:MM:SS+00:00`."""
    stamped = rows.select("line_no", "source_name", F.col("meta.ts").alias("stamp")).where(F.col("stamp").isNotNull() & ~F.col("stamp").rlike(CANONICAL))
    return normalize_timestamps(stamped, sources, F.col("stamp")).where(F.col("utc").isNotNull()).select("line_no", "utc")
