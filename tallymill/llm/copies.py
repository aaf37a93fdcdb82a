"""Records that are the same but for formatting (problem 2), by progressive partition refinement.

Level 0 groups by cheap invariants that no formatting changes: the number of letters and digits of each field and a
histogram of its characters, which survives any order of named fields. Level 1 compares the ordered digests inside
classes with several members (they are written in the same pass, since to fold the text is what costs). Only classes whose members' digests differ go to level 2, where texts made of named
fields are taken apart and keyed by their sorted fields.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.functions.bitmap import hits, member_bits
from tallymill.functions.text import fold, squeeze
from tallymill.operators.skew import join_counted
from tallymill.session import materialize

_SEPARATORS = ("\n", "|", ";", "·", " / ", ", ", ",\n")
_NAMED = re.compile(r"^[\s\-–—•*{\"'“«]*([^\W\d_][^:=\n|;]{0,40}?)[\s\"'”»]*(?::|=)\s*(.*)$", re.S)


def named_fields(text: str | None) -> list[tuple[str, str]] | None:
    """Squeezed (name, value) fields of a JSON object or of name-value fields one after the other; None if it is neither."""
    if not text or text.count(":") + text.count("=") < 2:
        return None
    body = text.strip().strip("﻿​")
    if body.startswith("{") and body.endswith("}"):
        try:
            got = json.loads(body, object_pairs_hook=lambda pairs: pairs)
            if isinstance(got, list) and got and isinstance(got[0], tuple):
                return [(squeeze(fold(str(k))), squeeze(fold(v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)))) for k, v in got]
        except ValueError:
            pass
        body = body[1:-1]
    for separator in _SEPARATORS:
        if separator not in body:
            continue
        got = []
        for part in body.split(separator):
            if part.strip():
                m = _NAMED.match(part)
                if m is None and not squeeze(part):
                    continue
                got.append(m)
                if m is None:
                    break
        if len(got) > 1 and got[-1] is not None:
            return [(squeeze(fold(m[1])), squeeze(fold(m[2]))) for m in got]
    return None


def exchange_key(q: str | None, a: str | None) -> tuple[int, int]:
    """Costliest key, and how many of the two texts it took as named fields (their order then doesn't count)."""
    parts, taken = [], 0
    for text in (q, a):
        fields = named_fields(text)
        if fields is None or len(fields) < 2:
            parts.append(squeeze(fold(text)))
        else:
            parts.append("".join(sorted(n + v for n, v in fields)))
            taken += 1
    return xxhash.xxh3_64_intdigest("\x1f".join(parts).encode("utf-8", "surrogatepass")), taken


def _profile(q: str, a: str) -> tuple[int, int]:
    """Level 0 and level 1 keys of two squeezed texts."""
    digest = xxhash.xxh3_64()
    for text in (q, a):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        digest.update(np.bincount(codes & 255, minlength=256).astype(np.uint32).tobytes() + len(text).to_bytes(4, "little"))
    ordered = xxhash.xxh3_64_intdigest((q + "\x1f" + a).encode("utf-8", "surrogatepass"))
    return digest.intdigest(), ordered


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64))


def _levels(batches):
    for b in batches:
        out0, out1 = [], []
        for q, a in zip(b.column("q").to_pylist(), b.column("a").to_pylist()):
            x, y = _profile(squeeze(fold(q)), squeeze(fold(a)))
            out0.append(x)
            out1.append(y)
        yield pa.RecordBatch.from_arrays([b.column("rid"), _signed(out0), _signed(out1)], names=["rid", "k0", "k1"])


def copy_classes(rows: DataFrame, key: str = "line_no", q: str = "q", a: str = "a") -> DataFrame:
    """(rid, k0, kc): rows with equal (k0, kc) are copies of each other; rows without a copy are left out.

    rows needs a unique bigint `key`. Null and empty texts count as empty, so that two rows with nothing in them are
    copies. Further columns are not read. An empty table gives an empty table.
    """
    base = rows.select(F.col(key).cast("bigint").alias("rid"), F.col(q).cast("string").alias("q"), F.col(a).cast("string").alias("a"))
    cheap = materialize(base.mapInArrow(_levels, "rid bigint, k0 bigint, k1 bigint"), "p2-cheap")
    # pre-aggregated by both keys, so a class that holds a third of the rows is one row before the shuffle by k0
    digests = cheap.groupBy("k0", "k1").agg(F.count("*").alias("n"))
    classes = digests.groupBy("k0").agg(F.sum("n").alias("n"), F.count("*").alias("d"))
    several = materialize(classes.where("n > 1"), "p2-several")
    marked = join_counted(cheap, several, "k0")
    settled = marked.where("d = 1").select("rid", "k0", F.col("k1").alias("kc"))

    unsettled = materialize(marked.where("d > 1").select("rid", "k0", "k1"), "p2-open")
    bits = member_bits(unsettled, "rid")

    def refine(batches):
        for b in batches:
            b = b.filter(pa.array(hits(b.column("place").to_numpy(zero_copy_only=False), bits)))
            if not b.num_rows:
                continue
            got = [exchange_key(q, a) for q, a in zip(b.column("q").to_pylist(), b.column("a").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("rid"), _signed([k for k, _ in got]), pa.array([n for _, n in got], pa.int32())], names=["rid", "key", "taken"])

    placed = base.withColumn("place", F.pmod(F.xxhash64("rid"), F.lit(64 * len(bits))))
    costly = unsettled.join(placed.mapInArrow(refine, "rid bigint, key bigint, taken int"), "rid")
    # equal ordered digests are copies even if only one spelling reads as fields: the digest takes its best-read key
    best = costly.groupBy("k0", "k1").agg(F.count("*").alias("n"), F.max_by("key", F.struct("taken", "key")).alias("kc"))
    refined = join_counted(unsettled, materialize(best, "p2-best"), ["k0", "k1"]).select("rid", "k0", "kc")
    return settled.unionByName(refined)


def found_copies(rows: DataFrame) -> DataFrame:
    """(line_a, line_b): every row of a group of copies but its first, with the smallest line_no of the group."""
    got = copy_classes(rows)
    first = got.groupBy("k0", "kc").agg(F.min("rid").alias("line_a"), F.count("*").alias("n")).where("n > 1")
    return join_counted(got, materialize(first, "p2-first"), ["k0", "kc"]).where("rid > line_a").select("line_a", F.col("rid").alias("line_b"))


def collapse_copies(rows: DataFrame) -> DataFrame:
    """(line_no, copies): one row per exchange, the first of each group of copies, with the size of the group."""
    pairs = found_copies(rows)
    counts = pairs.groupBy(F.col("line_a").alias("line_no")).agg((F.count("*") + 1).alias("copies"))
    return (
        rows.select("line_no")
        .join(pairs.select(F.col("line_b").alias("line_no")), "line_no", "left_anti")
        .join(counts, "line_no", "left")
        .select("line_no", F.coalesce("copies", F.lit(1).cast("bigint")).alias("copies"))
    )
