"""Writers: the export pair, annotation sheets and text reports. Files appear whole or not at all."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.operators.export import golden_lines


def sha256_hex(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def _fs(spark, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _write_text(spark, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    stream = fs.create(p)
    stream.write(bytearray(text.encode()))
    stream.close()


def write_text_whole(spark, path: str, text: str) -> None:
    """A text file that appears whole: written beside its place and renamed over it in one step."""
    staged = f"{path}.{uuid.uuid4().hex}"
    _write_text(spark, staged, text)
    jvm = spark._jvm
    _, src = _fs(spark, staged)
    _, dst = _fs(spark, path)
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(src.toUri(), spark._jsc.hadoopConfiguration()).rename(src, dst, over)


def write_export(golden: DataFrame, meta_text: str, out_dir: str) -> str:
    """golden.jsonl (a directory of ordered part files) and meta.json in a folder of their own; its path.

    The pair is written whole before the file CURRENT is renamed to name it, in one step, so that a reader always finds
    one complete pair and a failed run leaves the one before. Older pairs stay.
    """
    spark = golden.sparkSession
    name = f"export-{uuid.uuid4().hex}"
    folder = f"{out_dir.rstrip('/')}/{name}"
    golden_lines(golden).write.text(f"{folder}/golden.jsonl")
    _write_text(spark, f"{folder}/meta.json", meta_text)
    write_text_whole(spark, f"{out_dir.rstrip('/')}/CURRENT", name)
    return folder


def current_export(spark, out_dir: str) -> str | None:
    """Folder of the pair that out_dir's CURRENT names, None where nothing was exported."""
    fs, p = _fs(spark, f"{out_dir.rstrip('/')}/CURRENT")
    if not fs.exists(p):
        return None
    return f"{out_dir.rstrip('/')}/" + spark.read.text(p.toString()).first()[0]


class ArtifactsPresent(ValueError):
    """A folder that holds the other kind of artifacts: labels by a judge and blank sheets for humans never share one."""


def refuse_mixed(spark, out_dir: str, kind: str) -> None:
    """Raises where an annotation sheet would go beside a judge's output, or a judge's output beside a sheet."""
    other = {"annotation": ("CURRENT", "run_report"), "judge": ("sheet.jsonl", "instructions")}[kind]
    fs, p = _fs(spark, out_dir)
    if not fs.exists(p):
        return
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    found = sorted(n for n in names if n.startswith(other))
    if found:
        raise ArtifactsPresent(f"{out_dir} holds {found[0]}")


def annotation_sheet(records: DataFrame, taxonomy_id: str) -> DataFrame:
    """One JSON line per record for a human to fill, fields in a fixed order, rows in canonical order."""
    blank = [F.lit("").alias(k) for k in ("task_type", "outcome", "annotator", "note")]
    rows = records.orderBy("source_name", "line_no", "record_id")
    return rows.select(F.to_json(F.struct(F.col("record_id"), F.lit(taxonomy_id).alias("taxonomy_id"), *blank, F.col("input_text"), F.col("output_text"))).alias("value"))


def preview(text: F.Column, most: int = 64) -> F.Column:
    """One-line preview: line feeds shown as signs, cut with an ellipsis."""
    flat = F.regexp_replace(text, "\n", "␤")
    return F.when(F.length(flat) <= most, flat).otherwise(F.concat(F.substring(flat, 1, most - 1), F.lit("…")))


def wrap_words(words: list[str], width: int = 90, indent: str = "  ") -> str:
    """Words in lines of at most `width` characters, each line indented."""
    import textwrap

    return textwrap.fill(", ".join(words), width, initial_indent=indent, subsequent_indent=indent, break_long_words=False, break_on_hyphens=False) if words else indent + "-"


def render_table(df: DataFrame, title: str, most: int = 200) -> str:
    """Text report of a small table (collected counts, never data rows)."""
    rows = df.limit(most).collect()
    cells = [[str(c) for c in df.columns], *[["-" if v is None else str(v) for v in r] for r in rows]]
    width = [max(len(r[i]) for r in cells) for i in range(len(df.columns))]
    return "\n".join([title, *("  ".join(c.ljust(w) for c, w in zip(r, width)).rstrip() for r in cells)]) + "\n"
