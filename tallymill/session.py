"""Session, shared folder and materialisation helpers used by every operator."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_FALLBACK: dict[str, str] = {}


def build_session(app: str = "tallymill", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session with the settings the tests and the bench share."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors reach, from spark.checkpoint.dir; unset, a temporary one in local mode and an error on a cluster."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors reach")
    app = spark.sparkContext.applicationId
    if app not in _FALLBACK:
        _FALLBACK[app] = "file://" + tempfile.mkdtemp(prefix="tallymill-")
    return _FALLBACK[app]


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write df as a table in the shared folder and read it back: the lineage ends there and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tallymill/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tallymill_path = path
    return out


def discard(df: DataFrame) -> None:
    """Remove a table written by materialize() once nothing lazy reads it any more."""
    path = getattr(df, "_tallymill_path", None)
    if path:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table of a scale directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
