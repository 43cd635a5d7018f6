"""Session helpers: tables, the shared work folder and settings."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders written by this process, removed when it ends.
_WRITTEN: list[str] = []


@atexit.register
def _forget() -> None:
    for path in _WRITTEN:
        if path.startswith("file:"):
            shutil.rmtree(path.removeprefix("file:").replace("//", "/", 1), ignore_errors=True)
        elif spark := SparkSession.getActiveSession():
            discard(spark, path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a written folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for written intermediates, visible to every executor, and removed when this process ends.

    The folder lies below ``spark.checkpoint.dir``. Where that is unset, a local session gets a
    folder of its own; a cluster session is refused, since a machine-local folder would lose data.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        base = "file://" + tempfile.mkdtemp(prefix="tessella-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_settings(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session on the same context that differs from ``spark`` only in ``settings``.

    File-scan settings are read when a scan is planned, so they cannot be options of one reader; a
    session of their own keeps the caller's session as it was.
    """
    other = spark.newSession()
    fixed = {"spark.sql.warehouse.dir", "spark.sql.catalogImplementation", "spark.sql.extensions"}
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and key not in fixed:
            try:
                other.conf.set(key, value)
            except Exception:  # static settings are shared by all sessions of the context
                continue
    for key, value in settings.items():
        other.conf.set(key, value)
    return other
