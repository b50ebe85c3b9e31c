"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_swept: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset, one of this process, which only a master on this machine can read."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is unset: a cluster needs a folder that all executors share")
    if "dir" not in _own:
        _own["dir"] = tempfile.mkdtemp(prefix="corpusloom-")
        atexit.register(shutil.rmtree, _own["dir"], True)
    return "file://" + _own["dir"]


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def clear(spark: SparkSession) -> None:
    """Deletes all staged tables of this application; DataFrames that read them can't be run any more. Done at exit as well."""
    _delete(spark, f"{shared_folder(spark)}/corpusloom/{spark.sparkContext.applicationId}")


def _sweep(fs, at) -> None:
    try:
        fs.delete(at, True)
    except Exception:  # the session's JVM may be gone  # noqa: BLE001
        pass


def stage(df: DataFrame, label: str) -> DataFrame:
    """Writes `df` as a table in the shared folder and reads it back: the lineage ends there, so a lost executor costs
    no more than its own tasks, and several readers share one computation."""
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/corpusloom/{spark.sparkContext.applicationId}"
    if folder not in _swept:
        _swept.add(folder)
        at = spark._jvm.org.apache.hadoop.fs.Path(folder)
        atexit.register(_sweep, at.getFileSystem(spark._jsc.hadoopConfiguration()), at)  # works on when the context is stopped
    path = f"{folder}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes staged tables that nothing will read again."""
    for df in tables:
        if path := getattr(df, "_staged_at", None):
            _delete(df.sparkSession, path)
