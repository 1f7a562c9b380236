"""Lineage cuts that survive the loss of an executor."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Local folders chosen for sessions that name none.
_chosen: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    Only where a local session leaves it unset is a temporary folder chosen, and removed when Python ends; on a cluster an unset
    folder is an error, because a machine-local path would lose data with its executor. The session's settings stay as they are.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _chosen:
            made = tempfile.mkdtemp(prefix="axonframe-")
            atexit.register(shutil.rmtree, made, ignore_errors=True)
            _chosen[app] = "file://" + made
        found = _chosen[app]
    return found.rstrip("/")


def _own_dir(spark: SparkSession) -> str:
    """The session's own part of the shared folder."""
    return f"{shared_dir(spark)}/axonframe-{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and return the table read back."""
    spark = df.sparkSession
    path = f"{_own_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete cut tables that nothing reads any more; other tables are left alone."""
    for df in tables:
        if path := df.__dict__.get("_cut_path"):
            _delete(df.sparkSession, path)


def clear_cuts(spark: SparkSession) -> None:
    """Delete all cut tables of the session; results that were not written yet can no longer be read."""
    _delete(spark, _own_dir(spark))
