"""Folders on the file system the session uses."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder every executor can reach.

    It lies in ``spark.checkpoint.dir``. Only a local session without that
    setting falls back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tickbars-")
    return f"{base.rstrip('/')}/tickbars/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    target, fs = _file_system(spark, path)
    return fs.exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    target, fs = _file_system(spark, path)
    fs.delete(target, True)


def make_dir(spark: SparkSession, path: str) -> None:
    target, fs = _file_system(spark, path)
    fs.mkdirs(target)


def is_folder(spark: SparkSession, path: str) -> bool:
    target, fs = _file_system(spark, path)
    return fs.exists(target) and fs.getFileStatus(target).isDirectory()


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``."""
    target, fs = _file_system(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in a new shared folder.

    For a frame that several branches of a plan read: it is computed once,
    and its lineage ends here.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
