"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A fresh path below ``spark.checkpoint.dir``.

    Only a session whose executors live in the driver's process may do without that setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
    return f"{base.rstrip('/')}/tidemark-{uuid.uuid4().hex}"


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` and read it back: cuts the lineage and survives lost executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _filesystem(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch path made by :func:`shared_folder`."""
    target, filesystem = _filesystem(spark, path)
    filesystem.delete(target, True)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme."""
    target, filesystem = _filesystem(spark, path)
    return filesystem.makeQualified(target).toString()


def children(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """Names of what lies directly in a folder, with the time of the last change in seconds."""
    target, filesystem = _filesystem(spark, path)
    found = filesystem.listStatus(target) if filesystem.exists(target) else []
    return [(f.getPath().getName(), f.getModificationTime() / 1000) for f in found]


def file_sizes(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Full names and sizes of a file, or of the files directly in a folder but for markers; none for a path that is not there."""
    target, filesystem = _filesystem(spark, path)
    if not filesystem.exists(target):
        return []
    found = [f for f in filesystem.listStatus(target) if f.isFile() and not f.getPath().getName().startswith(("_", "."))]
    return sorted((f.getPath().toString(), f.getLen()) for f in found)


def take_place(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file to ``target``, in one step where the store can, replacing what is there."""
    jvm, hadoop = spark._jvm, spark._jvm.org.apache.hadoop.fs
    overwrite = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    overwrite[0] = jvm.java.lang.Enum.valueOf(jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), "OVERWRITE")
    context = hadoop.FileContext.getFileContext(hadoop.Path(source).toUri(), spark._jsparkSession.sessionState().newHadoopConf())
    context.rename(hadoop.Path(source), context.makeQualified(hadoop.Path(target)), overwrite)
