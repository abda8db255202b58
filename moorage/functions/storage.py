"""Cutting lineage with tables in the folder that the whole cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a session without executors of its own (``local[...]``, as in tests) gets a temporary folder when the
    setting is missing; on a cluster that is an error, because executors don't see each other's local folders.
    """
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    held = getattr(context, "_moorage_dir", None)
    if held is None:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        held = context._moorage_dir = tempfile.mkdtemp(prefix="moorage-")
    return held


def cut(df: DataFrame) -> DataFrame:
    """Writes ``df`` as Parquet in the shared folder and returns the written table, with no lineage behind it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/moorage/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._moorage_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Deletes tables that ``cut`` has written, once nothing reads them any more."""
    for df in tables:
        path = getattr(df, "_moorage_path", None)
        if path:
            jvm = df.sparkSession.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
