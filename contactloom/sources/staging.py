"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Bytecode of one generated method up to which the JVM compiles it; Spark's own default lets it interpret larger ones.
METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside get generated code in methods the JVM compiles; a projection of 67 columns is too long for one.

    A limit that the session was given stays, and the session is left as it was.
    """
    name, limit = METHOD_LIMIT
    given = spark.conf.get(name)
    if given != "65535":
        yield
        return
    spark.conf.set(name, limit)
    try:
        yield
    finally:
        spark.conf.unset(name)


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only a local session gets its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.gettempdir()


def shared_folder(spark: SparkSession) -> str:
    """A path for new tables below the shared root; unique per call."""
    return f"{shared_root(spark)}/contactloom-{uuid.uuid4().hex}"


def stage(df: DataFrame, path: str | None = None, wide: bool = False) -> DataFrame:
    """Write a DataFrame once and read it back: shared by several readers, no lineage.

    The files survive lost executors, and readers still prune columns.  ``wide`` is for rows of all properties
    (see ``small_methods``).
    """
    where = path or shared_folder(df.sparkSession)
    if wide:
        with small_methods(df.sparkSession):
            return stage(df, where)
    df.write.mode("overwrite").parquet(where)
    return df.sparkSession.read.schema(df.schema).parquet(where)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file is there, on any file system the session knows."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
