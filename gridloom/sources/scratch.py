"""Files in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a local master may run without it and gets a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="gridloom-scratch-"))
    return spark.conf.get("spark.checkpoint.dir")


#: Stands before the name of a catalog table among the paths.
TABLE = "table:"

#: The folders named since a caller of this thread began to note them; None where nobody does.
noted: ContextVar[list[str] | None] = ContextVar("noted", default=None)


def new_folder(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark)}/gridloom/{label}-{uuid.uuid4().hex}"
    if (list_ := noted.get()) is not None:
        list_.append(path)
    return path


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, fs = _file_system(spark, path)
    return bool(fs.exists(where))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back, which cuts its lineage."""
    path, schema = new_folder(df.sparkSession, label), df.schema
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def stored_by(df: DataFrame, key: str, label: str) -> DataFrame:
    """Writes ``df`` in buckets of ``key``: grouping or joining by it later moves no row of it."""
    spark = df.sparkSession
    name = f"gridloom_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if (written := noted.get()) is not None:
        written.append(f"{TABLE}{name}")
    df.write.bucketBy(buckets, key).option("compression", "zstd").option("path", new_folder(spark, label)).saveAsTable(name)
    return spark.table(name)


def delete(spark: SparkSession, path: str) -> None:
    where, fs = _file_system(spark, path)
    fs.delete(where, True)
