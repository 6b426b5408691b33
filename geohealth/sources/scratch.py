"""Tables that are written once to the folder that driver and executors share, and read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Local sessions without one get one of their own; on a cluster it must be set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _own:
            _own.append("file://" + tempfile.mkdtemp(prefix="spark-shared-"))
        root = _own[0]
    return root.rstrip("/")


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new name in the shared folder, which is deleted when the application ends."""
    path = f"{shared_root(spark)}/geohealth/{name}-{uuid.uuid4().hex}"
    files, folder = file_system(spark, path)
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once and read back: what follows reads the table, and a lost executor costs no recomputation."""
    path = scratch_folder(df.sparkSession, name) + "/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
