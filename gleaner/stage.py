"""Written stages: cut a plan at a table in the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folder: tempfile.TemporaryDirectory | None = None
_written: list[str] = []


def stage_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Local sessions without one get a scratch folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.TemporaryDirectory(prefix="gleaner-")
    return _local_folder.name


def fresh_path(spark: SparkSession, label: str) -> str:
    path = f"{stage_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def release(spark: SparkSession, since: int = 0) -> int:
    """Delete the copies this process wrote. Frames built on them can no longer be read.

    ``since``: an earlier ``written()``; only what came after it is deleted.
    """
    count = 0
    while len(_written) > since:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        count += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return count


def written() -> int:
    """How many copies this process has written and not deleted."""
    return len(_written)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    The copy outlives lost executors, keeps column pruning and row counts in the footers, and pins
    values such as row ids that a recomputed plan could assign differently.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
