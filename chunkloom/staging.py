"""Tables written between the steps of a run, in the folder that driver and executors share.

A written table ends lineage: what comes after reads it as often as it likes, and lost executors cost nothing but their own tasks.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.  A local session that names none (tests) gets a temporary one; a cluster's raises."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="spark-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/chunkloom-{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in any store that Spark can reach; nothing happens if there is none."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


class Staged:
    """The tables of one run; ``clear`` deletes them all."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def write(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        for path in self.paths:
            remove(self.spark, path)
        self.paths.clear()
