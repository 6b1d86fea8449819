"""Tables written to the shared checkpoint folder of the cluster.

A written table cuts lineage: executors can be lost without an earlier step
running again.  A step that nothing reads any more is removed; what a returned
frame still reads stays in the folder that ``spark.checkpoint.dir`` names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quarry.session import checkpoint_dir


class Scratch:
    """One run's folder below the checkpoint folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder = spark, f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def write(self, rows: DataFrame, step: str) -> DataFrame:
        path = f"{self.folder}/{step}"
        rows.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def drop(self, step: str) -> None:
        """Remove a step's files; no frame may read them any more."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{step}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
