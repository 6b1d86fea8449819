"""Readers for the given parquet tables (one file per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table.  ``spark.quarry.spreadScans`` (off; the benchmark of
    small one-file tables sets it) deals a scan out to all cores first."""
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    df = spark.read.parquet(table_path(sf_dir, name))
    if spark.conf.get("spark.quarry.spreadScans", "false") == "true":
        df = df.repartition(spark.sparkContext.defaultParallelism)
    return df
