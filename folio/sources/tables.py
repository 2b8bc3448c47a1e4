"""Batch scans of the driver's parquet tables and of the pipeline's own tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet scan; selecting the columns up front keeps ReadSchema minimal."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
