"""Parquet table scans (S-12)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one table; callers select columns so Catalyst prunes the scan."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
