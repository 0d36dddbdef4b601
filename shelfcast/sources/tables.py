"""Reading the given parquet tables with column pruning at the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Scan ``<sf_dir>/<name>.parquet``, keeping only ``columns`` (ReadSchema prunes to them)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
