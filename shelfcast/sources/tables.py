"""Column-pruned parquet scans of the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str, cols: list[str] | None = None) -> DataFrame:
    """Scan one driver table; `cols` prunes the parquet read schema."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df
