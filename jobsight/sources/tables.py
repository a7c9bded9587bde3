"""Reading source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, root: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """``root/name.parquet``, pruned to ``columns``."""
    df = spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
