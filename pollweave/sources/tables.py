"""Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Table ``name`` below ``folder``; with ``columns`` only these are read from the files."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*[f"`{c}`" for c in columns]) if columns else df
