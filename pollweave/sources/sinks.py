"""Outputs: partitioned tables, spreadsheets' CSV, JSON documents, report lines, chart series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pollweave.functions.scalars import fixed, sign_label


def sessions_parquet(df: DataFrame, path: str, *keys: str) -> None:
    df.write.mode("overwrite").partitionBy(*keys).parquet(path)


def csv_by_key(df: DataFrame, path: str, key: str) -> None:
    """One folder per key with CSV that begins with a byte order mark (spreadsheets then read UTF-8)."""
    first, *rest = [c for c in df.columns if c != key]
    df.withColumnRenamed(first, "\ufeff" + first).select(key, F.col("\ufeff" + first), *rest).write.mode("overwrite").partitionBy(key).csv(path, header=True)


def json_document(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").text(path)


def report_line(label: Column, *values: tuple[str, Column]) -> Column:
    """``label: name 1.00, ...`` with two decimals."""
    parts = [F.concat(F.lit(f"{n} "), fixed(v)) for n, v in values]
    return F.concat(label, F.lit(": "), F.concat_ws(", ", *parts))


def chart_series(df: DataFrame, x: str, y: str, series: str | None = None) -> DataFrame:
    """What a line or bar chart draws: ``x, y, series`` and the sign that colours a diverging bar."""
    return df.select(F.col(f"`{x}`").alias("x"), F.col(f"`{y}`").alias("y"), (F.col(f"`{series}`") if series else F.lit(None).cast("string")).alias("series"), sign_label(y).alias("sign"))


def scatter(df: DataFrame, x: str, y: str, label: str, outlier: Column, panel: str) -> DataFrame:
    """What one panel of a scatter plot draws: ``panel, label, x, y, is_outlier``; points without both numbers are not
    drawn."""
    return df.select(F.lit(panel).alias("panel"), F.col(f"`{label}`").alias("label"), F.col(f"`{x}`").cast("double").alias("x"), F.col(f"`{y}`").cast("double").alias("y"), F.coalesce(outlier, F.lit(False)).alias("is_outlier")).where("x is not null and y is not null")


def cloud(terms: DataFrame, term: str, weight: str) -> DataFrame:
    """What a word cloud draws: ``term, weight`` with the largest weight 1; weights that are null or not above 0 are
    not drawn."""
    t = terms.select(F.col(f"`{term}`").alias("term"), F.col(f"`{weight}`").cast("double").alias("w")).where("w > 0")
    return t.crossJoin(F.broadcast(t.agg(F.max("w").alias("m")))).select("term", (F.col("w") / F.col("m")).alias("weight"))
