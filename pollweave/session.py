"""Session settings the library relies on."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
}


def build(app: str = "pollweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with ANSI semantics, UTC and adaptive execution; ``conf`` wins over the defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**SETTINGS, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage and tables written between stages.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset a session on one machine
    (``local[...]``) uses a folder of its own below ``spark.local.dir``; any other session fails, as a
    folder that the executors do not share would lose data.
    """
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = f"file://{sc.getConf().get('spark.local.dir', '/tmp')}/pollweave-{sc.applicationId}"
        spark.conf.set("spark.checkpoint.dir", at)
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(at)
    return at


def written(df: DataFrame) -> DataFrame:
    """``df`` written once to a table below :func:`checkpoint_dir` and read from there: its lineage is cut,
    nothing is computed twice, and a lost executor costs only its unfinished tasks."""
    at = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{uuid.uuid4().hex}.parquet"
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def broadcast_if_small(df: DataFrame, limit: int = 32 << 20) -> DataFrame:
    """``df`` marked for broadcast if its rows, summed up as text now, have at most ``limit`` bytes; else as it
    is, and Spark joins it by shuffle. The sum is one pass that moves a number per task."""
    bytes_of = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns), F.lit(16))
    total = df.agg(F.sum(bytes_of)).first()[0] or 0
    return F.broadcast(df) if total <= limit else df
