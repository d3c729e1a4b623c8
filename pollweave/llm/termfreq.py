"""Frequency of every distinct term: occurrences, records that have it, and a mark for the useless ends.

Per-record counts are made first, then combined by hash on the map side, and only the partial sums are
shuffled; a hot term is one small partial row per task, so it does not skew the reduction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Blanks trimmed from terms: Unicode white space, no-break and zero-width blanks.
BLANKS = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200B}\x{2028}\x{2029}\x{202F}\x{205F}\x{2060}\x{3000}\x{FEFF}]"
RARE_BELOW = 3
COMMON_ABOVE = 0.25


def trimmed(c: Column) -> Column:
    """``c`` without outer blanks; null if nothing is left."""
    return F.nullif(F.regexp_replace(c, f"^{BLANKS}+|{BLANKS}+$", ""), F.lit(""))


def tags_of(field: Column, separators: str = "、；") -> Column:
    """The non-empty trimmed values of a separated field, repeats kept; an empty array for null."""
    parts = F.transform(F.split(F.coalesce(field, F.lit("")), f"[{separators}]"), trimmed)
    return F.filter(parts, lambda x: x.isNotNull())


def from_arrays(df: DataFrame, terms: Column) -> DataFrame:
    """``(term, n)`` of each record, for records that hold all their terms in one row (no shuffle).

    The counts of one record are made within its row.
    """
    one = df.select(F.array_sort(terms).alias("__t")).where(F.size("__t") > 0)
    one = one.select("__t", F.array_distinct("__t").alias("__u"))
    return one.select(F.explode("__u").alias("term"), F.lit(None).alias("__x"), "__t").select("term", F.size(F.filter("__t", lambda x: x == F.col("term"))).cast("bigint").alias("n"))


def from_rows(df: DataFrame, record: str, term: Column) -> DataFrame:
    """``(record, term, n)`` for records that are spread over rows; nulls in either column are left out."""
    return df.select(F.col(f"`{record}`").alias("record"), term.alias("term")).where("record is not null and term is not null").groupBy("record", "term").agg(F.count("*").alias("n"))


def totals(per_record: DataFrame) -> DataFrame:
    """``(term, occurrences, records)`` from per-record counts."""
    return per_record.groupBy("term").agg(F.sum("n").alias("occurrences"), F.count("*").alias("records"))


def marked(counts: DataFrame, n_records: DataFrame, rare_below: int = RARE_BELOW, common_above: float = COMMON_ABOVE) -> DataFrame:
    """``counts`` with ``mark``: ``rare``, else ``common``, else null. ``n_records`` is one row ``(n)``.

    A term in fewer than ``rare_below`` records is rare even if those are most of a tiny collection.
    """
    return counts.join(F.broadcast(n_records.select(F.col("n").alias("__n"))), how="cross").withColumn("mark", F.when(F.col("records") < rare_below, "rare").when(F.col("records") > F.col("__n") * common_above, "common")).drop("__n")
