"""Several sources consolidated into entities, indexes and one nested document."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pollweave.functions.scalars import parse_session, session_number
from pollweave.functions.semantics import col


def upsert(sources: list[DataFrame], key: str, first: list[str], last: list[str], order: str) -> DataFrame:
    """One row per key: ``first`` columns from the earliest row that has the key, ``last`` from the latest.

    Earlier sources come before later ones, rows of a source by ``order``; columns a source lacks are null.
    """
    parts = [s.dropna(subset=[key]).withColumn("__at", F.struct(F.lit(i).alias("s"), col(order).alias("o"))) for i, s in enumerate(sources)]
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    aggs = [F.min_by(F.struct(col(c)), F.col("__at"))[c].alias(c) for c in first] + [F.max_by(F.struct(col(c)), F.col("__at"))[c].alias(c) for c in last]
    return u.groupBy(col(key)).agg(*aggs)


def ordered_distinct(value: str | Column, order: str | Column) -> Column:
    """Aggregate: distinct non-null values in the order of their first occurrence."""
    rows = F.array_sort(F.collect_list(F.struct(col(order).alias("o"), col(value).alias("v"))))
    return F.array_distinct(F.filter(F.transform(rows, lambda x: x["v"]), lambda v: v.isNotNull()))


def index(df: DataFrame, key: str, value: str, order: str, out: str = "items") -> DataFrame:
    """Inverted index: ``key`` -> its distinct values in order of appearance; null keys are left out.
    Repeats are merged before lists are made, so a list is as long as its distinct values."""
    first = df.dropna(subset=[key, value]).groupBy(col(key), col(value)).agg(F.min(col(order)).alias("__o"))
    return first.groupBy(col(key)).agg(F.transform(F.array_sort(F.collect_list(F.struct("__o", col(value).alias("__v")))), lambda x: x["__v"]).alias(out))


def nested_json(entities: DataFrame, key: str, sessions: DataFrame, session: str) -> DataFrame:
    """``(key, json)``: attributes of each entity with a map of its sessions' statistics."""
    stats = [c for c in sessions.columns if c not in (key, session)]
    per = sessions.dropna(subset=[key, session]).groupBy(col(key)).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(col(session).alias("k"), F.struct(*[col(c) for c in stats]).alias("v"))))).alias("sessions"))
    attrs = [col(c) for c in entities.columns if c != key]
    return entities.join(per, key, "left").select(col(key), F.to_json(F.struct(*attrs, "sessions")).alias("json"))


def sessions_without(sessions: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Sessions that have no row in another table (such as the gender table)."""
    return sessions.select(col(key)).distinct().join(other.select(col(key)).distinct(), key, "left_anti")


def latest_stats(df: DataFrame, key: str, session: Column, stats: dict[str, Column], order: str) -> DataFrame:
    """``(key, session, stats)``: the statistics on the last row (by ``order``) of each key and session; null keys and
    sessions are left out."""
    d = df.select(col(key), session.alias("session"), F.struct(*[c.alias(n) for n, c in stats.items()]).alias("stats"), col(order).alias("__o"))
    return d.dropna(subset=[key, "session"]).groupBy(col(key), "session").agg(F.max_by("stats", "__o").alias("stats"))


def sections(parts: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """``(section, key, json)``: each part's rows as documents of that section under the value of its key column.

    The nested document is the object of the sections; a row for each entry keeps it distributed. Attributes that are
    null are left out of the JSON.
    """
    one = lambda name, df, key: df.select(F.lit(name).alias("section"), col(key).cast("string").alias("key"), F.to_json(F.struct(*[col(c) for c in df.columns if c != key])).alias("json"))
    return reduce(DataFrame.unionByName, [one(name, df, key) for name, (df, key) in parts.items()])


def sorted_sessions(df: DataFrame, session: str, suffix: str) -> DataFrame:
    """One row ``(sessions)``: the session keys with the suffix, sorted by their number; keys without one come last."""
    keys = df.select(parse_session(session, suffix).alias("k")).where("k is not null").distinct()
    rows = F.array_sort(F.collect_list(F.struct(F.coalesce(session_number("k"), F.lit(2**62)).alias("n"), "k")))
    return keys.agg(F.transform(rows, lambda x: x["k"]).alias("sessions"))
