"""Votes joined to their dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pollweave.functions.scalars import clean_name, normalize_title
from pollweave.functions.semantics import assert_unique, col, require_columns


def enrich_votes(votes: DataFrame, dim: DataFrame, key: str, value: str, above: float | None = 5.0, least: float | None = None) -> DataFrame:
    """Votes whose ``key`` has a dimension row with ``value`` (more than ``above``, if given; at least ``least``,
    if given); duplicates in the dimension fan out; null keys match nothing. The dimension is pruned and filtered
    before the join, which Spark broadcasts if its size allows."""
    require_columns(votes, key)
    require_columns(dim, key, value)
    d = dim.select(f"`{key}`", F.col(f"`{value}`").cast("double").alias(value)).dropna(subset=[key, value])
    if above is not None:
        d = d.where(F.col(f"`{value}`") > above)
    if least is not None:
        d = d.where(F.col(f"`{value}`") >= least)
    return votes.drop(value).join(d, key)


def title_clashes(dim: DataFrame, title: str, aliases: dict[str, str] | None = None) -> DataFrame:
    """``(title, n)`` of the normalised titles on several rows of a dimension; null titles are none."""
    return dim.groupBy(normalize_title(title, aliases).alias("title")).agg(F.count("*").alias("n")).where("title is not null and n > 1")


def enrich_songs(votes: DataFrame, dim: DataFrame, title: str, values: list[str], aliases: dict[str, str] | None = None, order: str | None = None) -> DataFrame:
    """Votes joined to songs by normalised title; ``values`` replace columns of the same names.

    A title on two rows of the dimension is an error; with ``order`` the first row by it stands for the title
    instead, so no vote is lost or counted twice. Rows lacking a value are dropped before; null titles match nothing.
    """
    d = dim.select(normalize_title(title, aliases).alias("__key"), *[f"`{v}`" for v in values], *([F.col(f"`{order}`").alias("__o")] if order else [])).dropna()
    if order:
        d = d.groupBy("__key").agg(F.min_by(F.struct(*[f"`{v}`" for v in values]), "__o").alias("__v")).select("__key", "__v.*")
    else:
        assert_unique(d, "__key")
    return votes.drop(*values).withColumn("__key", normalize_title(title, aliases)).join(d, "__key").drop("__key")


def last_wins(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """A lookup table: the value on the last row of each key."""
    return df.dropna(subset=[key]).groupBy(f"`{key}`").agg(F.max_by(f"`{value}`", f"`{order}`").alias(value))


def lookup(df: DataFrame, key: str, table: DataFrame, table_key: str, table_value: str, out: str, default=None, fallback: bool = False) -> DataFrame:
    """``df`` with ``out`` looked up; unmatched keys give ``default``, or with ``fallback`` the key itself."""
    t = table.select(F.col(f"`{table_key}`").alias("__k"), F.col(f"`{table_value}`").alias("__v"))
    got = df.join(t, F.col(f"`{key}`") == F.col("__k"), "left")
    other = F.col(f"`{key}`") if fallback else F.lit(default)
    return got.withColumn(out, F.coalesce("__v", other)).drop("__k", "__v")


def lookup_strict(df: DataFrame, key: str, table: DataFrame, table_key: str, table_value: str, out: str) -> DataFrame:
    """As :func:`lookup`, but a key that is missing from the table raises when the row is read."""
    got = lookup(df, key, table, table_key, table_value, out)
    return got.withColumn(out, F.when(F.col(out).isNull(), F.raise_error(F.concat(F.lit("no entry for "), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("null"))))).otherwise(F.col(out)))


def collapsed(df: DataFrame, name: str, values: dict[str, str], order: str, remove: tuple[str, ...] = ()) -> DataFrame:
    """One row for each cleaned name (bracket groups and the literals ``remove`` off, blanks trimmed): its numbers
    added up, ``n`` rows that came together, and the spelling of the first row by ``order``. Null and empty names are
    left out."""
    d = df.withColumn("__n", clean_name(name, remove)).where("__n <> ''")
    return d.groupBy(F.col("__n").alias("name")).agg(*[F.sum(col(v)).alias(o) for o, v in values.items()], F.count("*").alias("n"), F.min_by(col(name), col(order)).alias("spelling"))


def without(df: DataFrame, name: str, *values: str, cleaned: bool = False) -> DataFrame:
    """``df`` without the rows of the given names, as written or (``cleaned``) after cleaning; null names are kept."""
    n = clean_name(name) if cleaned else col(name)
    return df.where(~F.coalesce(n.isin(*values), F.lit(False)))
