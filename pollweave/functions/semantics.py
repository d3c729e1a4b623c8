"""Null, NaN, rounding and cast rules that every analysis relies on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def pd_div(a: str | Column, b: str | Column) -> Column:
    """Float division in which x/0 is infinite with the sign of x, and 0/0 or a null side is null."""
    a, b = col(a).cast("double"), col(b).cast("double")
    inf = F.lit(float("inf"))
    return F.when(b != 0, a / F.when(b != 0, b)).when((b == 0) & (a > 0), inf).when((b == 0) & (a < 0), -inf)


def nan_to_null(c: str | Column) -> Column:
    c = col(c)
    return F.when(~F.isnan(c), c)


def half_even(c: str | Column, digits: int = 2) -> Column:
    return F.bround(col(c), digits)


def ustrip(c: str | Column) -> Column:
    """Trims Unicode white space."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def to_int(c: str | Column) -> Column:
    """Tolerant whole number: numbers are cut towards zero, unreadable text is null."""
    return col(c).try_cast("bigint")


def to_float(c: str | Column) -> Column:
    return nan_to_null(col(c).try_cast("double"))


def clean_str(c: str | Column) -> Column:
    """Text of a number without a needless fraction: 6.0 -> '6', 5.5 -> '5.5'."""
    c = col(c).cast("double")
    return F.when(c == F.floor(c), c.cast("bigint").cast("string")).otherwise(c.cast("string"))


def sum0(c: str | Column) -> Column:
    """Sum that skips nulls; 0 of nothing."""
    return F.coalesce(F.sum(col(c)), F.lit(0))


def positive_or_null(c: str | Column) -> Column:
    c = col(c)
    return F.when(c > 0, c)


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """Fails before planning if a column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def assert_unique(df: DataFrame, *keys: str) -> DataFrame:
    """Fails if a key occurs on several rows (many-to-one joins need it); null keys do not count."""
    clash = df.dropna(subset=list(keys)).groupBy(*[col(k) for k in keys]).count().where("count > 1").limit(1).collect()
    if clash:
        raise ValueError(f"key {keys} is not unique: {clash[0]}")
    return df


def assert_not_empty(df: DataFrame, what: str = "result") -> DataFrame:
    """Fails if there is no row."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def assert_has(df: DataFrame, column: str, value: object, what: str = "value") -> DataFrame:
    """Fails if no row has the value, such as a session that was asked for; the message names those that there are."""
    if df.where(col(column) == value).isEmpty():
        there = [r[0] for r in df.select(col(column)).distinct().orderBy(col(column)).limit(20).collect()]
        raise ValueError(f"no {what} {value!r}; there are {there}")
    return df


def strict_int(c: str | Column) -> Column:
    """Whole number of a text that must be one; anything else raises when the row is read, null stays null."""
    c = col(c)
    n = c.cast("string").try_cast("bigint")
    return F.when(c.isNotNull() & n.isNull(), F.raise_error(F.concat(F.lit("no whole number: "), c.cast("string")))).otherwise(n)


def strip_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])
