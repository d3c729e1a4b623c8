"""Standardised comparison of entities, their songs and regions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pollweave.functions.semantics import col, nan_to_null, pd_div


def zscore(df: DataFrame, value: str, out: str = "z", by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with the standard score of ``value`` in its partition (population deviation, 0 where it is 0).

    The moments are aggregated and joined back, so a partition is never held in one task.
    """
    stats = df.groupBy(*[col(b) for b in by]).agg(F.avg(col(value)).alias("__m"), F.stddev_pop(col(value)).alias("__s"))
    joined = df.join(stats, list(by)) if by else df.crossJoin(F.broadcast(stats))
    z = F.when(F.col("__s") == 0, F.when(col(value).isNotNull(), 0.0)).otherwise((col(value) - F.col("__m")) / F.when(F.col("__s") != 0, F.col("__s")))
    return joined.withColumn(out, z).drop("__m", "__s")


def share_of_total(df: DataFrame, value: str, out: str, by: tuple[str, ...] = ()) -> DataFrame:
    total = df.groupBy(*[col(b) for b in by]).agg(F.sum(col(value)).alias("__t"))
    joined = df.join(total, list(by)) if by else df.crossJoin(F.broadcast(total))
    return joined.withColumn(out, pd_div(value, "__t")).drop("__t")


def average_by_member(df: DataFrame, members: Column, values: dict[str, str], count: str = "n") -> DataFrame:
    """One row per member of an array column: mean of each value over the rows that list it, and their number."""
    e = df.select(F.explode(members).alias("member"), *[col(v) for v in values.values()]).where("member is not null")
    return e.groupBy("member").agg(*[F.avg(col(v)).alias(o) for o, v in values.items()], F.count("*").alias(count))


def outer_fill(a: DataFrame, b: DataFrame, key: str, fill: float = 0.0, how: str = "full_outer") -> DataFrame:
    """Join on ``key`` keeping unmatched rows, their missing numbers filled."""
    return a.join(b, key, how).fillna(fill)


def xor_outliers(df: DataFrame, a: str, b: str, bound: float) -> DataFrame:
    """Rows of which exactly one of two scores is beyond the bound; a null score is within it."""
    far = lambda c: F.coalesce(F.abs(col(c)) > bound, F.lit(False))
    return df.where(far(a) != far(b))


def ratio_impact(df: DataFrame, x: str, y: str, mean: str, bound: float, out: str = "ratio") -> DataFrame:
    """Rows with ``abs((x / y) / mean - 1) > bound``: 1/0 is kept, 0/0 and unknown means are not."""
    r = pd_div(x, y)
    dev = F.abs(pd_div(r, mean) - 1)
    same_inf = (F.abs(r) == float("inf")) & (F.abs(col(mean).cast("double")) == float("inf"))
    return df.withColumn(out, r).where(F.coalesce(nan_to_null(dev) > bound, F.lit(False)) & ~F.coalesce(same_inf, F.lit(False)))


def pivot_mean(df: DataFrame, keys: list[str], pivot: str, values: list[str], measure: str) -> DataFrame:
    """Mean of ``measure`` by ``keys``, one column per pivot value; null keys and null measures are dropped."""
    d = df.dropna(subset=[*keys, pivot, measure])
    return d.groupBy(*[col(k) for k in keys]).pivot(pivot, values).agg(F.avg(col(measure)))


def only_in(a: DataFrame, b: DataFrame, *keys: str) -> DataFrame:
    """Distinct keys of ``a`` that ``b`` lacks; nulls compare equal."""
    return a.select(*[col(k) for k in keys]).subtract(b.select(*[col(k) for k in keys]))


def average_rank(df: DataFrame, value: str, out: str) -> DataFrame:
    """``df`` with the rank of ``value`` (1 = smallest), ties sharing their mean rank; nulls have none.

    Distinct values are counted first, so only those are ordered. Their running total is built in two
    steps (ranges in parallel, then one row per range), never in a single sorting task.
    """
    counts = df.where(col(value).isNotNull()).groupBy(col(value).alias("__v")).agg(F.count("*").alias("__n"))
    parts = counts.repartitionByRange("__v").withColumn("__p", F.spark_partition_id())
    inner = Window.partitionBy("__p").orderBy("__v")
    parts = parts.withColumn("__c", F.sum("__n").over(inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    size = parts.groupBy("__p").agg(F.sum("__n").alias("__s"))
    before = size.withColumn("__b", F.coalesce(F.sum("__s").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__s")
    ranks = parts.join(F.broadcast(before), "__p").select("__v", (F.col("__b") + F.col("__c") - (F.col("__n") - 1) / 2.0).alias(out))
    return df.join(ranks, col(value) == F.col("__v"), "left").drop("__v")


def ordered(df: DataFrame, by: tuple[tuple[str, bool], ...], out: str) -> DataFrame:
    """``df`` with the place (from 1) of each row in the order of ``by``: columns and whether they ascend, nulls last.

    The order is made of ranges sorted in parallel; only the number of rows of each range is summed in one place. Rows
    equal in all columns have places of their own, in no fixed order.
    """
    keys = [F.col(f"`{c}`").asc_nulls_last() if up else F.col(f"`{c}`").desc_nulls_last() for c, up in by]
    parts = df.repartitionByRange(*keys).withColumn("__p", F.spark_partition_id())
    parts = parts.withColumn("__i", F.row_number().over(Window.partitionBy("__p").orderBy(*keys)))
    size = parts.groupBy("__p").agg(F.count("*").alias("__s"))
    before = size.select("__p", F.coalesce(F.sum("__s").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__b"))
    return parts.join(F.broadcast(before), "__p").withColumn(out, (F.col("__b") + F.col("__i")).cast("bigint")).drop("__p", "__i", "__b")


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row ``(rho, n)`` of the rows where both are known; rho is null for fewer than 2 rows or a constant."""
    d = df.select(col(x).cast("double").alias("__x"), col(y).cast("double").alias("__y")).dropna()
    r = average_rank(average_rank(d, "__x", "rx"), "__y", "ry")
    a = r.agg(F.count("*").alias("n"), F.covar_pop("rx", "ry").alias("c"), F.stddev_pop("rx").alias("sx"), F.stddev_pop("ry").alias("sy"))
    return a.select(F.when((F.col("sx") != 0) & (F.col("sy") != 0), F.col("c") / F.when(F.col("sx") * F.col("sy") != 0, F.col("sx") * F.col("sy"))).alias("rho"), "n")


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 300):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + step / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-14:
            break
    return h


def spearman_p(rho: float | None, n: int) -> float | None:
    """Two-sided p-value of a rank correlation by the t distribution with n - 2 degrees of freedom."""
    if rho is None or n < 3:
        return None
    if abs(rho) >= 1:
        return 0.0
    df = n - 2
    x = df / (df + rho * rho * df / (1 - rho * rho))
    a, b = df / 2, 0.5
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) if 0 < x < 1 else 0.0
    return front * _beta_fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * _beta_fraction(b, a, 1 - x) / b


def with_p_value(result: DataFrame, level: float = 0.05) -> DataFrame:
    """``(rho, n, p_value, significant)`` of a :func:`spearman` result."""
    p = F.udf(spearman_p, "double")
    return result.withColumn("p_value", p("rho", "n")).withColumn("significant", F.col("p_value") < level)
