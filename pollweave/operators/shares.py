"""Vote shares: of the top entities, of groups, of single entities, and between regions.

Numerators come from the enriched table, denominators from the raw one, so a vote for something outside
the dimension still counts in the total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pollweave.functions.scalars import percent, session_number, session_order
from pollweave.functions.semantics import col, require_columns, sum0


def totals(raw: DataFrame, session: str, votes: str, out: str = "total") -> DataFrame:
    """Votes per session; unreadable and null votes count 0."""
    require_columns(raw, session, votes)
    return raw.groupBy(col(session)).agg(sum0(col(votes).try_cast("bigint")).alias(out))


def last_session(df: DataFrame, session: str) -> DataFrame:
    """The rows of the latest session: all names with the largest leading number (``20`` and ``20 (a, b)`` are
    one session); where no name has a number, the last name. Rows with a null session are left out."""
    top = df.agg(F.max(session_order(session)).alias("__o"))
    same = (F.col("__o.no") >= 0) & (session_number(session) == F.col("__o.no")) | (F.col("__o.no") < 0) & (col(session) == F.col("__o.name"))
    return df.join(F.broadcast(top), same, "inner").drop("__o")


def checked_totals(raw: DataFrame, session: str, votes: str, out: str = "total") -> DataFrame:
    """:func:`totals`, but a session whose total is 0 raises when its row is read."""
    t = totals(raw, session, votes, out)
    return t.withColumn(out, F.when(F.col(out) != 0, F.col(out)).otherwise(F.raise_error(F.concat(F.lit("no votes in session "), F.coalesce(col(session).cast("string"), F.lit("null"))))))


def topn_share(grouped: DataFrame, raw: DataFrame, session: str, votes: str, n: int, order: tuple[str, ...] = ()) -> DataFrame:
    """``(session, top_votes, total, share)``: percentage of all votes that the ``n`` largest rows have.

    The sum does not depend on how ties are broken; sessions with a total of 0 are left out.
    """
    w = Window.partitionBy(col(session)).orderBy(col(votes).desc_nulls_last(), *[col(o) for o in order])
    top = grouped.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).groupBy(col(session)).agg(sum0(votes).alias("top_votes"))
    return top.join(totals(raw, session, votes), session).where("total <> 0").select(col(session), "top_votes", "total", percent("top_votes", "total").alias("share"))


def group_share(grouped: DataFrame, raw: DataFrame, session: str, group: str, votes: str) -> DataFrame:
    """``(session, group, votes, share)``; rows without a group are left out, as are sessions without votes."""
    g = grouped.dropna(subset=[group]).groupBy(col(session), col(group)).agg(sum0(votes).alias("votes"))
    return g.join(totals(raw, session, votes), session).where("total <> 0").select(col(session), col(group), "votes", percent("votes", "total").alias("share"))


def entity_share(df: DataFrame, session: str, entity: str, votes: str, order: str, names: list[str] | None = None) -> DataFrame:
    """``(session, entity, votes, share)`` of the first row (by ``order``) of each entity and session;
    entities without votes are left out. ``names`` restricts the result, not the totals."""
    d = df.dropna(subset=[entity])
    if names is not None:
        d = d.where(col(entity).isin(names))
    first = d.groupBy(col(session), col(entity)).agg(F.min_by(col(votes), col(order)).alias("votes")).where("votes <> 0")
    return first.join(totals(df, session, votes), session).where("total <> 0").select(col(session), col(entity), "votes", percent("votes", "total").alias("share"))


def share_difference(a: DataFrame, b: DataFrame, entity: str, votes: str, order: str) -> DataFrame:
    """``(entity, share_a, share_b, difference)`` of the entities in both tables, in percent points."""

    def side(df: DataFrame, tag: str) -> DataFrame:
        total = df.agg(sum0(votes).alias("__t"))
        s = df.dropna(subset=[entity]).groupBy(col(entity)).agg(F.min_by(col(votes), col(order)).alias("__v")).where("__v <> 0")
        return s.crossJoin(F.broadcast(total)).where("__t <> 0").select(col(entity), (F.col("__v") / F.col("__t") * 100).alias(f"share_{tag}"))

    j = side(a, "a").join(side(b, "b"), entity)
    return j.select(col(entity), F.bround("share_a", 2).alias("share_a"), F.bround("share_b", 2).alias("share_b"), (F.bround(F.col("share_a") - F.col("share_b"), 2) + F.lit(0.0)).alias("difference"))
