"""Tags of entities: support, relative weight per session, ranking and differences."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pollweave.functions.scalars import session_number
from pollweave.functions.semantics import col, sum0


def support(entity_tags: DataFrame, tag: str = "tag", entity: str = "entity", least: int = 2) -> DataFrame:
    """``(tag, n_entities)`` of the tags that at least ``least`` different entities have."""
    return entity_tags.groupBy(col(tag)).agg(F.countDistinct(col(entity)).alias("n_entities")).where(F.col("n_entities") >= least)


def exclusions(results: DataFrame, entity: str, session: str, rank: str, boundary: int, region: str | None = None) -> DataFrame:
    """``(entity, session number[, region])`` ranked at the boundary or better. Without ``region`` an exclusion
    in one region holds for the session of the same number in every region. Null ranks exclude nothing."""
    keys = [col(entity), session_number(session).alias("session_no")] + ([col(region)] if region else [])
    return results.where(col(rank) <= boundary).select(*keys).distinct()


def eligible(results: DataFrame, place: str, boundary: int) -> DataFrame:
    """``(entity, region, session_no, votes)`` of the entities that no region ranks at the boundary or better in the
    session of that number: what :func:`exclusions` takes off, but from one pass, as places are combined with the votes
    before anything is compared. Null places exclude nothing; null entities are left out."""
    per = results.dropna(subset=["entity"]).groupBy("entity", "region", "session_no").agg(sum0("votes").alias("votes"), F.min(col(place)).alias("__p"))
    best = F.min("__p").over(Window.partitionBy("entity", "session_no"))
    return per.withColumn("__b", best).where(F.coalesce(F.col("__b") > boundary, F.lit(True))).drop("__p", "__b")


def relative_heat(results: DataFrame, entity_tags: DataFrame, excluded: DataFrame | None = None, least: int = 2) -> DataFrame:
    """``(tag, region, session_no, heat)``: the share of the votes of eligible entities that entities with the
    tag have, for every supported tag and every session of every region (0 where it has none).

    ``results``: ``entity, region, session_no, votes``; ``entity_tags``: ``entity, tag``. ``excluded`` is
    taken off by its columns before shares and totals. Tags, sessions and regions are dimensions, so the
    dense grid stays small; the votes themselves are aggregated by entity first and exploded by tag after.
    """
    r = results.dropna(subset=["entity"])
    if excluded is not None:
        r = r.join(excluded, excluded.columns, "left_anti")
    per = r.groupBy("entity", "region", "session_no").agg(sum0("votes").alias("votes"))
    total = per.groupBy("region", "session_no").agg(F.sum("votes").alias("total"))
    pairs = entity_tags.dropna().distinct().withColumn("__n", F.count("*").over(Window.partitionBy("tag"))).where(F.col("__n") >= least).drop("__n")
    kept = pairs.select("tag").distinct()
    sums = per.join(pairs, "entity").groupBy("tag", "region", "session_no").agg(F.sum("votes").alias("votes"))
    grid = kept.crossJoin(F.broadcast(total))
    out = grid.join(sums, ["tag", "region", "session_no"], "left")
    heat = F.when(F.col("total") > 0, F.coalesce("votes", F.lit(0)) / F.when(F.col("total") > 0, F.col("total"))).otherwise(0.0)
    return out.select("tag", "region", "session_no", heat.alias("heat"))


def ranked(heat: DataFrame) -> DataFrame:
    """``heat`` with ``rank`` in its region and session: largest first, ties by tag."""
    w = Window.partitionBy("region", "session_no").orderBy(F.desc("heat"), "tag")
    return heat.withColumn("rank", F.row_number().over(w).cast("bigint"))


def top(ranked_heat: DataFrame, region: str, session_no: int, n: int) -> DataFrame:
    """The first ``n`` tags of one session; a session that is not there gives no rows."""
    return ranked_heat.where((F.col("region") == region) & (F.col("session_no") == session_no) & (F.col("rank") <= n))


def across_sessions(heat: DataFrame, tag: str) -> DataFrame:
    """One tag over all sessions, densified with 0."""
    sessions = heat.select("region", "session_no").distinct()
    own = heat.where(F.col("tag") == tag)
    return sessions.join(own.drop("tag"), ["region", "session_no"], "left").select(F.lit(tag).alias("tag"), "region", "session_no", F.coalesce("heat", F.lit(0.0)).alias("heat"))


def difference(heat: DataFrame, a: tuple[str, int], b: tuple[str, int], least: float = 0.0, n: int = 0) -> DataFrame:
    """``(tag, a, b, difference, sign)`` of two sessions, largest absolute difference first, ties by tag;
    a tag missing from one side counts 0 there. ``n`` <= 0 gives all."""
    side = lambda s, name: heat.where((F.col("region") == s[0]) & (F.col("session_no") == s[1])).select("tag", F.col("heat").alias(name))
    j = side(a, "a").join(side(b, "b"), "tag", "full_outer").select("tag", F.coalesce("a", F.lit(0.0)).alias("a"), F.coalesce("b", F.lit(0.0)).alias("b"))
    j = j.withColumn("difference", F.col("a") - F.col("b")).where(F.abs("difference") >= least)
    j = j.withColumn("sign", F.when(F.col("difference") < 0, "negative").otherwise("positive"))
    return j.orderBy(F.desc(F.abs("difference")), "tag").limit(n) if n > 0 else j


def to_json(ranked_heat: DataFrame) -> DataFrame:
    """``(region, session_no, json)``: the document ``{session: [[tag, value], ...]}`` of each session, largest first.
    The sessions of a region side by side are the region's document; a row holds the tags of one session only."""
    pair = F.array(F.col("tag"), F.col("heat").cast("string"))
    per = ranked_heat.groupBy("region", "session_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", pair.alias("p")))), lambda x: x["p"]).alias("pairs"))
    return per.select("region", "session_no", F.to_json(F.create_map(F.col("session_no").cast("string"), F.col("pairs"))).alias("json"))


def from_json(docs: DataFrame, column: str, *keys: str) -> DataFrame:
    """``(keys, session_no, tag, heat)`` of documents written by :func:`to_json`, or of whole regions; unreadable
    documents give no rows."""
    m = docs.select(*[col(k) for k in keys], F.from_json(col(column), "map<string,array<array<string>>>").alias("m")).select(*[col(k) for k in keys], F.explode("m").alias("session", "pairs"))
    p = m.select(*[col(k) for k in keys], F.col("session").cast("bigint").alias("session_no"), F.explode("pairs").alias("p"))
    return p.select(*[col(k) for k in keys], "session_no", F.get("p", F.lit(0)).alias("tag"), F.get("p", F.lit(1)).try_cast("double").alias("heat"))
