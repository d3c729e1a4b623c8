"""Queries of the poll analyses over the vote tables, each with the SQL it must equal.

Regions: ``jp`` is char_votes_jp / music_votes_jp, ``cn`` is char_votes_cn / music_votes_cn. All queries
read whole tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollweave.functions import scalars as S
from pollweave.functions import semantics as M
from pollweave.operators import document, enrich, packed, relate, shares, tags
from pollweave.plans.general import members_sql
from pollweave.sources import sinks
from pollweave.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        QUERIES[name or f.__name__] = f
        if sql:
            SQL[name or f.__name__] = sql
        return f

    return add


def _jp(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "char_votes_jp")


def _cn(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "char_votes_cn")


def _grouped(spark: SparkSession, d: str, above: float | None = 5.0) -> DataFrame:
    return enrich.enrich_votes(_jp(spark, d), table(spark, d, "char_dim"), "日文名", "首次出现作品", above)


# enrichment

_GROUPED = """grouped as (select v.*, d.first_work as "首次出现作品" from char_votes_jp v join (select "日文名", "首次出现作品" as first_work from char_dim where "首次出现作品" > 5) d on v."日文名" = d."日文名")"""


@query(f'with {_GROUPED} select row_id, session, "日文名", "票数", "首次出现作品" from grouped')
def enrich_filter(spark: SparkSession, d: str) -> DataFrame:
    return _grouped(spark, d).select("row_id", "session", "日文名", "票数", "首次出现作品")


@query("""select row_id, session, "日文名", "首次出现作品" as work from char_votes_jp join (select "日文名", "首次出现作品" from char_dim where "首次出现作品" is not null) using ("日文名")""")
def enrich_all_works(spark: SparkSession, d: str) -> DataFrame:
    return _grouped(spark, d, None).select("row_id", "session", "日文名", F.col("首次出现作品").alias("work"))


def _title_sql(c: str) -> str:
    return f"""regexp_replace(regexp_replace(regexp_replace({c}, '[～~].*$', ''), '\\([^)]*\\)|（[^）]*）', '', 'g'), '^[\\s\\x{{3000}}]+|[\\s\\x{{3000}}]+$', '', 'g')"""


@query(
    f"""with songs as (select row_id, {_title_sql('"曲目"')} as k, "译名" as tr, "所属角色" as chars from song_dim where "曲目" is not null and "译名" is not null and "所属角色" is not null),
    firsts as (select k, tr, chars from songs where row_id in (select min(row_id) from songs group by k))
    select v.row_id, u.tr as title, u.chars as members from music_votes_jp v join firsts u on {_title_sql('v."曲目"')} = u.k"""
)
def enrich_normalized_title(spark: SparkSession, d: str) -> DataFrame:
    """Songs by normalised title; where a title stands on two rows of the dimension its first row counts."""
    dim = table(spark, d, "song_dim", "row_id", "曲目", "译名", "所属角色")
    out = enrich.enrich_songs(table(spark, d, "music_votes_jp", "row_id", "曲目"), dim, "曲目", ["译名", "所属角色"], order="row_id")
    return out.select("row_id", F.col("译名").alias("title"), F.col("所属角色").alias("members"))


@query(f"""select {_title_sql('"曲目"')} as title, cast(count(*) as bigint) as n from song_dim where "曲目" is not null group by 1 having count(*) > 1""")
def title_clashes(spark: SparkSession, d: str) -> DataFrame:
    return enrich.title_clashes(table(spark, d, "song_dim", "曲目"), "曲目")


@query("""select row_id, "日文名", d.work from char_votes_jp join (select "日文名", "首次出现作品" as work from char_dim where "首次出现作品" >= 6) d using ("日文名")""")
def enrich_from_work(spark: SparkSession, d: str) -> DataFrame:
    """The bound that includes its value: works from number 6 on."""
    out = enrich.enrich_votes(_jp(spark, d), table(spark, d, "char_dim"), "日文名", "首次出现作品", None, 6.0)
    return out.select("row_id", "日文名", F.col("首次出现作品").alias("work"))


# shares

for _n in (7, 15, 30):

    def _topn(spark: SparkSession, d: str, n: int = _n) -> DataFrame:
        return shares.topn_share(_grouped(spark, d), _jp(spark, d), "session", "票数", n, ("row_id",))

    query(
        f"""with {_GROUPED}, t as (select session, cast(sum(coalesce("票数", 0)) as bigint) as total from char_votes_jp group by 1),
        r as (select session, "票数" as v, row_number() over (partition by session order by "票数" desc nulls last, row_id) as rn from grouped),
        s as (select session, cast(sum(coalesce(v, 0)) as bigint) as top_votes from r where rn <= {_n} group by 1)
        select session, top_votes, total, round_even(cast(top_votes as double) / total * 100, 2) as share from s join t using (session) where total <> 0""",
        f"topn_share_{_n}",
    )(_topn)


@query(
    f"""with {_GROUPED}, t as (select session, cast(sum(coalesce("票数", 0)) as bigint) as total from char_votes_jp group by 1),
    g as (select session, "首次出现作品" as work, cast(sum(coalesce("票数", 0)) as bigint) as votes from grouped group by 1, 2)
    select session, work, votes, round_even(cast(votes as double) / total * 100, 2) as share from g join t using (session) where total <> 0"""
)
def work_share_trend(spark: SparkSession, d: str) -> DataFrame:
    return shares.group_share(_grouped(spark, d), _jp(spark, d), "session", "首次出现作品", "票数").withColumnRenamed("首次出现作品", "work")


_ENTITY = """with t as (select session, cast(sum(coalesce("票数", 0)) as bigint) as total from {t} group by 1),
e as (select session, "{k}" as name, arg_min("票数", row_id) filter (where "票数" is not null or true) as v0, min(row_id) as r from {t} where "{k}" is not null group by 1, 2),
f as (select e.session, e.name, v."票数" as votes from e join {t} v on v.row_id = e.r where v."票数" <> 0)
select session, name, votes, round_even(cast(votes as double) / total * 100, 2) as share from f join t using (session) where total <> 0"""


@query(_ENTITY.format(t="char_votes_jp", k="日文名"))
def entity_share_trend(spark: SparkSession, d: str) -> DataFrame:
    return shares.entity_share(_jp(spark, d), "session", "日文名", "票数", "row_id").withColumnRenamed("日文名", "name")


@query(_ENTITY.format(t="char_votes_cn", k="译名"))
def entity_share_trend_cn(spark: SparkSession, d: str) -> DataFrame:
    return shares.entity_share(_cn(spark, d), "session", "译名", "票数", "row_id").withColumnRenamed("译名", "name")


_NUM = lambda c: f"nullif(regexp_extract({c}, '^(\\d+)', 1), '')"


def _last_sql(t: str) -> str:
    return f"""(select * from {t} where cast({_NUM('session')} as bigint) = (select max(cast({_NUM('session')} as bigint)) from {t}))"""


@query(
    f"""with a as {_last_sql('char_votes_cn')}, b as {_last_sql('char_votes_jp')},
    sa as (select "译名" as name, cast("票数" as double) / (select sum(coalesce("票数", 0)) from a) * 100 as s from a where row_id in (select min(row_id) from a where "译名" is not null group by "译名") and "票数" <> 0),
    sb as (select "译名" as name, cast("票数" as double) / (select sum(coalesce("票数", 0)) from b) * 100 as s from b where row_id in (select min(row_id) from b where "译名" is not null group by "译名") and "票数" <> 0)
    select name, round_even(sa.s, 2) as share_a, round_even(sb.s, 2) as share_b, round_even(sa.s - sb.s, 2) + 0.0 as difference from sa join sb using (name)"""
)
def region_share_diff(spark: SparkSession, d: str) -> DataFrame:
    """The latest sessions (by number) of both regions compared."""
    last = lambda df: shares.last_session(df.select("row_id", "session", "译名", "票数"), "session")
    return shares.share_difference(last(_cn(spark, d)), last(_jp(spark, d)), "译名", "票数", "row_id").withColumnRenamed("译名", "name")


@query(f"""select 'cn' as region, session, cast(count(*) as bigint) as n from {_last_sql('char_votes_cn')} group by 2 union all select 'jp', session, cast(count(*) as bigint) from {_last_sql('char_votes_jp')} group by 2""")
def last_session_rows(spark: SparkSession, d: str) -> DataFrame:
    """The names under which the latest session of each region comes, with their rows."""
    one = lambda df, r: shares.last_session(df.select("session"), "session").groupBy("session").agg(F.count("*").alias("n")).select(F.lit(r).alias("region"), "session", "n")
    return one(_cn(spark, d), "cn").unionByName(one(_jp(spark, d), "jp"))


@query("""select session, cast(sum(coalesce(try_cast("票数" as bigint), 0)) as bigint) as total from char_votes_jp group by 1""")
def session_totals_tolerant(spark: SparkSession, d: str) -> DataFrame:
    return shares.totals(_jp(spark, d), "session", "票数")


@query(
    """with s as (select session, sum(coalesce("男性", 0)) as m, sum(coalesce("女性", 0)) as f, sum(case when "偏原作" > "偏二次" then "票数" else 0 end) as o from music_votes_cn group by 1)
    select session, cast(case when m > 0 then m end as bigint) as male, cast(case when f > 0 then f end as bigint) as female, cast(case when o > 0 then o end as bigint) as original from s"""
)
def conditional_sums(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "music_votes_cn", "session", "票数", "男性", "女性", "偏原作", "偏二次")
    s = v.groupBy("session").agg(M.sum0("男性").alias("m"), M.sum0("女性").alias("f"), M.sum0(F.when(F.col("偏原作") > F.col("偏二次"), F.col("票数"))).alias("o"))
    return s.select("session", M.positive_or_null("m").alias("male"), M.positive_or_null("f").alias("female"), M.positive_or_null("o").alias("original"))


# joins with defaults, semi and anti joins


@query("""select d."译名" as name, cast(coalesce(sum(v."票数"), 0) as bigint) as votes from (select distinct "译名" from char_dim) d left join char_votes_cn v using ("译名") group by 1""")
def left_join_fill(spark: SparkSession, d: str) -> DataFrame:
    v = _cn(spark, d).groupBy("译名").agg(F.sum("票数").alias("votes"))
    return relate.outer_fill(table(spark, d, "char_dim", "译名").distinct(), v, "译名", 0, "left").withColumnRenamed("译名", "name")


_LAST = """lookup as (select "日文名" as k, max("译名") as v from char_dim group by 1)"""


@query(f"""with {_LAST} select row_id, coalesce(v, "日文名") as name from char_votes_jp left join lookup on "日文名" = k""")
def map_lookup_fallback(spark: SparkSession, d: str) -> DataFrame:
    lookup = enrich.last_wins(table(spark, d, "char_dim").withColumn("o", F.col("译名")), "日文名", "译名", "o")
    return enrich.lookup(_jp(spark, d).select("row_id", "日文名"), "日文名", lookup, "日文名", "译名", "name", fallback=True).select("row_id", "name")


@query(f"""with {_LAST} select row_id, coalesce(v, 'unknown') as name from char_votes_jp left join lookup on "日文名" = k""")
def map_lookup_default(spark: SparkSession, d: str) -> DataFrame:
    lookup = enrich.last_wins(table(spark, d, "char_dim").withColumn("o", F.col("译名")), "日文名", "译名", "o")
    return enrich.lookup(_jp(spark, d).select("row_id", "日文名"), "日文名", lookup, "日文名", "译名", "name", default="unknown").select("row_id", "name")


@query(f"select row_id, session from char_votes_jp where {_NUM('session')} in (select {_NUM('session')} from char_votes_cn)")
def semi_sessions(spark: SparkSession, d: str) -> DataFrame:
    n = S.session_number("session").alias("no")
    return _jp(spark, d).select("row_id", "session", n).join(_cn(spark, d).select(n).distinct(), "no", "left_semi").select("row_id", "session")


@query(
    f"""with x as (select distinct "译名" as name, {_NUM('session')} as no from char_votes_cn where "名次" <= 3)
    select row_id from char_votes_jp v where not exists (select 1 from x where x.name = v."译名" and x.no = {_NUM('v.session')})"""
)
def anti_excluded(spark: SparkSession, d: str) -> DataFrame:
    x = tags.exclusions(_cn(spark, d), "译名", "session", "名次", 3)
    return _jp(spark, d).select("row_id", "译名", S.session_number("session").alias("session_no")).join(x, ["译名", "session_no"], "left_anti").select("row_id")


@query("""select distinct session from char_votes_jp where session not in (select session from char_votes_cn)""")
def sessions_missing(spark: SparkSession, d: str) -> DataFrame:
    return document.sessions_without(_jp(spark, d), _cn(spark, d), "session")


# standard scores, averages, correlation, regions


@query(
    """with v as (select row_id, '日' as region, session, cast("票数" as double) as x from char_votes_jp), s as (select session, avg(x) as m, stddev_pop(x) as sd from v group by 1)
    select row_id, v.session, round(case when sd = 0 then case when x is not null then 0.0 end else (x - m) / sd end, 6) as z from v join s using (session)"""
)
def zscore(spark: SparkSession, d: str) -> DataFrame:
    v = _jp(spark, d).select("row_id", "session", F.col("票数").cast("double").alias("x"))
    return relate.zscore(v, "x", "z", ("session",)).select("row_id", "session", F.round("z", 6).alias("z"))


def _entities(spark: SparkSession, d: str) -> DataFrame:
    return _jp(spark, d).dropna(subset=["日文名"]).groupBy(F.col("日文名").alias("name")).agg(F.avg("票数").alias("votes"), F.avg("评论数").alias("comments"))


_ENT = """e as (select "日文名" as name, avg("票数") as votes, avg("评论数") as comments from char_votes_jp where "日文名" is not null group by 1),
m as (select avg(votes) as mv, stddev_pop(votes) as sv, avg(comments) as mc, stddev_pop(comments) as sc from e),
z as (select name, (votes - mv) / nullif(sv, 0) as zv, (comments - mc) / nullif(sc, 0) as zc from e, m)"""


@query(
    f"""with {_ENT} select name, round(zv, 6) as z_votes, round(zc, 6) as z_comments, case when abs(zv) > 1 then 'first' else 'second' end as reason
    from z where coalesce(abs(zv) > 1, false) <> coalesce(abs(zc) > 1, false)"""
)
def xor_outliers(spark: SparkSession, d: str) -> DataFrame:
    z = relate.zscore(relate.zscore(_entities(spark, d), "votes", "zv"), "comments", "zc")
    return relate.xor_outliers(z, "zv", "zc", 1.0).select("name", F.round("zv", 6).alias("z_votes"), F.round("zc", 6).alias("z_comments"), S.outlier_reason("zv", "zc", 1.0).alias("reason"))


_SPEARMAN = """r as (select rank() over (order by votes) + (count(*) over (partition by votes) - 1) / 2.0 as rx, rank() over (order by comments) + (count(*) over (partition by comments) - 1) / 2.0 as ry from e where votes is not null and comments is not null)"""


@query(f"with {_ENT}, {_SPEARMAN} select round(corr(rx, ry), 6) as rho, cast(count(*) as bigint) as n from r")
def spearman(spark: SparkSession, d: str) -> DataFrame:
    return relate.spearman(_entities(spark, d), "votes", "comments").select(F.round("rho", 6).alias("rho"), "n")


@query()
def spearman_pvalue(spark: SparkSession, d: str) -> DataFrame:
    return relate.with_p_value(relate.spearman(_entities(spark, d), "votes", "comments"))


_MEMBERS = members_sql("music_votes_jp")


def _songs_with_members(spark: SparkSession, d: str, songs: DataFrame, *values: str) -> DataFrame:
    """``(row_id, values, val)``: a row for each character that a song's field names, by the grammar of packed fields."""
    known = packed.known_names(table(spark, d, "char_dim", "译名"), "译名")
    return packed.split_packed(songs, "所属角色", ["row_id", *values], known).select("row_id", *values, "val")


@query(f"""with {_MEMBERS} select member, round(avg(cast("得票数" as double)), 6) as mean_votes, round(avg(cast("评论数" as double)), 6) as mean_comments, cast(count(*) as bigint) as n from music_votes_jp join member on f = "所属角色" where member <> '' group by 1""")
def explode_avg(spark: SparkSession, d: str) -> DataFrame:
    v = _songs_with_members(spark, d, table(spark, d, "music_votes_jp", "row_id", "所属角色", "得票数", "评论数"), "得票数", "评论数")
    m = relate.average_by_member(v, F.array("val"), {"mean_votes": "得票数", "mean_comments": "评论数"})
    return m.select("member", F.round("mean_votes", 6).alias("mean_votes"), F.round("mean_comments", 6).alias("mean_comments"), "n")


_REGIONS = """u as (select 'jp' as region, session, "译名" as name, "票数" as votes from char_votes_jp union all select 'cn', session, "译名", "票数" from char_votes_cn)"""


def _regions(spark: SparkSession, d: str) -> DataFrame:
    side = lambda df, r: df.select(F.lit(r).alias("region"), "session", F.col("译名").alias("name"), F.col("票数").alias("votes"))
    return side(_jp(spark, d), "jp").unionByName(side(_cn(spark, d), "cn"))


@query(f"with {_REGIONS} select region, session, name, votes from u")
def union_regions(spark: SparkSession, d: str) -> DataFrame:
    return _regions(spark, d)


@query(
    f"""with {_REGIONS}, p as (select name, avg(votes) filter (where region = 'cn') as cn, avg(votes) filter (where region = 'jp') as jp from u where name is not null and votes is not null group by 1)
    select name, round(coalesce(cn, 0), 6) as cn, round(coalesce(jp, 0), 6) as jp, round(coalesce(cn, 0) - coalesce(jp, 0), 6) as difference from p"""
)
def pivot_region_diff(spark: SparkSession, d: str) -> DataFrame:
    p = relate.pivot_mean(_regions(spark, d), ["name"], "region", ["cn", "jp"], "votes").fillna(0.0, ["cn", "jp"])
    return p.select("name", F.round("cn", 6).alias("cn"), F.round("jp", 6).alias("jp"), F.round(F.col("cn") - F.col("jp"), 6).alias("difference"))


@query(
    f"""with {_REGIONS}, p as (select name, coalesce(sum(votes) filter (where region = 'cn'), 0) as x, coalesce(sum(votes) filter (where region = 'jp'), 0) as y from u where name is not null group by 1),
    m as (select sum(votes) filter (where region = 'cn') / cast(sum(votes) filter (where region = 'jp') as double) as mean from u where name is not null),
    r as (select name, x, y, mean, case when y <> 0 then x / cast(y as double) when x > 0 then cast('inf' as double) end as ratio from p, m)
    select name, cast(x as bigint) as cn, cast(y as bigint) as jp, case when isinf(ratio) then ratio else round(ratio, 6) end as ratio from r where ratio is not null and mean <> 0 and abs(ratio / mean - 1) > 0.5"""
)
def outer_join_ratio_impact(spark: SparkSession, d: str) -> DataFrame:
    side = lambda df, o: df.dropna(subset=["译名"]).groupBy(F.col("译名").alias("name")).agg(M.sum0("票数").alias(o))
    j = relate.outer_fill(side(_cn(spark, d), "cn"), side(_jp(spark, d), "jp"), "name", 0)
    mean = j.agg(M.pd_div(F.sum("cn"), F.sum("jp")).alias("mean"))
    r = relate.ratio_impact(j.crossJoin(F.broadcast(mean)), "cn", "jp", "mean", 0.5)
    return r.select("name", "cn", "jp", F.round("ratio", 6).alias("ratio"))


@query("""select "译名" as title from music_votes_cn except select "译名" from music_votes_jp""")
def only_in_region_a(spark: SparkSession, d: str) -> DataFrame:
    return relate.only_in(table(spark, d, "music_votes_cn"), table(spark, d, "music_votes_jp"), "译名").withColumnRenamed("译名", "title")


@query("""select "译名" as title from music_votes_jp except select "译名" from music_votes_cn""")
def only_in_region_b(spark: SparkSession, d: str) -> DataFrame:
    return relate.only_in(table(spark, d, "music_votes_jp"), table(spark, d, "music_votes_cn"), "译名").withColumnRenamed("译名", "title")


_MUSIC = f"""lastc as {_last_sql('char_votes_jp')}, lastm as {_last_sql('music_votes_jp')},
ent as (select "译名" as name, avg("票数") / (select sum("票数") from lastc) as v from lastc where "译名" is not null group by 1),
zc as (select name, (v - (select avg(v) from ent)) / (select nullif(stddev_pop(v), 0) from ent) as zc from ent),
sg as (select "所属角色" as f, cast("得票数" as double) / (select sum("得票数") from lastm) as v from lastm),
zs as (select f, (v - (select avg(v) from sg)) / (select nullif(stddev_pop(v), 0) from sg) as z from sg),
{_MEMBERS}, lookup as (select "日文名" as k, max("译名") as tr from char_dim group by 1),
mem as (select coalesce(tr, member) as name, z from zs join member using (f) left join lookup on k = member where member <> ''),
zm as (select name, avg(z) as zm, count(*) as n from mem group by 1),
both_z as (select zc.name, coalesce(zc, 0) as zc, coalesce(zm, 0) as zm, cast(coalesce(n, 0) as bigint) as n from zc left join zm using (name))"""


def _music(spark: SparkSession, d: str) -> DataFrame:
    """Standard score of each character's share of the latest session's votes and of the songs it appears in; 0
    without songs. Names in the other language are unified by the dimension."""
    share = lambda df, v, o: relate.share_of_total(df, v, o)
    last = lambda t, *c: shares.last_session(table(spark, d, t, "session", *c), "session")
    ent = share(last("char_votes_jp", "译名", "票数"), "票数", "share").dropna(subset=["译名"]).groupBy(F.col("译名").alias("name")).agg(F.avg("share").alias("v"))
    songs = relate.zscore(share(last("music_votes_jp", "row_id", "所属角色", "得票数"), "得票数", "share"), "share", "z")
    v = _songs_with_members(spark, d, songs, "z")
    names = enrich.last_wins(table(spark, d, "char_dim", "日文名", "译名").withColumn("o", F.col("译名")), "日文名", "译名", "o")
    v = enrich.lookup(v, "val", names, "日文名", "译名", "name", fallback=True)
    by = relate.average_by_member(v, F.array("name"), {"zm": "z"}).withColumnRenamed("member", "name")
    return relate.outer_fill(relate.zscore(ent, "v", "zc").drop("v"), by, "name", 0, "left")


@query(f"with {_MUSIC} select name, round(zc, 6) as zc, round(zm, 6) as zm, n, case when abs(zc) > 1 then 'first' else 'second' end as reason from both_z where (abs(zc) > 1) <> (abs(zm) > 1)")
def character_music_outliers(spark: SparkSession, d: str) -> DataFrame:
    out = relate.xor_outliers(_music(spark, d), "zc", "zm", 1.0)
    return out.select("name", F.round("zc", 6).alias("zc"), F.round("zm", 6).alias("zm"), "n", S.outlier_reason("zc", "zm", 1.0).alias("reason"))


@query(f"with {_MUSIC}, q as (select round(zc, 9) as zc, round(zm, 9) as zm from both_z), r as (select rank() over (order by zc) + (count(*) over (partition by zc) - 1) / 2.0 as rx, rank() over (order by zm) + (count(*) over (partition by zm) - 1) / 2.0 as ry from q) select round(corr(rx, ry), 6) as rho, cast(count(*) as bigint) as n from r")
def character_music_spearman(spark: SparkSession, d: str) -> DataFrame:
    # rounded as the grouping of equal scores must not depend on the order of summing
    m = _music(spark, d).select(F.round("zc", 9).alias("zc"), F.round("zm", 9).alias("zm"))
    return relate.spearman(m, "zc", "zm").select(F.round("rho", 6).alias("rho"), "n")


@query(
    """with u as (select 'jp' as region, "译名" as title, cast("得票数" as double) as v from music_votes_jp union all select 'cn', "译名", cast("票数" as double) from music_votes_cn),
    m as (select region, avg(v) as a, stddev_pop(v) as s from u group by 1), z as (select region, title, (v - a) / nullif(s, 0) as z from u join m using (region)),
    p as (select title, avg(z) filter (where region = 'cn') as cn, avg(z) filter (where region = 'jp') as jp from z where title is not null and z is not null group by 1)
    select title, round(coalesce(cn, 0), 6) as cn, round(coalesce(jp, 0), 6) as jp, round(coalesce(cn, 0) - coalesce(jp, 0), 6) as difference from p"""
)
def zscore_region_diff(spark: SparkSession, d: str) -> DataFrame:
    side = lambda t, v, r: table(spark, d, t, "译名", v).select(F.lit(r).alias("region"), F.col("译名").alias("title"), F.col(v).cast("double").alias("v"))
    z = relate.zscore(side("music_votes_jp", "得票数", "jp").unionByName(side("music_votes_cn", "票数", "cn")), "v", "z", ("region",))
    p = relate.pivot_mean(z, ["title"], "region", ["cn", "jp"], "z").fillna(0.0, ["cn", "jp"])
    return p.select("title", F.round("cn", 6).alias("cn"), F.round("jp", 6).alias("jp"), F.round(F.col("cn") - F.col("jp"), 6).alias("difference"))


# tags


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "char_tags", "译名", "keywords").dropna()
    parts = F.split(F.translate("keywords", "；", "、"), "、")
    return t.select(F.col("译名").alias("entity"), F.explode(F.transform(parts, lambda x: M.ustrip(x))).alias("tag")).where("tag <> ''").distinct()


_PAIRS = """pr as (select distinct entity, tag from (select "译名" as entity, regexp_replace(unnest(string_split_regex(keywords, '[、；]')), '^[\\s\\x{3000}\\x{A0}]+|[\\s\\x{3000}\\x{A0}]+$', '', 'g') as tag from char_tags where "译名" is not null and keywords is not null) where tag <> ''),
kept as (select tag, cast(count(*) as bigint) as n_entities from pr group by 1 having count(*) >= 2)"""


@query(f"with {_PAIRS} select tag, n_entities from kept")
def tag_support(spark: SparkSession, d: str) -> DataFrame:
    return tags.support(_pairs(spark, d))


def _results(spark: SparkSession, d: str) -> DataFrame:
    side = lambda df, r: df.select(F.col("译名").alias("entity"), F.lit(r).alias("region"), S.session_number("session").alias("session_no"), F.col("名次").alias("place"), F.col("票数").alias("votes"))
    return side(_jp(spark, d), "jp").unionByName(side(_cn(spark, d), "cn"))


def _heat(spark: SparkSession, d: str) -> DataFrame:
    return tags.relative_heat(tags.eligible(_results(spark, d), "place", 1), _pairs(spark, d))


_HEAT = f"""with {_PAIRS},
res as (select "译名" as entity, 'jp' as region, cast({_NUM('session')} as bigint) as session_no, "名次" as place, "票数" as votes from char_votes_jp
  union all select "译名", 'cn', cast({_NUM('session')} as bigint), "名次", "票数" from char_votes_cn),
ex as (select distinct entity, session_no from res where place <= 1),
per as (select entity, region, session_no, sum(coalesce(votes, 0)) as votes from res r where entity is not null and not exists (select 1 from ex where ex.entity = r.entity and ex.session_no = r.session_no) group by 1, 2, 3),
tot as (select region, session_no, sum(votes) as total from per group by 1, 2),
sums as (select tag, region, session_no, sum(votes) as votes from per join pr using (entity) join kept using (tag) group by 1, 2, 3),
heat as (select k.tag, t.region, t.session_no, case when total > 0 then cast(coalesce(s.votes, 0) as double) / cast(total as double) else 0.0 end as heat from kept k cross join tot t left join sums s on s.tag = k.tag and s.region = t.region and s.session_no = t.session_no),
ranked as (select *, cast(row_number() over (partition by region, session_no order by heat desc, tag) as bigint) as rank from heat)
"""


@query(_HEAT + "select tag, region, session_no, round(heat, 9) as heat from heat")
def tag_relative_heat(spark: SparkSession, d: str) -> DataFrame:
    return _heat(spark, d).withColumn("heat", F.round("heat", 9))


@query(_HEAT + "select tag, region, session_no, round(heat, 9) as heat, rank from ranked")
def tag_rank_by_session(spark: SparkSession, d: str) -> DataFrame:
    return tags.ranked(_heat(spark, d)).withColumn("heat", F.round("heat", 9))


@query(_HEAT + "select tag, region, session_no, round(heat, 9) as heat, rank from ranked where region = 'cn' and session_no = 11 and rank <= 20")
def tag_top_n(spark: SparkSession, d: str) -> DataFrame:
    return tags.top(tags.ranked(_heat(spark, d)), "cn", 11, 20).withColumn("heat", F.round("heat", 9))


@query(_HEAT + "select '妖怪' as tag, s.region, s.session_no, round(coalesce(h.heat, 0), 9) as heat from (select distinct region, session_no from heat) s left join heat h on h.region = s.region and h.session_no = s.session_no and h.tag = '妖怪'")
def tag_across_sessions(spark: SparkSession, d: str) -> DataFrame:
    return tags.across_sessions(_heat(spark, d), "妖怪").withColumn("heat", F.round("heat", 9))


@query(
    _HEAT
    + """, j as (select coalesce(a.tag, b.tag) as tag, coalesce(a.heat, 0) as a, coalesce(b.heat, 0) as b from (select * from heat where region = 'cn' and session_no = 11) a full join (select * from heat where region = 'jp' and session_no = 20) b on a.tag = b.tag)
    select tag, round(a, 9) as a, round(b, 9) as b, round(a - b, 9) as difference, case when a - b < 0 then 'negative' else 'positive' end as sign from j where abs(a - b) >= 0.001"""
)
def tag_diff(spark: SparkSession, d: str) -> DataFrame:
    j = tags.difference(_heat(spark, d), ("cn", 11), ("jp", 20), 0.001)
    return j.select("tag", *[F.round(c, 9).alias(c) for c in ("a", "b", "difference")], "sign")


@query(
    _HEAT
    + """, j as (select coalesce(a.tag, b.tag) as tag, coalesce(a.heat, 0) - coalesce(b.heat, 0) as difference from (select * from heat where region = 'cn' and session_no = 11) a full join (select * from heat where region = 'jp' and session_no = 20) b on a.tag = b.tag)
    select tag, round(difference, 9) as difference from j order by abs(difference) desc, tag limit 25"""
)
def keyset_diff_topn(spark: SparkSession, d: str) -> DataFrame:
    return tags.difference(_heat(spark, d), ("cn", 11), ("jp", 20), n=25).select("tag", F.round("difference", 9).alias("difference"))


@query(_HEAT + "select region, session_no, cast(count(*) as bigint) as n_tags, arg_min(tag, rank) as first_tag, arg_max(tag, rank) as last_tag from ranked group by 1, 2")
def tag_heat_json(spark: SparkSession, d: str) -> DataFrame:
    """The JSON documents of all sessions, read for how many tags each has and which stand first and last."""
    docs = tags.to_json(tags.ranked(_heat(spark, d))).withColumn("p", F.expr("from_json(json, 'map<string,array<array<string>>>')[cast(session_no as string)]"))
    return docs.select("region", "session_no", F.size("p").cast("bigint").alias("n_tags"), F.get(F.get("p", F.lit(0)), F.lit(0)).alias("first_tag"), F.get(F.element_at("p", -1), F.lit(0)).alias("last_tag"))


@query(_HEAT + "select region, session_no, tag, round(heat, 9) as heat from ranked where rank <= 3")
def json_explode(spark: SparkSession, d: str) -> DataFrame:
    """Ranked tags written as JSON documents and read again; the first three of each session."""
    docs = tags.to_json(tags.ranked(_heat(spark, d)).where("rank <= 3"))
    return tags.from_json(docs, "json", "region").select("region", "session_no", "tag", F.round("heat", 9).alias("heat"))


# consolidated documents


def _sources(spark: SparkSession, d: str) -> list[DataFrame]:
    jp = _jp(spark, d).select(F.col("译名").alias("name"), F.col("日文名").alias("jp_name"), F.col("票数").alias("votes"), "row_id")
    return [jp, _cn(spark, d).select(F.col("译名").alias("name"), F.col("票数").alias("votes"), "row_id")]


@query(
    """with u as (select "译名" as name, "日文名" as jp_name, "票数" as votes, 0 as s, row_id from char_votes_jp where "译名" is not null union all select "译名", null, "票数", 1, row_id from char_votes_cn where "译名" is not null),
    f as (select *, row_number() over (partition by name order by s, row_id) as a, row_number() over (partition by name order by s desc, row_id desc) as z from u)
    select name, max(jp_name) filter (where a = 1) as jp_name, max(votes) filter (where z = 1) as votes from f group by 1"""
)
def first_wins_last_wins(spark: SparkSession, d: str) -> DataFrame:
    return document.upsert(_sources(spark, d), "name", ["jp_name"], ["votes"], "row_id")


_INDEX = """with f as (select {k} as k, {v} as v, min(row_id) as r from {t} where {k} is not null and {v} is not null group by 1, 2) select k as {o}, string_agg(v, '|' order by r) as items from f group by 1"""


@query(_INDEX.format(k="session", v='"译名"', t="char_votes_cn", o="session"))
def session_index(spark: SparkSession, d: str) -> DataFrame:
    return document.index(_cn(spark, d), "session", "译名", "row_id").select("session", F.array_join("items", "|").alias("items"))


@query(_INDEX.format(k='"曲目"', v='"译名"', t="music_votes_jp", o="title"))
def ordered_distinct_list(spark: SparkSession, d: str) -> DataFrame:
    return document.index(table(spark, d, "music_votes_jp"), "曲目", "译名", "row_id").select(F.col("曲目").alias("title"), F.array_join("items", "|").alias("items"))


@query()
def consolidated_json(spark: SparkSession, d: str) -> DataFrame:
    """Each name with its attributes and the votes of every session."""
    e = document.upsert(_sources(spark, d), "name", ["jp_name"], [], "row_id").withColumn("id", S.entity_id("name"))
    stats = _regions(spark, d).withColumn("session", F.when(F.col("region") == "jp", S.parse_session("session", "jp")).otherwise(S.parse_session("session", "cn"))).groupBy("name", "session").agg(M.sum0("votes").alias("v"))
    return document.nested_json(e, "name", stats, "session")


# The statistics of a session in the consolidated document and the columns they come from.
_JP_STATS = {"r": "名次", "prev_r": "上回名次", "prev2_r": "上上回名次", "v": "票数", "bnum": "本名票数", "comments": "评论数", "support": "应援作品数"}
_CN_STATS = {"r": "名次", "v": "票数", "bnum": "本命数", "brate": "本命率", "bw": "本命加权", "v_pct": "票数占比", "b_pct": "本命占比", "male_pct": "男性比例", "female_pct": "女性比例"}
_JP_SONG = {"r": "排名", "prev_r": "上回名次", "prev2_r": "上上回名次", "v": "得票数", "main_v": "本名票数", "comments": "评论数"}
_CN_SONG = {
    "r": "名次", "v": "票数", "bnum": "本命数", "brate": "本命率", "bw": "本命加权", "v_pct": "票数占比", "b_pct": "本命占比", "male": "男性", "male_pct": "男性比", "male_total_pct": "占总数",
    "female": "女性", "female_pct": "女性比", "female_total_pct": "占总数_1", "bias_orig": "偏原作", "bias_2nd": "偏二次", "no_bias": "无偏爱", "no_interest": "都没兴趣",
}
_RATES = {"brate", "bw", "v_pct", "b_pct", "male_pct", "female_pct", "male_total_pct", "female_total_pct"}


def _session_map(parts: list[tuple[DataFrame, str, dict[str, str]]], key: str) -> DataFrame:
    """``(name, sessions)``: the statistics of each session, by session key; attributes a region lacks are left out."""
    names = list(dict.fromkeys(n for *_, stats in parts for n in stats))

    def value(n: str, stats: dict[str, str]):
        if n not in stats:
            return F.lit(None).cast("double" if n in _RATES else "bigint")
        return M.to_float(stats[n]) if n in _RATES else M.to_int(stats[n])

    per = [document.latest_stats(df.withColumn(key, M.ustrip(key)), key, S.parse_session("session", region), {n: value(n, stats) for n in names}, "row_id") for df, region, stats in parts]
    u = reduce(DataFrame.unionByName, per)
    return u.groupBy(F.col(f"`{key}`").alias("name")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("session", "stats")))).alias("sessions"))


def _document(spark: SparkSession, d: str) -> dict[str, tuple[DataFrame, str]]:
    """The sections of the consolidated document and their key columns."""
    jp, cn = _jp(spark, d), _cn(spark, d)
    mj, mc = table(spark, d, "music_votes_jp"), table(spark, d, "music_votes_cn")
    named = lambda df, *c: df.select("row_id", M.ustrip("译名").alias("name"), *c)
    works = table(spark, d, "char_dim").groupBy(F.col("译名").alias("name")).agg(F.min(M.clean_str("首次出现作品")).alias("first_appear"))
    tags_of = table(spark, d, "char_tags").select("entry_id", M.ustrip("译名").alias("name"), F.filter(F.transform(F.split(F.translate("keywords", "；", "、"), "、"), lambda x: M.ustrip(x)), lambda x: x != "").alias("keywords"))
    tags_of = tags_of.where("name is not null and keywords is not null").groupBy("name").agg(F.max_by("keywords", "entry_id").alias("keywords"))
    base = document.upsert([named(jp, F.col("日文名").alias("jp_name")), named(cn), tags_of.select("name", F.lit(0).cast("bigint").alias("row_id"))], "name", ["jp_name"], [], "row_id")
    chars = base.withColumn("id", S.entity_id("name")).join(works, "name", "left").join(tags_of, "name", "left").join(_session_map([(jp, "jp", _JP_STATS), (cn, "cn", _CN_STATS)], "译名"), "name", "left")
    titles = document.upsert([named(mj, M.ustrip("曲目").alias("t")), named(mc)], "name", ["t"], [], "row_id")
    known = packed.known_names(table(spark, d, "char_dim", "译名"), "译名")
    members = packed.split_packed(named(mj, "所属角色").where("name is not null"), "所属角色", ["row_id", "name"], known)
    members = document.index(members.withColumn("at", F.struct("row_id", "pos")), "name", "val", "at", "chars")
    songs = titles.join(members, "name", "left").join(_session_map([(mj, "jp", _JP_SONG), (mc, "cn", _CN_SONG)], "译名"), "name", "left")
    gender = mc.groupBy(S.parse_session("session", "cn").alias("session")).agg(M.positive_or_null(M.sum0(M.to_int("男性"))).alias("m"), M.positive_or_null(M.sum0(M.to_int("女性"))).alias("f"))
    both = named(jp).withColumn("o", F.struct(F.lit(0), "row_id")).unionByName(named(cn).withColumn("o", F.struct(F.lit(1), "row_id")))
    by_work = document.index(both.join(works.where("first_appear is not null"), "name"), "first_appear", "name", "o", "names")

    def session(df: DataFrame, region: str, votes: str, items: str, total: str) -> tuple[DataFrame, DataFrame]:
        k = df.select("row_id", "session", S.parse_session("session", region).alias("key"), M.ustrip("译名").alias("name"), F.col(f"`{votes}`").alias("v"))
        return document.index(k, "key", "name", "row_id", items), k.groupBy("key").agg(M.sum0(M.to_int("v")).alias(total), F.max(S.paren_list("session")).alias(f"{items}_works"))

    (cj, tj), (cc, tc) = session(jp, "jp", "票数", "chars", "total_votes"), session(cn, "cn", "票数", "chars", "total_votes")
    (sj, uj), (sc, uc) = session(mj, "jp", "得票数", "songs", "total_song_votes"), session(mc, "cn", "票数", "songs", "total_song_votes")
    by_session = tj.unionByName(tc).join(uj.unionByName(uc), "key", "full_outer").join(cj.unionByName(cc), "key", "left").join(sj.unionByName(sc), "key", "left")
    by_session = by_session.select("key", "chars", "songs", F.coalesce("chars_works", F.array().cast("array<string>")).alias("extra_works"), "total_votes", "total_song_votes")
    no_gender = document.sessions_without(by_session, gender.withColumnRenamed("session", "key").where("m is not null or f is not null"), "key")
    meta = [df.select(F.lit(n).alias("key"), "sessions") for n, df in (("jp_sessions", document.sorted_sessions(jp, "session", "jp")), ("cn_sessions", document.sorted_sessions(cn, "session", "cn")), ("missing_gender", no_gender.agg(F.array_sort(F.collect_list("key")).alias("sessions"))))]
    return {"characters": (chars, "name"), "songs": (songs, "name"), "gender": (gender, "session"), "by_work": (by_work, "first_appear"), "by_session": (by_session, "key"), "meta": (reduce(DataFrame.unionByName, meta), "key")}


@query()
def consolidated_document(spark: SparkSession, d: str) -> DataFrame:
    """The whole consolidated document: characters and songs with the statistics of their sessions, genders, indexes
    and meta, an entry a row."""
    return document.sections(_document(spark, d))


_BLANK = "\\s\\x{3000}\\x{A0}\\x{2000}-\\x{200A}\\x{202F}\\x{205F}"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^[{_BLANK}]+|[{_BLANK}]+$', '', 'g')"


def _key(region: str) -> str:
    return f"coalesce({_NUM('session')}, session) || '_{region}'"


_NAME_SQL = _strip('"译名"')
_CLEAN_SQL = _strip("regexp_replace(\"译名\", '（[^）]*）', '', 'g')")


@query(
    f"""with c as (select {_NAME_SQL} as name, {_key('jp')} as session, "票数" as v from char_votes_jp union all select {_NAME_SQL}, {_key('cn')}, "票数" from char_votes_cn),
    s as (select {_NAME_SQL} as name, {_key('jp')} as session, "得票数" as v from music_votes_jp union all select {_NAME_SQL}, {_key('cn')}, "票数" from music_votes_cn),
    g as (select {_NAME_SQL} as name from char_tags where keywords is not null),
    w as (select "译名" as name, min(case when "首次出现作品" = floor("首次出现作品") then cast(cast("首次出现作品" as bigint) as varchar) else cast("首次出现作品" as varchar) end) as work from char_dim group by 1)
    select 'characters' as section, name as key, cast(count(distinct session) as bigint) as n from (select name, session from c union all select name, null from g) where name is not null group by 2
    union all select 'songs', name, cast(count(distinct session) as bigint) from s where name is not null group by 2
    union all select 'by_work', work, cast(count(distinct name) as bigint) from c join w using (name) where work is not null group by 2
    union all select 'by_session', coalesce(a.session, b.session), coalesce(n, 0) + coalesce(m, 0) + coalesce(x, 0) + coalesce(y, 0) from
      (select session, cast(count(distinct name) as bigint) as n, cast(sum(coalesce(v, 0)) as bigint) as x from c group by 1) a full join (select session, cast(count(distinct name) as bigint) as m, cast(sum(coalesce(v, 0)) as bigint) as y from s group by 1) b on a.session = b.session
    union all select 'meta', 'jp_sessions', cast(count(distinct {_key('jp')}) as bigint) from char_votes_jp union all select 'meta', 'cn_sessions', cast(count(distinct {_key('cn')}) as bigint) from char_votes_cn"""
)
def consolidated_counts(spark: SparkSession, d: str) -> DataFrame:
    """How much each entry of the document holds: sessions of a name, names of a work, names and votes of a session."""
    p = _document(spark, d)
    size = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
    n0 = lambda c: F.coalesce(F.col(c), F.lit(0))
    row = lambda name, key, n: p[name][0].select(F.lit(name).alias("section"), F.col(key).cast("string").alias("key"), n.cast("bigint").alias("n"))
    parts = [row("characters", "name", size("sessions")), row("songs", "name", size("sessions")), row("by_work", "first_appear", size("names")), row("by_session", "key", size("chars") + size("songs") + n0("total_votes") + n0("total_song_votes"))]
    return reduce(DataFrame.unionByName, [*parts, row("meta", "key", size("sessions")).where("key <> 'missing_gender'")])


# scalars


@query(
    f"""select row_id, coalesce({_NUM('session')}, session) || '_jp' as session_key, cast({_NUM('session')} as bigint) as session_no, cast({_NUM('session')} as bigint) - 1 as session_index,
    array_to_string(list_filter(list_transform(string_split(regexp_extract(session, '\\(([^)]+)\\)', 1), '、'), lambda x: trim(x)), lambda x: x <> ''), '|') as works from char_votes_jp"""
)
def parse_session(spark: SparkSession, d: str) -> DataFrame:
    key = S.parse_session("session", "jp")
    return _jp(spark, d).select("row_id", key.alias("session_key"), S.session_number("session").alias("session_no"), S.session_index(key)[0].alias("session_index"), F.array_join(S.paren_list("session"), "|").alias("works"))


@query("""select "日文名" as name, lower(regexp_replace("日文名", '[^\\p{L}\\p{N}_]+', '', 'g')) as id from char_dim""")
def entity_id(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "char_dim").select(F.col("日文名").alias("name"), S.entity_id("日文名").alias("id"))


@query("""select "译名" as name, case when "首次出现作品" = floor("首次出现作品") then cast(cast("首次出现作品" as bigint) as varchar) else cast("首次出现作品" as varchar) end as work from char_dim""")
def clean_str(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "char_dim").select(F.col("译名").alias("name"), M.clean_str("首次出现作品").alias("work"))


@query("""select row_id, cast(trunc("票数占比") as bigint) as whole, "票数占比" as share from char_votes_cn""")
def tolerant_casts(spark: SparkSession, d: str) -> DataFrame:
    return _cn(spark, d).select("row_id", M.to_int("票数占比").alias("whole"), M.to_float("票数占比").alias("share"))


@query(
    """with s as (select "译名" as name, unnest(['', '/二次设定', '/分析考据']) as suffix from (select distinct "译名" from char_dim))
    select name, suffix, 'https://wiki.example/' || name || suffix as url from s"""
)
def suffix_cross(spark: SparkSession, d: str) -> DataFrame:
    from pollweave.operators.keywords import suffixed

    e = table(spark, d, "char_dim").select(F.col("译名").alias("name")).distinct()
    return suffixed(e, "name", ["", "/二次设定", "/分析考据"], "https://wiki.example/")


@query("""select "译名" as name, replace(url_encode("译名" || ' /x'), '%2F', '/') as path from char_dim""")
def url_encode_path(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "char_dim").select(F.col("译名").alias("name"), S.quote_path(F.concat("译名", F.lit(" /x"))).alias("path"))


@query(f"with t as ({SQL['topn_share_15']}) select session || ': votes ' || printf('%.2f', cast(top_votes as double)) || ', share ' || printf('%.2f', share) as line from t")
def report_lines(spark: SparkSession, d: str) -> DataFrame:
    t = QUERIES["topn_share_15"](spark, d)
    return t.select(sinks.report_line(F.col("session"), ("votes", F.col("top_votes")), ("share", F.col("share"))).alias("line"))


@query(f"with t as ({SQL['region_share_diff']}) select name as x, difference as y, cast(null as varchar) as series, case when difference > 0 then 'positive' when difference < 0 then 'negative' when difference = 0 then 'zero' end as sign from t")
def chart_series(spark: SparkSession, d: str) -> DataFrame:
    return sinks.chart_series(QUERIES["region_share_diff"](spark, d), "name", "difference")


# guards, ordering and outputs


@query(
    f"""select row_id, session, cast({_NUM('session')} as bigint) as session_no, "上回名次" - "名次" as gained, cast(row_number() over (order by cast({_NUM('session')} as bigint) desc nulls last, "名次" asc nulls last, row_id) as bigint) as place
    from char_votes_jp where "名次" is not null and "上回名次" is not null and "名次" <= 20"""
)
def rank_changes(spark: SparkSession, d: str) -> DataFrame:
    """How far the first twenty of each session have risen against the session before, latest session first."""
    v = _jp(spark, d).where("`名次` is not null and `上回名次` is not null and `名次` <= 20")
    v = v.select("row_id", "session", S.session_number("session").alias("session_no"), "名次", (F.col("上回名次") - F.col("名次")).alias("gained"))
    o = relate.ordered(v, (("session_no", False), ("名次", True), ("row_id", True)), "place")
    return o.select("row_id", "session", "session_no", "gained", "place")


@query(f"""with k as (select distinct {_key('jp')} as key, cast({_NUM('session')} as bigint) as n from char_votes_jp) select key, cast(row_number() over (order by n nulls last, key) as bigint) as place, cast(count(*) over () - row_number() over (order by n nulls last, key) + 1 as bigint) as shown_at from k""")
def sessions_in_order(spark: SparkSession, d: str) -> DataFrame:
    """Session keys by number, and their place where a chart shows the last one first."""
    k = _jp(spark, d).select(S.parse_session("session", "jp").alias("key"), M.strict_int(S.session_number("session")).alias("n")).distinct()
    o = relate.ordered(k, (("n", True), ("key", True)), "place")
    return o.crossJoin(F.broadcast(k.agg(F.count("*").alias("c")))).select("key", "place", (F.col("c") - F.col("place") + 1).alias("shown_at"))


@query(
    f"""with c as (select row_id, "译名", "票数", {_CLEAN_SQL} as name from char_votes_cn where "译名" is not null)
    select name, cast(sum("票数") as bigint) as votes, cast(count(*) as bigint) as n, arg_min("译名", row_id) as spelling from c where name <> '' and name not in ('弃权', '不认识') group by 1"""
)
def collapsed_names(spark: SparkSession, d: str) -> DataFrame:
    """Votes of names that are the same without bracketed notes, and without those who named nobody."""
    v = enrich.without(_cn(spark, d).select("row_id", "译名", "票数"), "译名", "弃权", "不认识", cleaned=True)
    return enrich.collapsed(v, "译名", {"votes": "票数"}, "row_id")


@query("""select session, cast(sum(coalesce("票数", 0)) as bigint) as total from char_votes_jp group by 1""")
def checked_totals(spark: SparkSession, d: str) -> DataFrame:
    """Totals of sessions, of which none may be 0; an empty table is an error."""
    return shares.checked_totals(M.assert_not_empty(_jp(spark, d).select("session", "票数"), "char_votes_jp"), "session", "票数")


@query("""select v.row_id, r.first_id as ref_id from char_votes_jp v join (select ref_name, min(ref_id) as first_id from canon_names where ref_kind = 'char' group by 1) r on r.ref_name = v."译名" """)
def strict_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The number of each name in the list, by a lookup that raises on a name without one."""
    ids = table(spark, d, "canon_names").where("ref_kind = 'char'").groupBy("ref_name").agg(F.min("ref_id").alias("ref_id"))
    known = _jp(spark, d).select("row_id", "译名").join(ids.select(F.col("ref_name").alias("译名")), "译名", "left_semi")
    return enrich.lookup_strict(known, "译名", ids.withColumnRenamed("ref_id", "id"), "ref_name", "id", "ref_id").select("row_id", "ref_id")


@query(
    f"""with {_ENT} select 'votes and comments' as panel, name as label, zv as x, zc as y, (abs(zv) > 1) <> (abs(zc) > 1) as is_outlier from (select name, round(zv, 6) as zv, round(zc, 6) as zc from z) where zv is not null and zc is not null
    union all select 'shares', name, round(votes / (select sum(votes) from e), 9), round(comments / (select sum(comments) from e), 9), false from e where votes is not null and comments is not null"""
)
def scatter_panels(spark: SparkSession, d: str) -> DataFrame:
    """Two panels of a scatter plot: standard scores with their outliers, and shares of the totals."""
    e = _entities(spark, d)
    z = relate.zscore(relate.zscore(e, "votes", "zv"), "comments", "zc").withColumn("zv", F.round("zv", 6)).withColumn("zc", F.round("zc", 6))
    far = lambda c: F.abs(F.col(c)) > 1
    share = relate.share_of_total(relate.share_of_total(e, "votes", "sv"), "comments", "sc").withColumn("sv", F.round("sv", 9)).withColumn("sc", F.round("sc", 9))
    return sinks.scatter(z, "zv", "zc", "name", far("zv") != far("zc"), "votes and comments").unionByName(sinks.scatter(share, "sv", "sc", "name", F.lit(False), "shares"))


@query(f"""with {_PAIRS} select tag as term, round(n_entities / cast(max(n_entities) over () as double), 9) as weight from kept""")
def cloud_weights(spark: SparkSession, d: str) -> DataFrame:
    return sinks.cloud(tags.support(_pairs(spark, d)), "tag", "n_entities").withColumn("weight", F.round("weight", 9))


@query(
    f"""with {_REGIONS}, p as (select name, session, avg(votes) filter (where region = 'cn') as cn, avg(votes) filter (where region = 'jp') as jp from u where name is not null and votes is not null group by 1, 2)
    select name, session, round(cn, 6) as cn, round(jp, 6) as jp from p"""
)
def pivot_by_session(spark: SparkSession, d: str) -> DataFrame:
    """Mean votes of a name in each session, a column for each region."""
    return relate.pivot_mean(_regions(spark, d), ["name", "session"], "region", ["cn", "jp"], "votes").select("name", "session", F.round("cn", 6).alias("cn"), F.round("jp", 6).alias("jp"))


@query("""with p as (select unnest(string_split(replace(keywords, '；', '、'), '、')) as tag, generate_subscripts(string_split(replace(keywords, '；', '、'), '、'), 1) as pos, entry_id from char_tags) select entry_id, cast(pos as bigint) as pos, tag from p""")
def zipped_positions(spark: SparkSession, d: str) -> DataFrame:
    """Two arrays side by side: the parts of a field and their places."""
    parts = F.split(F.translate("keywords", "；", "、"), "、")
    z = F.explode(F.arrays_zip(parts.alias("tag"), F.sequence(F.lit(1), F.size(parts)).alias("pos")))
    return table(spark, d, "char_tags", "entry_id", "keywords").where("keywords is not null").select("entry_id", z.alias("z")).select("entry_id", F.col("z.pos").cast("bigint").alias("pos"), F.col("z.tag").alias("tag"))


@query(f"""select row_id, {_CLEAN_SQL} as name from char_votes_cn""")
def bracket_groups(spark: SparkSession, d: str) -> DataFrame:
    return _cn(spark, d).select("row_id", S.clean_name("译名").alias("name"))


@query(f"""select rho, n, 'significant' as label from ({SQL['spearman']}) where n > 100 and abs(rho) >= 2.2 / sqrt(n)""")
def significant_rho(spark: SparkSession, d: str) -> DataFrame:
    """The rank correlation where it is far beyond chance (2.2 standard errors), with its label."""
    p = relate.with_p_value(relate.spearman(_entities(spark, d), "votes", "comments"))
    return p.where("n > 100 and abs(rho) >= 2.2 / sqrt(n)").select(F.round("rho", 6).alias("rho"), "n", S.significance("p_value").alias("label"))
