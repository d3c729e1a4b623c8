import math

import pytest
from pyspark.sql import functions as F

from pollweave.functions import html as H
from pollweave.functions import scalars as S
from pollweave.functions import semantics as M
from pollweave.operators import document, enrich, keywords, relate, shares, tags


def one(spark, c, **values):
    cols = [F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1).alias("one")]
    return spark.range(1).select(*cols).select(c.alias("x")).first()["x"]


@pytest.mark.parametrize("a, b, want", [(1.0, 0.0, math.inf), (-1.0, 0.0, -math.inf), (0.0, 0.0, None), (3.0, 2.0, 1.5), (None, 1.0, None)])
def test_division(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a double, b double")
    assert df.select(M.pd_div("a", "b").alias("x")).first()["x"] == want


@pytest.mark.parametrize("x, y, m, kept", [(1, 0, 0, True), (0, 0, 1, False), (0, 3, 1, True), (2, 4, None, False)])
def test_ratio_truth_table(spark, x, y, m, kept):
    df = spark.createDataFrame([(float(x), float(y), None if m is None else float(m))], "x double, y double, m double")
    assert (relate.ratio_impact(df, "x", "y", "m", 0.5).count() == 1) is kept


def test_rounding_and_casts(spark):
    assert one(spark, M.half_even(F.lit(0.125), 2)) == 0.12
    rows = spark.createDataFrame([("12",), ("12.7",), ("x",), (None,)], "s string").select(M.to_int("s").alias("i")).collect()
    assert [r.i for r in rows] == [12, None, None, None]
    assert one(spark, M.to_int(F.lit(12.7))) == 12
    assert [one(spark, M.clean_str(F.lit(v))) for v in (6.0, 5.5)] == ["6", "5.5"]
    assert one(spark, M.ustrip(F.lit("　a b "))) == "a b"
    empty = spark.createDataFrame([], "v int").agg(M.sum0("v").alias("s")).first().s
    assert empty == 0


def test_guards(spark):
    d = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "k string, v int")
    with pytest.raises(ValueError):
        M.assert_unique(d, "k")
    assert M.assert_unique(d.where("k is null"), "k") is not None
    with pytest.raises(ValueError):
        M.require_columns(d, "nope")
    assert M.strip_headers(d.toDF("k ", " v")).columns == ["k", "v"]


def test_sessions(spark):
    d = spark.createDataFrame([("3 (a、b)",), ("20",), ("x",)], "s string")
    got = d.select(S.parse_session("s", "jp").alias("k"), S.paren_list("s").alias("w"), S.session_number("s").alias("n")).collect()
    assert [tuple(r) for r in got] == [("3_jp", ["a", "b"], 3), ("20_jp", [], 20), ("x_jp", [], None)]
    assert spark.range(1).select(*S.session_index(F.lit("3_jp"))).first()[:] == (2, 1)


def test_names(spark):
    assert one(spark, S.normalize_title(F.lit("x(1)～sub"))) == "x"
    assert one(spark, S.normalize_title(F.lit("恋色M（恋色s）"), {"恋色M": "恋色s"})) == "恋色s"
    assert one(spark, S.clean_name(F.lit("/a（b）c "), slash=True)) == "ac"
    assert one(spark, S.entity_id(F.lit("A·b_1!"))) == "ab_1"
    assert one(spark, S.quote_path(F.lit("a b/c"))) == "a%20b/c"
    assert one(spark, S.split_trim(F.lit("a| b||"))) == ["a", "b"]
    assert one(spark, S.tokens(F.lit("灵乌路空/二次设定 - boss ⑨ 2.1"))) == ["灵乌路空", "二次设定", "boss", "⑨", "2", "1"]
    assert one(spark, S.at_least_one(F.lit(0.5))) == 2.0 and one(spark, S.at_least_one(F.lit(0.0))) is None
    assert one(spark, S.outlier_reason(F.lit(3.0), F.lit(0.0), 2)) == "first"


def test_html():
    page = '<div itemscope><tr><th>t</th><td>0</td></tr></div><div itemscope class="infotemplatebox"><table><tr><th>t</th><td>a<b>b</b></td><td>c</td></tr></table></div><script>x</script>'
    assert H.infobox_of(page, "t") == "a b；c" and H.infobox_of("<p>", "t") == "" and H.infobox_of(None, "t") is None
    assert H.text_of("<p>a &amp; b</p><style>z</style> c") == "a & b c"


def test_joins(spark):
    votes = spark.createDataFrame([("a", 5), ("b", 1), (None, 2), ("c", 4)], "k string, v int")
    dim = spark.createDataFrame([("a", 6.0), ("a", 7.0), ("b", 5.0), ("c", 5.5), (None, 9.0)], "k string, w double")
    assert sorted(r.k for r in enrich.enrich_votes(votes, dim, "k", "w").collect()) == ["a", "a", "c"]
    with pytest.raises(ValueError):
        enrich.enrich_songs(votes.withColumnRenamed("k", "t"), dim.select(F.col("k").alias("t"), "w"), "t", ["w"])
    lk = enrich.last_wins(spark.createDataFrame([("a", 1, 1), ("a", 2, 2)], "k string, v int, o int"), "k", "v", "o")
    assert [tuple(r) for r in lk.collect()] == [("a", 2)]
    with pytest.raises(Exception, match="no entry"):
        enrich.lookup_strict(votes, "k", lk, "k", "v", "x").collect()


def test_shares(spark):
    raw = spark.createDataFrame([("1", "a", 6, 1), ("1", "b", 3, 2), ("1", "x", 1, 3), ("2", "a", 0, 4)], "session string, k string, v int, id int")
    grouped = raw.where("k <> 'x'")
    assert [tuple(r) for r in shares.topn_share(grouped, raw, "session", "v", 1, ("id",)).collect()] == [("1", 6, 10, 60.0)]
    assert shares.entity_share(raw, "session", "k", "v", "id", ["a"]).count() == 1


def test_zscore_and_ranks(spark):
    d = spark.createDataFrame([(5.0,), (5.0,), (None,)], "x double")
    assert sorted((r.z for r in relate.zscore(d, "x").collect()), key=str) == [0.0, 0.0, None]
    d = spark.createDataFrame([(1, 2.0, 2.0), (2, 1.0, 5.0), (3, 2.0, 6.0), (4, 3.0, 9.0)], "id int, x double, y double")
    assert {r.id: r.r for r in relate.average_rank(d, "x", "r").collect()} == {1: 2.5, 2: 1.0, 3: 2.5, 4: 4.0}
    assert relate.spearman(d.withColumn("y", F.lit(1.0)), "x", "y").first().rho is None
    assert relate.spearman_p(0.5, 10) == pytest.approx(0.1411, abs=1e-3)


def test_tags(spark):
    res = spark.createDataFrame([("a", "jp", 1, 6), ("b", "jp", 1, 4), ("a", "cn", 1, 1), ("c", "cn", 1, 1)], "entity string, region string, session_no long, votes int")
    pairs = spark.createDataFrame([("a", "t"), ("b", "t"), ("a", "t"), ("a", "u")], "entity string, tag string")
    h = tags.relative_heat(res, pairs)
    assert {(r.region, r.tag): r.heat for r in h.collect()} == {("jp", "t"): 1.0, ("cn", "t"): 0.5}
    back = tags.from_json(tags.to_json(tags.ranked(h)), "json")
    assert sorted(tuple(r) for r in back.collect()) == [(1, "t", 0.5), (1, "t", 1.0)]


def test_documents(spark):
    a = spark.createDataFrame([("x", "first", 1, 1), ("x", None, 9, 2)], "k string, n string, v int, o int")
    b = spark.createDataFrame([("x", 5, 1), ("y", 7, 2), (None, 1, 3)], "k string, v int, o int")
    assert sorted(tuple(r) for r in document.upsert([a, b], "k", ["n"], ["v"], "o").collect()) == [("x", "first", 5), ("y", None, 7)]
    assert document.index(a.withColumn("g", F.lit("s")), "g", "k", "o").first()["items"] == ["x"]


def test_keywords(spark):
    d = spark.createDataFrame([(1, "b a a b c"), (2, ""), (3, None)], "id int, t string")
    c = keywords.term_counts(d, "id", "t")
    assert [(r.term, r["rank"]) for r in keywords.top_terms(c, "id", 2).orderBy("rank").collect()] == [("b", 1), ("a", 2)]
    stop = spark.createDataFrame([("boss",)], "w string")
    words = spark.createDataFrame([(1, "Boss", 1, 0), (1, "boss", 1, 1)], "id int, term string, tf int, pos int")
    assert [r.term for r in keywords.filtered(words, "freq", stop).collect()] == ["Boss"]
    ranks = keywords.rank_graph("a b a c a d".split())
    assert ranks[0] == ("a", 1.0) and all(x[1] >= y[1] for x, y in zip(ranks, ranks[1:], strict=False))
    assert keywords.rank_graph(["a", "a"]) == []
    tf = keywords.tfidf(c, "id").collect()
    assert sum(r.score**2 for r in tf) == pytest.approx(1)
