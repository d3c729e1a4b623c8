import json
import random

import pytest
from pyspark.sql import functions as F

from pollweave.functions import semantics as M
from pollweave.operators import document, enrich, keywords, relate, shares, tags, topics
from pollweave.sources import sinks

SESSIONS = [("9", 1), ("10", 2), ("20 (a、b)", 3), ("20", 4), ("3 (x)", 5), (None, 6), ("final", 7)]


def test_last_session_is_the_largest_number(spark):
    df = spark.createDataFrame(SESSIONS, "session string, v int")
    assert sorted(r.v for r in shares.last_session(df, "session").collect()) == [3, 4]
    assert [r.v for r in shares.last_session(df.where("v in (1, 2)"), "session").collect()] == [2]
    assert [r.v for r in shares.last_session(df.where("v >= 6"), "session").collect()] == [7]
    assert shares.last_session(df.where("v = 6"), "session").count() == 0 == shares.last_session(df.limit(0), "session").count()


def test_titles_on_two_rows(spark):
    votes = spark.createDataFrame([(1, "A ～ live"), (2, "B"), (3, None)], "id int, t string")
    dim = spark.createDataFrame([(2, "A", "second"), (1, "A（x）", "first"), (3, "B", "b"), (4, None, "n"), (0, "A", None)], "o int, t string, w string")
    got = {r.id: r.w for r in enrich.enrich_songs(votes, dim, "t", ["w"], order="o").collect()}
    assert got == {1: "first", 2: "b"}
    assert [tuple(r) for r in enrich.title_clashes(dim, "t").collect()] == [("A", 3)]
    with pytest.raises(ValueError, match="not unique"):
        enrich.enrich_songs(votes, dim, "t", ["w"])


def test_bounds_of_works(spark):
    votes = spark.createDataFrame([("a",), ("b",)], "k string")
    dim = spark.createDataFrame([("a", 6.0), ("b", 5.5)], "k string, w double")
    assert [r.k for r in enrich.enrich_votes(votes, dim, "k", "w", None, 6.0).collect()] == ["a"]
    assert enrich.enrich_votes(votes, dim, "k", "w", 5.5).count() == 1 and enrich.enrich_votes(votes, dim, "k", "w", None).count() == 2


def test_guards(spark):
    df = spark.createDataFrame([("1", 0), ("2", 5), (None, None)], "session string, v int")
    with pytest.raises(ValueError, match="is empty"):
        M.assert_not_empty(df.limit(0), "votes")
    with pytest.raises(ValueError, match="no session '7'"):
        M.assert_has(df, "session", "7", "session")
    assert M.assert_not_empty(M.assert_has(df, "session", "2")).count() == 3
    assert [r.total for r in shares.checked_totals(df.where("session = '2'"), "session", "v").collect()] == [5]
    with pytest.raises(Exception, match="no votes in session 1"):
        shares.checked_totals(df, "session", "v").collect()
    n = spark.createDataFrame([("7",), (None,)], "s string").select(M.strict_int("s").alias("n"))
    assert [r.n for r in n.collect()] == [7, None]
    with pytest.raises(Exception, match="no whole number: x"):
        spark.createDataFrame([("x",)], "s string").select(M.strict_int("s").alias("n")).collect()


def test_collapsed_and_left_out_names(spark):
    df = spark.createDataFrame([(2, "甲（新）", 3), (1, " 甲", 4), (3, "弃权（旧）", 9), (4, None, 1), (5, "（x）", 1), (6, "乙", None)], "id int, name string, n int")
    kept = enrich.without(df, "name", "弃权", cleaned=True)
    assert {r.id for r in kept.collect()} == {1, 2, 4, 5, 6} and enrich.without(df, "name", "弃权").count() == 6
    got = {r.name: (r.votes, r.n, r.spelling) for r in enrich.collapsed(kept, "name", {"votes": "n"}, "id").collect()}
    assert got == {"甲": (7, 2, " 甲"), "乙": (None, 1, "乙")}


def test_places(spark):
    rng = random.Random(6)
    rows = [(rng.choice([None, 1, 2, 3]), rng.randrange(50), i) for i in range(300)]
    df = spark.createDataFrame(rows, "a int, b int, id int")
    got = [r.id for r in relate.ordered(df, (("a", False), ("b", True), ("id", True)), "place").orderBy("place").collect()]
    assert got == [r[2] for r in sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1], r[2]))]
    assert relate.ordered(df.limit(0), (("a", True),), "place").count() == 0


def test_eligible_equals_exclusions(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["x", "y", "z", None]), rng.choice(["jp", "cn"]), rng.choice([1, 2]), rng.choice([None, 1, 2, 5]), rng.randrange(9)) for _ in range(60)]
    r = spark.createDataFrame(rows, "entity string, region string, session_no int, place int, votes int")
    out = r.where("place <= 1").select("entity", "session_no").distinct()
    want = r.dropna(subset=["entity"]).join(out, ["entity", "session_no"], "left_anti").groupBy("entity", "region", "session_no").agg(F.sum("votes").alias("v"))
    assert sorted(map(tuple, tags.eligible(r, "place", 1).collect())) == sorted(map(tuple, want.collect()))


def test_tag_documents(spark):
    heat = spark.createDataFrame([("b", "jp", 2, 0.5), ("a", "jp", 2, 0.5), ("c", "jp", 10, 0.25)], "tag string, region string, session_no int, heat double")
    docs = tags.to_json(tags.ranked(heat))
    assert {(r.session_no, r.json) for r in docs.collect()} == {(2, '{"2":[["a","0.5"],["b","0.5"]]}'), (10, '{"10":[["c","0.25"]]}')}
    assert sorted((r.region, r.session_no, r.tag, r.heat) for r in tags.from_json(docs, "json", "region").collect()) == [("jp", 2, "a", 0.5), ("jp", 2, "b", 0.5), ("jp", 10, "c", 0.25)]
    bad = spark.createDataFrame([("no json",), (None,)], "json string")
    assert tags.from_json(bad, "json").count() == 0


def test_sections(spark):
    votes = spark.createDataFrame([(1, "a", "9 (x)", 5), (2, "a", "9", 7), (3, "b", "10", None), (4, None, "10", 1)], "row int, name string, session string, v int")
    stats = document.latest_stats(votes, "name", F.regexp_extract("session", r"^\d+", 0), {"v": F.col("v")}, "row")
    assert sorted((r.name, r.session, r.stats.v) for r in stats.collect()) == [("a", "9", 7), ("b", "10", None)]
    doc = document.sections({"votes": (stats.select("name", "session", "stats"), "name"), "none": (votes.limit(0), "name")})
    assert sorted((r.section, r.key, json.dumps(json.loads(r.json))) for r in doc.collect()) == [("votes", "a", '{"session": "9", "stats": {"v": 7}}'), ("votes", "b", '{"session": "10", "stats": {}}')]
    assert document.sorted_sessions(spark.createDataFrame(SESSIONS, "session string, v int"), "session", "jp").first()["sessions"] == ["3_jp", "9_jp", "10_jp", "20_jp", "final_jp"]
    assert document.sorted_sessions(votes.limit(0), "session", "jp").first()["sessions"] == []


def test_what_charts_draw(spark):
    df = spark.createDataFrame([("a", 1.0, 4), ("b", 2.0, None), ("c", None, 2), ("d", 4.0, 0)], "label string, x double, y int")
    assert sorted(tuple(r) for r in sinks.scatter(df, "x", "y", "label", F.col("y") > 3, "p").collect()) == [("p", "a", 1.0, 4.0, True), ("p", "d", 4.0, 0.0, False)]
    assert {r.term: r.weight for r in sinks.cloud(df, "label", "x").collect()} == {"a": 0.25, "b": 0.5, "d": 1.0}
    assert sinks.cloud(df.limit(0), "label", "x").count() == 0


def test_labels_go_back_to_their_methods(spark):
    rows = [(m, k, s) for m in ("freq", "lda") for k, s in (("a", 1), ("b", 1), ("a", 2), ("b", 2), ("x", 7), ("y", 7), ("x", 8), ("y", 8))] + [("tfidf", "a", 1), (None, "a", 1), ("lda", None, 1)]
    df = spark.createDataFrame([*rows, rows[0]], "method string, keyword string, source int")
    got = {(r.method, r.keyword): r.cluster for r in topics.cluster_labels(df, "method", "keyword", "source", k=2).collect()}
    assert len(got) == 9 and got["freq", "a"] == got["lda", "b"] == got["tfidf", "a"] != got["freq", "x"] == got["lda", "y"]


def test_tfidf_against_its_definition(spark):
    import math

    docs = {1: "a a b", 2: "b c", 3: "c c c d", 4: ""}
    c = keywords.term_counts(spark.createDataFrame(list(docs.items()), "id int, t string"), "id", "t")
    df = {w: sum(w in t.split() for t in docs.values()) for w in "abcd"}
    weight = lambda d, w: docs[d].split().count(w) * (math.log(4 / (1 + df[w])) + 1)
    for r in keywords.tfidf(c, "id").collect():
        norm = math.sqrt(sum(weight(r.id, w) ** 2 for w in set(docs[r.id].split())))
        assert r.score == pytest.approx(weight(r.id, r.term) / norm)
