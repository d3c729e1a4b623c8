import itertools
import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pollweave.functions.html import text_of
from pollweave.operators import keywords, segment
from pollweave.sources import documents

WORDS = {"千纸": 5, "一华": 4, "千纸一华": 9, "主题": 3, "主题曲": 6, "曲": 1, "Ox": 2}


def test_cut():
    s = segment.Segmenter(WORDS)
    assert s.cut("千纸一华的主题曲, Quill Ox3!") == ["千纸一华", "的", "主题曲", "quill", "ox3"]
    assert s.cut(None) == s.cut("") == s.cut("。!") == [] and segment.Segmenter({}).cut("千纸 a") == ["千", "纸", "a"]
    assert len(s.cut("千纸一华" * 50_000)) == 50_000


@settings(deadline=None, max_examples=100)
@given(st.dictionaries(st.text("甲乙丙", min_size=1, max_size=3), st.integers(1, 9), max_size=8), st.text("甲乙丙丁", min_size=1, max_size=7))
def test_cut_is_the_likeliest(words, text):
    s = segment.Segmenter(words)
    cost = lambda parts: sum(s.cost.get(p, s.alone if len(p) == 1 else math.inf) for p in parts)
    ways = [[text[a:b] for a, b in itertools.pairwise((0, *cuts, len(text)))] for k in range(len(text)) for cuts in itertools.combinations(range(1, len(text)), k)]
    got = s.cut(text)
    assert "".join(got) == text and cost(got) == pytest.approx(min(map(cost, ways)))


def test_segmented_table(spark, monkeypatch):
    d = spark.createDataFrame([(1, "千纸一华", "x"), (2, None, "x"), (2, "", "x")], "id int, t string, words string")
    table = spark.createDataFrame([("千纸一华", 1), ("千纸一华", None), (None, 3)], "w string, n int")
    seg = segment.dictionary(table, "w", "n")
    assert seg.words == {"千纸一华": 2}
    assert [(r.id, r.words) for r in segment.segmented(d, "id", "t", seg).collect()] == [(1, ["千纸一华"]), (2, []), (2, [])]
    monkeypatch.setattr(segment, "DICTIONARY_MAX", 3)
    with pytest.raises(ValueError, match="characters"):
        segment.dictionary(table, "w")


def test_fetching(spark, tmp_path):
    page = tmp_path / "a.html"
    page.write_text("<p>one <b>two</b></p><script>x</script>", encoding="utf-8")
    good, bad = page.as_uri(), (tmp_path / "none").as_uri()
    cache = spark.createDataFrame([("0cc175b9c0f1b6a831c399e269772661", "text of a")], "url_md5 string, text string")
    urls = spark.createDataFrame([("a",), (good,), (bad,), (bad,), (None,)], "url string")
    fetcher = documents.Fetcher(retries=1, pause=0.0)
    got = {r.url: r for r in documents.cached_or_fetched(urls, "url", cache, fetcher, text_of).collect()}
    assert got["a"].text == "text of a" and got["a"].cached and got[good].text == "one two" and not got[good].error
    assert got[bad].text == "" and "URLError" in got[bad].error and len(got) == 3
    documents.save_pages(documents.cached_or_fetched(urls, "url", cache, fetcher, text_of), str(tmp_path / "cache"))
    saved = documents.page_files(spark, str(tmp_path / "cache"))
    again = documents.cached_or_fetched(urls.where(F.col("url") == good), "url", saved, documents.Fetcher(read=None, retries=0)).collect()
    assert [(r.text, r.cached) for r in again] == [("one two", True)]


def test_retries():
    tries = []

    def read(url, timeout):
        tries.append(url)
        if len(tries) < 3:
            raise TimeoutError("slow")
        return "ok"

    assert documents.Fetcher(pause=0.0, read=read)("u") == ("ok", None) and len(tries) == 3

    class Gone(Exception):
        code = 404

    def gone(url, timeout):
        tries.append(url)
        raise Gone("x")

    tries.clear()
    assert documents.Fetcher(pause=0.0, read=gone)("u") == ("", "Gone: x") and len(tries) == 1


def test_terms_of_entities_equal_their_concatenation(spark):
    rng = random.Random(4)
    pages = [(f"e{rng.randrange(4)}", i, " ".join(rng.choice("abcdef") for _ in range(rng.randint(0, 12)))) for i in range(40)]
    df = spark.createDataFrame(pages, "e string, p int, t string")
    one = keywords.top_terms(keywords.entity_counts(df, "e", "t", "p"), "e", 9)
    two = keywords.top_terms(keywords.term_counts(keywords.concatenated(df, "e", "t", "p"), "e", "text"), "e", 9)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_tfidf_with_a_given_table(spark):
    c = keywords.term_counts(spark.createDataFrame([(1, "a a b c"), (2, "")], "id int, t string"), "id", "t")
    idf = spark.createDataFrame([("a", 1.0), ("b", 9.0), ("x", 2.0)], "term string, idf double")
    got = [(r.term, r.score) for r in keywords.tfidf_of_document(c, "id", idf, 3).orderBy("rank").collect()]
    assert got == [("b", 2.25), ("a", 0.5), ("c", 0.5)]  # c has the median; of equals the first to stand
    assert {r.score for r in keywords.tfidf_of_document(c, "id", idf.limit(0)).collect()} == {0.0}


def test_textrank_filters_before_the_best_are_taken(spark):
    d = spark.createDataFrame([(1, "aa x bb x cc x aa x".split())], "id int, w array<string>")
    all_ = [r.term for r in keywords.textrank(d, "id", F.col("w")).orderBy("rank").collect()]
    assert all_[0] == "x"
    kept = keywords.textrank(d, "id", F.col("w"), 2, first=3, keep=lambda w: w != "x").orderBy("rank").collect()
    assert [r.term for r in kept] == all_[1:3] and [r["rank"] for r in kept] == [1, 2]
