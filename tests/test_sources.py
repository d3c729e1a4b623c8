import pandas as pd
import pytest

from pollweave.sources import documents, sheets, sinks
from pollweave.streaming import votes as V


def test_workbook_round_trip(spark, tmp_path):
    path = str(tmp_path / "b.xlsx")
    spark.dataSource.register(sheets.Sheets)
    df = spark.createDataFrame([("10", 1, "a & <b>"), ("2", 2, None), ("2", 3, " x ")], "session string, votes int, name string")
    df.write.format("sheets").mode("append").option("path", path).save()
    assert [n for n, _ in sheets.sheet_names(path)] == ["2", "10"]
    back = sheets.workbook(spark, path, {"votes": "bigint", "name": "string", "none": "double"})
    assert sorted((r.session, r.votes, r.name, r.none) for r in back.collect()) == [("10", 1, "a & <b>", None), ("2", 2, None, None), ("2", 3, " x ", None)]
    assert {r.session for r in sheets.workbook(spark, path, {"votes": "int"}, which="last").collect()} == {"10"}
    assert sheets.workbook(spark, path, {"votes": "int"}, sheet="2").count() == 2


def test_workbook_needs_a_shared_folder(tmp_path):
    from types import SimpleNamespace

    w = sheets.SheetWriter({"path": str(tmp_path / "b.xlsx")}, SimpleNamespace(fields=[SimpleNamespace(name="session"), SimpleNamespace(name="v")]))
    done = [w.write(iter([("1", 2), (None, 3)])), w.write(iter([])), None]
    w.commit(done)
    assert [n for n, _ in sheets.sheet_names(str(tmp_path / "b.xlsx"))] == ["1", ""] and not [p for p in tmp_path.iterdir() if "staged" in p.name]
    lost = [w.write(iter([("1", 2)]))]
    w.abort(lost)  # as on a node whose folder is its own
    with pytest.raises(OSError, match="shared by all nodes"):
        w.commit(lost)


def test_headers():
    assert sheets.headers(["a ", "b", "a", None]) == ["a", "b", "a.1", "column4"]


def test_csv_with_mark(spark, tmp_path):
    out = str(tmp_path / "c")
    sinks.csv_by_key(spark.createDataFrame([("k", "w", 1)], "name string, keyword string, n int"), out, "name")
    files = list((tmp_path / "c").rglob("*.csv"))
    assert files[0].read_bytes().startswith(b"\xef\xbb\xbf")
    assert spark.read.option("header", True).csv(out).columns == ["keyword", "n", "name"]


def test_page_cache(spark, tmp_path):
    (tmp_path / "0cc175b9c0f1b6a831c399e269772661.txt").write_text("text of a", encoding="utf-8")
    urls = spark.createDataFrame([("a",), ("b",)], "url string")
    got = documents.cached_pages(urls, "url", documents.page_files(spark, str(tmp_path)))
    assert {r.url: r.text for r in got.collect()} == {"a": "text of a", "b": ""}


def test_stop_words(spark, tmp_path):
    f = tmp_path / "s.txt"
    f.write_text("a\nb\na\n\n")
    assert sorted(r.word for r in documents.stop_words(spark, str(f), ("c", "a")).collect()) == ["a", "b", "c"]


def test_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    pd.DataFrame({"session": ["1", "1", "2"], "votes": ["3", "x", None]}).to_parquet(src / "a.parquet")
    s = V.vote_stream(spark, str(src), "session string, votes string")
    q = V.run_available(V.running_totals(s, "session", "votes"), "totals", str(tmp_path / "cp"))
    q.awaitTermination(60)
    assert {r.session: r.total for r in spark.table("totals").collect()} == {"1": 3, "2": 0}
