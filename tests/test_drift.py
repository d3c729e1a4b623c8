import json

from pollweave.operators import drift


def _records(spark, rows):
    return spark.createDataFrame([(i, b, s, n, j if isinstance(j, str) or j is None else json.dumps(j, ensure_ascii=False)) for i, (b, s, n, j) in enumerate(rows)], "rec_id long, book string, sheet_no long, row_no long, record_json string")


ROWS = [
    ("vote_music_jp-1", 1, 1, {"排名": 1, "得票数": 5, "译名": "a"}),
    ("vote_music_jp-1", 1, 2, {"排名": 2, "译名": None}),
    ("vote_music_jp-1", 2, 1, {"译名": ["a", "b"], "rank": 1.5, "得票数": 7}),
    ("vote_music_jp-1", 3, 1, {"rank": 2.0, "译 名": ["c"], "备注": "x", "得票数": None}),
    ("vote_music_jp-1", 3, 1, {"rank": 2.0, "译 名": ["c"], "备注": "x", "得票数": None}),
    ("vote_music_jp-1", 4, 1, {"rank": 2.0, "译 名": ["c"], "备注": "x", "得票数": "约9票"}),
    ("vote_music_jp-2", 1, 1, {"排名": 1}),
    ("other-1", 1, 1, {"Ａ ": 1}),
    ("other-1", 2, 1, {"Ａ ": "1"}),
    ("other-1", 2, 2, "no json"),
    ("other-1", 2, 3, "[1]"),
    ("other-1", 2, 4, None),
]


def test_changes(spark):
    got = {(r.book, r.sheet_no, r.header, r.drift) for r in drift.changes(drift.file_schemas(_records(spark, ROWS))).collect()}
    assert got == {
        ("vote_music_jp-1", 2, "rank", "renamed"), ("vote_music_jp-1", 2, "rank", "retyped"), ("vote_music_jp-1", 2, "译名", "retyped"),
        ("vote_music_jp-1", 3, "译 名", "renamed"), ("vote_music_jp-1", 3, "备注", "added"), ("other-1", 2, "Ａ ", "retyped"),
    }


def test_removed_and_versions(spark):
    rows = [("vote_music_cn-1", 1, 1, {"名次": 1, "译名": "x"}), ("vote_music_cn-1", 2, 1, {"译名": "x"}), ("vote_music_cn-1", 3, 1, {"译名": "y"})]
    s = drift.file_schemas(_records(spark, rows))
    assert [(r.sheet_no, r.header, r.drift) for r in drift.changes(s).collect()] == [(2, "名次", "removed")]
    assert [r.version for r in drift.versions(s).orderBy("sheet_no").collect()] == [1, 2, 2]


def test_two_headers_of_one_field(spark):
    rows = [("vote_music_jp-1", 1, 1, {"得票数": 1}), ("vote_music_jp-1", 2, 1, {"得票数": 1, "票数": 2})]
    assert [(r.header, r.drift) for r in drift.changes(drift.file_schemas(_records(spark, rows))).collect()] == [("票数", "added")]


def test_unified(spark):
    m = next(m for m in drift.MIGRATIONS if m.book_kind == "vote_music_jp")
    got = {(r.sheet_no, r.row_no): r for r in drift.unified(_records(spark, ROWS[:4] + ROWS[5:6]), m).collect()}
    assert got[1, 1]["得票数"] == 5 and got[2, 1]["排名"] == 1 and got[2, 1]["译名"] == "a" and got[4, 1]["得票数"] == 9
    assert got[1, 2]["译名"] is None and got[4, 1]["extra"] == {"备注": "x"}


def test_chains(spark):
    schemas = drift.file_schemas(_records(spark, [*ROWS, ("vote_music_jp-3", 1, 1, {"排名": 7, "得票数": 7, "译名": "z"}), ("vote_music_jp-3", 2, 1, {"得票数": 1, "票数": "2", "x": 1})]))
    got = {r["fingerprint"]: r for r in drift.chains(schemas).collect()}
    files = {(r.book, r.sheet_no): got[r.fingerprint] for r in drift.versions(schemas).collect()}
    assert len(got) == 8 and files["vote_music_jp-1", 1]["n_files"] == 2  # the same schema in two books
    steps = lambda b, n: [tuple(s) for s in files[b, n]["steps"] if s["op"] != "default"]
    assert steps("vote_music_jp-1", 1) == []
    assert steps("vote_music_jp-1", 2) == [("rename", "rank", "排名", None), ("cast", "rank", "排名", "decimal"), ("cast", "译名", "译名", "array")]
    assert steps("vote_music_jp-3", 2) == [("merge", "票数", "得票数", None), ("cast", "票数", "得票数", "string"), ("keep", "x", "x", None)]
    assert steps("other-1", 1) == [("keep", "Ａ ", "Ａ ", None)]
    assert {s["field"] for s in files["vote_music_jp-3", 2]["steps"] if s["op"] == "default"} == {"排名", "上回名次", "本名票数", "评论数", "曲目", "译名"}
    assert drift.chains(schemas.limit(0)).count() == 0


def test_defaults(spark):
    m = drift.Migration("k", (drift.Rule("a", "bigint", ("b",), 7), drift.Rule("c", "string", (), "none")))
    u = drift.unified(_records(spark, [("k-1", 1, 1, {"b": 1}), ("k-1", 2, 1, {"d": 1})]), m)
    assert sorted((r.sheet_no, r.a, r.c, str(r.extra)) for r in u.collect()) == [(1, 1, "none", "{}"), (2, 7, "none", "{'d': '1'}")]


def test_empty(spark):
    assert drift.changes(drift.file_schemas(_records(spark, ROWS).limit(0))).count() == 0


def test_plain_header():
    assert drift.plain_header("票 数（张）") == "票数" and drift.plain_header("RANK ") == "rank"


def test_long_form_has_every_value(spark):
    rows = [
        ("vote_music_jp-1", 1, 1, {"排名": 1, "票数": 6, "得票数": 5, "译 名": ["a", "旧译", "暂"], "备注": "x", "新": 1.5}),
        ("vote_music_jp-1", 1, 2, {"得票数": None, "票数": 7, "曲目": "[注]", "备 注": None}),
        ("other-1", 1, 1, {"Ａ ": 1, "b": ["c", "d"]}),
        ("other-1", 1, 2, "no json"),
    ]
    got = {}
    for r in drift.long_form(_records(spark, rows)).collect():
        got.setdefault((r.kind, r.row_no), []).append((r.field, r.value))
    none = [("上回名次", None), ("本名票数", None), ("评论数", None)]
    assert sorted(got["vote_music_jp", 1], key=str) == sorted([*none, ("排名", "1"), ("得票数", "5"), ("票数", "6"), ("曲目", None), ("译名", "a"), ("译名", "旧译"), ("译名", "暂"), ("备注", "x"), ("新", "1.5")], key=str)
    assert sorted(got["vote_music_jp", 2], key=str) == sorted([*none, ("排名", None), ("得票数", "7"), ("得票数", None), ("曲目", "[注]"), ("译名", None), ("备注", None)], key=str)
    assert got["other", 1] == [("Ａ ", "1"), ("b", '["c","d"]')] and len(got) == 3
    u = drift.unified(_records(spark, rows[:1]), next(m for m in drift.MIGRATIONS if m.book_kind == "vote_music_jp")).first()
    assert u["译名"] == "a" and u["extra"] == {"票数": "6", "译 名": '["旧译","暂"]', "备注": "x", "新": "1.5"}


def test_query_has_every_value(spark, tmp_path):
    from pollweave.plans import general

    _records(spark, [("vote_music_jp-1", 1, 1, {"排名": 1, "备注": "x"}), ("other-1", 1, 1, {"a": 1})]).write.parquet(str(tmp_path / "sheet_rows.parquet"))
    got = {(r.kind, r.field, r.value) for r in general.p2_unified(spark, str(tmp_path)).collect()}
    assert {("vote_music_jp", "排名", "1"), ("vote_music_jp", "备注", "x"), ("other", "a", "1")} <= got


def test_failed_casts_are_kept(spark):
    rows = [("vote_music_jp-1", 1, 1, {"rank": "暂无", "得票数": 777.5, "评论数": "约9条", "译名": "a", "上回名次": "", "本名票数": ["x", 3]})]
    m = next(m for m in drift.MIGRATIONS if m.book_kind == "vote_music_jp")
    u = drift.unified(_records(spark, rows), m).first()
    assert u["排名"] is None and u["得票数"] == 777 and u["评论数"] == 9
    assert u["extra"] == {"rank": "暂无", "得票数": "777.5", "本名票数": '["x",3]'}
    got = {(r.field, r.value) for r in drift.long_form(_records(spark, rows)).collect()}
    assert {("排名", "暂无"), ("得票数", "777"), ("得票数", "777.5"), ("本名票数", "x"), ("本名票数", "3")} <= got
