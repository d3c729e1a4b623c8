import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pollweave.operators import packed
from pollweave.operators.packed import Grammar, split_packed

KNOWN = ["桔梗,笹里", "绫帆 & 萌黄", '铃峰"小铃"', "弥荻|鸢尾"]


@pytest.mark.parametrize(
    "field, values",
    [
        ("a|b", ["a", "b"]),
        (" a 、 b；c ", ["a", "b", "c"]),
        ("a||b|", ["a", "b"]),
        ('"a|b"|c', ["a|b", "c"]),
        ('"x""y"、z', ['x"y', "z"]),
        ("「a、b」+c", ["a、b", "c"]),
        ("桔梗,笹里,雪", ["桔梗,笹里", "雪"]),
        ("绫帆 & 萌黄 & 钟", ["绫帆 & 萌黄", "钟"]),
        ('铃峰"小铃"|弥荻|鸢尾', ['铃峰"小铃"', "弥荻|鸢尾"]),
        ('["a", "b,c"]', ["a", "b,c"]),
        ("[]", ["[]"][:0]),
        ("Orbit Nine/Mira", ["Orbit Nine", "Mira"]),
        ("a|a", ["a", "a"]),
        ("", []),
        (" \t ", []),
    ],
)
def test_values(field, values):
    assert [v for v, _ in Grammar(KNOWN).values(field)] == values


@pytest.mark.parametrize("field, flags", [('"a|b', ["unclosed", None]), ('"a"b|c', ["stray", None]), ('["a", b]', ["json", "json"])])
def test_flags(field, flags):
    assert [f for _, f in Grammar().values(field)] == flags


name = st.text(alphabet="ab中'\"|、 ", min_size=1, max_size=6).map(str.strip).filter(lambda s: s and not s.startswith(("'", '"')))


@settings(deadline=None, max_examples=200)
@given(st.lists(name, min_size=2, max_size=6))
def test_quoted_round_trip(names):
    field = "|".join('"' + n.replace('"', '""') + '"' for n in names)
    assert [v for v, _ in Grammar().values(field)] == names


@settings(deadline=None, max_examples=300)
@given(st.text(alphabet="ab\"'「」[]|、 ", max_size=40))
def test_any_text_ends(field):
    assert all(v == v.strip() and v for v, _ in Grammar().values(field))


def test_long_field():
    assert len(Grammar().values("|".join(["x"] * 50_000))) == 50_000
    Grammar().values('"' * 20_001)
    Grammar().values('"a|' * 20_000)


def test_split(spark):
    df = spark.createDataFrame([(1, "a|b", "x"), (1, "a|b", "x"), (2, None, "y"), (3, "", None), (None, "c", "z")], "id int, f string, pos string")
    got = sorted((r["id"] or 0, r["p"], r["val"], r["n_values"]) for r in split_packed(df, "f", ["id"], pos="p").collect())
    assert got == [(0, 1, "c", 1), (1, 1, "a", 2), (1, 1, "a", 2), (1, 2, "b", 2), (1, 2, "b", 2)]
    assert split_packed(df.limit(0), "f", ["id"]).count() == 0
    with pytest.raises(ValueError):
        split_packed(df, "f", ["pos"])


def test_joined_names_equal_sent_names(spark, monkeypatch):
    odd = [*KNOWN, '铃峰"小铃"', "甲,乙,丙", "Quill/Ox"]
    rows = [(1, "桔梗,笹里,雪"), (2, "雪|弥荻|鸢尾"), (3, "a,b"), (4, '雪;铃峰"小铃";a'), (5, "甲,乙,丙,丁"), (6, "x、甲,乙"), (7, '["a,b","甲,乙,丙"]'), (8, "「甲,乙,丙」|Quill/Ox"), (8, "雪|雪"), (9, "'甲,乙,丙'"), (10, None)]
    df = spark.createDataFrame(rows, "id int, f string")
    names = spark.createDataFrame([(k,) for k in [*odd, None, "plain"]], "n string")
    key = lambda d: sorted((r["id"], r["pos"], r["val"]) for r in d.collect())
    sent = packed.known_names(names, "n")
    assert isinstance(sent, list) and "plain" not in sent
    monkeypatch.setattr(packed, "KNOWN_CHARS_MAX", 3)
    joined = packed.known_names(names, "n")
    assert isinstance(joined, tuple)
    want = key(split_packed(df, "f", ["id"], sent))
    assert key(split_packed(df, "f", ["id"], joined)) == want and (5, 1, "甲,乙,丙") in want and (4, 2, '铃峰"小铃"') in want
    assert split_packed(df.limit(0), "f", ["id"], joined).count() == 0 == split_packed(df, "f", ["id"], (names.limit(0), "n")).where("id = 10").count()


def test_spans_are_as_long_as_names():
    got = packed._spans("|".join("abcdefgh"), "|", 3)
    assert sorted(got) == sorted(["a|b", "b|c", "c|d", "d|e", "e|f", "f|g", "g|h", "a|b|c", "b|c|d", "c|d|e", "d|e|f", "e|f|g", "f|g|h"])
    assert len(packed._spans("a|" * 20_000, "|", 4)) <= 8 and packed._spans(None, "|", 2) == []
