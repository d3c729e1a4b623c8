import random
import re
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from pollweave.llm import boilerplate, canonical, langid, leakage, lookalike


# look-alike text


def test_classes_are_transitive():
    m = lookalike.classes([["a", "b"], ["b", "c"], ["x", "y"]], {"c": 5})
    assert m["a"] == m["b"] == m["c"] == "c" and m["x"] == m["y"] == "x"


@pytest.mark.parametrize(
    "a, b, same",
    [
        ("Ｑｕｉｌｌ Ox", "Quill Ox", True), ("Quіll​ Оx", "QuillOx", True), ("テ‍゙", "デ", True), ("ﾉｴﾙ･ﾄﾙｶﾞｰ", "ノエル・トルガー", True),
        ("雷茧ニ乃", "雷茧二乃", True), ("埃洛蒂‧托卢加", "埃洛蒂·托卢加", True), ("霧岬", "雾岬", False), ("quill Ox", "Quill Ox", False), ("千纸一华酱", "千纸一华", False), ("デ", "テ", False),
        ("Lantem", "Lantern", True), ("Lanteгո", "Lantem", True), ("vvw", "wvv", True), ("wvvv", "vww", True), ("clog", "ԁog", True), ("ΣΟ", "CO", False), ("森", "木木木", True), ("林木", "木林", True), ("rn", "nr", False),
    ],
)
def test_folding(a, b, same):
    f = lookalike.Folder()
    assert (f(a) == f(b)) is same


def test_found_lookalikes(spark):
    ref = spark.createDataFrame([("雷茧二乃", 1), ("雷茧二乃", 2), (None, 3)], "name string, form int")
    df = spark.createDataFrame([(1, "雷茧ニ乃", "z"), (1, "雷茧ニ乃", "z"), (2, "雷茧二乃", ""), (3, None, ""), (4, "​", ""), (5, "x" * 100_000, ""), (None, "雷 茧二乃", "")], "id int, v string, value string")
    got = lookalike.found(df, "v", ["id"], ref, "name").collect()
    assert sorted((r.id or 0, r.looks_like) for r in got) == [(0, "雷茧二乃"), (1, "雷茧二乃"), (1, "雷茧二乃")]
    assert lookalike.found(df.limit(0), "v", ["id"], ref, "name").count() == 0
    assert lookalike.found(df, "v", ["id"], ref.limit(0), "name").count() == 0


# canonical names


def _jaccard(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.9])
def test_similarity_join_is_exact(spark, threshold):
    rng = random.Random(3)
    make = lambda n: [(i, sorted({rng.choice("abcdefghijkl") for _ in range(rng.randint(1, 8))})) for i in range(n)]
    left, right = make(60), make(40)
    schema = "id int, tokens array<string>"
    got = {(r.l, r.r) for r in canonical.similarity_join(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), threshold).collect()}
    assert got == {(i, j) for i, a in left for j, b in right if _jaccard(a, b) >= threshold}


def test_reference_in_memory_is_exact():
    rng = random.Random(3)
    make = lambda n: [sorted({rng.choice("abcdefghijkl") for _ in range(rng.randint(1, 8))}) for i in range(n)]
    left, right = make(200), make(60)
    for t in (0.22, 0.6, 0.9, 1.0):
        ref = canonical.Reference([(str(i), "x", True, ts) for i, ts in enumerate(right)], (t,))
        for a in left:
            got = {(ref.rows[i][0], round(j, 9)) for j, i in ref.matches([*a], t)}
            assert got == {(str(i), round(_jaccard(a, b), 9)) for i, b in enumerate(right) if _jaccard(a, b) >= t}


@pytest.mark.parametrize("most", [0, canonical.REFERENCE_MAX])
def test_mapping(spark, monkeypatch, most):
    monkeypatch.setattr(canonical, "REFERENCE_MAX", most)
    ref = spark.createDataFrame([("雾岬椿姬",), ("千纸一华",), ("Quill Ox",), ("漫长的极光前线 ～ Long Aurora",), ("千纸一华",)], "value string")
    typed = {"《千纸一华》": "千纸一华", "千纸一": "千纸一华", "一华 千纸": "千纸一华", "qUILL OX!": "Quill Ox", "投给雾岬椿姬 (3)": "雾岬椿姬", "漫长的极光前线": "漫长的极光前线 ～ Long Aurora", "看心情": None, "？？？": None, "": None, "千纸一华": "千纸一华", "x" * 5000: None}
    df = spark.createDataFrame([(k,) for k in [*typed, None, "千纸一"]], "value string")
    got = {r.value: r.ref_name for r in canonical.mapped(df, ref).collect()}
    assert got == typed
    assert canonical.mapped(df.limit(0), ref).count() == 0
    assert {r.ref_name for r in canonical.mapped(df, ref.limit(0)).collect()} == {None}


def test_variants_are_learned(spark):
    ref = spark.createDataFrame([(f"雾{a}{b}山",) for a in "甲乙丙丁" for b in "子丑寅"], "value string")
    df = spark.createDataFrame([(f"霧{a}{b}山",) for a in "甲乙丙" for b in "子丑寅"], "value string")
    refs = canonical._sets(ref, None, True, False)
    assert canonical.learn_variants(canonical._sets(df, None, False, True), refs) == {"霧": "雾"}
    known = {}
    assert {r.value: r.ref_name for r in canonical.mapped(df, ref, known=known).collect()} == {r.value: r.value.replace("霧", "雾") for r in df.collect()}
    assert known == {"霧": "雾"}


# evaluation passages


def _items():
    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(3, 9)))
    return [" ".join(word() for _ in range(60)) for _ in range(6)]


def test_letters():
    x, start = leakage.letters(["Ａb, c!", "", "Straße ½", "が"])
    assert ["".join(map(chr, x[a:b])) for a, b in zip(start, start[1:])] == ["abc", "", "strasse12", "が"]


def _passages(text, item):
    ix = leakage.Index([1], [item])
    return max((p for *_, p in leakage.Finder(ix).find([text])), default=0)


@pytest.mark.parametrize("n, changes, found", [(60, 0, True), (44, 0, True), (36, 0, False), (80, 7, True), (80, 20, False), (41, 4, True)])
def test_passages(n, changes, found):
    item = _items()[0]
    flat = re.sub(r"\W", "", item)[30 : 30 + n]
    at = np.linspace(3, n - 4, changes).astype(int) if changes else []
    typed = list(flat)
    for i in at:
        typed[i] = "0"
    text = "before it, some words. > " + "".join(c.upper() + ("​ \n> " if i % 7 == 3 else "") for i, c in enumerate(typed)) + " and after."
    assert (_passages(text, item) >= 40) is found


def test_missing_letters_and_short_texts():
    item = _items()[1]
    flat = re.sub(r"\W", "", item)[10:90]
    cut = "".join(c for i, c in enumerate(flat) if i % 14 != 5)
    assert _passages("x " + cut, item) >= 70
    assert _passages("", item) == 0 and _passages("abc", item) == 0


def test_reordered_passages_are_covered():
    item = _items()[2]
    flat = re.sub(r"\W", "", item)
    parts = [flat[i : i + 45] for i in range(0, 180, 45)]
    ix = leakage.Index([7], [item])
    (d, i, n, covered, longest) = next(iter(leakage.Finder(ix).find([" zzz ".join(reversed(parts))])))
    assert n >= 4 and covered >= 170 and 40 <= longest < 60


def test_tiles_do_not_overlap():
    a = "abcdefghij" * 3 + "klmnopq" + "abcdefghij"
    x, _ = leakage.letters([a])
    h = leakage.grams(x)
    d, i = np.nonzero(h[:, None] == h[None, :])
    t = leakage.tiles(d, i)
    assert t == [(0, 0, len(a))]


def test_long_items_and_many_items():
    rng = np.random.default_rng(5)
    codes = rng.integers(0x4E00, 0x9F00, 3_000_000)
    long = "".join(map(chr, codes.tolist()))
    ix = leakage.Index([1, 2], [long, "x" * 50])
    for at in (1_000_000, 2_300_000, 2_990_000):
        assert [(i, p) for _, i, _, _, p in leakage.Finder(ix).find(["nothing", long[at : at + 120]])] == [(0, 120)]
    # so many items that a pair and its band do not fit beside a place: numbered anew, the same result
    items = [long[k : k + 60] for k in range(0, 60_000, 60)]
    ix = leakage.Index(list(range(len(items))), items)
    texts = [items[3] + "abc" + items[7][:41], "-" * 9, items[999]]
    want = sorted(leakage.Finder(ix).find(texts))
    assert [(d, i) for d, i, *_ in want] == [(0, 3), (0, 7), (2, 999)]
    ix.ids = range(1 << 45)  # only its length counts here
    assert sorted(leakage.Finder(ix).find(texts)) == want


def test_covered_in_short_pieces():
    item = _items()[2]
    flat = re.sub(r"\W", "", item)[:300]
    parts = [flat[k : k + 20] for k in range(0, len(flat), 20)]
    random.Random(2).shuffle(parts)
    ix = leakage.Index([7], [flat])
    ((_, _, n, covered, longest),) = leakage.Finder(ix).find(["".join(parts)])
    assert n >= 8 and covered >= 0.9 * len(flat) and longest < covered


@pytest.mark.parametrize("block", [0, leakage.ITEM_BLOCK])
def test_leaks_against_brute_force(spark, monkeypatch, block):
    """Both ways give the same; every document with 40 letters of an item of which at most four are changed is found."""
    monkeypatch.setattr(leakage, "ITEM_BLOCK", block)
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    items = [word(rng.randint(45, 200)) for _ in range(12)]
    docs, want = [], set()
    for d in range(120):
        i = rng.randrange(len(items))
        at = rng.randint(0, len(items[i]) - 42)
        cut = list(items[i][at : at + rng.choice([25, 40, 42])])
        spots = rng.sample(range(3, len(cut) - 3), rng.randint(0, 4))
        for k in spots:
            cut[k] = "0"
        docs.append((d, word(60) + "".join(cut) + word(rng.randint(0, 80)), "k"))
        if len(cut) >= 40:
            want.add((d, i))
    df = spark.createDataFrame([*docs, docs[0], (900, None, None), (901, "", None)], "doc int, text string, k string")
    ev = spark.createDataFrame([*enumerate(items), (3, items[3]), (None, items[4]), (77, None)], "item int, text string")
    got = [(r.doc, r.item) for r in leakage.leaks(df, "doc", "text", ev, "item", "text").where("passage >= 40").collect()]
    assert set(got) == want
    twice = lambda p: (1 + (p[0] == docs[0][0])) * (1 + (p[1] == 3))
    assert sorted(got) == sorted(p for p in want for _ in range(twice(p)))


def test_leaks_table(spark):
    items = _items()
    flat = re.sub(r"\W", "", items[0])[:100]
    docs = spark.createDataFrame([(1, "see " + flat, "a"), (1, "see " + flat, "a"), (2, None, None), (3, "", "b"), (4, "nothing here " * 5000, "c")], "doc int, text string, item_letters string")
    evals = spark.createDataFrame([*[(i, t) for i, t in enumerate(items)], (99, None), (98, "")], "item int, text string")
    got = leakage.leaks(docs, "doc", "text", evals, "item", "text").where("passage >= 40").collect()
    assert [(r.doc, r.item) for r in got] == [(1, 0), (1, 0)]
    assert leakage.leaks(docs, "doc", "text", evals.limit(0), "item", "text").count() == 0
    assert leakage.leaks(docs.limit(0), "doc", "text", evals, "item", "text").count() == 0
    with pytest.raises(ValueError):
        leakage.leaks(docs, "doc", "text", evals.withColumnRenamed("item", "doc"), "doc", "text")


# languages

SAMPLES = {
    "en": "the part is far too short and nobody has explained it since, which is why it got my vote in the poll",
    "fr": "le thème de cette scène porte encore la mélodie et personne n’a su dire pourquoi dans ce vote",
    "de": "das Thema trägt die Stimmung der ganzen Geschichte und niemand weiß genau warum sie gewonnen hat",
    "zh": "这一届投票里她的主题曲突然改变了整个故事的节奏，原因至今没有定论。",
    "ja": "今回の投票では、彼女のテーマ曲はいつも物語のテンポを支えていると思う。",
    "ko": "이번 투표에서 그녀의 테마곡은 언제나 이야기 전체의 흐름을 받쳐 주고 있다.",
}


@pytest.fixture(scope="module")
def model():
    return langid.Model.fit([t for t in SAMPLES.values() for _ in range(5)], [k for k in SAMPLES for _ in range(5)])


def _label(text, model):
    d, seg, lang, sure, n = langid.label_block([text], model)
    return {int(s): str(x) for s, x in zip(seg, lang)}, sure


@pytest.mark.parametrize("lang", list(SAMPLES))
def test_one_language(lang, model):
    got, sure = _label(SAMPLES[lang], model)
    assert got == {0: lang, 1: lang} and ((sure >= 0) & (sure <= 1)).all()


def test_mixed_lines(model):
    text = "\n".join([SAMPLES["zh"] * 4, SAMPLES["en"], "千纸一华、雾岬椿姬、Quill Ox", "No.123", "https://pics.example.invalid/1.png", "★★★", "", SAMPLES["zh"], SAMPLES["ko"]])
    got, _ = _label(text, model)
    assert got[0] == "zh" and got[2] == "en" and got[9] == "ko" and not set(got) & {3, 5, 6, 7}


def test_no_letters(model):
    assert _label("★ 12/34 \n---", model)[0] == {} and _label("", model)[0] == {}


def test_viterbi_against_brute_force():
    rng = np.random.default_rng(0)
    e = rng.normal(size=(12, 3)).astype(np.float32)
    doc = np.repeat([0, 1, 3], [5, 4, 3])
    got = langid.viterbi(e, doc, 4, 1.0)
    import itertools

    for k in (0, 1, 3):
        at = np.flatnonzero(doc == k)
        score = lambda p: sum(e[i, s] for i, s in zip(at, p)) - sum(a != b for a, b in zip(p, p[1:]))  # noqa: B023
        assert score(got[at]) == pytest.approx(max(map(score, itertools.product(range(3), repeat=len(at)))), abs=1e-4)


@pytest.mark.parametrize("label, lang", [("zh-CN", "zh"), ("ZH", "zh"), ("zho", "zh"), ("und", None), ("", None), (None, None), ("en_US", "en"), ("deu", "de")])
def test_labels(label, lang):
    assert langid.label_of(label) == lang


def test_language_table(spark, model):
    rows = [(1, SAMPLES["en"], "de", 0), (2, SAMPLES["en"], "EN", 0), (3, None, "en", 0), (4, "", None, 0), (5, SAMPLES["ja"] * 4 + "\n" + SAMPLES["de"], "ja-JP", 0), (5, SAMPLES["ja"] * 4 + "\n" + SAMPLES["de"], "ja-JP", 0), (6, SAMPLES["fr"] * 2000, None, 0)]
    df = spark.createDataFrame(rows, "id int, t string, l string, seg_no int")
    got = sorted((r.id, r.seg_no, r.lang) for r in langid.corrections(df, "id", "t", "l", model).collect())
    assert got == [(1, 0, "en"), (5, 2, "de"), (5, 2, "de"), (6, 0, "fr")]
    assert langid.corrections(df.limit(0), "id", "t", "l", model).count() == 0
    m = langid.trained(df, "id", "t", "l")
    assert langid.languages(df, "id", "t", m).where("seg_no = 0").count() == 5


# page content

PAGE = """首页 | 帮助中心 | 最近修改 | 注册 | 登录
本站使用 Cookie 分析流量来源，继续浏览即表示同意。
大家都在看
雾岬椿姬
单论人气的话，雾岬椿姬和妹妹的关系反而唤醒了本命票的…
千纸一华
概要
[编辑]
在我看来，千纸一华的主题曲突然改变了整个故事的节奏，原因至今没有定论。
> 按照惯例，千纸一华的立绘盖过了对手的全部优势，听多少遍都不会腻。
· 蓝洞八重：老实讲，蓝洞八重的弹幕多少串起了整个故事的节奏。
展开全部
轶事
听完整张专辑以后，千纸一华那段对白始终贯穿了雪夜里的那杯热茶！
此页面最后编辑于2019年7月19日 (星期五) 02:18。
返回顶部"""


# a page of another kind of site, in words that no page of the labelled table has
OTHER = """Home | Products | Pricing | Blog | About us | Careers
Sign in  Create account  Help
Lighthouses of the northern coast
History
The lighthouses of the northern coast were built between 1830 and 1912, when trade with the islands grew. Most of them replaced open fires that fishermen had kept on the cliffs for centuries.
The first keeper, a retired captain, lived alone in the tower for eleven years and recorded every storm in a diary that is now in the town archive.
Design
Each of the lighthouses has a round tower of granite blocks that narrows toward the lantern. The walls are two metres thick at the base, which is why they still stand after many winter gales.
The lamps burned oil at first, and later gas; electric light came to the northern coast only in the twenties.
Visitors may climb four of the lighthouses in summer, but the stairs are steep and there is no lift.
Related articles
Harbour walls
Tide tables
The best beaches for families...
Subscribe to our newsletter
Privacy policy | Terms of use | Contact
(c) 2023 Coast Guide. All rights reserved"""


def _content(text, known=None):
    b, x = boilerplate.features([text], known)
    return (np.flatnonzero((boilerplate.trained().predict(x) > 0.5) & b.solid) + 1).tolist()


def test_page_content():
    assert _content(PAGE) == [6, 7, 9, 10, 11, 13, 14]
    # the sentence that does not speak of lighthouses is lost, nothing of the site's own comes in
    for page in (OTHER, OTHER.replace("History", "Vergangenes").replace("Design", "Form")):
        assert _content(page) == [3, 4, 5, 7, 8, 9, 10]


def test_topic():
    assert boilerplate.Blocks([PAGE]).topics == ["千纸一华"]
    b = boilerplate.Blocks(["", "[编辑]", "x < Mira Acre\nMira Acre sang all night, and the whole town listened to the song.\nThen Mira Acre left for the coast in the early morning of May."])
    assert b.topics == ["", "", "Mira Acre"]


def test_occurrences():
    rng = random.Random(1)
    names = sorted({"".join(rng.choices("ab", k=rng.randint(1, 4))) for _ in range(40)})
    texts = ["".join(rng.choices("ab", k=rng.randint(0, 9))) for _ in range(300)]
    want = {n: sum(n in t for t in texts) for n in names if any(n in t for t in texts)}
    assert boilerplate.occurrences(names, texts) == want
    assert boilerplate.occurrences(names, texts[:40]) == {n: c for n in names if (c := sum(n in t for t in texts[:40]))}
    assert boilerplate.occurrences([], texts) == {} == boilerplate.occurrences(names, [])


@pytest.mark.parametrize("text", ["", "\n", "[编辑]", "返回顶部\n[编辑]", "概要", "概要\n", "大家都在看", "x", "。", "a < b", "\t　", "≪" * 5000, "| | |", " · ", "a\x00b"])
def test_odd_pages(text):
    b, x = boilerplate.features([text, PAGE, text])
    assert x.shape == (2 * (text.count("\n") + 1) + PAGE.count("\n") + 1, len(boilerplate.FEATURES))
    assert np.isfinite(x).all() and len(boilerplate.trained().predict(x)) == len(b.lines)
    assert (x[: text.count("\n") + 1] == x[-text.count("\n") - 1 :]).all()  # a page does not see its neighbours


def test_long_page():
    lines = ["Home | Log in", "Nine Lanes"] + ["Nine Lanes went on and on that day, number %d." % i for i in range(40_000)] + ["short %d" % i for i in range(20_000)]
    began = time.time()
    got = _content("\n".join(lines))
    assert time.time() - began < 60 and set(range(3, 40_000)) <= set(got)


def test_tree_learns_held_out_rows():
    rows = np.genfromtxt(boilerplate.LABELS, delimiter=",", skip_header=1)
    train, test = rows[::2], rows[1::2]
    tree = boilerplate.Tree().fit(train[:, :-1], train[:, -1])
    assert ((tree.predict(test[:, :-1]) > 0.5) == test[:, -1]).mean() > 0.95
    assert Path(boilerplate.LABELS).stat().st_size < 3_000_000


def test_repeated_blocks_are_counted(spark, monkeypatch):
    pages = [(i, f"Menu\nNo. {i}\nTopic {i}x\nTopic {i}x is told in a sentence that is long enough to count.\nmore") for i in range(6)]
    df = spark.createDataFrame([*pages, (9, None), (10, "")], "id int, text string")
    known = boilerplate.templates(df, "text")
    assert known["Menu"] == (1.0, 0.0, 0.0, 0.0) and known["more"] == (1.0, 0.0, 0.0, 1.0)
    assert known["No. 0"] == (1.0, 0.0, 1.0, 0.0) and known["\0"][2] == 1.0  # numbers and the topic are masked
    monkeypatch.setattr(boilerplate, "TEMPLATE_SHARE", 1.1)
    assert boilerplate.templates(df, "text") == {} == boilerplate.templates(df.limit(0), "text")


def test_pages_table(spark):
    df = spark.createDataFrame([(1, PAGE, "q"), (1, PAGE, "q"), (2, None, "q"), (3, "", "q"), (4, "首页\n帮助中心", "q"), (5, "\n".join(["首页 | 登录"] * 3000), "q"), (6, OTHER, "q")], "id int, text string, line string")
    got = boilerplate.content_lines(df, "id", "text").collect()
    assert {r.id for r in got} == {1, 6} and sum(r.id == 1 for r in got) == 14
    assert sorted(r.line_no for r in got if r.id == 6) == [3, 4, 5, 7, 8, 9, 10] and {r.line for r in got if r.id == 6} < set(OTHER.split("\n"))
    assert boilerplate.content_lines(df.limit(0), "id", "text").count() == 0


def test_labels_of_blocks(tmp_path):
    from pollweave.llm import label_blocks

    assert (np.flatnonzero(label_blocks.labels(PAGE)) + 1).tolist() == [6, 7, 9, 10, 11, 13, 14]
    n = label_blocks.write_table([PAGE, PAGE], str(tmp_path / "t.csv"), {}, bare=0)
    assert n == 16 and boilerplate.trained(tmp_path / "t.csv").predict(boilerplate.features([PAGE])[1]).shape == (16,)


def test_enumeration_commas_in_prose():
    from pollweave.llm.langid import Words

    prose = ["このキャラ、大好きです", "かわいい、大好きです", "> き、タヨロガド派は澍悼太鼓に由来すると譲らなかった", "我喜欢灵梦、魔理沙", "ブレクトは5400票、籠さゆ", "、犁悼橋だけが残った", "for me、too"]
    names = ["潮骨かおるこ、潮骨もえぎ", "千紙わかな、綿雲とびお、竜胆ちび5号", "貝鏡くちなし、ルミニ ペンドリ", "乌檐璃笑、夜汐二乃", "Orbit Parade、夢灘エドヤ、くりすorやえ", "千纸一华、雾岬椿姬、Quill Ox"]
    assert Words(["\n".join(prose + names)]).lines_without_language().tolist() == [False] * len(prose) + [True] * len(names)
    assert Words(prose).lines_without_language().tolist() == [False] * len(prose)


def test_passages_with_changes_at_the_ends():
    from pollweave.llm.leakage import Finder, Index

    item = "".join(chr(0x4E00 + x) for x in random.Random(7).sample(range(8000), 70))

    def found(text):
        return max((r[4] for r in Finder(Index([1], [item])).find([text])), default=0)

    def changed(text, at):
        return "".join("Ω" if k in at else c for k, c in enumerate(text))

    assert found(changed(item[:44], {24, 29, 34, 39})) == 44
    assert found(changed(item[:44], {4, 9, 14, 19})) == 44
    assert found(changed(item[3:67], {24, 29, 34, 39, 44, 49})) == 64 and found(changed(item[:44], {23, 28, 33, 38, 39})) < 40
    text = changed(item[:44], {27, 33})
    assert found(text[:20] + text[21:24] + "Ω" + text[24:]) == 44  # one missing, one put in, two changed


def test_topic_is_sought_in_all_sentences():
    rnd = random.Random(3)
    noise = lambda n: "".join(chr(0x5000 + rnd.randrange(8000)) for _ in range(n))
    lines = [noise(20) + "。" for _ in range(90)] + [noise(9) + "雾岬椿姬丸子" + noise(9) + "。" for _ in range(200)]
    assert boilerplate.Blocks(["\n".join(lines)]).topics == ["雾岬椿姬丸子"]


PAGES = Path("/root/testdata/sf0.1/page_cache.parquet")


@pytest.mark.skipif(not PAGES.exists(), reason="needs the test tables")
def test_pages_labelled_by_reading(spark):
    """38 pages (1,159 blocks) of the three sites left out of fitting, each block's label read and set right by hand:
    precision and recall of whole runs over the table."""
    rows = [r.split(",") for r in Path(__file__).with_name("page_labels.csv").read_text().split("\n")[1:] if r]
    want = {(int(p), int(n)) for p, ns in rows for n in ns.split()}
    pages = spark.read.parquet(str(PAGES)).select("page_id", "text")
    known = boilerplate.templates(pages, "text")
    ids = [int(p) for p, _ in rows]
    got = {(r.page_id, r.line_no) for r in boilerplate.content_lines(pages.where(F.col("page_id").isin(ids)), "page_id", "text", known=known).collect()}
    both = len(got & want)
    print(f"precision {both / len(got):.4f}, recall {both / len(want):.4f} of {len(want)}")
    assert both / len(got) > 0.97 and both / len(want) > 0.97
