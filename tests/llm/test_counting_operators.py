import itertools
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pollweave.llm import cooccur, packing, queries, termfreq


def test_term_counts(spark):
    df = spark.createDataFrame([(1, "a、b、a"), (2, " a ；　c"), (3, None), (4, ""), (5, "、"), (1, "a、b、a"), (6, "A" * 50_000)], "id int, f string")
    t = termfreq.totals(termfreq.from_arrays(df, termfreq.tags_of(F.col("f"))))
    got = {r.term: (r.occurrences, r.records) for r in t.collect()}
    assert got.pop("A" * 50_000) == (1, 1)
    assert got == {"a": (5, 3), "b": (2, 2), "c": (1, 1)}
    n = spark.createDataFrame([(4,)], "n long")
    marks = {r.term: r.mark for r in termfreq.marked(t, n).collect()}
    assert marks["a"] == "common" and marks["b"] == "rare"
    assert termfreq.totals(termfreq.from_arrays(df.limit(0), termfreq.tags_of(F.col("f")))).count() == 0


def test_counts_of_spread_records(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x "), (2, "x"), (None, "x"), (3, None), (3, " ")], "run int, k string")
    t = termfreq.totals(termfreq.from_rows(df, "run", termfreq.trimmed(F.col("k"))))
    assert [tuple(r) for r in t.collect()] == [("x", 3, 2)]


def _brute(baskets, least, per_mille):
    sets = [set(b) - {None} for b in baskets if b and set(b) - {None}]
    n = len(sets)
    one = Counter(x for s in sets for x in s)
    two = Counter(p for s in sets for p in itertools.combinations(sorted(s), 2))
    return {(a, b): (one[a], one[b], k, n) for (a, b), k in two.items() if k >= least and 1000 * k >= per_mille * n}


@pytest.mark.parametrize("split", [cooccur.SPLIT, 2, 3])
@pytest.mark.parametrize("broadcast", [cooccur.BROADCAST_ITEMS, 0])
def test_pairs_against_brute_force(spark, monkeypatch, broadcast, split):
    monkeypatch.setattr(cooccur, "BROADCAST_ITEMS", broadcast)
    monkeypatch.setattr(cooccur, "SPLIT", split)
    monkeypatch.setattr(cooccur, "BLOCK", 50)
    rng = random.Random(5)
    baskets = [[rng.choice("abcdefgh中é") for _ in range(rng.randint(0, 7))] for _ in range(200)] + [None, [], [None, "a"], ["a", "a"]]
    df = spark.createDataFrame([(b, i) for i, b in enumerate(baskets)], "items array<string>, code int")
    got = {(r.item_a, r.item_b): (r.n_a, r.n_b, r.n_ab, r.n) for r in cooccur.pairs(df, 4, 20).collect()}
    assert got == _brute(baskets, 4, 20)
    assert cooccur.pairs(df.limit(0)).count() == 0


def test_large_counts(spark):
    big = 900_000_000_000
    rows = [("a", "b", 4 * big, 3 * big, 2 * big, 6 * big), ("a", "c", big, big, big, 3 * big), ("a", "d", big, big, big, 3 * big - 1)]
    df = spark.createDataFrame(rows, "item_a string, item_b string, n_a long, n_b long, n_ab long, n long")
    with_ansi = spark.conf.get("spark.sql.ansi.enabled")
    assert with_ansi == "true" and [r.item_b for r in cooccur.above_chance(df).collect()] == ["c"]


def test_odds_are_finite(spark):
    df = spark.createDataFrame([(["a", "b"],)] * 5, "items array<string>")
    r = cooccur.pairs(df).first()
    assert r.odds_ratio == pytest.approx(5.5 * 0.5 / (0.5 * 0.5)) and cooccur.above_chance(cooccur.pairs(df)).count() == 0


def _one_by_one(sizes, capacity):
    """Best fit decreasing item by item: the containers' contents."""
    boxes = []
    for s in sorted(sizes, reverse=True):
        fits = [b for b in boxes if sum(b) + s <= capacity]
        if fits:
            max(fits, key=sum).append(s)
        else:
            boxes.append([s])
    return boxes


def _least(sizes, capacity):
    """The smallest number of containers, by search."""
    best = len(_one_by_one(sizes, capacity))
    sizes = sorted(sizes, reverse=True)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for r in {r for r in rooms if r >= sizes[i]}:
            place(i + 1, [*(x for k, x in enumerate(rooms) if k != rooms.index(r)), r - sizes[i]])
        place(i + 1, [*rooms, capacity - sizes[i]])

    place(0, [])
    return best


@settings(deadline=None, max_examples=300)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 40), max_size=12))
def test_plan_is_best_fit(histogram):
    used, fills = Counter(), Counter()
    plan = packing.plan(histogram, 20)
    for n, contents in plan:
        assert n > 0 and sum(s * k for s, k in contents) <= 20
        fills[sum(s * k for s, k in contents)] += n
        for s, k in contents:
            used[s] += n * k
    assert used == Counter(histogram)
    assert fills == Counter(map(sum, _one_by_one(Counter(histogram).elements(), 20)))
    assert len(plan) <= 3 * max(1, len(histogram))


@settings(deadline=None, max_examples=100)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_plan_against_the_least(sizes):
    n = sum(n for n, _ in packing.plan(Counter(sizes), 20))
    assert n <= 11 * _least(sizes, 20) / 9 + 6 / 9  # the known bound of best fit decreasing


@pytest.mark.parametrize("histogram, capacity", [({12: 3, 4: 5}, 20), ({7: 3, 3: 4}, 13)])
def test_plan_refills_what_it_took(histogram, capacity):
    assert sum(n for n, _ in packing.plan(histogram, capacity)) == 3


def test_plan_fills_well():
    rng = random.Random(2)
    h = Counter(min(2048, max(1, int(rng.lognormvariate(6, 1)))) for _ in range(20_000))
    assert sum(s * k for s, k in h.items()) / 2048 / sum(n for n, _ in packing.plan(h)) > 0.99


@pytest.mark.parametrize("at_once", [packing.RANKED_AT_ONCE, 30])
def test_packed_items(spark, monkeypatch, at_once):
    monkeypatch.setattr(packing, "RANKED_AT_ONCE", at_once)
    rng = random.Random(4)
    sizes = [rng.randint(1, 60) for _ in range(300)] + [10] * 200 + [100, 101, 350, 0, -3, None]
    df = spark.createDataFrame(list(enumerate(sizes)), "id long, n int").withColumn("rank", F.lit("x"))
    rows = packing.packed(df, "id", "n", 100).collect()
    by_item, spans = Counter(), {}
    for r in rows:
        by_item[r.id] += r.length
        spans.setdefault(r.container, []).append((r.offset, r.offset + r.length))
    assert by_item == Counter({i: n for i, n in enumerate(sizes) if n and n > 0})
    for s in spans.values():
        s.sort()
        assert s[0][0] == 0 and s[-1][1] <= 100 and all(a[1] == b[0] for a, b in itertools.pairwise(s))
    whole = Counter(r.id for r in rows)
    assert all(k == 1 or sizes[i] > 100 for i, k in whole.items())
    assert packing.packed(df.limit(0), "id", "n", 100).count() == 0


@pytest.mark.parametrize("file", ["byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_token_counts(spark, file):
    P = pytest.importorskip("public_tokenizers")
    df = spark.createDataFrame([(1, "Hello world 你好"), (2, None), (3, ""), (4, "<|endoftext|>")], "id int, t string")
    got = {r.id: r.n_tokens for r in packing.token_counts(df, "id", "t", P.path(file)).collect()}
    assert got[2] == got[3] == 0 and got[1] > 4 and got[4] > 1


def test_packed_texts(spark):
    P = pytest.importorskip("public_tokenizers")
    df = spark.createDataFrame([(1, "a b c", 7), (2, None, 7), (3, "", 7), (4, "好" * 40, 7), (5, "a b c", 7)], "id int, text string, length int")
    rows = packing.packed_texts(df, "id", "text", P.path("byte_bpe_50k.tiktoken"), 20).collect()
    assert {r.id for r in rows} == {1, 4, 5} and max(r.length for r in rows) == 20
    with pytest.raises(ValueError):
        packing.packed(df, "length", "id")


def test_queries_are_complete():
    assert {f"p{n}_found" for n in (3, 4, 5, 6, 7, 9, 10)} | {"p8_containers", "p8_audit"} <= set(queries.QUERIES)
