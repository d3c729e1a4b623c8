import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pollweave.operators import lda, topics


def _digamma(x):
    s = 0.0
    while x < 30:
        s, x = s - 1 / x, x + 1
    return s + math.log(x) - 1 / (2 * x) - 1 / (12 * x**2) + 1 / (120 * x**4) - 1 / (252 * x**6)


def _corpus(spark, many=60):
    draw = np.random.default_rng(5)
    docs = [[f"g{i % 3}w{w}" for w in draw.integers(0, 12, 30)] + [f"own{i}_{j}" for j in range(i % 4)] * (1 + i % 2) for i in range(many)]
    return docs, spark.createDataFrame(list(enumerate(docs)), "id long, words array<string>")


def test_exp_digamma():
    x = np.array([0.001, 0.05, 0.5, 1, 3, 40, 1e7])
    assert np.allclose(lda.exp_digamma(x), [math.exp(_digamma(v)) for v in x], rtol=1e-8)
    assert np.allclose(lda.exp_digamma(x[1:-1].astype(np.float32)), [math.exp(_digamma(v)) for v in x[1:-1]], rtol=1e-5)


def test_groups_and_longer_updates_end_where_plain_ones_do(monkeypatch):
    monkeypatch.setattr(lda, "SETTLED", 1e-9)
    monkeypatch.setattr(lda, "SHORT", 0)
    draw, k = np.random.default_rng(3), 4
    # documents of words 0 to 19, which are shared, and of words of their own, some of equal counts
    cells = [{**Counter(draw.integers(0, 20, 25).tolist()), **{20 + 5 * d + j: 1 + j // 3 for j in range(d % 6)}} for d in range(18)]
    at = np.cumsum([0, *map(len, cells)])
    code, n = (np.array([x for c in cells for x in y(c)]) for y in (list, dict.values))
    names, code = np.unique(code, return_inverse=True)
    weights = np.where((names < 20)[:, None], draw.gamma(2, 0.5, (len(names), k)), 1.0)
    total, gamma = weights.sum(axis=0), lda.start(np.arange(18, dtype=np.uint64), k, 0, 0)
    e, plain = np.vectorize(lambda v: math.exp(_digamma(v)))(weights) / [math.exp(_digamma(v)) for v in total], np.zeros((len(names), k))
    for d in range(18):
        own, g = slice(at[d], at[d + 1]), gamma[d]
        for _ in range(5000):
            t = np.array([math.exp(_digamma(v)) for v in g])
            share = e[code[own]] * t
            share *= (n[own] / share.sum(axis=1))[:, None]
            g, moved = 1 / k + share.sum(axis=0), np.abs(1 / k + share.sum(axis=0) - g).sum()
            if moved < 1e-10:
                break
        plain[code[own]] += share
    row = np.where(names < 20, names, -1)
    at2, codes, counts, ids, many, group = lda.grouped(at, code, n, row)
    table = lda.exp_digamma(np.vstack([weights[names < 20][ids], np.ones((len(many), k))]))
    got = lda.expected(table, at2, codes, counts, gamma, 1 / lda.exp_digamma(total), 1 / k)
    assert len(many) < np.count_nonzero(row < 0) and counts.sum() == n.sum()
    assert np.allclose(got[: len(ids)], plain[names < 20][ids], atol=1e-4)
    assert np.allclose((got[len(ids) :] / many[:, None])[group], plain[row < 0], atol=1e-4)


def test_driver_holds_words_of_several_documents_alone_and_no_word_is_lost(spark):
    docs, d = _corpus(spark)
    model = lda.Model(spark, 3, 0)
    model.begin(d.repartition(3), "id", F.col("words"))
    for _ in range(3):
        model.step()
    count, several = Counter(w for x in docs for w in x), Counter(w for x in docs for w in set(x))
    assert model.words.to_pylist() == sorted(w for w, n in several.items() if n > 1) and model.size == len(count)
    weight = Counter()
    for t, _, w, x in model.best(len(count)):
        weight[w] += x * model.totals[t]
    model.drop()
    assert weight.keys() == count.keys()
    assert all(weight[w] == pytest.approx(1 + n, rel=1e-5) for w, n in count.items())


def test_partitions_and_order_do_not_matter(spark):
    _, d = _corpus(spark)
    runs = [[(r.topic, r.rank, r.word) for r in topics.lda_topics(x, "id", F.col("words"), 3, 10, rounds=4).collect()] for x in (d.coalesce(1), d.repartition(5).orderBy(F.desc("id")))]
    assert runs[0] == runs[1] and len(runs[0]) == 30
    found = [{w[:2] for t, _, w in runs[0] if t == topic} for topic in range(3)]
    assert sorted(map(sorted, found)) == [["g0"], ["g1"], ["g2"]]


def test_documents_without_words(spark):
    d = spark.createDataFrame([(1, []), (2, None), (3, ["a", "b"]), (4, ["a"])], "id long, words array<string>")
    got = topics.lda_topics(d, "id", F.col("words"), 2, 5, rounds=2).collect()
    assert {r.word for r in got} == {"a", "b"} and len(got) == 4
    assert topics.lda_topics(d.where("id < 3"), "id", F.col("words"), 2, 5).count() == 0


def test_long_documents_settle(spark):
    d = spark.createDataFrame([(i, [f"w{(i * 7 + j * j) % 50}" for j in range(20_000)]) for i in range(4)], "id long, words array<string>")
    assert len(topics.lda_topics(d, "id", F.col("words"), 5, 4, rounds=2).collect()) == 20
