import numpy as np
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import functions as F

from pollweave.operators import topics


def test_every_document_counts_in_every_pass(spark):
    docs = [["a", "b"] * (i % 3) + [f"u{i}"] for i in range(300)]
    d = spark.createDataFrame([(x,) for x in docs], "words array<string>")
    vector = CountVectorizer(inputCol="words", outputCol="features").fit(d)
    m = topics.topic_model(vector.transform(d), "features", 4, 3, 0).topicsMatrix()
    weight = np.array(m.toArray()).reshape(4, m.numRows()).sum(axis=0)
    assert np.allclose(weight, [1 + sum(x.count(w) for x in docs) for w in vector.vocabulary])


def test_topics_have_the_whole_vocabulary(spark):
    d = spark.range(2100).select("id", F.transform(F.sequence(F.lit(0), F.lit(9)), lambda x: F.concat(F.lit("w"), (F.col("id") * 10 + x).cast("string"))).alias("words"))
    got = topics.lda_topics(d, "id", F.col("words"), topics=2, terms=21_000, rounds=1)
    assert got.select("word").distinct().count() == 21_000
    assert got.dtypes == [("topic", "int"), ("rank", "int"), ("word", "string"), ("weight", "double")]


def test_keywords_cluster_by_entry(spark, tmp_path):
    from pollweave.plans import texts

    rows = [(g * 10 + r, m, f" k{g}{w}") for g in range(5) for r in range(4) for m in ("freq", "lda") for w in range(6)]
    spark.createDataFrame([*rows, (99, "lda", None), (99, "lda", " ")], "run_id long, method string, keyword string").write.parquet(str(tmp_path / "keyword_clusters.parquet"))
    got = {r.keyword: r.cluster for r in texts.keyword_clusters(spark, str(tmp_path)).collect()}
    assert len(got) == 30
    groups = [{got[f"k{g}{w}"] for w in range(6)} for g in range(5)]
    assert [len(x) for x in groups] == [1] * 5 and len(set.union(*groups)) == 5
