"""Topic models and keyword clusters on MLlib."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pollweave.functions.semantics import col
from pollweave.operators import lda
from pollweave.operators.keywords import matrix


def topic_model(vectors: DataFrame, features: str, topics: int, rounds: int, seed: int):
    """MLlib's model (JVM) after ``rounds`` passes of batch variational LDA over all of ``vectors``, fixed priors 1/topics.

    ``pyspark.ml``'s LDA draws its documents with replacement, so even ``subsamplingRate=1.0`` leaves out about
    a third of them in each pass; only the optimizer below it can turn that off. With a step of 1 (``kappa`` 0)
    each pass replaces the topics, so a word's weights over all topics add up to its occurrences and 1.
    """
    jvm, prior = vectors.sparkSession._jvm, 1.0 / topics
    step = jvm.org.apache.spark.mllib.clustering.OnlineLDAOptimizer().setMiniBatchFraction(1.0).setSampleWithReplacement(False).setKappa(0.0).setOptimizeDocConcentration(False)
    fit = jvm.org.apache.spark.mllib.clustering.LDA().setK(topics).setMaxIterations(rounds).setSeed(seed).setDocConcentration(prior).setTopicConcentration(prior).setOptimizer(step)
    pairs = getattr(getattr(jvm.org.apache.spark.ml.clustering, "LDA$"), "MODULE$")
    return fit.run(pairs.getOldDataset(vectors._jdf, features))


def lda_topics(docs: DataFrame, key: str, words: Column, topics: int = 20, terms: int = 30, seed: int = 0, rounds: int = 10) -> DataFrame:
    """``(topic, rank, word, weight)``: the heaviest words of each topic (batch variational LDA, priors 1/k), of equal ones the first by name.

    Every document counts in every pass and every word is in the vocabulary. What :func:`topic_model` does, without the
    whole vocabulary in one place: the driver and each task hold topics x words numbers for words of two documents or more.
    """
    rows = lda.fitted(docs, key, words, topics, terms, seed, rounds)
    return docs.sparkSession.createDataFrame(rows, "topic int, rank int, word string, weight double")


def keyword_clusters(keywords: DataFrame, keyword: str, source: str, k: int = 5, seed: int = 0, rounds: int = 300) -> DataFrame:
    """``(keyword, cluster)``: K-means over the counts of each keyword by source (the entries or runs it comes from),
    until the centres stand still or for ``rounds`` rounds. Vectors are sparse; a keyword's own counts and the
    ``k`` centres, each as long as there are sources, must fit a task. One cluster for each keyword."""
    cells = matrix(keywords, keyword, source)
    width = keywords.dropna(subset=[keyword, source]).select(col(source)).distinct().count()
    pairs = F.array_sort(F.collect_list(F.struct("column", F.col("n").cast("double").alias("n"))))
    sparse = F.udf(lambda at, n: Vectors.sparse(width, at, n), VectorUDT())
    rows = cells.groupBy(col(keyword)).agg(pairs.alias("c")).select(col(keyword), sparse("c.column", "c.n").alias("features")).persist()
    try:
        model = KMeans(k=k, seed=seed, maxIter=rounds, featuresCol="features", predictionCol="cluster").fit(rows)
    finally:
        rows.unpersist()
    return model.transform(rows).select(col(keyword), "cluster")


def cluster_labels(contexts: DataFrame, method: str, keyword: str, source: str, k: int = 5, seed: int = 0) -> DataFrame:
    """``(method, keyword, cluster)``, each once: the clusters of all keywords given back to the methods that found
    them. Rows with a null method, keyword or source take no part."""
    c = contexts.select(col(method), col(keyword), col(source)).dropna()
    labels = keyword_clusters(c, keyword, source, k, seed)
    return c.select(col(method), col(keyword)).distinct().join(labels, keyword).select(col(method), col(keyword), "cluster")
