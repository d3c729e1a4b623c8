"""Keywords of documents: frequency, TF-IDF, single-topic and graph ranking."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pollweave.functions.scalars import is_number, is_single_alnum, tokens
from pollweave.functions.semantics import col


def term_counts(docs: DataFrame, key: str, text: str, least: int = 1, words: Column | None = None) -> DataFrame:
    """``(key, term, tf, pos)``: occurrences of each term of a document and the place of the first."""
    t = docs.select(col(key), F.posexplode(words if words is not None else tokens(text, least)).alias("pos", "term"))
    return t.groupBy(col(key), "term").agg(F.count("*").alias("tf"), F.min("pos").alias("pos"))


def filtered(counts: DataFrame, variant: str, stop: DataFrame | None = None, names: DataFrame | None = None) -> DataFrame:
    """Terms a keyword method admits: ``freq`` (not stop, not a name, no single letter or digit, longer than
    one character), ``lda`` (also no numbers), ``clusters`` (longer than one, not ASCII alone, names allowed),
    ``scored`` (not stop, not a name, no single letter or digit). Stop words match exactly, case included."""
    t = F.col("term")
    rule = {
        "freq": ~is_single_alnum(t) & (F.length(F.trim(t)) > 1),
        "lda": ~is_single_alnum(t) & (F.length(F.trim(t)) > 1) & ~is_number(t),
        "clusters": (F.length(t) > 1) & ~t.rlike("^[A-Za-z0-9]+$"),
        "scored": ~is_single_alnum(t),
    }[variant]
    out = counts.where(rule)
    if stop is not None:
        out = out.join(stop.select(F.col(stop.columns[0]).alias("term")).distinct(), "term", "left_anti")
    if names is not None and variant != "clusters":
        out = out.join(names.select(F.col(names.columns[0]).alias("term")).distinct(), "term", "left_anti")
    return out


def top_terms(counts: DataFrame, key: str, k: int = 20, ascending: bool = False) -> DataFrame:
    """The ``k`` most frequent terms of each document, ties by first place; ``rank`` from 1."""
    w = Window.partitionBy(col(key)).orderBy(F.desc("tf"), "pos", "term")
    out = counts.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)
    if ascending:
        out = out.withColumn("rank", F.count("*").over(Window.partitionBy(col(key))) - F.col("rank") + 1)
    return out.select(col(key), "term", "tf", "rank")


def tfidf(counts: DataFrame, key: str, k: int = 50, n: DataFrame | None = None) -> DataFrame:
    """``(key, term, score, rank)``: tf * (ln((1 + n) / (1 + df)) + 1), rows of length 1, the ``k`` largest;
    ties (to 9 digits) by term. ``n`` is one row with the number of documents that have a term, counted from
    ``counts`` if not given. Length and rank come from one partitioning by document."""
    if n is None:
        n = counts.select(col(key)).distinct().agg(F.count("*").alias("n"))
    df = counts.groupBy("term").agg(F.count("*").alias("df"))
    w = counts.join(df, "term").crossJoin(F.broadcast(n)).withColumn("w", F.col("tf") * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1))
    s = w.withColumn("score", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(col(key)))))
    order = Window.partitionBy(col(key)).orderBy(F.desc(F.round("score", 9)), "term")
    return s.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= k).select(col(key), "term", "score", "rank")


def tfidf_of_document(counts: DataFrame, key: str, idf: DataFrame, k: int = 20) -> DataFrame:
    """``(key, term, score, rank)`` of each document by itself: tf / (terms of the document) * idf, the ``k`` largest,
    ties (to 9 digits) by first place. ``idf`` is a given table ``(term, idf)``, as of another corpus; a term that it
    lacks has its median (0 for an empty table)."""
    middle = idf.agg(F.coalesce(F.median("idf"), F.lit(0.0)).alias("__m"))
    w = counts.join(idf.groupBy("term").agg(F.max("idf").alias("idf")), "term", "left").crossJoin(F.broadcast(middle))
    own = Window.partitionBy(col(key))
    s = w.withColumn("score", F.col("tf") / F.sum("tf").over(own) * F.coalesce("idf", "__m"))
    order = own.orderBy(F.desc(F.round("score", 9)), "pos", "term")
    return s.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= k).select(col(key), "term", "score", "rank")


def corpus_idf(counts: DataFrame, n: DataFrame) -> DataFrame:
    """``(term, idf)``: ln(n / df) of a corpus's counts; ``n`` is one row with its documents."""
    return counts.groupBy("term").agg(F.count("*").alias("df")).crossJoin(F.broadcast(n)).select("term", F.log(F.col("n") / F.col("df")).alias("idf"))


def entity_counts(pages: DataFrame, entity: str, text: str, part: str, least: int = 1, words: Column | None = None) -> DataFrame:
    """``(entity, term, tf, pos)`` over all pages of an entity together, as of their concatenation in the order of
    ``part``: counts add up, so no entity's text is ever put together in one task. ``pos`` orders terms by the page and
    the place where they first stand."""
    t = pages.select(col(entity), col(part).alias("__p"), F.posexplode(words if words is not None else tokens(text, least)).alias("__i", "term"))
    return t.groupBy(col(entity), "term").agg(F.count("*").alias("tf"), F.min(F.struct("__p", "__i")).alias("pos"))


def suffixed(entities: DataFrame, name: str, suffixes: list[str], base: str = "") -> DataFrame:
    """Every entity with every suffix, as ``url`` after ``base``."""
    return entities.select("*", F.explode(F.array(*map(F.lit, suffixes))).alias("suffix")).withColumn("url", F.concat(F.lit(base), col(name), F.col("suffix")))


def concatenated(docs: DataFrame, key: str, text: str, order: str, out: str = "text") -> DataFrame:
    """The texts of each key joined by blanks in order, empty ones skipped."""
    rows = F.array_sort(F.collect_list(F.struct(col(order).alias("o"), col(text).alias("t"))))
    return docs.where(col(text) != "").groupBy(col(key)).agg(F.array_join(F.transform(rows, lambda x: x["t"]), " ").alias(out))


def matrix(keywords: DataFrame, keyword: str = "keyword", source: str = "source") -> DataFrame:
    """``(keyword, source, n)`` counts with dense coordinates ``row`` and ``column`` by sorted value.

    Coordinates are numbered over the distinct values, which are the matrix's own dimensions.
    """
    n = keywords.dropna(subset=[keyword, source]).groupBy(col(keyword), col(source)).agg(F.count("*").alias("n"))

    def numbered(c: str, out: str) -> DataFrame:
        d = n.select(col(c)).distinct().repartitionByRange(col(c)).withColumn("__p", F.spark_partition_id())
        d = d.withColumn("__i", F.row_number().over(Window.partitionBy("__p").orderBy(col(c))))
        size = d.groupBy("__p").agg(F.count("*").alias("__s"))
        before = size.select("__p", F.coalesce(F.sum("__s").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__b"))
        return d.join(F.broadcast(before), "__p").select(col(c), (F.col("__b") + F.col("__i") - 1).cast("bigint").alias(out))

    return n.join(numbered(keyword, "row"), keyword).join(numbered(source, "column"), source)


def rank_graph(words: list[str], span: int = 5, rounds: int = 10, damping: float = 0.85) -> list[tuple[str, float]]:
    """Weighted PageRank of the words on their co-occurrence within ``span`` places; the largest score is 1."""
    names, at = np.unique(np.array(words, dtype=object).astype(str), return_inverse=True)
    n = len(names)
    a = np.concatenate([at[:-d] for d in range(1, span) if d < len(at)] or [at[:0]])
    b = np.concatenate([at[d:] for d in range(1, span) if d < len(at)] or [at[:0]])
    a, b = a[a != b], b[a != b]
    if not len(a):
        return []
    edge, w = np.unique(np.concatenate([a * n + b, b * n + a]), return_counts=True)
    src, dst = edge // n, edge % n
    flow = w / np.bincount(src, w, n)[src]
    linked = np.bincount(dst, minlength=n) > 0
    score = linked.astype(float)
    for _ in range(rounds):
        score = np.where(linked, (1 - damping) + damping * np.bincount(dst, flow * score[src], n), 0.0)
    score = np.round(score / score.max(), 9)
    order = sorted(np.flatnonzero(linked).tolist(), key=lambda i: (-score[i], names[i].encode()))
    return [(str(names[i]), float(score[i])) for i in order]


def textrank(docs: DataFrame, key: str, words: Column, k: int = 20, span: int = 5, rounds: int = 10, damping: float = 0.85, first: int | None = None, keep: Callable[[str], bool] | None = None) -> DataFrame:
    """``(key, term, score, rank)``: the ``k`` best terms of each document by :func:`rank_graph`, ties by term. With
    ``keep`` the best ``first`` terms (all, if not given) are filtered by it before the ``k`` best are taken.

    Every document is a graph of its own, so it is ranked where it is read: one narrow pass, no shuffle,
    memory for one document's words times the span. ``words`` is an array of the admitted words in order;
    documents with fewer than two different words give no rows.
    """
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("term", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rank", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(i, t, s, r) for i, ws in enumerate(b.column("__w").to_pylist()) if ws for r, (t, s) in enumerate([x for x in rank_graph(ws, span, rounds, damping)[:first] if keep is None or keep(x[0])][:k], 1)]
            take = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(key).take(take), *(pa.array([r[j] for r in rows], t) for j, t in ((1, pa.string()), (2, pa.float64()), (3, pa.int64())))], names=schema.names)

    return docs.select(col(key), words.alias("__w")).where(F.size("__w") > 1).mapInArrow(run, schema)


def contexts(docs: DataFrame, key: str, text: str, stop: DataFrame | None = None, k: int = 20) -> DataFrame:
    """``(method, keyword, source)``: the ``k`` best terms of each document by four methods (repeats kept)."""
    counts = term_counts(docs, key, text)
    words = F.filter(tokens(text), lambda x: ~is_single_alnum(x))
    by = {
        "tfidf": tfidf(filtered(counts, "clusters", stop), key, k),
        "textrank": textrank(docs, key, words, k),
        "freq": top_terms(filtered(counts, "clusters", stop), key, k),
        "lda": top_terms(filtered(counts, "lda", stop), key, k, ascending=True),
    }
    return reduce(DataFrame.unionByName, [d.select(F.lit(m).alias("method"), F.col("term").alias("keyword"), col(key).alias("source")) for m, d in by.items()])
