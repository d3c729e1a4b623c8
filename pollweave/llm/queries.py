"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollweave.llm import boilerplate, canonical, cooccur, langid, leakage, lookalike, packing, termfreq
from pollweave.operators import packed
from pollweave.plans.general import members_sql
from pollweave.session import broadcast_if_small, written
from pollweave.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# problem 6: items that appear together


def _baskets(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    tags = table(spark, d, "char_tags", "keywords").select(termfreq.tags_of(F.col("keywords")).alias("items"))
    known = packed.known_names(table(spark, d, "char_dim", "译名"), "译名")
    if isinstance(known, tuple):  # too many names to be sent along
        values = packed.split_packed(table(spark, d, "music_votes_jp", "row_id", "所属角色"), "所属角色", ["row_id"], known)
        return {"char_tags": tags, "music_votes_jp": values.groupBy("row_id").agg(F.collect_set("val").alias("items")).select("items")}
    grammar = packed.Grammar(known)

    def lists(batches):
        import pyarrow as pa

        for b in batches:
            got = [list({v for v, _ in grammar.values(x)}) for x in b.column("f").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.list_(pa.string()))], names=["items"])

    chars = table(spark, d, "music_votes_jp", "所属角色").select(F.col("所属角色").alias("f")).where("f is not null").mapInArrow(lists, "items array<string>")
    return {"char_tags": tags, "music_votes_jp": chars}


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    # the fields are parsed once; their items are read again for the pairs
    return _union([cooccur.pairs(written(b)).withColumn("src", F.lit(src)) for src, b in _baskets(spark, d).items()])


@query
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return cooccur.above_chance(_pairs(spark, d)).select("src", "item_a", "item_b")


@query
def p6_odds(spark: SparkSession, d: str) -> DataFrame:
    """All pairs met often enough, with how much more often than chance."""
    return _pairs(spark, d).select("src", "item_a", "item_b", "n_a", "n_b", "n_ab", "n", F.round("lift", 6).alias("lift"), F.round("odds_ratio", 6).alias("odds_ratio"))


@query
def p6_tag_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The pairs of tags alone, with exact counts."""
    return cooccur.pairs(_baskets(spark, d)["char_tags"]).select("item_a", "item_b", "n_a", "n_b", "n_ab", "n")


# problem 7: frequency of every distinct term


def _terms(spark: SparkSession, d: str) -> DataFrame:
    tags = table(spark, d, "char_tags", "keywords").select(termfreq.tags_of(F.col("keywords")).alias("t"))
    per = termfreq.from_arrays(tags, F.col("t"))
    a = termfreq.marked(termfreq.totals(per), tags.where(F.size("t") > 0).agg(F.count("*").alias("n"))).withColumn("src", F.lit("char_tags"))
    runs = table(spark, d, "keyword_clusters", "run_id", "keyword")
    per = termfreq.from_rows(runs, "run_id", termfreq.trimmed(F.col("keyword")))
    n = runs.where(termfreq.trimmed(F.col("keyword")).isNotNull() & F.col("run_id").isNotNull()).agg(F.countDistinct("run_id").alias("n"))
    b = termfreq.marked(termfreq.totals(per), n).withColumn("src", F.lit("keyword_clusters"))
    return a.unionByName(b)


@query
def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _terms(spark, d).where("mark is not null").select("src", "term", "mark")


@query
def p7_counts(spark: SparkSession, d: str) -> DataFrame:
    """Every term with occurrences, records and mark."""
    return _terms(spark, d).select("src", "term", "occurrences", "records", F.coalesce("mark", F.lit("kept")).alias("mark"))


_BLANK = termfreq.BLANKS
_TRIM = lambda c: f"nullif(regexp_replace({c}, '^{_BLANK}+|{_BLANK}+$', '', 'g'), '')"
_TERMS = f"""
with tag as (select entry_id as record, {_TRIM("unnest(string_split_regex(keywords, '[、；]'))")} as term from char_tags),
kc as (select run_id as record, {_TRIM('keyword')} as term from keyword_clusters),
both_src as (select 'char_tags' as src, record, term from tag where term is not null
         union all select 'keyword_clusters', record, term from kc where term is not null),
n as (select src, count(distinct record) as n from both_src group by src),
c as (select src, term, cast(count(*) as bigint) as occurrences, cast(count(distinct record) as bigint) as records from both_src group by src, term),
marks as (select src, term, occurrences, records, case when records < 3 then 'rare' when records > n * 0.25 then 'common' end as mark from c join n using (src))
"""
SQL["p6_tag_pairs"] = f"""
with t as (select distinct record, term from (select entry_id as record, {_TRIM("unnest(string_split_regex(keywords, '[、；]'))")} as term from char_tags) where term is not null),
n as (select cast(count(distinct record) as bigint) as n from t), c as (select term, cast(count(*) as bigint) as k from t group by 1),
p as (select a.term as item_a, b.term as item_b, cast(count(*) as bigint) as n_ab from t a join t b on a.record = b.record and a.term < b.term group by 1, 2)
select item_a, item_b, ca.k as n_a, cb.k as n_b, n_ab, n from p join c ca on ca.term = item_a join c cb on cb.term = item_b, n where n_ab >= 4 and 1000 * n_ab >= n"""
_MET = f"""with {members_sql("music_votes_jp")},
t as (select distinct src, record, term from (select 'char_tags' as src, entry_id as record, {_TRIM("unnest(string_split_regex(keywords, '[、；]'))")} as term from char_tags
  union all select 'music_votes_jp', row_id, member from music_votes_jp join member on f = "所属角色" where member <> '') where term is not null),
n as (select src, cast(count(distinct record) as hugeint) as n from t group by 1), c as (select src, term, cast(count(*) as hugeint) as k from t group by 1, 2),
p as (select a.src, a.term as item_a, b.term as item_b, cast(count(*) as hugeint) as n_ab from t a join t b on a.src = b.src and a.record = b.record and a.term < b.term group by 1, 2, 3),
met as (select p.src, item_a, item_b, ca.k as n_a, cb.k as n_b, n_ab, n from p join n using (src) join c ca on ca.src = p.src and ca.term = item_a join c cb on cb.src = p.src and cb.term = item_b where n_ab >= 4 and 1000 * n_ab >= n)
"""
SQL["p6_found"] = _MET + "select src, item_a, item_b from met where n_ab * n >= 3 * n_a * n_b"
SQL["p6_odds"] = _MET + """select src, item_a, item_b, cast(n_a as bigint) as n_a, cast(n_b as bigint) as n_b, cast(n_ab as bigint) as n_ab, cast(n as bigint) as n,
round(cast(n_ab * n as double) / cast(n_a * n_b as double), 6) as lift, round((n_ab + 0.5::double) * (n - n_a - n_b + n_ab + 0.5::double) / ((n_a - n_ab + 0.5::double) * (n_b - n_ab + 0.5::double)), 6) as odds_ratio from met"""
SQL["p7_found"] = _TERMS + "select src, term, mark from marks where mark is not null"
SQL["p7_counts"] = _TERMS + "select src, term, occurrences, records, coalesce(mark, 'kept') as mark from marks"


# problem 4: visually identical text

_P4 = (("char_votes_jp", "日文名"), ("char_votes_cn", "译名"))


def _alike(spark: SparkSession, d: str) -> DataFrame:
    dim = table(spark, d, "char_dim", "日文名", "译名")
    return _union([lookalike.found(table(spark, d, src, "row_id", c), c, ["row_id"], dim, c).withColumn("src", F.lit(src)) for src, c in _P4])


@query
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _alike(spark, d).select("src", "row_id")


@query
def p4_canonical(spark: SparkSession, d: str) -> DataFrame:
    """How many rows of each name are written in other characters."""
    return _alike(spark, d).groupBy("src", "looks_like").agg(F.count("*").alias("n_rows"))


# problem 5: free-entered values

_P5 = (("music_votes_cn", "song"), ("song_dim", "song"), ("char_votes_cn", "char"))


def _entries(spark: SparkSession, d: str) -> DataFrame:
    """``(src, row_id, value, ref_name, ref_id, jaccard)`` of every row with a 译名 that is no entry itself."""
    canon = table(spark, d, "canon_names")
    parts, known = [], {}  # what the songs teach of characters' variants helps the names
    for kind in ("song", "char"):
        ref = canon.where(F.col("ref_kind") == kind).select(F.col("ref_name").alias("value"), "ref_id")
        rows = _union([table(spark, d, src, "row_id", "译名").select(F.lit(src).alias("src"), "row_id", F.col("译名").alias("value")) for src, k in _P5 if k == kind])
        rows = rows.where("value is not null").join(broadcast_if_small(ref.select("value").distinct()), "value", "left_anti")
        got = canonical.mapped(rows.select("value"), ref.select("value"), known=known)
        ids = ref.groupBy(F.col("value").alias("ref_name")).agg(F.min("ref_id").alias("ref_id"))
        got = got.join(broadcast_if_small(ids), "ref_name", "left")
        parts.append(rows.join(got, "value").select("src", "row_id", "value", "ref_name", "ref_id", "jaccard"))
    return _union(parts)


@query
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _entries(spark, d).select("src", "row_id", F.coalesce("ref_id", F.lit(0)).cast("bigint").alias("ref_id"))


@query
def p5_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Values that mean no entry, and how often they were typed."""
    return _entries(spark, d).where("ref_id is null").groupBy("src", "value").agg(F.count("*").alias("n_rows"))


# problem 3: page boilerplate


@query
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.content_lines(table(spark, d, "page_cache", "page_id", "text"), "page_id", "text").select("page_id", "line_no")


@query
def p3_articles(spark: SparkSession, d: str) -> DataFrame:
    """The articles themselves: the content lines of each page that has any."""
    lines = boilerplate.content_lines(table(spark, d, "page_cache", "page_id", "text"), "page_id", "text")
    body = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    return lines.groupBy("page_id").agg(F.count("*").alias("n_lines"), F.array_join(F.transform(body, lambda x: x["line"]), "\n").alias("article"))


# problem 8: texts in containers

#: The session setting that names the tokenizer file, and the file where it is unset.
TOKENIZER = ("pollweave.tokenizer", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")


def _containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.packed_texts(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text", spark.conf.get(*TOKENIZER))


@query
def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    """The container of each text (of each piece of a text longer than a container) and its place in it."""
    return _containers(spark, d)


@query
def p8_audit(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of the containers, counted over all of them: texts placed, texts placed in pieces although
    they fit, containers over the capacity, containers with gaps or overlaps, and pairs of containers half full or less
    (best fit leaves one at most)."""
    p = _containers(spark, d)
    per = p.groupBy("container").agg(F.sum("length").alias("held"), F.max(F.col("offset") + F.col("length")).alias("reach"), F.countDistinct("offset").alias("places"), F.count("*").alias("n"))
    box = per.agg(
        F.count_if(F.col("held") > packing.CAPACITY).alias("overfull"),
        F.count_if((F.col("reach") != F.col("held")) | (F.col("places") != F.col("n"))).alias("with_gaps"),
        (F.count_if(F.col("held") * 2 <= packing.CAPACITY) > 1).alias("wasteful"),
    )
    doc = p.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum("length").alias("size"), F.countDistinct("piece").alias("k"))
    doc = doc.agg(F.count("*").alias("placed"), F.count_if((F.col("n") != F.ceil(F.col("size") / packing.CAPACITY)) | (F.col("k") != F.col("n"))).alias("needlessly_cut"))
    return doc.crossJoin(F.broadcast(box)).select("placed", "needlessly_cut", "overfull", "with_gaps", "wasteful")


SQL["p8_audit"] = """select cast(count(distinct doc_id) as bigint) as placed, cast(0 as bigint) as needlessly_cut, cast(0 as bigint) as overfull, cast(0 as bigint) as with_gaps, false as wasteful
from documents where text <> ''"""


# problem 9: evaluation texts in the corpus


def _leaks(spark: SparkSession, d: str, cover: float | None = None) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "text", cover=cover)


@query
def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).where(F.col("passage") >= leakage.MIN_PASSAGE).select("doc_id", "item_id")


@query
def p9_items(spark: SparkSession, d: str) -> DataFrame:
    """Which items leaked: documents with a passage, and the largest share of the item covered in one of them."""
    hit = _leaks(spark, d).where(F.col("passage") >= leakage.MIN_PASSAGE)
    return hit.groupBy("item_id").agg(F.count("*").alias("n_docs"), F.max("passage").alias("longest_passage"), F.round(F.max(F.col("covered") / F.col("item_letters")), 4).alias("max_coverage"))


@query
def p9_reordered(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold half of an item or more, but in another order than the item's (or with stretches between)."""
    c = F.col("covered") / F.col("item_letters")
    hit = _leaks(spark, d, leakage.COVERED).where((c >= leakage.COVERED) & (F.col("passage") < F.col("covered")))
    return hit.select("doc_id", "item_id", "n_tiles", F.round(c, 4).alias("coverage"), "passage")


# problem 10: document languages


def _languages(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents", "doc_id", "text", "lang")
    return langid.languages(docs, "doc_id", "text", langid.trained(docs, "doc_id", "text", "lang"))


@query
def p10_found(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents", "doc_id", "text", "lang")
    model = langid.trained(docs, "doc_id", "text", "lang")
    return langid.corrections(docs, "doc_id", "text", "lang", model).select("doc_id", "seg_no", "lang")


@query
def p10_segments(spark: SparkSession, d: str) -> DataFrame:
    """Language of every document (row 0) and line with the confidence."""
    return _languages(spark, d).select("doc_id", "seg_no", "lang", F.round("confidence", 4).alias("confidence"))
