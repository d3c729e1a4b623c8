"""Queries of the text analyses over pages and documents, each with the SQL it must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollweave.functions import html as H
from pollweave.functions import scalars as S
from pollweave.functions.semantics import ustrip
from pollweave.operators import keywords as K
from pollweave.sources import documents as D
from pollweave.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}

# A short stop list for the queries; real lists are read by stop_words().
STOP = ("the", "of", "and", "a", "in", "de", "la", "le", "und", "der", "die", "das", "ende", "boss")


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents", "doc_id", "text")


def _stop(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w,) for w in STOP], "word string")


_TOK = """t as (select doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) as term, generate_subscripts(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+'), 1) - 1 as pos from documents),
c as (select doc_id, term, cast(count(*) as bigint) as tf, min(pos) as pos from t group by 1, 2)"""
_STOPS = ", ".join(f"'{w}'" for w in STOP)
_ADMIT = f"not regexp_matches(term, '^[A-Za-z0-9]$') and length(trim(term)) > 1 and term not in ({_STOPS})"


@query(f"with {_TOK} select doc_id, term, tf from c")
def token_counts(spark: SparkSession, d: str) -> DataFrame:
    return K.term_counts(_docs(spark, d), "doc_id", "text").select("doc_id", "term", "tf")


@query(f"with {_TOK}, r as (select doc_id, term, tf, cast(row_number() over (partition by doc_id order by tf desc, pos, term) as bigint) as rank from c where {_ADMIT}) select * from r where rank <= 20")
def top_terms_freq(spark: SparkSession, d: str) -> DataFrame:
    return K.top_terms(K.filtered(K.term_counts(_docs(spark, d), "doc_id", "text"), "freq", _stop(spark)), "doc_id")


@query(f"with {_TOK}, r as (select doc_id, term, tf, cast(row_number() over (partition by doc_id order by tf desc, pos, term) as bigint) as n from c where {_ADMIT} and not regexp_matches(term, '^[0-9]+$')), k as (select * from r where n <= 20) select doc_id, term, tf, cast(count(*) over (partition by doc_id) - n + 1 as bigint) as rank from k")
def lda_single_topic(spark: SparkSession, d: str) -> DataFrame:
    """One topic per document: the weights are counts plus a constant, so the last of the ascending order is the commonest."""
    return K.top_terms(K.filtered(K.term_counts(_docs(spark, d), "doc_id", "text"), "lda", _stop(spark)), "doc_id", ascending=True)


@query(
    f"""with {_TOK}, n as (select count(distinct doc_id) as n from c), df as (select term, count(*) as df from c group by 1),
    w as (select doc_id, c.term, tf * (ln((1 + n) / cast(1 + df as double)) + 1) as w from c join df using (term), n),
    s as (select doc_id, term, w / sqrt(sum(w * w) over (partition by doc_id)) as score from w),
    r as (select doc_id, term, score, cast(row_number() over (partition by doc_id order by round(score, 9) desc, term) as bigint) as rank from s)
    select doc_id, term, round(score, 6) as score, rank from r where rank <= 50"""
)
def tfidf_top(spark: SparkSession, d: str) -> DataFrame:
    return K.tfidf(K.term_counts(_docs(spark, d), "doc_id", "text"), "doc_id").withColumn("score", F.round("score", 6))


@query(f"with {_TOK} select cast(sum(case when length(term) > 1 and not regexp_matches(term, '^[A-Za-z0-9]+$') and term not in ({_STOPS}) then 1 else 0 end) as bigint) as clusters, cast(sum(case when not regexp_matches(term, '^[A-Za-z0-9]$') and term not in ({_STOPS}) then 1 else 0 end) as bigint) as scored from c")
def token_filters(spark: SparkSession, d: str) -> DataFrame:
    c = K.term_counts(_docs(spark, d), "doc_id", "text")
    one = lambda v: K.filtered(c, v, _stop(spark)).agg(F.count("*").alias(v))
    return one("clusters").crossJoin(one("scored"))


@query(
    """with k as (select keyword, method, cast(count(*) as bigint) as n from keyword_clusters where keyword is not null and method is not null group by 1, 2)
    select keyword, method, n, cast(dense_rank() over (order by keyword) - 1 as bigint) as "row", cast(dense_rank() over (order by method) - 1 as bigint) as "column" from k"""
)
def cooccurrence(spark: SparkSession, d: str) -> DataFrame:
    return K.matrix(table(spark, d, "keyword_clusters"), "keyword", "method").select("keyword", "method", "n", "row", "column")


@query("""select url, string_agg(text, ' ' order by page_id) as text from page_cache where text <> '' group by 1""")
def doc_concat(spark: SparkSession, d: str) -> DataFrame:
    """The texts of an address in the order of their fetching (an address is fetched a few times at most)."""
    return K.concatenated(table(spark, d, "page_cache"), "url", "text", "page_id")


@query(
    """with c as (select url_md5, max(text) as text from page_cache group by 1), u as (select distinct url from page_cache union all select distinct url || '/none' from page_cache)
    select url, md5(url) as key, cast(length(coalesce(text, '')) as bigint) as n_chars from u left join c on md5(url) = url_md5"""
)
def url_md5(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "page_cache", "url", "url_md5", "text")
    urls = pages.select("url").distinct()
    urls = urls.unionByName(urls.select(F.concat("url", F.lit("/none")).alias("url")))
    cache = pages.groupBy("url_md5").agg(F.max("text").alias("text"))
    return D.cached_pages(urls, "url", cache).select("url", F.md5("url").alias("key"), F.length("text").cast("bigint").alias("n_chars"))


_MARKUP = """'<html><style>p{x}</style><h1>' || url || '</h1><p>' || replace(text, chr(10), '</p><p>') || '</p><script>var a=1</script></html>'"""


def _markup(spark: SparkSession, d: str) -> DataFrame:
    head, tail = F.lit("<html><style>p{x}</style><h1>"), F.lit("</p><script>var a=1</script></html>")
    return table(spark, d, "page_cache").select("page_id", F.concat(head, "url", F.lit("</h1><p>"), F.replace("text", F.lit("\n"), F.lit("</p><p>")), tail).alias("html"))


@query(
    f"""with h as (select page_id, {_MARKUP} as html from page_cache)
    select page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)\\b.*?</(script|style)>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '[ \\t\\n\\v\\f\\r]+', ' ', 'g')) as text from h"""
)
def html_to_text(spark: SparkSession, d: str) -> DataFrame:
    return _markup(spark, d).select("page_id", S.html_text("html").alias("text"))


@query()
def html_to_text_exact(spark: SparkSession, d: str) -> DataFrame:
    return _markup(spark, d).select("page_id", H.html_text_exact("html").alias("text"))


@query(
    """select entry_id, coalesce(string_agg(x, '；' order by i), '') as tags from (select entry_id, i, trim(p[i]) as x from (select entry_id, string_split(replace(replace(coalesce(keywords, ''), '；', '、'), chr(12288), ' '), '、') as p, unnest(range(1, len(p) + 1)) as i from char_tags)
    union all select entry_id, 1, null from char_tags) where x is null or x <> '' group by 1"""
)
def html_extract(spark: SparkSession, d: str) -> DataFrame:
    """The cells of one row of an information box, from markup made of the tags."""
    cells = F.array_join(F.transform(F.split(F.translate(F.coalesce("keywords", F.lit("")), "；　", "、 "), "、"), lambda x: F.concat(F.lit("<td>"), x, F.lit("</td>"))), "")
    page = F.concat(F.lit('<div itemscope><tr><th>萌点</th><td>no</td></tr></div><div itemscope class="box infotemplatebox"><table><tr><th>萌点</th>'), cells, F.lit("</tr><tr><th>x</th><td>y</td></tr></table></div>"))
    return table(spark, d, "char_tags").select("entry_id", H.infobox(page, "萌点").alias("tags"))


@query()
def textrank(spark: SparkSession, d: str) -> DataFrame:
    words = F.filter(S.tokens("text"), lambda x: ~S.is_single_alnum(x) & ~x.isin(*STOP))
    return K.textrank(_docs(spark, d), "doc_id", words)


@query()
def keyword_contexts(spark: SparkSession, d: str) -> DataFrame:
    return K.contexts(_docs(spark, d), "doc_id", "text", _stop(spark))


@query()
def lda_topics(spark: SparkSession, d: str) -> DataFrame:
    from pollweave.operators import topics

    words = F.filter(S.tokens("text"), lambda x: ~x.isin(*STOP) & ~x.rlike("^[A-Za-z0-9]$|^[0-9]+$"))
    return topics.lda_topics(_docs(spark, d), "doc_id", words)


@query()
def keyword_clusters(spark: SparkSession, d: str) -> DataFrame:
    from pollweave.operators import topics

    k = table(spark, d, "keyword_clusters", "keyword", "run_id").withColumn("keyword", ustrip("keyword")).where("keyword <> ''")
    return topics.keyword_clusters(k, "keyword", "run_id")


# pages of entities: entity -> addresses with suffixes -> cached pages -> terms of all pages of the entity

_BASE = "https://pages.example/"
#: Suffixes of an entity's addresses: the kinds of text that are kept about it.
SUFFIXES = ("/poll_comment", "/forum_thread", "/wiki_page", "/music_review", "/news_digest", "/support_letter")
_LIST = ", ".join(f"'{x}'" for x in SUFFIXES)
_ENTITY_PAGES = f"""cache as (select doc_id, md5('{_BASE}' || subject || '/' || source) as k, text from documents where subject is not null and source is not null),
urls as (select name, s as suffix, '{_BASE}' || name || s as url from (select distinct "译名" as name from char_dim), (select unnest([{_LIST}]) as s)),
pages as (select name, doc_id, text from urls join cache on md5(url) = k)"""


def _entity_pages(spark: SparkSession, d: str) -> DataFrame:
    """``(name, suffix, url, doc_id, text)`` of the cached pages of each entity's addresses."""
    docs = table(spark, d, "documents", "doc_id", "subject", "source", "text").where("subject is not null and source is not null")
    cache = docs.select("doc_id", F.md5(F.concat(F.lit(_BASE), "subject", F.lit("/"), "source")).alias("url_md5"), "text")
    names = table(spark, d, "char_dim").select(F.col("译名").alias("name")).distinct()
    urls = K.suffixed(names, "name", list(SUFFIXES), _BASE).withColumn("url_md5", F.md5("url"))
    return urls.join(cache, "url_md5").select("name", "suffix", "url", "doc_id", "text")


@query(f"with {_ENTITY_PAGES} select name, cast(count(*) as bigint) as n_pages, cast(sum(length(text)) as bigint) as n_chars, cast(min(doc_id) as bigint) as first_page from pages group by 1")
def entity_pages(spark: SparkSession, d: str) -> DataFrame:
    return _entity_pages(spark, d).groupBy("name").agg(F.count("*").alias("n_pages"), F.sum(F.length("text")).cast("bigint").alias("n_chars"), F.min("doc_id").cast("bigint").alias("first_page"))


_ENTITY_TERMS = f"""{_ENTITY_PAGES}, t as (select name, doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+')) as term, generate_subscripts(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+'), 1) as i from pages),
c as (select name, term, cast(count(*) as bigint) as tf, min(lpad(cast(doc_id as varchar), 20, '0') || lpad(cast(i as varchar), 12, '0')) as pos from t group by 1, 2)"""


@query(f"with {_ENTITY_TERMS}, r as (select name, term, tf, cast(row_number() over (partition by name order by tf desc, pos, term) as bigint) as rank from c where {_ADMIT}) select * from r where rank <= 20")
def entity_top_terms(spark: SparkSession, d: str) -> DataFrame:
    """The commonest terms of each entity over all its pages."""
    c = K.entity_counts(_entity_pages(spark, d), "name", "text", "doc_id")
    return K.top_terms(K.filtered(c, "freq", _stop(spark)), "name")


@query(
    f"""with {_ENTITY_TERMS}, n as (select count(distinct name) as n from c), df as (select term, count(*) as df from c group by 1),
    w as (select name, c.term, tf * (ln((1 + n) / cast(1 + df as double)) + 1) as w from c join df using (term), n),
    s as (select name, term, w / sqrt(sum(w * w) over (partition by name)) as score from w),
    r as (select name, term, score, cast(row_number() over (partition by name order by round(score, 9) desc, term) as bigint) as rank from s)
    select name, term, round(score, 6) as score, rank from r where rank <= 50"""
)
def entity_tfidf(spark: SparkSession, d: str) -> DataFrame:
    """TF-IDF of each entity's pages taken together, against the other entities."""
    return K.tfidf(K.entity_counts(_entity_pages(spark, d), "name", "text", "doc_id"), "name").withColumn("score", F.round("score", 6))


@query(
    f"""with {_TOK}, n as (select count(distinct doc_id) as n from c), idf as (select term, ln(n / cast(count(*) as double)) as idf from c, n group by term, n),
    s as (select doc_id, c.term, pos, tf / cast(sum(tf) over (partition by doc_id) as double) * idf as score from c join idf using (term)),
    r as (select doc_id, term, score, cast(row_number() over (partition by doc_id order by round(score, 9) desc, pos, term) as bigint) as rank from s) select doc_id, term, round(score, 6) as score, rank from r where rank <= 20"""
)
def tfidf_alone(spark: SparkSession, d: str) -> DataFrame:
    """Each document's terms by a given table of idf (here that of the documents themselves)."""
    c = K.term_counts(_docs(spark, d), "doc_id", "text")
    n = _docs(spark, d).where(F.size(S.tokens("text")) > 0).agg(F.count("*").alias("n"))
    return K.tfidf_of_document(c, "doc_id", K.corpus_idf(c, n)).withColumn("score", F.round("score", 6))


def _segmenter(spark: SparkSession, d: str):
    from pollweave.operators import segment

    names = table(spark, d, "char_dim").select(F.col("译名").alias("w"))
    keywords = table(spark, d, "keyword_clusters", "keyword").select(ustrip("keyword").alias("w")).where("w <> ''")
    return segment.dictionary(names.unionByName(keywords), "w")


@query()
def segmented_terms(spark: SparkSession, d: str) -> DataFrame:
    """Occurrences of each word where texts are cut by a dictionary of names and keywords."""
    from pollweave.operators import segment

    words = segment.segmented(_docs(spark, d), "doc_id", "text", _segmenter(spark, d))
    return words.select(F.explode("words").alias("term")).groupBy("term").agg(F.count("*").alias("n"))


@query()
def textrank_words(spark: SparkSession, d: str) -> DataFrame:
    """Graph ranking over dictionary words: the best 50 of each document, of those the ones that are neither stop words
    nor single letters, and of those 20."""
    from pollweave.operators import segment

    words = segment.segmented(_docs(spark, d), "doc_id", "text", _segmenter(spark, d))
    return K.textrank(words, "doc_id", F.col("words"), 20, first=50, keep=lambda w: len(w) > 1 and w not in STOP)


@query()
def method_clusters(spark: SparkSession, d: str) -> DataFrame:
    """The clusters of keywords by the run they come from, given back to each method's keywords."""
    from pollweave.operators import topics

    k = table(spark, d, "keyword_clusters", "method", "keyword", "run_id").withColumn("keyword", ustrip("keyword")).where("keyword <> ''")
    return topics.cluster_labels(k, "method", "keyword", "run_id")


@query()
def context_clusters(spark: SparkSession, d: str) -> DataFrame:
    """The whole chain: keywords of every document by four methods, clustered by the documents they come from, and given
    back to the methods."""
    from pollweave.operators import topics

    return topics.cluster_labels(K.contexts(_docs(spark, d), "doc_id", "text", _stop(spark)), "method", "keyword", "source")
