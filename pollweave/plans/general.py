"""Queries of the core operators for packed fields (p1) and drifting schemas (p2)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollweave.operators import drift, packed
from pollweave.sources.tables import table

PACKED = ("music_votes_jp", "song_dim")


def packed_values(spark: SparkSession, d: str) -> DataFrame:
    """Every value of 所属角色 of both tables with place, flag and number of values."""
    known = packed.known_names(table(spark, d, "char_dim"), "译名")
    parts = [packed.split_packed(table(spark, d, t, "row_id", "所属角色"), "所属角色", ["row_id"], known).withColumn("src", F.lit(t)) for t in PACKED]
    return reduce(DataFrame.unionByName, parts)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return packed_values(spark, d).where("n_values >= 2").select("src", "row_id", "pos", "val")


def p1_flags(spark: SparkSession, d: str) -> DataFrame:
    """How many fields parsed cleanly and how many carry each error flag, by table and number of values."""
    v = packed_values(spark, d).groupBy("src", "row_id").agg(F.max("n_values").alias("n_values"), F.max("flag").alias("flag"))
    return v.groupBy("src", "n_values", F.coalesce("flag", F.lit("ok")).alias("flag")).agg(F.count("*").alias("fields"))


def _schemas(spark: SparkSession, d: str) -> DataFrame:
    return drift.file_schemas(table(spark, d, "sheet_rows", "book", "sheet_no", "record_json"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return drift.changes(_schemas(spark, d)).select("book", "sheet_no", "header", "drift")


def p2_versions(spark: SparkSession, d: str) -> DataFrame:
    v = drift.versions(_schemas(spark, d))
    return v.select("book", "sheet_no", "version", "fingerprint", F.size("columns").cast("bigint").alias("n_columns"))


def p2_steps(spark: SparkSession, d: str) -> DataFrame:
    """The chain of every schema that any file has: its explicit steps in order, and how many files go through it."""
    c = drift.chains(_schemas(spark, d))
    return c.select("kind", "fingerprint", "n_files", F.posexplode("steps").alias("step_no", "s")).select("kind", "fingerprint", "n_files", (F.col("step_no") + 1).alias("step_no"), "s.op", "s.header", "s.field", "s.value")


def p2_unified(spark: SparkSession, d: str) -> DataFrame:
    """The consistent tables of all kinds in long form, with every value read (see :func:`drift.long_form`)."""
    return drift.long_form(table(spark, d, "sheet_rows", "rec_id", "book", "sheet_no", "row_no", "record_json"))


QUERIES = {"p1_found": p1_found, "p1_flags": p1_flags, "p2_found": p2_found, "p2_versions": p2_versions, "p2_steps": p2_steps, "p2_unified": p2_unified}


# The signs that separate or enclose values of a packed field, for SQL (quotes doubled).
_SIGNS = "|｜;；、，,/／+＋&＆\"“”「」『』''‘’＂[]【】《》〈〉｛｝{}"
_ENDS = "\\s\\x{3000}\\x{A0}\"“”「」『』''‘’＂\\[\\]【】《》〈〉｛｝{}"


def members_sql(*tables: str) -> str:
    """SQL of the members of packed fields, said apart from the operator's grammar: names that hold signs are masked
    (each sign becomes a private character), fields are cut at the signs left, quotes and brackets go, and the masks
    come off. ``member(f, i, member)`` has the parts of each distinct field in order, empty ones included."""
    fields = " union ".join(f"""select distinct "所属角色" as f from {t} where "所属角色" <> ''""" for t in tables)
    return f"""sig as (select '{_SIGNS}' as signs, string_agg(chr(57344 + cast(i as int)), '' order by i) as masks from range(0, length('{_SIGNS}')) r(i)),
    tricky as (select list(x order by length(x) desc, x) as names from (select distinct "译名" as x from char_dim, sig where translate("译名", signs, '') <> "译名")),
    fields as ({fields}),
    clear as (select f, replace(replace(f, '\\"', '"'), '""', '"') as g from fields),
    hidden as (select f, string_split_regex(list_reduce(list_prepend(g, names), lambda acc, x: replace(acc, x, translate(x, signs, masks))), '[|｜;；、，,/／+＋&＆\\t\\n\\r]') as g, signs, masks from clear, tricky, sig),
    parts as (select f, signs, masks, unnest(g) as x, generate_subscripts(g, 1) as i from hidden),
    member as (select f, i, translate(regexp_replace(x, '^[{_ENDS}]+|[{_ENDS}]+$', '', 'g'), masks, signs) as member from parts)"""


_P1_SQL = f"""with {members_sql(*PACKED)},
    src as ({" union all ".join(f"select '{t}' as src, row_id, \"所属角色\" as f from {t}" for t in PACKED)}),
    r as (select src, row_id, member as val, cast(row_number() over (partition by src, row_id order by i) as bigint) as pos, count(*) over (partition by src, row_id) as n from src join member using (f) where member <> '')
    select src, row_id, pos, val from r where n >= 2"""


def _values(pairs: list[tuple[str, str, str]]) -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    return ", ".join(f"({', '.join(map(quote, p))})" for p in pairs)


def _drift_sql() -> str:
    exact = [(m.book_kind, h, f) for m in drift.MIGRATIONS for h, f in m.headers().items()]
    loose: dict[tuple[str, str], str] = {}
    for k, h, f in exact:
        loose.setdefault((k, drift.plain_header(h)), f)
    plain = "lower(regexp_replace(translate(header, '（）', '()'), '[\\s\\x{3000}\\x{A0}]+', '', 'g'))"
    return f"""with exact(kind, header, field) as (values {_values(exact)}), loose(kind, plain, field) as (values {_values([(k, h, f) for (k, h), f in loose.items()])}),
    e as (select book, sheet_no, regexp_replace(book, '-\\d+$', '') as kind, j.key as header, j.type as kind_of from sheet_rows, json_each(record_json) j),
    h as (select book, sheet_no, kind, header, max(case when kind_of in ('BIGINT', 'UBIGINT') then 0 when kind_of = 'DOUBLE' then 1 when kind_of = 'VARCHAR' then 2 when kind_of = 'ARRAY' then 3 when kind_of <> 'NULL' then 4 end) as type from e group by 1, 2, 3, 4),
    p as (select *, case when instr({plain}, '(') > 1 then split_part({plain}, '(', 1) else {plain} end as plain from h),
    f as (select p.book, p.sheet_no, p.header, p.type, coalesce(x.field, l.field, p.header) as field from p left join exact x on x.kind = p.kind and x.header = p.header left join loose l on l.kind = p.kind and l.plain = p.plain),
    s as (select book, sheet_no, lag(sheet_no) over (partition by book order by sheet_no) as before from (select distinct book, sheet_no from f)),
    c as (select f.*, before from f join s using (book, sheet_no) where before is not null),
    b as (select f.book, s.sheet_no, f.header, f.type, f.field from f join s on s.book = f.book and s.before = f.sheet_no)
    select book, sheet_no, header, 'added' as drift from c where not exists (select 1 from b where b.book = c.book and b.sheet_no = c.sheet_no and b.field = c.field)
    union all select book, sheet_no, header, 'removed' from b where not exists (select 1 from c where b.book = c.book and b.sheet_no = c.sheet_no and b.field = c.field)
    union all select c.book, c.sheet_no, c.header, 'renamed' from c join b on b.book = c.book and b.sheet_no = c.sheet_no and b.field = c.field where b.header <> c.header
    union all select c.book, c.sheet_no, c.header, 'retyped' from c join b on b.book = c.book and b.sheet_no = c.sheet_no and b.field = c.field where b.type <> c.type"""


_VERSIONS_SQL = """with e as (select book, sheet_no, j.key as header, j.type as kind_of from sheet_rows, json_each(record_json) j),
    h as (select book, sheet_no, header, max(case when kind_of in ('BIGINT', 'UBIGINT') then 0 when kind_of = 'DOUBLE' then 1 when kind_of = 'VARCHAR' then 2 when kind_of = 'ARRAY' then 3 when kind_of <> 'NULL' then 4 end) as i from e group by 1, 2, 3),
    t as (select book, sheet_no, header, ['whole', 'decimal', 'string', 'array', 'other'][i + 1] as type from h),
    f as (select book, sheet_no, cast(count(*) as bigint) as n_columns, sha256('[' || string_agg('{"header":' || to_json(header) || coalesce(',"type":"' || type || '"', '') || '}', ',' order by header) || ']') as fingerprint from t group by 1, 2),
    c as (select *, case when lag(fingerprint) over (partition by book order by sheet_no) = fingerprint then 0 else 1 end as changed from f)
    select book, sheet_no, cast(sum(changed) over (partition by book order by sheet_no) as int) as version, fingerprint, n_columns from c"""
SQL: dict[str, str] = {"p2_versions": _VERSIONS_SQL, "p1_found": _P1_SQL, "p2_found": _drift_sql()}
