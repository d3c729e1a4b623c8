"""Schemas that drift between files: versioned fingerprints, explicit migration rules, one table.

A *file* is one sheet of one book; each record is a JSON object. The operator

1. reads the schema of every file (header -> type of its non-null values),
2. resolves each header to a field by the migration rules of the book's kind,
3. fingerprints the file's schema and numbers the versions of a book,
4. reports each change against the preceding file of the same book,
5. derives for each fingerprint the chain of explicit steps (rename, cast, default, keep) that leads a file of
   that schema into the consistent table,
6. routes the records of each file through the chain of its fingerprint into one table per kind.

Everything is aggregated per file before files are compared, so the only data that meets in one
window partition is one row per sheet of a book.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pollweave.session import broadcast_if_small, written

TYPES = ("whole", "decimal", "string", "array", "other")


@dataclass(frozen=True)
class Rule:
    """One field of the consistent table: target type, default, and the headers it has come under."""

    name: str
    kind: str  # bigint, double or string
    aliases: tuple[str, ...] = ()
    default: object = None


@dataclass(frozen=True)
class Migration:
    """The rules of one kind of workbook; ``extra`` names fields that come and go and are kept as text."""

    book_kind: str
    rules: tuple[Rule, ...]
    extra: tuple[str, ...] = field(default=())

    def headers(self) -> dict[str, str]:
        """Header -> field. An exact field name always means that field."""
        out = {a: r.name for r in self.rules for a in r.aliases}
        out |= {r.name: r.name for r in self.rules} | {e: e for e in self.extra}
        return out


# The headers under which each field has been delivered.
_NAME = ("译名（暂定）", "譯名", "name_zh", "中文名", "中文译名", "译 名")
_VOTES = ("得票", "总票数", "votes", "票数（张）", "票 数", "票數")
_RANK = ("順位", "rank")
_PREV = ("前回名次", "上届名次")
_FIRST = ("本命票数", "一推し数")
_COMMENTS = ("评论", "コメント数")
_EXTRA = ("地区", "增减", "作者", "加权", "无偏爱", "有效率", "备注", "画师", "截止时刻", "其他性别", "重复票", "应援作品数")
MIGRATIONS = (
    Migration(
        "vote_jp_grouped",
        (
            Rule("名次", "bigint", (*_RANK, "排名")),
            Rule("上回名次", "bigint", _PREV),
            Rule("票数", "bigint", (*_VOTES, "得票数")),
            Rule("本名票数", "bigint", _FIRST),
            Rule("评论数", "bigint", _COMMENTS),
            Rule("日文名", "string", ("キャラ名", "日本名")),
            Rule("译名", "string", _NAME),
            Rule("首次出现作品", "double", ("初登场", "首次登场作品")),
        ),
        _EXTRA,
    ),
    Migration(
        "vote_music_cn",
        (
            Rule("名次", "bigint", (*_RANK, "排名")),
            Rule("译名", "string", _NAME),
            Rule("票数", "bigint", (*_VOTES, "得票数")),
            Rule("本命数", "bigint", ("本命", "本命票")),
            Rule("本命率", "double", ("本命比率", "一推率")),
            Rule("票数占比", "double", ("占比", "票数比例")),
            Rule("男性", "bigint", ("男", "男性人数")),
            Rule("女性", "bigint", ("女", "女性人数")),
        ),
        _EXTRA,
    ),
    Migration(
        "vote_music_jp",
        (
            Rule("排名", "bigint", (*_RANK, "名次")),
            Rule("上回名次", "bigint", _PREV),
            Rule("得票数", "bigint", ("票数", "得票", "votes", "得票数(张)", "得票數", "得 票 数", "总票数")),
            Rule("本名票数", "bigint", _FIRST),
            Rule("评论数", "bigint", _COMMENTS),
            Rule("曲目", "string", ("楽曲", "曲名")),
            Rule("译名", "string", _NAME),
        ),
        _EXTRA,
    ),
)


def plain_header(header: str) -> str:
    """A header without width, blanks, case and a note in brackets: the fallback for unlisted headers."""
    s = unicodedata.normalize("NFKC", header)
    s = "".join(s.split()).lower()
    cut = s.find("(")
    return s[:cut] if cut > 0 else s


def _plain(c: Column) -> Column:
    """:func:`plain_header` as an expression (full-width brackets, letters and digits; all blanks)."""
    wide = "".join(chr(0xFF01 + i) for i in range(94))
    thin = "".join(chr(0x21 + i) for i in range(94))
    s = F.lower(F.regexp_replace(F.translate(c, wide, thin), r"(?U)\s+", ""))
    return F.when(F.locate("(", s) > 1, F.substring_index(s, "(", 1)).otherwise(s)


def resolve(kind: Column, header: Column, migrations: tuple[Migration, ...] = MIGRATIONS) -> Column:
    """The field a header means: listed header, else the same header but for width, blanks and notes, else itself."""
    exact, plain = [], {}
    for m in migrations:
        for h, f in m.headers().items():
            exact += [F.lit(f"{m.book_kind}\0{h}"), F.lit(f)]
            plain.setdefault(f"{m.book_kind}\0{plain_header(h)}", f)
    loose = [x for k, v in plain.items() for x in (F.lit(k), F.lit(v))]
    if not exact:
        return header
    key = lambda h: F.concat(kind, F.lit("\0"), h)
    return F.coalesce(F.try_element_at(F.create_map(*exact), key(header)), F.try_element_at(F.create_map(*loose), key(_plain(header))), header)


def book_kind(book: Column) -> Column:
    """The kind of a book: its name without the number at the end."""
    return F.regexp_replace(book, r"-\d+$", "")


def _type(v: Column) -> Column:
    t = F.schema_of_variant(v)
    return (
        F.when(t == "VOID", None)
        .when(t == "BIGINT", "whole")
        .when(t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT"), "decimal")
        .when(t == "STRING", "string")
        .when(t.startswith("ARRAY"), "array")
        .otherwise("other")
    )


def file_schemas(records: DataFrame, migrations: tuple[Migration, ...] = MIGRATIONS) -> DataFrame:
    """One row per file: ``book, sheet_no, columns array<struct<field, header, type>>`` sorted by field.

    ``records`` has ``book, sheet_no, record_json``. A header counts if any record has the key; its type
    is that of its non-null values (null if there are none; where types mix, the widest: string over
    decimal over whole, array over all). Records that are null or no JSON object add nothing.
    """
    one = records.select("book", "sheet_no", F.try_parse_json("record_json").alias("__v")).where("book is not null and sheet_no is not null and __v is not null and schema_of_variant(__v) like 'OBJECT%'")
    keys = one.lateralJoin(_exploded()).select("book", "sheet_no", F.col("key").alias("header"), _type(F.col("value")).alias("__t"))
    order = F.create_map(*[x for i, t in enumerate(("whole", "decimal", "string", "array", "other")) for x in (F.lit(t), F.lit(i))])
    names = F.array(*map(F.lit, ("whole", "decimal", "string", "array", "other")))
    per = keys.groupBy("book", "sheet_no", "header").agg(F.max(F.try_element_at(order, F.col("__t"))).alias("__i"))
    per = per.select("book", "sheet_no", "header", F.when(F.col("__i").isNotNull(), F.get(names, F.col("__i"))).alias("type"), resolve(book_kind(F.col("book")), F.col("header"), migrations).alias("field"))
    cols = per.groupBy("book", "sheet_no").agg(F.array_sort(F.collect_list(F.struct("field", "header", "type"))).alias("columns"))
    # two headers of one file cannot both be the field: the one named like it keeps it, the other stands for itself
    clash = "filter(columns, y -> y.field = x.field)"
    fixed = f"transform(columns, x -> named_struct('field', case when size({clash}) > 1 and x.header <> coalesce(element_at(filter({clash}, y -> y.header = y.field), 1).header, element_at({clash}, 1).header) then x.header else x.field end, 'header', x.header, 'type', x.type))"
    return cols.select("book", "sheet_no", F.expr("try_element_at(columns, 1)").isNotNull().alias("__ok"), F.expr(fixed.replace("element_at(filter", "try_element_at(filter")).alias("columns")).drop("__ok")


def _exploded():
    from pyspark.sql import SparkSession

    return SparkSession.active().tvf.variant_explode(F.col("__v").outer())


def versions(schemas: DataFrame) -> DataFrame:
    """``book, sheet_no, columns, previous, fingerprint, version``: files with their predecessor's columns.

    The fingerprint covers headers and types but not their order; ``version`` counts from 1 and rises
    whenever the fingerprint differs from the preceding file of the book.
    """
    w = Window.partitionBy("book").orderBy("sheet_no")
    out = schemas.withColumn("fingerprint", F.sha2(F.to_json(F.expr("array_sort(transform(columns, x -> struct(x.header, x.type)))")), 256))
    out = out.withColumn("previous", F.lag("columns").over(w)).withColumn("__changed", (~F.lag("fingerprint").over(w).eqNullSafe(F.col("fingerprint"))).cast("int"))
    return out.withColumn("version", F.sum("__changed").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("__changed")


def changes(schemas: DataFrame) -> DataFrame:
    """Each change of a file against the preceding one: ``book, sheet_no, header, drift, field, was, now``.

    ``drift``: ``added``, ``removed`` (header as in the preceding file), ``renamed``, ``retyped``; a field
    both renamed and retyped gives two rows. A field without any non-null value has no type and is not
    reported as retyped. The first file of a book has no changes; column order is none.
    """
    v = versions(schemas).where("previous is not null")
    expr = """
    concat(
      transform(filter(columns, x -> not exists(previous, p -> p.field = x.field)), x -> struct(x.header as header, 'added' as drift, x.field as field, cast(null as string) as was, x.header as now)),
      transform(filter(previous, p -> not exists(columns, x -> x.field = p.field)), p -> struct(p.header as header, 'removed' as drift, p.field as field, p.header as was, cast(null as string) as now)),
      transform(filter(columns, x -> exists(previous, p -> p.field = x.field and p.header <> x.header)), x -> struct(x.header as header, 'renamed' as drift, x.field as field, try_element_at(filter(previous, p -> p.field = x.field), 1).header as was, x.header as now)),
      transform(filter(columns, x -> exists(previous, p -> p.field = x.field and p.type <> x.type)), x -> struct(x.header as header, 'retyped' as drift, x.field as field, try_element_at(filter(previous, p -> p.field = x.field), 1).type as was, x.type as now)))
    """
    return v.select("book", "sheet_no", F.explode(F.expr(expr)).alias("c")).select("book", "sheet_no", "c.*")


#: Types of values that a field's type takes without a cast.
_TAKES = {"bigint": ("whole",), "double": ("decimal", "whole"), "string": ("string",)}


def chains(schemas: DataFrame, migrations: tuple[Migration, ...] = MIGRATIONS) -> DataFrame:
    """``kind, fingerprint, n_files, means map<header, field>, steps``: one row for each schema that any file has.

    ``steps`` is an array of ``op, header, field, value`` in the order in which they apply: ``rename`` (a header
    that means a field of another name), ``merge`` (a further header of a field that has several; the one named like the
    field comes first), ``cast`` (values come as ``value``, the field has another type), ``default`` (a field that the
    schema lacks, with the rule's default), ``keep`` (a header that means no field; its values go to ``extra``).
    """
    return _chains(versions(schemas), migrations)


def _chains(files: DataFrame, migrations: tuple[Migration, ...]) -> DataFrame:
    """:func:`chains` of the rows of :func:`versions`."""
    v = files.withColumn("kind", book_kind(F.col("book")))
    one = v.groupBy("kind", "fingerprint").agg(F.count("*").alias("n_files"), F.any_value("columns").alias("columns"))
    heads = F.transform("columns", lambda x: F.struct(x["header"].alias("header"), resolve(F.col("kind"), x["header"], migrations).alias("field"), x["type"].alias("type")))
    step = lambda op, h, f, val: F.struct(F.lit(op).alias("op"), h.cast("string").alias("header"), f.cast("string").alias("field"), val.cast("string").alias("value"))
    none = F.lit(None)
    absent = F.expr("cast(array() as array<struct<op string, header string, field string, value string>>)")
    is_field = casts = lambda x: F.lit(False)
    for m in migrations:
        here = F.col("kind") == m.book_kind
        is_field = lambda x, f=is_field, here=here, m=m: f(x) | (here & x["field"].isin([r.name for r in m.rules]))
        for r in m.rules:
            casts = lambda x, f=casts, here=here, r=r: f(x) | (here & (x["field"] == r.name) & ~x["type"].isin(*_TAKES[r.kind]))
            lacks = here & ~F.array_contains(F.transform("heads", lambda x: x["field"]), r.name)
            absent = F.concat(absent, F.when(lacks, F.array(step("default", none, F.lit(r.name), F.lit(r.default)))).otherwise(F.expr("cast(array() as array<struct<op string, header string, field string, value string>>)")))
    one = one.withColumn("heads", F.array_sort(heads))
    first = lambda x: F.array_min(F.transform(F.filter("heads", lambda y: y["field"] == x["field"]), lambda y: F.struct((y["header"] != y["field"]).alias("o"), y["header"].alias("h"))))["h"]
    merged = lambda x: is_field(x) & (first(x) != x["header"])
    steps = F.concat(
        F.transform(F.filter("heads", lambda x: (x["field"] != x["header"]) & ~merged(x)), lambda x: step("rename", x["header"], x["field"], none)),
        F.transform(F.filter("heads", merged), lambda x: step("merge", x["header"], x["field"], none)),
        F.transform(F.filter("heads", lambda x: casts(x)), lambda x: step("cast", x["header"], x["field"], x["type"])),
        absent,
        F.transform(F.filter("heads", lambda x: ~is_field(x)), lambda x: step("keep", x["header"], x["field"], none)),
    )
    means = F.map_from_entries(F.transform("heads", lambda x: F.struct(x["header"], x["field"])))
    return one.select("kind", "fingerprint", "n_files", means.alias("means"), steps.alias("steps"))


def routes(records: DataFrame, migrations: tuple[Migration, ...] = MIGRATIONS) -> DataFrame:
    """``book, sheet_no, version, fingerprint, __f``: for each file the chain it goes through, as header -> field. One
    row per file, written once, as every kind's records are routed by it."""
    files = written(versions(file_schemas(records, migrations)).select("book", "sheet_no", "version", "fingerprint", "columns"))
    steps = _chains(files, migrations).select("kind", "fingerprint", F.col("means").alias("__f"))
    kind = book_kind(F.col("book")).alias("kind")
    return written(files.select("book", "sheet_no", "version", "fingerprint", kind).join(steps, ["kind", "fingerprint"]).drop("kind"))


def _entries(text: Column) -> Column:
    """The entries of a value that is a JSON list, else null."""
    return F.when(text.startswith("["), F.from_json(text, "array<string>"))


def _cast(text: Column, kind: str) -> Column:
    """Text of a JSON value to a type: lists give their first entry, ``约``, units, blanks and % are read away."""
    first = F.when(_entries(text).isNotNull(), F.get(_entries(text), F.lit(0))).otherwise(text)
    if kind == "string":
        return F.regexp_replace(first, r"(?U)^\s+|\s+$", "")
    num = F.regexp_extract(F.regexp_replace(first, ",", ""), r"[-+]?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?", 0)
    val = F.try_cast(num, "double") if hasattr(F, "try_cast") else num.try_cast("double")
    val = F.when(first.endswith("%"), val / 100).otherwise(val)
    return val.try_cast("bigint") if kind == "bigint" else val


def _objects(records: DataFrame) -> DataFrame:
    return records.select("rec_id", "book", "sheet_no", "row_no", F.from_json("record_json", "map<string,string>").alias("__m")).where("__m is not null")


def _routed(records: DataFrame, migration: Migration, files: DataFrame) -> DataFrame:
    """The records of one kind with ``__m`` (header -> text), ``__f`` (header -> field, by the chain of the record's
    file) and ``__won`` (field -> header that gives its value: the one named like the field if it has a value, else the
    first that has one)."""
    routed = _objects(records.where(book_kind(F.col("book")) == migration.book_kind)).join(files, ["book", "sheet_no"])
    order = lambda r, h: F.struct(F.try_element_at("__m", h).isNull().alias("n"), (h != F.lit(r.name)).alias("o"), h.alias("h"))
    heads = lambda r: F.filter(F.map_keys("__m"), lambda h: F.try_element_at("__f", h) == F.lit(r.name))
    first = lambda r: F.array_min(F.transform(heads(r), lambda h: order(r, h)))["h"]
    won = [x for r in migration.rules for x in (F.lit(r.name), first(r))]
    return routed.withColumn("__won", F.create_map(*won) if won else F.expr("cast(map() as map<string,string>)"))


def _unified(records: DataFrame, migration: Migration, files: DataFrame) -> DataFrame:
    """:func:`unified` with the columns of :func:`_routed`."""
    routed = _routed(records, migration, files)
    fields, failed = [], []
    for r in migration.rules:
        head = F.try_element_at("__won", F.lit(r.name))
        text = F.try_element_at("__m", head)
        c = _cast(text, r.kind)
        if r.kind != "string":
            failed.append(F.when((F.trim(text) != "") & ~c.cast("double").eqNullSafe(_cast(text, "double")) | (F.trim(text) != "") & c.isNull(), head))
        fields.append((F.coalesce(c, F.lit(r.default)) if r.default is not None else c).alias(r.name))
    won = F.map_values("__won")
    routed = routed.withColumn("__failed", F.array_compact(F.array(*failed)) if failed else F.expr("cast(array() as array<string>)"))
    whole = lambda k: ~F.exists(won, lambda h: h.eqNullSafe(k)) | F.array_contains("__failed", k)
    rest = F.transform_values(F.map_filter("__m", lambda k, v: ~whole(k) & (F.coalesce(F.size(_entries(v)), F.lit(0)) > 1)), lambda k, v: F.to_json(F.slice(_entries(v), 2, F.size(_entries(v)) - 1)))
    extra = F.map_concat(F.map_filter("__m", lambda k, v: whole(k)), rest)
    return routed.select("rec_id", "book", "sheet_no", "row_no", *fields, extra.alias("extra"), "__f", "__won")


def unified(records: DataFrame, migration: Migration) -> DataFrame:
    """All records of one kind in one table: ``rec_id, book, sheet_no, row_no``, the fields with their
    types, and ``extra map<string,string>`` with everything that is in no field, by header: headers that mean
    no field of the kind, the further headers of a field that has several, values that the type cannot hold, and,
    as a JSON list, what follows the first entry of a list.

    Each record goes through the chain of its file (see :func:`routes`; one row per file, broadcast if its size
    allows). Missing fields take the rule's default; values that cannot be read as the type become null, a whole number loses
    its fraction, and either stays in ``extra`` as it was delivered. Repeated
    records stay repeated. Records that are no JSON object give no row.
    """
    return _unified(records, migration, broadcast_if_small(routes(records, (migration,)))).drop("__f", "__won", "version", "fingerprint")


def long_form(records: DataFrame, migrations: tuple[Migration, ...] = MIGRATIONS) -> DataFrame:
    """``(rec_id, kind, book, sheet_no, row_no, field, value)``: every value of every record as text.

    A row for each field of the kind, value null where the record has none; a row for each further entry of a
    list; a row as delivered for a value that the field's type cannot hold; a row for each other header, under the field it means, or under itself if another header of the
    record gives that field. Kinds without rules have a row for each header.
    """
    keys = ["rec_id", "kind", "book", "sheet_no", "row_no"]
    files = broadcast_if_small(routes(records, migrations))
    pair = lambda f, v: F.struct(f.alias("field"), v.alias("value"))
    parts = []
    for m in migrations:
        names = [r.name for r in m.rules]
        fields = F.array(*[pair(F.lit(n), F.col(f"`{n}`").cast("string")) for n in names]) if names else F.expr("cast(array() as array<struct<field string, value string>>)")

        def other(e: Column) -> Column:
            means, head, text = F.try_element_at("__f", e["key"]), e["key"], e["value"]
            won = F.exists(F.map_values("__won"), lambda h: h.eqNullSafe(head))
            return F.when(won, F.coalesce(F.transform(_entries(text), lambda x: pair(means, x)), F.array(pair(means, text)))).otherwise(F.array(pair(F.when(means.isin(names), head).otherwise(means), text)))

        more = F.flatten(F.transform(F.map_entries("extra"), other))
        parts.append(_unified(records, m, files).select("rec_id", F.lit(m.book_kind).alias("kind"), "book", "sheet_no", "row_no", F.explode(F.concat(fields, more)).alias("p")).select(*keys, "p.*"))
    kind = book_kind(F.col("book"))
    rest = _objects(records.where(~F.coalesce(kind.isin([m.book_kind for m in migrations]), F.lit(False))))
    return reduce(DataFrame.unionByName, [*parts, rest.select("rec_id", kind.alias("kind"), "book", "sheet_no", "row_no", F.explode("__m").alias("field", "value"))])
