"""Several values packed in one field: split into one value per row, position kept.

Grammar (ordered alternatives, first match wins, with backtracking)::

    field  <- json / items
    json   <- blank* '[' ... ']' blank* end           a JSON array of scalars
    items  <- item (separator item)* end
    item   <- blank* (known / quoted / bracketed / bare)? blank*   &(separator / end)
    known  <- a listed name that itself contains a separator, quote or bracket
    quoted <- '"' ('""' / !'"' .)* '"'   and the pairs of QUOTES
    bracketed <- the pairs of BRACKETS
    bare   <- (!separator .)*

A quoted or bracketed value whose closing sign is missing, or is not followed by a separator, makes
its alternative fail; the parser goes back and reads the item as a bare value, drops the stray signs
at its ends and flags it. The alternatives are compiled to one backtracking pattern, so a field costs
one pass.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEPARATORS = "|｜;；、，,/／+＋&＆\t\n\r"
QUOTES = (('"', '"'), ("“", "”"), ("「", "」"), ("『", "』"), ("'", "'"), ("‘", "’"), ("＂", "＂"))
BRACKETS = (("[", "]"), ("【", "】"), ("《", "》"), ("〈", "〉"), ("｛", "｝"), ("{", "}"))
FLAGS = ("unclosed", "stray", "json")
#: Names that need the dictionary are sent to the executors with the parser up to this many characters in all.
KNOWN_CHARS_MAX = 4_000_000


class Grammar:
    """The compiled grammar. ``known``: names that stay whole whatever signs they contain."""

    def __init__(self, known: Iterable[str] = (), separators: str = SEPARATORS):
        self.separators = separators
        signs = set(separators) | {c for p in QUOTES + BRACKETS for c in p}
        self.known = sorted({k.strip() for k in known if k and k.strip() and signs & set(k)}, key=lambda k: (-len(k), k))
        self._build()

    def _build(self) -> None:
        esc = re.escape
        sep = "".join(map(esc, self.separators))
        gap = rf"[^\S{sep}]*"  # blanks that do not separate
        end = rf"(?={gap}(?:[{sep}]|\Z))"
        alts = []
        if self.known:
            alts.append(f"(?P<known>{'|'.join(map(esc, self.known))}){end}")
        for i, (a, b) in enumerate(QUOTES):
            inner = rf"(?:[^{esc(b)}]|{esc(b)}{esc(b)})*" if a == b else rf"[^{esc(b)}]*"
            alts.append(f"{esc(a)}(?P<q{i}>{inner}){esc(b)}{end}")
        for i, (a, b) in enumerate(BRACKETS):
            alts.append(f"{esc(a)}(?P<b{i}>[^{esc(a)}{esc(b)}]*){esc(b)}{end}")
        alts.append(f"(?P<bare>[^{sep}]*)")
        self._item = re.compile(f"{gap}(?:{'|'.join(alts)}){gap}")
        self._plain = re.compile(f"[{sep}{''.join(esc(c) for p in QUOTES + BRACKETS for c in p)}]")
        self._open = {a for a, _ in QUOTES + BRACKETS}
        self._ends = "".join({c for p in QUOTES + BRACKETS for c in p})
        self._both = {f"q{i}": a for i, (a, b) in enumerate(QUOTES) if a == b}

    def __reduce__(self):
        return (Grammar, (self.known, self.separators))

    def _json(self, field: str) -> list[tuple[str, str | None]] | None:
        try:
            got = json.loads(field)
        except (ValueError, RecursionError):
            return None
        if not isinstance(got, list) or any(isinstance(x, list | dict) for x in got):
            return None
        return [("" if x is None else x if isinstance(x, str) else json.dumps(x), None) for x in got]

    def values(self, field: str | None) -> list[tuple[str, str | None]]:
        """``(value, flag)`` of each non-empty place of ``field``; the place is the index in the list.

        Flags: None, ``unclosed`` (a quote without its counterpart), ``stray`` (text after a closing
        quote), ``json`` (looks like a JSON array but is none).
        """
        if not field:
            return []
        whole = field.strip()
        if not self._plain.search(whole):
            return [(whole, None)] if whole else []
        broken = None
        if whole[0] == "[" and whole[-1] == "]":
            got = self._json(whole)
            if got is not None:
                return [(v.strip(), f) for v, f in got if v.strip()]
            if '"' in whole and whole.count("[") == 1:
                broken, whole = "json", whole[1:-1]
        out, at, n = [], 0, len(whole)
        while at <= n:
            m = self._item.match(whole, at)
            kind, flag = m.lastgroup, broken
            value = m.group(kind)
            if kind in self._both:
                value = value.replace(self._both[kind] * 2, self._both[kind])
            value = value.strip()
            if kind == "bare" and value and value[0] in self._open:
                closer = dict(QUOTES + BRACKETS)[value[0]]
                flag = "stray" if closer in value[1:] else "unclosed"
                value = value.strip(self._ends).strip()
            if value:
                out.append((value, flag))
            at = m.end()
            if at >= n:
                break
            if whole[at] in self.separators:
                at += 1
            # else: a quoted value ended early; its rest is read as a further bare item
        return out


def _signed(names: DataFrame, column: str, separators: str) -> DataFrame:
    """``(n)``: the distinct names that contain a sign of the grammar and so need the dictionary."""
    signs = "".join(sorted(set(separators) | {c for p in QUOTES + BRACKETS for c in p}))
    return names.select(F.col(f"`{column}`").alias("n")).where(F.col("n").isNotNull() & (F.translate("n", signs, "") != F.col("n"))).distinct()


def known_names(names: DataFrame, column: str, separators: str = SEPARATORS) -> list[str] | tuple[DataFrame, str]:
    """What :func:`split_packed` needs of the names of ``column``: the list of those that contain a sign of the grammar,
    or, where they have more than ``KNOWN_CHARS_MAX`` characters in all (summed before any is collected), the table and
    its column, which is then joined instead."""
    hit = _signed(names, column, separators)
    total = hit.agg(F.coalesce(F.sum(F.length("n")), F.lit(0))).first()[0]
    return (hit, "n") if total > KNOWN_CHARS_MAX else sorted(r[0] for r in hit.collect())


def _spans(field: str | None, separators: str, most: int) -> list[str]:
    """Every run of two to ``most`` adjacent pieces of a field: what might be a name that contains separators."""
    if not field:
        return []
    cuts = [-1, *[i for i, c in enumerate(field) if c in separators], len(field)]
    return list({field[a + 1 : b].strip(" 　\"'“”「」[]") for i, a in enumerate(cuts) for b in cuts[i + 2 : i + 1 + most]} - {""})


def split_packed(
    df: DataFrame,
    column: str,
    keys: Sequence[str],
    known: Iterable[str] | tuple[DataFrame, str] = (),
    separators: str = SEPARATORS,
    pos: str = "pos",
    val: str = "val",
    flag: str = "flag",
    count: str = "n_values",
) -> DataFrame:
    """One row per value of ``df[column]``: the ``keys`` and ``pos`` (from 1, empty places passed over),
    ``val`` (no outer blanks, no quoting), ``flag`` and ``count`` (values in that field).

    ``known`` are names that are one value whatever signs they contain. Where they are too many to be
    sent along, give ``(table, column)`` (as :func:`known_names` does): the runs of adjacent pieces of each field, as
    long as a name may be, are then joined to that table and only a field's own hits go to its parser.

    Null, empty and blank fields give no rows; repeated rows give repeated results; columns of ``df``
    other than the keys are dropped, so their names cannot clash. No shuffle with a list of names.
    """
    for k in keys:
        if k in (pos, val, flag, count):
            raise ValueError(f"key {k} clashes with an output column")
    types = {f.name: f.dataType for f in df.schema.fields}
    out = T.StructType([*[T.StructField(k, types[k]) for k in keys], T.StructField(pos, T.LongType()), T.StructField(val, T.StringType()), T.StructField(flag, T.StringType()), T.StructField(count, T.LongType())])
    slim = df.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{column}`").alias("__field")).where("__field is not null and __field <> ''")
    per_row = isinstance(known, tuple) and len(known) == 2 and isinstance(known[0], DataFrame)
    grammar = Grammar(() if per_row else known, separators)
    if per_row:
        names, name = known
        own = names.select(F.col(f"`{name}`").alias("__span")).where("__span is not null").distinct()
        pieces = own.agg(F.max(F.length("__span") - F.length(F.translate("__span", separators, "")))).first()[0] or 0
        signs = "".join({c for p in QUOTES + BRACKETS for c in p})
        quoted = own.where(F.translate("__span", signs, "") != F.col("__span"))
        spans = F.udf(lambda s: _spans(s, separators, pieces + 1), "array<string>", useArrow=True)
        # distinct fields are parsed once each, so a field that fills a third of the table is joined once
        fields = slim.select("__field").distinct()
        hits = fields.select("__field", F.explode(spans("__field")).alias("__span")).join(own, "__span", "left_semi")
        parts = fields.select("__field", F.explode(F.split("__field", f"[{re.escape(separators)}]")).alias("__span")).withColumn("__span", F.trim("__span"))
        hits = hits.unionByName(parts.join(quoted, "__span", "left_semi")).groupBy("__field").agg(F.collect_set("__span").alias("__hits"))
        slim = slim.join(hits, "__field", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, list] = {}
        for b in batches:
            idx, ps, vs, fs, ns = [], [], [], [], []
            hits = b.column("__hits").to_pylist() if per_row else None
            for i, field in enumerate(b.column("__field").to_pylist()):
                if hits and hits[i]:
                    got = Grammar(hits[i], separators).values(field)
                else:
                    got = memo.get(field)
                    if got is None:
                        got = grammar.values(field)
                        if len(memo) < 50_000 and len(field) < 500:
                            memo[field] = got
                n = len(got)
                for p, (v, f) in enumerate(got, 1):
                    idx.append(i)
                    ps.append(p)
                    vs.append(v)
                    fs.append(f)
                    ns.append(n)
            take = pa.array(idx, pa.int64())
            cols = [b.column(k).take(take) for k in keys] + [pa.array(ps, pa.int64()), pa.array(vs, pa.string()), pa.array(fs, pa.string()), pa.array(ns, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=[*keys, pos, val, flag, count])

    return slim.mapInArrow(run, out)
