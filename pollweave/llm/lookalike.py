"""Visually identical text with different characters brought to one form.

Look-alike classes are the transitive closure (union-find) of a fixed list of pairs over strings and
code points; in each class the member that is most frequent in the reference column represents it. A
text is cleaned of invisible characters, composed (NFKC) and then rewritten greedily, leftmost longest
first, by multi-pattern automata (Aho-Corasick): code points first, then strings such as ``rn`` for ``m``. Two strings look alike when their forms without
blanks are equal.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator, Mapping

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pollweave.session import broadcast_if_small

# Groups of code points and strings that look alike at reading size. The first member
# represents the group unless the reference column uses another more often.
GROUPS = (
    "· ・ • ‧ ⋅ ∙ ᐧ ⸱",
    "ー 一 ― — ─ ㅡ",
    "二 ニ", "八 ハ", "力 カ", "夕 タ", "口 ロ 囗", "工 エ", "卜 ト", "へ ヘ", "べ ベ", "ぺ ペ", "丿 ノ",
    "a а ɑ α", "b Ь", "c с ϲ", "d ԁ cl", "e е ҽ", "g ɡ", "h һ", "i і ı", "j ј", "k κ", "l ӏ", "m rn", "n ո", "o о ο օ", "p р ρ", "q ԛ",
    "r г", "s ѕ", "u υ ս", "v ν ѵ", "w ԝ vv", "x х ⅹ", "y у ү",
    "A А Α", "B В Β", "C С Ϲ", "E Е Ε", "G Ԍ", "H Н Η", "I І Ι Ӏ", "J Ј", "K К Κ", "M М Μ", "N Ν", "O О Ο Օ", "P Р Ρ", "Q Ԛ",
    "S Ѕ Տ", "T Т Τ", "U Ս", "V Ѵ", "W Ԝ VV", "X Х Χ Ⅹ", "Y У Υ Ү", "Z Ζ",
    "林 木木", "森 木林", "炎 火火", "| ǀ ∣ ｜ │", "/ ⁄ ∕ ╱", ", ‚", "& ﹠ ＆", "、 ﹑", "\" ″ ʺ ＂", "' ′ ʹ ＇",
)
#: The groups of code points alone.
CODE_POINTS = tuple(g for g in GROUPS if all(len(m) == 1 for m in g.split(" "))) + ("d ԁ", "m", "w ԝ", "W Ԝ")
#: Characters without ink: format characters, variation selectors, fillers; and blanks of any width.
INVISIBLE = re.compile("[\\s\\x00-\\x1f\\x7f-\\x9f\\u00a0\\u00ad\\u034f\\u061c\\u115f\\u1160\\u1680\\u17b4\\u17b5\\u180b-\\u180f\\u2000-\\u200f\\u2028-\\u202f\\u205f-\\u206f\\u2800\\u3000\\u3164\\ufe00-\\ufe0f\\ufeff\\uffa0\\ufff9-\\ufffb\\U000e0000-\\U000e0fff]")
_EARLY = str.maketrans({"゛": "゙", "゜": "゚", "Ϲ": "C", "ϲ": "c"})


def classes(groups: Iterable[Iterable[str]], frequency: Mapping[str, int] | None = None) -> dict[str, str]:
    """Member -> representative of its transitive class; representatives map to themselves.

    The most frequent member represents a class; among equals the one named first.
    """
    parent: dict[str, str] = {}
    order: dict[str, int] = {}

    def find(x: str) -> str:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for group in groups:
        members = list(group)
        for m in members:
            order.setdefault(m, len(order))
            parent.setdefault(m, m)
        for m in members[1:]:
            a, b = find(members[0]), find(m)
            if a != b:
                parent[b] = a
    best: dict[str, str] = {}
    rank = lambda m: (-(frequency or {}).get(m, 0), order[m])
    for m in order:
        root = find(m)
        if root not in best or rank(m) < rank(best[root]):
            best[root] = m
    return {m: best[find(m)] for m in order}


class Folder:
    """Brings text to one form; ``blanks=False`` keeps single blanks between visible characters."""

    def __init__(self, frequency: Mapping[str, int] | None = None, groups: Iterable[str] = GROUPS, blanks: bool = True):
        self.args = (dict(frequency or {}), tuple(groups), blanks)
        self.map = classes([g.split(" ") for g in self.args[1]], frequency)
        self.blanks = blanks
        self._build()

    def _build(self) -> None:
        """One automaton for the code points and one for the strings over code points already rewritten; a class with
        strings is written out as its longest member, so that what is made of what is does not matter."""
        single = {m: r for m, r in self.map.items() if len(m) == 1}
        wide: dict[str, list[str]] = {}
        for m, r in self.map.items():
            wide.setdefault(r, []).append(m)
        wide = {r: ms for r, ms in wide.items() if any(len(m) > 1 for m in ms)}
        shown = {r: min((m for m in ms if len(m) == 1), key=lambda m: (m != r, ms.index(m)), default=r) for r, ms in wide.items()}
        self.autos = [self._automaton({m: shown.get(r, r) for m, r in single.items()})]
        # members as the first automaton leaves them, each written out until nothing of it can be
        plain = {r: {self.rewrite(m) for m in ms} for r, ms in wide.items()}
        strings = {m: max(ms, key=lambda x: (len(x), x)) for ms in plain.values() for m in ms}
        out = {}
        for m, r in strings.items():
            while (longer := "".join(strings.get(c, c) for c in r)) != r and len(longer) < 64:
                r = longer
            out[m] = r
        self.autos.append(self._automaton(out))

    @staticmethod
    def _automaton(rules: Mapping[str, str]) -> ahocorasick.Automaton:
        auto = ahocorasick.Automaton()
        for m, rep in rules.items():
            if m != rep:
                auto.add_word(m, (len(m), rep))
        if len(auto):
            auto.make_automaton()
        return auto

    def __reduce__(self):
        return (Folder, self.args)

    def __call__(self, text: str | None) -> str | None:
        if text is None:
            return None
        if self.blanks:
            s = INVISIBLE.sub("", text)
        else:
            s = " ".join(INVISIBLE.sub(lambda m: " " if m.group().isspace() else "", text).split())
        s = unicodedata.normalize("NFKC", s.translate(_EARLY))
        if self.blanks and " " in s:
            s = s.replace(" ", "")
        return self.rewrite(s)

    def rewrite(self, s: str) -> str:
        for auto in self.autos:
            if len(auto):
                out, at = [], 0
                for end, (n, rep) in auto.iter_long(s):
                    out += (s[at : end - n + 1], rep)
                    at = end + 1
                s = "".join(out) + s[at:] if out else s
        return s


def frequencies(reference: DataFrame, column: str, groups: Iterable[str] = GROUPS) -> dict[str, int]:
    """How often each class member occurs in the reference column (as many rows as there are members)."""
    members = {m for g in groups for m in g.split(" ")}
    text = reference.select(F.col(f"`{column}`").alias("t")).where("t <> ''")
    single = sorted(m for m in members if len(m) == 1)
    counts = text.select(F.explode(F.split("t", "")).alias("m")).where(F.col("m").isin(single)).groupBy("m").agg(F.count("*").alias("n"))
    out = {m: 0 for m in members} | {r["m"]: r["n"] for r in counts.collect()}
    longer = sorted(m for m in members if len(m) > 1)
    if longer:
        row = text.agg(*[F.coalesce(F.sum(((F.length("t") - F.length(F.replace(F.col("t"), F.lit(m), F.lit("")))) / len(m)).cast("bigint")), F.lit(0)) for m in longer]).first()
        out |= dict(zip(longer, row, strict=True))
    return out


def folded(df: DataFrame, column: str, folder: Folder, out: str = "form") -> DataFrame:
    """``(value, out)`` for each distinct non-null value of ``column``; the text is folded once per value."""
    schema = T.StructType([T.StructField("value", T.StringType()), T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("value"), pa.array([folder(x) for x in b.column("value").to_pylist()], pa.string())], names=["value", out])

    return df.select(F.col(f"`{column}`").alias("value")).where("value is not null").distinct().mapInArrow(run, schema)


def found(df: DataFrame, column: str, keys: list[str], reference: DataFrame, ref_column: str) -> DataFrame:
    """Rows of ``df`` whose value is no reference value but looks like one: ``keys`` and ``looks_like``.

    The value folds to the form of a reference value; where several share a form the smallest is given.
    Null values, and forms without any visible character, give no rows; repeated rows stay repeated;
    other columns are dropped. Values are folded once each and joined by their form, so a value that
    fills a third of the table costs no more than any other.
    """
    folder = Folder(frequencies(reference, ref_column))
    names = folded(reference, ref_column, folder).where("form <> ''")
    forms = names.groupBy("form").agg(F.min("value").alias("looks_like"))
    # rows with a reference value are no cases; they leave before anything is shuffled
    rows = df.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{column}`").alias("__value")).where("__value is not null")
    rows = rows.join(broadcast_if_small(reference.select(F.col(f"`{ref_column}`").alias("__value")).distinct()), "__value", "left_anti")
    values = folded(rows, "__value", folder).where("form <> ''")
    hits = values.join(broadcast_if_small(forms), "form").select(F.col("value").alias("__value"), "looks_like")
    return rows.join(hits, "__value").select(*keys, "looks_like")
