"""Free-entered values mapped to a canonical list by a prefix-filter set-similarity join.

Values are cleaned (look-alike folding, case, decorations, stray punctuation), turned into token sets
(characters with their occurrence number, and character pairs) and joined to the reference sets by
exact Jaccard similarity: tokens are ordered by global rarity, only the rare prefixes that a pair with
the wanted similarity must share are joined, length and positional filters cut candidates, and the
similarity of the rest is verified exactly. The best entry is kept, or none.

Characters written in another variant (traditional for simplified and the like) are learned from the
values themselves: a character that the reference does not use, but which stands almost always for the
same reference character where a value and its best entry align, is rewritten before the join.

Only distinct values are matched; rows get their entry by joining on the value. A reference of bounded size goes to
the tasks, and the join runs there over its prefix postings; a larger one is joined by shuffle (:func:`similarity_join`).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pollweave.llm.lookalike import CODE_POINTS, Folder
from pollweave.session import broadcast_if_small, written

THRESHOLD = 0.32
#: Similarity from which variants are learned, and how often.
LEARN_AT, LEARN_ROUNDS = 0.22, 2
#: A variant is learned from at least so many values, of which this share agrees.
VARIANT_SUPPORT, VARIANT_SHARE = 3, 0.7
#: Characters of the reference (names and comparable forms) up to which it is sent to the tasks; a larger one is
#: joined by shuffle, with the same result.
REFERENCE_MAX = 2_000_000

# Words people put around a name, and marks of editions.
BEFORE = ("投给", "支持", "我推:", "我推", "永远的", "永遠的", "最爱的", "最愛的", "【本命】", "本命", "no.1", "#")
AFTER = (
    "大人", "小姐", "同学", "同學", "酱", "醬", "さん", "(新作版)", "(本命)", "(第二次投)", "(新)", "ver.2", "ver2", "~♡", "(改)", "(现场)", "(現場)",
    "(完整版)", "【再录】", "【再錄】", "(shortver.)", "-instrumental", "~anotherside", "~remix",
)
_PUNCT = re.compile(r"[^\w]|_|ー(?=$)")
_NOISE_ENDS = " .,…-!?~♡\"'“”「」『』《》〈〉【】#*:;、。·"
_NUMBER = re.compile(r"\(\d+\)$")


def clean(text: str | None, fold: Folder, variants: dict[str, str] | None = None, decorated: bool = True) -> str | None:
    """The comparable form of a value: folded, lower case, variants rewritten, decorations and punctuation off.

    Letters, digits and ideographs are kept; null for null, and '' if nothing is left.
    """
    if text is None:
        return None
    s = fold(text).lower()
    if variants:
        s = "".join(variants.get(c, c) for c in s)
    if decorated:
        while True:
            t = s.strip(_NOISE_ENDS)
            t = _NUMBER.sub("", t)
            u = t.replace("…", "").replace("...", "")
            for w in BEFORE:
                if u.startswith(w) and len(u) > len(w) + 1:
                    t = u = u[len(w) :]
            for w in AFTER:
                if u.endswith(w) and len(u) > len(w) + 1:
                    t = u = u[: -len(w)]
            if t == s:
                break
            s = t
    return _PUNCT.sub("", s)


def tokens(form: str) -> list[str]:
    """Characters with their occurrence number, and distinct character pairs."""
    seen: dict[str, int] = {}
    out = []
    for c in form:
        seen[c] = seen.get(c, 0) + 1
        out.append(f"{c}{seen[c]}")
    return out + sorted({form[i : i + 2] + "\x00" for i in range(len(form) - 1)})


def main_part(name: str) -> str:
    """A title without its subtitle or bracketed addition; the title itself if nothing else is left."""
    cut = re.split(r"\s[～~]\s|[（(]", name, maxsplit=1)[0].strip()
    return cut or name


_SETS = T.StructType([T.StructField("value", T.StringType()), T.StructField("form", T.StringType()), T.StructField("whole", T.BooleanType()), T.StructField("tokens", T.ArrayType(T.StringType()))])


def _sets(df: DataFrame, variants: dict[str, str] | None, parts: bool, decorated: bool) -> DataFrame:
    """``(value, form, whole, tokens)`` of the distinct strings ``df.value``; with ``parts`` also of main parts."""
    fold = Folder(groups=CODE_POINTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for v in b.column("value").to_pylist():
                form = clean(v, fold, variants, decorated)
                rows.append((v, form, True))
                if parts and (short := clean(main_part(v), fold, variants, decorated)) and short != form:
                    rows.append((v, short, False))
            cols = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([tokens(r[1]) for r in rows], pa.list_(pa.string()))], names=["value", "form", "whole", "tokens"])

    return df.select("value").where("value is not null").distinct().mapInArrow(run, _SETS).where("size(tokens) > 0")


def similarity_join(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """Pairs of sets with Jaccard similarity of at least ``threshold``: ``(l, r, jaccard)``.

    Both sides have ``id`` (unique) and ``tokens`` (distinct). Tokens are ordered by how rare they are
    in ``right`` (tokens it lacks come first), so a prefix seldom holds a common token. Exact for any
    data: filters drop only pairs below the threshold. Empty sets match nothing.
    """
    df = right.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("df"))

    def ranked(side: DataFrame) -> DataFrame:
        t = side.select("id", F.explode("tokens").alias("token")).join(df, "token", "left")
        s = F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), F.xxhash64("token").alias("h"))))
        return t.groupBy("id").agg(s.alias("s")).select("id", F.transform("s", lambda x: x["h"]).alias("s"), F.size("s").alias("n"))

    lr, rr = ranked(left), ranked(right)
    keep = F.col("n") - F.ceil(F.col("n") * threshold) + 1

    def prefix(side: DataFrame, tag: str) -> DataFrame:
        return side.select(F.col("id").alias(tag), F.col("n").alias(f"n{tag}"), F.posexplode(F.slice("s", F.lit(1), keep.cast("int"))).alias(f"p{tag}", "h"))

    a, b = prefix(lr, "l"), prefix(rr, "r")
    need = F.ceil((F.col("nl") + F.col("nr")) * (threshold / (1 + threshold)) - 1e-9)
    cand = a.join(b, "h").where((F.col("nl") >= F.col("nr") * threshold - 1e-9) & (F.col("nr") >= F.col("nl") * threshold - 1e-9))
    cand = cand.where(F.least(F.col("nl") - F.col("pl"), F.col("nr") - F.col("pr")) >= need).select("l", "r").distinct()
    both = cand.join(lr.select(F.col("id").alias("l"), F.col("s").alias("sl")), "l").join(rr.select(F.col("id").alias("r"), F.col("s").alias("sr")), "r")
    inter = F.size(F.array_intersect("sl", "sr"))
    return both.select("l", "r", (inter / (F.size("sl") + F.size("sr") - inter)).alias("jaccard")).where(F.col("jaccard") >= threshold - 1e-12)


def _best(values: DataFrame, refs: DataFrame, threshold: float) -> DataFrame:
    """``(value, form, ref_name, ref_form, jaccard)``: the best entry of each value that has one."""
    v = values.select(F.col("value").alias("id"), "tokens")
    r = refs.select(F.struct("value", "whole").alias("id"), "tokens")
    pairs = similarity_join(v, r, threshold)
    pairs = pairs.join(values.select(F.col("value").alias("l"), "form"), "l").join(refs.select(F.struct("value", "whole").alias("r"), F.col("form").alias("ref_form")), "r")
    # closest first: similarity, edit distance, whole titles before parts, then the smaller name
    rank = F.struct((-F.round("jaccard", 9)).alias("j"), F.levenshtein("form", "ref_form").alias("d"), (~F.col("r.whole")).alias("w"), F.col("r.value").alias("name"), F.col("ref_form").alias("ref_form"))
    best = pairs.groupBy("l", "form").agg(F.min(rank).alias("b"))
    return best.select(F.col("l").alias("value"), "form", F.col("b.name").alias("ref_name"), F.col("b.ref_form").alias("ref_form"), (-F.col("b.j")).alias("jaccard"))


def learn_variants(values: DataFrame, refs: DataFrame, at: float = LEARN_AT, support: int = VARIANT_SUPPORT, share: float = VARIANT_SHARE) -> dict[str, str]:
    """Characters foreign to the reference -> the reference character they stand for.

    Each value votes with all entries that tie as its most similar, where both are equally long and agree
    in at least half their places (two fifths of a short one): the right entry recurs, chance ones do not.
    A character counts if at least ``support`` values and ``share`` of those that hold it agree. The
    result has at most one entry for each foreign character.
    """
    chars = lambda c: F.split(c, "")
    alphabet = "".join(r["a"] for r in refs.select(F.explode(chars(F.col("form"))).alias("a")).distinct().collect())  # no longer than Unicode
    values = values.where(F.translate("form", alphabet, "") != "")  # others cannot vote
    v = values.select(F.col("value").alias("id"), "tokens")
    pairs = similarity_join(v, refs.select(F.struct("value", "whole").alias("id"), "tokens"), at)
    top = Window.partitionBy("l")
    pairs = pairs.withColumn("m", F.max("jaccard").over(top)).where("jaccard >= m - 1e-9")
    pairs = pairs.join(values.select(F.col("value").alias("l"), "form"), "l").join(refs.select(F.struct("value", "whole").alias("r"), F.col("form").alias("ref_form")), "r")
    z = pairs.where("length(form) = length(ref_form)").select("l", F.filter(F.arrays_zip(chars(F.col("form")).alias("a"), chars(F.col("ref_form")).alias("b")), lambda x: x["a"] != x["b"]).alias("z"), F.length("form").alias("n"))
    votes = z.where(F.size("z") * 5 <= F.col("n") * 3).select("l", F.explode("z").alias("z")).select("l", F.col("z.a").alias("a"), F.col("z.b").alias("b"))
    votes = votes.where((F.col("a") != "") & (F.col("b") != "") & (F.translate("a", alphabet, "") != "")).distinct()
    total = votes.groupBy("a").agg(F.countDistinct("l").alias("n"))
    best = votes.groupBy("a", "b").agg(F.count("*").alias("k")).groupBy("a").agg(F.max_by("b", F.struct("k", "b")).alias("b"), F.max("k").alias("k")).join(total, "a")
    return {r["a"]: r["b"] for r in best.where((F.col("k") >= support) & (F.col("k") >= share * F.col("n"))).collect()}


def variants_of(values: DataFrame, refs: DataFrame, start: dict[str, str] | None = None) -> dict[str, str]:
    """Variants learned in LEARN_ROUNDS rounds; ``start`` holds some known before (those of characters that
    this reference uses itself are left out)."""
    used = {r["a"] for r in refs.select(F.explode(F.split("form", "")).alias("a")).distinct().collect()}
    out = {a: b for a, b in (start or {}).items() if a not in used}
    for _ in range(LEARN_ROUNDS):
        more = learn_variants(_sets(values, out, False, True), refs)
        if not more:
            break
        out |= more
    return out


def _edits(a: str, b: str) -> int:
    """Levenshtein distance."""
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return row[-1]


class Reference:
    """The reference sets in memory: tokens ordered by rarity, postings of the prefixes, the sets for verification."""

    def __init__(self, rows: list[tuple[str, str, bool, list[str]]], thresholds: tuple[float, ...] = (LEARN_AT, THRESHOLD)):
        self.rows = sorted(rows)
        df = Counter(t for r in self.rows for t in r[3])
        self.order = {t: i for i, t in enumerate(sorted(df, key=lambda t: (df[t], t)))}
        self.sets = [frozenset(r[3]) for r in self.rows]
        self.alphabet = {c for r in self.rows for c in r[1]}
        self.postings: dict[float, dict[str, list[tuple[int, int]]]] = {}
        for t in set(thresholds):
            at: dict[str, list[tuple[int, int]]] = {}
            for i, r in enumerate(self.rows):
                ranked = sorted(r[3], key=self.order.__getitem__)
                for place, token in enumerate(ranked[: self.prefix(len(ranked), t)]):
                    at.setdefault(token, []).append((i, place))
            self.postings[t] = at

    @staticmethod
    def prefix(n: int, t: float) -> int:
        return n - math.ceil(n * t - 1e-9) + 1

    def matches(self, tokens: Sequence[str], t: float) -> list[tuple[float, int]]:
        """``(jaccard, reference row)`` of every reference set of at least ``t``: rare prefixes are looked up,
        candidates cut by length and place, and the rest verified. Tokens the reference lacks are the rarest."""
        n = len(tokens)
        known = sorted((x for x in tokens if x in self.order), key=self.order.__getitem__)
        strange = n - len(known)
        at, sets = self.postings[t], self.sets
        cand: set[int] = set()
        for place, x in enumerate(known[: max(0, self.prefix(n, t) - strange)], strange):
            for i, there in at.get(x, ()):
                m = len(sets[i])
                if i not in cand and m >= n * t - 1e-9 and n >= m * t - 1e-9 and min(n - place, m - there) >= (n + m) * t / (1 + t) - 1e-9:
                    cand.add(i)
        own = set(known)
        out = []
        for i in cand:
            both = len(own & sets[i])
            j = both / (n + len(sets[i]) - both)
            if j >= t - 1e-12:
                out.append((j, i))
        return out

    def best(self, form: str, tokens: Sequence[str], t: float) -> tuple[str | None, float | None]:
        """The closest entry: similarity, edit distance, whole titles before parts, then the smaller name."""
        found = self.matches(tokens, t)
        if not found:
            return None, None
        top = max(round(j, 9) for j, _ in found)
        tied = [self.rows[i] for j, i in found if round(j, 9) == top]
        name = tied[0][0] if len(tied) == 1 else min((_edits(form, r[1]), not r[2], r[0], r[1]) for r in tied)[2]
        return name, top

    def votes(self, form: str, tokens: Sequence[str], t: float) -> set[tuple[str, str]]:
        """``(foreign character, reference character)`` that a value votes for; see :func:`learn_variants`."""
        if self.alphabet.issuperset(form):
            return set()
        found = self.matches(tokens, t)
        top = max((j for j, _ in found), default=0)
        out = set()
        for j, i in found:
            ref = self.rows[i][1]
            if j >= top - 1e-9 and len(ref) == len(form):
                differ = [(a, b) for a, b in zip(form, ref, strict=True) if a != b]
                if len(differ) * 5 <= len(form) * 3:
                    out.update((a, b) for a, b in differ if a not in self.alphabet)
        return out


def _in_memory(refs: DataFrame) -> Reference | None:
    """The reference if it has at most REFERENCE_MAX characters in all (summed before anything is collected)."""
    size = refs.agg(F.sum(F.length("value") + F.length("form"))).first()[0] or 0
    return Reference([tuple(r) for r in refs.collect()]) if size <= REFERENCE_MAX else None


def _matched_in_memory(todo: DataFrame, ref: Reference, names: set[str], threshold: float, variants: dict[str, str] | None, known: dict[str, str] | None) -> DataFrame:
    """:func:`mapped` by narrow passes over the values: learning votes, then the best entry."""
    spark, fold = todo.sparkSession, Folder(groups=CODE_POINTS)
    sent = spark.sparkContext.broadcast((ref, names))

    def forms(b: pa.RecordBatch, rewrite: dict[str, str]) -> Iterator[tuple[str, str, list[str]]]:
        for v in b.column("value").to_pylist():
            form = clean(v, fold, rewrite)
            yield v, form, tokens(form)

    if variants is None:
        variants = {a: b for a, b in (known or {}).items() if a not in ref.alphabet}
        for _ in range(LEARN_ROUNDS):

            def voting(batches: Iterator[pa.RecordBatch], rewrite=dict(variants)) -> Iterator[pa.RecordBatch]:
                for b in batches:
                    n: Counter = Counter()
                    for _, form, ts in forms(b, rewrite):
                        cast = sent.value[0].votes(form, ts, LEARN_AT) if ts else ()
                        n.update(cast)
                        n.update({(a, None) for a, _ in cast})  # one for each value that votes on the character
                    yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in n], pa.string()), pa.array([k[1] for k in n], pa.string()), pa.array(list(n.values()), pa.int64())], names=["a", "b", "n"])

            votes = todo.mapInArrow(voting, "a string, b string, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n")).where(F.col("n") >= VARIANT_SUPPORT)
            total, most = {}, {}
            for r in votes.collect():  # at most an entry for each character and its partners that recur
                if r["b"] is None:
                    total[r["a"]] = r["n"]
                else:
                    most[r["a"]] = max(most.get(r["a"], (0, "")), (r["n"], r["b"]))
            more = {a: b for a, (k, b) in most.items() if k >= VARIANT_SHARE * total[a]}
            if not more:
                break
            variants |= more
        if known is not None:
            known |= variants

    def best(batches: Iterator[pa.RecordBatch], rewrite=dict(variants)) -> Iterator[pa.RecordBatch]:
        here, exact = sent.value
        for b in batches:
            got = [(v, 1.0) if v in exact else here.best(form, ts, threshold) if ts else (None, None) for v, form, ts in forms(b, rewrite)]
            yield pa.RecordBatch.from_arrays([b.column("value"), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=["value", "ref_name", "jaccard"])

    return todo.mapInArrow(best, "value string, ref_name string, jaccard double")


def mapped(values: DataFrame, reference: DataFrame, threshold: float = THRESHOLD, variants: dict[str, str] | None = None, known: dict[str, str] | None = None) -> DataFrame:
    """``(value, ref_name, jaccard)`` for each distinct non-null ``values.value``; null name if none is meant.

    ``reference.value`` holds the canonical names (repeats count once). Values that are a canonical name
    letter for letter map to it. With ``variants=None`` they are learned first; a dictionary ``known`` then
    gives the learning a start and takes up what it finds. Empty tables give empty results; values without
    letters or digits are unmatched.
    """
    # read by every round; few bytes and much work each, so not left to coalescing by size
    todo = written(values.select("value").where("value is not null").distinct().repartition(int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    refs = _sets(reference, None, True, False)
    if (ref := _in_memory(refs)) is not None and threshold in ref.postings:
        names = {r["value"] for r in reference.select("value").where("value is not null").distinct().collect()}
        return _matched_in_memory(todo, ref, names, threshold, variants, known)
    refs = written(refs)
    if variants is None:
        variants = variants_of(todo, refs, known)
        if known is not None:
            known |= variants
    best = _best(_sets(todo, variants, False, True), refs, threshold).select("value", "ref_name", "jaccard")
    exact = reference.select("value").where("value is not null").distinct().withColumn("exact", F.lit(True))
    out = todo.join(best, "value", "left").join(broadcast_if_small(exact), "value", "left")
    return out.select("value", F.when(F.col("exact"), F.col("value")).otherwise(F.col("ref_name")).alias("ref_name"), F.when(F.col("exact"), 1.0).otherwise(F.col("jaccard")).alias("jaccard"))
