"""Main content of web pages: flat text blocks classified by a decision tree.

A page is a list of blocks (lines). Each block gets its word count and link density (the share of its
text in short pieces set side by side, as menus are), a few signs of its form, whether it shares the
page's topic, and the same figures of its neighbours; a decision tree (CART, trained here on the small
labelled table beside this module) tells content from boilerplate. No word list takes part: the topic is
the short piece of the page that most of its sentences repeat, and what a site prints on page after page
is known by counting it (:func:`templates`), not by its words.

One narrow pass over the pages, and one before it that counts repeated short blocks; what is shuffled
there are counts combined per task.
"""

from __future__ import annotations

import csv
import re
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LABELS = Path(__file__).with_name("blocks_labelled_by_rules.csv")
#: A short block is counted as repeated from so many pages and this share of all pages on. The share bounds
#: the table that is sent to the tasks: at most its inverse times the short blocks of a page.
TEMPLATE_PAGES, TEMPLATE_SHARE = 3, 1 / 2000
#: Letters of a short block at most.
SHORT = 120
#: Characters of pages handled together.
CHUNK = 500_000

_STOP = "。！？!?.～♪…」”』\"）)"
_SENTENCES = r"[。！？!?～♪]|\.{3}|…+|\.(?:[\s」”\"']|$)"
_WORDS = r"[A-Za-zÀ-ÿ'’]+|\d+|[가-힣]+|[\x{3040}-\x{30FF}]|[\x{3400}-\x{9FFF}]"
_SIDE = r"\s*\|\s*|\s+[>·<]\s+|\s+"
_BULLET = re.compile(r"^\s*(?:[>*•·\-–—◆■●]|\d+[.)、])\s*")
_TAIL = re.compile(r"\s*(?:/[^/]{1,12}|[（(][^（()）]{1,16}[)）]|\s[-–—]\s.{1,30})$")
_PIECE = re.compile(r"\s*\|\s*|\s+[>·<]\s+|\s{2,}")
_NUMBER = re.compile(r"\d+")
_CLAUSE = re.compile(r"[、，,：:（）()「」“”。！？!?～♪….\s]+")
_NAMES = re.compile(r"[A-ZÀ-Þ][\w'’]*(?:\s(?:and\s)?[A-ZÀ-Þ]\w*)+")

_OWN = ("words", "link_density", "ends", "cut", "sentences", "bullet", "numbered", "quoted", "bracketed", "entry", "topic", "title", "again", "crumb")
_NEAR = ("words", "link_density", "ends", "topic", "text", "entry", "bracketed", "again")
_FAR = ("words", "text")
_STATS = ("t_pages", "t_inside", "t_before", "t_after")
_NEAR_STATS = ("t_inside", "t_before")
FEATURES = (
    *_OWN, "text",
    *(f"prev_{n}" for n in _NEAR), *(f"prev2_{n}" for n in _FAR), *(f"next_{n}" for n in _NEAR), *(f"next2_{n}" for n in _FAR),
    "to_core_before", "to_core_after", "inside", "core",
    *_STATS, *(f"prev_{n}" for n in _NEAR_STATS), *(f"next_{n}" for n in _NEAR_STATS),
)


def occurrences(names: Sequence[str], texts: Sequence[str]) -> dict[str, int]:
    """In how many of ``texts`` each of ``names`` stands, for those that stand in any; work in proportion to the texts."""
    if len(names) * len(texts) <= 4000:
        joined = "\n".join(texts)
        return {x: sum(x in t for t in texts) for x in names if x in joined}
    auto = ahocorasick.Automaton()
    for x in names:
        auto.add_word(x, x)
    auto.make_automaton()
    return dict(Counter(x for t in texts for x in {x for _, x in auto.iter(t)}))


def shared_phrase(texts: Sequence[str]) -> tuple[str, int]:
    """``(phrase, texts that have it)``: names where there are capitals, else long words; in scripts that do not part
    words the longest run of letters among those that most texts share. Ties go to the larger code points."""
    grams: Counter = Counter()
    for t in texts:
        names = _NAMES.findall(t)
        grams.update(set(names) if names else {y for x in _CLAUSE.split(t) for y in ([x.lower()] * (len(x) > 4) if x.isascii() else [x[k : k + 3] for k in range(len(x) - 2)])})
    most = max(grams.values(), default=0)
    top = max((g for g, n in grams.items() if n == most), default="")
    if len(top) == 3 and not top.isascii():  # grown as long as no text is lost
        have = [t for t in texts if top in t]
        for side in (1, 0):
            while True:
                first = have[0]
                k = first.index(top)
                c = first[k + len(top) : k + len(top) + 1] if side else first[max(0, k - 1) : k]
                longer = top + c if side else c + top
                if not c or _CLAUSE.match(c) or any(longer not in t for t in have):
                    break
                top = longer
    return top, most


class Blocks:
    """The blocks of some pages with their own figures; ``page`` numbers the page of each block."""

    def __init__(self, texts: Sequence[str]):
        split = [t.split("\n") for t in texts]
        self.lines = [x for ls in split for x in ls]
        n = np.array([len(ls) for ls in split], np.int64)
        self.start = np.concatenate([[0], np.cumsum(n)])
        self.page = np.repeat(np.arange(len(split)), n)
        raw = pa.array(self.lines, pa.string())
        line = pc.utf8_trim_whitespace(pc.replace_substring_regex(raw, r"\s+", " "))
        f64 = lambda a: a.to_numpy(zero_copy_only=False).astype(float)
        size = f64(pc.utf8_length(line))
        self.forms = line.to_pylist()
        self.size = size
        o = self.own = {k: np.zeros(len(self.lines)) for k in _OWN}
        o["words"] = f64(pc.count_substring_regex(line, _WORDS))
        o["sentences"] = f64(pc.count_substring_regex(line, _SENTENCES))
        o["ends"] = np.array([x[-1:] in _STOP and x != "" for x in self.forms], float)
        o["cut"] = f64(pc.match_substring_regex(line, r"(?:…|\.\.\.)$"))
        o["bullet"] = f64(pc.match_substring_regex(line, r"^(?:[>*•·\-–—◆■●]|\d+[.)、])\s*\S"))
        o["numbered"] = o["bullet"] * f64(pc.match_substring_regex(line, r"^\d"))
        o["quoted"] = f64(pc.match_substring_regex(line, r"^(?:[>*•·\-–—◆■●]\s*)?[「“『\"]"))
        o["bracketed"] = f64(pc.match_substring_regex(line, r"^[\[【（(].*[\]】）)]$"))
        o["crumb"] = f64(pc.match_substring(line, " < "))
        self._density(raw, size)
        for i in np.flatnonzero(f64(pc.match_substring_regex(line, r"：|: "))):
            head, _, tail = _BULLET.sub("", self.forms[i]).replace(": ", "：", 1).partition("：")
            o["entry"][i] = 1 < len(head) <= 40 and head in tail
        solid = size > 0
        #: a block of running text: enough words, not set side by side, and closed as sentences are
        self.text = solid & (o["words"] >= 8) & (o["link_density"] < 0.5) & (o["ends"] > 0) & (o["sentences"] > 0)
        self.solid = solid
        seen: dict[tuple[int, str], int] = Counter((p, x) for p, x in zip(self.page.tolist(), self.forms, strict=True) if x)
        o["again"] = np.array([min(seen.get((p, x), 0), 9) for p, x in zip(self.page.tolist(), self.forms, strict=True)], float)
        self._topics()

    def _density(self, raw: pa.Array, size: np.ndarray) -> None:
        o = self.own
        pieces = pc.split_pattern_regex(pc.utf8_trim_whitespace(raw), _SIDE)
        flat = pc.utf8_length(pieces.flatten()).to_numpy(zero_copy_only=False).astype(float)
        marks = pc.match_substring_regex(pieces.flatten(), r"[。！？!?～♪…]").to_numpy(zero_copy_only=False)
        at = pieces.offsets.to_numpy()[:-1]
        full = np.maximum(np.add.reduceat(flat, at), 1) if len(flat) else np.ones(len(size))
        short = np.add.reduceat(np.where((flat <= 16) & ~marks, flat, 0), at) if len(flat) else np.zeros(len(size))
        n = np.diff(pieces.offsets.to_numpy()).astype(float)
        d = np.where(n > 1, short / full, 0.0)
        # in running text of languages that part words by blanks the pieces are words, and function words link them
        d = np.where((n > 1) & (o["ends"] > 0) & (o["sentences"] > 0) & (o["words"] >= 8), d * 0.4, d)
        o["link_density"] = np.where((n == 1) & (o["words"] <= 8) & (o["ends"] == 0) & (size > 0), 1.0, d)

    def _topics(self) -> None:
        """The topic of each page and the blocks that share it."""
        o = self.own
        self.topics: list[str] = []
        text, starts = self.text.tolist(), self.start.tolist()
        # blocks that may name the topic, and the running text that may repeat it
        names = (self.solid & (self.size <= 80) & ~((o["sentences"] > 0) & (o["ends"] > 0)) & (o["bullet"] == 0)).tolist()
        told_at = (self.text & (o["entry"] == 0)).tolist()
        for a, b in zip(starts, starts[1:], strict=False):
            told = [self.forms[i] for i in range(a, b) if told_at[i]]
            topic, at = self._topic(a, b, told, names, text)
            self.topics.append(topic)
            if topic:
                low = topic.lower()
                o["topic"][a:b] = [low in f.lower() for f in self.forms[a:b]]
                if at >= 0:
                    o["title"][at] = 1

    def _topic(self, a: int, b: int, told: list[str], names: list[bool], text: list[bool]) -> tuple[str, int]:
        """``(topic, its block or -1)`` of the page of blocks a to b: the short piece, alone or among others in a
        block, that most running text repeats; else the phrase that most of it shares."""
        if not told:
            return "", -1
        pieces: dict[str, list[tuple[int, bool, bool]]] = {}
        for i in range(a, b):
            if not names[i]:
                continue
            f = self.forms[i]
            parts = _PIECE.split(f)
            for c in parts if len(parts) == 1 else dict.fromkeys([*parts, f]):
                tail = _TAIL.sub("", c)
                for name in (c,) if tail == c else (c, tail):
                    if 1 < len(name) <= 40:
                        pieces.setdefault(name, []).append((i, len(parts) == 1, name != c or " < " in f))
        best, score, at = "", 0.0, -1
        counts = occurrences(list(pieces), told)
        for name, n in counts.items():
            for i, alone, tail in pieces[name]:
                # a block of its own that text about it follows is a title rather than a link to another page
                nxt = next((j for j in range(i + 1, min(b, i + 4)) if text[j]), -1)
                s = n + 0.8 * (alone and nxt >= 0 and name in self.forms[nxt]) + 0.3 * tail + 0.2 * alone - 0.002 * min(i - a, 100)
                if s > score:
                    best, score, at = name, s, i if alone else -1
        n = counts.get(best, 0)
        if best and at < 0:
            at = next((i for i in range(a, b) if names[i] and " < " not in self.forms[i] and _TAIL.sub("", self.forms[i]) == best), -1)
        if len(told) >= 3 and n < 0.4 * len(told):
            top, m = shared_phrase(told)
            if m >= max(3, 0.5 * len(told), n + 2):
                return top, -1
        return best, at

    def key(self, i: int) -> str:
        """What :func:`templates` counts a block under: its text with the page's topic and all numbers masked."""
        f, topic = self.forms[i], self.topics[self.page[i]]
        return _NUMBER.sub("0", f.replace(topic, "\0") if topic else f)

    def core(self) -> np.ndarray:
        """Running text and entries that are surely part of what the page is about."""
        return self.text & ((self.own["topic"] > 0) & (self.own["crumb"] == 0) | (self.own["entry"] > 0) & (self.own["numbered"] == 0))

    def around(self) -> dict[str, np.ndarray]:
        """Where each block stands: the solid blocks before and after it (-1 for none), and its distance to
        the core on both sides in solid blocks."""
        n = len(self.lines)
        solid = np.flatnonzero(self.solid)
        rank = np.cumsum(self.solid) - 1  # rank of the last solid block up to here
        page = self.page
        out = {}
        for name, step in (("prev", -1), ("prev2", -2), ("next", 1), ("next2", 2)):
            k = rank + step + ((~self.solid) & (step < 0)).astype(int)
            ok = (k >= 0) & (k < len(solid))
            j = np.where(ok, solid[np.clip(k, 0, max(0, len(solid) - 1))], -1) if len(solid) else np.full(n, -1)
            out[name] = np.where((j >= 0) & (page[j] == page), j, -1)
        core = self.core()
        at = np.where(core, np.arange(n), -1)
        last = np.maximum.accumulate(at) if n else at
        first = np.where(core, np.arange(n), n)
        nxt = np.minimum.accumulate(first[::-1])[::-1] if n else first
        before = (last >= 0) & (page[np.maximum(last, 0)] == page)
        after = (nxt < n) & (page[np.minimum(nxt, n - 1)] == page)
        out["before"] = np.where(before, rank - rank[np.maximum(last, 0)], 99)
        out["after"] = np.where(after, rank[np.minimum(nxt, n - 1)] - rank, 99)
        out["core"] = core
        return out


def context(blocks: Blocks) -> tuple[list[str], np.ndarray]:
    """The short blocks and, for each, whether it stands inside the core, before running text of the topic (at
    most one block between), and right after such text: what :func:`templates` counts."""
    at = blocks.around()
    short = np.flatnonzero(blocks.solid & (blocks.size <= SHORT))
    core = at["core"]
    core_at = lambda j: (j >= 0) & core[np.maximum(j, 0)]
    inside = (at["before"] < 99) & (at["after"] < 99)
    before = core_at(at["next"]) | core_at(at["next2"])
    after = core_at(at["prev"])
    return [blocks.key(i) for i in short], np.stack([inside, before, after], 1)[short].astype(np.int64)


def features(texts: Sequence[str], known: Mapping[str, Sequence[float]] | None = None) -> tuple[Blocks, np.ndarray]:
    """The blocks of ``texts`` and one row of FEATURES for each. ``known``: what :func:`templates` found."""
    b = Blocks(texts)
    n = len(b.lines)
    at = b.around()
    own = {**b.own, "text": b.text.astype(float), "core": at["core"].astype(float)}
    own["words"] = np.minimum(own["words"], 100)
    stats = np.full((n, len(_STATS)), -1.0)
    if known:
        for i in np.flatnonzero(b.solid & (b.size <= SHORT)).tolist():
            if (s := known.get(b.key(i))) is not None:
                stats[i] = s
    cols = [own[k] for k in _OWN] + [own["text"]]
    for who in ("prev", "prev2", "next", "next2"):
        j = at[who]
        cols += [np.where(j >= 0, own[k][np.maximum(j, 0)], -1) for k in (_FAR if who.endswith("2") else _NEAR)]
    cols += [np.minimum(at["before"], 20), np.minimum(at["after"], 20), ((at["before"] < 99) & (at["after"] < 99)).astype(float), own["core"]]
    cols += [stats[:, k] for k in range(len(_STATS))]
    for who in ("prev", "next"):
        j = at[who]
        cols += [np.where(j >= 0, stats[np.maximum(j, 0), _STATS.index(k)], -2) for k in _NEAR_STATS]
    return b, np.stack(cols, 1).round(3) if n else np.zeros((0, len(FEATURES)))


class Tree:
    """A CART decision tree (Gini) for 0/1 labels."""

    def __init__(self, depth: int = 14, least: int = 12):
        self.depth, self.least, self.nodes = depth, least, np.zeros((0, 5))

    def fit(self, x: np.ndarray, y: np.ndarray) -> Tree:
        nodes: list[list] = []
        self._grow(nodes, x, y.astype(float), 0)
        self.nodes = np.array(nodes)
        return self

    def _grow(self, nodes: list[list], x: np.ndarray, y: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append([-1, 0.0, -1, -1, float(y.mean()) if len(y) else 0.0])
        if depth >= self.depth or len(y) < 2 * self.least or y.min() == y.max():
            return me
        best = (1e-9, -1, 0.0)
        parent = y.mean() * (1 - y.mean()) * len(y)
        for f in range(x.shape[1]):
            order = np.argsort(x[:, f], kind="stable")
            v, s = x[order, f], np.cumsum(y[order])
            k = np.arange(1, len(y))
            ok = (v[1:] > v[:-1]) & (k >= self.least) & (len(y) - k >= self.least)
            if not ok.any():
                continue
            a, b = s[:-1] / k, (s[-1] - s[:-1]) / (len(y) - k)
            gain = np.where(ok, parent - a * (1 - a) * k - b * (1 - b) * (len(y) - k), -1)
            i = int(gain.argmax())
            if gain[i] > best[0]:
                best = (gain[i], f, (v[i] + v[i + 1]) / 2)
        if best[1] < 0:
            return me
        left = x[:, best[1]] <= best[2]
        nodes[me][:2] = best[1:]
        nodes[me][2] = self._grow(nodes, x[left], y[left], depth + 1)
        nodes[me][3] = self._grow(nodes, x[~left], y[~left], depth + 1)
        return me

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The share of content in each row's leaf."""
        at = np.zeros(len(x), np.int64)
        nodes = self.nodes
        feature, cut, left, right = nodes[:, 0].astype(int), nodes[:, 1], nodes[:, 2].astype(int), nodes[:, 3].astype(int)
        go = np.flatnonzero(feature[at] >= 0)
        while len(go):
            k = at[go]
            at[go] = np.where(x[go, feature[k]] <= cut[k], left[k], right[k])
            go = go[feature[at[go]] >= 0]
        return nodes[at, 4]


def trained(path: Path | str = LABELS) -> Tree:
    """The tree of the labelled table at ``path`` (columns FEATURES and ``content``)."""
    with open(path, encoding="utf-8") as f:
        head, *rows = csv.reader(f)
    if head != [*FEATURES, "content"]:
        raise ValueError(f"{path} has other columns")
    data = np.array(rows, float)
    return Tree().fit(data[:, :-1], data[:, -1])


def _chunks(texts: Sequence[str | None]) -> Iterator[tuple[int, list[str]]]:
    """``(place of the first, texts)`` of about CHUNK characters, or one longer text."""
    at = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t or "") > CHUNK:
            yield at, [x or "" for x in texts[at:i]]
            at, size = i, 0
        size += len(t or "")
    if at < len(texts):
        yield at, [x or "" for x in texts[at:]]


def templates(pages: DataFrame, text: str) -> dict[str, tuple[float, ...]]:
    """What sites print again and again: masked short block -> its share of all pages, and of its occurrences
    the shares inside the core, before and after text of the topic.

    Counted over all pages; blocks of at least ``TEMPLATE_PAGES`` occurrences and a ``TEMPLATE_SHARE`` of all
    pages are kept, so no more entries come to the driver than the inverse of that share times the short blocks
    of an average page. Each task sends one row for each different block of its pages.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["block", "n", "inside", "before", "after"]
        for b in batches:
            for _, part in _chunks(b.column(0).to_pylist()):
                keys, x = context(Blocks(part))
                kinds = pa.array(keys, pa.string()).dictionary_encode()
                u, inv = kinds.dictionary.to_pylist(), kinds.indices.to_numpy(zero_copy_only=False)
                cols = [np.bincount(inv, minlength=len(u)), *(np.bincount(inv, x[:, k], len(u)) for k in range(3))]
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.string()), *(pa.array(c.astype(np.int64)) for c in cols)], names=names)

    texts = pages.select(F.col(f"`{text}`").alias("t")).where("t <> ''")
    total = texts.count()
    sums = texts.mapInArrow(run, "block string, n bigint, inside bigint, before bigint, after bigint").groupBy("block").agg(*[F.sum(c).alias(c) for c in ("n", "inside", "before", "after")])
    kept = sums.where((F.col("n") >= TEMPLATE_PAGES) & (F.col("n") >= total * TEMPLATE_SHARE))
    return {r["block"]: tuple(round(float(v), 3) for v in (min(r["n"] / total, 1), r["inside"] / r["n"], r["before"] / r["n"], r["after"] / r["n"])) for r in kept.collect()}


def content_lines(pages: DataFrame, key: str, text: str, tree: Tree | None = None, threshold: float = 0.5, known: Mapping[str, Sequence[float]] | None = None) -> DataFrame:
    """``(key, line_no, line, score)`` of every line of ``pages[text]`` that is main content; lines count from 1.

    ``known`` is the result of :func:`templates`, made from ``pages`` if not given (an empty one is allowed).
    Null and empty texts give no rows; a page without an article gives none; repeated pages are repeated.
    Other columns are dropped. Whole texts are read, however long.
    """
    sent = pages.sparkSession.sparkContext.broadcast((tree or trained(), templates(pages, text) if known is None else dict(known)))
    schema = T.StructType([T.StructField(key, pages.schema[key].dataType), T.StructField("line_no", T.LongType()), T.StructField("line", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, stats = sent.value
        for batch in batches:
            for at, part in _chunks(batch.column(text).to_pylist()):
                b, x = features(part, stats)
                score = model.predict(x)
                hit = np.flatnonzero((score > threshold) & b.solid)
                page = b.page[hit]
                yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(at + page)), pa.array(hit - b.start[page] + 1), pa.array([b.lines[i] for i in hit.tolist()], pa.string()), pa.array(score[hit])], names=schema.names)

    return pages.select(f"`{key}`", f"`{text}`").where(F.col(f"`{text}`") != "").mapInArrow(run, schema)
