"""Language of documents and of each line: script ranges, per-word scores and Viterbi.

Texts are cut into words: runs of Latin letters, of Hangul, or of Han and kana together. Scripts narrow
the candidates (kana is Japanese, Hangul Korean); words get a score for each language still possible,
learned from a bounded sample of labelled documents; Viterbi with a switching penalty then labels the
words of a whole document, with one state more for text without language (lists of names, addresses).
A line takes the language of most of its labelled letters, a document that of most of its text.

All documents of a block advance through Viterbi together, word by word, so the work is in vector
operations; the corpus is read once (and once more for the sample), nothing of it is shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LANGS = ("zh", "ja", "en", "ko", "fr", "de")
NONE = len(LANGS)
#: Documents of each label that the word scores are learned from, at most.
SAMPLE = 400
#: Length up to which documents are sampled.
SAMPLE_CHARS = 20_000
SWITCH = 5.0
CHUNK = 3_000_000
#: Evidence (log odds against the document's main language) and letters that a line needs to differ.
LINE_EVIDENCE, LINE_LETTERS = 3.0, 4

# ISO 639 codes and names that denote one of LANGS.
ALIASES = {
    "zh": "zh zho chi cmn chinese", "ja": "ja jpn jp japanese", "en": "en eng english", "ko": "ko kor kr korean",
    "fr": "fr fra fre french", "de": "de deu ger german",
}
_ALIAS = {a: k for k, v in ALIASES.items() for a in v.split()}
_B = np.uint64(0x9E3779B97F4A7C15)
_KINDS: np.ndarray | None = None
HAN, KANA, HANGUL, LATIN, OTHER, BREAK = 1, 2, 3, 4, 5, 0


def label_of(label: str | None) -> str | None:
    """The language a label denotes (``zh-CN``, ``ZH`` and ``zho`` all denote zh); None for other labels."""
    if not label:
        return None
    return _ALIAS.get(re.split(r"[-_\s]", label.strip().lower(), maxsplit=1)[0])


def _kinds() -> np.ndarray:
    """Code point -> script."""
    global _KINDS
    if _KINDS is None:
        t = np.zeros(0x110000, np.uint8)
        for kind, spans in (
            (HAN, ((0x3400, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF), (0x3005, 0x3007))),
            (KANA, ((0x3041, 0x3096), (0x309D, 0x309F), (0x30A1, 0x30FA), (0x30FC, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F))),
            (HANGUL, ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7A3))),
            (LATIN, ((0x41, 0x5A), (0x61, 0x7A), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x24F), (0x1E00, 0x1EFF), (0xFF21, 0xFF3A), (0xFF41, 0xFF5A))),
            (OTHER, ((0x370, 0x52F), (0x590, 0x6FF), (0x900, 0xDFF), (0xE00, 0xE7F))),
        ):
            for a, b in spans:
                t[a : b + 1] = kind
        _KINDS = t
    return _KINDS


def _csum(m: np.ndarray) -> np.ndarray:
    out = np.zeros(len(m) + 1, np.float32 if m.dtype.kind == "f" else np.int32)
    np.cumsum(m, out=out[1:])
    return out


class Words:
    """The words of a block of texts, in arrays: ``doc``, ``line`` (of all lines), ``kind``, ``start``, ``size``, ``key``, ``han``, ``kana``."""

    def __init__(self, texts: list[str]):
        kinds = _kinds()
        c = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.codes = c
        k = kinds[c]
        group = np.where(k == KANA, HAN, k)
        change = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(c) else np.zeros(0, np.int64)
        size = np.diff(np.concatenate([change, [len(c)]]))
        kind = group[change]
        word = kind != BREAK
        self.start, self.size, self.kind = change[word], size[word], kind[word]
        newline = np.flatnonzero(c == 10)
        self.n_lines = len(newline) + 1
        self.line_start = np.concatenate([[0], newline + 1])
        self.line_end = np.concatenate([newline, [len(c)]])
        self.line = np.searchsorted(newline, self.start)
        lens = np.array([len(t) for t in texts], np.int64)
        self.doc_start = np.concatenate([[0], np.cumsum(lens + 1)])[:-1]
        self.line_doc = np.searchsorted(self.doc_start, self.line_start, side="right") - 1
        self.line_no = np.arange(self.n_lines) - np.searchsorted(self.line_start, self.doc_start)[self.line_doc] + 1
        self.doc = self.line_doc[self.line] if len(self.line) else np.zeros(0, np.int64)
        csum = _csum
        self.csum = csum
        end = self.start + self.size
        kc = csum(k == KANA)
        self.kana = kc[end] - kc[self.start]
        self.han = np.where(self.kind == HAN, self.size - self.kana, 0)
        # hash of each Latin word, lower case
        self.key = np.zeros(len(self.start), np.uint64)
        lat = np.flatnonzero(self.kind == LATIN)
        if len(lat):
            n = self.size[lat]
            at = np.repeat(self.start[lat] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum()))
            x = c[at]
            x = np.where(x >= 0xFF21, x - 0xFEE0, x)  # full width
            upper = (x >= 65) & (x <= 90) | (x >= 0xC0) & (x <= 0xDE)
            x = np.where(upper, x + 32, x).astype(np.uint64)
            off = np.minimum(np.arange(len(at)) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n), 63)
            power = np.concatenate([[np.uint64(1)], np.cumprod(np.full(63, _B))])
            self.key[lat] = np.add.reduceat(x * power[off], np.concatenate([[0], np.cumsum(n)[:-1]]))

    def lines_without_language(self) -> np.ndarray:
        """Lines that are lists of names or addresses.

        Names are short pieces set apart by enumeration commas, no piece empty, without a sentence mark. The comma
        stands in ordinary sentences too, so a line with more digits than pieces or any sign of prose (:data:`_PROSE`)
        is none.
        """
        c = self.codes
        per = lambda m: self.csum(m)[self.line_end] - self.csum(m)[self.line_start]
        comma = per((c == 0x3001) | (c == 0xFF64))
        sentence = per(np.isin(c, _SENTENCE))
        length = self.line_end - self.line_start
        names = (comma > 0) & (sentence == 0) & (length <= 18 * (comma + 1)) & (per(self._digits()) <= comma + 1)
        for i in np.flatnonzero(names):
            line = _INVISIBLE.sub("", c[self.line_start[i] : self.line_end[i]].tobytes().decode("utf-32-le", "surrogatepass"))
            names[i] = all(p.strip() for p in _COMMA.split(line)) and not _PROSE.search(line)
        slashes = per((c == 0x2F) | (c == 0x40))
        blanks = per((c == 0x20) | (c == 0x3000))
        colon = per(c == 0x3A)
        address = (slashes >= 2) & (blanks == 0) & (colon > 0)
        bracket = (length < 24) & np.isin(c[np.minimum(self.line_start, max(0, len(c) - 1))], [0x5B, 0x3E]) & (per(np.isin(c, np.arange(48, 58))) > 0) & (self.letters() < 6) if len(c) else address
        return names | address | bracket

    def _digits(self) -> np.ndarray:
        c = self.codes
        return (c >= 0x30) & (c <= 0x39) | (c >= 0xFF10) & (c <= 0xFF19)

    def letters(self) -> np.ndarray:
        return np.bincount(self.line, self.size, self.n_lines).astype(np.int64) if len(self.line) else np.zeros(self.n_lines, np.int64)


_COMMA = re.compile("[、､]")
_INVISIBLE = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff]")
#: Signs that a line is prose and no list of names: hiragana before ideographs or katakana (particles, verb endings),
#: one hiragana after them at the end of a piece, verb and adjective endings there, を, Chinese function words, and
#: a Latin word that begins small.
_PROSE = re.compile(
    "[ぁ-ゖ][\u3005\u3400-\u9fff\uf900-\ufaffァ-ヺ]|[\u3005\u3400-\u9fff\uf900-\ufaffァ-ヺー][ぁ-ゖ](?=\\s*(?:[、､]|$))|を"
    "|(?:です|ます|でした|ました|ません|だった|った|いた|んだ|ない|たい|しい|いい|だね|だよ|よね|いる|ある|する|れる|って|けど|から|まで|すぎ|して|ので|のに)[ねよなぁー]?(?=\\s*(?:[、､]|$))"
    "|[我你您他她它们們这這那哪是的了很也吗嗎吧呢啊还還没沒让讓被把给給]|喜[欢歡]|(?:^|[\\s、､])[a-zß-öø-ÿ]+(?=[\\s、､]|$)"
)
_SENTENCE = np.array([ord(x) for x in "。！？!?♪…～，.;；"], np.uint32)


class Model:
    """Scores of Latin words for en, fr, de and of Han characters for zh, ja."""

    def __init__(self, keys: np.ndarray, scores: np.ndarray, han: np.ndarray):
        self.keys, self.scores, self.han = keys, scores, han

    @staticmethod
    def fit(texts: list[str], labels: list[str], rounds: int = 2, smooth: float = 0.5) -> Model:
        """Learns from documents with (partly wrong) labels; labels are replaced by the model's own view after each round."""
        w = Words(texts)
        letters = w.letters()
        dom = np.zeros((w.n_lines, 6))
        if len(w.line):
            np.add.at(dom, (w.line, w.kind), w.size)
        kana = np.bincount(w.line, w.kana, w.n_lines) if len(w.line) else np.zeros(w.n_lines)
        lab = np.array([LANGS.index(x) if x in LANGS else -1 for x in labels])
        line_lab = lab[w.line_doc] if len(lab) else np.zeros(0, int)
        latin_line = dom[:, LATIN] > 0.8 * np.maximum(letters, 1)
        use = np.flatnonzero((w.kind == LATIN) & latin_line[w.line]) if len(w.line) else np.zeros(0, int)
        keys, inv = np.unique(w.key[use], return_inverse=True)
        n_use = len(use)
        latin = [LANGS.index(x) for x in ("en", "fr", "de")]
        scores = np.zeros((len(keys), 3))
        now = line_lab[w.line[use]] if n_use else np.zeros(0, int)
        for _ in range(rounds):
            counts = np.zeros((len(keys), 3))
            for j, k in enumerate(latin):
                counts[:, j] = np.bincount(inv[now == k], minlength=len(keys)) if n_use else 0
            total = counts.sum(axis=0) + smooth * max(1, len(keys))
            logp = np.log((counts + smooth) / total)
            scores = logp - logp.mean(axis=1, keepdims=True)
            scores *= (counts.sum(axis=1) >= 2)[:, None]
            if n_use:  # each line takes the label its words speak for
                per = np.zeros((w.n_lines, 3))
                np.add.at(per, w.line[use], scores[inv])
                now = np.array(latin)[per.argmax(axis=1)][w.line[use]]
        # Han characters: lines with kana are Japanese, Han lines of documents labelled zh are Chinese
        ja_line = (kana >= 4) & (kana > 0.15 * letters)
        zh_line = (kana == 0) & (dom[:, HAN] > 0.8 * np.maximum(letters, 1)) & (line_lab == 0)
        codes, kinds = w.codes, _kinds()[w.codes]
        at = np.flatnonzero((kinds == HAN) & (codes < 0x10000))
        ln = np.searchsorted(w.line_start, at, side="right") - 1
        c_ja = np.bincount(codes[at[ja_line[ln]]], minlength=0x10000)[:0x10000] + smooth
        c_zh = np.bincount(codes[at[zh_line[ln]]], minlength=0x10000)[:0x10000] + smooth
        odds = np.log(c_zh / c_zh.sum()) - np.log(c_ja / c_ja.sum())
        han = np.where(c_zh + c_ja >= 5, np.clip(odds, -2, 2), 0.0)
        return Model(keys, np.clip(scores, -4, 4), han.astype(np.float32))

    def emissions(self, w: Words) -> np.ndarray:
        """Score of every word in every state (LANGS and NONE)."""
        n = len(w.start)
        e = np.zeros((n, NONE + 1), np.float32)
        lat = w.kind == LATIN
        han = w.kind == HAN
        hang = w.kind == HANGUL
        zh, ja, en, ko, fr, de = range(6)
        # Latin words: names stand in any text, so words unknown to the scores only lean to Latin languages
        e[lat, zh] = e[lat, ja] = e[lat, ko] = -0.6
        if lat.any() and len(self.keys):
            k = np.searchsorted(self.keys, w.key[lat])
            k[k == len(self.keys)] = 0
            s = self.scores[k] * ((self.keys[k] == w.key[lat]) & (w.size[lat] > 1))[:, None]  # single letters also number choices
            known = np.abs(s).max(axis=1) > 0.7
            e[lat] += np.where(known, -1.0, 0.0)[:, None].astype(np.float32)
            idx = np.flatnonzero(lat)
            for j, lang in enumerate((en, fr, de)):
                e[idx, lang] += (s[:, j] + np.where(known, 1.0, 0.0)).astype(np.float32)
        elif lat.any():
            e[lat, en] += 0.2
        kana = np.minimum(w.kana[han], 12)
        ideo = np.minimum(w.han[han], 12)
        safe = np.where(w.codes < 0x10000, w.codes, 0)
        score = self.han[safe].astype(np.float64)
        at = np.empty(2 * int(han.sum()), np.int64)
        at[::2], at[1::2] = w.start[han], w.start[han] + w.size[han]
        o = np.add.reduceat(np.append(score, 0.0), at)[::2] if len(at) else np.zeros(0)
        pure = kana == 0
        e[han, ja] = np.where(pure, 0.2 * ideo - 0.5 * np.clip(o, -8, 8), 1.2 * kana + 0.3 * ideo)
        e[han, zh] = np.where(pure, 0.45 * ideo + 0.5 * np.clip(o, -8, 8), -1.5 * kana + 0.2 * ideo)
        for other in (en, fr, de, ko):
            e[han, other] = -0.7 * np.minimum(w.size[han], 12)
        size = np.minimum(w.size[hang], 8)
        e[hang, ko] = 1.5 * size
        for other in (zh, ja, en, fr, de):
            e[hang, other] = -1.5 * size
        e[:, NONE] = np.where(han, -0.25 * np.minimum(w.size, 12), np.where(hang, -1.5 * np.minimum(w.size, 8), -0.5))
        off = w.lines_without_language()[w.line] if n else np.zeros(0, bool)
        e[off] = 0
        e[off, NONE] = 8
        return e


def viterbi(e: np.ndarray, doc: np.ndarray, n_docs: int, penalty: float) -> np.ndarray:
    """Best state of every word; ``e`` are the scores, ``doc`` ascending. All documents advance together."""
    n, s = e.shape
    first = np.searchsorted(doc, np.arange(n_docs))
    count = np.diff(np.concatenate([first, [n]]))
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    back = np.zeros((n, s), np.int8)
    score = np.zeros((n_docs, s), np.float32)
    stay = np.arange(s, dtype=np.int8)
    steps = int(count[0]) if n_docs else 0
    active = np.searchsorted(-count, -np.arange(steps), side="left").tolist()
    lane = np.arange(n_docs)
    for t, m in enumerate(active):
        at = first[:m] + t
        if t == 0:
            score[:m] = e[at]
            back[at] = stay
            continue
        old = score[:m]
        top = old.argmax(axis=1)
        jump = (old[lane[:m], top] - penalty)[:, None]
        keep = old >= jump
        back[at] = np.where(keep, stay, top[:, None])
        np.maximum(old, jump, out=old)
        old += e[at]
    state = np.zeros(n, np.int8)
    cur = score.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        m = active[t]
        at = first[:m] + t
        now = cur[:m]
        state[at] = now
        cur[:m] = back[at, now]
    return state


def label_block(texts: list[str], model: Model, penalty: float = SWITCH) -> tuple[np.ndarray, ...]:
    """Arrays ``(text, seg_no, language, confidence, letters)``: 0 for the document, then each line that has a language.

    A text without a letter in any language gives nothing.
    """
    w = Words(texts)
    n = len(texts)
    if not len(w.start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "U2"), np.zeros(0), np.zeros(0, np.int64)
    e = model.emissions(w)
    state = viterbi(e, w.doc, n, penalty)
    size = w.size.astype(np.float64)
    wide = NONE + 1
    by = np.bincount(w.line * wide + state, size, w.n_lines * wide).reshape(-1, wide)
    ev = np.stack([np.bincount(w.line, e[:, j], w.n_lines) for j in range(wide)], axis=1)
    lang = by[:, :NONE].argmax(axis=1)
    has = by[:, :NONE].max(axis=1) > by[:, NONE]
    # the weight of a line in its document is its letters in the language
    doc_by = np.zeros((n, NONE))
    np.add.at(doc_by, (w.line_doc[has], lang[has]), by[has, lang[has]])
    main = doc_by.argmax(axis=1)
    total = doc_by.sum(axis=1)
    doc_ev = np.zeros((n, NONE))
    np.add.at(doc_ev, w.line_doc[has], ev[has][:, :NONE])
    rows = np.arange(w.n_lines)
    others = ev[:, :NONE].copy()
    others[rows, lang] = -1e9
    margin = ev[rows, lang] - others.max(axis=1)
    against = ev[rows, lang] - ev[rows, main[w.line_doc]]
    keep = has & ((lang == main[w.line_doc]) | (against >= LINE_EVIDENCE) & (by[rows, lang] >= LINE_LETTERS))
    n_words = np.bincount(w.line, minlength=w.n_lines)
    sure = _sure(margin, n_words)
    rest = doc_ev.copy()
    rest[np.arange(n), main] = -1e9
    doc_sure = doc_by[np.arange(n), main] / np.maximum(total, 1) * _sure(doc_ev[np.arange(n), main] - rest.max(axis=1), np.bincount(w.doc, minlength=n))
    names = np.array(LANGS)
    d, i = np.flatnonzero(total > 0), np.flatnonzero(keep)
    return (
        np.concatenate([d, w.line_doc[i]]), np.concatenate([np.zeros(len(d), np.int64), w.line_no[i]]), np.concatenate([names[main[d]], names[lang[i]]]),
        np.concatenate([doc_sure[d], sure[i]]), np.concatenate([total[d], by[i, lang[i]]]).astype(np.int64),
    )


def _sure(margin: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Log odds to a confidence; words of a text are not independent, so their evidence adds up more slowly."""
    return 1 / (1 + np.exp(-np.clip(margin / (1 + np.sqrt(np.maximum(words, 1))), -30, 30)))


def trained(docs: DataFrame, key: str, text: str, label: str, sample: int = SAMPLE, longest: int = SAMPLE_CHARS) -> Model:
    """A model of at most ``sample`` documents of each language, taken by a hash of their key, whole texts.

    Labels are counted first (the texts are not read for that); then a share of each language's documents
    that gives about the wanted number is taken by hash, so nothing is sorted or shuffled and what comes
    to the driver is bounded by ``sample`` and ``longest``, the length up to which texts are sampled.
    """
    l = F.lower(F.split(F.trim(f"`{label}`"), "[-_ ]")[0])
    lang = F.coalesce(*[F.when(l.isin(names.split()), k) for k, names in ALIASES.items() if k != "ko"])  # its script tells Korean
    d = docs.select(F.xxhash64(f"`{key}`").alias("h"), F.col(f"`{text}`").alias("t"), lang.alias("l"))
    counts = {r["l"]: r["n"] for r in d.where("l is not null").groupBy("l").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Model.fit([], [])
    cell = F.pmod(F.col("h"), F.lit(1 << 30))
    wanted = [F.when((F.col("l") == k) & (cell < int(min(1.0, (1.3 * sample + 30) / n) * (1 << 30))), 1) for k, n in counts.items()]
    rows = d.where((F.length("t") <= longest) & (F.col("t") != "") & F.coalesce(*wanted).isNotNull()).collect()
    taken: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: r["h"]):
        taken.setdefault(r["l"], []).append(r["t"])
    return Model.fit([t for v in taken.values() for t in v[:sample]], [k for k, v in taken.items() for _ in v[:sample]])


def _labelled(batches: list[pa.RecordBatch], text: str, model: Model) -> Iterator[tuple[np.ndarray, ...]]:
    """:func:`label_block` over batches in blocks of CHUNK characters; the first array counts rows of the batch."""
    for b in batches:
        col = b.column(text)
        ends = np.cumsum(pa.compute.utf8_length(col).fill_null(0).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(ends):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, side="right")))
            d, *rest = label_block([t or "" for t in col.slice(at, to - at).to_pylist()], model)
            yield (at + d, *rest)
            at = to


def languages(docs: DataFrame, key: str, text: str, model: Model) -> DataFrame:
    """``(key, seg_no, lang, confidence, letters)``: row 0 for the document, then its lines from 1.

    Lines without a language (names, numbers, signs, addresses), null, empty and letterless texts give no
    rows; repeated documents repeat. Other columns are dropped.
    """
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("seg_no", T.LongType()), T.StructField("lang", T.StringType()), T.StructField("confidence", T.DoubleType()), T.StructField("letters", T.LongType())])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, *rest in _labelled([b], text, sent.value):
                yield pa.RecordBatch.from_arrays([b.column(key).take(pa.array(d)), *map(pa.array, rest)], names=schema.names)

    return docs.select(f"`{key}`", f"`{text}`").mapInArrow(run, schema)


def corrections(docs: DataFrame, key: str, text: str, label: str, model: Model) -> DataFrame:
    """``(key, seg_no, lang, confidence, letters)``: documents whose label is missing or denotes another
    language (row 0), and lines in another language than their document's main one.

    The label travels through the one pass over the texts, so nothing is joined; a label that is none of
    a language's names counts as missing.
    """
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("seg_no", T.LongType()), T.StructField("lang", T.StringType()), T.StructField("confidence", T.DoubleType()), T.StructField("letters", T.LongType())])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            said = np.array([label_of(x) or "" for x in b.column(label).to_pylist()])
            for part in _labelled([b], text, sent.value):
                d, seg, lang, sure, n = part
                main = np.full(len(said), "", dtype="U2")
                main[d[seg == 0]] = lang[seg == 0]
                keep = np.where(seg == 0, said[d] != lang, main[d] != lang)
                yield pa.RecordBatch.from_arrays([b.column(key).take(pa.array(d[keep])), *(pa.array(x[keep]) for x in (seg, lang, sure, n))], names=schema.names)

    return docs.select(f"`{key}`", f"`{text}`", f"`{label}`").mapInArrow(run, schema)
