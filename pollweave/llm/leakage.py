"""Evaluation texts in a training corpus: greedy string tiling over shared-token seeds.

Texts are reduced to their letters and digits (width, case, blanks, punctuation and line ends do not
count). Tokens are runs of ``Q`` letters, hashed with a rolling Karp-Rabin hash over whole blocks of
documents at once. A document can hold a wanted passage only where enough tokens of the items stand
close together, so windows with fewer are passed over; this follows from the q-gram lemma and loses no
passage within the bounds. The seeds left are joined to the items' tokens, grown to maximal matches and
tiled greedily, longest first and without overlap. The tiles give the share of the item that is covered
(in any order) and, chained, the longest passage in sequence within the allowed share of changes.

Items of at most ``ITEM_BLOCK`` letters in all are sent to the tasks; the corpus is then read once and nothing of
it is shuffled. More items stay distributed: a bitmap of their tokens of fixed size is sent instead, only the
tokens of documents that stand dense in it are shuffled and joined to the items' tokens, and the texts of the
pairs that share enough of them meet for tiling.
"""

from __future__ import annotations

import heapq
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pollweave.session import broadcast_if_small, written

Q = 5
MIN_PASSAGE = 40
MAX_CHANGED = 0.1
#: Share of an item under tiles, in whatever order, from which a pair counts as covered.
COVERED = 0.5
#: Characters of items that are sent to the tasks at most; more items are joined by shuffle.
ITEM_BLOCK = 4_000_000
#: Letters in a row that a passage within MAX_CHANGED keeps unchanged at least (0.9 n letters in n / 10 + 1 runs).
SEED = 8
#: Bits of the hash that number the places of a bitmap of tokens sent to the tasks.
MAP_BITS = 26
#: Characters of documents handled at once in a task.
CHUNK = 1_000_000
_BITS = 22
_B = np.uint64(0x9E3779B97F4A7C15)
_COMBINING = re.compile("[\\u0300-\\u036f\\u3099\\u309a\\uff9e\\uff9f\\u1100-\\u11ff]")
_LUT: np.ndarray | None = None


def _lut() -> np.ndarray:
    """Code point -> folded code point, 0 for what is no letter or digit, 1 for what folds to several."""
    global _LUT
    if _LUT is None:
        t = np.zeros(0x110000, np.uint32)
        for a, b in ((0, 0xD800), (0xE000, 0x10000)):
            for i in range(a, b):
                s = chr(i)
                if 0x3400 <= i < 0x9FFF or 0xAC00 <= i < 0xD7A4:
                    t[i] = i
                    continue
                f = [c for c in unicodedata.normalize("NFKC", s).casefold() if c.isalnum()]
                t[i] = 0 if not f else ord(f[0]) if len(f) == 1 else 1
        for a, b in ((0x20000, 0x32000),):
            t[a:b] = np.arange(a, b, dtype=np.uint32)
        _LUT = t
    return _LUT


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The folded letters and digits of all texts in one array, and each text's start in it (one more at the end)."""
    lut = _lut()
    clean = [unicodedata.normalize("NFKC", t) if _COMBINING.search(t) else t for t in texts]
    codes = np.frombuffer("".join(clean).encode("utf-32-le", "surrogatepass"), np.uint32)
    x = lut[codes]
    n = np.array([len(t) for t in clean], np.int64)
    many = np.flatnonzero(x == 1)
    if len(many):  # ligatures, sharp s, fractions and the like are written out
        full = [[ord(c) for c in unicodedata.normalize("NFKC", chr(i)).casefold() if c.isalnum()] for i in codes[many].tolist()]
        extra = np.array([len(f) - 1 for f in full])
        n += np.bincount(np.searchsorted(np.cumsum(n), many, side="right"), extra, len(n)).astype(np.int64)
        x = np.insert(x, np.repeat(many, extra), 1)
        x[x == 1] = [c for f in full for c in f]
    keep = x > 0
    at = np.concatenate([[0], np.cumsum(keep)])
    return x[keep], at[np.concatenate([[0], np.cumsum(n)])].astype(np.int64)


def grams(x: np.ndarray, q: int = Q) -> np.ndarray:
    """Rolling hash of every run of ``q`` code points (``len(x) - q + 1`` of them)."""
    if len(x) < q:
        return np.zeros(0, np.uint64)
    h = x[: len(x) - q + 1].astype(np.uint64)
    for k in range(1, q):
        h *= _B
        h += x[k : len(x) - q + 1 + k]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h


class Index:
    """The tokens of a block of items."""

    def __init__(self, ids: list, texts: list[str], q: int = Q):
        self.ids, self.q = ids, q
        self.x, self.start = letters(texts)
        h = grams(self.x, q)
        item = np.searchsorted(self.start, np.arange(len(h)), side="right") - 1
        inside = np.arange(len(h)) + q <= self.start[item + 1] if len(h) else np.zeros(0, bool)
        pos = np.flatnonzero(inside)
        order = np.argsort(h[pos], kind="stable")
        self.pos = pos[order].astype(np.int64)
        self.key, first, self.n = np.unique(h[pos][order], return_index=True, return_counts=True)
        self.first = first
        self.item = item
        self.bloom = np.zeros(1 << _BITS, bool)
        self.bloom[self.key >> np.uint64(64 - _BITS)] = True


def _edit(a: np.ndarray, b: np.ndarray) -> int:
    """Levenshtein distance of two short runs."""
    if not len(a) or not len(b):
        return max(len(a), len(b))
    if len(a) == len(b) == 1:
        return int(a[0] != b[0])
    row = list(range(len(b) + 1))
    bl = b.tolist()
    for i, c in enumerate(a.tolist(), 1):
        last, row[0] = row[0], i
        for j, d in enumerate(bl, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return row[-1]


def _reach(a: np.ndarray, b: np.ndarray, most: int) -> list[tuple[int, int]]:
    """``(k, e)``: the first ``k`` letters of ``a`` stand at the start of ``b`` with ``e`` changes at best, ``most`` at most.

    Only ends that a passage may have: the last letter is unchanged, and there are three unchanged ones for
    each change. Without that a shorter passage would grow over chance matches in the text beside it.
    """
    out, least = [(0, 0)], 0
    far = most + 1
    bl = b.tolist()
    row = [min(j, far) for j in range(len(bl) + 1)]
    for i, c in enumerate(a.tolist(), 1):
        lo, hi = max(1, i - most), min(len(bl), i + most)  # farther from the diagonal there are more changes
        new = [far] * len(row)
        if i <= most:
            new[0] = i
        for j in range(lo, hi + 1):
            new[j] = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != bl[j - 1]))
        row = new
        now = min(row)
        if now > most:
            break
        if now == least and i >= 4 * now:
            out.append((i, now))
        least = now
    return out


def tiles(dpos: np.ndarray, ipos: np.ndarray, q: int = Q) -> list[tuple[int, int, int]]:
    """Greedy string tiling of equal-token positions: ``(doc, item, length)``, longest first, no overlaps."""
    order = np.lexsort((dpos, ipos - dpos))
    d, i = dpos[order], ipos[order]
    cut = np.flatnonzero((np.diff(d) != 1) | (np.diff(i) != 1)) + 1
    begin = np.concatenate([[0], cut])
    length = np.diff(np.concatenate([begin, [len(d)]])) + q - 1
    todo = sorted(zip(length.tolist(), d[begin].tolist(), i[begin].tolist(), strict=True), key=lambda t: (-t[0], t[1], t[2]))
    lo_d, lo_i = int(d.min()), int(i.min())
    used_d, used_i = np.zeros(int(d.max()) - lo_d + q + 1, bool), np.zeros(int(i.max()) - lo_i + q + 1, bool)
    out = []
    heap = [(-n, a, b) for n, a, b in todo]
    heapq.heapify(heap)
    while heap:
        n, a, b = heapq.heappop(heap)
        n = -n
        free = ~(used_d[a - lo_d : a - lo_d + n] | used_i[b - lo_i : b - lo_i + n])
        if free.all():
            used_d[a - lo_d : a - lo_d + n] = True
            used_i[b - lo_i : b - lo_i + n] = True
            out.append((a, b, n))
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[0], free.astype(np.int8), [0]])))
        for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if e - s >= q:
                heapq.heappush(heap, (-(e - s), a + s, b + s))
    return out


def passage(dx: np.ndarray, ix: np.ndarray, found: list[tuple[int, int, int]], least: int = MIN_PASSAGE, share: float = MAX_CHANGED, q: int = Q) -> int:
    """The longest run of item letters that stands in the document in sequence with at most ``share`` changed.

    ``found`` are tiles within ``dx`` and ``ix``. Tiles are chained in the order of both texts and the
    letters between them compared exactly; ends are grown letter by letter where that decides. A passage of
    three times ``least`` contains a shorter one of at least ``least`` within the share, so ends are grown to
    that length and until the changes it may have are used up.
    """
    far = int(3 / share)
    reach = 3 * least
    most = int(share * reach + 1e-9)
    ts = sorted(found, key=lambda t: (t[1], t[0]))
    score: list[float] = []
    before: list[int] = []
    for j, (a, b, n) in enumerate(ts):
        top, link = -1e9, -1
        for k in range(j - 1, -1, -1):
            ka, kb, kn = ts[k]
            gi, gd = b - kb - kn, a - ka - kn
            if gi > far:
                if ts[k][1] + 4 * far < b:
                    break
                continue
            if gi >= 0 and 0 <= gd <= far:
                s = score[k] - max(abs(gi - gd), 1, (max(gi, gd) - q) // q) * (1 / share - 1)
                if s > top:
                    top, link = s, k
        score.append(n + max(top, 0.0) if link >= 0 else float(n))
        before.append(link)
    best = 0
    for end in set(range(len(ts))) - set(before):
        path = [end]
        while before[path[-1]] >= 0:
            path.append(before[path[-1]])
        path.reverse()
        gaps = [0]
        for k, j in zip(path, path[1:], strict=False):
            (ka, kb, kn), (a, b, _) = ts[k], ts[j]
            gaps.append(_edit(ix[kb + kn : b], dx[ka + kn : a]))
        err = np.cumsum(gaps)
        lo = np.array([ts[j][1] for j in path])
        hi = np.array([ts[j][1] + ts[j][2] for j in path])
        n, c = hi[None, :] - lo[:, None], err[None, :] - err[:, None]
        upper = np.triu(np.ones(n.shape, bool))
        ok = upper & (c <= share * n + 1e-9)
        if ok.any():
            best = max(best, int(n[ok].max()))
        if best >= least:
            continue
        grown: dict[tuple[int, int], list] = {}
        for s, e in np.argwhere(upper & (n < reach) & (c <= most)).tolist():
            a0, b0, _ = ts[path[s]]
            a1, b1, n1 = ts[path[e]]
            if (s, 0) not in grown:
                grown[s, 0] = _reach(ix[max(0, b0 - reach) : b0][::-1], dx[max(0, a0 - reach - most) : a0][::-1], most)
            if (e, 1) not in grown:
                grown[e, 1] = _reach(ix[b1 + n1 : b1 + n1 + reach], dx[a1 + n1 : a1 + n1 + reach + most], most)
            for kl, el in grown[s, 0]:
                for kr, er in grown[e, 1]:
                    m = int(n[s, e]) + kl + kr
                    if m > best and c[s, e] + el + er <= share * m + 1e-9:
                        best = m
    return best


def aligned(x: np.ndarray, y: np.ndarray, doc_at: np.ndarray, item_at: np.ndarray, length: np.ndarray, band: int, group: int = 4096) -> np.ndarray:
    """Best local score (+1 a letter, -3 a change) of item runs ``y[item_at:][:length]`` along a diagonal
    band of ``x`` that begins at ``doc_at``; all runs advance together, letter by letter."""
    best = np.zeros(len(length), np.int16)
    pad = band + int(length.max(initial=0)) + 1
    x = np.concatenate([np.zeros(pad, np.uint32), x, np.zeros(pad, np.uint32)])
    width = np.arange(-band, band + 1)
    order = np.argsort(-length, kind="stable")
    for g in range(0, len(order), group):
        who = order[g : g + group]
        n, da, ia = length[who], doc_at[who] + pad, item_at[who]
        s = np.zeros((len(who), len(width)), np.int16)
        top = np.zeros(len(who), np.int16)
        for r in range(int(n[0])):
            m = int(np.searchsorted(-n, -r, side="left"))
            at = np.clip(da[:m, None] + r + width, 0, len(x) - 1)
            old = s[:m]
            new = old + np.where(x[at] == y[ia[:m] + r][:, None], np.int16(1), np.int16(-3))
            new[:, :-1] = np.maximum(new[:, :-1], old[:, 1:] - 3)
            np.maximum(new, 0, out=new)
            new[:, 1:] = np.maximum(new[:, 1:], new[:, :-1] - 3)
            s[:m] = new
            top[:m] = np.maximum(top[:m], new.max(axis=1))
        best[who] = top
    return best


class Finder:
    """Finds the items of an index in documents."""

    def __init__(self, index: Index | None, least: int = MIN_PASSAGE, share: float = MAX_CHANGED, cover: float | None = COVERED, q: int = Q):
        self.ix, self.least, self.share, self.cover = index, least, share, cover
        q = index.q if index else q
        self.errors = int(least * share)
        #: tokens that a passage of ``least`` letters keeps under scattered changes, less a margin for clustered ones
        self.need = max(2, least - q + 1 - q * self.errors - 4)
        self.window = least + self.errors
        #: a passage of n letters with at most share * n changes scores n - 4 share n at least
        self.score = int(least * (1 - 4 * share))

    def dense(self, h: np.ndarray, bits: np.ndarray, shift: int) -> np.ndarray:
        """Places of the tokens ``h`` that ``bits`` may hold and that stand close together."""
        hit = bits[h >> np.uint64(shift)]
        cs = np.empty(len(h) + self.window + 1, np.int64)
        cs[0] = 0
        np.cumsum(hit, out=cs[1 : len(h) + 1])
        cs[len(h) + 1 :] = cs[len(h)]
        dense = cs[self.window :] - cs[: -self.window] >= self.need
        if not dense.any():
            return np.zeros(0, np.int64)
        # a seed counts if a dense window begins within a window's length before it
        dc = np.concatenate([[0], np.cumsum(dense)])
        at = np.flatnonzero(hit)
        return at[dc[np.minimum(at + 1, len(dc) - 1)] > dc[np.maximum(at - self.window + 1, 0)]]

    def seeds(self, x: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(position, text, token)`` of the item tokens that stand close together."""
        ix = self.ix
        none = (np.zeros(0, np.int64),) * 3
        h = grams(x, ix.q)
        if not len(h) or not len(ix.key):
            return none
        at = self.dense(h, ix.bloom, 64 - _BITS)
        if not len(at):
            return none
        doc = np.searchsorted(start, at, side="right") - 1
        inside = at + ix.q <= start[doc + 1]
        at, doc = at[inside], doc[inside]
        k = np.searchsorted(ix.key, h[at])
        k[k == len(ix.key)] = 0
        ok = ix.key[k] == h[at]
        return at[ok], doc[ok], k[ok]

    def candidates(self, x: np.ndarray, start: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """``(text, item, text positions, item positions)`` of the pairs with a well-scoring alignment, and of those
        that share the wanted part of the item's tokens in whatever order."""
        ix = self.ix
        at, doc, k = self.seeds(x, start)
        n = ix.n[k] if len(k) else np.zeros(0, np.int64)
        edge = np.concatenate([[0], np.flatnonzero(np.diff(doc)) + 1, [len(doc)]]) if len(doc) else np.zeros(1, np.int64)
        size = np.concatenate([[0], np.cumsum(n)])
        e = 0
        while e < len(edge) - 1:  # whole documents, as many as have a million postings
            f = max(e + 1, int(np.searchsorted(size[edge], size[edge[e]] + 1_000_000, side="right")) - 1)
            sl = slice(edge[e], edge[f])
            e = f
            m = n[sl]
            dp = np.repeat(at[sl], m)
            ip = ix.pos[np.repeat(ix.first[k[sl]] - np.concatenate([[0], np.cumsum(m)[:-1]]), m) + np.arange(int(m.sum()))]
            it, dc = ix.item[ip], np.repeat(doc[sl], m)
            pair = dc.astype(np.int64) * len(ix.ids) + it
            rel = ip - ix.start[it]
            diag = rel - (dp - start[dc])
            low = int(diag.min())
            width = 2 * self.errors
            bits = (int(rel.max()) + self.window + 1).bit_length()  # keys of different runs lie farther apart than a window
            mask = (1 << bits) - 1
            good = self._covered(pair, rel, bits) if self.cover is not None else set()
            for shift in (0, self.errors):  # overlapping bands of diagonals
                band = (diag - low + shift) // width
                bands = int(band.max()) + 1
                runs, which = None, pair * bands + band
                if (int(pair.max()) + 1) * bands >= 1 << (63 - bits):  # numbered anew, as the pair and band leave no room
                    seen, dense = np.unique(pair, return_inverse=True)
                    runs, which = np.unique(dense * bands + band, return_inverse=True)
                v = np.sort((which << bits) | rel)
                v = v[np.concatenate([[True], v[1:] != v[:-1]])]
                if len(v) < self.need:
                    continue
                w = v[: len(v) - self.need + 1]
                w = w[v[self.need - 1 :] - w <= self.window]
                if not len(w):
                    continue
                # neighbouring windows of one pair and band are one run
                cut = np.flatnonzero(np.diff(w) > self.window) + 1
                lo, hi = w[np.concatenate([[0], cut])], w[np.concatenate([cut - 1, [len(w) - 1]])]
                key, r0, r1 = lo >> bits, lo & mask, hi & mask
                if runs is not None:
                    key = runs[key]
                pr = key // bands if runs is None else seen[key // bands]
                i, d = pr % len(ix.ids), pr // len(ix.ids)
                centre = (key % bands) * width - shift + low + width // 2
                r0 = np.maximum(r0 - self.window, 0)
                r1 = np.minimum(r1 + 2 * self.window, ix.start[i + 1] - ix.start[i])
                got = aligned(x, ix.x, start[d] + r0 - centre, ix.start[i] + r0, r1 - r0, 2 * self.errors + 1)
                good.update(pr[got >= self.score].tolist())
            if not good:
                continue
            order = np.argsort(pair, kind="stable")
            sp = pair[order]
            for g in sorted(good):
                a, b = np.searchsorted(sp, g, side="left"), np.searchsorted(sp, g, side="right")
                o = order[a:b]
                d, i = divmod(g, len(ix.ids))
                yield d, i, dp[o] - start[d], rel[o]

    def _covered(self, pair: np.ndarray, rel: np.ndarray, bits: int) -> set[int]:
        """Pairs in which at least the wanted share of the item's tokens has a seed."""
        u, which = np.unique(pair, return_inverse=True)
        both = np.unique((which << bits) | rel) if bits < 40 else np.unique(np.stack([which, rel], 1), axis=0)[:, 0] << bits
        n = np.bincount(both >> bits, minlength=len(u))
        item = u % len(self.ix.ids)
        tokens = self.ix.start[item + 1] - self.ix.start[item] - self.ix.q + 1
        return set(u[(n >= self.cover * tokens) & (n >= self.need)].tolist())

    def find(self, texts: list[str]) -> Iterator[tuple[int, int, int, int, int]]:
        """``(text, item, tiles, covered letters, longest passage)`` of every candidate pair."""
        ix = self.ix
        x, start = letters(texts)
        for d, i, dp, ip in self.candidates(x, start):
            t = tiles(dp, ip, ix.q)
            yield d, i, len(t), sum(n for _, _, n in t), passage(x[start[d] : start[d + 1]], ix.x[ix.start[i] : ix.start[i + 1]], t, self.least, self.share, ix.q)


def _rows(key: pa.Array, found: list[tuple], id_type: pa.DataType, names: list[str]) -> pa.RecordBatch:
    """A batch of ``(place of the document, item, ...)`` with the documents' keys in the first column."""
    cols = [key.take(pa.array([r[0] for r in found], pa.int64())), pa.array([r[1] for r in found], id_type)]
    return pa.RecordBatch.from_arrays([*cols, *(pa.array([r[j] for r in found], pa.int64()) for j in range(2, len(names)))], names=names)


def _parts(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """``(place of the first, texts)`` of about CHUNK characters, or one longer text."""
    lens = pa.compute.utf8_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lens)
    at = 0
    while at < len(lens):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, side="right")))
        yield at, [t or "" for t in texts.slice(at, to - at).to_pylist()]
        at = to


def _sent(docs: DataFrame, items: DataFrame, schema: T.StructType, id_type: pa.DataType, finder_args: tuple) -> DataFrame:
    """All items in each task: one narrow pass over the documents."""
    doc_key, doc_text = docs.columns
    got = items.orderBy("k").collect()
    sent = docs.sparkSession.sparkContext.broadcast(Index([r["k"] for r in got], [r["t"] for r in got]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(sent.value, *finder_args)
        ix = finder.ix
        for b in batches:
            rows: list[tuple] = []
            for at, part in _parts(b.column(doc_text)):
                rows += [(at + d, ix.ids[i], n, c, int(ix.start[i + 1] - ix.start[i]), p) for d, i, n, c, p in finder.find(part)]
            yield _rows(b.column(doc_key), rows, id_type, schema.names)

    return docs.mapInArrow(run, schema)


def _joined(docs: DataFrame, items: DataFrame, schema: T.StructType, id_type: pa.DataType, finder_args: tuple) -> DataFrame:
    """Items by shuffle. Runs of SEED letters are joined where a document has enough tokens of items close together,
    and the texts of the pairs that share one are tiled. A passage of n letters with n / 10 changed has SEED letters
    in a row unchanged, so no passage is lost; a pair that is covered by shorter runs alone is."""
    spark = docs.sparkSession
    doc_key, doc_text = docs.columns
    finder = Finder(None, *finder_args)
    shift, words = 64 - MAP_BITS, (1 << MAP_BITS) // 64

    def runs(batches: Iterator[pa.RecordBatch], bits: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        """``(n, h)``: key hash and the different seeds of each text; with ``bits`` only those in dense stretches."""
        for b in batches:
            for lo, part in _parts(b.column("t")):
                x, start = letters(part)
                h = grams(x, SEED)
                ok = np.ones(len(h), bool)
                if bits is not None and len(h):
                    near = np.zeros(len(h) + SEED, bool)
                    near[finder.dense(grams(x), bits, shift)] = True
                    for k in range(SEED - Q + 1):  # all tokens of the run are the items'
                        ok &= near[k : k + len(h)]
                at = np.flatnonzero(ok)
                doc = np.searchsorted(start, at, side="right") - 1
                inside = at + SEED <= start[doc + 1]
                n = b.column("n").slice(lo, len(part)).to_numpy()[doc[inside]]
                u = np.unique(np.stack([n, h[at[inside]].view(np.int64)]), axis=1)
                for k in range(0, u.shape[1], 500_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c[k : k + 500_000]) for c in u], names=["n", "h"])

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, part in _parts(b.column("t")):
                p = np.unique(grams(letters(part)[0]) >> np.uint64(shift)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(p // 64), pa.array(p % 64)], names=["w", "k"])

    own = items.select(F.xxhash64("k", "t").alias("n"), "t")
    filled = own.mapInArrow(places, "w bigint, k bigint").groupBy("w").agg(F.expr("bit_or(shiftleft(1L, cast(k as int)))").alias("b")).toArrow()
    table = np.zeros(words, np.int64)
    table[filled.column("w").to_numpy()] = filled.column("b").to_numpy()
    sent = spark.sparkContext.broadcast(table)

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from runs(batches, np.unpackbits(sent.value.view(np.uint8), bitorder="little").astype(bool))

    them = docs.select(F.xxhash64(doc_key, doc_text).alias("n"), F.col(f"`{doc_text}`").alias("t")).where("t is not null")
    seen = them.mapInArrow(dense, "n bigint, h bigint").withColumnRenamed("n", "d")
    pairs = written(seen.join(own.mapInArrow(runs, "n bigint, h bigint").distinct().withColumnRenamed("n", "i"), "h").select("d", "i").distinct())
    side = docs.select(F.xxhash64(doc_key, doc_text).alias("d"), F.col(f"`{doc_key}`").alias("dk"), F.col(f"`{doc_text}`").alias("dt"))
    both = side.join(broadcast_if_small(pairs), "d").join(items.select(F.xxhash64("k", "t").alias("i"), F.col("k").alias("ik"), F.col("t").alias("it")), "i")

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, index = None, None
        for b in batches:
            rows = []
            for j, (t, k, it) in enumerate(zip(b.column("dt").to_pylist(), b.column("ik").to_pylist(), b.column("it").to_pylist(), strict=True)):
                if it != last:
                    last, index = it, Index([k], [it])
                rows += [(j, k, n, c, int(index.start[1]), p) for _, _, n, c, p in Finder(index, *finder_args).find([t])]
            yield _rows(b.column("dk"), rows, id_type, schema.names)

    return both.select("dk", "dt", "ik", "it").mapInArrow(tile, schema)


def leaks(docs: DataFrame, doc_key: str, doc_text: str, items: DataFrame, item_key: str, item_text: str, least: int = MIN_PASSAGE, share: float = MAX_CHANGED, cover: float | None = COVERED) -> DataFrame:
    """``(doc_key, item_key, n_tiles, covered, item_letters, passage)`` for pairs that share enough close tokens.

    ``covered`` counts item letters under tiles in any order (it finds reordered passages); ``passage`` is
    the longest run in sequence with at most ``share`` of its letters changed or missing. Pairs whose
    passage has ``least`` letters are all among the rows, as are (unless ``cover`` is None) those that share ``cover`` of
    the item's tokens where they stand close together in the document; others may be.

    Null and empty texts and texts shorter than a token match nothing; items with a null key are left out; repeated
    documents or items give repeated pairs. The two key columns must differ in name; other columns are dropped.
    """
    if doc_key == item_key:
        raise ValueError("rename one of the key columns")
    own = items.select(F.col(f"`{item_key}`").alias("k"), F.col(f"`{item_text}`").alias("t")).where("k is not null and t is not null and t <> ''")
    size = own.agg(F.sum(F.length("t"))).first()[0] or 0
    id_type = items.schema[item_key].dataType
    schema = T.StructType([T.StructField(doc_key, docs.schema[doc_key].dataType), T.StructField(item_key, id_type), *[T.StructField(c, T.LongType()) for c in ("n_tiles", "covered", "item_letters", "passage")]])
    arrow = {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.StringType: pa.string()}[type(id_type)]
    way = _sent if size <= ITEM_BLOCK else _joined
    return way(docs.select(f"`{doc_key}`", f"`{doc_text}`"), own, schema, arrow, (least, share, cover))
