"""Words of text without blanks between words: the likeliest path through a dictionary.

Every run of letters is cut where the product of the words' frequencies is largest (dynamic programming over all
dictionary words that begin at each place). Letters that no word covers stand alone, except that runs of letters and
digits of scripts that part words by blanks stay whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pollweave.functions.semantics import col

#: Characters of a dictionary that is sent to the tasks at most.
DICTIONARY_MAX = 16_000_000
_RUN = re.compile(r"[^\W_]+")
#: Kana and ideographs: scripts that do not part words by blanks.
_CJK = re.compile(r"[\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U000323af]+")
_UNSPACED = re.compile(rf"{_CJK.pattern}|{_CJK.pattern.replace('[', '[^')}")


class Segmenter:
    """Cuts text by a dictionary ``{word: frequency}``; words are taken in lower case, frequencies of at least 1."""

    def __init__(self, words: Mapping[str, int]):
        self.words: dict[str, int] = {}
        for w, n in words.items():
            if w:
                w = w.lower()
                self.words[w] = self.words.get(w, 0) + max(1, n)
        self.longest = max(map(len, self.words), default=1)
        total = sum(self.words.values()) or 1
        self.cost = {w: math.log(total) - math.log(n) for w, n in self.words.items()}
        self.alone = math.log(total) + 1  # a letter that is no word

    def __reduce__(self):
        return (Segmenter, (self.words,))

    def _path(self, run: str) -> list[str]:
        n = len(run)
        best, cut = [0.0] * (n + 1), [0] * (n + 1)
        for i in range(n - 1, -1, -1):
            best[i], cut[i] = best[i + 1] + self.cost.get(run[i], self.alone), i + 1
            for j in range(i + 2, min(n, i + self.longest) + 1):
                c = self.cost.get(run[i:j])
                if c is not None and c + best[j] < best[i]:
                    best[i], cut[i] = c + best[j], j
        out, i = [], 0
        while i < n:
            out.append(run[i : cut[i]])
            i = cut[i]
        return out

    def cut(self, text: str | None) -> list[str]:
        """The words of ``text`` in order, in lower case, without blanks and signs."""
        out: list[str] = []
        for run in _RUN.findall((text or "").lower()):
            for part in _UNSPACED.findall(run):
                out += self._path(part) if _CJK.match(part) else [part]
        return out


def dictionary(words: DataFrame, word: str, frequency: str | None = None) -> Segmenter:
    """The segmenter of a table of words; a table of more than ``DICTIONARY_MAX`` characters is an error. Repeated
    words add up, null words are left out, null frequencies count 1."""
    n = F.sum(F.coalesce(col(frequency).cast("bigint"), F.lit(1))) if frequency else F.count("*")
    d = words.where(col(word).isNotNull()).groupBy(col(word).alias("w")).agg(n.alias("n"))
    size = d.agg(F.sum(F.length("w"))).first()[0] or 0
    if size > DICTIONARY_MAX:
        raise ValueError(f"the dictionary has {size} characters; at most {DICTIONARY_MAX} are sent to the tasks")
    return Segmenter({r["w"]: r["n"] for r in d.collect()})


def segmented(docs: DataFrame, key: str, text: str, segmenter: Segmenter, out: str = "words") -> DataFrame:
    """``(key, out)``: the words of each text as an array; null and empty texts have none. One narrow pass."""
    sent = docs.sparkSession.sparkContext.broadcast(segmenter)
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField(out, T.ArrayType(T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = sent.value.cut
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(key), pa.array([cut(t) for t in b.column(text).to_pylist()], pa.list_(pa.string()))], names=schema.names)

    return docs.select(col(key), col(text)).mapInArrow(run, schema)
