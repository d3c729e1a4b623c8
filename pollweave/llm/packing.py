"""Filling fixed-capacity containers: best fit over the histogram of lengths, then a join on rank.

Only the counts of each length are collected (at most ``capacity`` numbers, whatever the corpus). The
plan packs counts rather than items: containers of the same contents are one line of the plan with a
multiplicity. Each length's items are then numbered, in parallel and without a single sorting task, and
take the planned slots by their rank within the length. An item longer than the capacity is cut into full
pieces and a rest; all others stay whole.

The plan is sent to the tasks. Its size is bounded by the capacity alone: a length adds at most three
kinds of containers (one that it splits, one it opens full and one it opens in part), so there are at most
three times ``capacity`` kinds, each with fewer than ``sqrt(2 * capacity)`` lengths.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pollweave.session import written

CAPACITY = 2048
#: Items numbered in one task, about.
RANKED_AT_ONCE = 1_000_000
#: Fixed value: how byte-level rank files of this kind part a text before its bytes are merged.
BYTE_LEVEL = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Largest tokenizer file that is sent along with the tasks, in bytes.
TOKENIZER_MAX = 64 << 20


def _counter(name: str, data: bytes, pattern: str):
    if name.endswith(".tiktoken"):
        import base64

        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}
        enc = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return lambda ts: [len(x) for x in enc.encode_ordinary_batch(ts, num_threads=1)]
    if name.endswith(".json"):
        from tokenizers import Tokenizer

        tok = Tokenizer.from_str(data.decode())
        tok.encode_special_tokens = True
        return lambda ts: [len(x.ids) for x in tok.encode_batch(ts, add_special_tokens=False)]
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=data)
    return lambda ts: [len(x) for x in sp.encode(ts, num_threads=1)]


def token_counts(docs: DataFrame, key: str, text: str, tokenizer: str, out: str = "n_tokens", pattern: str = BYTE_LEVEL) -> DataFrame:
    """``(key, out)``: tokens of each text by the tokenizer file at ``tokenizer``.

    ``.tiktoken`` rank files (with the ``pattern`` that parts a text), ``.json`` files and ``.model`` files of
    the public libraries are read on the driver and sent along, so other nodes need no copy; a file above
    ``TOKENIZER_MAX`` bytes is an error. Special tokens in a text count as ordinary text. Null and empty texts
    have 0 tokens; repeated rows stay repeated; other columns are dropped.
    """
    data = Path(tokenizer).read_bytes()
    if len(data) > TOKENIZER_MAX:
        raise ValueError(f"{tokenizer} has {len(data)} bytes; at most {TOKENIZER_MAX} are sent to the tasks")
    sent = docs.sparkSession.sparkContext.broadcast(data)
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField(out, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(tokenizer, sent.value, pattern)
        for b in batches:
            for at in range(0, b.num_rows, 64):  # the library's lists of ids are larger than the texts
                part = b.slice(at, 64)
                ts = [t or "" for t in part.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(key), pa.array(count(ts), pa.int64())], names=[key, out])

    return docs.select(f"`{key}`", f"`{text}`").mapInArrow(run, schema)


def plan(histogram: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """``(how many containers, ((length, how many each), ...))`` for ``{length: items}``, lengths 1..capacity.

    Best fit decreasing, with the same containers as if item after item, longest first, went to the container
    with the least room that takes it: that one then has the least room still, so it takes the length until it
    is full, and the next one follows. Work is bounded by lengths times kinds of room, not by items.
    """
    if any(not 0 < s <= capacity for s in histogram):
        raise ValueError("lengths must be between 1 and the capacity")
    room: dict[int, dict[tuple, int]] = {}  # room left -> contents -> containers

    def put(contents: tuple, left: int, n: int) -> None:
        kinds = room.setdefault(left, {})
        kinds[contents] = kinds.get(contents, 0) + n

    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        for r in sorted(k for k in room if k >= size):  # what they become is too small to take the length again
            fit = r // size
            for contents in list(room[r]):
                n = room[r].pop(contents)
                full = min(n, left // fit)
                rest = left - full * fit if full < n else 0
                if full:
                    put((*contents, (size, fit)), r - fit * size, full)
                if rest:
                    put((*contents, (size, rest)), r - rest * size, 1)
                if kept := n - full - (rest > 0):
                    put(contents, r, kept)
                left -= full * fit + rest
                if not left:
                    break
            if not room[r]:
                del room[r]
            if not left:
                break
        fit = capacity // size
        full, rest = divmod(left, fit)
        if full:
            put(((size, fit),), capacity - fit * size, full)
        if rest:
            put(((size, rest),), capacity - rest * size, 1)
    out = [(n, contents) for kinds in room.values() for contents, n in kinds.items()]
    return sorted(out, key=lambda x: (-sum(s * k for s, k in x[1]), x[1]))


def slots(lines: list[tuple[int, tuple[tuple[int, int], ...]]]) -> dict[int, np.ndarray]:
    """The plan by length: rows of ``first rank, first container, how many each, offset``, by first rank. The
    ranks of a row go to its containers in turn, ``how many each`` to one."""
    used: dict[int, int] = {}
    rows: dict[int, list] = {}
    container = 0
    for n, contents in lines:
        offset = 0
        for length, each in contents:
            at = used.get(length, 0)
            rows.setdefault(length, []).append((at, container, each, offset))
            used[length] = at + n * each
            offset += length * each
        container += n
    return {k: np.array(v, np.int64) for k, v in rows.items()}


def pieces(items: DataFrame, key: str, size: str, capacity: int = CAPACITY) -> DataFrame:
    """``(key, piece, length)``: whole items as one piece 0; longer ones cut at multiples of the capacity.
    Items of size 0, negative or null have no piece."""
    n = F.col(f"`{size}`").cast("bigint")
    cut = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / capacity).cast("bigint")))
    d = items.where(n > 0).select(F.col(f"`{key}`"), n.alias("__n"), cut.alias("piece"))
    return d.select(f"`{key}`", "piece", F.least(F.lit(capacity).cast("bigint"), F.col("__n") - F.col("piece") * capacity).alias("length"))


def ranked(parts: DataFrame, key: str, buckets: int = 1) -> DataFrame:
    """``parts`` with ``rank`` from 0 within each length, dense. A length is split into ``buckets`` by the key's
    hash, so a length that a third of all items share is not numbered in one task."""
    k = F.col(f"`{key}`")
    d = parts.withColumn("__b", F.pmod(F.xxhash64(k, "piece"), F.lit(buckets)))
    within = F.row_number().over(Window.partitionBy("length", "__b").orderBy(k, "piece")) - 1
    if buckets == 1:
        return d.select(k, "piece", "length", within.cast("bigint").alias("rank"))
    size = d.groupBy("length", "__b").agg(F.count("*").alias("__c"))
    before = F.sum("__c").over(Window.partitionBy("length").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))
    size = size.withColumn("__before", F.coalesce(before, F.lit(0))).drop("__c")
    return d.withColumn("__r", within).join(size, ["length", "__b"]).select(k, "piece", "length", (F.col("__before") + F.col("__r")).alias("rank"))


def packed(items: DataFrame, key: str, size: str, capacity: int = CAPACITY) -> DataFrame:
    """``(key, piece, length, container, offset)``: the container of each piece and its place in it.

    Every item with a positive size is placed exactly once (repeated keys are items of their own; give
    them distinct keys if they must be told apart); no container holds more than ``capacity``. Sizes
    of 0 or less and null sizes are left out; an empty table gives an empty result; ties go by key. The
    items are read three times, so sizes that cost much to compute should be :func:`written` before.
    """
    spark = items.sparkSession
    if key in ("piece", "length", "container", "offset", "rank"):
        raise ValueError(f"key {key} clashes with an output column")
    parts = pieces(items, key, size, capacity)
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    schema = T.StructType([T.StructField(key, items.schema[key].dataType), *[T.StructField(c, T.LongType()) for c in ("piece", "length", "container", "offset")]])
    buckets = -(-max(histogram.values(), default=1) // RANKED_AT_ONCE)
    sent = spark.sparkContext.broadcast(slots(plan(histogram, capacity)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = sent.value
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            container, offset = np.empty_like(rank), np.empty_like(rank)
            for n in np.unique(length).tolist():
                who = np.flatnonzero(length == n)
                line = by[n][np.searchsorted(by[n][:, 0], rank[who], side="right") - 1]
                nth = rank[who] - line[:, 0]
                container[who] = line[:, 1] + nth // line[:, 2]
                offset[who] = line[:, 3] + nth % line[:, 2] * n
            yield pa.RecordBatch.from_arrays([b.column(key), b.column("piece"), b.column("length"), pa.array(container), pa.array(offset)], names=schema.names)

    return ranked(parts, key, buckets).mapInArrow(place, schema)


def packed_texts(docs: DataFrame, key: str, text: str, tokenizer: str, capacity: int = CAPACITY, pattern: str = BYTE_LEVEL) -> DataFrame:
    """:func:`packed` over the tokens of ``docs[text]``; each text is tokenized once and only its key and count
    are kept. Null and empty texts are in no container."""
    return packed(written(token_counts(docs, key, text, tokenizer, "n_tokens", pattern)), key, "n_tokens", capacity)
