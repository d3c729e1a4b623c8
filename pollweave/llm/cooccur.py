"""Items that appear together: pair counts by an external sort of packed 64-bit codes, with odds ratios.

Each record's items become integer ids, each pair one 64-bit code (smaller id in the high half). A task
sorts the codes of a block and run-length counts them, which leaves a sorted run of ``(code, count)``;
the shuffle brings equal codes together, each reducer merges its runs in an external sort that spills,
and a second run-length pass adds them up. A pair can reach the bounds only if both items do, so items
below the bounds are dropped before pairs are made - no pair is lost, and the dictionary of the items
left has at most ``1000 * (items per record)`` entries, which is what may be broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIN_COUNT = 4
MIN_PER_MILLE = 1
MIN_LIFT = 3
#: Ids are broadcast as a map up to this many items, joined beyond.
BROADCAST_ITEMS = 200_000
#: Codes sorted at once in a task (8 bytes each).
BLOCK = 2_000_000
#: A record of more items is split over tasks, each with so many of its items as the first of a pair.
SPLIT = 2_000


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of ascending ids to sorted runs of (code, n). With columns ``lo`` and ``hi`` only the items of
    these places are the first of a pair."""
    held: list[np.ndarray] = []
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        codes, n = np.unique(np.concatenate(held), return_counts=True)
        for at in range(0, len(codes), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(codes[at : at + 100_000]), pa.array(n[at : at + 100_000].astype(np.int64))], names=["code", "n"])

    for b in batches:
        ids = b.column("ids")
        flat = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        lens = np.diff(ids.offsets.to_numpy())
        starts = np.concatenate([[0], np.cumsum(lens)[:-1]]).astype(np.int64)
        if "lo" in b.schema.names:
            for at, k, lo, hi in zip(starts.tolist(), lens.tolist(), b.column("lo").to_pylist(), b.column("hi").to_pylist(), strict=True):
                for i in range(lo, min(hi, k - 1)):
                    held.append((flat[at + i] << 32) | flat[at + i + 1 : at + k])
                    size += held[-1].size
                    if size >= BLOCK:
                        yield from flush()
                        held, size = [], 0
            continue
        # records of equal length make one matrix, whose column pairs are vector operations
        for k in np.unique(lens):
            if k < 2:
                continue
            at = starts[lens == k]
            step = max(1, BLOCK // int(k * (k - 1) // 2))
            for s in range(0, len(at), step):
                m = flat[at[s : s + step, None] + np.arange(k)]
                for i in range(k - 1):
                    held.append(((m[:, i : i + 1] << 32) | m[:, i + 1 :]).ravel())
                    size += held[-1].size
                    if size >= BLOCK:
                        yield from flush()
                        held, size = [], 0
    if size:
        yield from flush()


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (code, n) to one row per code; a code may run on over batches."""
    code, total = None, 0
    for b in batches:
        c, n = b.column("code").to_numpy(), b.column("n").to_numpy()
        if not len(c):
            continue
        first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
        u, s = c[first], np.add.reduceat(n, first)
        if code is not None:
            if u[0] == code:
                s[0] += total
            else:
                u, s = np.concatenate([[code], u]), np.concatenate([[total], s])
        code, total = int(u[-1]), int(s[-1])
        yield pa.RecordBatch.from_arrays([pa.array(u[:-1], pa.int64()), pa.array(s[:-1], pa.int64())], names=["code", "n"])
    if code is not None:
        yield pa.RecordBatch.from_arrays([pa.array([code], pa.int64()), pa.array([total], pa.int64())], names=["code", "n"])


PAIRS = T.StructType([T.StructField("code", T.LongType()), T.StructField("n", T.LongType())])


def item_counts(baskets: DataFrame) -> DataFrame:
    """``(item, n_item, longest)`` of ``baskets(items array<string>)`` with distinct items; the row with a null item
    has the number of records and the items of the longest, so all come from one pass."""
    marked = F.concat(F.array(F.lit(None).cast("string")), "items")
    return baskets.where(F.size("items") > 0).select(F.explode(marked).alias("item"), F.size("items").alias("k")).groupBy("item").agg(F.count("*").alias("n_item"), F.max("k").alias("longest"))


def _split(encoded: DataFrame) -> DataFrame:
    """Runs of the records, long ones dealt out to all tasks in parts."""
    usual = encoded.where(F.size("ids") <= SPLIT).mapInArrow(_runs, PAIRS)
    at = F.explode(F.sequence(F.lit(0), F.size("ids") - 1, F.lit(SPLIT)))
    parts = encoded.where(F.size("ids") > SPLIT).select("ids", at.alias("lo")).withColumn("hi", F.col("lo") + SPLIT).repartition(encoded.sparkSession.sparkContext.defaultParallelism * 4, F.xxhash64("ids", "lo"))
    return usual.unionByName(parts.mapInArrow(_runs, PAIRS))


def pairs(baskets: DataFrame, min_count: int = MIN_COUNT, min_per_mille: float = MIN_PER_MILLE) -> DataFrame:
    """All pairs with ``n_ab >= min_count`` and ``1000 * n_ab >= min_per_mille * n``:
    ``(item_a, item_b, n_a, n_b, n_ab, n, lift, odds_ratio, log_odds)``, ``item_a`` before ``item_b`` by code points.

    ``baskets`` has one row per record with ``items``, an array of strings; null or empty arrays are no
    records, null items and repeats within a record count not at all and once. The odds ratio has the
    continuity correction of 1/2 in each cell, so it is finite for items that always or never meet.
    """
    spark = baskets.sparkSession
    clean = baskets.select(F.array_distinct(F.filter(F.coalesce("items", F.array().cast("array<string>")), lambda x: x.isNotNull())).alias("items"))
    # the items that can be in a pair, and the number of records; ids follow the code points, so the smaller is item_a
    counts = item_counts(clean)
    n_of = counts.where("item is null").select(F.col("n_item").alias("__n"), F.col("longest").alias("__longest"))
    often = counts.where("item is not null").crossJoin(F.broadcast(n_of)).where((F.col("n_item") >= min_count) & (1000 * F.col("n_item") >= F.lit(min_per_mille) * F.col("__n")))
    rows = often.limit(BROADCAST_ITEMS + 1).collect()
    if not rows:
        return spark.createDataFrame([], "item_a string, item_b string, n_a bigint, n_b bigint, n_ab bigint, n bigint, lift double, odds_ratio double, log_odds double")
    n, longest = rows[0]["__n"], rows[0]["__longest"]
    often = often.drop("__n", "__longest", "longest")
    if len(rows) <= BROADCAST_ITEMS:
        rows.sort(key=lambda r: r[0].encode())
        ids = spark.createDataFrame([(r[0], i, r[1]) for i, r in enumerate(rows)], "item string, id bigint, n_item bigint")
        lookup = spark.sparkContext.broadcast({r[0]: i for i, r in enumerate(rows)})

        def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = lookup.value
            for b in batches:
                got = [sorted({known[x] for x in r if x in known}) for r in b.column("items").to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array([g for g in got if len(g) > 1], pa.list_(pa.int64()))], names=["ids"])

        many = clean.where(F.size("items") > 1)
        if longest <= SPLIT:
            encoded = many.mapInArrow(lambda it: _runs(encode(it)), PAIRS)
        else:
            encoded = _split(many.mapInArrow(encode, "ids array<bigint>"))
    else:
        from pyspark.sql import Window

        # dense ids without one sorting task
        ranged = often.repartitionByRange("item").sortWithinPartitions("item").withColumn("__p", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
        size = ranged.groupBy("__p").agg(F.count("*").alias("__n"))
        before = size.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        ids = ranged.join(before, "__p").select("item", (F.col("__before") + F.col("__i")).alias("id"), "n_item")
        rec = clean.withColumn("__r", F.monotonically_increasing_id()).select("__r", F.explode("items").alias("item"))
        encoded = rec.join(ids, "item").groupBy("__r").agg(F.array_sort(F.collect_list("id")).alias("ids")).select("ids")
        encoded = encoded.mapInArrow(_runs, PAIRS) if longest <= SPLIT else _split(encoded)
    met = encoded.repartition("code").sortWithinPartitions("code").mapInArrow(_merge, PAIRS)
    met = met.where((F.col("n") >= min_count) & (1000 * F.col("n") >= F.lit(min_per_mille) * n))
    a = ids.select(F.col("id").alias("__a"), F.col("item").alias("item_a"), F.col("n_item").alias("n_a"))
    b = ids.select(F.col("id").alias("__b"), F.col("item").alias("item_b"), F.col("n_item").alias("n_b"))
    out = met.withColumn("__a", F.shiftright("code", 32)).withColumn("__b", F.col("code").bitwiseAND(0xFFFFFFFF)).withColumnRenamed("n", "n_ab").join(a, "__a").join(b, "__b")
    out = out.withColumn("n", F.lit(n).cast("bigint"))
    half = F.lit(0.5)
    odds = (F.col("n_ab") + half) * (F.col("n") - F.col("n_a") - F.col("n_b") + F.col("n_ab") + half) / ((F.col("n_a") - F.col("n_ab") + half) * (F.col("n_b") - F.col("n_ab") + half))
    return out.select("item_a", "item_b", "n_a", "n_b", "n_ab", "n", (F.col("n_ab").cast("double") * F.col("n") / (F.col("n_a").cast("double") * F.col("n_b"))).alias("lift"), odds.alias("odds_ratio"), F.log(odds).alias("log_odds"))


def above_chance(found: DataFrame, min_lift: int = MIN_LIFT) -> DataFrame:
    """The pairs met at least ``min_lift`` times as often as independent items would (exact in integers)."""
    whole = lambda c: F.col(c).cast("decimal(18,0)")  # noqa: E731 - products of large counts do not fit 64 bits
    return found.where(whole("n_ab") * whole("n") >= F.lit(min_lift).cast("decimal(1,0)") * (whole("n_a") * whole("n_b")))
