"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Texts that are equal form a group, and a group is never split.  Groups enter in order of
falling size; each goes into the bin whose remaining capacity is the smallest that still
holds it, found in a list of bins kept in order of what remains.  The capacity is the
smallest that leaves no group over, found by halving; a capacity too small by little is
what keeps the shards near equal.

Nothing whole passes the driver.  Groups count by size class, 4096 classes for each
doubling of the size, and sizes up to 8192 exactly, so the table of counts has a fixed
bound (about 220,000 rows for sizes up to 2**62).  Packing that table gives, for each
class, runs of ranks that share a shard; a group finds its shard by its rank in its class.
Ranks and slots come from cells (see ``common.numbered``), so neither a frequent size nor
a frequent text gathers in one task.
"""

from __future__ import annotations

import bisect

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.common import numbered, pick, written

FINE = 12


def size_class(size: Column) -> Column:
    """The size with all but its leading 13 bits cleared."""
    drop = F.greatest(F.floor(F.log2(size)).cast("int") - FINE, F.lit(0))
    # log2 in floating point may be one off beside a power of two; a bit more is kept then.
    return F.call_function("shiftleft", F.call_function("shiftright", size, drop), drop)


def pack(sizes: list[tuple[int, int, int]], bins: int, capacity: int):
    """Best-fit-decreasing of (class, groups, largest size) into ``bins`` bins.

    Returns runs (class, first rank, last rank, bin), or None if a group is left over.
    """
    order = [(capacity, b) for b in range(bins)]
    runs = []
    for name, count, size in sizes:
        first = 0
        while first < count:
            at = bisect.bisect_left(order, (size, -1))
            if at == len(order):
                return None
            room, which = order.pop(at)
            n = min(count - first, room // size)
            runs.append((name, first, first + n - 1, which))
            bisect.insort(order, (room - n * size, which))
            first += n
    return runs


def best_fit_decreasing(sizes: list[tuple[int, int, int]], bins: int):
    """The runs for the smallest capacity found by halving; see :func:`pack`.

    A group above the mean of what is left takes a bin alone, so that the others stay equal.
    """
    sizes = sorted(sizes, key=lambda x: (-x[2], -x[0]))
    total = sum(n * s for _, n, s in sizes)
    alone, skipped = [], {}
    for name, count, size in sizes:
        while skipped.get(name, 0) < count and bins > 1 and size * bins > total:
            alone.append((name, skipped.get(name, 0), skipped.get(name, 0), bins - 1))
            skipped[name] = skipped.get(name, 0) + 1
            total, bins = total - size, bins - 1
    sizes = [(c, n - skipped.get(c, 0), s) for c, n, s in sizes if n > skipped.get(c, 0)]
    if not sizes:
        return alone
    low = max(-(-total // bins), sizes[0][2])
    high, found = low, None
    while (found := pack(sizes, bins, high)) is None:
        low, high = high + 1, high + max(1, high // 64)
    while low < high:
        middle = (low + high) // 2
        runs = pack(sizes, bins, middle)
        if runs is None:
            low = middle + 1
        else:
            high, found = middle, runs
    moved = [(c, f + skipped.get(c, 0), t + skipped.get(c, 0), b) for c, f, t, b in found]
    return alone + moved


def shard(docs: DataFrame, shards: int = 16, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row.

    Law ``bytes``: sizes (UTF-8 bytes plus one) are near equal.  Null texts count as no
    bytes and form a group of their own, apart from empty ones.  Rows repeated in full
    stay, each with a slot of its own; null ids stay null.  No rows give no rows.
    """
    spark = docs.sparkSession
    rows = pick(docs, id_column, text).toDF("doc_id", "text")
    body = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    narrow = written(
        rows.select(
            "doc_id",
            (F.octet_length(body).cast("long") + 1).alias("size"),
            F.crc32(body).alias("text_crc32"),
            F.when(F.col("text").isNull(), F.lit(b"")).otherwise(F.unhex(F.sha2(body, 256))).alias("_g"),
        )
    )
    groups = narrow.groupBy("_g").agg(F.sum("size").alias("_bytes"))
    groups = groups.withColumn("_class", size_class(F.col("_bytes")))
    ranked = written(numbered(groups, ["_class"], ["_g"], "_rank"))
    counted = ranked.groupBy("_class").agg(
        F.count(F.lit(1)).alias("n"), F.max("_bytes").alias("most")
    )
    runs = best_fit_decreasing([tuple(r) for r in counted.toLocalIterator()], shards)
    plan = spark.createDataFrame(
        [tuple(map(int, r)) for r in runs], "pc long, low long, high long, shard int"
    )
    placed = (
        ranked.join(
            plan,
            (F.col("_class") == F.col("pc"))
            & (F.col("_rank") >= F.col("low"))
            & (F.col("_rank") <= F.col("high")),
        )
        .select(F.col("_g").alias("_pg"), "shard")
    )
    dealt = written(
        narrow.join(placed, F.col("_g") == F.col("_pg")).drop("_g", "_pg")
        .withColumn("_row", F.monotonically_increasing_id())
    )
    # The row's own number spreads equal rows over cells; it is part of the written table.
    slotted = numbered(dealt, ["shard"], ["doc_id", "size", "text_crc32", "_row"], "slot")
    return slotted.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
