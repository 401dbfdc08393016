"""Token ids packed by best-fit-decreasing, as id matrices with segment lengths and resets.

Overlong documents are split without loss: full sequences, each a sequence of its own, and
a rest.  Rests enter in order of falling size; each goes into the open sequence with the
smallest room that still holds it, found in a segment tree over room.

Sizes are at most ``length``, so the corpus comes down to a histogram of at most ``length``
rows, whatever its size.  Packing takes it size by size: as long as the tightest sequence
holds more of the same size it is the tightest still, so one step fills many equal
sequences.  That is the result of placing rests one by one, for the whole corpus, as a
short table of runs.  A rest finds its place by its rank among the rests of its size;
ranks are gapless and found in cells (``common.numbered``), not in one task per size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.common import numbered, pick, written
from rowsmith.llm.tokens import tokens
from rowsmith.llm.words import blocks

_BLOCK = 1 << 20  # bytes of text that are tokenized at a time


class RoomTree:
    """A segment tree over room 0..capacity: the smallest room with an open group, from below."""

    def __init__(self, capacity: int):
        self.leaves = 1
        while self.leaves <= capacity:
            self.leaves *= 2
        self.full = [0] * (2 * self.leaves)
        self.groups: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def _change(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.full[node] += by
            node //= 2

    def push(self, room: int, first: int, count: int) -> None:
        if count and room:
            self.groups[room].append((first, count))
            self._change(room, 1)

    def tightest(self, size: int) -> int | None:
        """The smallest room of at least ``size``."""
        node = size + self.leaves
        if self.full[node]:
            return size
        while node > 1:
            if node % 2 == 0 and self.full[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.full[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None

    def pop(self, room: int) -> tuple[int, int]:
        self._change(room, -1)
        return self.groups[room].pop()


def best_fit_decreasing(histogram: dict[int, int], length: int):
    """Runs (size, first rank, count, first sequence, per sequence, offset) and the sequences.

    Rank ``first + i`` of a size lies in sequence ``first sequence + i // per sequence`` at
    ``offset + (i % per sequence) * size``.
    """
    tree, runs, opened = RoomTree(length), [], 0
    for size in sorted(histogram, reverse=True):
        rank, left = 0, histogram[size]
        while left:
            room = tree.tightest(size)
            if room is None:
                room, first, count = length, opened, -(-left // (length // size))
                opened += count
            else:
                first, count = tree.pop(room)
            each = room // size
            whole = min(count, left // each)
            taken = whole * each
            if taken:
                tree.push(room - each * size, first, whole)
            elif left < each:
                whole, taken, each = 1, left, left
                tree.push(room - left * size, first, 1)
            tree.push(room, first + whole, count - whole)
            runs.append((size, rank, taken, first, each, length - room))
            rank, left = rank + taken, left - taken
    return runs, opened


def _split(path: str, end: int, length: int, kind: str):
    """(doc_id, doc_tokens, start, size, ids): full pieces and rests, ids compressed.

    Texts are tokenized, cut and compressed by one process, a small block at a time.
    """

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for first, data, offsets in blocks(batch.column(1), _BLOCK):
                ids, cuts = tokens(path).encode(data, offsets)
                size = np.diff(cuts) + 1
                n = -(-size // length)
                row = np.repeat(np.arange(len(size)), n)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * length
                stop = np.minimum(start + length, size[row])
                line = np.insert(ids, cuts[1:], np.uint32(end)).astype(kind)
                before = (np.cumsum(size) - size)[row]
                bodies = [
                    pack(line[a:b].tobytes())
                    for a, b in zip((before + start).tolist(), (before + stop).tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(size)).take(pa.array(row)), pa.array(size[row]),
                     pa.array(start), pa.array(stop - start), pa.array(bodies, pa.binary())],
                    names=["doc_id", "doc_tokens", "start", "size", "ids"],
                )

    return run


def pieces(
    docs: DataFrame, path: str, length: int = 4096, end: int = 2, wide: bool = False,
    id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, doc_tokens, start, size, ids, sequence_id, offset) of every piece.

    Null and empty texts are the end id alone; rows repeated in full, or without an id, are
    documents of their own.  No rows give no pieces.
    """
    spark = docs.sparkSession
    rows = pick(docs, id_column, text)
    kind = rows.schema[0].dataType.simpleString()
    split = written(
        rows.mapInArrow(
            _split(path, end, length, "<u4" if wide else "<u2"),
            f"doc_id {kind}, doc_tokens long, start long, size long, ids binary",
        )
        .withColumn("piece", F.monotonically_increasing_id())
    )
    ranked = written(numbered(split.select("piece", "size"), ["size"], ["piece"], "rank"))
    counts = dict(ranked.groupBy("size").count().collect())
    full = counts.pop(length, 0)
    runs, opened = best_fit_decreasing(counts, length)
    if full:
        runs.append((length, 0, full, opened, 1, 0))
    plan = spark.createDataFrame(
        [tuple(map(int, r)) for r in runs],
        "ps long, low long, taken long, first long, each long, base long",
    )
    inside = (F.col("size") == F.col("ps")) & (F.col("rank") >= F.col("low"))
    placed = ranked.join(plan, inside & (F.col("rank") < F.col("low") + F.col("taken"))).select(
        F.col("piece").alias("p"),
        (F.col("first") + F.floor((F.col("rank") - F.col("low")) / F.col("each"))).alias("sequence_id"),
        (F.col("base") + (F.col("rank") - F.col("low")) % F.col("each") * F.col("size")).alias("offset"),
    )
    return split.join(placed, F.col("piece") == F.col("p")).select(
        "doc_id", "doc_tokens", "start", "size", "ids", "sequence_id", "offset"
    )


def _assembled(length: int, kind: str, pad: int, schema: pa.Schema):
    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table["offset"].to_numpy())
        open_ = zstandard.ZstdDecompressor().decompress
        bodies = table["ids"].to_pylist()
        line = np.frombuffer(b"".join(open_(bodies[i]) for i in order), dtype=kind)
        sizes = table["size"].to_numpy()[order]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        ids = np.full(length, pad, dtype=kind)
        ids[: len(line)] = line
        resets = np.arange(len(line)) - np.repeat(bounds[:-1], sizes)
        positions = np.zeros(length, dtype="<u4")
        positions[: len(line)] = resets
        return pa.table(
            [
                pa.array([table["sequence_id"][0].as_py()]),
                pa.array([len(line)]),
                pa.array([table["doc_id"].take(pa.array(order)).to_pylist()], schema.field("doc_ids").type),
                pa.array([table["start"].to_numpy()[order].tolist()], pa.list_(pa.int64())),
                pa.array([bounds.tolist()], pa.list_(pa.int64())),
                pa.array([ids.tobytes()], pa.binary()),
                pa.array([positions.tobytes()], pa.binary()),
            ],
            schema=schema,
        )

    return run


def matrices(
    docs: DataFrame, path: str, length: int = 4096, end: int = 2, pad: int = 0, wide: bool = False,
    id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(sequence_id, n_ids, doc_ids, starts, bounds, ids, positions): a row of the matrix each.

    ``ids`` are ``length`` numbers of 16 bits (32 with ``wide``), padded; ``bounds`` the
    cumulative segment lengths from 0; ``positions`` the place of each id in its segment, 32
    bits, 0 again at every reset.  Write it with ``.write.parquet``.
    """
    placed = pieces(docs, path, length, end, wide, id_column, text)
    kind = placed.schema["doc_id"].dataType.simpleString()
    id_type = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    if id_type == pa.string():
        placed = placed.withColumn("doc_id", F.col("doc_id").cast("string"))
        kind = "string"
    schema = pa.schema(
        [("sequence_id", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(id_type)),
         ("starts", pa.list_(pa.int64())), ("bounds", pa.list_(pa.int64())),
         ("ids", pa.binary()), ("positions", pa.binary())]
    )
    return placed.groupBy("sequence_id").applyInArrow(
        _assembled(length, "<u4" if wide else "<u2", pad, schema),
        f"sequence_id long, n_ids long, doc_ids array<{kind}>, starts array<long>, "
        "bounds array<long>, ids binary, positions binary",
    )
