"""Near-duplicate documents by SimHash, compared bit-sliced.

A fingerprint has a bit set where more than half of the document's shingle hashes have it.
Two fingerprints within ``radius`` bits agree wholly on at least one of ``radius`` + 1
pieces of the 64 bits, so only fingerprints that share a piece are compared, and no link
is lost.  Equal fingerprints are one class from the start: copies never meet in a pair.

Inside a bucket fingerprints stand upright: word ``j`` of plane ``b`` holds bit ``b`` of 64
of them.  One XOR with a plane tells where a query differs from all of them; the distances
are kept as bit-sliced counters, to which each plane is added by carry-save.  Counters
start so that they overflow exactly beyond the radius, and queries and blocks of which all
counters have overflowed are left out of further planes.

Large buckets are cut into cells of at most two blocks of ``block`` fingerprints; every
pair of blocks is a cell, in a task of its own.  A cell returns a tree of its links, never
all pairs, and the trees are joined by star contraction.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.common import components, pick, place, text_key, written
from rowsmith.llm.words import U64

BITS = 64


def fingerprint(text: bytes, words: int = 4, seed: int = 42) -> int:
    """The SimHash of a text's word shingles; zero for a text without words."""
    parts = text.lower().split()
    if not parts:
        return 0
    if len(parts) < words:
        shingles = [b" ".join(parts)]
    else:
        shingles = map(b" ".join, zip(*[itertools.islice(parts, i, None) for i in range(words)]))
    ones, total = np.zeros(BITS, dtype=np.int64), 0
    shingles = iter(shingles)
    while True:
        some = itertools.islice(shingles, 1 << 15)
        hashes = np.fromiter(
            map(xxhash.xxh64_intdigest, some, itertools.repeat(seed)), dtype=U64
        )
        if not len(hashes):
            break
        total += len(hashes)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > total, bitorder="little").view(U64)[0])


def _fingerprints(words: int):
    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            prints = [fingerprint(t.as_py() or b"", words) for t in texts]
            column = pa.array(np.array(prints, dtype=U64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), column, batch.column(2)], names=["doc_id", "fp", "text_key"]
            )

    return run


def planes(prints: np.ndarray) -> np.ndarray:
    """Bit planes: row b holds bit b of all fingerprints, 64 to a word."""
    bits = np.unpackbits(prints.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    wide = np.zeros((BITS, -(-packed.shape[1] // 8) * 8), dtype=np.uint8)
    wide[:, : packed.shape[1]] = packed
    return wide.view(U64)


def within(upright: np.ndarray, n: int, queries: np.ndarray, radius: int, every: int = 8):
    """(query, column) of all fingerprints at most ``radius`` bits from a query."""
    depth = int(radius).bit_length()
    ones = ~U64(0)
    # Columns beyond n count as too far from the start.
    over = np.zeros((len(queries), upright.shape[1]), dtype=U64)
    if n % 64:
        over[:, n // 64] = ones << U64(n % 64)
    start = (1 << depth) - 1 - radius
    counters = [np.full(over.shape, ones if start >> k & 1 else U64(0)) for k in range(depth)]
    rows, columns = np.arange(len(queries)), np.arange(upright.shape[1])
    for plane in range(BITS):
        mask = np.where(queries >> U64(plane) & U64(1), ones, U64(0))
        carry = upright[plane][None, :] ^ mask[:, None]
        for k in range(depth):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over |= carry
        if plane % every == every - 1:
            live = over != ones
            r, c = live.any(axis=1), live.any(axis=0)
            if not r.any():
                return np.zeros(0, np.int64), np.zeros(0, np.int64)
            if not (r.all() and c.all()):
                rows, columns, queries = rows[r], columns[c], queries[r]
                # Rows stay contiguous, which the bytes below need; a plain mask of columns
                # returns them the other way round.
                upright = np.compress(c, upright, axis=1)
                kept = np.ix_(r, c)
                over, counters = over[kept], [x[kept] for x in counters]
    near = np.unpackbits((~over).view(np.uint8).reshape(len(rows), -1), axis=1, bitorder="little")
    q, j = np.nonzero(near)
    return rows[q], columns[j // 64] * 64 + j % 64


def tree(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member reachable from each of ``n`` nodes over links a-b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _links(radius: int, block: int):
    """Trees of links within each cell of a partition sorted by cell."""

    def linked(prints: np.ndarray, side: np.ndarray):
        n = len(prints)
        if side.min() == side.max():
            q, j = within(planes(prints), n, prints, radius)
        else:
            left, right = np.flatnonzero(side == side.min()), np.flatnonzero(side == side.max())
            q, j = within(planes(prints[right]), len(right), prints[left], radius)
            q, j = left[q], right[j]
        root = tree(n, q, j)
        far = np.flatnonzero(root != np.arange(n))
        return prints[far], prints[root[far]]

    def run(batches):
        held = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                part = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
                if held is not None:
                    part = [np.concatenate(x) for x in zip(held, part)]
            elif held is None:
                return
            else:
                part = held
            cell, prints, side = part
            edges = np.flatnonzero(np.diff(cell)) + 1
            cuts = [0, *edges.tolist(), len(cell)]
            if batch is not None:
                held = [x[cuts[-2] :] for x in part]
                cuts.pop()
            us, vs = [], []
            for low, high in itertools.pairwise(cuts):
                if high - low > 1:
                    u, v = linked(prints[low:high].view(U64), side[low:high])
                    us.append(u)
                    vs.append(v)
            if us:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).view(np.int64)) for x in (us, vs)], names=["u", "v"]
                )

    return run


def link_trees(prints: DataFrame, radius: int, block: int = 1024) -> DataFrame:
    """(u, v): links that join all distinct fingerprints ``fp`` within the radius."""
    pieces, width = radius + 1, -(-BITS // (radius + 1))
    keys = F.array(
        *[
            F.struct(
                F.lit(p).alias("piece"),
                F.shiftrightunsigned("fp", p * width)
                .bitwiseAND(F.lit((1 << min(width, BITS - p * width)) - 1))
                .alias("part"),
            )
            for p in range(pieces)
        ]
    )
    rows = prints.select("fp", F.explode(keys).alias("k")).select("fp", "k.piece", "k.part")
    full = (
        rows.groupBy("piece", "part")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(
            F.col("piece").alias("p"), F.col("part").alias("q"),
            F.ceil(F.col("n") / block).cast("int").alias("sides"),
        )
    )
    placed = rows.join(full, (F.col("piece") == F.col("p")) & (F.col("part") == F.col("q")))
    side = F.pmod(F.xxhash64("fp", "piece"), "sides").cast("int")
    placed = placed.withColumn("side", side).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("sides") - 1))
    )
    cells = placed.select(
        F.xxhash64("piece", "part", F.least("side", "other"), F.greatest("side", "other")).alias("cell"),
        "fp", "side",
    )
    return (
        cells.repartition("cell")
        .sortWithinPartitions("cell")
        .mapInArrow(_links(radius, block), "u long, v long")
    )


def near_duplicates(
    docs: DataFrame, words: int = 4, radius: int = 4, block: int = 1024,
    id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, fp, component_id, root, text_key) of every row.

    ``component_id`` is the smallest id reachable, ``root`` the smallest fingerprint, and
    ``text_key`` a hash of the text.  Null and empty texts have fingerprint zero and link
    like any other.  Rows without an id are linked, but name no component unless it has no
    other id; then its id is null.  Repeated rows stay.
    """
    rows = pick(docs, id_column, text).toDF("doc_id", "text")
    id_type = rows.schema[0].dataType.simpleString()
    keyed = rows.withColumn("text_key", text_key(F.col("text")))
    found = written(
        keyed.mapInArrow(_fingerprints(words), f"doc_id {id_type}, fp long, text_key long")
    )
    prints = written(found.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(link_trees(prints.select("fp"), radius, block))
    named = written(
        prints.join(roots, F.col("fp") == F.col("node"), "left").select(
            F.col("fp").alias("f"), "least", F.coalesce("root", "fp").alias("root")
        )
    )
    least = named.groupBy(F.col("root").alias("r")).agg(F.min("least").alias("component_id"))
    named = named.join(least, F.col("root") == F.col("r")).select("f", "component_id", "root")
    return found.join(named, F.col("fp") == F.col("f"), "left").select(
        "doc_id", "fp", "component_id", "root", "text_key"
    )


def hexadecimal(column):
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def keep_one(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """One row of each component, all columns kept: the one with the smallest id.

    Rows without an id stand behind all others; among rows with the same id the hash of the
    text decides, and of rows repeated in full one stays.
    """
    found = written(near_duplicates(docs, words, radius))
    row = F.struct("doc_id", "text_key")
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_key")
    kept = found.groupBy("root").agg(F.min_by(row, order).alias("k")).select(
        F.col("k.doc_id").alias("_id"), F.col("k.text_key").alias("_key")
    )
    columns = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    doc, text = f"c{place(columns, 'doc_id')}", f"c{place(columns, 'text')}"
    keyed = plain.withColumn("_text", text_key(F.col(text)))
    same = F.col(doc).eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_key"))
    out = keyed.join(kept, same, "left_semi")
    if not found.groupBy("doc_id", "text_key").count().where("count > 1").isEmpty():
        out = out.dropDuplicates([doc, "_text"])
    return out.drop("_text").toDF(*columns)
