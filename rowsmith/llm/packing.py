"""Concatenate and cut: token ids of all documents in one line, cut into fixed windows.

Pass one tokenizes and writes, for each document, its ids and where it begins among the
tokens of its partition.  The totals of the partitions, one number each, are summed up to
the place where each partition begins in the whole line.  Pass two reads the written rows,
adds that place, and cuts each document where a window ends: one boundary record for each
piece.  Nothing is shuffled but the partition totals, and only the last window has padding.
"""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.common import pick, written
from rowsmith.llm.tokens import tokens
from rowsmith.llm.words import blocks


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """The path of a public vocabulary file; it lies at the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _tokenized(path: str, end: int, kind: str):
    def run(batches):
        part, begin, names = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            names = ["doc_id", "part", "begin", "doc_tokens", "ids"]
            for first, data, offsets in blocks(batch.column(1)):
                ids, cuts = tokens(path).encode(data, offsets)
                n = len(cuts) - 1
                line = np.insert(ids, cuts[1:], np.uint32(end)).astype(kind)
                ends = cuts[1:] + np.arange(1, n + 1)
                starts = np.concatenate([[0], ends])[:-1]
                width = line.dtype.itemsize
                body = pa.Array.from_buffers(
                    pa.binary(), n,
                    [None, pa.py_buffer((np.append(starts, ends[-1:]) * width).astype(np.int32)),
                     pa.py_buffer(line)],
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(np.full(n, part, np.int64)),
                     pa.array(starts + begin), pa.array(ends - starts), body],
                    names=names,
                )
                begin += int(ends[-1])

    return run


def token_rows(
    docs: DataFrame, path: str, end: int = 2, wide: bool = False,
    id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, part, begin, doc_tokens, ids): each document's ids and the end id.

    ``begin`` counts the tokens before the document in its partition.  Ids are packed as 16
    bits, or as 32 with ``wide`` for vocabularies above 65,536.  Null texts are empty.
    """
    rows = pick(docs, id_column, text)
    kind = rows.schema[0].dataType.simpleString()
    schema = f"doc_id {kind}, part long, begin long, doc_tokens long, ids binary"
    return rows.mapInArrow(_tokenized(path, end, "<u4" if wide else "<u2"), schema)


def _cut(length: int, kind: str, crc: bool):
    def run(batches):
        for batch in batches:
            begin = batch.column(1).to_numpy()
            size = batch.column(2).to_numpy()
            n = (begin + size - 1) // length - begin // length + 1
            row = np.repeat(np.arange(len(begin)), n)
            k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            sequence = begin[row] // length + k
            low = np.maximum(begin[row], sequence * length)
            high = np.minimum(begin[row] + size[row], (sequence + 1) * length)
            start = low - begin[row]
            ids = batch.column(3)
            pieces = []
            whole, at = None, -1
            for r, a, b in zip(row.tolist(), start.tolist(), (start + high - low).tolist()):
                if r != at:
                    whole, at = np.frombuffer(ids[r].as_buffer(), dtype=kind).astype("<u4"), r
                pieces.append(zlib.crc32(whole[a:b]) if crc else whole[a:b].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(start), pa.array(high - low),
                 pa.array(pieces, pa.int64() if crc else pa.binary()), pa.array(size[row]),
                 pa.array(sequence), pa.array(low - sequence * length)],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

    return run


def concatenate_and_cut(
    docs: DataFrame, path: str, length: int = 4096, end: int = 2, wide: bool = False,
    digest: bool = False, id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset) of every piece.

    ``ids`` are the piece's ids as little-endian 32-bit numbers, or with ``digest`` their
    CRC-32.  Documents stand in the order of the written table.  Null and empty texts are
    the end id alone; rows repeated in full, or without an id, are documents of their own.
    No rows give no pieces.
    """
    spark = docs.sparkSession
    rows = written(token_rows(docs, path, end, wide, id_column, text))
    totals = rows.groupBy("part").agg(F.sum("doc_tokens")).orderBy("part").collect()
    places = itertools.accumulate([t[1] for t in totals], initial=0)
    begins = spark.createDataFrame(
        [(int(t[0]), p) for t, p in zip(totals, places)], "p long, place long"
    )
    placed = rows.join(F.broadcast(begins), F.col("part") == F.col("p")).select(
        "doc_id", (F.col("begin") + F.col("place")).alias("begin"), "doc_tokens", "ids"
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, start long, length long, ids {'long' if digest else 'binary'}, "
        "doc_tokens long, sequence_id long, offset long"
    )
    return placed.mapInArrow(_cut(length, "<u4" if wide else "<u2", digest), schema)


def sequences(pieces: DataFrame, length: int = 4096, pad: int = 0) -> DataFrame:
    """(sequence_id, ids, n_ids, bounds): the pieces of each sequence side by side, padded.

    A sequence shorter than ``length`` is padded to it, unless its size is a power of two.
    ``bounds`` are the places where pieces begin, and the end.
    """
    kind = "sequence_id long, ids binary, n_ids long, bounds array<long>"

    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table["offset"].to_numpy())
        blobs = [table["ids"][int(i)].as_py() for i in order]
        bounds = np.concatenate([[0], np.cumsum([len(b) // 4 for b in blobs])])
        n = int(bounds[-1])
        room = n if n & (n - 1) == 0 else length
        body = b"".join(blobs) + np.full(max(0, room - n), pad, "<u4").tobytes()
        return pa.table(
            {
                "sequence_id": [table["sequence_id"][0].as_py()],
                "ids": pa.array([body], pa.binary()),
                "n_ids": [n],
                "bounds": pa.array([bounds.tolist()], pa.list_(pa.int64())),
            }
        )

    return pieces.groupBy("sequence_id").applyInArrow(run, kind)
