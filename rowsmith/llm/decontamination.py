"""Benchmark decontamination with a distributed positional inverted index.

Training texts are cut into segments of whole documents.  For each segment and each of its
words the index stores one posting list: the places of that word among the segment's words,
ascending.  The index is a table in the shared folder, built once, without a shuffle.

The benchmark is the stated query set; it is read in blocks of a fixed number of windows,
and each block searches the stored index.  Only lists of the block's words leave the table
(a broadcast semi join; the block bounds its size).  Per segment a window begins with the
list of its rarest word, shifted by the word's offset; each further list, rarest first, is
intersected with what is left.  Places that all lists share are exact phrase matches; with
``slop`` each word may be that many places off in the same text, which gives proximity
matches: the starts so found, adjacent ones taken as one, that are not within ``slop`` of an
exact match of the window.  Both are returned apart.

No list is cut, and no list leaves its segment, so a very common word costs each segment
its own places only.  Words are known by 64-bit hashes of their bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsmith.llm.common import keep_rows, pick, place, text_key, written
from rowsmith.llm.words import ALNUM, LOWER, blocks, spans, word_hashes

#: The term of the row that lists a segment's documents; no word has this hash.
DOCS = 0
_ROOM = 1 << 34


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and where each text's words begin and end among them."""
    data = LOWER[data]
    starts, ends = spans(data, offsets, ALNUM)
    terms = word_hashes(data, starts, ends).view(np.int64)
    terms[terms == DOCS] = 1
    return terms, np.searchsorted(starts, offsets)


def _lists(segment_bytes: int):
    def run(batches):
        part, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            kind = pa.list_(batch.schema.field(0).type)
            for first, data, offsets in blocks(batch.column(1), segment_bytes):
                terms, bounds = _terms(data, offsets)
                order = np.argsort(terms, kind="stable")
                ranked = terms[order]
                cuts = np.flatnonzero(np.diff(ranked, prepend=ranked[:1] - 1)) if len(ranked) else ranked
                ends = np.append(cuts, len(ranked)).astype(np.int32) * 4
                n = len(cuts)
                places = pa.Array.from_buffers(
                    pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(order.astype(np.uint32))]
                )
                ids = batch.column(0).slice(first, len(bounds) - 1)
                ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids).cast(kind)
                name = (part << 32) + k
                k += 1
                columns = ["segment", "term", "places", "ids"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([DOCS], pa.int64()),
                     pa.array([bounds.astype(np.int64).tobytes()], pa.binary()), ids],
                    names=columns,
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, name, np.int64)), pa.array(ranked[cuts], pa.int64()),
                     places, pa.nulls(n, kind)],
                    names=columns,
                )

    return run


def positional_index(
    docs: DataFrame, segment_bytes: int = 4 << 20, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(segment, term, places, ids): posting lists, and one row of documents per segment."""
    rows = pick(docs, id_column, text)
    schema = T.StructType(
        [
            T.StructField("segment", T.LongType()),
            T.StructField("term", T.LongType()),
            T.StructField("places", T.BinaryType()),
            T.StructField("ids", T.ArrayType(rows.schema[0].dataType)),
        ]
    )
    return written(rows.mapInArrow(_lists(segment_bytes), schema))


def _windows(benchmark: DataFrame, id_column: str, text: str, width: int, most: int):
    """Blocks of at most ``most`` windows: {length: (matrix of terms, item of each row)}."""
    block, held = {}, 0
    for item, body in pick(benchmark, id_column, text).toLocalIterator():
        data = np.frombuffer((body or "").encode(), dtype=np.uint8)
        terms, _ = _terms(data, np.array([0, len(data)]))
        if not len(terms):
            continue
        length = min(width, len(terms))
        rows = np.lib.stride_tricks.sliding_window_view(terms, length)
        first = 0
        while first < len(rows):
            taken = rows[first : first + most - held]
            block.setdefault(length, []).append((taken, None if item is None else str(item)))
            first, held = first + len(taken), held + len(taken)
            if held >= most:
                yield _packed(block)
                block, held = {}, 0
    if block:
        yield _packed(block)


def _packed(block):
    out = {}
    for length, parts in block.items():
        matrix = np.concatenate([m for m, _ in parts])
        owner = np.repeat(np.arange(len(parts)), [len(m) for m, _ in parts])
        rows, which = np.unique(matrix, axis=0, return_inverse=True)
        order = np.argsort(which.ravel(), kind="stable")
        cuts = np.searchsorted(which.ravel()[order], np.arange(len(rows) + 1))
        out[length] = (rows, owner[order], cuts, [i for _, i in parts])
    return out


class _Segment:
    """The posting lists of a segment that a block needs."""

    def __init__(self, table: pa.Table):
        terms = table["term"].to_numpy()
        row = int(np.flatnonzero(terms == DOCS)[0])
        blobs = table["places"].to_pylist()
        self.ids = table["ids"][row]
        self.bounds = np.frombuffer(blobs[row], dtype=np.int64)
        order = [i for i in np.argsort(terms, kind="stable") if i != row]
        self.terms = terms[order]
        lists = [np.frombuffer(blobs[i], dtype=np.uint32) for i in order]
        self.sizes = np.array([len(x) for x in lists], dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])
        self.places = np.concatenate(lists).astype(np.int64) if lists else np.zeros(0, np.int64)
        self.keys = np.repeat(np.arange(len(lists)), self.sizes) * _ROOM + self.places

    def matches(self, windows: np.ndarray, slop: int):
        """(window, start, text) where every list agrees to within ``slop`` places."""
        none = np.zeros(0, np.int64)
        if not len(self.terms) or not len(windows):
            return none, none, none
        at = np.searchsorted(self.terms, windows)
        at[at == len(self.terms)] = 0
        live = np.flatnonzero((self.terms[at] == windows).all(axis=1))
        at = at[live]
        ranks = np.argsort(self.sizes[at], axis=1, kind="stable")
        rarest = at[np.arange(len(at)), ranks[:, 0]]
        found = []
        step, low = (1 << 21) // (2 * slop + 1), 0
        total = np.cumsum(self.sizes[rarest])
        while low < len(live):
            high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + step)))
            w, s, text = self._from(at[low:high], ranks[low:high], rarest[low:high], slop)
            found.append((live[low:high][w], s, text))
            low = high
        return tuple(map(np.concatenate, zip(*found))) if found else (none, none, none)

    def _from(self, at, ranks, rarest, slop):
        length = at.shape[1]
        sizes = self.sizes[rarest]
        w = np.repeat(np.arange(len(at)), sizes)
        inner = np.arange(len(w)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        place = self.places[self.first[rarest][w] + inner]
        text = np.searchsorted(self.bounds, place, side="right") - 1
        s = place - ranks[w, 0]
        if slop:  # the rarest word may be off as well
            shifts = np.arange(-slop, slop + 1)
            s = (s[:, None] + shifts).ravel()
            w, text = np.repeat(w, len(shifts)), np.repeat(text, len(shifts))
        ok = (s >= self.bounds[text] - slop) & (s + length <= self.bounds[text + 1] + slop)
        w, s, text = w[ok], s[ok], text[ok]
        for k in range(1, length):
            if not len(w):
                break
            shift = ranks[w, k]
            room = at[w, shift] * _ROOM
            low = room + np.maximum(s + shift - slop, self.bounds[text])
            high = room + np.minimum(s + shift + slop, self.bounds[text + 1] - 1)
            near = np.searchsorted(self.keys, low)
            near[near == len(self.keys)] = len(self.keys) - 1
            ok = (self.keys[near] >= low) & (self.keys[near] <= high)
            w, s, text = w[ok], s[ok], text[ok]
        if slop and len(w):  # a start that several places of the rarest word lead to
            order = np.lexsort((s, text, w))
            w, s, text = w[order], s[order], text[order]
            ok = np.ones(len(w), bool)
            ok[1:] = (np.diff(w) != 0) | (np.diff(text) != 0) | (np.diff(s) != 0)
            w, s, text = w[ok], s[ok], text[ok]
        return w, s, text


def _inexact(exact, close, slop: int):
    """The first of adjacent starts in ``close``, without those at an exact match of the window."""
    w, s, text = close
    if not len(w):
        return close
    order = np.lexsort((exact[1], exact[0]))
    known = exact[0][order] * _ROOM + exact[1][order]
    at = np.searchsorted(known, w * _ROOM + s - slop)
    far = np.append(known, np.iinfo(np.int64).max)[at] > w * _ROOM + s + slop
    w, s, text = w[far], s[far], text[far]
    first = np.ones(len(w), bool)
    first[1:] = (np.diff(w) != 0) | (np.diff(text) != 0) | (np.diff(s) != 1)
    return w[first], s[first], text[first]


def _search(block, slop: int, schema: pa.Schema):
    def run(table: pa.Table) -> pa.Table:
        here = _Segment(table)
        n = len(here.bounds) - 1
        items: list[set] = [set() for _ in range(n)]
        near: list[list] = [[] for _ in range(n)]
        step = np.zeros(int(here.bounds[-1]) + 1, dtype=np.int64)
        for length, (windows, owner, cuts, names) in block.items():
            exact = here.matches(windows, 0)
            w, s, text = exact
            np.add.at(step, s, 1)
            np.add.at(step, s + length, -1)
            for one, doc in {(int(a), int(b)) for a, b in zip(w, text)}:
                items[doc].update(names[o] for o in owner[cuts[one] : cuts[one + 1]])
            if slop:
                w, s, text = _inexact(exact, here.matches(windows, slop), slop)
                for one, start, doc in zip(w.tolist(), s.tolist(), text.tolist()):
                    start = max(start - int(here.bounds[doc]), 0)
                    for o in owner[cuts[one] : cuts[one + 1]]:
                        near[doc].append({"item": names[o], "start": start, "length": length})
        hit = np.cumsum(step[:-1]) > 0
        totals = np.concatenate([[0], np.cumsum(hit)])
        count = np.diff(totals[here.bounds])
        runs = [[] for _ in range(n)]
        for i in np.flatnonzero(count):
            mine = hit[here.bounds[i] : here.bounds[i + 1]]
            edges = np.flatnonzero(np.diff(np.concatenate([[0], mine, [0]]).astype(np.int8)))
            runs[i] = [{"start": int(a), "length": int(b - a)} for a, b in edges.reshape(-1, 2)]
        return pa.table(
            [
                pa.array([table["segment"][0].as_py()] * n, pa.int64()),
                pa.array(np.arange(n, dtype=np.int64)),
                here.ids.values,
                pa.array(np.diff(here.bounds).astype(np.int64)),
                pa.array(runs, schema.field("runs").type),
                pa.array([sorted(x - {None}) for x in items], pa.list_(pa.string())),
                pa.array(near, schema.field("near").type),
            ],
            names=schema.names,
        )

    return run


def overlaps(
    docs: DataFrame, benchmark: DataFrame, width: int = 10, slop: int = 0,
    block: int = 100_000, segment_bytes: int = 4 << 20,
    id_column: str = "doc_id", text: str = "text", item_column: str = "item_id",
) -> DataFrame:
    """(doc_id, n_words, n_hit, runs, items, near) of every document.

    ``runs`` are the stretches of words inside exact matches of a window of ``width`` words
    (of a whole item that is shorter), ``items`` the items those windows come from and
    ``near`` the proximity matches that are not exact, where ``slop`` is above zero.

    Null and empty texts have no words and no matches, items without words have no window,
    an item without an id marks words but is not listed, and items that share an id count
    once.  Rows repeated in full stay.  An empty benchmark marks nothing.
    """
    index = positional_index(docs, segment_bytes, id_column, text)
    run = "array<struct<start: long, length: long>>"
    schema = (
        f"segment long, ordinal long, doc_id {index.schema['ids'].dataType.elementType.simpleString()}, "
        f"n_words long, runs {run}, items array<string>, "
        "near array<struct<item: string, start: long, length: long>>"
    )
    arrow = pa.schema(
        [("segment", pa.int64()), ("ordinal", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
         ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
         ("items", pa.list_(pa.string())),
         ("near", pa.list_(pa.struct([("item", pa.string()), ("start", pa.int64()), ("length", pa.int64())])))]
    )
    found, count = None, 0
    for windows in _windows(benchmark, item_column, text, width, block):
        part = _searched(index, windows, slop, schema, arrow)
        found, count = part if found is None else found.union(part), count + 1
    if found is None:
        found, count = _searched(index, {}, slop, schema, arrow), 1
    if count > 1:
        found = found.groupBy("segment", "ordinal").agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list("runs")).alias("runs"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
            F.flatten(F.collect_list("near")).alias("near"),
        )
        places = F.flatten(
            F.transform("runs", lambda r: F.sequence(r["start"], r["start"] + r["length"] - 1))
        )
        n_hit = F.size(F.array_distinct(places)).cast("long")
    else:
        n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + r["length"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), "runs", "items", "near")


def _searched(index: DataFrame, windows, slop: int, schema: str, arrow: pa.Schema) -> DataFrame:
    terms = {DOCS}.union(*[np.unique(rows).tolist() for rows, *_ in windows.values()])
    vocabulary = index.sparkSession.createDataFrame([(t,) for t in sorted(terms)], "term long")
    # At most ``width`` terms of 8 bytes for each window of a block: 8 MB at the defaults.
    needed = index.join(F.broadcast(vocabulary), "term", "left_semi")
    return needed.groupBy("segment").applyInArrow(_search(windows, slop, arrow), schema)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, width: int = 10, by_row: bool = False
) -> DataFrame:
    """The rows of ``docs`` with no exact match, all columns kept.

    Rows are told apart by their id, and rows that share one, or have none, are judged
    together.  With ``by_row`` each is judged by its own text: rows are told apart by their
    id and a hash of the text, so that a match takes no other text with it.
    """
    if not by_row:
        hit = overlaps(docs, benchmark, width).where("n_hit > 0").select("doc_id").distinct()
        return keep_rows(docs, "doc_id", hit, "left_anti")
    columns = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    doc, text = f"c{place(columns, 'doc_id')}", f"c{place(columns, 'text')}"
    keyed = plain.withColumn("_id", F.struct(F.col(doc).alias("doc_id"), text_key(F.col(text)).alias("key")))
    texts = keyed.select("_id", F.col(text).alias("text"))
    hit = overlaps(texts, benchmark, width, id_column="_id").where("n_hit > 0")
    hit = hit.select(F.col("doc_id.doc_id").alias("_hit"), F.col("doc_id.key").alias("_key")).distinct()
    same = F.col(doc).eqNullSafe(F.col("_hit")) & (F.col("_id.key") == F.col("_key"))
    return keyed.join(hit, same, "left_anti").drop("_id").toDF(*columns)
