"""Removal of passages that occur earlier, by prefix-partitioned suffix trees.

A suffix starts at every word with ``depth`` words ahead of it in its document.  Wanted are
the internal nodes at least ``depth`` words deep: the words above one occur at all its leaves.

1. Leaves that matter.  Of the phrases of ``stem`` words inside its first ``depth`` words,
   each suffix names the one with the smallest hash; equal passages name the same phrase.
   Where that phrase occurs once in the corpus no deep node can be above the suffix, and it
   is dropped.  Six in seven phrases are never named, so little is shuffled.
2. Prefixes of variable length.  A suffix is known by a code of 64 bits, in order: bits of
   its first word, of its first two, its first four, and all ``depth``; so the order of codes
   is one of a tree whose upper branches are these prefixes.  Codes are cut into ranges of
   about equal load, at splitters taken from a sample: a rare first word shares its range with
   others, a frequent one is split by its second word, fourth, and on.  A range fits memory.
3. Subtrees.  A range sorted by code and a second hash of all ``depth`` words has the leaves
   below one node of that depth side by side; the earliest is the node's first occurrence, and
   every other leaf is told where that is.  Trees end at this depth.
4. Maximal repeats.  The suffix link of a deeper node leads to that of the next word, so a
   repeat of any length shows in its document as leaves in a row whose first occurrences are
   in a row too.  Such a stretch, as long as it goes, is a repeat; its later words go.

Documents are dealt to segments of about ``segment`` bytes by a hash of id and text, so no
source, id or group of copies fills one.  Rows that agree in both are joined, with a count,
where they are read and again in their segment.  Before anything is shuffled, a segment also
joins the suffixes that are equal inside it; a passage that a third of all documents share
costs one entry per segment.  What travels is packed arrays, not rows.

Hashes have 64 bits for words and over 80 for prefixes of full depth; among 10**11 suffixes
the chance of any two different ones agreeing is below 10**-2.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.common import pick, text_key
from rowsmith.llm.words import (
    NOT_SPACE, U64, blocks, mixed, run_hashes, spans, word_hashes,
)

_OTHER = 0xA0761D6478BD642F
_LATE = 1 << 62
_ANEW = U64(0xE7037ED1A0B428DB)


def _windowed(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """The least (or greatest) of each ``width`` neighbours, by doubling."""
    pick_ = np.minimum if least else np.maximum
    have, out = 1, values
    while have * 2 <= width:
        out = pick_(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = pick_(out[: len(values) - width + 1], out[width - have :][: len(values) - width + 1])
    return out


def _words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words in a row, and the number of words of each text."""
    hashes, counts = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
    for _, data, offsets in blocks(column):
        starts, ends = spans(data, offsets, NOT_SPACE)
        hashes.append(word_hashes(data, starts, ends))
        counts.append(np.diff(np.searchsorted(starts, offsets)))
    return np.concatenate(hashes), np.concatenate(counts)


def _codes(words: np.ndarray, depth: int, places: np.ndarray) -> np.ndarray:
    """Codes of suffixes: those with a common prefix of 1, 2 or 4 words stand together."""
    code = (words[places] >> U64(52)) << U64(52)
    code |= (run_hashes(words, min(2, depth))[places] >> U64(52)) << U64(40)
    code |= (run_hashes(words, min(4, depth))[places] >> U64(48)) << U64(24)
    return code | run_hashes(words, depth)[places] >> U64(40)


def _inside(n_words: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The document of each word, and whether ``depth`` words from it on lie in that document."""
    owner = np.repeat(np.arange(len(n_words)), n_words)
    n = max(0, len(owner) - depth + 1)
    return owner, owner[:n] == owner[depth - 1 :][:n]


class Segment:
    """The suffixes of a segment's documents, in the order of document and place.

    Rows with equal id and text are one document; ``times`` counts them.
    """

    def __init__(self, docs: pa.Table, depth: int, stem: int):
        key, tie = docs["doc_key"].to_numpy(), docs["tie"].to_numpy()
        bare = docs["text"].is_null().to_numpy()
        order = np.lexsort((bare, tie, key))
        key, tie = key[order], tie[order]
        lead = np.flatnonzero(_firsts(key, tie))
        self.times = np.add.reduceat(docs["n"].to_numpy()[order], lead)
        self.docs = docs = docs.take(pa.array(order[lead]))
        self.keys = key[lead]
        words, self.n_words = _words_of(docs["text"])
        self.words = words
        self.first = np.concatenate([[0], np.cumsum(self.n_words)])
        self.depth = depth
        self.owner, self.inside = _inside(self.n_words, depth)
        n = len(self.inside)
        phrases = run_hashes(words, stem)
        width = depth - stem + 1
        self.named = _windowed(phrases, width, True) if n else np.zeros(0, U64)
        if n:
            # A phrase is named where some window over it has it as its smallest.
            seen = np.where(self.inside, self.named, U64(0))
            pad = np.zeros(width - 1, U64)
            most = _windowed(np.concatenate([pad, seen, pad]), width, False)
            chosen = np.sort(phrases[: len(most)][(most == phrases[: len(most)])])
        else:
            chosen = np.zeros(0, U64)
        new = np.ones(len(chosen), dtype=bool)
        new[1:] = chosen[1:] != chosen[:-1]
        # The smallest of several hashes are small ones; mixed anew they spread evenly.
        self.named = mixed(self.named ^ _ANEW)
        self.phrases = np.sort(mixed(chosen[new] ^ _ANEW))
        self.twice = np.sort(mixed(np.unique(chosen[~new]) ^ _ANEW))

    def leaves(self, shared: np.ndarray):
        """(place, code, check) of suffixes that some other may equal, by code and place."""
        live = np.union1d(self.twice, shared)
        if not len(live) or not len(self.named):
            empty = np.zeros(0, np.int64)
            return empty, empty.astype(U64), empty.astype(U64)
        at = np.searchsorted(live, self.named)
        at[at == len(live)] = 0
        places = np.flatnonzero((live[at] == self.named) & self.inside)
        code = _codes(self.words, self.depth, places)
        check = run_hashes(self.words, self.depth, _OTHER)[places]
        order = np.lexsort((places, check, code))
        return places[order], code[order], check[order]

    def own(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document key, place in that document)."""
        doc = self.owner[places]
        return self.keys[doc], (places - self.first[doc]).astype(np.int32)


def _firsts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return new


def _runs(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of a sorted array, and where each of them begins, with the end."""
    begins = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]])[: len(parts)])
    return parts[begins], np.append(begins, len(parts))


def _blobs(values: np.ndarray, cuts: np.ndarray) -> list[bytes]:
    return [values[a:b].tobytes() for a, b in itertools.pairwise(cuts)]


def _sent(docs: pa.Table, parts: np.ndarray, arrays, schema: pa.Schema) -> pa.Table:
    """One packed row for every range that the segment holds anything of."""
    held, cuts = _runs(parts)
    seg = np.full(len(held), docs["seg"][0].as_py(), np.int32)
    return pa.table([held.astype(np.int32), seg, *(_blobs(a, cuts) for a in arrays)], schema=schema)


def _combined(schema: pa.Schema):
    """Rows of one partition that agree in key and text become one row and a count."""

    def run(batches):
        more = {}
        for batch in batches:
            ids, keys, ties = (batch.column(i).to_pylist() for i in range(3))
            fresh = []
            for doc_id, key, tie in zip(ids, keys, ties):
                fresh.append((key, tie) not in more)
                more[key, tie] = (doc_id, 0 if fresh[-1] else more[key, tie][1] + 1)
            one = pa.array(np.ones(len(fresh), np.int64))
            whole = pa.RecordBatch.from_arrays([*batch.columns, one], schema=schema)
            yield whole.filter(pa.array(fresh, pa.bool_()))
        again = [(doc_id, key, tie, None, n) for (key, tie), (doc_id, n) in more.items() if n]
        columns = zip(*again) if again else [[]] * len(schema)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema
        )

    return run


def _sampled(depth: int, thin: int):
    """Codes of one in ``thin`` different suffixes."""

    def run(batches):
        for batch in batches:
            words, n_words = _words_of(batch.column(0))
            places = np.flatnonzero(_inside(n_words, depth)[1])
            code = np.unique(_codes(words, depth, places))
            code = code[mixed(code ^ _ANEW) % U64(thin) == 0]
            yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64))], names=["code"])

    return run


def _phrases_of(depth: int, stem: int, groups: int, schema: pa.Schema):
    def run(docs: pa.Table) -> pa.Table:
        here = Segment(docs, depth, stem)
        parts = (here.phrases >> U64(32)) * U64(groups) >> U64(32)
        return _sent(docs, parts, [here.phrases], schema)

    return run


def _joined(table: pa.Table, column: str, kind) -> tuple[np.ndarray, np.ndarray]:
    """All arrays of a packed column in a row, and the row each entry came from."""
    parts = [np.frombuffer(b, dtype=kind) for b in table[column].to_pylist()]
    lengths = [len(p) for p in parts]
    return np.concatenate(parts), np.repeat(np.arange(len(parts)), lengths)


def _shared_phrases(schema: pa.Schema):
    """Phrases that more than one segment named, back to those segments."""

    def run(table: pa.Table) -> pa.Table:
        values, row = _joined(table, "a", U64)
        order = np.argsort(values, kind="stable")
        values, row = values[order], row[order]
        same = np.zeros(len(values) + 1, dtype=bool)
        same[1:-1] = values[1:] == values[:-1]
        shared = same[:-1] | same[1:]
        values, row = values[shared], row[shared]
        order = np.argsort(row, kind="stable")
        held, cuts = _runs(row[order])
        none = pa.nulls(len(held), pa.binary())
        return pa.table(
            [table["seg"].take(pa.array(held)), np.full(len(held), -1, np.int32),
             _blobs(values[order], cuts), none, none],
            schema=schema,
        )

    return run


def _shared_of(back: pa.Table) -> np.ndarray:
    mine = back.filter(pa.compute.equal(back["part"], -1)) if len(back) else back
    return np.unique(_joined(mine, "a", U64)[0]) if len(mine) else np.zeros(0, U64)


def _suffixes_of(depth: int, stem: int, splitters: np.ndarray, schema: pa.Schema):
    """The first of each leaf that others may share a node with, by range of prefixes."""

    def run(docs: pa.Table, back: pa.Table) -> pa.Table:
        if not len(docs):
            return schema.empty_table()
        here = Segment(docs, depth, stem)
        places, code, check = here.leaves(_shared_of(back))
        new = _firsts(code, check)
        code, check = code[new], check[new]
        parts = np.searchsorted(splitters, code, side="right")
        return _sent(docs, parts, [code, check, *here.own(places[new])], schema)

    return run


def _nodes(schema: pa.Schema):
    """The subtrees of a range: for each later leaf of a node, the node's first occurrence.

    Leaves of one id in different segments follow each other by segment, a hash of the text.
    """

    def run(table: pa.Table) -> pa.Table:
        code, row = _joined(table, "a", U64)
        check, _ = _joined(table, "b", U64)
        keys, _ = _joined(table, "c", np.int64)
        places, _ = _joined(table, "d", np.int32)
        order = np.lexsort((table["seg"].to_numpy()[row], keys, check, code))
        first = _firsts(code[order], check[order])
        late = np.empty(len(code), dtype=bool)
        late[order] = ~first
        lead = np.empty(len(code), dtype=np.int64)
        lead[order] = order[np.maximum.accumulate(np.where(first, np.arange(len(code)), 0))]
        cuts = np.searchsorted(row, np.arange(len(table) + 1))
        told = np.concatenate([[0], np.cumsum(late)])[cuts]
        return pa.table(
            [
                table["seg"],
                table["part"],
                [np.packbits(late[a:b]).tobytes() for a, b in itertools.pairwise(cuts)],
                _blobs(keys[lead[late]], told),
                _blobs(places[lead[late]], told),
            ],
            schema=schema,
        )

    return run


def _stretches(place: np.ndarray, owner: np.ndarray, key: np.ndarray, at: np.ndarray):
    """Where leaves in a row, with first occurrences in a row, begin; with the end."""
    new = np.ones(len(place), dtype=bool)
    new[1:] = (
        (np.diff(place) != 1) | (np.diff(owner) != 0) | (np.diff(key) != 0) | (np.diff(at) != 1)
    )
    return np.append(np.flatnonzero(new), len(place))


def _kept(depth: int, stem: int, splitters: np.ndarray, schema: pa.Schema):
    def sources(here: Segment, back: pa.Table):
        """(place, key and place of the first occurrence) of all later leaves, by place."""
        places, code, check = here.leaves(_shared_of(back))
        new = _firsts(code, check)
        parts = np.searchsorted(splitters, code[new], side="right")
        late = np.zeros(len(parts), dtype=bool)
        key, at = here.own(places[new])
        for row in back.to_pylist():
            if row["part"] >= 0:
                low, high = np.searchsorted(parts, [row["part"], row["part"] + 1])
                bits = np.unpackbits(np.frombuffer(row["a"], np.uint8), count=high - low)
                told = low + np.flatnonzero(bits)
                late[told] = True
                key[told] = np.frombuffer(row["b"], np.int64)
                at[told] = np.frombuffer(row["c"], np.int32)
        node = np.cumsum(new) - 1
        later = ~new | late[node]
        order = np.argsort(places[later])
        node = node[later][order]
        return places[later][order], key[node], at[node]

    def run(docs: pa.Table, back: pa.Table) -> pa.Table:
        if not len(docs):
            return schema.empty_table()
        here = Segment(docs, depth, stem)
        place, key, at = sources(here, back)
        step = np.zeros(len(here.words) + 1, dtype=np.int32)
        np.add.at(step, place, 1)
        np.add.at(step, place + depth, -1)
        gone = np.cumsum(step[:-1]) > 0
        owner = here.owner[place]
        edges = _stretches(place, owner, key, at)
        begins = edges[:-1]
        rows, times, removed, texts = [], [], [], []
        counts, found = [], []  # of each row: its repeats, as columns

        def put(doc, n, gone_here, words, begin, length, source, there):
            rows.append(doc)
            times.append(n)
            removed.append(int(gone_here.sum()))
            texts.append(b" ".join(itertools.compress(words, ~gone_here) if removed[-1] else words))
            counts.append(len(begin))
            found.append((begin, length, source, there))

        of_doc = np.searchsorted(owner[begins], np.arange(len(here.n_words) + 1))
        for i, text in enumerate(here.docs["text"].cast(pa.large_binary()).to_pylist()):
            words = (text or b"").split()
            low, high = here.first[i], here.first[i + 1]
            b = begins[of_doc[i] : of_doc[i + 1]]
            length = edges[of_doc[i] + 1 : of_doc[i + 1] + 1] - b + depth - 1
            put(i, 1, gone[low:high], words, place[b] - low, length, key[b], at[b])
            if here.times[i] > 1:  # the copies under the same id: every leaf is a later one
                n = max(0, len(words) - depth + 1)
                source, there = np.full(n, here.keys[i]), np.arange(n, dtype=np.int32)
                mine = slice(*np.searchsorted(place, [low, high]))
                source[place[mine] - low], there[place[mine] - low] = key[mine], at[mine]
                cut = _stretches(np.arange(n), np.zeros(n), source, there)
                b, length = cut[:-1], np.diff(cut) + depth - 1
                all_gone = np.full(len(words), n > 0)
                put(i, here.times[i] - 1, all_gone, words, b, length, source[b], there[b])
        begin, length, source, there = (np.concatenate(c) for c in zip(*found))
        repeats = pa.StructArray.from_arrays(
            [pa.array(begin.astype(np.int64)), pa.array(length.astype(np.int64)),
             pa.array(source.astype(np.int64), mask=source >= _LATE), pa.array(there.astype(np.int64))],
            fields=list(schema.field("repeats").type.value_type),
        )
        ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        return pa.table(
            [
                here.docs["doc_id"].take(pa.array(rows)),
                pa.array(here.n_words[rows], pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(texts, pa.binary()).cast(pa.string()),
                pa.ListArray.from_arrays(pa.array(ends), repeats, type=schema.field("repeats").type),
                pa.array(times, pa.int64()),
            ],
            schema=schema,
        )

    return run


def _splitters(rows: DataFrame, size: int, depth: int, groups: int, sample: int) -> np.ndarray:
    """Codes that cut all suffixes into ``groups`` ranges of about equal load.

    They come from the texts of about ``sample`` bytes and at most some 16 codes a range;
    they decide where suffixes are compared, never whether.
    """
    every = max(1, size // sample)
    some = rows.where(F.pmod(F.xxhash64("tie", "doc_key"), F.lit(every)) == 0).select("text")
    thin = max(1, min(size, sample) // 6 // (16 * groups))
    codes = some.mapInArrow(_sampled(depth, thin), "code long").distinct().toPandas()["code"]
    codes = np.sort(codes.to_numpy().astype(np.int64).view(U64))
    at = np.arange(1, groups) * len(codes) // groups
    return np.unique(codes[at]) if len(codes) else codes


def remove_repeats(
    docs: DataFrame, depth: int = 20, stem: int = 8, segment: int = 6 << 20, sample: int = 16 << 20,
    id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_removed, text, repeats) of every row.

    ``text`` holds the words that stay, joined by one space.  ``repeats`` lists the maximal
    repeats that make the others go: (start, length, first_doc, first_start), all of whose
    windows of ``depth`` words occur first there, in word numbers; they may overlap, and
    ``first_doc`` is null where that document has no id.  Ids must be integers below 2**62;
    rows without one count as the last documents, in the order of a hash of their texts.  Rows
    with the same id follow each other by hashes of their texts, whatever their order in the
    input.  Null and empty texts have no words.  No rows give no rows.
    """
    rows = pick(docs, id_column, text).toDF("doc_id", "text")
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("long"))
    hidden = F.lit(_LATE) + F.shiftrightunsigned(F.xxhash64("text"), 2)
    rows = rows.select(
        "doc_id", F.coalesce("doc_id", hidden).alias("doc_key"), text_key(F.col("text")).alias("tie"), "text"
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    segments = max(48, size // segment)
    groups = max(24, segments // 8)
    splitters = _splitters(rows, size, depth, groups, sample)
    long, packed = pa.int64(), pa.binary()
    plain = pa.schema([("doc_id", long), ("doc_key", long), ("tie", long), ("text", pa.string()), ("n", long)])
    rows = rows.mapInArrow(_combined(plain), "doc_id long, doc_key long, tie long, text string, n long")
    rows = rows.withColumn("seg", F.pmod(F.xxhash64("doc_key", "tie"), F.lit(segments)).cast("int"))
    by_segment = rows.groupBy("seg")
    sent = pa.schema([("part", pa.int32()), ("seg", pa.int32()), ("a", packed)])
    suffixes = pa.schema([*sent, ("b", packed), ("c", packed), ("d", packed)])
    told = pa.schema([("seg", pa.int32()), ("part", pa.int32()), ("a", packed), ("b", packed), ("c", packed)])
    run = pa.list_(pa.struct([("start", long), ("length", long), ("first_doc", long), ("first_start", long)]))
    out = pa.schema(
        [("doc_id", long), ("n_words", long), ("n_removed", long), ("text", pa.string()),
         ("repeats", run), ("times", long)]
    )
    reply = "seg int, part int, a binary, b binary, c binary"
    shared = (
        by_segment.applyInArrow(_phrases_of(depth, stem, groups, sent), "part int, seg int, a binary")
        .groupBy("part")
        .applyInArrow(_shared_phrases(told), reply)
    )
    late = (
        by_segment.cogroup(shared.groupBy("seg"))
        .applyInArrow(
            _suffixes_of(depth, stem, splitters, suffixes),
            "part int, seg int, a binary, b binary, c binary, d binary",
        )
        .groupBy("part")
        .applyInArrow(_nodes(told), reply)
    )
    kept = by_segment.cogroup(shared.union(late).groupBy("seg")).applyInArrow(
        _kept(depth, stem, splitters, out),
        "doc_id long, n_words long, n_removed long, text string, repeats array<struct<"
        "start: long, length: long, first_doc: long, first_start: long>>, times long",
    )
    # Copies under one id come as one row and their number.
    return kept.withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).drop("_", "times")
