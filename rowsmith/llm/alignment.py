"""Alignment of two tokenizers' ids by galloping intersection of their end lists.

Both tokenizers cut the same bytes, a space and the text, so a token is known by the byte
after its last.  Of the two ascending lists of ends the shorter one drives: each of its ends
is searched in the longer list from where an end before it was found, in steps that double
until they pass it, then by halving the last step.  Ends found in both lists cut the text into
groups; the ranks of two neighbouring ends of the shorter list in the longer one bound the
tokens that overlap the token between them.

Texts are encoded by pieces that begin with a space between two visible characters.  Neither
vocabulary joins over such a place (the piece vocabulary is looked through for that), so the
ids of the pieces in a row are the text's own.  Pieces are known by 64-bit hashes of their
bytes; each process asks the libraries once for each.

How many documents link a pair of ids is counted over the whole corpus.  A block of documents
is one row of a written table and names each of its pairs once, with the number of its
documents that hold it; the sums go back to the blocks that named the pair.  No document is
shuffled pair by pair, and nothing is broadcast.
"""

from __future__ import annotations

import hashlib
import os

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rowsmith.llm.common import pick, written
from rowsmith.llm.words import blocks, lookup, word_hashes

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_STRIDE = 64  # every so many ends of the shorter list are searched first
_TOGETHER = 1000  # pieces encoded as one text
_VISIBLE = lookup(range(0x21, 0x7F))
#: First bytes of characters beyond ASCII of which none is white space.
_LEAD = lookup(b for b in range(0xC3, 0xF8) if b not in (0xE1, 0xE2, 0xE3))
_MARK = "▁"  # how pieces write a space


def vocabularies() -> tuple[str, str]:
    """The paths of the two public vocabulary files; they lie at the same place everywhere."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: visible bytes are
    themselves, the others follow from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _piece_bytes(piece: str) -> bytes:
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(_MARK, " ").encode()


class _Side:
    """What one tokenizer makes of the pieces seen so far."""

    def __init__(self, pieces: list[bytes], encode):
        self.bytes, self.encode = pieces, encode
        self.width = np.array([len(p) for p in pieces], dtype=np.int64)
        self.forget()

    def forget(self) -> None:
        self.ids = np.zeros(0, np.uint16)
        self.first = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)

    def learn(self, together: list[list[str]], alone: list[str]) -> list[bytes]:
        """Add the ids of these texts: lists of texts that may be joined by spaces, then
        others.  Returns the bytes of the tokens of each of the others."""
        ids, sizes = [], []
        for texts, found in zip(together, self.encode([" ".join(t) for t in together])):
            found = np.array(found, dtype=np.uint16)
            ends = np.cumsum(self.width[found])
            last = np.cumsum([len(t.encode()) + 1 for t in texts])
            at = np.searchsorted(ends, last) + 1
            if len(ends) != at[-1] or (ends[at - 1] != last).any():
                raise ValueError("a token goes on over a space between two words")
            ids.append(found)
            sizes.append(np.diff(at, prepend=0))
        others = self.encode(alone)
        ids += [np.array(found, dtype=np.uint16) for found in others]
        sizes.append(np.array([len(found) for found in others], dtype=np.int64))
        size = np.concatenate(sizes)
        self.first = np.concatenate([self.first, np.cumsum(size) - size + len(self.ids)])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, *ids])
        return [b"".join([self.bytes[i] for i in found]) for found in others]

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces in a row, and where each piece's ids begin, and the end."""
        size = self.size[rows]
        total = np.concatenate([[0], np.cumsum(size)])
        return self.ids[np.arange(total[-1]) + np.repeat(self.first[rows] - total[:-1], size)], total


class Pair:
    """Two tokenizers with a common store of pieces; ``most`` bounds it."""

    def __init__(self, bytes_path: str, pieces_path: str, most: int = 1_000_000):
        import sentencepiece
        from tokenizers import Tokenizer

        letters = _byte_letters()
        library = Tokenizer.from_file(bytes_path)
        library.encode_special_tokens = True
        shown = [library.id_to_token(i) for i in range(library.get_vocab_size())]
        one = [bytes(letters.get(c, 0x3F) for c in t) for t in shown]
        model = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        if max(len(one), len(pieces)) > 1 << 16:
            raise ValueError("vocabularies above 65,536 ids are not supported")
        # Texts may be cut before a space only if no piece goes on over one.
        self.cuts = not any(_MARK in p.lstrip(_MARK) for p in pieces)
        self.a = _Side(one, lambda texts: [
            e.ids for e in library.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        ])
        self.b = _Side([_piece_bytes(p) for p in pieces], lambda texts: model.encode(texts, num_threads=1))
        self.most = most
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.row = np.zeros(0, np.int64)
        self.whole = np.zeros(0, bool)
        self.a.forget()
        self.b.forget()

    def pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the pieces of all texts start and end, without the space before each."""
        starts = offsets[:-1][np.diff(offsets) > 0]
        inner = np.zeros(len(starts), dtype=bool)
        if self.cuts and len(data) > 2:
            before, after = data[:-2], data[2:]
            seen = _VISIBLE[before].copy()
            # The last character before the space, if it has two to four bytes.
            for back, least in ((1, 0xC3), (2, 0xE0), (3, 0xF0)):
                lead = data[: len(before) - back]
                seen[back:] |= (before[back:] >= 0x80) & (lead >= least) & _LEAD[lead]
            at = np.flatnonzero((data[1:-1] == 0x20) & seen & (_VISIBLE[after] | _LEAD[after])) + 1
            # Neither neighbour may belong to another text.
            text = np.searchsorted(offsets, at, side="right")
            at = at[(at > offsets[text - 1]) & (at + 1 < offsets[text])]
            starts = np.concatenate([starts, at + 1])
            order = np.argsort(starts, kind="stable")
            starts, inner = starts[order], order >= len(inner)
        # A piece ends at the space before the next one, or with its text.
        ends = np.append(starts[1:] - inner[1:], len(data))[: len(starts)]
        return starts, ends

    def _learn(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Encode new pieces; returns the order in which they were added, and for each in
        that order whether its tokens have its bytes."""
        joins = np.array([
            self.cuts and t[0].isprintable() and t[-1].isprintable() and t[0] != " " != t[-1]
            and _MARK not in t for t in texts
        ], dtype=bool)
        order = np.concatenate([np.flatnonzero(joins), np.flatnonzero(~joins)])
        n = int(joins.sum())
        sorted_ = [texts[k] for k in order.tolist()]
        together = [sorted_[k : min(k + _TOGETHER, n)] for k in range(0, n, _TOGETHER)]
        alone = sorted_[n:]
        one, other = self.a.learn(together, alone), self.b.learn(together, alone)
        whole = np.ones(len(texts), dtype=bool)
        whole[n:] = [x == y == (" " + t).encode() for t, x, y in zip(alone, one, other)]
        return order, whole

    def rows(self, data, starts, ends) -> np.ndarray:
        """The place in the store of each piece; new ones are encoded."""
        hashes = word_hashes(data, starts, ends)
        names, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, names)
        place[place == len(self.known)] = 0
        new = self.known[place] != names if len(self.known) else np.ones(len(names), bool)
        if new.any():
            if len(self.known) + new.sum() > self.most:
                self._forget()
                new[:] = True
            spots = at[new]
            low, high = starts[spots].tolist(), ends[spots].tolist()
            texts = [data[x:y].tobytes().decode() for x, y in zip(low, high)]
            order, whole = self._learn(texts)
            rows = np.empty(len(texts), dtype=np.int64)
            rows[order] = np.arange(len(texts)) + len(self.row)
            known = np.concatenate([self.known, names[new]])
            order = np.argsort(known, kind="stable")
            self.known, self.row = known[order], np.concatenate([self.row, rows])[order]
            self.whole = np.concatenate([self.whole, whole])
            place = np.searchsorted(self.known, names)
        return self.row[place][which]


def gallop(wanted: np.ndarray, longer: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The first place in ``longer``, from ``low`` on, that holds ``wanted`` or more.

    There is one for each.  Steps double until they pass it; the last step is halved.
    """
    low = low.copy()
    high = np.full(len(low), len(longer) - 1)
    live, step = np.arange(len(low)), 1
    while len(live):
        probe = np.minimum(low[live] + step - 1, len(longer) - 1)
        reached = longer[probe] >= wanted[live]
        high[live[reached]] = probe[reached]
        live = live[~reached]
        low[live] = probe[~reached] + 1
        step *= 2
    live = np.flatnonzero(low < high)
    while len(live):
        middle = (low[live] + high[live]) // 2
        reached = longer[middle] >= wanted[live]
        high[live[reached]] = middle[reached]
        low[live[~reached]] = middle[~reached] + 1
        live = live[low[live] < high[live]]
    return high


def intersect(short: np.ndarray, longer: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of each end of ``short`` the first place in ``longer`` that is not below it.

    ``first`` is a place in ``longer`` at or before the one of each end.  Every 64th end gallops
    from there, the ends after it from where it was found.
    """
    found = np.empty(len(short), dtype=np.int64)
    anchor = np.arange(0, len(short), _STRIDE)
    found[anchor] = gallop(short[anchor], longer, first[anchor])
    rest = np.delete(np.arange(len(short)), anchor)
    found[rest] = gallop(
        short[rest], longer, np.maximum(first[rest], found[rest // _STRIDE * _STRIDE])
    )
    return found


def overlaps(short: np.ndarray, longer: np.ndarray, first: np.ndarray, begins: np.ndarray):
    """(common, found, from, to): the shared ends and each short token's partners.

    ``begins`` marks the first token of each text in ``short``; all texts end in both lists.
    Token k of ``short`` overlaps the tokens ``from[k]`` to ``to[k]`` of ``longer``.
    """
    found = intersect(short, longer, first)
    common = longer[found] == short
    after = found + common
    start = np.empty_like(found)
    start[1:] = after[:-1]
    start[begins] = first[begins]
    return common, found, start, found


def _digits(most: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of all numbers below ``most``, and how many each has."""
    shown = np.char.encode(np.arange(most).astype(str), "ascii").astype("S6")
    return shown.view(np.uint8).reshape(most, 6), np.char.str_len(shown)


_DIGITS = _digits(1 << 16)


def _lines(ids: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every id in digits with its mark after it, and where each begins, and the end."""
    table, size = _DIGITS
    size = size[ids] + 1
    at = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(at[-1], dtype=np.uint8)
    for digit in range(5):
        has = size > digit + 1
        out[at[:-1][has] + digit] = table[ids[has], digit]
    out[at[1:] - 1] = marks
    return out, at


class Aligned:
    """Both tokenizers' ids of some texts, their groups and links."""

    def __init__(self, pair: Pair, data: np.ndarray, offsets: np.ndarray):
        n = len(offsets) - 1
        starts, ends = pair.pieces(data, offsets)
        rows = pair.rows(data, starts, ends) if len(starts) else np.zeros(0, np.int64)
        text = np.searchsorted(offsets, starts, side="right") - 1
        # A text whose bytes are not those of its tokens has none.
        whole = pair.whole[rows] if len(rows) else np.zeros(0, bool)
        bad = np.zeros(n, dtype=bool)
        bad[text[~whole]] = True
        keep = ~bad[text]
        rows, text = rows[keep], text[keep]
        edges = np.searchsorted(text, np.arange(n + 1))
        (self.a, at), (self.b, bt) = pair.a.of(rows), pair.b.of(rows)
        self.a_first, self.b_first = at[edges], bt[edges]
        self.n_a, self.n_b = np.diff(self.a_first), np.diff(self.b_first)
        ends_a = np.cumsum(pair.a.width[self.a])
        ends_b = np.cumsum(pair.b.width[self.b])
        common_a = np.zeros(len(self.a), dtype=bool)
        common_b = np.zeros(len(self.b), dtype=bool)
        link_a, link_b = [], []
        for a_drives in (True, False):
            driven = (self.n_a <= self.n_b) == a_drives
            sides = (self.n_a, self.a_first, ends_a, common_a), (self.n_b, self.b_first, ends_b, common_b)
            (n_s, s_first, s_ends, s_common), (_, l_first, l_ends, l_common) = sides[:: 1 if a_drives else -1]
            which = np.flatnonzero(np.repeat(driven, n_s))
            if not len(which):
                continue
            owner = np.repeat(np.arange(n), n_s)[which]
            begins = which == s_first[owner]
            common, found, low, high = overlaps(s_ends[which], l_ends, l_first[owner], begins)
            s_common[which[common]] = True
            l_common[found[common]] = True
            times = high - low + 1
            mine = np.repeat(which, times)
            theirs = np.arange(len(mine)) + np.repeat(low - np.cumsum(times) + times, times)
            link_a.append(mine if a_drives else theirs)
            link_b.append(theirs if a_drives else mine)
        none = [np.zeros(0, np.int64)]
        self.link_a = np.concatenate(link_a or none)
        self.link_b = np.concatenate(link_b or none)
        self.link_text = np.searchsorted(self.a_first, self.link_a, side="right") - 1
        self.common_a, self.common_b = common_a, common_b
        in_groups = np.concatenate([[0], np.cumsum(common_a)])
        self.n_groups = np.diff(in_groups[self.a_first])
        self.n_links = np.bincount(self.link_text, minlength=n)

    def groups(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each text."""
        group_a = np.cumsum(self.common_a) - self.common_a
        group_b = np.cumsum(self.common_b) - self.common_b
        b_before = np.searchsorted(group_b, group_a)
        a_before = np.searchsorted(group_a, group_b, side="right")
        ids = np.empty(len(self.a) + len(self.b), dtype=np.uint16)
        marks = np.empty(len(ids), dtype=np.uint8)
        spot_a, spot_b = np.arange(len(self.a)) + b_before, np.arange(len(self.b)) + a_before
        ids[spot_a], ids[spot_b] = self.a, self.b
        marks[spot_a] = np.where(self.common_a, ord("|"), ord(","))
        marks[spot_b] = np.where(self.common_b, ord(";"), ord(","))
        out, at = _lines(ids, marks)
        edges = at[self.a_first + self.b_first].tolist()
        return [out[a : max(a, b - 1)].tobytes() for a, b in zip(edges, edges[1:])]

    def pairs(self):
        """(pairs, times, first): each text's distinct id pairs, a * 65536 + b, with how many
        links each has, and the places where texts begin, and the end."""
        code = self.a[self.link_a].astype(np.uint64) << np.uint64(16) | self.b[self.link_b]
        key = np.sort(self.link_text.astype(np.uint64) << np.uint64(32) | code)
        new = np.ones(len(key), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        at = np.flatnonzero(new)
        times = np.diff(np.append(at, len(key)))
        key = key[at]
        first = np.searchsorted(key >> np.uint64(32), np.arange(len(self.n_a) + 1).astype(np.uint64))
        return (key & np.uint64(0xFFFFFFFF)).astype(np.int64), times, first


_OPEN: dict[tuple[str, str], Pair] = {}


def tokenizers(paths: tuple[str, str]) -> Pair:
    """One instance for each two vocabularies and process."""
    if paths not in _OPEN:
        _OPEN[paths] = Pair(*paths)
    return _OPEN[paths]


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _aligned(paths: tuple[str, str], digest: bool, schema: pa.Schema):
    def run(batches):
        block = 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            for first, data, offsets in blocks(batch.column(1), 2 << 20):
                found = Aligned(tokenizers(paths), data, offsets)
                n = len(offsets) - 1
                shown = found.groups()
                if digest:
                    empty = (found.n_groups == 0).tolist()
                    shown = ["" if e else hashlib.sha256(g).hexdigest() for g, e in zip(shown, empty)]
                codes, times, cuts = found.pairs()
                distinct, which = np.unique(codes, return_inverse=True)
                # Each document holds a pair once here, so this counts documents.
                holders = np.bincount(which, minlength=len(distinct))
                numbers = [pa.array([getattr(found, c).astype(np.int64)], pa.list_(pa.int64())) for c in _COUNTS]
                ids = batch.column(0).slice(first, n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(part << 32) | block]),
                     pa.ListArray.from_arrays([0, n], ids, type=schema.field("doc_ids").type),
                     *numbers,
                     pa.array([shown], schema.field("groups").type),
                     pa.array([distinct], pa.list_(pa.int64())),
                     pa.array([holders.astype(np.int32)], pa.list_(pa.int32())),
                     pa.array([np.diff(cuts).astype("<u4").tobytes()], pa.binary()),
                     pa.array([which.astype("<u2" if len(distinct) <= 1 << 16 else "<u4").tobytes()], pa.binary()),
                     pa.array([times.astype("<u4").tobytes()], pa.binary())],
                    schema=schema,
                )
                block += 1

    return run


def _summed(schema: pa.Schema):
    """The rows of the documents of each block, with the counts of its pairs.

    An answer holds the place of a pair in the block, the number of its documents, and
    whether that is the highest of its first id.
    """

    def run(batches):
        for batch in batches:
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            for row in range(batch.num_rows):
                ids = column["doc_ids"][row].values
                counts = [column[c][row].values for c in _COUNTS]
                pairs = np.frombuffer(column["pairs"][row].as_buffer(), "<u4")
                n_pairs = int(pairs.sum())
                which = column["which"][row].as_buffer()
                which = np.frombuffer(which, "<u2" if len(which) == 2 * n_pairs else "<u4")
                times = np.frombuffer(column["times"][row].as_buffer(), "<u4").astype(np.int64)
                total = np.zeros(n_pairs and int(which.max()) + 1, dtype=np.int64)
                best = np.zeros(len(total), dtype=np.int64)
                if n_pairs:
                    answers = column["answers"][row].values
                    at = answers.field(0).to_numpy()
                    total[at] = answers.field(1).to_numpy()
                    best[at] = answers.field(2).to_numpy(zero_copy_only=False)
                text = np.repeat(np.arange(len(pairs)), pairs)
                sums = []
                for value in (best, total):
                    out = np.zeros(len(pairs), dtype=np.int64)
                    np.add.at(out, text, value[which] * times)
                    sums.append(pa.array(out))
                yield pa.RecordBatch.from_arrays(
                    [ids, *counts, *sums, column["groups"][row].values], schema=schema
                )

    return run


def align(
    docs: DataFrame, paths: tuple[str, str], digest: bool = False,
    id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every row.

    A is the byte-level vocabulary at the first path, B the piece vocabulary at the second;
    both encode a space and the text.  ``groups`` are the ids between common ends, as
    ``a1,a2|b1;a3|b2,b3``, or with ``digest`` their SHA-256 in hexadecimal digits.  Links
    are all pairs of an A and a B token that share bytes; the count of a pair of ids is the
    number of documents that link it, ``count_sum`` adds it up over links, and ``n_best``
    counts the links whose count is the highest of their A id, ties included.

    Null and empty texts, and texts that are not the bytes of their tokens, have no tokens:
    zeros and an empty ``groups``.  Repeated rows, and rows without an id, are documents of
    their own.  No rows give no rows.
    """
    rows = pick(docs, id_column, text).toDF("doc_id", "text")
    kind = rows.schema["doc_id"].dataType
    arrow = to_arrow_type(kind)
    arrays = [("doc_ids", pa.list_(arrow)), *((c, pa.list_(pa.int64())) for c in _COUNTS)]
    schema = pa.schema(
        [("block", pa.int64()), *arrays, ("groups", pa.list_(pa.string())),
         ("distinct", pa.list_(pa.int64())), ("holders", pa.list_(pa.int32())),
         ("pairs", pa.binary()), ("which", pa.binary()), ("times", pa.binary())]
    )
    plain = ", ".join(f"{c} array<long>" for c in _COUNTS)
    kept = written(rows.mapInArrow(
        _aligned(paths, digest, schema),
        f"block long, doc_ids array<{kind.simpleString()}>, {plain}, groups array<string>, "
        "distinct array<long>, holders array<int>, pairs binary, which binary, times binary",
    ))
    named = kept.select(
        "block", F.posexplode(F.arrays_zip("distinct", "holders")).alias("at", "entry")
    ).select("block", "at", F.col("entry.distinct").alias("pair"), F.col("entry.holders").alias("n"))
    counts = written(named.groupBy("pair").agg(F.sum("n").alias("n")))
    first_id = F.shiftright("pair", 16).alias("a")
    highest = counts.groupBy(first_id).agg(F.max("n").alias("most"))
    scored = counts.withColumn("a", first_id).join(highest, "a").select(
        "pair", F.col("n").alias("total"), (F.col("n") == F.col("most")).alias("best")
    )
    answers = (
        named.select("block", "at", "pair").join(scored, "pair")
        .groupBy("block").agg(F.collect_list(F.struct("at", "total", "best")).alias("answers"))
    )
    out = pa.schema(
        [("doc_id", arrow), *((c, pa.int64()) for c in (*_COUNTS, "n_best", "count_sum")),
         ("groups", pa.string())]
    )
    numbers = ", ".join(f"{c} long" for c in (*_COUNTS, "n_best", "count_sum"))
    return kept.drop("distinct", "holders").join(answers, "block", "left").mapInArrow(
        _summed(out), f"doc_id {kind.simpleString()}, {numbers}, groups string"
    )
