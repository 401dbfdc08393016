"""Periodic runs of words by recompression.

The words of many texts stand in one row, with a mark of its own before, between and after
them.  The row is compressed in turns: blocks of one symbol become a symbol (symbol,
length), then the symbols are halved into left and right ones and every pair left-right
becomes a symbol.  This goes on until each text is one symbol: a run-length grammar of
logarithmic height, whose levels are kept.

Where a block or pair begins depends on two neighbouring symbols alone, so equal passages are
compressed alike but for their edges.  The longest common extension of two places climbs the
levels while both places begin a symbol and the symbols agree, and goes down again at the
first that differ; each level costs a few comparisons.  To the left the same levels are read
from their ends.

A run with period q and at least four periods holds a place i that is a multiple of 3 q, and
i + q.  These places are the candidates, n/3 + n/6 + n/9 ... of them.  Those with the same
word q later are extended to both sides, exactly.  Longer periods of a run that is known are
passed over: they would find the same run.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from rowsmith.llm.common import pick
from rowsmith.llm.words import NOT_SPACE, U64, blocks, mixed, spaced, spans, word_hashes

_QUERIES = 1 << 15  # extensions asked for at once


class _Level:
    """One row of symbols, and the symbol of the next row that each is part of."""

    def __init__(self, symbols: np.ndarray, first: np.ndarray, block: bool):
        self.symbols, self.block = symbols, block
        self.first = np.append(first, len(symbols)).astype(np.int32)
        self.owner = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(self.first))

    def mirrored(self) -> _Level:
        """The same row read from its end."""
        other = object.__new__(_Level)
        other.symbols, other.block = self.symbols[::-1], self.block
        other.first = len(self.symbols) - self.first[::-1]
        other.owner = (len(self.first) - 2) - self.owner[::-1]
        return other


class Grammar:
    """The levels of a row of symbols; negative symbols are marks and must be unique."""

    def __init__(self, symbols: np.ndarray):
        self.names = int(symbols.max(initial=-1)) + 1
        self.levels: list[_Level] = []
        row = symbols.astype(np.int64)
        while ((row[1:] >= 0) & (row[:-1] >= 0)).any():
            row = self._blocks(row)
            row = self._pairs(row)
        self.top = row
        self.left = [level.mirrored() for level in self.levels]

    def _named(self, row, first, chosen, keys, block) -> np.ndarray:
        """The next row: a new name for each distinct key, at the chosen of its symbols."""
        distinct, names = np.unique(keys, return_inverse=True)
        new = row[first]
        new[chosen] = self.names + names
        self.names += len(distinct)
        self.levels.append(_Level(row.astype(np.int32), first, block))
        return new

    def _blocks(self, row: np.ndarray) -> np.ndarray:
        starts = np.ones(len(row), dtype=bool)
        starts[1:] = row[1:] != row[:-1]
        first = np.flatnonzero(starts)
        if len(first) == len(row):
            return row
        size = np.diff(np.append(first, len(row)))
        chosen = np.flatnonzero(size > 1)
        return self._named(row, first, chosen, (row[first[chosen]] << 32) | size[chosen], True)

    def _pairs(self, row: np.ndarray) -> np.ndarray:
        both = (row[:-1] >= 0) & (row[1:] >= 0)
        if not both.any():
            return row
        # Of four ways to halve the symbols the one with the most pairs is taken.
        turn = U64((len(self.levels) + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        bits = mixed(row.astype(U64) + turn)
        best = None
        for bit in (1, 2, 4, 8):
            right = (bits & U64(bit)) != 0
            joined = both & ~right[:-1] & right[1:]
            n = int(joined.sum())
            if best is None or n > best[0]:
                best = n, joined
        n, joined = best
        if not n:
            symbol = row[:-1][both][0]
            joined = both & (row[:-1] == symbol)
        at = np.flatnonzero(joined)
        starts = np.ones(len(row), dtype=bool)
        starts[at + 1] = False
        first = np.flatnonzero(starts)
        chosen = at - np.arange(len(at))  # each pair before took one place
        return self._named(row, first, chosen, (row[at] << 32) | row[at + 1], False)

    def extension(self, i: np.ndarray, j: np.ndarray, to_left: bool = False) -> np.ndarray:
        """How many symbols agree from i and from j on, i included; i and j differ.

        With ``to_left`` symbols are read leftwards.
        """
        levels = self.left if to_left else self.levels
        if not levels:
            return np.zeros(len(i), dtype=np.int64)
        top = self.top[::-1] if to_left else self.top
        if to_left:
            n = len(levels[0].symbols)
            i, j = n - 1 - i, n - 1 - j
        a, b = i.astype(np.int64), j.astype(np.int64)
        height = np.full(len(i), len(levels), dtype=np.int32)
        live = np.arange(len(i))
        for h, level in enumerate(levels):
            x, y = a[live], b[live]
            differ = level.symbols[x] != level.symbols[y]
            inner = ~differ
            while inner.any():
                # Equal symbols, of which one does not begin a symbol above: go on to the next.
                at = np.flatnonzero(inner)
                p, q = x[at], y[at]
                up, vp = level.owner[p], level.owner[q]
                inside = (level.first[up] != p) | (level.first[vp] != q)
                at, p, q, up, vp = at[inside], p[inside], q[inside], up[inside], vp[inside]
                inner[:] = False
                if len(at):
                    step = np.minimum(level.first[up + 1] - p, level.first[vp + 1] - q)
                    x[at], y[at] = p + step, q + step
                    differ[at] = level.symbols[x[at]] != level.symbols[y[at]]
                    inner[at] = ~differ[at]
            a[live], b[live] = x, y
            height[live[differ]] = h
            live = live[~differ]
            if not len(live):
                break
            a[live], b[live] = level.owner[a[live]], level.owner[b[live]]
        while len(live):
            live = live[top[a[live]] == top[b[live]]]
            a[live] += 1
            b[live] += 1
        for h in range(int(height.max(initial=0)), 0, -1):
            level = levels[h - 1]
            live = np.flatnonzero(height >= h)
            x, y = level.first[a[live]].astype(np.int64), level.first[b[live]].astype(np.int64)
            at = np.flatnonzero(level.symbols[x] == level.symbols[y])
            while len(at):
                p, q = x[at], y[at]
                step = 1
                if level.block:
                    step = np.minimum(
                        level.first[level.owner[p] + 1] - p, level.first[level.owner[q] + 1] - q
                    )
                x[at], y[at] = p + step, q + step
                at = at[level.symbols[x[at]] == level.symbols[y[at]]]
            a[live], b[live] = x, y
        return a - i


def runs_of(names: np.ndarray, longest: int, least: int = 6, exponent: int = 4) -> np.ndarray:
    """(start, end, period) of all runs in a row of names with marks, by start and period.

    ``longest`` is the longest stretch between two marks.
    """
    n = len(names)
    grammar = Grammar(names)
    period, end = np.ones(n, np.int32), np.zeros(n, np.int32)  # of a run that holds each place
    found: list[np.ndarray] = []
    waiting: list[tuple[np.ndarray, int]] = []
    held = 0

    def extend() -> None:
        places = np.concatenate([at for at, _ in waiting]).astype(np.int64)
        periods = np.concatenate([np.full(len(at), q, np.int64) for at, q in waiting])
        for low in range(0, len(places), _QUERIES):
            i, q = places[low : low + _QUERIES], periods[low : low + _QUERIES]
            new = (end[i] <= i + q) | (q % period[i] != 0)
            i, q = i[new], q[new]
            start = i - grammar.extension(i - 1, i + q - 1, to_left=True)
            stop = i + q + grammar.extension(i, i + q)
            long = stop - start >= np.maximum(least, exponent * q)
            runs = np.unique(np.stack([start[long], stop[long], q[long]], axis=1), axis=0)
            for s, e, p in runs[::-1]:
                period[s:e], end[s:e] = p, e
            found.append(runs)

    for q in range(1, longest // exponent + 1):
        grid = names[:: 3 * q]
        later = names[q :: 3 * q]
        at = np.flatnonzero(grid[: len(later)] == later)
        if len(at):
            waiting.append((at * (3 * q), q))
            held += len(at)
        if held >= _QUERIES:
            extend()
            waiting, held = [], 0
    if waiting:
        extend()
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    # A run found with several periods counts with the smallest.
    new = np.ones(len(runs), dtype=bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[new]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


Order = Callable[[list, np.ndarray], np.ndarray | None]


def _found(order: Order | None, least: int, exponent: int, schema: pa.Schema):
    kind = schema.field("runs").type

    def run(batches):
        for batch in batches:
            for first, data, offsets in blocks(batch.column(1), 2 << 20):
                starts, ends = spans(data, offsets, NOT_SPACE)
                begin = np.searchsorted(starts, offsets)
                counts = np.diff(begin)
                ids = batch.column(0).slice(first, len(counts))
                _, names = np.unique(word_hashes(data, starts, ends), return_inverse=True)
                if order is not None:
                    places = order(ids.to_pylist(), counts)
                    starts, ends, names = starts[places], ends[places], names[places]
                # A mark stands before each text and after the last.
                marked = np.insert(names, begin, -1 - np.arange(len(begin)))
                runs = runs_of(marked, int(counts.max(initial=0)), least, exponent)
                mark = begin + np.arange(len(begin))
                text = np.searchsorted(mark, runs[:, 0], side="right") - 1
                gone = np.zeros(len(marked) + 1, dtype=np.int32)
                np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
                np.add.at(gone, runs[:, 1], -1)
                stays = np.delete(np.cumsum(gone[:-1]) == 0, mark)
                body, at = spaced(data, starts[stays], ends[stays])
                kept = np.concatenate([[0], np.cumsum(stays)])[begin]
                low = at[kept[:-1]]
                # The space after a text's last word is not part of it.
                texts = [
                    body[a : max(a, b - 1)].tobytes().decode()
                    for a, b in zip(low.tolist(), at[kept[1:]].tolist())
                ]
                edges = np.searchsorted(text, np.arange(len(begin)))
                flat = pa.StructArray.from_arrays(
                    [pa.array(runs[:, 0] - mark[text] - 1), pa.array(runs[:, 1] - runs[:, 0]),
                     pa.array(runs[:, 2])], fields=list(kind.value_type),
                )
                lists = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), flat, type=kind)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(counts), lists, pa.array(texts, pa.string())], schema=schema
                )

    return run


def find_runs(
    docs: DataFrame, least: int = 6, exponent: int = 4, order: Order | None = None,
    id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, n_words, runs, text) of every row.

    ``runs`` are (start, length, period) of the maximal stretches of words with their
    smallest period, at least ``exponent`` periods and ``least`` words long, by start, then
    period; ``exponent`` must be 4 or more.  ``text`` holds the words outside of runs and the
    first period of each, joined by one space.

    ``order`` may put other words in a text's place first: it gets the ids and word counts of
    some rows and returns, for each word of them in a row, which word stands there.

    Null and empty texts have no words and no runs; each row is judged by itself, so repeated
    rows and ids, and rows without an id, give one row each.  No rows give no rows.  A text of
    one repeated word is one run.
    """
    if exponent < 4:
        raise ValueError(f"exponent must be 4 or more (received: {exponent})")
    rows = pick(docs, id_column, text).toDF("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    run = "array<struct<start: long, length: long, period: long>>"
    struct = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
    schema = pa.schema(
        [("doc_id", to_arrow_type(rows.schema["doc_id"].dataType)), ("n_words", pa.int64()),
         ("runs", pa.list_(struct)), ("text", pa.string())]
    )
    return rows.mapInArrow(
        _found(order, least, exponent, schema),
        f"doc_id {kind}, n_words long, runs {run}, text string",
    )


def planted(ids: list, counts: np.ndarray) -> np.ndarray:
    """The word order of the registered query: texts chosen by their id repeat a stretch.

    With h = crc32(decimal id) and g = h // 10, texts with h % 10 = 0 repeat from word
    a = g % n on the p = 1 + (n - a) // (3 + g % 8) words there.  Rows without an id stay.
    """
    first = np.concatenate([[0], np.cumsum(counts)])
    places = np.arange(first[-1])
    for row, (name, n) in enumerate(zip(ids, counts.tolist())):
        if name is None or not n:
            continue
        g, rest = divmod(zlib.crc32(str(name).encode()), 10)
        if rest == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            places[first[row] + a : first[row + 1]] = first[row] + a + np.arange(n - a) % p
    return places
