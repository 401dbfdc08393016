"""Token ids of many texts, exactly as the tokenizer library gives them, with a word cache.

Most of a corpus is the same words over and over, so the library is asked once per word and
process.  Texts are cut at white space, which the vocabulary's own pattern never joins, and
further into runs of letters, single digits and runs of marks, as that pattern does.  A run
between white space that holds anything else (an apostrophe, a bracket that may open a
special token, a control, any character beyond ASCII but Latin-1 letters) stays in one piece.
Pieces are known by 64-bit hashes; what the cache lacks the library encodes.
"""

from __future__ import annotations

import os

import numpy as np

from rowsmith.llm.words import LOWER, word_hashes

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_LONG = 1 << 20  # bytes of one text that are encoded at a time
_SPACE, _LETTER, _DIGIT, _MARK, _ODD = range(5)
_KIND = np.full(256, _ODD, dtype=np.uint8)
_KIND[0x21:0x7F] = _MARK
_KIND[[ord("'"), ord("<")]] = _ODD
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _LETTER
_KIND[[0x20, *range(0x09, 0x0E)]] = _SPACE


def pieces(data: np.ndarray, offsets: np.ndarray):
    """(starts, ends, odd) of the pieces of all texts, in order."""
    kind = _KIND[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    latin = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kind[latin] = kind[latin + 1] = _LETTER
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    change = np.ones(len(data) + 1, dtype=bool)
    change[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    change |= edge
    gap = kind == _SPACE
    # Chunks between white space, and whether they hold an odd byte.
    turn = edge.copy()
    turn[1:-1] |= gap[1:] != gap[:-1]
    bounds = np.flatnonzero(turn)
    odd = np.concatenate([[0], np.cumsum(kind == _ODD)])
    strange = odd[bounds[1:]] > odd[bounds[:-1]]
    whole = np.repeat(strange, np.diff(bounds))
    change[:-1] &= ~whole | turn[:-1]
    at = np.flatnonzero(change)
    starts, ends = at[:-1], at[1:]
    held = ~gap[starts]
    starts, ends = starts[held], ends[held]
    return starts, ends, whole[starts]


def _parts(data: np.ndarray):
    """A long text cut before white space, into parts of at most ``_LONG`` bytes where it can be."""
    first = 0
    while first < len(data):
        last = first + _LONG
        if last >= len(data):
            yield data[first:]
            return
        gaps = np.flatnonzero(_KIND[data[first + 1 : last]] == _SPACE)
        if len(gaps):
            last = first + 1 + int(gaps[-1])
        else:
            # No white space in reach: the part goes on to the next there is.
            while last < len(data) and _KIND[data[last]] != _SPACE:
                step = np.flatnonzero(_KIND[data[last : last + _LONG]] == _SPACE)
                last += int(step[0]) if len(step) else min(_LONG, len(data) - last)
        yield data[first:last]
        first = last


class Tokens:
    """Ids by the vocabulary file at ``path``; ``most`` bounds the cached words."""

    def __init__(self, path: str, most: int = 3_000_000):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.most = most
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)
        self.first = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def _plain(self, words: list[bytes]):
        """Ids of pieces that the pattern keeps whole, many to a call."""
        ids, sizes = [], []
        for low in range(0, len(words), 20_000):
            part = words[low : low + 20_000]
            found = self.library.encode(b" ".join(part).decode(), add_special_tokens=False)
            which = np.array(found.word_ids, dtype=np.int64)
            ids.append(np.array(found.ids, dtype=np.uint32))
            sizes.append(np.bincount(which, minlength=len(part)))
        return ids, sizes

    def _learn(self, data, lowered, hashes, starts, ends, odd) -> None:
        plain = [lowered[a:b].tobytes() for a, b in zip(starts[~odd], ends[~odd])]
        ids, sizes = self._plain(plain)
        strange = [data[a:b].tobytes().decode() for a, b in zip(starts[odd], ends[odd])]
        for e in self.library.encode_batch_fast(strange, add_special_tokens=False):
            ids.append(np.array(e.ids, dtype=np.uint32))
            sizes.append(np.array([len(e.ids)]))
        names = np.concatenate([hashes[~odd], hashes[odd]])
        size = np.concatenate(sizes)
        first = np.concatenate([[0], np.cumsum(size)[:-1]]) + len(self.ids)
        self.ids = np.concatenate([self.ids, *ids])
        known = np.concatenate([self.known, names])
        order = np.argsort(known, kind="stable")
        self.known = known[order]
        self.first = np.concatenate([self.first, first])[order]
        self.size = np.concatenate([self.size, size])[order]

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """The ids of all texts in a row, and where each text's ids begin and end."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        if len(offsets) == 2 and len(data) > _LONG:
            parts = [self._encode(part, np.array([0, len(part)]))[0] for part in _parts(data)]
            ids = np.concatenate(parts)
            return ids, np.array([0, len(ids)])
        return self._encode(data, offsets)

    def _encode(self, data: np.ndarray, offsets: np.ndarray):
        starts, ends, odd = pieces(data, offsets)
        lowered = LOWER[data]
        hashes = word_hashes(lowered, starts, ends)
        if odd.any():
            hashes[odd] = word_hashes(data, starts[odd], ends[odd]) ^ np.uint64(1)
        names, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, names)
        place[place == len(self.known)] = 0
        new = self.known[place] != names if len(self.known) else np.ones(len(names), dtype=bool)
        if new.any():
            if len(self.known) + new.sum() > self.most:
                self._forget()
                new[:] = True
            pick = at[new]
            self._learn(data, lowered, names[new], starts[pick], ends[pick], odd[pick])
            place = np.searchsorted(self.known, names)
        row = place[which]
        size = self.size[row]
        total = np.concatenate([[0], np.cumsum(size)])
        flat = np.arange(total[-1]) + np.repeat(self.first[row] - total[:-1], size)
        return self.ids[flat], total[np.searchsorted(starts, offsets)]


_OPEN: dict[str, Tokens] = {}


def tokens(path: str) -> Tokens:
    """One instance for each vocabulary and process."""
    if path not in _OPEN:
        _OPEN[path] = Tokens(path)
    return _OPEN[path]
