"""Name similarity and the lossless filter that finds similar names.

The similarity of two names is ``2 * M / (length + length)``, where ``M`` counts
the characters in the matching blocks of a Ratcliff/Obershelp comparison.  The
blocks are an order-preserving alignment, so a high ratio forces the names to
share many q-grams; :func:`overlap_bound` says how many.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

# Python workers get these helpers with the plan, so no executor needs the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: added to the similarity where both departments are equal.
DEPARTMENT_BOOST = 0.06

_SLACK = 1e-9  # keeps the float bounds on the safe side
_MAX_GRAM = 6


def ratio(source: Column, target: Column, at_least: float = 0.0) -> Column:
    """The similarity of two name columns, or null where it is below ``at_least``.

    It is not symmetric.  Pairs are first screened by their common characters; the rest is
    compared many pairs at a time.
    """

    @F.pandas_udf("double")
    def compare(left: pd.Series, right: pd.Series) -> pd.Series:
        li, ls = pd.factorize(left)
        ri, rs = pd.factorize(right)
        one, other = Names(ls), Names(rs)
        out = np.full(len(left), np.nan)
        for low in range(0, len(left), _SCREENED):
            part = slice(low, low + _SCREENED)
            bound = upper_bound(one, li[part], other, ri[part])
            at = np.flatnonzero(bound >= at_least - _SLACK) + low
            value = ratios(one, li[at], other, ri[at])
            fine = value >= at_least
            out[at[fine]] = value[fine]
        return pd.Series(out)

    return F.nanvl(compare(source, target), F.lit(None).cast("double"))


_SCREENED = 1 << 18  # pairs screened at a time
_COMPARED = 1 << 20  # words of bits that one comparison of many pairs may take
_CLASSES, _REPEATS = 32, 4  # letters are counted in 32 classes, up to 4 of each apart


def letter_class(points: np.ndarray) -> np.ndarray:
    """The class of each letter: a to z and the space have one each, so that words and numbers
    have none in common; other marks of ASCII share five, other letters go by their code."""
    ascii_class = np.where(points == 32, 26, 27 + points % 5)
    small = np.where((points >= 97) & (points <= 122), points - np.uint32(97), ascii_class)
    return np.where(points < 128, small, points % _CLASSES).astype(np.int64)


class Names:
    """Distinct names as arrays: letters, lengths and letter counts."""

    def __init__(self, names):
        names = ["" if n is None or n != n else n for n in names]
        points = [np.frombuffer(n.encode("utf-32-le", "surrogatepass"), np.uint32) for n in names]
        self.length = np.array([len(p) for p in points], dtype=np.int64)
        self.flat = np.concatenate([*points, np.zeros(0, np.uint32)])
        self.first = np.concatenate([[0], np.cumsum(self.length)])
        owner = np.repeat(np.arange(len(names)), self.length)
        place = owner * _CLASSES + letter_class(self.flat)
        counts = np.bincount(place, minlength=len(names) * _CLASSES).reshape(-1, _CLASSES)
        self.counts = np.minimum(counts, 0xFFFF).astype(np.uint16)
        # A bit for each of the first letters of a class, and the number of the others.
        self.bits = np.zeros((len(names), _REPEATS), dtype=np.uint32)
        weight = np.uint32(1) << np.arange(_CLASSES, dtype=np.uint32)
        for k in range(_REPEATS):
            self.bits[:, k] = ((counts > k) * weight).sum(axis=1, dtype=np.uint64)
        self.bits = self.bits.view(np.uint64)
        self.more = np.maximum(counts - _REPEATS, 0).sum(axis=1)

    def letters(self, rows: np.ndarray, width: int) -> np.ndarray:
        """The letters of some names, one a row, filled up with a mark that is no letter."""
        at = np.arange(width) + self.first[rows][:, None]
        inside = np.arange(width) < self.length[rows][:, None]
        if not len(self.flat):
            return np.full((len(rows), width), 0xFFFFFFFF, dtype=np.uint32)
        return np.where(inside, self.flat[np.minimum(at, len(self.flat) - 1)], np.uint32(0xFFFFFFFF))


def upper_bound(one: Names, left: np.ndarray, other: Names, right: np.ndarray) -> np.ndarray:
    """No pair's ratio is above the share of letters both names have."""
    common = np.minimum(one.more[left], other.more[right])
    for word in range(one.bits.shape[1]):
        common = common + np.bitwise_count(one.bits[left, word] & other.bits[right, word])
    length = one.length[left] + other.length[right]
    return 2.0 * common / np.maximum(length, 1)


def ratios(one: Names, left: np.ndarray, other: Names, right: np.ndarray) -> np.ndarray:
    """The similarity of pairs of names, ``left`` of ``one`` with ``right`` of ``other``."""
    out = np.zeros(len(left))
    la, lb = one.length[left], other.length[right]
    # Pairs of like size are compared together, so that little is filled up.
    size = np.maximum(la, 1) * ((lb + 63) // 64)
    order = np.argsort(size * (1 << 20) + la, kind="stable")
    order = order[(la[order] > 0) & (lb[order] > 0)]
    low = 0
    while low < len(order):
        # Sizes ascend; take as many pairs as fit at the size of the last.
        high = low + max(1, int(_COMPARED // size[order[low]]))
        high = min(high, len(order))
        while high > low + 1 and size[order[high - 1]] * (high - low) > _COMPARED:
            high = low + (high - low + 1) // 2
        at = order[low:high]
        matched = _matched(one, left[at], other, right[at])
        out[at] = 2.0 * matched / (la[at] + lb[at])
        low = high
    return out


def _matched(one: Names, left: np.ndarray, other: Names, right: np.ndarray) -> np.ndarray:
    """The letters in the matching blocks of each pair.

    The longest common block is found, the one that begins first in the left name and then
    in the right, and the parts before and after it are compared in the same way.  A part of
    every pair is worked on at once: row i of a pair holds a bit for each place of the right
    name with the letter i of the left.  Shifting the rows by one and keeping what both have
    leaves the ends of longer and longer blocks, until none is left.
    """
    la, lb = one.length[left], other.length[right]
    a, b = one.letters(left, int(la.max())), other.letters(right, int(lb.max()))
    words = (b.shape[1] + 63) // 64
    equal = np.zeros((len(left), a.shape[1], words), dtype=np.uint64)
    popular = _popular(b, lb)
    for j in range(b.shape[1]):
        same = (a == b[:, j, None]) & (j < lb)[:, None]
        if popular is not None:
            same &= ~popular[:, j, None]
        equal[:, :, j // 64] |= same.astype(np.uint64) << np.uint64(j % 64)
    total = np.zeros(len(left), dtype=np.int64)
    pair = np.arange(len(left))
    zero = np.zeros(len(left), dtype=np.int64)
    parts = pair, zero, la, zero, lb
    while len(parts[0]):
        pair, alo, ahi, blo, bhi = parts
        i, j, size = _longest(equal[pair], alo, ahi, blo, bhi)
        if popular is not None:
            i, j, size = _grown(a[pair], b[pair], i, j, size, alo, ahi, blo, bhi)
        np.add.at(total, pair, size)
        before = (size > 0) & (alo < i) & (blo < j)
        after = (size > 0) & (i + size < ahi) & (j + size < bhi)
        parts = tuple(np.concatenate([x[before], y[after]]) for x, y in (
            (pair, pair), (alo, i + size), (i, ahi), (blo, j + size), (j, bhi)
        ))
    return total


def _popular(b: np.ndarray, lb: np.ndarray) -> np.ndarray | None:
    """Places of letters that make up over a hundredth of a right name of 200 letters or
    more (fixed values of the similarity); no block begins from these."""
    if b.shape[1] < 200:
        return None
    out = np.zeros(b.shape, dtype=bool)
    for row in np.flatnonzero(lb >= 200):
        n = int(lb[row])
        _, which, times = np.unique(b[row, :n], return_inverse=True, return_counts=True)
        out[row, :n] = times[which] > n // 100 + 1
    return out


def _below(count: np.ndarray, words: int) -> np.ndarray:
    """Words of bits in which the first ``count`` bits are set."""
    rest = np.clip(count[:, None] - 64 * np.arange(words), 0, 64)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    part = (np.uint64(1) << np.minimum(rest, 63).astype(np.uint64)) - np.uint64(1)
    return np.where(rest == 64, full, part)


def _longest(rows, alo, ahi, blo, bhi) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, size) of the longest common block within the given bounds."""
    width, words = rows.shape[1:]
    at = np.arange(width)
    inside = (at >= alo[:, None]) & (at < ahi[:, None])
    window = _below(bhi, words) & ~_below(blo, words)
    rows = np.where(inside[:, :, None], rows & window[:, None, :], np.uint64(0))
    n = len(rows)
    i, j, size = alo.copy(), blo.copy(), np.zeros(n, dtype=np.int64)
    live, ends, length = np.arange(n), rows, 0
    while len(live):
        some = (ends != 0).any(axis=2)
        left = some.any(axis=1)
        if not left.all():
            live, ends, rows, some = live[left], ends[left], rows[left], some[left]
            if not len(live):
                break
        length += 1
        # The block of this length that ends first, and its first place on the right.
        end = some.argmax(axis=1)
        found = ends[np.arange(len(live)), end]
        word = (found != 0).argmax(axis=1)
        bits = found[np.arange(len(live)), word]
        lowest = np.bitwise_count((bits & (~bits + np.uint64(1))) - np.uint64(1)).astype(np.int64)
        size[live] = length
        i[live] = end - length + 1
        j[live] = word * 64 + lowest - length + 1
        shifted = ends << np.uint64(1)
        if words > 1:
            shifted[:, :, 1:] |= ends[:, :, :-1] >> np.uint64(63)
        longer = np.zeros_like(ends)
        longer[:, 1:] = shifted[:, :-1] & rows[:, 1:]
        ends = longer
    return i, j, size


def _grown(a, b, i, j, size, alo, ahi, blo, bhi):
    """Blocks made longer on both sides by equal letters, popular ones included."""
    i, j, size = i.copy(), j.copy(), size.copy()
    while True:
        row = np.flatnonzero((i > alo) & (j > blo))
        row = row[a[row, i[row] - 1] == b[row, j[row] - 1]]
        if not len(row):
            break
        i[row], j[row], size[row] = i[row] - 1, j[row] - 1, size[row] + 1
    while True:
        row = np.flatnonzero((i + size < ahi) & (j + size < bhi))
        row = row[a[row, i[row] + size[row]] == b[row, j[row] + size[row]]]
        if not len(row):
            return i, j, size
        size[row] += 1


def gram_size(at_least: float) -> int:
    """The longest q-gram for which every qualifying pair must share one.

    A pair has at most ``2 M (1 - r) / r`` unmatched characters, each of which
    ends at most one block, and a break costs ``q - 1`` grams.
    """
    if at_least >= 1.0:
        return _MAX_GRAM
    return max(1, min(_MAX_GRAM, 1 + math.floor(at_least / (2 * (1 - at_least)) + _SLACK)))


def overlap_bound(a: int, b: int, at_least: float, q: int) -> int:
    """Least number of common padded q-grams of names with lengths ``a`` and ``b``
    whose ratio reaches ``at_least``; 0 where the lengths rule it out."""
    matched = max(1, math.ceil(at_least * (a + b) / 2 - _SLACK))
    if matched > min(a, b):
        return 0
    unmatched = a + b - 2 * matched
    return max(1, matched + (q - 1) * (1 - unmatched))


def least_overlap(length: int, at_least: float, q: int) -> int:
    """The bound that holds against a partner of any length."""
    bounds = (1,)
    if at_least > 0:
        low = max(1, math.floor(length * at_least / (2 - at_least)))
        high = math.ceil(length * (2 - at_least) / at_least)
        if q == 1:
            # One gram to a letter: the bound grows with the partner, so the shortest decides.
            high = min(high, low + 2)
        found = [overlap_bound(length, b, at_least, q) for b in range(low, high + 1)]
        bounds = [b for b in found if b] or bounds
    return min(bounds)


def prefix_length(length: int, at_least: float) -> int:
    """How many of a name's grams must be indexed so that every pair that shares
    ``least_overlap`` grams shares an indexed one."""
    q = gram_size(at_least)
    if at_least <= 0:
        return length + q - 1
    return max(1, length + q - least_overlap(length, at_least, q))


_B1, _B2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(32))) * _B2
    value = (value ^ (value >> np.uint64(29))) * _B1
    return value ^ (value >> np.uint64(32))


def grams(names, salts: np.ndarray, at_least: float) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): 64-bit hashes of the padded q-grams of each name, and where each
    name's begin, and the end.

    The second of two equal grams is a gram of its own.  ``salts`` are mixed in, so that names
    with different salts share none.
    """
    q = gram_size(at_least)
    known = Names(names)
    # Two marks that no name holds stand before and after it.
    wide = known.length + 2 * (q - 1)
    start = np.concatenate([[0], np.cumsum(wide)])
    padded = np.empty(start[-1], dtype=np.uint64)
    at = np.arange(start[-1]) - np.repeat(start[:-1], wide)
    size = np.repeat(known.length, wide)
    padded[:] = np.where(at < q - 1, 0x110000, 0x110001)
    inner = (at >= q - 1) & (at < size + q - 1)
    padded[inner] = known.flat
    count = np.where(known.length > 0, known.length + q - 1, 0)
    first = np.concatenate([[0], np.cumsum(count)])
    owner = np.repeat(np.arange(len(count)), count)
    place = np.arange(first[-1]) - first[owner] + start[owner]
    value = np.zeros(first[-1], dtype=np.uint64)
    for k in range(q):
        value = (value + padded[place + k] + np.uint64(1)) * _B1
    order = np.lexsort((value, owner))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (value[order[1:]] != value[order[:-1]]) | (owner[order[1:]] != owner[order[:-1]])
    run = np.flatnonzero(new)
    times = np.empty(len(order), dtype=np.uint64)
    times[order] = np.arange(len(order)) - np.repeat(run, np.diff(np.append(run, len(order))))
    salt = np.asarray(salts, dtype=np.int64).view(np.uint64)[owner]
    return _mixed(_mixed(value + times * _B2) ^ salt).view(np.int64), first


def indexed(names, salts: np.ndarray, at_least: float, common: tuple[np.ndarray, np.ndarray]):
    """(hashes, first): of each name the grams it is indexed by, the rarest ones.

    ``common`` are the sorted hashes of frequent grams and their counts; the others come first,
    in the order of their hashes.
    """
    value, first = grams(names, salts, at_least)
    count = np.diff(first)
    owner = np.repeat(np.arange(len(count)), count)
    hashes, seen = common
    often = np.zeros(len(value), dtype=np.int64)
    if len(hashes):
        at = np.minimum(np.searchsorted(hashes, value), len(hashes) - 1)
        often = np.where(hashes[at] == value, seen[at], 0)
    order = np.lexsort((value, often, owner))
    value = value[order]
    rank = np.arange(len(value)) - first[owner]
    q = gram_size(at_least)
    keep = {n: prefix_length(n - q + 1, at_least) for n in np.unique(count).tolist() if n}
    most = np.array([keep.get(n, 0) for n in count.tolist()], dtype=np.int64)
    stay = rank < most[owner]
    return value[stay], np.concatenate([[0], np.cumsum(np.minimum(most, count))])


def gram_column(
    name: Column, salt: Column, at_least: float, common: tuple[np.ndarray, np.ndarray] | None = None
) -> Column:
    """All grams of a name as an array of hashes, or with ``common`` those it is indexed by."""

    @F.pandas_udf("array<long>")
    def cut(names: pd.Series, salts: pd.Series) -> pd.Series:
        if common is None:
            value, first = grams(names, salts.to_numpy(), at_least)
        else:
            value, first = indexed(names, salts.to_numpy(), at_least, common)
        return pd.Series([value[a:b] for a, b in zip(first[:-1], first[1:])])

    return cut(name, salt)
