"""Words of many texts at once, as numpy arrays: places in the bytes and 64-bit hashes."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Odd multipliers of the byte and window hashes; any odd numbers do.
_BASE = 0x9E3779B97F4A7C15
_MIX1, _MIX2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
_SLICE = 1 << 19

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def lookup(members) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


#: Bytes of a word: all but white space; or digits, small letters and all beyond ASCII.
NOT_SPACE = ~lookup([0x20, *range(0x09, 0x0E)])
ALNUM = lookup([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and the n+1 places where texts begin and end.

    Null texts are empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, np.uint8)
    data = data[offsets[0] : offsets[-1]] if len(column) else data[:0]
    return data, offsets - offsets[0] if len(column) else np.zeros(1, np.int64)


def blocks(column: pa.Array, most: int = 4 << 20):
    """(first row, data, offsets) of runs of texts of about ``most`` bytes; a text is whole."""
    data, offsets = text_bytes(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), n)
        low, high = offsets[first], offsets[last]
        yield first, data[low:high], offsets[first : last + 1] - low
        first = last


def spans(data: np.ndarray, offsets: np.ndarray, members: np.ndarray):
    """Where the words of all texts start and end; no word crosses from text to text."""
    inside = members[data]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    if len(inside):
        before[0] = after[-1] = False
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = False
    after[edges - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


@functools.lru_cache(maxsize=4)
def _powers(size: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(base, -1, 1 << 64)
    up = np.full(size, U64(base))
    up[0] = 1
    down = np.full(size, U64(inverse))
    down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(size: int, base: int = _BASE):
    return _powers(1 << max(10, int(size).bit_length()), base)


def mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> U64(30))) * _MIX1
    value = (value ^ (value >> U64(27))) * _MIX2
    return value ^ (value >> U64(31))


_LETTER = mixed(np.arange(1, 257, dtype=U64) * U64(_BASE))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial in its bytes, mixed with its length."""
    out = np.empty(len(starts), dtype=U64)
    first = 0
    while first < len(starts):
        last = int(np.searchsorted(ends, starts[first] + _SLICE, side="right"))
        last = max(last, first + 1)
        low, high = starts[first], ends[last - 1]
        up, down = powers(high - low)
        total = np.zeros(high - low + 1, dtype=U64)
        np.cumsum(_LETTER[data[low:high]] * up[: high - low], out=total[1:])
        s, e = starts[first:last] - low, ends[first:last] - low
        out[first:last] = mixed((total[e] - total[s]) * down[s] + (e - s).astype(U64) * _MIX2)
        first = last
    return out


def run_hashes(words: np.ndarray, length: int, base: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """A hash of every run of ``length`` consecutive words, by the place of its first one."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    out = np.empty(n, dtype=U64)
    step = 1 << 16
    up, down = powers(step + length, base)
    for low in range(0, n, step):
        high = min(low + step, n)
        part = words[low : high + length - 1]
        total = np.zeros(len(part) + 1, dtype=U64)
        np.cumsum(part * up[: len(part)], out=total[1:])
        size = high - low
        out[low:high] = mixed((total[length : length + size] - total[:size]) * down[:size])
    return out


def spaced(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the words, each with one space after it, and the n+1 places they begin."""
    size = ends - starts + 1
    at = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(at[-1], dtype=np.uint8)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + _SLICE, side="right")) - 1)
        low, high = at[first], at[last]
        shift = np.repeat(starts[first:last] - at[first:last], size[first:last])
        source = np.arange(low, high) + shift
        # The place after a word at the very end of the data is none; it becomes a space too.
        np.take(data, source, out=out[low:high], mode="clip")
        first = last
    out[at[1:] - 1] = 0x20
    return out, at
