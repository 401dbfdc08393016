"""Spans of text: (kind, start, end) in code points, end exclusive, and their digests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

Span = tuple[str, int, int]


def joined(spans: Iterable[Span], kinds: list[str]) -> str:
    """kind:start:end by start, then kind as listed, comma-joined."""
    order = {k: i for i, k in enumerate(kinds)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], order[s[0]], s[2])))


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def apart(spans: list[Span], taken: Iterable[Span]) -> list[Span]:
    """The spans that share no character with one in ``taken`` nor with one before them."""
    held = sorted((a, b) for _, a, b in taken)
    out, at = [], 0
    end = 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], s[2])):
        while at < len(held) and held[at][1] <= a:
            at += 1
        if a >= end and (at == len(held) or held[at][0] >= b):
            out.append((kind, a, b))
            end = b
    return out
