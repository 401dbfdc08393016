"""Secrets by token efficiency.

A vocabulary learnt from text spends few tokens on what people write and many on random
strings.  A run of key characters that costs a token for every two characters or fewer, by
a tiktoken vocabulary, is taken for a secret, unless it is a digest of a known size, a
UUID, a number, or an identifier made of words.  What words are the same vocabulary tells:
the letters of an identifier, split at marks, digits and case changes, cost few tokens.
Spans so found are added to those of the base patterns, which always stay.  One pass over
the texts; nothing is shuffled.
"""

from __future__ import annotations

import base64
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from rowsmith.llm.common import pick, place, ship
from rowsmith.llm.spans import Span, apart, digest, joined

BASE = ["assign", "access", "hex"]
KINDS = [*BASE, "random"]

_ASSIGN = re.compile(
    r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*+[:=]\x20*+[\"']?([A-Za-z0-9+/_.=-]++)",
    re.ASCII | re.IGNORECASE,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]++")
_HEX = re.compile(r"[0-9a-f]{24,}+")
#: Runs of key characters worth a look: 16 or more, no longer run of the same kind around.
_RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+")
#: Known digests: MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512 in hex of one case.
_DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
_DIGESTS = {32, 40, 56, 64, 96, 128}
_UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\Z")
_NUMBER = re.compile(r"[0-9+/_=-]+\Z")
#: Dates, versions and part numbers: short numbers between marks, a letter before some.
_SHORT = r"[A-Za-z]?[0-9]{1,4}+"
_NUMBERS = re.compile(rf"[-_/+=]*+{_SHORT}(?:[-_/+=]++{_SHORT})++[-_/+=]*+\Z")
#: The letters of an identifier: words of one case or in camel case; it has few digits in a row.
_WORD = re.compile(r"[A-Z]++(?![a-z])|[A-Z]?[a-z]++|[A-Z]+(?=[A-Z][a-z])")
_DIGITS = re.compile(r"[0-9]{5}")


def base_spans(text: str) -> list[Span]:
    out = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return out


def excluded(run: str) -> bool:
    """Known digests, UUIDs and numbers: not secrets whatever they cost."""
    if len(run) in _DIGESTS and _DIGEST.match(run):
        return True
    return any(p.match(run) for p in (_UUID, _NUMBER, _NUMBERS))


class Cost:
    """Characters per token under the tiktoken vocabulary file at ``path``."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        lines = [line.split() for line in open(path, "rb")]
        self.library = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, special_tokens={},
            mergeable_ranks={base64.b64decode(a): int(b) for a, b in lines},
        )

    def tokens(self, run: str) -> int:
        # Long runs are read in parts: byte pairs take time with the square of a run.
        parts = [run[i : i + 512] for i in range(0, len(run), 512)]
        return sum(len(self.library.encode_ordinary(p)) for p in parts)

    def per_token(self, run: str) -> float:
        return len(run) / self.tokens(run)

    def identifier(self, run: str, most: float) -> bool:
        """Whether the letters of a run are words: more than ``most`` of them to a token.

        A word costs what its cheapest form does: as it stands, after a space, or in small
        letters after a space, which is how the vocabulary has seen most words.
        """
        words = _WORD.findall(run)
        if not words or _DIGITS.search(run):
            return False
        cost = sum(min(map(self.tokens, (w, f" {w}", f" {w.lower()}"))) for w in words)
        return sum(map(len, words)) > most * cost


_OPEN: dict[str, Cost] = {}


def costly(text: str, path: str, most: float) -> list[Span]:
    if path not in _OPEN:
        _OPEN[path] = Cost(path)
    cost = _OPEN[path]
    runs = ((m.group(), m.span()) for m in _RUN.finditer(text))
    return [
        ("random", *span)
        for run, span in runs
        if not excluded(run) and cost.per_token(run) <= most and not cost.identifier(run, most)
    ]


def secrets(text: str, path: str, most: float) -> tuple[list[Span], list[Span]]:
    """(base spans, added spans) of a text; an added span touches no base span."""
    base = base_spans(text)
    return base, apart(costly(text, path, most), base)


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def find(
    docs: DataFrame, path: str, most: float = 2.0, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every row.

    Null and empty texts have no spans; rows repeated in full, or without an id, have their
    own.  No rows give no rows.
    """

    def run(batches):
        for batch in batches:
            out = {name: [] for name in [*BASE, "sha", "spans"]}
            for body in batch.column(1):
                base, added = secrets(body.as_py() or "", path, most)
                for k in BASE:
                    out[k].append(sum(s[0] == k for s in base))
                out["sha"].append(digest(joined(base, KINDS)))
                out["spans"].append(joined(base + added, KINDS))
            columns = [pa.array(out[k], pa.int64()) for k in BASE]
            columns += [pa.array(out[k], pa.string()) for k in ("sha", "spans")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns],
                names=["doc_id", *[f"n_{k}" for k in BASE], "base_sha256", "spans"],
            )

    rows = pick(docs, id_column, text)
    kind = rows.schema[0].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in BASE)
    return rows.mapInArrow(run, f"doc_id {kind}, {counts}, base_sha256 string, spans string")


def masked(text: str, path: str, most: float = 2.0, mask: str = "[SECRET]") -> str:
    """The text with each span, or run of spans that overlap, replaced by ``mask``."""
    base, added = secrets(text, path, most)
    parts, end = [], 0
    for _, a, b in sorted(base + added, key=lambda s: s[1:]):
        if a >= end:
            parts += [text[end:a], mask]
        end = max(end, b)
    return "".join([*parts, text[end:]])


def redact(docs: DataFrame, path: str, most: float = 2.0, mask: str = "[SECRET]") -> DataFrame:
    """All rows and columns of ``docs`` with secrets masked; null texts stay null.

    ``n_chars``, where there is such a column, is the length of the masked text.
    """
    columns = docs.columns
    at = place(columns, "text")
    long = columns.index("n_chars") if "n_chars" in columns else None

    def run(batches):
        for batch in batches:
            old = batch.column(at).to_pylist()
            new = [None if t is None else masked(t, path, most, mask) for t in old]
            arrays = list(batch.columns)
            arrays[at] = pa.array(new, batch.schema.field(at).type)
            if long is not None:
                sizes = [len(n) if n != o else s for n, o, s in zip(new, old, arrays[long].to_pylist())]
                arrays[long] = pa.array(sizes, batch.schema.field(long).type)
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    ship(docs.sparkSession)
    plain = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    return plain.mapInArrow(run, plain.schema).toDF(*columns)
