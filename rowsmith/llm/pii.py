"""Personal data by weak supervision.

Broad patterns propose spans.  Regex, gazetteer and context labelers vote on each: yes, no
or nothing.  A proposal's votes, kind, length and digits are all small categories, so the
proposals of a corpus of any size come down to a table of patterns with counts (at most
7 kinds x 3**5 votes x 4 lengths x 4 digit counts).  On it, expectation-maximisation finds
how reliable each labeler is, without any labelled span, and what share of each kind is
real; its posteriors train the final span classifier, a logistic regression over kind,
votes, length and digits.  Spans it accepts are added to the base spans, which always stay.

The texts are read once; what is left per document are its spans, which are written, so
that the model's table and the result come from the same small rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.common import pick, written
from rowsmith.llm.spans import Span, apart, digest, joined

BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "ssn", "iban", "person"]
VOTERS = ["format", "gazetteer", "context", "variety", "surroundings"]

_OTHER = re.compile(r"[^A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# The base patterns, with possessive repeats where that changes no match; a match of the
# address pattern never starts inside a run of digits, as its first part takes them all.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def _emails(text: str):
    """Leftmost matches of local part, @ and domain: each @ in turn, in linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        low = _run_start(text, done, at)
        match = _DOMAIN.match(text, at) if low < at else None
        if match:
            yield low, match.end()
        # No local part reaches back over an @.
        done = match.end() if match else at + 1
        at = text.find("@", done)


def _run_start(text: str, low: int, high: int) -> int:
    """Where the run of local-part characters that ends at ``high`` begins, not before ``low``."""
    first, width = high, 64
    while first > low:
        step = max(low, first - width)
        others = _OTHER.findall(text, step, first)
        if others:
            return text.rindex(others[-1], step, first) + 1
        first, width = step, width * 2
    return first


def base_spans(text: str) -> list[Span]:
    out = [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37:
            digits = _digits(m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 10 <= len(_digits(m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


# Broad proposals beyond the base patterns.
_PROPOSALS = {
    "email": re.compile(r"(?<![\w.])[A-Za-z0-9._%+-]{1,64}+ ?[\[({] ?(?:at|AT|@) ?[\])}] ?[A-Za-z0-9-]{1,63}+(?: ?[\[({] ?(?:dot|DOT|\.) ?[\])}] ?[A-Za-z0-9-]{1,63}+|\.[A-Za-z0-9-]{1,63}+){1,8}"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[ -]?[0-9]{4}){3}(?![0-9])|(?<![0-9])3[0-9]{3}[ -]?[0-9]{6}[ -]?[0-9]{5}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9.])(?:\([0-9]{2,5}\) ?|[0-9]{2,5}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9.])"),
    "ssn": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "iban": re.compile(r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Z0-9])"),
    "person": re.compile(r"(?<!\w)(?:Mr|Mrs|Ms|Dr|Prof)\.? [A-Z][a-z]{1,30}(?: [A-Z][a-z]{1,30})?(?!\w)"),
}
# Gazetteers of top-level domains, IBAN countries and given names, and the
# words around personal data of each kind.
_DOMAINS = "com org net edu gov info io de fr es it uk us ch at nl eu co biz".split()
_COUNTRIES = "AT BE BG CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IS IT LI LT LU LV MC MT NL NO PL PT RO SE SI SK".split()
_NAMES = "james john robert michael david mary patricia linda anna maria jose juan carlos pierre jean marie hans peter julia thomas paul laura sarah emma".split()
_NEAR = {
    "email": "mail contact write address reach correo courriel",
    "card": "card visa mastercard credit amex payment karte carte tarjeta",
    "phone": "phone call tel telephone mobile cell fax contact telefon teléfono",
    "ssn": "ssn social security",
    "iban": "iban account bank transfer konto compte cuenta",
    "person": "name patient signed dear contact customer",
    "ip": "ip host server address login client",
}
_AWAY = "isbn version order invoice doi figure section page part serial issn".split()
_NEAR = {k: frozenset(v.split()) for k, v in _NEAR.items()}
_WORDS = re.compile(r"[^\W\d_]+")


def _format(kind: str, span: str) -> int:
    digits = _digits(span)
    if kind == "card":
        return 1 if luhn(digits) else -1
    if kind == "ssn":
        a, b, c = span.split("-")
        return -1 if a in ("000", "666") or a[0] == "9" or b == "00" or c == "0000" else 1
    if kind == "iban":
        plain = span.replace(" ", "")
        turned = plain[4:] + plain[:4]
        return 1 if int("".join(str(int(c, 36)) for c in turned)) % 97 == 1 else -1
    if kind == "phone":
        return 1 if 9 <= len(digits) <= 12 else -1
    if kind == "ip":
        return 1 if not span.startswith(("0.", "127.")) else -1
    return 0


def _gazetteer(kind: str, span: str) -> int:
    if kind == "email":
        return 1 if _WORDS.findall(span.lower())[-1:] and _WORDS.findall(span.lower())[-1] in _DOMAINS else -1
    if kind == "iban":
        return 1 if span[:2] in _COUNTRIES else -1
    if kind == "person":
        return 1 if any(w in _NAMES for w in _WORDS.findall(span.lower())[1:]) else 0
    if kind == "card":
        return 1 if span[0] in "3456" else -1
    return 0


def _context(kind: str, before: str) -> int:
    words = _WORDS.findall(before.lower())[-4:]
    if any(w in _NEAR[kind] for w in words):
        return 1
    return -1 if any(w in _AWAY for w in words) else 0


def _variety(span: str) -> int:
    digits = _digits(span)
    if len(digits) < 6:
        return 0
    if len(set(digits)) <= 2 or digits in "01234567890123456789" or digits in "98765432109876543210":
        return -1
    return 1


def _surroundings(text: str, a: int, b: int) -> int:
    left, right = text[a - 1 : a], text[b : b + 1]
    return -1 if left and left in "/=_#$" or right and right in "/=_%" else 0


def pattern(kind: str, text: str, a: int, b: int) -> str:
    """The kind, the votes, and the size and digits of a proposal in four steps each."""
    span = text[a:b]
    votes = [
        _format(kind, span), _gazetteer(kind, span), _context(kind, text[max(0, a - 48) : a]),
        _variety(span), _surroundings(text, a, b),
    ]
    size, digits = min(3, (b - a) // 10), min(3, len(_digits(span)) // 5)
    return ":".join([kind, *map(str, votes), str(size), str(digits)])


def proposals(text: str) -> list[Span]:
    found = []
    for kind, rule in _PROPOSALS.items():
        found += [(kind, *m.span()) for m in rule.finditer(text)]
    return found


def _read(batches):
    for batch in batches:
        base, more = [], []
        for text in batch.column(1):
            text = text.as_py() or ""
            mine = base_spans(text)
            base.append([{"kind": k, "start": a, "end": b, "pattern": pattern(k, text, a, b)}
                         for k, a, b in mine if k in BASE])
            more.append([{"kind": k, "start": a, "end": b, "pattern": pattern(k, text, a, b)}
                         for k, a, b in apart(proposals(text), mine)])
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()),
                                   ("end", pa.int64()), ("pattern", pa.string())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(base, kind), pa.array(more, kind)],
            names=["doc_id", "base", "more"],
        )


class LabelModel:
    """Reliabilities of the labelers by expectation-maximisation over vote patterns.

    P(vote | real) and P(vote | not real) for each labeler and the share of real spans for
    each kind are re-estimated in turn from the posteriors of all patterns, by their counts.
    """

    def __init__(self, kinds: np.ndarray, votes: np.ndarray, counts: np.ndarray, rounds: int = 50):
        self.share = np.full(len(KINDS), 0.5)
        # Before any data, a labeler is right more often than wrong.
        start = {-1: (0.15, 0.6), 0: (0.45, 0.35), 1: (0.4, 0.05)}
        self.table = np.array([[start[v] for v in (-1, 0, 1)]] * votes.shape[1])
        at = votes + 1
        labeler = np.arange(votes.shape[1])
        for _ in range(rounds):
            real = self.posterior(kinds, votes)
            for k in range(len(KINDS)):
                mine = kinds == k
                # Half the weight stays on even odds, so that votes decide and not the kind.
                n = counts[mine].sum()
                self.share[k] = (counts[mine] @ real[mine] + 0.25 * n + 1) / (1.5 * n + 2)
            fresh = np.array([[start[v] for v in (-1, 0, 1)]] * votes.shape[1]) * 20
            for j in labeler:
                for y, weight in enumerate((real, 1 - real)):
                    fresh[j, :, y] += np.bincount(at[:, j], counts * weight, minlength=3)
            # A labeler may be useless, but no vote speaks against itself: a yes is at least
            # twice as likely on real spans, a no on others.
            table = fresh / fresh.sum(axis=1, keepdims=True)
            table[:, 2, 1] = np.minimum(table[:, 2, 1], table[:, 2, 0] / 2)
            table[:, 0, 0] = np.minimum(table[:, 0, 0], table[:, 0, 1] / 2)
            self.table = table / table.sum(axis=1, keepdims=True)

    def posterior(self, kinds: np.ndarray, votes: np.ndarray) -> np.ndarray:
        logs = np.log(self.table[np.arange(votes.shape[1])[None, :], votes + 1]).sum(axis=1)
        logs += np.log(np.stack([self.share[kinds], 1 - self.share[kinds]], axis=1))
        return 1 / (1 + np.exp(np.clip(logs[:, 1] - logs[:, 0], -50, 50)))


def _matrix(patterns: list[str]) -> np.ndarray:
    rows = []
    for p in patterns:
        kind, *rest = p.split(":")
        row = [float(kind == k) for k in KINDS]
        for v in map(int, rest[:5]):
            row += [float(v == 1), float(v == -1)]
        for v in map(int, rest[5:]):
            row += [float(v == s) for s in range(4)]
        rows.append(row)
    return np.array(rows)


def span_classifier(patterns: list[str], counts: list[int], steps: int = 400) -> dict[str, float]:
    """The probability, by the final classifier, that a span of each pattern is real."""
    if not patterns:
        return {}
    parts = [p.split(":") for p in patterns]
    kinds = np.array([KINDS.index(p[0]) for p in parts])
    votes = np.array([[int(v) for v in p[1:6]] for p in parts])
    n = np.array(counts, dtype=float)
    real = LabelModel(kinds, votes, n).posterior(kinds, votes)
    x = np.hstack([_matrix(patterns), np.ones((len(patterns), 1))])
    weight = n / n.sum()
    w = np.zeros(x.shape[1])
    for _ in range(steps):  # Newton steps of a lightly penalised logistic regression
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        grad = x.T @ (weight * (p - real)) + 1e-4 * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    final = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
    return dict(zip(patterns, final.tolist()))


def find(docs: DataFrame, least: float = 0.9, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, base, added) of every row: base spans, and spans the classifier accepts.

    Null and empty texts have no spans; rows repeated in full, or without an id, have their
    own.  No rows give no rows.
    """
    rows = pick(docs, id_column, text)
    spans = "array<struct<kind: string, start: long, end: long, pattern: string>>"
    kind = rows.schema[0].dataType.simpleString()
    read = written(rows.mapInArrow(_read, f"doc_id {kind}, base {spans}, more {spans}"))
    counted = (
        read.select(F.explode(F.concat("base", "more")).alias("s"))
        .groupBy(F.col("s.pattern").alias("pattern"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("pattern")
        .collect()
    )
    odds = span_classifier([r.pattern for r in counted], [r.n for r in counted])
    accepted = docs.sparkSession.createDataFrame(
        [([p for p, v in sorted(odds.items()) if v >= least],)], "accepted array<string>"
    )
    # One row; its array is bounded by the number of patterns.
    judged = read.crossJoin(F.broadcast(accepted))
    plain = lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))
    return judged.select(
        "doc_id",
        F.transform("base", plain).alias("base"),
        F.transform(F.filter("more", lambda s: F.array_contains("accepted", s["pattern"])), plain).alias("added"),
    )


def digests(found: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of :func:`find`'s rows."""

    def run(batches):
        for batch in batches:
            out = {name: [] for name in [*BASE, "sha", "spans"]}
            for base, added in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                base = [(s["kind"], s["start"], s["end"]) for s in base]
                added = [(s["kind"], s["start"], s["end"]) for s in added]
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

    kind = found.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in BASE)
    return found.select("doc_id", "base", "added").mapInArrow(
        run, f"doc_id {kind}, {counts}, base_sha256 string, spans string"
    )
