"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positive sample; unlabelled text, of which an unknown
part is toxic, is the other.  With the class prior p the risk of a classifier is

    p E_pos[l(f)] + max(0, E_unl[l(-f)] - p E_pos[l(-f)]),

the second term being what the unlabelled sample says about clean text once the toxic part
is taken out.  Where it falls below zero the model fits noise, and the step is reversed.
The classifier is linear over the words of a text and the beginnings of its words, fitted
with numpy by Adam.

The prior is the share of toxic rows among the labels of the training fold, counted over
all of them, less one standard error, as too high a prior costs clean documents.  The two samples are bounded (``most`` rows each, texts of at most ``wide``
different words and beginnings; 8,000 x 32 KB at the defaults): distinct ids in the order of a
hash, and of the texts of a repeated id the one with the smallest hash.
Scores read every whole text, in one pass that shuffles nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.common import pick, place, ship
from rowsmith.llm.words import ALNUM, LOWER, blocks, spans, word_hashes

#: Bytes of the beginnings of words that are features beside whole words: endings vary.
BEGIN = (4, 5, 6, 7)


def held_out(id_column: str = "doc_id") -> Column:
    """Rows no label is learnt from: CRC-32 of the id as text, mod 5, is 0; rows without id."""
    fold = F.crc32(F.col(id_column).cast("string").cast("binary")) % 5
    return F.coalesce(fold == 0, F.lit(True))


def _words(data: np.ndarray, offsets: np.ndarray):
    """(text, 32-bit hash) of every word of all texts, and of how longer words begin."""
    data = LOWER[data]
    starts, ends = spans(data, offsets, ALNUM)
    counts = np.diff(np.searchsorted(starts, offsets))
    text = np.repeat(np.arange(len(counts)), counts)
    texts, hashes = [text], [word_hashes(data, starts, ends)]
    for size in BEGIN:
        long = ends - starts > size
        texts.append(text[long])
        hashes.append(word_hashes(data, starts[long], starts[long] + size) + np.uint64(size << 32))
    return np.concatenate(texts), (np.concatenate(hashes) >> np.uint64(32)).astype(np.uint32)


def _features(wide: int):
    def run(batches):
        for batch in batches:
            for first, data, offsets in blocks(batch.column(1)):
                text, hashes = _words(data, offsets)
                order = np.argsort(text, kind="stable")
                text, hashes = text[order], hashes[order]
                cuts = np.searchsorted(text, np.arange(len(offsets)))
                sets = [np.unique(hashes[a:b]) for a, b in zip(cuts, cuts[1:])]
                keep = [i for i, s in enumerate(sets) if len(s) <= wide]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(sets)).take(pa.array(keep, pa.int64())),
                     pa.array([sets[i].tobytes() for i in keep], pa.binary())],
                    names=["positive", "words"],
                )

    return run


class Model:
    """A weight for each of a few words, by hash, and a bias."""

    def __init__(self, names: np.ndarray, weights: np.ndarray, bias: float):
        self.names, self.weights, self.bias = names, weights, bias

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        total = np.full(n, self.bias)
        if len(self.names):
            text, hashes = _words(data, offsets)
            at = np.searchsorted(self.names, hashes)
            at[at == len(self.names)] = 0
            hit = self.names[at] == hashes
            pairs = np.unique(text[hit] * len(self.names) + at[hit])
            total += np.bincount(
                pairs // len(self.names), self.weights[pairs % len(self.names)], minlength=n
            )[:n]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def _chosen(positive, unlabelled, prior: float, most: int, least: float) -> np.ndarray:
    """Words that toxic text uses and clean text hardly does.

    Their share among clean texts is that of the unlabelled sample less the toxic part of
    it; toxic texts have the word ten times as often, and ``least`` standard errors more
    often than unlabelled ones.
    """
    flat = [np.concatenate(s) if s else np.zeros(0, np.uint32) for s in (positive, unlabelled)]
    names = np.unique(np.concatenate(flat))
    p, u = (np.bincount(np.searchsorted(names, f), minlength=len(names)) for f in flat)
    a, b = len(positive), len(unlabelled)
    mean = (p + u + 1) / (a + b + 2)
    z = (p / a - u / b) / np.sqrt(mean * (1 - mean) * (1 / a + 1 / b))
    clean = np.maximum(u / b - prior * p / a, 0) / (1 - prior)
    keep = np.flatnonzero((z >= least) & (p / a >= 10 * clean) & (p >= 4) & (p / a >= 0.01))
    keep = keep[np.argsort(-z[keep], kind="stable")[:most]]
    return np.sort(names[keep])


def _cut(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> float:
    """The score at which the non-negative risk of the decision itself is least.

    The smooth loss leaves a bias towards the larger class.  Where many cuts do as well, the
    middle of the widest gap between scores is taken.
    """
    edges = np.unique(np.concatenate([positive, unlabelled]))
    if len(edges) < 2:
        return 0.0
    cuts, gaps = (edges[1:] + edges[:-1]) / 2, np.diff(edges)
    share = lambda f: 1 - np.searchsorted(np.sort(f), cuts) / len(f)
    caught, marked = share(positive), share(unlabelled)
    risk = prior * (1 - caught) + np.maximum(marked - prior * caught, 0)
    best = np.flatnonzero(risk <= risk.min() + 1e-9)
    return float(cuts[best[gaps[best].argmax()]])


def fit(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float,
    words: int = 4096, least: float = 5.0, steps: int = 600, rate: float = 0.1,
    decay: float = 1e-4,
) -> Model:
    """The linear model of least non-negative risk.  Without positives all scores are the prior."""
    prior = min(max(prior, 1e-3), 0.499)
    blank = Model(np.zeros(0, np.uint32), np.zeros(0), float(np.log(prior / (1 - prior))))
    if not positive or not unlabelled:
        return blank
    names = _chosen(positive, unlabelled, prior, words, least)
    if not len(names):
        return blank

    def matrix(sets):
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        flat = np.concatenate(sets)
        at = np.searchsorted(names, flat)
        at[at == len(names)] = 0
        hit = names[at] == flat
        return row[hit], at[hit], len(sets)

    both = matrix(positive), matrix(unlabelled)
    value = np.zeros(len(names) + 1)
    value[-1] = blank.bias
    first, second = np.zeros_like(value), np.zeros_like(value)

    def forward(part):
        row, at, n = part
        return np.bincount(row, value[at], minlength=n) + value[-1]

    def back(part, slope):
        row, at, n = part
        grad = np.append(np.bincount(at, slope[row], minlength=len(names)), slope.sum())
        return grad / n

    loss = lambda f: np.logaddexp(0, -f)
    sigmoid = lambda f: 1 / (1 + np.exp(-np.clip(f, -40, 40)))
    best, kept = np.inf, value.copy()
    for step in range(1, steps + 1):
        fp, fu = forward(both[0]), forward(both[1])
        clean = loss(-fu).mean() - prior * loss(-fp).mean()
        risk = prior * loss(fp).mean() + max(0.0, clean) + decay / 2 * (value[:-1] ** 2).sum()
        if risk < best:
            best, kept = risk, value.copy()
        grad_clean = back(both[1], sigmoid(fu)) - prior * back(both[0], sigmoid(fp))
        if clean >= 0:
            grad = prior * back(both[0], sigmoid(fp) - 1) + grad_clean
        else:
            grad = -grad_clean
            grad[-1] = 0  # a prior set too high must not lift all scores
        grad += decay * np.append(value[:-1], 0)
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        value -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    value = kept
    return Model(names, kept[:-1], float(kept[-1]) - _cut(forward(both[0]), forward(both[1]), prior))


def train(
    docs: DataFrame, labels: DataFrame, most: int = 4000, wide: int = 8192,
    id_column: str = "doc_id", text: str = "text", label: str = "toxic",
) -> Model:
    """A model from the labels of the training fold; an id labelled twice is toxic if either is."""
    spark = docs.sparkSession
    known = pick(labels, id_column, label).toDF("doc_id", "toxic")
    known = known.where(~held_out() & F.col("toxic").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n, share = known.agg(F.count(F.lit(1)), F.avg(F.col("toxic").cast("double"))).first()
    share = share or 0.0
    prior = max(share - (share * (1 - share) / max(n, 1)) ** 0.5, share / 2)
    rows = pick(docs, id_column, text).toDF("doc_id", "text").where(~held_out())
    order = F.xxhash64("doc_id")
    ids = rows.select("doc_id").distinct()
    some = [
        known.where("toxic = 1").orderBy(order, "doc_id").limit(most).select("doc_id", F.lit(True)),
        ids.orderBy(order, "doc_id").limit(most).select("doc_id", F.lit(False)),
    ]
    wanted = spark.createDataFrame(
        [tuple(r) for part in some for r in part.collect()],
        f"wanted {rows.schema[0].dataType.simpleString()}, positive boolean",
    )
    # At most ``most`` ids of each sample; both are bounded by their ids alone.
    taken = rows.join(F.broadcast(wanted), F.col("doc_id") == F.col("wanted"))
    least = F.struct(F.col("text").isNull().alias("n"), F.xxhash64("text").alias("h"), "text")
    single = taken.groupBy("positive", "doc_id").agg(F.min(least).alias("least"))
    found = (
        single.select("positive", F.col("least.text").alias("text"))
        .mapInArrow(_features(wide), "positive boolean, words binary")
        .collect()
    )
    found.sort(key=lambda r: bytes(r.words))  # sums do not depend on the order of arrival
    sets = [[np.frombuffer(r.words, np.uint32) for r in found if r.positive == p] for p in (True, False)]
    return fit(sets[0], sets[1], prior)


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row; null and empty texts get the score of no words."""

    def run(batches):
        for batch in batches:
            for first, data, offsets in blocks(batch.column(1)):
                values = model.scores(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(values)), pa.array(values)],
                    names=["doc_id", "score"],
                )

    rows = pick(docs, id_column, text)
    return rows.mapInArrow(run, f"doc_id {rows.schema[0].dataType.simpleString()}, score double")


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; repeated rows are scored each."""
    found = score(docs, train(docs, labels))
    return found.select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def reject(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` scored below 0.5, all columns kept; one pass, no shuffle."""
    model = train(docs, labels)

    def run(batches):
        for batch in batches:
            for first, data, offsets in blocks(batch.column(at)):
                keep = pa.array(model.scores(data, offsets) < 0.5)
                yield batch.slice(first, len(keep)).filter(keep)

    columns = docs.columns
    at = place(columns, "text")
    ship(docs.sparkSession)
    plain = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    return plain.mapInArrow(run, plain.schema).toDF(*columns)
