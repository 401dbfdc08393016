"""Documents whose statistics lie far from those of their language and source.

Whole numbers are counted from every whole text and turned into a vector of four: the mean
length of words (logarithm), and the shares of symbols, of repeated lines and of words in
repeated windows (arc sine of the root, which evens out the spread of shares).  Each number is
divided by the least spread that is taken as meaningful (``FLOOR``).

The centre and scatter of each group are those of the half of its documents with the smallest
covariance determinant, so that up to half of a group may be junk without moving them.  The
vectors of all documents are summed up on a grid of cells a quarter of a floor wide: number,
sums and products, with partial sums on the map side.  A cell counts with the sums of all its
documents, only which cells belong to the half is decided cell by cell.  The number of cells is
bounded by the range of the numbers, whatever the size of the group, so one task can take the
steps of a group: from several starts, the half nearest to the centre by the present scatter
gives the next centre and scatter, until the determinant falls no more.  A last, weighted step
takes all documents that are not far off.

Groups with few documents are judged together with the other small ones of their language, and
languages with few together.  A document is rejected beyond the chosen quantile of the
chi-squared distribution of its squared Mahalanobis distance.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rowsmith.llm.common import pick, written
from rowsmith.llm.words import NOT_SPACE, blocks, lookup, run_hashes, spans, word_hashes

SYMBOLS = lookup(b"#*$%&|<>")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
#: The least meaningful spread of log word length and of the three transformed shares.
FLOOR = (0.08, 0.05, 0.25, 0.25)
DIMENSIONS = len(FLOOR)
CELL = 0.25  # width of a cell, in floors
BROADCAST = 50_000  # groups; a model has 21 numbers, so at most 10 MB are sent to a task
SALTS = 256  # beyond that, how many tasks may share a group's documents
_UPPER = [(i, j) for i in range(DIMENSIONS) for j in range(i, DIMENSIONS)]
_STARTS, _STEPS = 40, 30


def _repeated(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each hash came up before in its text, and whether it is there twice or more."""
    order = np.lexsort((hashes, owner))
    same = np.zeros(len(order) + 1, dtype=bool)
    same[1:-1] = (hashes[order[1:]] == hashes[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    again, twice = np.empty(len(order), dtype=bool), np.empty(len(order), dtype=bool)
    again[order], twice[order] = same[:-1], same[:-1] | same[1:]
    return again, twice


def statistics(data: np.ndarray, offsets: np.ndarray, width: int = 3) -> dict[str, np.ndarray]:
    """:data:`COUNTS` of each text: words, code points in them, symbols, lines with a word,
    those equal to an earlier one, words in ``width``-word windows found twice or more."""
    n = len(offsets) - 1
    starts, ends = spans(data, offsets, NOT_SPACE)
    first = np.searchsorted(starts, offsets)
    owner = np.repeat(np.arange(n), np.diff(first))
    inner = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int32)])
    chars = np.concatenate([[0], np.cumsum(inner[ends] - inner[starts], dtype=np.int64)])
    symbols = np.concatenate([[0], np.cumsum(SYMBOLS[data], dtype=np.int32)])

    hashes = word_hashes(data, starts, ends)
    windows = run_hashes(hashes, width)
    at = np.flatnonzero(owner[: len(windows)] == owner[width - 1 :])
    _, twice = _repeated(owner[at], windows[at])
    step = np.zeros(len(owner) + 1, dtype=np.int64)
    np.add.at(step, at[twice], 1)
    np.add.at(step, at[twice] + width, -1)
    covered = np.cumsum(step[:-1]) > 0

    breaks = np.flatnonzero(data == 0x0A)
    lines = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    line_ends = np.sort(np.concatenate([offsets[1:], breaks]), kind="stable")
    worded = np.searchsorted(starts, line_ends) > np.searchsorted(starts, lines)
    lines, line_ends = lines[worded], line_ends[worded]
    line_owner = np.searchsorted(offsets, lines, side="right") - 1
    again, _ = _repeated(line_owner, word_hashes(data, lines, line_ends))
    return {
        "n_words": np.diff(first),
        "word_chars": np.diff(chars[first]),
        "n_symbols": np.diff(symbols[offsets]).astype(np.int64),
        "n_lines": np.bincount(line_owner, minlength=n),
        "n_dup_lines": np.bincount(line_owner[again], minlength=n),
        "n_repeat_words": np.bincount(owner[covered], minlength=n),
    }


def _counted(schema: pa.Schema):
    def run(batches):
        for batch in batches:
            for first, data, offsets in blocks(batch.column(batch.num_columns - 1), 2 << 20):
                found = statistics(data, offsets)
                n = len(offsets) - 1
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(first, n) for i in range(batch.num_columns - 1)),
                     *(pa.array(found[c].astype(np.int64)) for c in COUNTS)], schema=schema,
                )

    return run


def vector() -> list:
    """The transformed statistics of a row, in floors."""
    def share(part: str, whole: str):
        return F.asin(F.sqrt(F.least(F.lit(1.0), F.col(part) / F.col(whole))))

    numbers = [
        F.log(F.col("word_chars") / F.col("n_words")), share("n_symbols", "word_chars"),
        share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words"),
    ]
    return [number / F.lit(floor) for number, floor in zip(numbers, FLOOR)]


def chi_squared(x: float, degrees: int) -> float:
    """The distribution function, for an even number of degrees of freedom."""
    term, total = 1.0, 0.0
    for k in range(degrees // 2):
        total += term
        term *= x / 2 / (k + 1)
    return 1 - math.exp(-x / 2) * total


def chi_squared_quantile(share: float, degrees: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_squared(middle, degrees) < share else (low, middle)
    return high


def _moments(weight, sums, products) -> tuple[np.ndarray, np.ndarray]:
    """Centre and covariance of weighted cells."""
    total = weight.sum()
    centre = weight @ sums / total
    scatter = np.zeros((DIMENSIONS, DIMENSIONS))
    for k, (i, j) in enumerate(_UPPER):
        scatter[i, j] = scatter[j, i] = weight @ products[:, k] / total - centre[i] * centre[j]
    return centre, scatter


def _distances(points: np.ndarray, centre: np.ndarray, scatter: np.ndarray) -> np.ndarray:
    off = points - centre
    return np.einsum("ni,ij,nj->n", off, np.linalg.inv(scatter), off)


def robust(count: np.ndarray, sums: np.ndarray, products: np.ndarray, share: float = 0.5):
    """(centre, scatter) of least covariance determinant of cells of vectors.

    ``sums`` and ``products`` (upper triangle) are means over each cell; cells are weighed by
    their number of vectors.  The half holds exactly ``share`` of the vectors, the last cell
    in part.  The identity, one floor to each side, is added to every scatter, so that numbers
    that are all the same do no harm.  Ties are settled by the order of the cells.
    """
    identity = np.eye(DIMENSIONS)
    n = int(count.sum())
    half = max(share * n, min(n, DIMENSIONS + 1))

    def nearest(centre, scatter) -> np.ndarray:
        order = np.argsort(_distances(sums, centre, scatter), kind="stable")
        before = np.cumsum(count[order]) - count[order]
        weight = np.empty(len(count))
        weight[order] = np.clip(half - before, 0, count[order])
        return weight

    def step(centre, scatter):
        centre, scatter = _moments(nearest(centre, scatter), sums, products)
        return centre, scatter + identity

    def middle(values, weight) -> np.ndarray:
        out = []
        for column in values.T:
            order = np.argsort(column, kind="stable")
            at = np.searchsorted(np.cumsum(weight[order]), weight.sum() / 2)
            out.append(column[order][min(at, len(order) - 1)])
        return np.array(out)

    median = middle(sums, count)
    spread = 1.4826 * middle(np.abs(sums - median), count)
    starts = [(median, np.diag(spread**2) + identity)]
    rng = np.random.default_rng(len(count))
    chance = count / n
    for _ in range(_STARTS):
        few = sums[rng.choice(len(count), DIMENSIONS + 1, p=chance)]
        starts.append((few.mean(axis=0), np.cov(few.T, bias=True) + identity))
    tried = [step(*step(*start)) for start in starts]
    tried.sort(key=lambda found: np.linalg.slogdet(found[1])[1])
    best = None
    for centre, scatter in tried[:5]:
        size = np.linalg.slogdet(scatter)[1]
        for _ in range(_STEPS):
            centre, scatter = step(centre, scatter)
            now = np.linalg.slogdet(scatter)[1]
            if now >= size - 1e-9:
                break
            size = now
        if best is None or size < best[0]:
            best = size, centre, scatter
    _, centre, scatter = best
    # The half nearest to the centre is narrower than the whole: make up for it.
    cut = chi_squared_quantile(half / n, DIMENSIONS) if half < n else math.inf
    factor = (half / n) / chi_squared(cut, DIMENSIONS + 2) if cut < math.inf else 1.0
    scatter = (scatter - identity) * factor + identity
    near = _distances(sums, centre, scatter) <= chi_squared_quantile(0.975, DIMENSIONS)
    if count[near].sum() >= half:
        centre, scatter = _moments(np.where(near, count, 0.0), sums, products)
        scatter = scatter + identity
    return centre, scatter


def _modelled(cells: pa.Table) -> pa.Table:
    """The centre and inverse scatter of one group."""
    values = np.stack([cells[c].to_numpy() for c in cells.column_names[1:]], axis=1)
    values = values[np.lexsort(values.T[::-1])]
    count = values[:, 0]
    means = values[:, 1:] / count[:, None]
    centre, scatter = robust(count, means[:, :DIMENSIONS], means[:, DIMENSIONS:])
    return pa.table({
        "pool": cells["pool"][:1],
        "model": pa.array([[*centre, *np.linalg.inv(scatter).ravel()]], pa.list_(pa.float64())),
    })


def _models(rows: DataFrame, least: int) -> DataFrame:
    """(group, model) of each group that has documents to judge."""
    y = [f"y{i}" for i in range(DIMENSIONS)]
    added = {"n": F.count(F.lit(1)).cast("double")}
    added |= {f"s_{c}": F.sum(c) for c in y}
    added |= {f"p_{i}{j}": F.sum(F.col(y[i]) * F.col(y[j])) for i, j in _UPPER}
    grid = [F.floor(F.col(c) / CELL).alias(f"c{i}") for i, c in enumerate(y)]
    at = [f"c{i}" for i in range(DIMENSIONS)]
    cells = written(
        rows.select("group", "wider", *y, *grid).groupBy("group", "wider", *at)
        .agg(*[c.alias(name) for name, c in added.items()])
    )
    sizes = cells.groupBy("group", "wider").agg(F.sum("n").alias("size"))
    small = sizes.where(F.col("size") < least).groupBy("wider").agg(F.sum("size").alias("rest"))
    pools = sizes.join(small, "wider", "left").select(
        "group",
        F.when(F.col("size") >= least, F.concat(F.lit("0"), "group"))
        .when(F.col("rest") >= least, F.concat(F.lit("1"), "wider"))
        .otherwise(F.lit("2")).alias("pool"),
    )
    pooled = cells.join(pools, "group").groupBy("pool", *at).agg(
        *[F.sum(name).alias(name) for name in added]
    )
    models = pooled.select("pool", *added).groupBy("pool").applyInArrow(
        _modelled, "pool string, model array<double>"
    )
    return pools.join(models, "pool").select(F.col("group").alias("g"), "model")


def judge(
    docs: DataFrame, quantile: float = 0.9999, least: int = 50,
    groups: tuple[str, str] = ("lang", "source"), id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, the counts, base_failed, distance, kept) of every row.

    Documents of fewer than 50 words, or with more than half of their words in repeated
    windows, have failed and are no part of any group's vectors; their distance is null.
    The others are kept unless their squared distance passes the ``quantile``.  ``groups``
    names the wider and the narrower grouping column, ``least`` the documents of a group that
    has a model of its own.

    Null and empty texts have no words and so have failed.  A null language or source is a
    value of its own.  Each row is judged by itself; repeated rows and ids count as often as
    they are there, and a group of equal rows has them all in its centre and keeps them.  No
    rows give no rows.
    """
    spark = docs.sparkSession
    rows = pick(docs, id_column, *groups, text).toDF("doc_id", "wide", "narrow", "text")
    kinds = [rows.schema[c].dataType for c in ("doc_id", "wide", "narrow")]
    arrow = [(c, to_arrow_type(k)) for c, k in zip(("doc_id", "wide", "narrow"), kinds)]
    schema = pa.schema([*arrow, *((c, pa.int64()) for c in COUNTS)])
    plain = ", ".join(f"{c} {k.simpleString()}" for c, k in zip(("doc_id", "wide", "narrow"), kinds))
    counted = rows.mapInArrow(
        _counted(schema), f"{plain}, " + ", ".join(f"{c} long" for c in COUNTS)
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    counted = written(counted.withColumn("base_failed", failed))
    numbers = [F.when(~F.col("base_failed"), v).alias(f"y{i}") for i, v in enumerate(vector())]
    wide = F.to_json(F.struct(F.col("wide").cast("string")))
    both = F.to_json(F.struct(F.col("wide").cast("string"), F.col("narrow").cast("string")))
    judged = counted.select(
        "doc_id", *COUNTS, "base_failed", wide.alias("wider"), both.alias("group"), *numbers
    )
    models = written(_models(judged.where("not base_failed"), least))
    if models.count() <= BROADCAST:
        joined = judged.join(F.broadcast(models), F.col("group") == F.col("g"), "left")
    else:
        salt = F.pmod(F.xxhash64("doc_id", *COUNTS), F.lit(SALTS))
        spread = models.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = judged.withColumn("own", salt).join(
            spread, (F.col("group") == F.col("g")) & (F.col("own") == F.col("salt")), "left"
        )
    off = [F.col(f"y{i}") - F.col("model")[i] for i in range(DIMENSIONS)]
    squared = sum(
        off[i] * off[j] * F.col("model")[DIMENSIONS + i * DIMENSIONS + j]
        for i in range(DIMENSIONS) for j in range(DIMENSIONS)
    )
    far = chi_squared_quantile(quantile, DIMENSIONS)
    return joined.select(
        "doc_id", *COUNTS, "base_failed", squared.alias("distance"),
    ).withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= far, F.lit(True)))
