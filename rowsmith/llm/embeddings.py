"""Near-duplicate vectors by product quantisation.

Vectors are compared at unit length, where cosine >= c means a distance of at most
r = sqrt(2 - 2c).  A k-means on a bounded sample gives coarse centroids, and product
codebooks for what is left of a vector after its centroid is taken off.  Every vector goes
into the inverted list of its nearest centroid, with a code of one byte per subspace and
the length ``err`` of what the code misses.

* Probes.  A vector y within r of x lies in the list of centroid b only if x is within r of
  the plane between its own centroid and b.  Along one direction a displacement of length r
  is r * sqrt(share) long in the mean, where ``share`` is that direction's part of the spread:
  1 / d if vectors vary alike in all directions, 1 / 2 if they lie on a surface.  It is
  estimated from what the sample leaves after the centroids, for all lists together (the
  widest direction) and for the list of x (the mean, less what few vectors feign), and the
  larger counts.  x probes every list whose plane is within ``slack`` times that length, and
  never needs more than r, which is exact.  There is no fixed number of probes.
* Table-lookup distances.  For each probe a table holds the squared distances from the
  query's subvectors to all codewords; sums of looked-up entries are distances to decoded
  vectors.  By the triangle inequality a pair with distance - err > r cannot link, so the
  codes drop no pair that the probes reach.
* Rerank.  Every other pair gets its exact cosine in double precision from the vectors.

A pair met from both sides counts at one of them, by a rule on the two lists.  Equal
vectors are one class with a count.  A list is cut into cells of ``home`` members by
``ask`` queries, so a list that holds most vectors spreads over tasks; a cell returns sums
of links and a tree, never its pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.common import components, pick, written
from rowsmith.llm.simhash import tree


def kmeans(points: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centroids after a few rounds, from evenly spaced starting points."""
    centres = points[np.linspace(0, len(points) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        at = nearest(points, centres)
        total = np.zeros_like(centres)
        np.add.at(total, at, points)
        n = np.bincount(at, minlength=k)
        centres[n > 0] = total[n > 0] / n[n > 0, None]
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.empty(len(points), dtype=np.int64)
    square = (centres**2).sum(axis=1)
    for low in range(0, len(points), 4096):
        part = points[low : low + 4096]
        out[low : low + 4096] = (square - 2 * part @ centres.T).argmin(axis=1)
    return out


class Index:
    """Coarse centroids and product codebooks for vectors of one length."""

    def __init__(self, sample: np.ndarray, rows: int, parts: int = 8, words: int = 256):
        self.size = sample.shape[1]
        self.lists = max(1, min(1024, round(math.sqrt(rows) / 2), len(sample) // 16))
        self.centres = kmeans(sample, self.lists)
        home = nearest(sample, self.centres)
        rest = sample - self.centres[home]
        self.share = self._shares(rest, home)
        parts = min(parts, self.size)
        self.cuts = np.linspace(0, self.size, parts + 1).astype(int)
        words = max(1, min(words, len(sample) // 4))
        self.books = [kmeans(rest[:, a:b], words) for a, b in zip(self.cuts, self.cuts[1:])]
        square = (self.centres**2).sum(axis=1)
        between = square[:, None] + square - 2 * self.centres @ self.centres.T
        self.between = np.sqrt(np.maximum(between, 1e-18))

    def _shares(self, rest: np.ndarray, home: np.ndarray) -> np.ndarray:
        """For each list, the part of the spread that one direction may have."""
        spread = np.linalg.eigvalsh(rest.T @ rest)
        least = spread[-1] / spread.sum() if spread.sum() > 0 else 1.0
        out = np.ones(self.lists)
        for name in range(self.lists):
            mine = rest[home == name]
            mine = mine - mine.mean(axis=0) if len(mine) > 2 else mine[:0]
            inner = mine @ mine.T if len(mine) < self.size else mine.T @ mine
            total = np.trace(inner) ** 2
            if total > 0:  # lists of one or two vectors, or of equal ones, tell nothing: exact
                out[name] = max(least, (inner**2).sum() / total - 1 / (len(mine) - 1))
        return np.minimum(out, 1.0)

    def encode(self, x: np.ndarray):
        """(list, codes, err) of unit vectors."""
        home = nearest(x, self.centres)
        rest = x - self.centres[home]
        codes = np.empty((len(x), len(self.books)), dtype=np.uint8)
        miss = np.zeros(len(x))
        for j, (a, b) in enumerate(zip(self.cuts, self.cuts[1:])):
            codes[:, j] = nearest(rest[:, a:b], self.books[j])
            miss += ((rest[:, a:b] - self.books[j][codes[:, j]]) ** 2).sum(axis=1)
        return home, codes, np.sqrt(miss)

    def probes(self, x: np.ndarray, home: np.ndarray, radius: float, slack: float) -> np.ndarray:
        """A row of flags for each vector: the lists whose plane is within its reach."""
        reach = radius * np.minimum(1, slack * np.sqrt(self.share[home]))[:, None]
        far = (self.centres**2).sum(axis=1) - 2 * x @ self.centres.T
        own = far[np.arange(len(x)), home][:, None]
        return (far - own) / (2 * self.between[home]) <= reach

    def distances(self, x: np.ndarray, name: int, codes: np.ndarray) -> np.ndarray:
        """Distances from queries to the decoded members of a list, by table lookup."""
        rest = x - self.centres[name]
        total = np.zeros((len(x), len(codes)))
        for j, (a, b) in enumerate(zip(self.cuts, self.cuts[1:])):
            book = self.books[j]
            part = rest[:, a:b]
            lookup = (part**2).sum(axis=1)[:, None] + (book**2).sum(axis=1) - 2 * part @ book.T
            total += lookup[:, codes[:, j]]
        return np.sqrt(np.maximum(total, 0))


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # squares stay finite
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(len(column), -1)


def _placed(indexes: dict[int, Index], cosine: float, slack: float):
    """Each class as a member of its list, and as a query of every list it probes."""
    radius = math.sqrt(2 - 2 * cosine)
    names = ["size", "list", "query", "rep", "n", "vector", "codes", "err", "probed"]

    def run(batches):
        for batch in batches:
            rep = batch.column(0).to_numpy()
            count = batch.column(1).to_numpy()
            vectors = batch.column(2)
            sizes = np.diff(vectors.offsets.to_numpy())
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                flat = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
                raw = flat.astype(np.float64).reshape(len(rows), size)
                x = unit(raw)
                index = indexes[size]
                home, codes, err = index.encode(x)
                flags = index.probes(x, home, radius, slack)
                bits = np.packbits(flags, axis=1)
                blobs = pa.array([v.tobytes() for v in x], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), size, np.int32)), pa.array(home.astype(np.int32)),
                     pa.array(np.zeros(len(rows), bool)), pa.array(rep[rows]), pa.array(count[rows]),
                     blobs, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(err),
                     pa.array([b.tobytes() for b in bits], pa.binary())],
                    names=names,
                )
                who, where = np.nonzero(flags)
                for low in range(0, len(who), 4096):
                    w, at = who[low : low + 4096], where[low : low + 4096]
                    empty = pa.nulls(len(w), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(w), size, np.int32)), pa.array(at.astype(np.int32)),
                         pa.array(np.ones(len(w), bool)), pa.array(rep[rows][w]), pa.array(count[rows][w]),
                         blobs.take(pa.array(w)), empty, pa.array(home[w].astype(np.float64)), empty],
                        names=names,
                    )

    return run


def _compared(indexes: dict[int, Index], cosine: float):
    radius = math.sqrt(2 - 2 * cosine) + 1e-6
    kind = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("v", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        asks = table["query"].to_numpy()
        homes, queries = table.filter(pa.array(~asks)), table.filter(pa.array(asks))
        if not len(homes) or not len(queries):
            return kind.empty_table()
        index, name = indexes[table["size"][0].as_py()], table["list"][0].as_py()
        y, x = _matrix(homes["vector"]), _matrix(queries["vector"])
        codes = np.frombuffer(b"".join(homes["codes"].to_pylist()), np.uint8).reshape(len(y), -1)
        err = homes["err"].to_numpy()
        probed = np.frombuffer(b"".join(homes["probed"].to_pylist()), np.uint8).reshape(len(y), -1)
        reps = np.concatenate([homes["rep"].to_numpy(), queries["rep"].to_numpy()])
        count = np.concatenate([homes["n"].to_numpy(), queries["n"].to_numpy()])
        from_list = queries["err"].to_numpy().astype(np.int64)
        links = np.zeros(len(reps), dtype=np.int64)
        pairs = []
        for low in range(0, len(x), 512):
            part = x[low : low + 512]
            q, h = np.nonzero(index.distances(part, name, codes) - err <= radius)
            q += low
            # The other way round this pair is met too if the member probes the query's list;
            # then the search in the higher list, or from the later vector, leaves it out.
            back = probed[h, from_list[q] // 8] >> (7 - from_list[q] % 8) & 1 == 1
            mine = ~back | (name < from_list[q]) | ((name == from_list[q]) & (reps[h] < reps[len(y) + q]))
            mine &= reps[h] != reps[len(y) + q]
            q, h = q[mine], h[mine]
            near = np.concatenate(
                [(x[q[a : a + 65536]] * y[h[a : a + 65536]]).sum(axis=1) >= cosine
                 for a in range(0, len(q), 65536)] or [np.zeros(0, bool)]
            )
            q, h = q[near] + len(y), h[near]
            np.add.at(links, q, count[h])
            np.add.at(links, h, count[q])
            pairs.append((q, h))
        root = tree(len(reps), *(np.concatenate(p) for p in zip(*pairs)))
        held = np.flatnonzero(links)
        return pa.table([reps[held], links[held], reps[root[held]]], schema=kind)

    return run


def near_duplicates(
    rows: DataFrame, cosine: float = 0.95, slack: float = 3.0, sample: int = 16_384,
    home: int = 1024, ask: int = 4096, id_column: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Vectors that are null, empty, zero, or hold null or non-finite components link with
    nothing and are their own component; so do vectors of different lengths with each
    other.  Repeated rows are different vectors that link.  A component without any id has
    none, and rows without an id are not kept.  The index is fitted on the ``sample``
    classes with the smallest hashes (fewer of long vectors: 2**22 numbers at most), and
    every row is indexed.
    """
    spark = rows.sparkSession
    plain = pick(rows, id_column, vector).toDF("vec_id", "embedding")
    fine = F.coalesce(
        F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists("embedding", lambda v: v != 0),
        F.lit(False),
    )
    plain = written(plain.select("vec_id", "embedding", F.monotonically_increasing_id().alias("rid"), fine.alias("fine")))
    good = plain.where("fine").select("rid", "vec_id", "embedding")
    classes = written(
        good.groupBy("embedding").agg(
            F.min("rid").alias("rep"), F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least")
        )
    )
    sizes = classes.groupBy(F.size("embedding").alias("size")).count().collect()
    indexes = {}
    for size, count in sizes:
        some = (
            classes.where(F.size("embedding") == size)
            .orderBy(F.xxhash64("embedding"), "rep")
            .limit(max(16, min(sample, (1 << 22) // size)))
            .select("embedding")
            .collect()
        )
        indexes[size] = Index(unit(np.array([r[0] for r in some], dtype=np.float64)), count)
    placed = written(
        classes.select("rep", "n", "embedding").mapInArrow(
            _placed(indexes, cosine, slack),
            "size int, list int, query boolean, rep long, n long, vector binary, codes binary, "
            "err double, probed binary",
        )
    )
    full = placed.groupBy(F.col("size").alias("s"), F.col("list").alias("l")).agg(
        F.ceil(F.count_if(~F.col("query")) / home).cast("int").alias("homes"),
        F.ceil(F.count_if("query") / ask).cast("int").alias("asks"),
    )
    spread = placed.join(full, (F.col("size") == F.col("s")) & (F.col("list") == F.col("l"))).where("homes > 0")
    mine = F.when(F.col("query"), F.col("asks")).otherwise(F.col("homes"))
    others = F.when(F.col("query"), F.col("homes")).otherwise(F.col("asks"))
    dealt = spread.where(others > 0).select(
        "size", "list", "query", "rep", "n", "vector", "codes", "err", "probed",
        F.pmod(F.xxhash64("rep", "list"), mine).alias("mine"),
        F.explode(F.sequence(F.lit(0), others - 1)).alias("other"),
    )
    cells = dealt.withColumn("h", F.when(F.col("query"), F.col("other")).otherwise(F.col("mine")))
    cells = cells.withColumn("q", F.when(F.col("query"), F.col("mine")).otherwise(F.col("other")))
    found = written(
        cells.drop("mine", "other")
        .groupBy("size", "list", "h", "q")
        .applyInArrow(_compared(indexes, cosine), "rep long, links long, v long")
    )
    roots = components(found.select(F.col("rep").alias("u"), "v"))
    linked = found.groupBy("rep").agg(F.sum("links").alias("links")).withColumnRenamed("rep", "r")
    named = (
        classes.join(linked, F.col("rep") == F.col("r"), "left")
        .join(roots, F.col("rep") == F.col("node"), "left")
        .select(
            "rep", "embedding", "least", F.coalesce("root", "rep").alias("root"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        )
    )
    named = written(named)
    least = named.groupBy(F.col("root").alias("o")).agg(F.min("least").alias("component_id"))
    named = named.join(least, F.col("root") == F.col("o")).select(
        F.col("embedding").alias("e"), "n_links", "component_id"
    )
    joined = good.join(named, F.col("embedding") == F.col("e")).select("vec_id", "n_links", "component_id")
    alone = plain.where("not fine").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return joined.union(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )
