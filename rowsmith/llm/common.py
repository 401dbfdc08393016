"""Helpers the training-data operators share: columns, shared tables, ranks, labels."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowsmith.session import written


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    archive = f"{tempfile.mkdtemp(prefix='rowsmith-code-')}/{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def place(columns: list[str], name: str) -> int:
    """Where a column stands: by exact name, else without regard to case."""
    return columns.index(name) if name in columns else [c.lower() for c in columns].index(name.lower())


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, in this order.

    Columns are found by exact name first, then without regard to case, so that extra
    columns whose names clash with ours, or differ from them in case only, do no harm.
    """
    ship(df.sparkSession)
    columns = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(columns))])
    chosen = []
    for name in names:
        chosen.append(F.col(f"c{place(columns, name)}").alias(name))
    return plain.select(*chosen)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_key(text):
    """A hash of a text by which rows of one id are told apart; 0 for no text."""
    return F.when(text.isNull(), F.lit(0)).otherwise(F.xxhash64(text))


def keep_rows(df: DataFrame, name: str, ids: DataFrame, how: str) -> DataFrame:
    """The rows of ``df`` whose ``name`` is (``left_semi``) or is not (``left_anti``) in ``ids``.

    All columns stay as they are, also columns whose names clash; null equals null.
    """
    columns = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(columns))])
    at = place(columns, name)
    wanted = ids.toDF("_id")
    joined = plain.join(wanted, F.col(f"c{at}").eqNullSafe(F.col("_id")), how)
    return joined.toDF(*columns)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """A gapless number from 0 within ``keys``, in no task more than a share of one key.

    Rows are dealt to cells by a hash of ``order``; they are numbered within their cell,
    and each cell starts where the ones before it end.  The cells of a key are about four
    to each shuffle partition, so that a key with most rows still splits evenly.
    """
    cells = 4 * partitions(df.sparkSession)
    dealt = df.withColumn("_cell", F.pmod(F.xxhash64(*order), F.lit(cells)))
    starts = _starts(dealt.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_n")), keys)
    within = F.row_number().over(_window([*keys, "_cell"], order)) - 1
    on = [dealt[k].eqNullSafe(starts[f"_k_{k}"]) for k in keys]
    rows = dealt.withColumn("_within", within)
    joined = rows.join(starts, [*on, rows["_cell"] == starts["_c"]], "left")
    drop = ["_cell", "_within", "_start", "_c", *[f"_k_{k}" for k in keys]]
    return joined.withColumn(name, F.col("_start") + F.col("_within")).drop(*drop)


def _window(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def _starts(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Where each cell begins: at most as many rows for a key as there are cells."""
    before = _window(keys, ["_cell"]).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_cell").alias("_c"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with a link; the root is the smallest node reachable.

    ``edges`` has two long columns ``u`` and ``v``.  Alternating star contraction: every
    node's larger neighbours, then its smaller ones, are tied to the smallest node it
    knows, until nothing changes.  Rounds grow with the logarithm of the longest chain.
    Each round is written to the shared folder, so that no lineage piles up.
    """
    links = edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    links = written(links.distinct())
    state = _state(links)
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("k"), F.least("u", "m").alias("m")
        )
        large = (
            both.where("v > u")
            .join(least, F.col("u") == F.col("k"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        small = large.join(low, F.col("u") == F.col("k")).select(
            F.explode(
                F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")),
                        F.struct(F.col("u").alias("a"), F.col("m").alias("b")))
            ).alias("e")
        )
        links = written(
            small.select(F.col("e.a").alias("u"), F.col("e.b").alias("v"))
            .where("u <> v")
            .distinct()
        )
        now = _state(links)
        if now == state:
            break
        state = now
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _state(links: DataFrame):
    row = links.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return tuple(row)
