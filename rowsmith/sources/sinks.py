"""Writers.  Spark writes a folder of part files per table."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import quoted

CURRENT = "current"  # the file that names the current version of published tables


def write_csv(
    df: DataFrame, path: str, quote_all: bool = False, order_by: Sequence[str] = ()
) -> None:
    """Header and fixed column order; overwrites; quotes inside a cell are doubled, and cells
    keep the white space around them.

    With ``order_by`` the part files, in the order of their names, hold the rows in key
    order; the sort is by ranges of the key, so no task holds more than a part.
    """
    ordered = df.orderBy(*[F.col(quoted(c)) for c in order_by]) if order_by else df
    (
        ordered.write.mode("overwrite")
        .option("header", True)
        .option("quoteAll", quote_all)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_summary(summary: DataFrame, path: str) -> None:
    """One JSON object per row of a summary table."""
    summary.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_document(
    header: DataFrame, sections: Mapping[str, tuple[DataFrame, Sequence[str]]], path: str
) -> None:
    """One JSON object in part files: joined in the order of their paths they are the document.

    ``header`` is one row, whose columns are the object's first fields; each of ``sections`` is
    a field with an array of the rows of a table, in the order of the named columns, then of
    the rows' own text.  Entries are written by as many tasks as there are ranges of them, and
    no task or row holds an array.
    """
    spark = header.sparkSession
    digits = len(str(2 * len(sections) + 1))

    def part(place: int, name: str, lines: DataFrame) -> None:
        lines.write.mode("overwrite").text(f"{path}/{place:0{digits}}-{name}")

    def frame(place: int, name: str, text: str) -> None:
        part(place, name, spark.createDataFrame([(text,)], "value string").coalesce(1))

    first = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    opened = F.expr("substring(value, 1, length(value) - 1)")
    part(0, "header", header.select(first.alias("value")).select(opened).coalesce(1))
    for i, (name, (rows, order)) in enumerate(sections.items()):
        key = F.struct(*[F.col(quoted(c)) for c in order], first.alias("entry"))
        # Equal entries are one row with a number, so that exactly one row is the first.
        counted = rows.select(key.alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        least = counted.agg(F.min("key").alias("least"))
        listed = counted.join(F.broadcast(least)).select(
            "key", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("i"),
            (F.col("key") == F.col("least")).alias("leads"),
        )
        comma = F.when(F.col("leads") & (F.col("i") == 1), F.lit("")).otherwise(F.lit(","))
        body = listed.orderBy("key", "i").select(F.concat(comma, F.col("key.entry")))
        closed = "]" if i else ""
        frame(2 * i + 1, name, f'{closed}, "{name}": [')
        part(2 * i + 2, f"{name}-entries", body)
    frame(2 * len(sections) + 1, "end", "]}" if sections else "}")


def publish(tables: Mapping[str, DataFrame], root: str) -> str:
    """Write tables as JSON below a new folder in ``root`` and make it the current one.

    The tables may read the version they replace: it stays where it is.  The name of the
    current version is one small file, put in place by a rename once all is written; a job that
    dies before leaves the old version current.  Returns the new version's name.
    """
    spark = next(iter(tables.values())).sparkSession
    version = f"version-{uuid.uuid4().hex}"
    for name, table in tables.items():
        write_summary(table, f"{root}/{version}/{name}")
    switch(spark, root, version)
    return version


def switch(spark: SparkSession, root: str, version: str) -> None:
    """Make a written version the current one, in one step."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    new, now = hadoop.Path(f"{root}/.{version}"), hadoop.Path(f"{root}/{CURRENT}")
    stream = new.getFileSystem(conf).create(new, True)
    stream.write(version.encode())
    stream.close()
    files = hadoop.FileContext.getFileContext(new.getFileSystem(conf).getUri(), conf)
    rename = spark.sparkContext._gateway.jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    files.rename(files.makeQualified(new), files.makeQualified(now), options)


def current(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """A table of the current version; no rows where none was published."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    now = hadoop.Path(f"{root}/{CURRENT}")
    if not now.getFileSystem(conf).exists(now):
        return spark.createDataFrame([], schema)
    version = spark.read.text(f"{root}/{CURRENT}").first()[0]
    return spark.read.schema(schema).json(f"{root}/{version}/{name}")
