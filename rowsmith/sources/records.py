"""Record tables: text scans, ordinals and typed schemas."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.text import quoted, sql_trim
from ..session import written

ROW_IDX = "row_idx"


def read_records(
    spark: SparkSession,
    path: str | list[str],
    multiline: bool = True,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """UTF-8 delimited records with a header row; every column is text.

    ``multiline=True`` reads quoted cells with line breaks, at the price of one
    task per file; ``False`` lets Spark split files without such cells.
    :func:`scan_records` splits files with them too.
    """
    reader = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("encoding", "UTF-8")
        .option("multiLine", multiline)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
    )
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


# A cell of a line that begins outside of quotes: quoted and closed, plain, or empty.  A quote
# inside a plain cell is a letter like others.  All repeats are possessive: nothing is retried.
_QUOTED = r'"(?:[^"]++|"")*+'
_CELLS = rf'(?:(?:{_QUOTED}"[^,]*+|[^",][^,]*+|),)*+'
#: Does a line leave a quoted cell open, if it begins outside of one, or inside?
_OPENS = rf'\A{_CELLS}{_QUOTED}\z'
_STAYS = rf'\A(?:[^"]++|"")*+(?:"[^,]*+,{_CELLS}{_QUOTED})?\z'


def scan_records(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Delimited records as :func:`read_records` gives them, read by many tasks a file.

    A line break inside quotes does not end a record, and a task that begins in the middle of
    a file cannot see the quotes before.  So files are read as lines, and each line is a map
    from (outside, inside a quoted cell) at its start to the same at its end.  Such maps are
    put together in any grouping: each split gives one for all its lines, those of the splits
    before it tell the state it begins in, and a running state tells which lines begin a
    record.  Lines that are records alone go on as they are; only lines of longer records are
    shuffled, to be joined.  Spark parses the records.

    The lines are written to the shared folder once, so that splits stay what they are.  The
    header is the first record of every file and must be the same in all.  Empty lines outside
    of quotes are no records.  A window sorts the lines of one split, never of a file.
    """
    names = spark.createDataFrame([], schema) if schema else read_records(spark, path)
    kind = T.StructType([T.StructField(c, T.StringType()) for c in names.columns])
    open_at = [F.col("value").rlike(p).cast("int") for p in (_OPENS, _STAYS)]
    lines = written(
        spark.read.option("lineSep", "\n").text(path).select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
            open_at[0].alias("outside"),
            open_at[1].alias("inside"),
        )
    )
    split = Window.partitionBy("file", "block").orderBy("line")
    before = split.rowsBetween(Window.unboundedPreceding, -1)
    # A line whose two ends are equal settles the state; one that swaps them turns it.
    turns = F.sum(F.when((F.col("outside") == 1) & (F.col("inside") == 0), 1).otherwise(0))
    settled = F.when(F.col("outside") == F.col("inside"), F.col("outside"))
    ran = lines.withColumn("turned", turns.over(split)).withColumn("settled", settled)
    at_last = F.when(F.col("settled").isNotNull(), F.struct("settled", "turned"))
    ran = ran.withColumn("mark", F.last(at_last, ignorenulls=True).over(before))
    ran = ran.withColumn("so_far", F.coalesce(F.lag("turned").over(split), F.lit(0)))
    # The state at the split's own end, for both states at its start.
    ends = lines.join(
        lines.groupBy("file", "block").agg(F.max("line").alias("line")), ["file", "block", "line"]
    ).select("file", "block", "line")
    ends = ran.join(ends, ["file", "block", "line"]).select(
        "file", "block",
        F.when(F.col("settled").isNotNull(), F.struct("settled", "turned"))
        .otherwise(F.col("mark")).alias("mark"), "turned",
    )
    files = Window.partitionBy("file").orderBy("block")
    earlier = files.rowsBetween(Window.unboundedPreceding, -1)
    value = F.col("mark.settled")
    after = (F.col("turned") - F.coalesce(F.col("mark.turned"), F.lit(0))) % 2
    splits = ends.withColumn("left_over", after).withColumn("known", value)
    splits = splits.withColumn("all_turns", F.sum("left_over").over(files))
    known = F.when(F.col("known").isNotNull(), F.struct("known", "left_over", "all_turns"))
    last = F.last(known, ignorenulls=True).over(earlier)
    turns_before = F.coalesce(F.lag("all_turns").over(files), F.lit(0))
    begins = splits.withColumn("last", last).withColumn("turns_before", turns_before).select(
        F.col("file").alias("f"),
        F.col("block").alias("b"),
        F.when(F.col("last").isNull(), F.col("turns_before"))
        .otherwise(
            F.col("last.known") + F.col("last.left_over")
            + F.col("turns_before") - F.col("last.all_turns")
        ).alias("begin"),
    )
    state = (
        F.when(F.col("mark").isNull(), F.col("begin") + F.col("so_far"))
        .otherwise(F.col("mark.settled") + F.col("so_far") - F.col("mark.turned"))
    )
    stated = ran.join(begins, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b"))).select(
        "value", "file", "block", "line", F.pmod(state, F.lit(2)).alias("state"),
        "outside", "inside",
    )
    ended = F.when(F.col("state") == 0, F.col("outside")).otherwise(F.col("inside"))
    stated = stated.withColumn("ended", ended)
    # A record's lines have the place of its first; a record that goes on in the next split
    # finds it as the last beginning of the splits before.
    starts = F.when(F.col("state") == 0, F.struct("block", "line"))
    stated = stated.withColumn("own", F.last(starts, ignorenulls=True).over(split))
    alone = stated.where("state = 0 and ended = 0")
    parts = stated.where("state <> 0 or ended <> 0")
    heads = parts.where("state = 0").groupBy("file", "block").agg(
        F.max(F.struct("block", "line")).alias("head")
    )
    reach = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = lines.select("file", "block").distinct().join(heads, ["file", "block"], "left").select(
        F.col("file").alias("f"), F.col("block").alias("b"),
        F.last("head", ignorenulls=True).over(reach).alias("carried"),
    )
    joined = (
        parts.join(carried, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b")))
        .withColumn("first", F.coalesce("own", "carried"))
        .groupBy("file", "first")
        .agg(F.array_sort(F.collect_list(F.struct("block", "line", "value"))).alias("lines"))
        .select("file", F.col("first.block").alias("block"), F.col("first.line").alias("line"),
                F.array_join("lines.value", "\n").alias("value"))
    )
    # The first record of each file is its header.
    top = lines.where("block = 0").groupBy("file").agg(F.min("line").alias("top")).select(
        F.col("file").alias("f"), "top"
    )
    body = F.regexp_replace("value", r"\r\z", "")
    records = (
        alone.select("file", "block", "line", "value").unionByName(joined)
        .join(top, (F.col("file") == F.col("f")) & (F.col("block") == 0) & (F.col("line") == F.col("top")), "left_anti")
        .select(body.alias("value"))
        .where("value <> ''")
    )
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}
    ddl = ", ".join(f"{quoted(f.name)} string" for f in kind.fields)
    return records.select(F.from_csv("value", ddl, options).alias("record")).select("record.*")


def with_row_idx(
    df: DataFrame, order_by: str | None = None, start: int = 2, name: str = ROW_IDX
) -> DataFrame:
    """Add the record ordinal the order-sensitive jobs use.

    With ``order_by`` the caller's unique numeric order column is used as it is.
    Without it ``df`` must be a file scan: rows are numbered densely from ``start`` in
    path and line order.  Filter afterwards.

    Formats that tell a row's place in its file (Parquet) need the rows per file only.
    Others are read once, tagged with their split and their order in it, and written to
    the shared folder; counts and numbers come from that copy, so a second reading that
    splits the files elsewhere cannot lose or misnumber rows.  Files are numbered by one
    window over files, splits by a window within their file; rows never are.  The
    offsets, a row per file or split (no more than the driver lists to plan the scan), go
    to all tasks: a join by path would send all rows of a file to one of them.  A row
    whose file or split has no count stops the job.
    """
    if order_by is not None:
        return df.withColumn(name, F.col(quoted(order_by)).cast("bigint"))
    path = F.col("_metadata.file_path").alias("__path")
    columns = [F.col(quoted(c)) for c in df.columns]
    try:
        tagged = df.select(*columns, path, F.col("_metadata.row_index").alias("__row"))
    except AnalysisException:
        block = F.col("_metadata.file_block_start").alias("__block")
        # A split is read by one task in line order, so its ids are consecutive.
        tagged = written(
            df.select(*columns, path, block, F.monotonically_increasing_id().alias("__row"))
        )
        places = tagged.groupBy("__path", "__block").agg(
            F.count(F.lit(1)).alias("n"), (-F.min("__row")).alias("shift")
        )
    else:
        places = tagged.groupBy("__path").agg((F.max("__row") + 1).alias("n"), F.lit(0).alias("shift"))
    within = [c for c in places.columns if c.startswith("__")]
    files = places.groupBy("__path").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("__path").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select(
        F.col("__path").alias("__file"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("files")
    )
    if "__block" in within:
        before = Window.partitionBy("__path").orderBy("__block").rowsBetween(
            Window.unboundedPreceding, -1
        )
        places = places.withColumn("shift", F.col("shift") + F.coalesce(F.sum("n").over(before), F.lit(0)))
    offsets = places.join(files, F.col("__path") == F.col("__file")).select(
        *within, (F.col("shift") + F.col("files")).alias("offset")
    )
    known = F.coalesce(
        F.col("offset"), F.raise_error(F.lit("A row has no place among the counted files")).cast("bigint")
    )
    return (
        tagged.join(F.broadcast(offsets), within, "left")
        .withColumn(name, F.col("__row") + known + F.lit(start))
        .drop(*within, "__row", "offset")
    )


def apply_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast text records to the fields of ``schema``; bad cells become null.

    Whole-number fields accept decimal text and round half-even, as the typed
    staging step of a BI tool does.  Columns outside the schema are kept.
    """
    kinds = {f.name: f.dataType for f in schema.fields}
    out = []
    for column in df.columns:
        value = F.col(quoted(column))
        kind = kinds.get(column)
        if kind is None or isinstance(kind, T.StringType):
            out.append(value)
        elif isinstance(kind, T.IntegralType):
            number = sql_trim(value.cast("string")).try_cast(T.DecimalType(38, 10))
            out.append(F.bround(number, 0).try_cast(kind).alias(column))
        else:
            out.append(sql_trim(value.cast("string")).try_cast(kind).alias(column))
    return df.select(*out)
