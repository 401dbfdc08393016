"""Session settings shared by the jobs."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Public Spark settings the jobs run best with.  Rules and date layouts make long
# expressions, and the JVM does not compile methods above 8000 bytes: stages that
# would exceed that are better run operator by operator.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to a running session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one that ``spark.checkpoint.dir`` names.

    Only a session whose executors run in the driver's own process, as in tests, may do
    without the setting; it gets a temporary folder.  Elsewhere such a folder would be
    lost with its machine, so a missing setting is an error.
    """
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("Set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="rowsmith-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/rowsmith-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: later steps read it and recompute nothing."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._written_at = path
    return table


def dropped(table: DataFrame) -> None:
    """Delete a table that :func:`written` made and nothing reads any more."""
    path = getattr(table, "_written_at", None)
    if path:
        session = table.sparkSession
        place = session._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(session._jsc.hadoopConfiguration()).delete(place, True)


def cut_lineage(df: DataFrame, instead_of: DataFrame | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back from there.

    ``instead_of`` is a table that it takes the place of, deleted once ``df`` is written.
    """
    table = written(df)
    if instead_of is not None:
        dropped(instead_of)
    return table
