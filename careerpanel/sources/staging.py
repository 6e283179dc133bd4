"""Written intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar, Token

from pyspark.sql import DataFrame, SparkSession

_written: ContextVar[list[tuple[str, str | None]] | None] = ContextVar("written", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="careerpanel-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/careerpanel-{name}-{uuid.uuid4().hex}"


def _keep_track(path: str, table: str | None = None) -> None:
    written = _written.get()
    if written is not None:
        written.append((path, table))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system it lies."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """Intermediate tables that are written inside are deleted at the end, also after an error. Frames that
    read them are of no use afterwards: write or collect what is wanted inside, or stage it with the function
    that the block is given, whose tables outlive it as if they were written around it."""
    token = _written.set([])

    def keep(df: DataFrame, name: str = "stage") -> DataFrame:
        inner = _written.set(token.old_value if token.old_value is not Token.MISSING else None)
        try:
            return stage(df, name)
        finally:
            _written.reset(inner)

    try:
        yield keep
    finally:
        written = _written.get()
        _written.reset(token)
        for path, table in written:
            if table is not None:
                spark.sql(f"DROP TABLE IF EXISTS {table}")
            remove(spark, path)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: later passes start there,
    read only the columns they need, and survive the loss of executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    _keep_track(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_bucketed(df: DataFrame, key: str, order: list[str], buckets: int, name: str = "stage") -> DataFrame:
    """Like :func:`stage`, as a table in ``buckets`` buckets of ``key``, each sorted by ``order``.

    What reads it is placed by ``key`` already: windows and aggregates over ``key`` and joins of two such tables
    take no exchange. Rows that were dealt by ``repartition(buckets, key)`` make one file per bucket.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    table = f"careerpanel_{name}_{uuid.uuid4().hex}".replace("-", "_")
    _keep_track(path, table)
    df.write.bucketBy(buckets, key).sortBy(*order).option("path", path).saveAsTable(table)
    return spark.table(table)
