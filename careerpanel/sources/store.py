"""Tables that stay: a bucketed panel, and an episode store that takes each batch exactly once."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careerpanel.schema import conform

#: One row per batch of a load that is complete. ``print`` adds up the hashes of its rows.
LEDGER = T.StructType(
    [
        T.StructField("load", T.StringType()),
        T.StructField("pn_batch", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("print", T.DecimalType(38, 0)),
        T.StructField("folder", T.LongType()),
    ]
)

#: Leading bits of a batch number that its folder is named by.
FOLDER_BITS = 9


# --- folders of batches ---------------------------------------------------------------------


def folder_of(batch: Column) -> Column:
    """The folder of a batch: its number with all but its ``FOLDER_BITS`` leading bits set to 0.

    So the first 511 batches have a folder each, and a later folder holds at most a 256th of the batches up to it:
    the number of folders grows with the logarithm of the number of batches, and no batch ever moves.
    """
    spare = F.length(F.bin(batch)) - FOLDER_BITS
    cut = F.call_function("shiftleft", F.call_function("shiftright", batch, spare), spare)
    return F.when(batch >= 1 << FOLDER_BITS, cut).otherwise(batch)


def read_folders(spark: SparkSession, path: str) -> DataFrame:
    """A table in folders of batches, with ``_folder`` and ``pn_batch``. Folders that aren't asked for are not read.

    In tables that were written before folders held several batches, a folder's name is the batch.
    """
    rows = spark.read.parquet(path)
    if "_batch" not in rows.columns:
        rows = spark.read.schema(T.StructType([*rows.schema, T.StructField("_batch", T.LongType())])).parquet(path)
    folder = F.col("pn_batch").cast("long")
    return rows.withColumns({"_folder": folder, "pn_batch": F.coalesce("_batch", folder)}).drop("_batch")


def write_folders(df: DataFrame, path: str, *within: str, order: tuple[str, ...] = ()) -> None:
    """The folders named by ``_folder``, and in them by ``within``, are replaced, others stay. Small folders share a
    task, large ones are cut."""
    df = df.withColumnsRenamed({"pn_batch": "_batch", "_folder": "pn_batch"}).hint("rebalance", F.col("pn_batch"))
    df = df.sortWithinPartitions("pn_batch", *within, *order) if order else df
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("pn_batch", *within).parquet(path)


# --- bucketed tables: S5 --------------------------------------------------------------------


def save_bucketed(
    df: DataFrame, path: str, buckets: int, key: str = "persnr", order: tuple[str, ...] = ("persnr", "year"), placed: bool = False
) -> None:
    """A finished table in ``buckets`` buckets of ``key``, one file each, sorted by ``order``.

    A note beside the files says how they are dealt, so that :func:`open_bucketed` finds it in any session. Rows
    that are ``placed`` by ``key`` in as many partitions already, as those of a table in such buckets are, aren't dealt anew.
    """
    spark = df.sparkSession
    name = f"careerpanel_{uuid.uuid4().hex}"
    dealt = df if placed else df.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(*order).option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")
    note = spark.createDataFrame([(buckets, key, list(order))], "buckets int, key string, order array<string>")
    note.coalesce(1).write.json(f"{path}/_bucketed")


def open_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A table of :func:`save_bucketed`: windows over its key and joins with a table that is dealt alike take
    no exchange, and files of other buckets are skipped where the key is given."""
    note = spark.read.json(f"{path}/_bucketed").first()
    if note is None:
        raise ValueError(f"{path} is no bucketed table")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    name = f"careerpanel_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({note['key']}) SORTED BY ({', '.join(note['order'])})"
        f" INTO {note['buckets']} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


# --- episodes by batch: S3 ------------------------------------------------------------------


@dataclass(frozen=True)
class EpisodeStore:
    """Episodes in folders by batches and load, with a ledger of the batches that are complete.

    ``append`` writes a batch's rows first and enters it in the ledger then. What is not in the ledger doesn't
    exist: ``read`` leaves it out, and the next append of that batch writes over it or elsewhere. So an append that is
    repeated, or that broke off anywhere and is repeated, leaves what one whole append leaves. One writer at
    a time.

    The batches of an append that ``folder_of`` puts together share a folder, named by the first of them. As that batch
    is new, no complete batch is ever written over. The ledger says where a batch lies.
    """

    spark: SparkSession
    path: str

    @property
    def _rows(self) -> str:
        return f"{self.path}/rows"

    @property
    def _ledger(self) -> str:
        return f"{self.path}/ledger"

    def exists(self, path: str) -> bool:
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)

    def ledger(self) -> DataFrame:
        """(load, pn_batch, n, print, folder): the complete batches. A row per batch and load."""
        if not self.exists(self._ledger):
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(self._ledger).withColumn("folder", F.coalesce("folder", "pn_batch"))

    def append(self, df: DataFrame, load: str = "1") -> DataFrame:
        """S3: adds the batches of ``df`` (with ``pn_batch``) that ``load`` doesn't hold yet; returns these.

        A load names a delivery: the same batch of another load is kept beside. A batch that is complete must
        come again with the same rows; other rows under its name raise and change nothing.
        """
        df = conform(df).withColumn("pn_batch", F.coalesce(F.col("pn_batch").cast("long"), F.raise_error(F.lit("a row has no pn_batch")).cast("long")))
        known = self.ledger().where(F.col("load") == load).select("pn_batch", F.col("n").alias("_n"), F.col("print").alias("_print"))
        prints = F.sum(F.xxhash64(*sorted(c for c in df.columns if c != "pn_batch")).cast("decimal(38,0)"))
        found = df.groupBy("pn_batch").agg(F.count("*").alias("n"), prints.alias("print")).join(known, "pn_batch", "left")
        # a row per batch; written, so that all that follows decides by the same counts
        entries = self.spark.createDataFrame(found.toArrow(), "pn_batch bigint, n bigint, print decimal(38,0), _n bigint, _print decimal(38,0)")
        other = F.col("_n").isNotNull() & ((F.col("n") != F.col("_n")) | (F.col("print") != F.col("_print")))
        if bad := entries.where(other).limit(5).collect():
            raise ValueError(f"batches of load {load} hold other rows already: {[r['pn_batch'] for r in bad]}")
        folder = F.min("pn_batch").over(Window.partitionBy(folder_of(F.col("pn_batch"))))
        new = entries.where(F.col("_n").isNull()).select(F.lit(load).alias("load"), "pn_batch", "n", "print", folder.alias("folder"))
        if not new.isEmpty():
            rows = df.join(new.select("pn_batch", F.col("folder").alias("_folder")), "pn_batch").withColumn("load", F.lit(load))
            self._write(rows)
            self._enter(new)
        return new

    def _write(self, rows: DataFrame) -> None:
        write_folders(rows, self._rows, "load")

    def _enter(self, new: DataFrame) -> None:
        new.coalesce(1).write.mode("append").parquet(self._ledger)

    def read(self, batches: list[int] | None = None) -> DataFrame:
        """The episodes of all complete batches, or of these, with ``pn_batch`` and ``load``. Folders that aren't
        asked for are not read."""
        if not self.exists(self._rows):
            raise ValueError(f"{self.path} holds no episodes")
        ledger = self.ledger().select("pn_batch", "load", F.col("folder").alias("_folder"))
        rows = read_folders(self.spark, self._rows).withColumn("load", F.col("load").cast("string"))
        if batches is not None:
            asked = self.spark.createDataFrame([(b,) for b in batches], "pn_batch bigint")  # a row per batch
            ledger = ledger.join(F.broadcast(asked), "pn_batch", "left_semi")
            folders = [r["_folder"] for r in ledger.select("_folder").distinct().collect()]
            rows = rows.where(F.col("_folder").isin(folders))
        return rows.join(F.broadcast(ledger), ["pn_batch", "load", "_folder"], "left_semi").drop("_folder")
