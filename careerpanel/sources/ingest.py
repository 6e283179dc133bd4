"""Loading, batching and writing episode tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from careerpanel.functions.frames import BEFORE, SO_FAR
from careerpanel.schema import EPISODES, check_key, conform
from careerpanel.sources.staging import stage

BATCH_SIZE = 3_000_000


def read_episodes(spark: SparkSession, path: str, format: str = "parquet", check: bool = False, **options):
    """The episode table from Parquet, or from CSV with a header, with the declared schema.

    The whole job ends if (``persnr``, ``spell``) is no key, and looks behind its own exchange for that. ``check`` looks at
    once, which takes an exchange of the key columns: for tables that go elsewhere.
    """
    reader = spark.read.options(**options)
    if format == "csv":
        reader = reader.options(header=True, enforceSchema=False).schema(EPISODES)
    df = conform(reader.format(format).load(path))
    return check_key(df) if check else df


def _ranged(df: DataFrame, placed: int | None) -> tuple[DataFrame, DataFrame]:
    """The rows in order of (``persnr``, ``spell``), dealt by range and written, with ``_part`` and ``_at``, the
    place in the part from 0; and per part its number of rows. The input is read for the sampled bounds and once more.

    A range ends anywhere between two rows, so a heavy person takes as many parts as its rows fill.
    """
    person = F.coalesce("persnr", F.raise_error(F.lit("a row has no persnr")).cast("long"))
    keys = [F.col("persnr"), F.col("spell")]
    df = df.drop("pn_batch").withColumn("persnr", person)
    ranged = df.repartitionByRange(*([placed] if placed else []), *keys).sortWithinPartitions(*keys)
    number = F.monotonically_increasing_id()
    places = {"_part": F.shiftright(number, 33).cast("int"), "_at": number.bitwiseAND((1 << 33) - 1)}
    rows = stage(ranged.withColumns(places), "ranged")
    return rows, rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))


def _ends(rows: DataFrame, parts: DataFrame, size: int) -> DataFrame:
    """One row: ``offsets``, for each part the number of rows before it, and ``ends``, for each batch end k = 1, 2, ...
    the person it falls on and ``top``, the last end on that person.

    Everything here has a row per part or per batch.
    """
    before = F.sum("n").over(Window.orderBy("_part").rowsBetween(*BEFORE))
    parts = stage(parts.select("_part", F.coalesce(before, F.lit(0)).alias("offset")), "parts")
    number = F.col("offset") + F.col("_at") + 1
    ends = rows.select("_part", "_at", "persnr").join(F.broadcast(parts), "_part").where(number % size == 0)
    ends = stage(ends.select("persnr", (number / size).cast("long").alias("k")), "batch-ends")
    # a person on whom several batches end belongs to the last of them
    ends = ends.join(ends.groupBy("persnr").agg(F.max("k").alias("top")), "persnr")
    ends = ends.agg(F.sort_array(F.collect_list(F.struct("k", "persnr", "top"))).alias("ends"))
    # every part gets its place, those without rows too
    all_parts = parts.agg(F.coalesce(F.max("_part"), F.lit(0)).alias("top")).select(F.explode(F.sequence(F.lit(0), "top")).alias("_part"))
    offsets = all_parts.join(parts, "_part", "left").agg(F.sort_array(F.collect_list(F.struct("_part", "offset"))).alias("parts"))
    return offsets.select(F.transform("parts", lambda p: p["offset"]).alias("offsets")).crossJoin(ends)  # a row each


def assign_batches(df: DataFrame, size: int = BATCH_SIZE, parts: int | None = None) -> DataFrame:
    """The table with its batch number ``pn_batch``: 1 + floor(running row number of the person's last row / size).

    A batch has about ``size`` rows and never splits a person. Rows are dealt by range of ``persnr``; each part's
    number of rows is carried to the parts behind it as an offset. Batch k ends at the person in whose rows
    the running number passes k * size. If the next end falls on a row's own person, the person's last end counts,
    else the row's own number. So a row takes one look-up, however many batches there are, without counts by
    person and without a join. A row without a person belongs to
    no batch: it raises. ``parts`` is the number of ranges, the session's by default.
    """
    rows, counted = _ranged(df, parts)
    known = stage(_ends(rows, counted, size).select(F.struct("offsets", "ends").alias("known")), "ends").scalar()
    number = F.get(known["offsets"], F.col("_part")) + F.col("_at") + 1
    rows = rows.withColumn("_k", F.floor(number / size).cast("long"))
    ahead = F.get(known["ends"], F.col("_k").cast("int"))  # end k is at place k - 1
    batch = F.when(ahead["persnr"] == F.col("persnr"), ahead["top"]).otherwise(F.col("_k")) + 1
    return rows.withColumn("pn_batch", batch).drop("_part", "_at", "_k")


def batch_plan(df: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """First and last row number of each batch."""
    counts = assign_batches(df.select("persnr", "spell"), size).groupBy("pn_batch").agg(F.count(F.lit(1)).alias("n"))
    last = F.sum("n").over(Window.orderBy("pn_batch").rowsBetween(*SO_FAR))  # over one row per batch
    return counts.withColumn("max_row", last).select("pn_batch", (F.col("max_row") - F.col("n") + 1).alias("min_row"), "max_row")


def append_batches(df: DataFrame, path: str, mode: str = "append") -> None:
    """S3: append rows to the store, one folder per batch.

    Rows are gathered by batch first, so a batch is a file or a few: Spark gives small batches a task
    together and cuts a large one, such as that of a heavy person, at the advisory partition size.
    """
    df.hint("rebalance", F.col("pn_batch")).write.partitionBy("pn_batch").mode(mode).parquet(path)


def write_panel(df: DataFrame, path: str, mode: str = "error") -> None:
    """The finished table, sorted by person within files, so that later reads skip row groups."""
    df.sortWithinPartitions("persnr", "year").write.mode(mode).parquet(path)
