"""A reproducible shuffle into shards by a Feistel permutation of row numbers. DataFrame operations only."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careerpanel.sources.staging import stage

ROUNDS = 6


def row_numbers(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` with ``row``: its place, from 0, in the order of ``order`` (which should be total).

    Rows are placed by range and sorted there; a place is the row's place in its partition plus the sizes
    of the partitions before. Only sizes of partitions meet in one task.
    """
    keys = [c.alias(f"_k{i}") for i, c in enumerate(order)]
    names = [f"_k{i}" for i in range(len(keys))]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = df.select("*", *keys).repartitionByRange(n, *names).sortWithinPartitions(*names).drop(*names)
    placed = stage(sorted_rows.withColumn("_at", F.monotonically_increasing_id()), "rows")
    part, at = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("n"))
    starts, start = [], 0
    for p, size in sorted(sizes.collect()):  # one number for each partition
        starts.append((p, start))
        start += size
    table = df.sparkSession.createDataFrame(starts, "_part bigint, _start bigint")
    rows = placed.withColumns({"_part": part, "_at": at}).join(table, "_part")
    return rows.withColumn("row", F.col("_start") + F.col("_at")).drop("_at", "_part", "_start")


def feistel(x: Column, a: int, b: int, seed: int) -> Column:
    """A permutation of 0 .. a*b - 1: halves x div b and x mod b take turns in being shifted by a hash of the other."""
    left, right = F.floor(x / b).cast("bigint"), x % b
    for i in range(ROUNDS):
        if i % 2 == 0:
            left = (left + F.pmod(F.xxhash64(F.lit(seed * ROUNDS + i).cast("bigint"), right), F.lit(a))) % a
        else:
            right = (right + F.pmod(F.xxhash64(F.lit(seed * ROUNDS + i).cast("bigint"), left), F.lit(b))) % b
    return left * b + right


def permuted(df: DataFrame, n: int, row: str = "row", seed: int = 0) -> DataFrame:
    """``df`` with ``place``: a permutation of the row numbers 0 .. n - 1.

    The Feistel network permutes a domain just above n; a row that lands outside walks on along its cycle
    until it is inside. Rows that still walk are few and fewer in each pass, and passes go on until none is left.
    """
    a = max(1, isqrt(max(n, 1) - 1) + 1)
    b = max(1, -(-n // a))
    out = df.withColumn("place", feistel(F.col(row).cast("bigint"), a, b, seed))
    step = F.when(F.col("place") >= n, feistel(F.col("place"), a, b, seed)).otherwise(F.col("place"))
    out = stage(out, "places")
    while not out.where(F.col("place") >= n).isEmpty():
        out = stage(out.withColumn("place", step).withColumn("place", step).withColumn("place", step), "places")
    return out


def shard(df: DataFrame, order: list[Column], shards: int, seed: int = 0) -> DataFrame:
    """``df`` with ``shard`` and ``slot``: shards' counts are at most one apart, slots have no gaps.

    Both follow from the row's number in ``order``, the number of rows and ``seed``: whoever has a row's
    number can compute its shard and slot, and place = slot * shards + shard. An empty table stays empty.
    """
    numbered = row_numbers(df, order)
    out = permuted(numbered, numbered.count(), seed=seed)
    return out.withColumns({"shard": (F.col("place") % shards).cast("int"), "slot": F.floor(F.col("place") / shards).cast("bigint")})


def document_shards(docs: DataFrame, shards: int, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row, by the law of rows.

    ``size`` is the text's bytes in UTF-8 plus 16; a null text has none, and its crc32 is that of no bytes, 0.
    Rows are numbered by id (nulls first) and then by text hashes; rows alike in all of these are told
    apart by where they were read, which leaves the result, as a set of rows, the same. Equal texts are not
    kept together. Further columns are not read.
    """
    text = F.encode(F.col(text_col), "UTF-8")
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 16).cast("bigint").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("bigint").alias("text_crc32"),
        F.xxhash64(text_col).alias("_hash"),
        F.monotonically_increasing_id().alias("_read"),
    )
    order = [F.col(c) for c in ("id", "size", "text_crc32", "_hash", "_read")]
    out = shard(rows, order, shards, seed)
    return out.select(F.col("id").alias(id_col), "size", "text_crc32", "shard", "slot")
