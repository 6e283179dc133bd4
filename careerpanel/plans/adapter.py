"""Episodes made from the ``orders`` table, to run the operators on available data.

A customer is a person, an order an episode that starts in the month of the order. Every column
is arithmetic on the order, so that a SQL query can state the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from careerpanel.functions.carry import carry
from careerpanel.functions.frames import BEFORE
from careerpanel.functions.people import BLOCK, ROW_LIMIT, People, heavy_persons, split_heavy
from careerpanel.schema import EPISODES


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey",
        F.col("o_custkey").alias("persnr"),
        "o_orderstatus",
        "o_totalprice",
        F.trunc(F.to_date("o_orderdate"), "month").alias("b"),
    )


def _numbered(orders: DataFrame) -> DataFrame:
    """``spell`` by month and order key, and the next later month ``nb`` of the same person."""
    w = Window.partitionBy("persnr").orderBy("b", "o_orderkey")
    month = Window.partitionBy("persnr", "b")
    return (
        orders.withColumn("spell", F.row_number().over(w).cast("long"))
        .withColumn("_next", F.lead("b").over(w))
        .withColumn("nb", F.max("_next").over(month))
        .withColumn("nb", F.when(F.col("nb") > F.col("b"), F.col("nb")))
        .drop("_next")
    )


def _numbered_spread(orders: DataFrame, block: int) -> DataFrame:
    slices = ["b", "_block"]

    def scan(pieces, w):
        months = pieces.select("persnr", "b").distinct()
        person = Window.partitionBy("persnr").orderBy("b")
        months = months.withColumn("nb", F.lead("b").over(person))
        return pieces.select(
            "persnr", *slices, F.sum("n").over(w.rowsBetween(*BEFORE)).alias("_before")
        ).join(months, ["persnr", "b"])

    inside = Window.partitionBy("persnr", *slices).orderBy("o_orderkey")
    rows = orders.withColumn("_block", F.floor(F.col("o_orderkey") / block))
    return (
        carry(rows, ["persnr"], slices, {"n": F.count(F.lit(1))}, scan)
        .withColumn("spell", F.coalesce("_before", F.lit(0)) + F.row_number().over(inside))
        .drop("_before", "_block")
    )


def _episode_columns(df: DataFrame) -> DataFrame:
    key, person, b = F.col("o_orderkey"), F.col("persnr"), F.col("b")
    k = (person * 31 + F.year(b) * 12 + F.month(b)) % 20
    benefit = F.col("o_orderstatus") == "P"

    def unless(missing, value):
        return F.when(~missing, value)

    m = key % 13
    columns = {
        "persnr": person,
        "spell": F.col("spell"),
        "begorig": b,
        "begepi": b,
        "endepi": F.least(
            F.date_add(b, (29 + 2 * k * k).cast("int")), F.date_sub(F.col("nb"), 1)
        ),
        "quelle_gr": F.when(~benefit, 1).when(key % 2 == 0, 2).otherwise(16),
        "erwstat_gr": unless(benefit, F.when(key % 8 == 0, 2).otherwise(1)),
        "bnn": unless(benefit | (key % 29 == 0), 1 + key % 3),
        "grund_gr": unless(benefit, key % 6),
        "tentgelt_gr": unless(benefit | (key % 31 == 0), F.col("o_totalprice") / 3000),
        "beruf_gr": unless(key % 17 == 0, 1 + key % 125),
        "ausbildung": unless(m.isin(7, 8), m),
        "ao_region": unless(key % 23 == 0, (1 + key % 17) * 1000 + 1),
        "gebjahr": 1945 + person % 35,
        "frau": person % 2,
        "teilzeit": unless(key % 11 == 0, (key % 3 == 0).cast("int")),
    }
    return df.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in EPISODES])


def episode_people(
    spark: SparkSession, sf_dir: str, row_limit: int = ROW_LIMIT, block: int = BLOCK
) -> People:
    """The episodes, ordinary persons already placed by ``persnr``."""
    orders = _orders(spark, sf_dir)
    heavy_ids = heavy_persons(orders, row_limit)
    if heavy_ids is None:
        return People(_episode_columns(_numbered(orders)), None, block)
    others, heavy = split_heavy(orders, heavy_ids)
    return People(
        _episode_columns(_numbered(others)),
        _episode_columns(_numbered_spread(heavy, block)),
        block,
        heavy_ids,
    )


def episodes(spark: SparkSession, sf_dir: str, **limits) -> DataFrame:
    """The episodes as one frame."""
    return episode_people(spark, sf_dir, **limits).merged()
