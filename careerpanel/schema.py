"""The episode table: its columns and the checks made when it is loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPISODES = T.StructType(
    [
        T.StructField("persnr", T.LongType(), False),
        T.StructField("spell", T.LongType(), False),
        T.StructField("begorig", T.DateType()),
        T.StructField("begepi", T.DateType()),
        T.StructField("endepi", T.DateType()),
        T.StructField("quelle_gr", T.IntegerType()),
        T.StructField("erwstat_gr", T.IntegerType()),
        T.StructField("bnn", T.IntegerType()),
        T.StructField("grund_gr", T.IntegerType()),
        T.StructField("tentgelt_gr", T.DoubleType()),
        T.StructField("beruf_gr", T.IntegerType()),
        T.StructField("ausbildung", T.IntegerType()),
        T.StructField("ao_region", T.IntegerType()),
        T.StructField("gebjahr", T.IntegerType()),
        T.StructField("frau", T.IntegerType()),
        T.StructField("teilzeit", T.IntegerType()),
    ]
)
KEY = ["persnr", "spell"]

# columns of the finished panel, in order
PANEL = [
    "persnr", "nspell", "year", "age", "frau", "gebjahr",
    "begorig", "begepi", "endepi", "begepi_orig", "endepi_orig",
    "quelle_gr", "erwstat_gr", "azubi", "grund_gr", "bnn", "teilzeit",
    "beruf_gr", "occ_kldb92_2", "occ_blo", "ausbildung", "educ",
    "ao_region", "ao_bula", "east",
    "ein_erw", "tage_erw", "ein_bet", "tage_bet", "ein_job", "tage_job", "anz_lst", "tage_lst",
    "tentgelt_gr", "limit_assess", "limit_marginal", "marginal", "cpi",
    "wage_defl", "limit_assess_defl", "limit_marginal_defl",
    "cens", "wage", "ln_wage", "ln_wage_imp", "wage_imp",
    "parallel_jobs", "parallel_wage", "parallel_wage_imp", "parallel_benefits",
    "year_days_emp", "year_days_benefits", "year_labor_earn",
]


def conform(df: DataFrame) -> DataFrame:
    """The declared columns with the declared types; raises if one is missing.

    A column of another type is cast; further columns, such as ``pn_batch``, are kept. A number that
    is none (NaN) becomes null, so that no order puts it first.
    """
    missing = [f.name for f in EPISODES if f.name not in df.columns]
    if missing:
        raise ValueError(f"episode table lacks {', '.join(missing)}")
    cast = {f.name: F.col(f.name).cast(f.dataType) for f in EPISODES}
    cast |= {f.name: F.when(~F.isnan(cast[f.name]), cast[f.name]) for f in EPISODES if f.dataType.typeName() == "double"}
    known = [c.alias(name) for name, c in cast.items()]
    return df.select(*known, *[c for c in df.columns if c not in EPISODES.fieldNames()])


def duplicate_keys(df: DataFrame) -> DataFrame:
    """(``persnr``, ``spell``) pairs that occur more than once or are not complete."""
    return (
        df.groupBy(*KEY)
        .agg(F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) | F.col("persnr").isNull() | F.col("spell").isNull())
    )


def check_key(df: DataFrame) -> DataFrame:
    """Raises unless (``persnr``, ``spell``) is a key, else hands the frame on."""
    bad = duplicate_keys(df).limit(5).collect()
    if bad:
        raise ValueError(f"(persnr, spell) is not a key, for example {bad}")
    return df


def raise_on_copies(placed: DataFrame) -> DataFrame:
    """The rows, of which a second one with the same ``persnr`` and ``spell`` ends the job that reads it.

    On rows placed by ``persnr`` this is a sort within partitions and no exchange.
    """
    before = F.lag("spell").over(Window.partitionBy("persnr").orderBy("spell"))
    copy = F.raise_error(F.lit("(persnr, spell) is not a key")).cast("long")
    return placed.withColumn("_before", before).withColumn(
        "spell", F.when(F.col("_before") == F.col("spell"), copy).otherwise(F.col("spell"))
    ).drop("_before")
