"""Year, age, the calendar-year split and the observation counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from careerpanel.functions.carry import carry
from careerpanel.functions.frames import BEFORE, ordered
from careerpanel.functions.metrics import Metrics
from careerpanel.functions.people import PersonStep, with_block


def add_year_age(df: DataFrame) -> DataFrame:
    """Calendar year of the start and age in that year."""
    return df.withColumns(
        {"year": F.year("begepi"), "age": F.year("begepi") - F.col("gebjahr")}
    )


def add_span(df: DataFrame) -> DataFrame:
    """The original bounds and the number of calendar years touched."""
    return df.withColumns(
        {
            "begepi_orig": F.col("begepi"),
            "endepi_orig": F.col("endepi"),
            "span_year": F.year("endepi") - F.year("begepi") + 1,
        }
    )


def span_report(df: DataFrame) -> DataFrame:
    """How many episodes span how many years, most frequent first."""
    return (
        df.groupBy((F.year("endepi") - F.year("begepi") + 1).alias("span_year"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc_nulls_last("span_year"))
    )


def years_touched() -> Column:
    """The number of rows that an episode is split into."""
    return F.greatest(F.coalesce(F.year("endepi") - F.year("begepi") + 1, F.lit(0)), F.lit(0))


def watch_episodes(df: DataFrame, metrics: Metrics) -> DataFrame:
    """E4 on the way: ``metrics`` counts the episodes and those that the split is going to drop."""
    return metrics.watch(df, episodes=F.count(F.lit(1)), dropped=F.count_if(years_touched() == 0))


def split_episodes(df: DataFrame, observation: Observation | None = None) -> DataFrame:
    """One row per calendar year that an episode touches, bounds cut to that year.

    Episodes without bounds or with reversed years vanish; an ``Observation`` counts them
    as ``dropped``.
    """
    first, last = F.year("begepi"), F.year("endepi")
    if observation is not None:
        lost = F.coalesce(last < first, F.lit(True))
        df = df.observe(observation, F.count_if(lost).alias("dropped"))
    return (
        df.where(last >= first)
        .withColumns({"begepi_orig": F.col("begepi"), "endepi_orig": F.col("endepi")})
        .drop("year", "age")
        .withColumn("year", F.explode(F.sequence(first, last)))
        .withColumns(
            {
                "begepi": F.greatest("begepi", F.make_date("year", F.lit(1), F.lit(1))),
                "endepi": F.least("endepi", F.make_date("year", F.lit(12), F.lit(31))),
                "age": F.col("year") - F.col("gebjahr"),
            }
        )
    )


def _with_source(df: DataFrame) -> DataFrame:
    """``_source`` to group and order by; an unknown source comes last."""
    return df.withColumn("_source", F.coalesce("quelle_gr", F.lit(2**31 - 1)))


def _add_counters(df: DataFrame) -> DataFrame:
    """E5: ``level1`` counts rows per person, start and source, ``level2`` per person and start."""
    source = ordered(["persnr", "begepi", "_source"], ["spell"])
    start = ordered(["persnr", "begepi"], ["_source", "spell"])
    return _with_source(df).withColumns(
        {
            "level1": (F.row_number().over(source) - 1).cast("long"),
            "level2": (F.row_number().over(start) - 1).cast("long"),
        }
    ).drop("_source")


def _add_counters_spread(df: DataFrame, block: int) -> DataFrame:
    group = ["persnr", "begepi", "_source"]

    def scan(pieces, _):
        same = ordered(group, ["_block"]).rowsBetween(*BEFORE)
        start = ordered(group[:2], ["_source", "_block"]).rowsBetween(*BEFORE)
        return pieces.select(
            *group,
            "_block",
            F.sum("n").over(same).alias("_before1"),
            F.sum("n").over(start).alias("_before2"),
        )

    inside = ordered(group + ["_block"], ["spell"])
    out = carry(
        with_block(_with_source(df), block), group, ["_block"], {"n": F.count(F.lit(1))}, scan
    ).withColumn("_nr", F.row_number().over(inside) - 1)
    return out.withColumns(
        {
            "level1": F.coalesce("_before1", F.lit(0)) + F.col("_nr"),
            "level2": F.coalesce("_before2", F.lit(0)) + F.col("_nr"),
        }
    ).drop("_block", "_source", "_nr", "_before1", "_before2")


add_counters = PersonStep(_add_counters, _add_counters_spread)


def counter_gaps(df: DataFrame) -> DataFrame:
    """Number of rows without a counter (one row)."""
    return df.agg(
        F.count_if(F.col("level1").isNull() | F.col("level2").isNull()).alias("missing")
    )


def watch_counters(df: DataFrame, metrics: Metrics) -> DataFrame:
    """E6 on the way: ``metrics`` counts the rows and those without a counter."""
    missing = F.col("level1").isNull() | F.col("level2").isNull()
    return metrics.watch(df, rows=F.count(F.lit(1)), counters_missing=F.count_if(missing))


def check_counters(df: DataFrame) -> DataFrame:
    """E6 as an assertion: raises if a counter is missing, else hands the frame on."""
    missing = counter_gaps(df).first()["missing"]
    if missing:
        raise ValueError(f"{missing} rows have no observation counter")
    return df
