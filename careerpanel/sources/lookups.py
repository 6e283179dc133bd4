"""Lookup tables (S4): the built-in ones and those of a user's CSV files.

No join below forces a broadcast: the built-in tables are inline relations and CSV files carry
their size, so Spark broadcasts them under ``spark.sql.autoBroadcastJoinThreshold`` and falls
back to a sort-merge join beyond it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careerpanel.sources import fixed_values

CPI_SCHEMA = "year int, cpi double"
CEILING_SCHEMA = "year int, east int, limit_assess double"
MARGINAL_SCHEMA = "year int, east int, limit_marginal double"


def _lines(text: str) -> list[list[str]]:
    return [line.replace(":", "").split() for line in text.split("\n") if line.strip()]


def cpi_rows() -> list[tuple]:
    return [(int(y), float(v)) for y, v in _lines(fixed_values.CPI)]


def limit_rows(text: str) -> list[tuple]:
    return [
        (int(y), east, float(v))
        for y, *limits in _lines(text)
        for east, v in enumerate(limits)
    ]


def crosswalk_rows(text: str) -> list[tuple]:
    """(key, target, number of targets of the key, place in the listed order)."""
    return [
        (int(key), int(target), len(targets), place)
        for key, *targets in _lines(text)
        for place, target in enumerate(targets, 1)
    ]


def values_sql(rows: list[tuple], names: list[str]) -> str:
    """The rows as an inline table that both Spark and other SQL engines read.

    Doubles are written with an exponent, so that they are not taken as decimals.
    """
    cells = [
        "(" + ", ".join(f"{v!r}e0" if isinstance(v, float) else str(v) for v in row) + ")"
        for row in rows
    ]
    return f"SELECT * FROM (VALUES {', '.join(cells)}) AS t({', '.join(names)})"


@dataclass(frozen=True)
class Lookups:
    cpi: DataFrame
    ceiling: DataFrame
    marginal: DataFrame
    occupation: DataFrame
    blossfeld: DataFrame


LOOKUP_ROWS = {
    "cpi": (cpi_rows(), ["year", "cpi"]),
    "ceiling": (
        limit_rows(fixed_values.ASSESSMENT_CEILING),
        ["year", "east", "limit_assess"],
    ),
    "marginal": (
        limit_rows(fixed_values.MARGINAL_THRESHOLD),
        ["year", "east", "limit_marginal"],
    ),
    "occupation": (
        crosswalk_rows(fixed_values.KLDB92_2),
        ["beruf_gr", "kldb92_2", "n_kldb92_2", "place"],
    ),
    "blossfeld": (
        crosswalk_rows(fixed_values.BLOSSFELD),
        ["beruf_gr", "occ_blo", "n_occ_blo", "place"],
    ),
}


def default_lookups(spark: SparkSession) -> Lookups:
    """The built-in tables."""
    return Lookups(**{k: spark.sql(values_sql(*v)) for k, v in LOOKUP_ROWS.items()})


def read_lookup(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A lookup CSV with a header, read with a fixed schema."""
    return spark.read.schema(schema).csv(path, header=True)


def read_crosswalk(spark: SparkSession, path: str, target: str, n_col: str) -> DataFrame:
    """An occupation crosswalk CSV: key ``beruf_gr``, target code, number of targets of the key."""
    return read_lookup(spark, path, f"beruf_gr int, {target} int, {n_col} int")


def read_lookups(
    spark: SparkSession, cpi: str, ceiling: str, marginal: str, occupation: str, blossfeld: str
) -> Lookups:
    """All five tables from CSV files."""
    return Lookups(
        read_lookup(spark, cpi, CPI_SCHEMA),
        read_lookup(spark, ceiling, CEILING_SCHEMA),
        read_lookup(spark, marginal, MARGINAL_SCHEMA),
        read_crosswalk(spark, occupation, "kldb92_2", "n_kldb92_2"),
        read_crosswalk(spark, blossfeld, "occ_blo", "n_occ_blo"),
    )


def place_of(crosswalk: DataFrame) -> DataFrame:
    """The crosswalk with a ``place`` column; a CSV without one takes the file order."""
    if "place" in crosswalk.columns:
        return crosswalk
    return crosswalk.withColumn("place", F.monotonically_increasing_id())
