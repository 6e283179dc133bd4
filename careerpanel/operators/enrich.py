"""Occupation, education, region, wage limits and deflation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careerpanel.sources.lookups import place_of

EDUCATION = {3: (5, 6, 11, 12), 2: (2, 4), 1: (1, 3)}
EAST_STATES = (11, 12, 13, 14, 15, 16)


def add_unique_crosswalk(
    df: DataFrame, crosswalk: DataFrame, target: str, n_col: str, out: str, key: str = "beruf_gr"
) -> DataFrame:
    """The target code of keys that have exactly one, null for all others."""
    unique = crosswalk.where(F.col(n_col) == 1).select(key, F.col(target).alias(out))
    return df.join(unique, key, "left")


def add_occupation(df: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Two-digit occupation ``occ_kldb92_2``."""
    return add_unique_crosswalk(df, crosswalk, "kldb92_2", "n_kldb92_2", "occ_kldb92_2")


def add_blossfeld(df: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Blossfeld occupation ``occ_blo``."""
    return add_unique_crosswalk(df, crosswalk, "occ_blo", "n_occ_blo", "occ_blo")


def crosswalk_ambiguity(
    crosswalk: DataFrame, target: str, n_col: str, key: str = "beruf_gr"
) -> DataFrame:
    """Keys with several targets and the list of these, as "a,b and c"."""
    return (
        place_of(crosswalk)
        .where(F.col(n_col) != 1)
        .groupBy(key)
        .agg(
            F.expr(f"listagg(CAST({target} AS STRING), ',') WITHIN GROUP (ORDER BY place)").alias(
                "matched"
            )
        )
        .withColumn("matched", F.regexp_replace("matched", ",([^,]*)$", " and $1"))
    )


def crosswalk_loss(
    df: DataFrame, crosswalk: DataFrame, target: str, n_col: str, key: str = "beruf_gr"
) -> DataFrame:
    """J3 on data: the ambiguous keys that occur and how many episodes get no code from them."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_episodes"))
    return counts.join(crosswalk_ambiguity(crosswalk, target, n_col, key), key)


def add_crosswalk(df: DataFrame, crosswalk: DataFrame, key: str = "beruf_gr") -> DataFrame:
    """All targets of a key, one row per target (two- or three-digit crosswalks)."""
    return df.join(crosswalk, key, "left")


def add_education(df: DataFrame) -> DataFrame:
    """``educ``, 3 university, 2 vocational training, 1 neither, null unknown."""
    educ = None
    for group, codes in EDUCATION.items():
        cond = F.col("ausbildung").isin(list(codes))
        educ = F.when(cond, group) if educ is None else educ.when(cond, group)
    return df.withColumn("educ", educ)


def education_report(df: DataFrame) -> DataFrame:
    """Number of rows per ``educ`` and ``ausbildung``."""
    return (
        df.groupBy("educ", "ausbildung")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.asc_nulls_last("ausbildung"))
    )


def add_region(df: DataFrame) -> DataFrame:
    """State ``ao_bula`` of the workplace and ``east``."""
    state = F.floor(F.col("ao_region") / 1000).cast("int")
    return df.withColumn("ao_bula", state).withColumn(
        "east",
        F.when(F.col("ao_bula").isin(list(EAST_STATES)), 1).when(F.col("ao_bula") < 11, 0),
    )


def add_ceiling(df: DataFrame, ceiling: DataFrame) -> DataFrame:
    """Contribution assessment ceiling ``limit_assess`` of the year and region."""
    return df.join(ceiling, ["east", "year"], "left")


def add_marginal(df: DataFrame, marginal: DataFrame) -> DataFrame:
    """Threshold ``limit_marginal`` and ``marginal``, 1 for wages up to it."""
    low = F.col("tentgelt_gr") <= F.col("limit_marginal")
    return df.join(marginal, ["east", "year"], "left").withColumn(
        "marginal", F.when(low, 1).when(~low, 0)
    )


DEFLATED = {
    "tentgelt_gr": "wage_defl",
    "limit_marginal": "limit_marginal_defl",
    "limit_assess": "limit_assess_defl",
}


def deflate(df: DataFrame, cpi: DataFrame, cols: Iterable[str] = tuple(DEFLATED)) -> DataFrame:
    """Price index ``cpi`` of the year and amounts in prices of its base year."""
    return df.join(cpi, "year", "left").withColumns(
        {DEFLATED.get(c, f"{c}_defl"): 100 * F.col(c) / F.col("cpi") for c in cols}
    )
