"""Censoring flags, reports, wage variables and the upper bound of wages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from careerpanel.functions.quantile import exact_quantile

MARGIN = 4
AGE_EDGES = (18, 25, 30, 35, 40, 45, 50, 55, 60)
CELL = ["year", "educ_tmp", "east"]
HELPERS = [
    "old",
    "age_sq",
    "age_old",
    "age_sq_old",
    "tenure_sq",
    "limit_assess4",
    "ln_limit_assess4",
    "ln_wage_cens",
]


def flag_censored(df: DataFrame, margin: float = MARGIN) -> DataFrame:
    """Ceiling less ``margin`` EUR in base prices, its log, and ``cens`` for employment."""
    employed = F.col("quelle_gr") == 1
    return df.withColumn(
        "limit_assess4", F.col("limit_assess_defl") - 100 * F.lit(margin) / F.col("cpi")
    ).withColumns(
        {
            "ln_limit_assess4": F.log("limit_assess4"),
            "cens": F.when(employed & (F.col("wage_defl") <= F.col("limit_assess4")), 0).when(
                employed & (F.col("wage_defl") > F.col("limit_assess4")), 1
            ),
        }
    )


def _flagged(df: DataFrame) -> DataFrame:
    return df.where((F.col("quelle_gr") == 1) & F.col("cens").isNotNull())


def censoring_report(df: DataFrame) -> DataFrame:
    """Number and share of wages below (0) and above (1) the limit."""
    counts = _flagged(df).groupBy("cens").agg(F.count(F.lit(1)).alias("n"))
    # two counts at most, so one window over all of them is small
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def censoring_by_education(df: DataFrame) -> DataFrame:
    """Counts by ``cens`` side by side and the censored share per education; no row of a kind counts 0."""
    label = F.create_map(*[F.lit(x) for kv in ((1, "Low"), (2, "Medium"), (3, "High")) for x in kv])
    free, censored = (F.coalesce(F.col(c), F.lit(0)) for c in ("0", "1"))
    return (
        _flagged(df)
        .groupBy("educ")
        .pivot("cens", [0, 1])
        .agg(F.count(F.lit(1)))
        .select(
            F.coalesce(label[F.col("educ")], F.lit("Missing")).alias("education"),
            free.alias("cens0"),
            censored.alias("cens1"),
            (censored / (free + censored)).alias("share_censored"),
        )
    )


def censoring_by_age(df: DataFrame, edges: tuple[int, ...] = AGE_EDGES) -> DataFrame:
    """C4: censored share of the highly educated per age band; the last band includes its end."""
    age, band = F.col("age"), None
    for low, high in zip(edges, edges[1:]):
        inside = (age >= low) & ((age <= high) if high == edges[-1] else (age < high))
        name = f"{low} to {high}"
        band = F.when(inside, name) if band is None else band.when(inside, name)
    return (
        _flagged(df)
        .where((F.col("educ") == 3) & age.between(edges[0], edges[-1]))
        .groupBy(band.alias("age_category"))
        .agg(F.avg("cens").alias("share_censored"))
        .orderBy("age_category")
    )


def censoring_by_hours(df: DataFrame) -> DataFrame:
    """Censored share of full-time and part-time work."""
    label = F.when(F.col("teilzeit") == 0, "Fulltime").when(F.col("teilzeit") == 1, "Parttime")
    return (
        _flagged(df)
        .groupBy(F.when(F.col("teilzeit").isNull(), "Missing FT-Info").otherwise(label).alias("hours"))
        .agg(F.avg("cens").alias("share_censored"))
    )


def censoring_by_gender(df: DataFrame) -> DataFrame:
    """Censored share of men and women."""
    label = F.when(F.col("frau") == 0, "Men").when(F.col("frau") == 1, "Women")
    return (
        _flagged(df).groupBy(label.alias("gender")).agg(F.avg("cens").alias("share_censored"))
    )


REPORTS = {
    "cens": censoring_report,
    "educ": censoring_by_education,
    "age": censoring_by_age,
    "teilzeit": censoring_by_hours,
    "frau": censoring_by_gender,
}


def topcode_wage(df: DataFrame) -> DataFrame:
    """``wage`` cut at the limit, ``ln_wage`` (null at 0), ``ln_wage_cens`` of uncensored rows."""
    employed = F.col("quelle_gr") == 1
    over = F.col("wage_defl") > F.col("limit_assess4")
    return (
        df.withColumn(
            "wage",
            F.when(employed & ~over, F.col("wage_defl")).when(
                employed & over, F.col("limit_assess4")
            ),
        )
        .withColumn("ln_wage", F.when(F.col("wage") != 0, F.log("wage")))
        .withColumn("ln_wage_cens", F.when(F.col("cens") == 0, F.col("ln_wage")))
    )


def add_controls(df: DataFrame) -> DataFrame:
    """Regressors of the imputation; unknown education counts as low."""
    return df.withColumns(
        {
            "age_sq": (F.col("age") / 10) * (F.col("age") / 10),
            "old": (F.col("age") > 40).cast("int"),
            "tenure_sq": (F.col("tage_job") / 10) * (F.col("tage_job") / 10),
            "educ_tmp": F.coalesce("educ", F.lit(1)),
        }
    ).withColumns(
        {
            "age_old": F.col("age") * F.col("old"),
            "age_sq_old": F.col("age_sq") * F.col("old"),
        }
    )


def imputation_plan(df: DataFrame) -> DataFrame:
    """The cells in which wages are imputed."""
    return (
        df.select(*CELL)
        .where(F.col("east").isNotNull())
        .distinct()
        .orderBy("year", "east", "educ_tmp")
    )


def wage_bound(
    df: DataFrame, q: float = 0.99, factor: float = 10.0, compat: bool = False
) -> float | None:
    """C14: ``factor`` times the exact ``q`` quantile of imputed wages (of their log if ``compat``); None without any."""
    value = exact_quantile(df.select((F.col("ln_wage_imp") if compat else F.exp("ln_wage_imp")).alias("x")), "x", q)
    return None if value is None else factor * value


def bound_wage(df: DataFrame, bound: float | None, compat: bool = False) -> DataFrame:
    """C14: ``wage_imp`` in levels, no larger than ``bound``; with ``compat`` the log wage is bounded instead and
    ``wage_imp`` stays as it is."""
    df = df.withColumn("wage_imp", F.exp("ln_wage_imp"))
    if bound is None:
        return df
    over = F.col("ln_wage_imp" if compat else "wage_imp") > bound
    if compat:
        return df.withColumn("ln_wage_imp", F.when(over, bound).otherwise(F.col("ln_wage_imp")))
    return df.withColumns(
        {
            "ln_wage_imp": F.when(over, F.log(F.lit(bound))).otherwise(F.col("ln_wage_imp")),
            "wage_imp": F.when(over, bound).otherwise(F.col("wage_imp")),
        }
    )


def cap_wage(
    df: DataFrame, q: float = 0.99, factor: float = 10.0, compat: bool = False
) -> DataFrame:
    """C14: ``wage_imp`` in levels, bounded at ``factor`` times its ``q`` quantile.

    ``compat`` bounds the log wage by ``factor`` times the quantile of the log wage and leaves
    ``wage_imp`` as it is. The quantile is exact; it is found when this is called.
    """
    return bound_wage(df, wage_bound(df, q, factor, compat), compat)


def drop_helpers(df: DataFrame) -> DataFrame:
    """Without the columns that only the imputation needs."""
    return df.drop(*HELPERS, "educ_tmp")
