"""Parallel episodes and the yearly panel."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careerpanel.functions.carry import carry
from careerpanel.functions.frames import ALL, days, left_null_safe, ordered, three_valued
from careerpanel.functions.people import People, PersonStep, with_block

START = ["persnr", "begepi"]
HANDLING = {"wage": ("wage_imp", "tage_bet"), "tenure": ("tage_bet", "wage_imp")}


# --- parallel episodes: P1-P4 ---------------------------------------------------------------


def _parallel_totals(benefit_sources: tuple[int, ...]) -> dict[str, Column]:
    job = F.col("quelle_gr") == 1
    benefit = F.col("quelle_gr").isin(list(benefit_sources))
    return {
        "parallel_jobs": F.count_if(job),
        "parallel_wage": F.sum(F.coalesce(F.when(job, F.col("tentgelt_gr")), F.lit(0.0))),
        "parallel_wage_imp": F.sum(F.coalesce(F.when(job, F.col("wage_imp")), F.lit(0.0))),
        "parallel_benefits": F.max(three_valued(benefit, 1, 0)),
    }


def _add_parallel_totals(df: DataFrame, benefit_sources: tuple[int, ...] = (2,)) -> DataFrame:
    """Number and total wages of all jobs with the same start, and whether benefits run beside."""
    start = ordered(START, [])
    totals = _parallel_totals(benefit_sources)
    return df.withColumns({name: c.over(start) for name, c in totals.items()})


def _add_parallel_totals_spread(
    df: DataFrame, block: int, benefit_sources: tuple[int, ...] = (2,)
) -> DataFrame:
    parts = _parallel_totals(benefit_sources)

    def scan(pieces, w):
        start = w.rowsBetween(*ALL)
        combined = {c: F.max(c) if c == "parallel_benefits" else F.sum(c) for c in parts}
        return pieces.select(
            *START, "_block", *[c.over(start).alias(name) for name, c in combined.items()]
        )

    return carry(with_block(df, block), START, ["_block"], parts, scan).drop("_block")


add_parallel_totals = PersonStep(_add_parallel_totals, _add_parallel_totals_spread)


def check_handling(handling: str) -> tuple[str, str]:
    if handling not in HANDLING:
        raise ValueError("handling must be 'wage' or 'tenure'")
    return HANDLING[handling]


def _main_order(handling: str) -> list[Column]:
    best = [F.desc_nulls_last(c) for c in check_handling(handling)]
    return [F.asc_nulls_last("quelle_gr"), *best, F.col("spell"), F.col("endepi")]


def _main_episode(df: DataFrame, handling: str = "wage") -> DataFrame:
    """One row per person and start: lowest source, then highest wage and longest tenure.

    ``handling="tenure"`` looks at tenure first. Nulls come last; ties go to the lowest ``spell``.
    """
    w = ordered(START, []).orderBy(*_main_order(handling))
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")


def _best_row(df: DataFrame, handling: str, totals: dict[str, Column]) -> DataFrame:
    """The main row and ``totals`` per person and start, as one map-side combined aggregation."""
    order = [F.col("quelle_gr").isNull(), F.col("quelle_gr")]
    for c in check_handling(handling):
        order += [F.col(c).isNull(), -F.col(c)]
    order += [F.col("spell"), F.col("endepi")]
    place = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    others = [c for c in df.columns if c not in START]
    best = df.groupBy(*START).agg(
        F.min_by(F.struct(*others), place).alias("_best"),
        *[c.alias(name) for name, c in totals.items()],
    )
    return best.select(*START, "_best.*", *totals).select(*df.columns, *totals)


def _main_episode_spread(df: DataFrame, block: int, handling: str = "wage") -> DataFrame:
    return _best_row(df, handling, {})


main_episode = PersonStep(_main_episode, _main_episode_spread)


def _add_nspell(df: DataFrame) -> DataFrame:
    """Number of the episode in the person's life, after P2 (one row per start)."""
    return df.withColumn("nspell", F.row_number().over(ordered(["persnr"], ["year", "begepi"])).cast("long"))


# after P2 a person has at most one row per calendar day, so its window is small in any case
add_nspell = PersonStep(_add_nspell, lambda df, block: _add_nspell(df))


def drop_levels(df: DataFrame) -> DataFrame:
    """Without the columns that count parallel rows."""
    return df.drop("spell", "level1", "level2")


def _reduce_parallel(
    df: DataFrame, handling: str = "wage", benefit_sources: tuple[int, ...] = (2,)
) -> DataFrame:
    """P1 and P2 in one window. ``year`` is that of ``begepi``; with it in front, the same sort
    serves P3 and P6."""
    w = ordered(["persnr", "year", "begepi"], []).orderBy(*_main_order(handling))
    totals = _parallel_totals(benefit_sources)
    return (
        df.withColumns(
            {
                **{name: c.over(w.rowsBetween(*ALL)) for name, c in totals.items()},
                "_rank": F.row_number().over(w),
            }
        )
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def _reduce_parallel_spread(
    df: DataFrame, block: int, handling: str = "wage", benefit_sources: tuple[int, ...] = (2,)
) -> DataFrame:
    return _best_row(df, handling, _parallel_totals(benefit_sources))


reduce_parallel = PersonStep(_reduce_parallel, _reduce_parallel_spread)


def handle_parallel_episodes(data, handling: str = "wage"):
    """P1-P4 in order."""
    check_handling(handling)
    people = add_nspell(reduce_parallel(data, handling=handling))
    return people.map(drop_levels) if isinstance(people, People) else drop_levels(people)


# --- yearly panel: P5-P9 --------------------------------------------------------------------


def add_durations(df: DataFrame, benefit_sources: tuple[int, ...] = (2,)) -> DataFrame:
    """P5: days of the row in employment and in benefits."""
    job = F.col("quelle_gr") == 1
    benefit = F.col("quelle_gr").isin(list(benefit_sources)) | (F.col("parallel_benefits") == 1)
    return df.withColumns(
        {
            "dur_emp": three_valued(job, days(), 0),
            "dur_benefits": three_valued(benefit, days(), 0),
        }
    )


def _year_sums() -> dict[str, Column]:
    return {
        "year_days_emp": F.sum("dur_emp"),
        "year_days_benefits": F.sum("dur_benefits"),
        "year_labor_earn": F.sum(F.col("parallel_wage_imp") * F.col("dur_emp")),
    }


def _zero_if_none(df: DataFrame) -> DataFrame:
    return df.na.fill(0, list(_year_sums())).drop("dur_emp", "dur_benefits")


def _add_year_totals(df: DataFrame) -> DataFrame:
    """Days employed, days with benefits and labour earnings of the person's year."""
    year = ordered(["persnr", "year"], [])
    sums = {name: c.over(year) for name, c in _year_sums().items()}
    return _zero_if_none(add_durations(df).withColumns(sums))


def _add_year_totals_spread(df: DataFrame, block: int) -> DataFrame:
    df = add_durations(df)
    sums = df.groupBy("persnr", "year").agg(*[c.alias(n) for n, c in _year_sums().items()])
    return _zero_if_none(left_null_safe(df, sums, ["persnr", "year"]))


add_year_totals = PersonStep(_add_year_totals, _add_year_totals_spread)


def cutoff_date(month: int, day: int) -> Column:
    """The cutoff in the year of the row. The day must exist in every year."""
    datetime.date(2001, month, day)
    return F.make_date("year", F.lit(month), F.lit(day))


def alive_on(df: DataFrame, month: int = 6, day: int = 30) -> DataFrame:
    """Rows whose episode includes the cutoff date of their year."""
    return df.where(cutoff_date(month, day).between(F.col("begepi"), F.col("endepi")))


def cut_durations(
    df: DataFrame, month: int = 6, day: int = 30, benefit_sources: tuple[int, ...] = (2,)
) -> DataFrame:
    """Running days moved back from the end of the episode to the cutoff date.

    Firm and job days stay on employment, ``tage_erw`` on employment without training,
    ``tage_lst`` (if there) on benefits; elsewhere they are null.
    """
    job = F.col("quelle_gr") == 1
    benefit = F.col("quelle_gr").isin(list(benefit_sources)) | (F.col("parallel_benefits") == 1)
    kept = {
        "tage_bet": job,
        "tage_job": job,
        "tage_erw": job & (F.col("erwstat_gr") != 2),
        "tage_lst": benefit,
    }
    late = F.datediff(F.col("endepi"), cutoff_date(month, day))
    return df.withColumns(
        {c: F.when(cond, F.col(c) - late) for c, cond in kept.items() if c in df.columns}
    )


def build_yearly_panel(data, month: int = 6, day: int = 30):
    """P5-P9 in order."""
    cutoff_date(month, day)
    people = add_year_totals(data)
    if isinstance(people, People):
        return people.map(alive_on, month, day).map(cut_durations, month, day)
    return cut_durations(alive_on(people, month, day), month, day)
