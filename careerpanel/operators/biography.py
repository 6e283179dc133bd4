"""Biographies: first days, running days and job spells per person.

Each rule exists twice with the same result: over whole ordinary persons, and spread over the
slices of a heavy person (see ``careerpanel.functions.people``). ``compat=True`` gives the older
literal behaviour where it differs from the documented rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from careerpanel.functions.carry import carry
from careerpanel.functions.frames import (
    ALL,
    BEFORE,
    SO_FAR,
    days,
    left_null_safe,
    ordered,
    running,
    three_valued,
)
from careerpanel.functions.people import PersonStep, with_block
from careerpanel.sources.staging import stage

BENEFIT_SOURCES = (2, 16)
END_REASONS = (0, 3, 5)
JOB = ["persnr", "azubi", "bnn"]


def add_flags(df: DataFrame) -> DataFrame:
    """B1: ``azubi`` marks vocational training, ``emp`` employment outside of it."""
    return df.withColumn("azubi", three_valued(F.col("erwstat_gr") == 2, 1, 0)).withColumn(
        "emp", three_valued((F.col("quelle_gr") == 1) & (F.col("azubi") == 0), 1, 0)
    )


def _first_at_start(kind: Column) -> Column:
    """Whether a row is the first of its kind, by ``spell``, at its start day."""
    before = ordered(["persnr"], ["begepi", "spell"]).rowsBetween(*BEFORE)
    latest = F.last(F.when(kind, F.col("begepi")), ignorenulls=True).over(before)
    return kind & F.coalesce(latest != F.col("begepi"), F.lit(True))


# --- employment: B2, B3 ---------------------------------------------------------------------


def _first_days(compat: bool, over: WindowSpec) -> Column:
    """``ein_erw`` from the first ``begorig`` of the person's rows of each kind."""

    def first(kind):
        return F.min(F.when(kind, F.col("begorig"))).over(over)

    emp = F.col("emp")
    if not compat:
        return first(emp == 1)
    return (
        F.when(emp == 1, first(emp == 1))
        .when(emp == 0, first(emp == 0))
        .otherwise(first(emp.isNull()))
    )


def _days_employed(total: Column, compat: bool) -> Column:
    return total if compat else F.coalesce(total, F.lit(0))


def _add_employment(df: DataFrame, compat: bool = False) -> DataFrame:
    """First day in employment ``ein_erw`` and days employed so far ``tage_erw``.

    Of parallel employment episodes with one start only the first counts; training never does.
    All rows of a start carry the same total, hence the frame that includes peers.
    """
    days_order = ordered(["persnr"], ["begepi"])
    df = add_flags(df)
    counts = _first_at_start(F.col("emp") == 1)
    return (
        df.withColumn("_days", F.when(counts, days()))
        .withColumns(
            {
                "tage_erw": _days_employed(
                    F.sum("_days").over(days_order.rangeBetween(*SO_FAR)), compat
                ),
                "ein_erw": _first_days(compat, days_order.rowsBetween(*ALL)),
            }
        )
        .drop("_days", "emp")
    )


def _add_employment_spread(df: DataFrame, block: int, compat: bool = False) -> DataFrame:
    df = with_block(add_flags(df), block)
    emp = F.col("emp") == 1
    keys = ["persnr", "emp"] if compat else ["persnr"]
    entry = F.min("begorig") if compat else F.min(F.when(emp, F.col("begorig")))
    first = df.groupBy(*keys).agg(entry.alias("ein_erw"))

    def scan(pieces, w):
        # the first employment row of a day is in one of its slices; the others add nothing
        day = Window.partitionBy("persnr", "begepi").orderBy(F.asc_nulls_last("first"), "_block")
        pieces = pieces.withColumn("d", F.when(F.row_number().over(day) == 1, F.col("d")))
        total = F.sum("d").over(ordered(["persnr"], ["begepi"]).rangeBetween(*SO_FAR))
        return pieces.select(
            "persnr", "begepi", "_block", _days_employed(total, compat).alias("tage_erw")
        )

    parts = {
        "first": F.min(F.when(emp, F.col("spell"))),
        "d": F.min_by(F.when(emp, days()), F.when(emp, F.col("spell"))),
    }
    out = carry(df, ["persnr"], ["begepi", "_block"], parts, scan)
    return left_null_safe(out, first, keys).drop("emp", "_block")


add_employment = PersonStep(_add_employment, _add_employment_spread)


# --- establishment: B4, B5 ------------------------------------------------------------------


def _add_establishment(df: DataFrame, compat: bool = False) -> DataFrame:
    """First day ``ein_bet`` and days so far ``tage_bet`` in an establishment.

    Episodes with the same bounds count once. Both are null where ``bnn`` is unknown.
    """
    firm = ["persnr", "bnn"]
    by_bounds = ordered(firm, ["begepi", "endepi", "spell"])
    known = F.col("bnn").isNotNull()
    entry = F.min("begepi").over(by_bounds.rowsBetween(*ALL))
    again = (F.lag("begepi").over(by_bounds) == F.col("begepi")) & (
        F.lag("endepi").over(by_bounds) == F.col("endepi")
    )
    return (
        df.withColumns(
            {
                "_days": F.when(again, 0).otherwise(days()),
                "ein_bet": entry if compat else F.when(known, entry),
            }
        )
        .withColumn(
            "tage_bet", F.when(known, F.sum("_days").over(running(firm, ["spell", "begepi"])))
        )
        .drop("_days")
    )


def _add_establishment_spread(df: DataFrame, block: int, compat: bool = False) -> DataFrame:
    firm = ["persnr", "bnn"]
    bounds = firm + ["begepi", "endepi"]
    known = F.col("bnn").isNotNull()

    def leader(pieces, w):
        return pieces.select(*bounds, "_block", F.min("s").over(w.rowsBetween(*ALL)).alias("_leader"))

    rows = carry(with_block(df, block), bounds, ["_block"], {"s": F.min("spell")}, leader)
    rows = stage(
        rows.withColumn(
            "_days", F.when(F.col("spell") == F.col("_leader"), days()).otherwise(0)
        ).drop("_leader")
    )

    def scan(pieces, w):
        return pieces.select(
            *firm,
            "_block",
            F.sum("d").over(w.rowsBetween(*BEFORE)).alias("_before"),
            F.min("entry").over(w.rowsBetween(*ALL)).alias("_entry"),
        )

    inside = running(firm + ["_block"], ["spell", "begepi"])
    parts = {"d": F.sum("_days"), "entry": F.min("begepi")}
    out = carry(rows, firm, ["_block"], parts, scan)
    total = F.coalesce("_before", F.lit(0)) + F.sum("_days").over(inside)
    return out.withColumns(
        {
            "ein_bet": F.col("_entry") if compat else F.when(known, F.col("_entry")),
            "tage_bet": F.when(known, total),
        }
    ).drop("_days", "_before", "_block", "_entry")


add_establishment = PersonStep(_add_establishment, _add_establishment_spread)


# --- jobs: B6-B8 ----------------------------------------------------------------------------


def _starts_job(
    is_first: Column, gap: Column, reason: Column, short: int, long: int, reasons, compat: bool
) -> Column:
    """Whether a row begins a new job, given the gap to and the end reason of the row before."""
    if compat:
        cond = gap > short
    else:
        ended = F.coalesce(reason.isin(list(reasons)), F.lit(False))
        cond = (gap > long) | ((gap > short) & ended)
    return is_first | F.coalesce(cond, F.lit(False))


def _add_jobs(
    df: DataFrame,
    short: int = 92,
    long: int = 366,
    end_reasons: tuple[int, ...] = END_REASONS,
    compat: bool = False,
) -> DataFrame:
    """First day ``ein_job`` and days so far ``tage_job`` of the current job.

    Within person, training flag and firm a new job begins with the first row, after a gap of
    more than ``long`` days, or of more than ``short`` days if the first episode at the previous
    start reported an end of employment. Of parallel rows with one start only the first counts.
    Both are null where the firm or the training flag is unknown.
    """
    w = ordered(JOB, ["begepi", "spell"])
    so_far, before = w.rowsBetween(*SO_FAR), w.rowsBetween(*BEFORE)
    known = F.col("bnn").isNotNull() & F.col("azubi").isNotNull()
    first = F.col("_beg").isNull()
    opens_day = first | (F.col("_beg") != F.col("begepi"))
    df = df.withColumns({"_end": F.lag("endepi").over(w), "_beg": F.lag("begepi").over(w)})
    df = df.withColumn("_days", F.when(opens_day, days()).otherwise(0)).withColumns(
        {
            # a struct, so that a missing reason is not skipped
            "_reason": F.last(
                F.when(opens_day, F.struct("grund_gr")), ignorenulls=True
            ).over(before)["grund_gr"],
            "_total": F.sum("_days").over(so_far),
        }
    )
    gap = F.datediff("begepi", "_end") - 1
    df = df.withColumn(
        "_new", _starts_job(first, gap, F.col("_reason"), short, long, end_reasons, compat)
    )

    def at_start(value):
        return F.last(F.when(F.col("_new"), value), ignorenulls=True).over(so_far)

    df = df.withColumns(
        {
            "ein_job": F.when(known, at_start(F.col("begepi"))),
            "tage_job": F.when(
                known, F.col("_total") - at_start(F.col("_total") - F.col("_days"))
            ),
        }
    )
    if compat:
        # a job of one row stays without dates
        single = F.col("_new") & F.coalesce(F.lead("_new").over(w), F.lit(True))
        df = df.withColumn("_single", single).withColumns(
            {c: F.when(~F.col("_single"), F.col(c)) for c in ("ein_job", "tage_job")}
        ).drop("_single")
    return df.drop("_reason", "_end", "_beg", "_new", "_days", "_total")


def _add_jobs_spread(
    df: DataFrame,
    block: int,
    short: int = 92,
    long: int = 366,
    end_reasons: tuple[int, ...] = END_REASONS,
    compat: bool = False,
) -> DataFrame:
    slices = ["begepi", "_block"]
    has_job = F.col("bnn").isNotNull() & F.col("azubi").isNotNull()
    columns = df.columns + ["ein_job", "tage_job"]
    others = df.where(~has_job).withColumns(
        {"ein_job": F.lit(None).cast("date"), "tage_job": F.lit(None).cast("long")}
    )

    def edges(pieces, w):
        day = ordered(JOB + ["begepi"], ["_block"])
        pieces = pieces.withColumns(
            {
                "_day_reason": F.first("reason").over(day),
                "_day_opens": F.row_number().over(day) == 1,
                "_opens": F.row_number().over(w) == 1,
                "_prev_end": F.lag("end").over(w),
            }
        )
        return pieces.withColumn("_prev_reason", F.lag("_day_reason").over(w)).drop("reason", "end")

    inside = ordered(JOB + slices, ["spell"])
    rows = carry(
        with_block(df.where(has_job), block),
        JOB,
        slices,
        {"reason": F.min_by("grund_gr", "spell"), "end": F.max_by("endepi", "spell")},
        edges,
    ).withColumns({"_nr": F.row_number().over(inside), "_lag": F.lag("endepi").over(inside)})
    head = F.col("_nr") == 1
    gap = F.datediff("begepi", F.when(head, F.col("_prev_end")).otherwise(F.col("_lag"))) - 1
    reason = F.when(head, F.col("_prev_reason")).otherwise(F.col("_day_reason"))
    rows = rows.withColumns(
        {
            "_new": _starts_job(
                head & F.col("_opens"), gap, reason, short, long, end_reasons, compat
            ),
            "_days": F.when(head & F.col("_day_opens"), days()).otherwise(0),
        }
    ).drop("_nr", "_lag", "_day_reason", "_day_opens", "_opens", "_prev_end", "_prev_reason")
    so_far = inside.rowsBetween(*SO_FAR)
    rows = stage(
        rows.withColumns(
            {
                "_total": F.sum("_days").over(so_far),
                "_jobs": F.sum(F.col("_new").cast("long")).over(so_far),
            }
        )
    )
    base = F.when(F.col("_new"), F.col("_total") - F.col("_days"))

    def totals(pieces, w):
        before = w.rowsBetween(*BEFORE)
        pieces = pieces.withColumns(
            {
                "_total_before": F.coalesce(F.sum("total").over(before), F.lit(0)),
                "_jobs_before": F.coalesce(F.sum("jobs").over(before), F.lit(0)),
                "_start_before": F.last(
                    F.when(F.col("jobs") > 0, F.col("begepi")), ignorenulls=True
                ).over(before),
            }
        ).withColumn("base", F.col("_total_before") + F.col("base"))
        return pieces.withColumn("_base_before", F.last("base", ignorenulls=True).over(before)).drop(
            "total", "jobs", "base"
        )

    rows = carry(
        rows.withColumn("_base", F.last(base, ignorenulls=True).over(so_far)),
        JOB,
        slices,
        {
            "total": F.sum("_days"),
            "jobs": F.sum(F.col("_new").cast("long")),
            "base": F.max_by(base, F.when(F.col("_new"), F.col("spell"))),
        },
        totals,
    )
    total = F.col("_total_before") + F.col("_total")
    start = F.coalesce(F.col("_total_before") + F.col("_base"), F.col("_base_before"))
    rows = rows.withColumns(
        {
            "ein_job": F.when(F.col("_jobs") > 0, F.col("begepi")).otherwise(F.col("_start_before")),
            "tage_job": total - start,
            "_job": F.col("_jobs_before") + F.col("_jobs"),
        }
    )
    if compat:
        job = JOB + ["_job"]

        def size(pieces, w):
            total = F.sum("n").over(w.rowsBetween(*ALL))
            return pieces.select(*job, *slices, total.alias("_size"))

        rows = carry(stage(rows), job, slices, {"n": F.count(F.lit(1))}, size).withColumns(
            {c: F.when(F.col("_size") > 1, F.col(c)) for c in ("ein_job", "tage_job")}
        )
    return rows.select(*columns).unionByName(others.select(*columns))


add_jobs = PersonStep(_add_jobs, _add_jobs_spread)


# --- benefits: B9-B11 -----------------------------------------------------------------------


def _benefit_columns(max_gap: int) -> dict[str, Column]:
    """Receipts and days that a row adds; ``_first`` marks the first benefit row at its start."""
    gap = F.datediff("begepi", "ende_vor")
    fresh = F.col("ende_vor").isNull() | (gap > max_gap)
    return {
        "_receipt": F.when(F.col("_first") & fresh, 1).otherwise(0),
        "_days": F.when(F.col("_first"), days()).otherwise(0),
    }


def _add_benefits(
    df: DataFrame, sources: tuple[int, ...] = BENEFIT_SOURCES, max_gap: int = 10
) -> DataFrame:
    """End of the last benefit ``ende_vor``, receipts ``anz_lst`` and days ``tage_lst`` so far.

    A receipt is the first benefit row at its start that begins more than ``max_gap`` days after
    the end of the last benefit row before it (in the order of ``spell``), or has none before it.
    """
    person = ordered(["persnr"], ["spell", "begepi"])
    benefit = F.coalesce(F.col("quelle_gr").isin(list(sources)), F.lit(False))
    last_end = F.last(F.when(benefit, F.col("endepi")), ignorenulls=True)
    so_far = person.rowsBetween(*SO_FAR)
    return (
        df.withColumn("_first", _first_at_start(benefit))
        .withColumn("ende_vor", last_end.over(person.rowsBetween(*BEFORE)))
        .withColumns(_benefit_columns(max_gap))
        .withColumns(
            {
                "anz_lst": F.sum("_receipt").over(so_far),
                "tage_lst": F.sum("_days").over(so_far),
            }
        )
        .drop("_first", "_receipt", "_days")
    )


def _add_benefits_spread(
    df: DataFrame,
    block: int,
    sources: tuple[int, ...] = BENEFIT_SOURCES,
    max_gap: int = 10,
) -> DataFrame:
    benefit = F.coalesce(F.col("quelle_gr").isin(list(sources)), F.lit(False))

    def leader(pieces, w):
        first = F.min("s").over(w.rowsBetween(*ALL))
        return pieces.select("persnr", "begepi", "_block", first.alias("_leader"))

    rows = carry(
        with_block(df, block),
        ["persnr", "begepi"],
        ["_block"],
        {"s": F.min(F.when(benefit, F.col("spell")))},
        leader,
    ).withColumn("_first", benefit & (F.col("spell") == F.col("_leader")))
    inside = ordered(["persnr", "_block"], ["spell", "begepi"])
    known_end = F.when(benefit, F.col("endepi"))

    def ends(pieces, w):
        last = F.last("end", ignorenulls=True).over(w.rowsBetween(*BEFORE))
        return pieces.select("persnr", "_block", last.alias("_end_before"))

    place = F.when(benefit & F.col("endepi").isNotNull(), F.struct("spell", "begepi"))
    rows = carry(rows, ["persnr"], ["_block"], {"end": F.max_by("endepi", place)}, ends)
    local = F.last(known_end, ignorenulls=True).over(inside.rowsBetween(*BEFORE))
    rows = stage(
        rows.withColumn("ende_vor", F.coalesce(local, F.col("_end_before")))
        .withColumns(_benefit_columns(max_gap))
        .drop("_leader", "_end_before")
    )

    def totals(pieces, w):
        before = w.rowsBetween(*BEFORE)
        return pieces.select(
            "persnr",
            "_block",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_n"),
            F.coalesce(F.sum("d").over(before), F.lit(0)).alias("_d"),
        )

    so_far = inside.rowsBetween(*SO_FAR)
    return (
        carry(
            rows, ["persnr"], ["_block"], {"n": F.sum("_receipt"), "d": F.sum("_days")}, totals
        )
        .withColumns(
            {
                "anz_lst": F.col("_n") + F.sum("_receipt").over(so_far),
                "tage_lst": F.col("_d") + F.sum("_days").over(so_far),
            }
        )
        .drop("_first", "_receipt", "_days", "_n", "_d", "_block")
    )


add_benefits = PersonStep(_add_benefits, _add_benefits_spread)
