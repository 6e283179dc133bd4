"""The whole job (F1): from raw episodes to the yearly panel.

Shape of the plan: one exchange by person for all biography rules, row-wise enrichment with
broadcast lookups, and one written table in buckets by person. The regression, the quantile and the
reports start there and read only their columns; the panel rules start there without an exchange.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careerpanel.functions.frames import SLICE, pack, unpack
from careerpanel.functions.metrics import Metrics
from careerpanel.functions.people import BLOCK, ROW_LIMIT, People, by_person, person_sizes
from careerpanel.operators import biography, censor, enrich, panel, split, tobit
from careerpanel.operators.reports import report_counts, split_reports
from careerpanel.schema import PANEL, check_key, conform, raise_on_copies
from careerpanel.sources.lookups import Lookups, default_lookups
from careerpanel.sources.staging import scratch, stage, stage_bucketed
from careerpanel.sources.store import save_bucketed

#: Rows of a bucket of the prepared table. The sorts and windows of a million rows take 2.3 GB in a task.
BUCKET_ROWS = 200_000

# what the windows of each half of the job look at; all other columns travel packed
BIOGRAPHY_COLUMNS = [
    "persnr", "spell", "begorig", "begepi", "endepi", "quelle_gr", "erwstat_gr", "bnn", "grund_gr",
]
PANEL_COLUMNS = [
    "persnr", "spell", "year", "begepi", "endepi", "quelle_gr", "erwstat_gr", "tentgelt_gr",
    "wage_imp", "tage_bet", "tage_job", "tage_erw", "tage_lst",
]


def checked(people: People) -> People:
    """The same rows; (``persnr``, ``spell``) that is no key ends the job. Heavy persons are counted by key."""
    heavy = None if people.heavy is None else check_key(people.heavy)
    return People(raise_on_copies(people.ordinary), heavy, people.block, people.heavy_ids)


def build_biographies(people: People, compat: bool = False, metrics: Metrics | None = None) -> People:
    """E1, E4, E5 and B1-B11 on placed episodes."""
    if metrics is not None:
        people = people.map(split.watch_episodes, metrics)
    people = people.map(split.add_year_age).map(split.split_episodes)
    people = people.map(pack, BIOGRAPHY_COLUMNS)
    people = split.add_counters(people)
    people = biography.add_employment(people, compat=compat)
    people = biography.add_benefits(people)
    people = biography.add_establishment(people, compat=compat)
    return biography.add_jobs(people, compat=compat).map(unpack)


def enrich_episodes(df: DataFrame, lookups: Lookups) -> DataFrame:
    """J1-J10, row by row."""
    df = enrich.add_occupation(df, lookups.occupation)
    df = enrich.add_blossfeld(df, lookups.blossfeld)
    df = enrich.add_education(df)
    df = enrich.add_region(df)
    df = enrich.add_ceiling(df, lookups.ceiling)
    df = enrich.add_marginal(df, lookups.marginal)
    return enrich.deflate(df, lookups.cpi)


def prepare_wages(df: DataFrame) -> DataFrame:
    """C1, C7 and C8, row by row."""
    return censor.add_controls(censor.topcode_wage(censor.flag_censored(df)))


def impute_wages(
    df: DataFrame, seed: int = 0, compat: bool = False, fits: DataFrame | None = None
) -> DataFrame:
    """C10-C15 on prepared rows, which are read several times: stage them first.

    A regression that ends without a maximum raises; ``fits`` that are passed in are taken as they are.
    """
    return impute_people(People(df), seed, compat, fits)[0].merged()


def impute_people(
    prepared: People,
    seed: int,
    compat: bool,
    fits: DataFrame | None,
    bound: float | None = None,
    metrics: Metrics | None = None,
) -> tuple[People, DataFrame, float | None]:
    """The rows with imputed wages, the fits and the wage bound, which are found unless they are known."""
    if fits is None:
        fits = tobit.check_fits(tobit.fit_censored(prepared.merged().where(tobit.in_sample()), metrics=metrics))
    drawn = prepared.map(tobit.draw_censored, fits, seed)
    if bound is None:
        bound = censor.wage_bound(drawn.merged(), compat=compat)
    if metrics is not None:
        drawn = drawn.map(tobit.watch_draws, metrics)
    return drawn.map(censor.bound_wage, bound, compat).map(censor.drop_helpers), fits, bound


def finish_panel(
    data: DataFrame | People,
    handling: str = "wage",
    month: int = 6,
    day: int = 30,
    row_limit: int = ROW_LIMIT,
    block: int = BLOCK,
    heavy_ids: DataFrame | tuple[()] | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """P1-P9 on rows with imputed wages. :class:`People` are taken as they are placed; a frame is placed first.
    Columns in ``keep`` go along."""

    def wanted(df: DataFrame) -> DataFrame:
        return pack(df.select(*[c for c in df.columns if c in PANEL or c in ("spell", SLICE, *keep)]), PANEL_COLUMNS)

    people = data.map(wanted) if isinstance(data, People) else by_person(wanted(data), row_limit, block, heavy_ids)
    people = panel.handle_parallel_episodes(people, handling)
    return panel.build_yearly_panel(people, month, day).map(unpack).merged()


@dataclass(frozen=True)
class PanelRun:
    """What a run of the job gives: the panel, the reports as small written tables, and the fits and bound of wages
    (to be passed to runs that shall impute alike). ``metrics`` has numbers once the panel was written or read.
    ``buckets`` is the number of buckets that ordinary persons lie in."""

    panel: DataFrame
    prepared: People
    buckets: int
    reports: dict[str, DataFrame]
    fits: DataFrame
    bound: float | None
    metrics: Metrics

    def numbers(self) -> dict[str, int]:
        """E4, E6, C10-C12 and F1 in numbers: episodes, dropped, rows, counters_missing, cells, cells_fitted (if the
        job fitted them), censored, draws, draws_below, outside (rows in employment that are out of the sample) and
        panel_rows."""
        return self.metrics.numbers()


def prepare_people(
    df: DataFrame,
    lookups: Lookups,
    compat: bool = False,
    row_limit: int = ROW_LIMIT,
    block: int = BLOCK,
    metrics: Metrics | None = None,
) -> People:
    """The prepared rows of :func:`prepared_buckets` alone."""
    return prepared_buckets(df, lookups, compat, row_limit, block, metrics)[0]


def prepared_buckets(
    df: DataFrame,
    lookups: Lookups,
    compat: bool = False,
    row_limit: int = ROW_LIMIT,
    block: int = BLOCK,
    metrics: Metrics | None = None,
) -> tuple[People, int]:
    """Prepared rows in tables, ordinary persons' in buckets of ``persnr``,
    and the number of buckets.

    Persons are heavy by the rows that their episodes are going to be split into. There is a bucket for each
    ``BUCKET_ROWS`` rows, and at least one for each core, so a bucket is a task's work at any size.
    """
    df = conform(df)
    heavy, total = person_sizes(df, row_limit, rows=split.years_touched())
    buckets = max(df.sparkSession.sparkContext.defaultParallelism, -(-total // BUCKET_ROWS))
    people = checked(by_person(df, row_limit, block, () if heavy is None else heavy, parts=buckets))
    people = build_biographies(people, compat, metrics).map(enrich_episodes, lookups).map(prepare_wages)
    if metrics is not None:
        people = people.map(split.watch_counters, metrics)
    ordinary = stage_bucketed(people.ordinary, "persnr", ["persnr", "year", "begepi"], buckets, "prepared")
    spread = None if people.heavy is None else stage(people.heavy, "prepared-heavy")
    return People(ordinary, spread, block, people.heavy_ids), buckets


def run_panel(
    df: DataFrame,
    lookups: Lookups | None = None,
    handling: str = "wage",
    cutoff: tuple[int, int] = (6, 30),
    seed: int = 0,
    compat: bool = False,
    row_limit: int = ROW_LIMIT,
    block: int = BLOCK,
    fits: DataFrame | None = None,
    bound: float | None = None,
    reports: bool = True,
    keep: tuple[str, ...] = (),
) -> PanelRun:
    """F1 with all that it tells. The counts come from the passes that the job makes anyway; the reports are one
    further aggregation over a few columns of the prepared rows. See :func:`prepare_panel`."""
    panel.check_handling(handling)
    date(2000, *cutoff)
    metrics = Metrics()
    lookups = lookups or default_lookups(df.sparkSession)
    prepared, buckets = prepared_buckets(df, lookups, compat, row_limit, block, metrics)
    if missing := metrics.numbers()["counters_missing"]:
        raise ValueError(f"{missing} rows have no observation counter")
    found: dict[str, DataFrame] = {}
    if reports:
        found = split_reports(stage(report_counts(prepared.merged()), "reports"), lookups)
    imputed, fits, bound = impute_people(prepared, seed, compat, fits, bound, metrics)
    out = finish_panel(imputed, handling, *cutoff, keep=keep).select(*PANEL, *keep)
    out = metrics.watch(out, panel_rows=F.count(F.lit(1)))
    return PanelRun(out, prepared, buckets, found, fits, bound, metrics)


def prepare_panel(
    df: DataFrame,
    lookups: Lookups | None = None,
    handling: str = "wage",
    cutoff: tuple[int, int] = (6, 30),
    seed: int = 0,
    compat: bool = False,
    row_limit: int = ROW_LIMIT,
    block: int = BLOCK,
    fits: DataFrame | None = None,
    bound: float | None = None,
) -> DataFrame:
    """the yearly panel of an episode table. Wrong ``handling`` or ``cutoff`` fail before any work.

    Episodes that share (``persnr``, ``spell``) and draws that are missing or below the wage end the job too.
    ``fits`` are those of ``tobit.fit_censored``, if they are known; else the job fits and checks them.
    ``bound`` is the largest imputed wage, if it is known; else it follows from their quantile (C14).
    """
    return run_panel(df, lookups, handling, cutoff, seed, compat, row_limit, block, fits, bound, reports=False).panel


def store_panel(df: DataFrame, path: str, **options) -> tuple[dict[str, int], dict[str, list[dict]]]:
    """F1 from episodes to a finished table at ``path`` (which must be new), in the buckets by person that the job
    works in, so the rows move once from end to end. Returns the job's numbers and its reports as rows. All
    intermediate tables are gone afterwards, also if the job fails."""
    spark = df.sparkSession
    with scratch(spark):
        run = run_panel(df, **options)
        save_bucketed(run.panel, path, run.buckets, placed=run.prepared.heavy is None)
        return run.numbers(), {name: [r.asDict() for r in report.collect()] for name, report in run.reports.items()}
