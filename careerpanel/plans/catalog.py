"""Every operator as a query over the given tables, with the SQL that must give the same rows.

A query is a relation and a list of output columns. Columns are plain, ``i:`` whole numbers
(compared as 64-bit), or ``r<digits>:`` doubles rounded to so many digits.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careerpanel.functions.people import People
from careerpanel.operators import biography, censor, enrich, panel, split, tobit
from careerpanel.operators.reports import AXES, SETS, report_counts
from careerpanel.plans import pipeline
from careerpanel.plans.adapter import episode_people, episodes
from careerpanel.plans.incremental import PanelStore
from careerpanel.plans.oracle import with_clause
from careerpanel.schema import check_key, conform
from careerpanel.sources import ingest
from careerpanel.sources.lookups import (
    CEILING_SCHEMA,
    LOOKUP_ROWS,
    default_lookups,
    read_lookup,
    values_sql,
)
from careerpanel.sources.staging import fresh_path, stage
from careerpanel.sources.store import EpisodeStore, open_bucketed

BATCH = 1000
JOB_DAYS = ["tage_erw", "tage_bet", "tage_job"]


def shaped(df: DataFrame, columns: str) -> DataFrame:
    out = []
    for item in columns.split():
        kind, _, name = item.rpartition(":")
        c = F.col(name)
        if kind == "i":
            c = c.cast("bigint")
        elif kind.startswith("r"):
            c = F.round(c.cast("double"), int(kind[1:]))
        out.append(c.alias(name))
    return df.select(*out)


def shaped_sql(columns: str) -> str:
    out = []
    for item in columns.split():
        kind, _, name = item.rpartition(":")
        if kind == "i":
            name = f"CAST({name} AS BIGINT) AS {name}"
        elif kind.startswith("r"):
            name = f"round(CAST({name} AS DOUBLE), {kind[1:]}) AS {name}"
        out.append(name)
    return ", ".join(out)


@dataclass(frozen=True)
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    columns: str
    sql: str | None = None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return shaped(self.build(spark, sf_dir), self.columns)

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        head, _, body = self.sql.rpartition("\n::")
        return f"{head}\nSELECT {shaped_sql(self.columns)} FROM ({body})"


def _from(last: str, body: str | None = None, **options) -> str:
    return with_clause(last, **options) + "\n::" + (body or f"SELECT * FROM {last}")


# --- relations on the Spark side ------------------------------------------------------------


def _count_columns(df: DataFrame, gone: list[str]) -> DataFrame:
    """With ``left_over``: how many of the columns that should be gone are still there."""
    return df.withColumn("left_over", F.lit(len(set(gone) & set(df.columns))))


def _placed(spark, sf_dir) -> People:
    return episode_people(spark, sf_dir).map(split.add_year_age)


def _split(spark, sf_dir) -> People:
    return _placed(spark, sf_dir).map(split.split_episodes)


def _step(step, **options):
    return lambda spark, sf_dir: step(_split(spark, sf_dir), **options).merged()


def _biographies(spark, sf_dir) -> People:
    return pipeline.build_biographies(episode_people(spark, sf_dir))


def _enriched(spark, sf_dir) -> DataFrame:
    """The split episodes with the enrichment; no biography, which the joins do not need."""
    return pipeline.enrich_episodes(_split(spark, sf_dir).merged(), default_lookups(spark))


def _enrich(step):
    return lambda spark, sf_dir: step(_split(spark, sf_dir).merged(), default_lookups(spark))


def _wages(spark, sf_dir) -> DataFrame:
    return censor.topcode_wage(censor.flag_censored(_enriched(spark, sf_dir)))


def _flagged(report):
    return lambda spark, sf_dir: report(censor.flag_censored(_enriched(spark, sf_dir)))


def _with_jobs(spark, sf_dir) -> DataFrame:
    people = biography.add_jobs(_split(spark, sf_dir).map(biography.add_flags))
    people = people.map(pipeline.enrich_episodes, default_lookups(spark))
    return people.map(pipeline.prepare_wages).merged()


def _parallel_input(spark, sf_dir) -> People:
    """Biographies with observed wages in the place of imputed ones."""
    people = _biographies(spark, sf_dir).map(pipeline.enrich_episodes, default_lookups(spark))
    people = people.map(pipeline.prepare_wages)
    return people.map(lambda df: df.withColumn("wage_imp", F.col("wage")))


def _main(handling: str = "wage"):
    def build(spark, sf_dir):
        people = panel.add_parallel_totals(_parallel_input(spark, sf_dir))
        return panel.add_nspell(panel.main_episode(people, handling=handling))

    return build


def _handled(spark, sf_dir) -> People:
    return panel.handle_parallel_episodes(_parallel_input(spark, sf_dir))


def _s3_append(spark, sf_dir) -> DataFrame:
    path = fresh_path(spark, "store")
    ingest.append_batches(ingest.assign_batches(episodes(spark, sf_dir), BATCH), path)
    stored = ingest.read_episodes(spark, path, check=False)
    return stored.groupBy("pn_batch").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("persnr").alias("persons")
    )


def _s3_append_twice(spark, sf_dir) -> DataFrame:
    """The first batches, then all, then all again."""
    store = EpisodeStore(spark, fresh_path(spark, "store"))
    rows = stage(ingest.assign_batches(episodes(spark, sf_dir), BATCH), "assigned")
    for part in (rows.where("pn_batch <= 2"), rows, rows):
        store.append(part)
    return store.read().groupBy("pn_batch").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("persnr").alias("persons")
    )


def _s3_refresh(spark, sf_dir) -> DataFrame:
    """The panel after two deliveries: most persons' first episodes, then the rest and new persons."""
    store = PanelStore(spark, fresh_path(spark, "panel-store"), BATCH)
    rows = stage(episodes(spark, sf_dir), "episodes")
    early = (F.col("persnr") % 5 != 0) & ((F.col("persnr") % 3 != 0) | (F.col("spell") <= 4))
    for load, part in (("1", rows.where(early)), ("2", rows.where(~early))):
        store.deliver(part, load)
        store.refresh(reports=False)
    return _single_jobs(store.panel())


def _s5_bucketed(spark, sf_dir) -> DataFrame:
    """Years and employment days of each person from the stored table, which is dealt by person."""
    path = fresh_path(spark, "panel")
    pipeline.store_panel(episodes(spark, sf_dir), path, reports=False)
    return open_bucketed(spark, path).groupBy("persnr").agg(
        F.countDistinct("year").alias("years"), F.sum("tage_lst").alias("tage_lst"), F.max("nspell").alias("last_spell")
    )


def _s4_lookup(spark, sf_dir) -> DataFrame:
    path = fresh_path(spark, "lookup")
    rows, names = LOOKUP_ROWS["ceiling"]
    spark.sql(values_sql(rows, names)).write.csv(path, header=True)
    ceiling = read_lookup(spark, path, CEILING_SCHEMA)
    regions = enrich.add_region(split.add_year_age(episodes(spark, sf_dir)))
    return (
        enrich.add_ceiling(regions, ceiling)
        .groupBy("year", "east", "limit_assess")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _fits(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    rows = stage(_with_jobs(spark, sf_dir), "prepared")
    return rows, tobit.fit_censored(rows.where(tobit.in_sample()))


def _drawn(spark, sf_dir) -> DataFrame:
    rows, fits = _fits(spark, sf_dir)
    return tobit.draw_censored(rows, fits)


# with more uncensored rows than coefficients a cell has a fit; with fewer it depends on their rank
SURE = f"n_free > {len(tobit.REGRESSORS) + 1}"


def _c10_slopes(spark, sf_dir) -> DataFrame:
    rows, fits = _fits(spark, sf_dir)
    slopes = tobit.fit_slopes(rows.where(tobit.in_sample()), fits)
    return slopes.withColumn("status", F.when(F.expr(SURE), F.col("status")))


def _c11_places(spark, sf_dir) -> DataFrame:
    rows, fits = _fits(spark, sf_dir)
    return tobit.places_in_tail(tobit.draw_censored(rows, fits), fits.where(SURE))


def _c13_places(spark, sf_dir) -> DataFrame:
    same = F.col("ln_wage_imp") == F.col("ln_wage")
    return _drawn(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(tobit.in_sample() & (F.col("cens") == 0) & same).alias("observed"),
        F.count_if(~tobit.in_sample() & F.col("ln_wage_imp").isNull()).alias("outside"),
    )


def _panel(spark, sf_dir, **options) -> DataFrame:
    return pipeline.prepare_panel(episodes(spark, sf_dir), **options)


def _single_jobs(panel: DataFrame) -> DataFrame:
    single = F.col("parallel_jobs") <= 1
    return panel.withColumns({c: F.when(single, F.col(c)) for c in JOB_DAYS})


def _panel_of_single_jobs(spark, sf_dir) -> DataFrame:
    return _single_jobs(_panel(spark, sf_dir))


def _f1_reports(spark, sf_dir) -> DataFrame:
    rows = stage(censor.flag_censored(_enriched(spark, sf_dir)), "flagged")
    return report_counts(rows)


def _f1_numbers(spark, sf_dir) -> DataFrame:
    """What a run counts on the way, as one row."""
    run = pipeline.run_panel(episodes(spark, sf_dir), reports=False)
    stage(run.panel, "panel")
    numbers = run.numbers()
    return spark.createDataFrame([tuple(numbers.values())], ", ".join(f"{n} bigint" for n in numbers))


def _s5_store(spark, sf_dir) -> DataFrame:
    path = fresh_path(spark, "panel")
    ingest.write_panel(_panel(spark, sf_dir), path)
    return spark.read.parquet(path)


SAMPLE = """quelle_gr = 1 AND marginal = 0 AND east IS NOT NULL AND tage_job IS NOT NULL
  AND ln_wage IS NOT NULL AND cens IS NOT NULL AND ln_limit_assess4 IS NOT NULL"""
ROW = "i:persnr i:spell begepi endepi"
EPISODE = (
    "i:persnr i:spell begorig begepi endepi i:quelle_gr i:erwstat_gr i:bnn i:grund_gr "
    "r6:tentgelt_gr i:beruf_gr i:ausbildung i:ao_region i:gebjahr i:frau i:teilzeit"
)
SPLIT = "i:persnr i:spell begepi endepi begepi_orig endepi_orig i:year i:age"
MAIN = "i:persnr i:nspell begepi endepi i:quelle_gr i:year"
REPORTED = "quelle_gr = 1 AND cens IS NOT NULL"
SINGLE = (
    MAIN + " ein_erw i:tage_erw i:tage_bet i:tage_job i:anz_lst i:tage_lst i:parallel_jobs"
    " r6:parallel_wage i:parallel_benefits i:year_days_emp i:year_days_benefits"
)


def _ambiguous(table: str, target: str) -> str:
    return f"""
  SELECT beruf_gr, n_episodes, regexp_replace(list, ',([^,]*)$', ' and \\1') AS matched
  FROM (SELECT beruf_gr, string_agg(CAST({target} AS VARCHAR), ',' ORDER BY place) AS list
        FROM {table} WHERE n_{target} <> 1 GROUP BY beruf_gr)
  JOIN (SELECT beruf_gr, count(*) AS n_episodes FROM ep GROUP BY beruf_gr) USING (beruf_gr)"""


SINGLE_SQL = _from(
    "cut",
    "SELECT * REPLACE ("
    + ", ".join(f"CASE WHEN parallel_jobs <= 1 THEN {c} END AS {c}" for c in JOB_DAYS)
    + ") FROM cut",
)
RUNNING_ROWS = f"""
  SELECT persnr, n, a AS last_row, CAST(floor(a / {BATCH}) + 1 AS BIGINT) AS pn_batch
  FROM (SELECT persnr, n, sum(n) OVER (ORDER BY persnr ROWS UNBOUNDED PRECEDING) AS a
        FROM (SELECT persnr, count(*) AS n FROM ep GROUP BY persnr))"""

QUERIES: dict[str, Query] = {
    # sources and sinks
    "s1_episodes": Query(
        lambda s, d: check_key(conform(episodes(s, d))), EPISODE, _from("ep")
    ),
    "s2_batches": Query(
        lambda s, d: ingest.batch_plan(episodes(s, d), BATCH),
        "i:pn_batch i:min_row i:max_row",
        _from("ep", f"SELECT pn_batch, max(last_row) - sum(n) + 1 AS min_row, max(last_row) AS max_row"
                    f" FROM ({RUNNING_ROWS}) GROUP BY pn_batch"),
    ),
    "s2_assign": Query(
        lambda s, d: ingest.assign_batches(episodes(s, d), BATCH),
        "i:persnr i:spell i:pn_batch",
        _from("ep", f"SELECT * FROM ep JOIN ({RUNNING_ROWS}) USING (persnr)"),
    ),
    "s3_append": Query(
        _s3_append,
        "i:pn_batch i:n i:persons",
        _from("ep", f"SELECT pn_batch, sum(n) AS n, count(*) AS persons FROM ({RUNNING_ROWS})"
                    " GROUP BY pn_batch"),
    ),
    "s3_append_twice": Query(
        _s3_append_twice,
        "i:pn_batch i:n i:persons",
        _from("ep", f"SELECT pn_batch, sum(n) AS n, count(*) AS persons FROM ({RUNNING_ROWS})"
                    " GROUP BY pn_batch"),
    ),
    "s4_lookup": Query(
        _s4_lookup,
        "i:year i:east r6:limit_assess i:n",
        _from("ep", """
  SELECT e.year, e.east, limit_assess, count(*) AS n
  FROM (SELECT year(begepi) AS year, CASE WHEN ao_region // 1000 < 11 THEN 0
               WHEN ao_region // 1000 BETWEEN 11 AND 16 THEN 1 END AS east FROM ep) AS e
  LEFT JOIN ceiling ON e.east = ceiling.east AND e.year = ceiling.year GROUP BY ALL""",
              lookups=["ceiling"]),
    ),
    "s5_store": Query(_s5_store, "i:persnr i:year i:nspell r6:wage_imp"),
    "s5_stored": Query(
        _s5_store,
        MAIN + " ein_erw i:anz_lst i:tage_lst i:parallel_jobs r6:parallel_wage i:year_days_emp i:year_days_benefits",
        _from("cut"),
    ),
    "s5_bucketed": Query(
        _s5_bucketed,
        "i:persnr i:years i:tage_lst i:last_spell",
        _from("cut", "SELECT persnr, count(DISTINCT year) AS years, sum(tage_lst) AS tage_lst, max(nspell) AS last_spell"
                     " FROM cut GROUP BY persnr"),
    ),
    # episodes
    "e1_year_age": Query(
        lambda s, d: split.add_year_age(episodes(s, d)),
        "i:persnr i:spell i:year i:age",
        _from("ep", "SELECT *, year(begepi) AS year, year(begepi) - gebjahr AS age FROM ep"),
    ),
    "e2_span": Query(
        lambda s, d: split.add_span(episodes(s, d)),
        "i:persnr i:spell begepi_orig endepi_orig i:span_year",
        _from("ep", "SELECT *, begepi AS begepi_orig, endepi AS endepi_orig,"
                    " year(endepi) - year(begepi) + 1 AS span_year FROM ep"),
    ),
    "e3_span_report": Query(
        lambda s, d: split.span_report(episodes(s, d)),
        "i:span_year i:n",
        _from("ep", "SELECT year(endepi) - year(begepi) + 1 AS span_year, count(*) AS n FROM ep"
                    " GROUP BY ALL ORDER BY n DESC"),
    ),
    "e4_split": Query(lambda s, d: _split(s, d).merged(), SPLIT, _from("sp")),
    "e5_counters": Query(
        _step(split.add_counters), ROW + " i:level1 i:level2", _from("lev")
    ),
    "e6_counter_gaps": Query(
        lambda s, d: split.counter_gaps(_step(split.add_counters)(s, d)),
        "i:missing",
        _from("lev", "SELECT count(*) - count(level1 + level2) AS missing FROM lev"),
    ),
    # biographies
    "b1_flags": Query(
        lambda s, d: biography.add_flags(_split(s, d).merged()),
        ROW + " i:azubi i:emp",
        _from("flag"),
    ),
    "b2_first_employment": Query(
        _step(biography.add_employment), ROW + " ein_erw", _from("bio")
    ),
    "b3_days_employment": Query(
        _step(biography.add_employment), ROW + " i:tage_erw", _from("bio")
    ),
    "b3_compat": Query(
        _step(biography.add_employment, compat=True),
        ROW + " ein_erw i:tage_erw",
        _from("bio", compat=True),
    ),
    "b4_first_firm": Query(_step(biography.add_establishment), ROW + " ein_bet", _from("bio")),
    "b5_days_firm": Query(_step(biography.add_establishment), ROW + " i:tage_bet", _from("bio")),
    "b5_compat": Query(
        _step(biography.add_establishment, compat=True),
        ROW + " ein_bet i:tage_bet",
        _from("bio", compat=True),
    ),
    "b6_job_spells": Query(
        lambda s, d: biography.add_jobs(_split(s, d).map(biography.add_flags)).merged(),
        ROW + " i:azubi i:bnn ein_job",
        _from("bio"),
    ),
    "b7_first_job_day": Query(
        lambda s, d: biography.add_jobs(_split(s, d).map(biography.add_flags))
        .merged()
        .groupBy("persnr", "azubi", "bnn", "ein_job")
        .agg(F.count(F.lit(1)).alias("n"), F.max("tage_job").alias("days")),
        "i:persnr i:azubi i:bnn ein_job i:n i:days",
        _from("bio", "SELECT persnr, azubi, bnn, ein_job, count(*) AS n, max(tage_job) AS days"
                     " FROM bio GROUP BY ALL"),
    ),
    "b8_days_job": Query(
        lambda s, d: biography.add_jobs(_split(s, d).map(biography.add_flags)).merged(),
        ROW + " i:tage_job",
        _from("bio"),
    ),
    "b8_compat": Query(
        lambda s, d: biography.add_jobs(
            _split(s, d).map(biography.add_flags), compat=True
        ).merged(),
        ROW + " ein_job i:tage_job",
        _from("bio", compat=True),
    ),
    "b9_last_benefit": Query(_step(biography.add_benefits), ROW + " ende_vor", _from("bio")),
    "b10_benefit_count": Query(_step(biography.add_benefits), ROW + " i:anz_lst", _from("bio")),
    "b11_benefit_days": Query(_step(biography.add_benefits), ROW + " i:tage_lst", _from("bio")),
    # enrichment
    "j1_occ_2digit": Query(
        _enrich(lambda df, t: enrich.add_occupation(df, t.occupation)),
        ROW + " i:beruf_gr i:occ_kldb92_2",
        _from("enr"),
    ),
    "j2_occ_blossfeld": Query(
        _enrich(lambda df, t: enrich.add_blossfeld(df, t.blossfeld)),
        ROW + " i:beruf_gr i:occ_blo",
        _from("enr"),
    ),
    "j3_ambiguous_2digit": Query(
        lambda s, d: enrich.crosswalk_loss(
            episodes(s, d), default_lookups(s).occupation, "kldb92_2", "n_kldb92_2"
        ),
        "i:beruf_gr i:n_episodes matched",
        _from("ep", _ambiguous("occupation", "kldb92_2"), lookups=["occupation"]),
    ),
    "j3_ambiguous_blossfeld": Query(
        lambda s, d: enrich.crosswalk_loss(
            episodes(s, d), default_lookups(s).blossfeld, "occ_blo", "n_occ_blo"
        ),
        "i:beruf_gr i:n_episodes matched",
        _from("ep", _ambiguous("blossfeld", "occ_blo"), lookups=["blossfeld"]),
    ),
    "j4_all_targets": Query(
        lambda s, d: enrich.add_crosswalk(episodes(s, d), default_lookups(s).occupation),
        "i:persnr i:spell i:beruf_gr i:kldb92_2 i:n_kldb92_2",
        _from("ep", "SELECT ep.*, kldb92_2, n_kldb92_2 FROM ep LEFT JOIN occupation"
                    " ON ep.beruf_gr = occupation.beruf_gr", lookups=["occupation"]),
    ),
    "j5_education": Query(
        _enrich(lambda df, t: enrich.add_education(df)), ROW + " i:ausbildung i:educ", _from("enr")
    ),
    "j6_education_report": Query(
        _enrich(lambda df, t: enrich.education_report(enrich.add_education(df))),
        "i:educ i:ausbildung i:n",
        _from("enr", "SELECT educ, ausbildung, count(*) AS n FROM enr GROUP BY ALL"),
    ),
    "j7_region": Query(
        _enrich(lambda df, t: enrich.add_region(df)),
        ROW + " i:ao_region i:ao_bula i:east",
        _from("enr"),
    ),
    "j8_ceiling": Query(
        _enrich(lambda df, t: enrich.add_ceiling(enrich.add_region(df), t.ceiling)),
        ROW + " r6:limit_assess",
        _from("enr"),
    ),
    "j9_marginal": Query(
        _enrich(lambda df, t: enrich.add_marginal(enrich.add_region(df), t.marginal)),
        ROW + " r6:limit_marginal i:marginal",
        _from("enr"),
    ),
    "j10_deflate": Query(
        _enriched,
        ROW + " r6:cpi r6:wage_defl r6:limit_marginal_defl r6:limit_assess_defl",
        _from("enr"),
    ),
    # censoring
    "c1_censor": Query(
        _flagged(lambda df: df), ROW + " r6:limit_assess4 r6:ln_limit_assess4 i:cens", _from("cen")
    ),
    "c2_censored": Query(
        _flagged(censor.censoring_report),
        "i:cens i:n r6:share",
        _from("cen", "SELECT cens, n, n / sum(n) OVER () AS share FROM (SELECT cens, count(*) AS n"
                     f" FROM cen WHERE {REPORTED} GROUP BY cens)"),
    ),
    "c3_censored_by_education": Query(
        _flagged(censor.censoring_by_education),
        "education i:cens0 i:cens1 r6:share_censored",
        _from("cen", "SELECT CASE educ WHEN 1 THEN 'Low' WHEN 2 THEN 'Medium' WHEN 3 THEN 'High'"
                     " ELSE 'Missing' END AS education, count(*) FILTER (cens = 0) AS cens0,"
                     " count(*) FILTER (cens = 1) AS cens1, avg(cens) AS share_censored"
                     f" FROM cen WHERE {REPORTED} GROUP BY educ"),
    ),
    "c4_censored_by_age": Query(
        _flagged(censor.censoring_by_age),
        "age_category r6:share_censored",
        _from("cen", "SELECT CASE WHEN age < 25 THEN '18 to 25' ELSE least(age // 5, 11) * 5 || ' to ' ||"
                     " least(age // 5, 11) * 5 + 5 END AS age_category, avg(cens) AS share_censored"
                     f" FROM cen WHERE {REPORTED} AND educ = 3 AND age BETWEEN 18 AND 60 GROUP BY ALL"),
    ),
    "c5_censored_by_hours": Query(
        _flagged(censor.censoring_by_hours),
        "hours r6:share_censored",
        _from("cen", "SELECT CASE teilzeit WHEN 0 THEN 'Fulltime' WHEN 1 THEN 'Parttime'"
                     " ELSE 'Missing FT-Info' END AS hours, avg(cens) AS share_censored"
                     f" FROM cen WHERE {REPORTED} GROUP BY ALL"),
    ),
    "c6_censored_by_gender": Query(
        _flagged(censor.censoring_by_gender),
        "gender r6:share_censored",
        _from("cen", "SELECT CASE frau WHEN 0 THEN 'Men' ELSE 'Women' END AS gender,"
                     f" avg(cens) AS share_censored FROM cen WHERE {REPORTED} GROUP BY ALL"),
    ),
    "c7_topcode": Query(
        _wages, ROW + " r6:wage r6:ln_wage r6:ln_wage_cens", _from("cen")
    ),
    "c8_controls": Query(
        _with_jobs,
        ROW + " r6:age_sq i:old i:age_old r6:age_sq_old r6:tenure_sq i:educ_tmp",
        _from("cen"),
    ),
    "c9_plan": Query(
        lambda s, d: censor.imputation_plan(
            enrich.add_region(enrich.add_education(_split(s, d).merged())).withColumn(
                "educ_tmp", F.coalesce("educ", F.lit(1))
            )
        ),
        "i:year i:educ_tmp i:east",
        _from("cen", "SELECT DISTINCT year, educ_tmp, east FROM cen WHERE east IS NOT NULL"),
    ),
    "c10_moments": Query(
        lambda s, d: tobit.design_moments(
            tobit.design_points(_with_jobs(s, d).where(tobit.in_sample()))
        ),
        "i:year i:educ_tmp i:east i:n_free i:n_cens i:xx_0_1 i:xx_0_6 i:xx_1_6 r6:xx_0_3 r6:xy_0 r6:yy",
        _from("cen", f"""
  SELECT year, educ_tmp, east, count(*) FILTER (cens = 0) AS n_free, count(*) FILTER (cens = 1) AS n_cens,
         coalesce(sum(frau) FILTER (cens = 0), 0) AS xx_0_1,
         coalesce(sum(tage_job) FILTER (cens = 0), 0) AS xx_0_6,
         coalesce(sum(frau * tage_job) FILTER (cens = 0), 0) AS xx_1_6,
         coalesce(sum(age_sq) FILTER (cens = 0), 0) AS xx_0_3,
         coalesce(sum(ln_wage) FILTER (cens = 0), 0) AS xy_0,
         coalesce(sum(ln_wage * ln_wage) FILTER (cens = 0), 0) AS yy
  FROM cen WHERE {SAMPLE} GROUP BY year, educ_tmp, east"""),
    ),
    "c10_fit": Query(
        lambda s, d: _fits(s, d)[1],
        "i:year i:educ_tmp i:east i:n_free i:n_cens status i:rank r6:sigma",
    ),
    "c11_draw": Query(_drawn, ROW + " i:cens r6:ln_wage r6:ln_wage_imp"),
    # at the fitted point the plain likelihood of the rows has no slope
    "c10_slopes": Query(
        _c10_slopes,
        "i:year i:educ_tmp i:east i:n_free i:n_cens status r4:slope",
        _from("cen", f"""
  SELECT year, educ_tmp, east, count(*) FILTER (cens = 0) AS n_free, count(*) FILTER (cens = 1) AS n_cens,
         CASE WHEN count(*) FILTER (cens = 0) > {len(tobit.REGRESSORS) + 1} THEN 'ok' END AS status, 0 AS slope
  FROM cen WHERE {SAMPLE} GROUP BY year, educ_tmp, east"""),
    ),
    # a draw's place in the tail of its fit is the uniform number of its row
    "c11_places": Query(
        _c11_places,
        ROW + " i:year r6:place",
        _from("cen", f"""
  SELECT * EXCLUDE (u), CASE WHEN n_free > {len(tobit.REGRESSORS) + 1} THEN u END AS place
  FROM (SELECT *, count(*) FILTER (cens = 0) OVER (PARTITION BY year, educ_tmp, east) AS n_free,
               (CAST('0x' || substr(md5(persnr || '|' || spell || '|' || begepi || '|0'), 1, 13) AS BIGINT)
                + CAST(0.5 AS DOUBLE)) / 4503599627370496 AS u
        FROM cen WHERE {SAMPLE})
  WHERE cens = 1"""),
    ),
    "c12_draws_below": Query(
        lambda s, d: tobit.draws_below(_drawn(s, d)),
        "i:below",
        _from("cen", "SELECT count(*) FILTER (wage > limit_assess4) AS below FROM cen"),
    ),
    "c13_places": Query(
        _c13_places,
        "i:n i:observed i:outside",
        _from("cen", f"SELECT count(*) AS n, count(*) FILTER ({SAMPLE} AND cens = 0) AS observed,"
                     f" count(*) - count(*) FILTER ({SAMPLE}) AS outside FROM cen"),
    ),
    "c14_cap": Query(
        lambda s, d: censor.cap_wage(
            _wages(s, d).withColumn("ln_wage_imp", F.col("ln_wage")), q=0.9, factor=0.8
        ),
        ROW + " r6:ln_wage_imp r6:wage_imp",
        _from("cen", """
  SELECT * EXCLUDE (ln_wage_imp, wage_imp), CASE WHEN w > bound THEN ln(bound) ELSE l END AS ln_wage_imp,
         CASE WHEN w > bound THEN bound ELSE w END AS wage_imp
  FROM (SELECT cen.*, ln_wage AS l, exp(ln_wage) AS w, NULL AS ln_wage_imp, NULL AS wage_imp,
               0.8 * quantile_cont(exp(ln_wage), 0.9) OVER () AS bound FROM cen)"""),
    ),
    "c14_compat": Query(
        lambda s, d: censor.cap_wage(
            _wages(s, d).withColumn("ln_wage_imp", F.col("ln_wage")), q=0.9, factor=0.9, compat=True
        ),
        ROW + " r6:ln_wage_imp r6:wage_imp",
        _from("cen", """
  SELECT persnr, spell, begepi, endepi, exp(ln_wage) AS wage_imp,
         CASE WHEN ln_wage > bound THEN bound ELSE ln_wage END AS ln_wage_imp
  FROM (SELECT cen.*, 0.9 * quantile_cont(ln_wage, 0.9) OVER () AS bound FROM cen)"""),
    ),
    "c15_cleanup": Query(
        lambda s, d: _count_columns(censor.drop_helpers(_with_jobs(s, d)), [*censor.HELPERS, "educ_tmp"]),
        ROW + " i:cens r6:wage r6:ln_wage i:left_over",
        _from("cen", "SELECT *, 0 AS left_over FROM cen"),
    ),
    # panel
    "p1_parallel": Query(
        lambda s, d: panel.add_parallel_totals(_parallel_input(s, d)).merged(),
        ROW + " i:parallel_jobs r6:parallel_wage r6:parallel_wage_imp i:parallel_benefits",
        _from("par"),
    ),
    "p2_main_by_wage": Query(
        lambda s, d: _main()(s, d).merged(),
        "i:persnr i:spell begepi endepi i:quelle_gr i:tage_bet r6:wage_imp",
        _from("main"),
    ),
    "p2_main_by_tenure": Query(
        lambda s, d: _main("tenure")(s, d).merged(),
        "i:persnr i:spell begepi endepi i:quelle_gr i:tage_bet r6:wage_imp",
        _from("main", handling="tenure"),
    ),
    "p3_nspell": Query(
        lambda s, d: _main()(s, d).merged(), "i:persnr i:spell begepi i:nspell", _from("main")
    ),
    "p4_handled": Query(
        lambda s, d: _count_columns(_handled(s, d).merged(), ["spell", "level1", "level2"]),
        MAIN + " i:parallel_jobs i:parallel_benefits i:left_over",
        _from("main", "SELECT *, 0 AS left_over FROM main"),
    ),
    "p5_durations": Query(
        lambda s, d: panel.add_durations(_handled(s, d).merged()),
        MAIN + " i:dur_emp i:dur_benefits",
        _from("tot"),
    ),
    "p6_year_totals": Query(
        lambda s, d: panel.add_year_totals(_handled(s, d)).merged(),
        MAIN + " i:year_days_emp i:year_days_benefits r2:year_labor_earn",
        _from("tot"),
    ),
    "p7_alive": Query(
        lambda s, d: panel.alive_on(_handled(s, d).merged()), MAIN, _from("alive")
    ),
    "p8_cut": Query(
        lambda s, d: panel.build_yearly_panel(_handled(s, d)).merged(),
        MAIN + " i:tage_bet i:tage_job i:tage_erw",
        _from("cut"),
    ),
    "p9_benefit_cut": Query(
        lambda s, d: panel.build_yearly_panel(_handled(s, d)).merged(),
        MAIN + " i:tage_lst",
        _from("cut"),
    ),
    # the whole job; columns that do not depend on a draw have an exact oracle. Which of several
    # parallel jobs is the main one does, so job columns are compared where there is one job.
    "f1_panel": Query(_panel_of_single_jobs, SINGLE, SINGLE_SQL),
    "s3_refresh": Query(_s3_refresh, SINGLE, SINGLE_SQL),
    "f1_numbers": Query(
        _f1_numbers,
        "i:episodes i:dropped i:rows i:counters_missing i:cells i:censored i:draws_below i:outside i:panel_rows",
        _from("cut", f"""
  SELECT (SELECT count(*) FROM ep) AS episodes,
         (SELECT count(*) FROM ep WHERE coalesce(endepi < begepi, TRUE)) AS dropped,
         (SELECT count(*) FROM lev) AS rows, (SELECT count(*) - count(level1 + level2) FROM lev) AS counters_missing,
         (SELECT count(*) FROM (SELECT DISTINCT year, educ_tmp, east FROM cen WHERE {SAMPLE})) AS cells,
         (SELECT count(*) FROM cen WHERE {SAMPLE} AND cens = 1) AS censored, 0 AS draws_below,
         (SELECT count(*) FROM cen WHERE quelle_gr = 1 AND NOT coalesce({SAMPLE}, FALSE)) AS outside,
         (SELECT count(*) FROM cut) AS panel_rows"""),
    ),
    "f1_reports": Query(
        _f1_reports,
        f"i:set {' '.join(a if a == 'age_category' else f'i:{a}' for a in AXES)} i:n i:episodes i:cens0 i:cens1",
        _from("cen", f"""
  SELECT grouping_id({', '.join(AXES)}) AS set, {', '.join(AXES)}, count(*) AS n, count(*) FILTER (first) AS episodes,
         count(*) FILTER (quelle_gr = 1 AND cens = 0) AS cens0, count(*) FILTER (quelle_gr = 1 AND cens = 1) AS cens1
  FROM (SELECT *, year(endepi_orig) - year(begepi_orig) + 1 AS span_year, year = year(begepi_orig) AS first,
               CASE WHEN age BETWEEN 18 AND 24 THEN '18 to 25' WHEN age BETWEEN 25 AND 60
                    THEN least(age // 5, 11) * 5 || ' to ' || least(age // 5, 11) * 5 + 5 END AS age_category FROM cen)
  GROUP BY GROUPING SETS ({', '.join(f"({', '.join(axes)})" for axes in SETS)})"""),
    ),
    "f1_panel_full": Query(
        _panel,
        MAIN + " i:year_days_emp r6:wage r6:wage_imp r6:parallel_wage_imp r2:year_labor_earn",
    ),
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["f1_panel"].run(spark, sf_dir)
