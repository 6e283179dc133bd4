"""The same queries in SQL, stated from the rules and not from the Spark code.

One chain of common table expressions per flavour (documented rules, or ``compat``) ends in the
relations that the catalog names: ``ep`` episodes, ``sp`` split, ``bio`` biographies, ``enr``
enriched, ``cen`` with wage variables and controls, ``par`` parallel totals, ``main`` main
episodes, ``tot`` with yearly totals, ``alive`` on the cutoff, ``cut`` with durations cut.
"""

from __future__ import annotations

from careerpanel.sources.lookups import LOOKUP_ROWS, values_sql

EPISODES = """
o AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS st, o_totalprice AS price,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS b
  FROM orders),
months AS (
  SELECT c, b, lead(b) OVER (PARTITION BY c ORDER BY b) AS nb
  FROM (SELECT DISTINCT c, b FROM o)),
num AS (
  SELECT o.*, nb, row_number() OVER (PARTITION BY o.c ORDER BY o.b, k) AS spell,
         CAST((o.c * 31 + year(o.b) * 12 + month(o.b)) % 20 AS INTEGER) AS q
  FROM o JOIN months ON o.c = months.c AND o.b = months.b),
ep AS (
  SELECT c AS persnr, spell, b AS begorig, b AS begepi,
         least(b + (29 + 2 * q * q), nb - 1) AS endepi,
         CASE WHEN st <> 'P' THEN 1 WHEN k % 2 = 0 THEN 2 ELSE 16 END AS quelle_gr,
         CASE WHEN st = 'P' THEN NULL WHEN k % 8 = 0 THEN 2 ELSE 1 END AS erwstat_gr,
         CASE WHEN st = 'P' OR k % 29 = 0 THEN NULL ELSE 1 + k % 3 END AS bnn,
         CASE WHEN st = 'P' THEN NULL ELSE k % 6 END AS grund_gr,
         CASE WHEN st = 'P' OR k % 31 = 0 THEN NULL ELSE price / 3000 END AS tentgelt_gr,
         CASE WHEN k % 17 = 0 THEN NULL ELSE 1 + k % 125 END AS beruf_gr,
         CASE WHEN k % 13 IN (7, 8) THEN NULL ELSE k % 13 END AS ausbildung,
         CASE WHEN k % 23 = 0 THEN NULL ELSE (1 + k % 17) * 1000 + 1 END AS ao_region,
         1945 + c % 35 AS gebjahr, c % 2 AS frau,
         CASE WHEN k % 11 = 0 THEN NULL WHEN k % 3 = 0 THEN 1 ELSE 0 END AS teilzeit
  FROM num)"""

SPLIT = """
sp AS (
  SELECT * EXCLUDE (begepi, endepi), begepi AS begepi_orig, endepi AS endepi_orig,
         greatest(begepi, make_date(year, 1, 1)) AS begepi,
         least(endepi, make_date(year, 12, 31)) AS endepi, year - gebjahr AS age
  FROM (SELECT *, unnest(generate_series(year(begepi), year(endepi))) AS year FROM ep)),
lev AS (
  SELECT *, endepi - begepi + 1 AS len,
         row_number() OVER (PARTITION BY persnr, begepi, quelle_gr ORDER BY spell, endepi) - 1 AS level1,
         row_number() OVER (PARTITION BY persnr, begepi ORDER BY quelle_gr, spell, endepi) - 1 AS level2
  FROM sp)"""


def _biography(compat: bool) -> str:
    known = "" if compat else "CASE WHEN bnn IS NOT NULL THEN "
    end = "" if compat else " END"
    fresh_job = (
        "gap > 92"
        if compat
        else "gap > 366 OR (gap > 92 AND coalesce(reason IN (0, 3, 5), FALSE))"
    )
    single = "size = 1 OR" if compat else ""
    total = "sum(d)" if compat else "sum(coalesce(d, 0))"
    entry = (
        "min(begorig) OVER (PARTITION BY persnr, emp)"
        if compat
        else "min(CASE WHEN emp = 1 THEN begorig END) OVER (PARTITION BY persnr)"
    )
    return f"""
flag AS (
  SELECT *, CASE WHEN quelle_gr = 1 AND azubi = 0 THEN 1
                 WHEN NOT (quelle_gr = 1 AND azubi = 0) THEN 0 END AS emp
  FROM (SELECT *, CASE WHEN erwstat_gr = 2 THEN 1 WHEN erwstat_gr <> 2 THEN 0 END AS azubi FROM lev)),
emp1 AS (
  SELECT *, CASE WHEN emp = 1 THEN row_number() OVER
         (PARTITION BY persnr, emp, begepi ORDER BY spell, endepi) END AS nre
  FROM flag),
emp2 AS (
  SELECT *, {entry} AS ein_erw,
         {total} OVER (PARTITION BY persnr ORDER BY begepi, nre NULLS LAST, spell
                       ROWS UNBOUNDED PRECEDING) AS tage_erw
  FROM (SELECT *, CASE WHEN nre = 1 THEN len END AS d FROM emp1)),
firm AS (
  SELECT *, {known}min(begepi) OVER (PARTITION BY persnr, bnn){end} AS ein_bet,
         CASE WHEN bnn IS NOT NULL THEN
           sum(CASE WHEN nrb = 1 THEN len ELSE 0 END) OVER
           (PARTITION BY persnr, bnn ORDER BY spell, begepi ROWS UNBOUNDED PRECEDING) END AS tage_bet
  FROM (SELECT *, row_number() OVER
               (PARTITION BY persnr, bnn, begepi, endepi ORDER BY spell) AS nrb FROM emp2)),
job1 AS (
  SELECT *, row_number() OVER w AS nrw, begepi - lag(endepi) OVER w - 1 AS gap,
         lag(lead_reason) OVER w AS reason
  FROM (SELECT *, first_value(grund_gr) OVER
               (PARTITION BY persnr, azubi, bnn, begepi ORDER BY spell) AS lead_reason,
               row_number() OVER
               (PARTITION BY persnr, azubi, bnn, begepi ORDER BY spell) AS nra
        FROM firm)
  WINDOW w AS (PARTITION BY persnr, azubi, bnn ORDER BY begepi, spell)),
job2 AS (
  SELECT *, sum(CASE WHEN nrw = 1 OR {fresh_job} THEN 1 ELSE 0 END) OVER
         (PARTITION BY persnr, azubi, bnn ORDER BY begepi, spell ROWS UNBOUNDED PRECEDING) AS job
  FROM job1),
job3 AS (
  SELECT * REPLACE (CASE WHEN {single} bnn IS NULL OR azubi IS NULL THEN NULL ELSE ein_job END AS ein_job,
                    CASE WHEN {single} bnn IS NULL OR azubi IS NULL THEN NULL ELSE tage_job END AS tage_job)
  FROM (SELECT *, min(begepi) OVER (PARTITION BY persnr, azubi, bnn, job) AS ein_job,
               count(*) OVER (PARTITION BY persnr, azubi, bnn, job) AS size,
               sum(CASE WHEN nra = 1 THEN len ELSE 0 END) OVER
               (PARTITION BY persnr, azubi, bnn, job ORDER BY begepi, spell
                ROWS UNBOUNDED PRECEDING) AS tage_job
        FROM job2)),
ben1 AS (
  SELECT *, last_value(CASE WHEN quelle_gr IN (2, 16) THEN endepi END IGNORE NULLS) OVER
         (PARTITION BY persnr ORDER BY spell, begepi
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ende_vor,
         quelle_gr IN (2, 16) AND row_number() OVER
         (PARTITION BY persnr, begepi, quelle_gr IN (2, 16) ORDER BY spell, endepi) = 1 AS lead_ben
  FROM job3),
bio AS (
  SELECT *, sum(CASE WHEN lead_ben AND coalesce(begepi - ende_vor > 10, TRUE) THEN 1 ELSE 0 END) OVER w
           AS anz_lst,
         sum(CASE WHEN lead_ben THEN len ELSE 0 END) OVER w AS tage_lst
  FROM ben1
  WINDOW w AS (PARTITION BY persnr ORDER BY spell, begepi ROWS UNBOUNDED PRECEDING))"""


ENRICHED = """
enr AS (
  SELECT bio.*, occ.kldb92_2 AS occ_kldb92_2, blo.occ_blo AS occ_blo,
         CASE WHEN ausbildung IN (5, 6, 11, 12) THEN 3 WHEN ausbildung IN (2, 4) THEN 2
              WHEN ausbildung IN (1, 3) THEN 1 END AS educ,
         limit_assess, limit_marginal,
         CASE WHEN tentgelt_gr <= limit_marginal THEN 1 WHEN tentgelt_gr > limit_marginal THEN 0 END
           AS marginal,
         cpi, 100 * tentgelt_gr / cpi AS wage_defl, 100 * limit_marginal / cpi AS limit_marginal_defl,
         100 * limit_assess / cpi AS limit_assess_defl
  FROM (SELECT *, CASE WHEN ao_bula IN (11, 12, 13, 14, 15, 16) THEN 1 WHEN ao_bula < 11 THEN 0 END AS east
        FROM (SELECT *, CAST(floor(ao_region / 1000) AS BIGINT) AS ao_bula FROM bio)) AS bio
  LEFT JOIN (SELECT * FROM occupation WHERE n_kldb92_2 = 1) AS occ ON bio.beruf_gr = occ.beruf_gr
  LEFT JOIN (SELECT * FROM blossfeld WHERE n_occ_blo = 1) AS blo ON bio.beruf_gr = blo.beruf_gr
  LEFT JOIN ceiling ON bio.east = ceiling.east AND bio.year = ceiling.year
  LEFT JOIN marginal AS mar ON bio.east = mar.east AND bio.year = mar.year
  LEFT JOIN cpi ON bio.year = cpi.year),
cen AS (
  SELECT *, CASE WHEN wage <> 0 THEN ln(wage) END AS ln_wage,
         CASE WHEN wage <> 0 AND cens = 0 THEN ln(wage) END AS ln_wage_cens,
         (age / 10.0) ** 2 AS age_sq, CASE WHEN age > 40 THEN 1 ELSE 0 END AS old,
         CASE WHEN age > 40 THEN age ELSE 0 END AS age_old,
         CASE WHEN age > 40 THEN (age / 10.0) ** 2 ELSE 0 END AS age_sq_old,
         (tage_job / 10.0) ** 2 AS tenure_sq, coalesce(educ, 1) AS educ_tmp
  FROM (SELECT *, ln(limit_assess4) AS ln_limit_assess4,
               CASE WHEN quelle_gr = 1 THEN least(wage_defl, limit_assess4) +
                    0 * wage_defl + 0 * limit_assess4 END AS wage,
               CASE WHEN quelle_gr = 1 AND wage_defl <= limit_assess4 THEN 0
                    WHEN quelle_gr = 1 AND wage_defl > limit_assess4 THEN 1 END AS cens
        FROM (SELECT *, limit_assess_defl - 400 / cpi AS limit_assess4 FROM enr)))"""


def _panel(handling: str) -> str:
    order = {
        "wage": "wage_imp DESC NULLS LAST, tage_bet DESC NULLS LAST",
        "tenure": "tage_bet DESC NULLS LAST, wage_imp DESC NULLS LAST",
    }[handling]
    return f"""
par AS (
  SELECT *, count(CASE WHEN quelle_gr = 1 THEN 1 END) OVER w AS parallel_jobs,
         sum(CASE WHEN quelle_gr = 1 THEN coalesce(tentgelt_gr, 0) ELSE 0 END) OVER w AS parallel_wage,
         sum(CASE WHEN quelle_gr = 1 THEN coalesce(wage_imp, 0) ELSE 0 END) OVER w AS parallel_wage_imp,
         max(CASE WHEN quelle_gr = 2 THEN 1 ELSE 0 END) OVER w AS parallel_benefits
  FROM (SELECT *, wage AS wage_imp FROM cen)
  WINDOW w AS (PARTITION BY persnr, begepi)),
main AS (
  SELECT *, row_number() OVER (PARTITION BY persnr ORDER BY begepi) AS nspell
  FROM (SELECT * FROM par QUALIFY row_number() OVER
        (PARTITION BY persnr, begepi ORDER BY quelle_gr, {order}, spell, endepi) = 1)),
tot AS (
  SELECT *, sum(dur_emp) OVER w AS year_days_emp, sum(dur_benefits) OVER w AS year_days_benefits,
         sum(parallel_wage_imp * dur_emp) OVER w AS year_labor_earn
  FROM (SELECT *, CASE WHEN quelle_gr = 1 THEN len ELSE 0 END AS dur_emp,
               CASE WHEN quelle_gr = 2 OR parallel_benefits = 1 THEN len ELSE 0 END AS dur_benefits
        FROM main)
  WINDOW w AS (PARTITION BY persnr, year)),
alive AS (
  SELECT * FROM tot
  WHERE month(begepi) * 100 + day(begepi) <= 630 AND month(endepi) * 100 + day(endepi) >= 630),
cut AS (
  SELECT * REPLACE (CASE WHEN quelle_gr = 1 THEN tage_bet - late END AS tage_bet,
                    CASE WHEN quelle_gr = 1 THEN tage_job - late END AS tage_job,
                    CASE WHEN quelle_gr = 1 AND erwstat_gr <> 2 THEN tage_erw - late END AS tage_erw,
                    CASE WHEN quelle_gr = 2 OR parallel_benefits = 1 THEN tage_lst - late END AS tage_lst)
  FROM (SELECT *, endepi - make_date(year, 6, 30) AS late FROM alive))"""


def _lookup(name: str) -> str:
    return f"\n{name} AS ({values_sql(*LOOKUP_ROWS[name])})"


# a relation needs all parts up to the one that defines it
PARTS = ["ep", "lev", "bio", "cen", "cut"]
DEFINED = {
    "ep": "ep", "sp": "lev", "lev": "lev", "flag": "bio", "bio": "bio", "enr": "cen", "cen": "cen",
    "par": "cut", "main": "cut", "tot": "cut", "alive": "cut", "cut": "cut",
}


def with_clause(last: str, compat: bool = False, handling: str = "wage", lookups=()) -> str:
    """``WITH ...`` up to the part that defines relation ``last``, and the lookups asked for."""
    parts = PARTS[: PARTS.index(DEFINED[last]) + 1]
    text = [_lookup(name) for name in (LOOKUP_ROWS if "cen" in parts else lookups)]
    build = {
        "ep": lambda: EPISODES,
        "lev": lambda: SPLIT,
        "bio": lambda: _biography(compat),
        "cen": lambda: ENRICHED,
        "cut": lambda: _panel(handling),
    }
    return "WITH " + ",".join(text + [build[p]() for p in parts]) + "\n"
