"""P1-P9 on hand tables."""

import pytest
from pyspark.sql import functions as F

from careerpanel.operators import panel
from tests.helpers import date, episodes, values


@pytest.fixture(scope="module")
def parallel(spark):
    """(spell, source, wage, imputed wage, firm days), all with one start."""
    rows = [(1, 1, 50.0, 60.0, 5), (2, 1, 80.0, 80.0, 3), (3, 1, 80.0, 80.0, 9),
            (4, 2, None, None, None), (5, 1, None, None, 99)]
    df = episodes(
        spark,
        [{"persnr": 1, "spell": s, "quelle_gr": q, "tentgelt_gr": w, "begepi": "2000-01-01",
          "endepi": "2000-07-01"} for s, q, w, _, _ in rows],
    )
    extra = spark.createDataFrame(
        [(s, i, t) for s, _, _, i, t in rows], "spell long, wage_imp double, tage_bet long"
    )
    return df.join(extra, "spell").withColumn("year", F.year("begepi"))


def test_totals(parallel):
    out = panel.add_parallel_totals(parallel)
    names = ["parallel_jobs", "parallel_wage", "parallel_wage_imp", "parallel_benefits"]
    assert set(values(out, *names)) == {(4, 210.0, 220.0, 1)}


@pytest.mark.parametrize("handling, spell", [("wage", 3), ("tenure", 5)])
def test_main_episode(parallel, handling, spell):
    assert values(panel.main_episode(parallel, handling=handling), "spell") == [spell]


def test_ties_go_to_the_first_spell(parallel):
    tied = parallel.where("spell in (2, 3)").withColumn("tage_bet", F.lit(1))
    assert values(panel.main_episode(tied), "spell") == [2]


def test_unknown_handling(parallel):
    with pytest.raises(ValueError, match="handling"):
        panel.handle_parallel_episodes(parallel, "income")


def _alive(spark, month, day, *bounds):
    df = episodes(
        spark,
        [{"persnr": 1, "spell": i, "begepi": b, "endepi": e} for i, (b, e) in enumerate(bounds)],
    ).withColumn("year", F.year("begepi"))
    return values(panel.alive_on(df, month, day), "spell")


def test_alive_edges(spark):
    bounds = [("2000-06-30", "2000-12-31"), ("2000-01-01", "2000-06-30"),
              ("2000-07-01", "2000-12-31"), ("2000-01-01", "2000-06-29")]
    assert _alive(spark, 6, 30, *bounds) == [0, 1]
    assert _alive(spark, 7, 1, *bounds) == [0, 2]


@pytest.mark.parametrize("month, day", [(2, 30), (2, 29), (13, 1)])
def test_cutoff_must_exist_in_every_year(parallel, month, day):
    with pytest.raises(ValueError):
        panel.alive_on(parallel, month, day)


def test_year_totals_and_cut(spark):
    rows = [
        {"persnr": 1, "spell": 1, "begepi": "2000-01-01", "endepi": "2000-01-10"},
        {"persnr": 1, "spell": 2, "begepi": "2000-06-01", "endepi": "2000-07-10"},
        {"persnr": 2, "spell": 1, "begepi": "2000-06-01", "endepi": "2000-07-10", "quelle_gr": 2,
         "erwstat_gr": None},
    ]
    df = episodes(spark, rows).withColumns(
        {
            "year": F.year("begepi"),
            "parallel_wage_imp": F.lit(2.0),
            "parallel_benefits": F.lit(0),
            **{c: F.lit(100).cast("long") for c in ("tage_bet", "tage_job", "tage_erw", "tage_lst")},
        }
    )
    out = panel.add_year_totals(df)
    names = ["year_days_emp", "year_days_benefits", "year_labor_earn"]
    assert values(out, *names) == [(50, 0, 100.0), (50, 0, 100.0), (0, 40, 0.0)]
    cut = panel.build_yearly_panel(df)
    assert values(cut, "tage_bet", "tage_job", "tage_erw", "tage_lst") == [
        (90, 90, 90, None), (None, None, None, 90)
    ]


def test_wrong_arguments_fail_first():
    from careerpanel.plans.pipeline import prepare_panel

    for wrong in ({"handling": "no such rule"}, {"cutoff": (2, 30)}):
        with pytest.raises(ValueError):
            prepare_panel(None, **wrong)
