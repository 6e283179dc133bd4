"""Heavy persons: the spread rules give what the whole-person rules give."""

import pytest
from pyspark.sql import functions as F

from careerpanel.functions.frames import SLICE
from careerpanel.functions.people import by_person, heavy_persons, person_sizes
from careerpanel.operators import biography, panel, split
from careerpanel.plans.adapter import episode_people
from careerpanel.plans.pipeline import prepare_panel, prepare_people
from careerpanel.sources.lookups import default_lookups
from tests.helpers import episodes as hand
from tests.helpers import rows_of


@pytest.fixture(scope="module")
def base(people):
    return people.ordinary


@pytest.fixture(scope="module")
def crowded(spark, base):
    """One person with a third of all rows, many of them parallel, some bounds equal."""
    one = base.where(F.col("persnr") % 2 == 0).withColumns(
        {
            "spell": F.col("persnr") * 100 + F.col("spell"),
            "persnr": F.lit(1_000_000).cast("long"),
            "bnn": F.when(F.col("bnn").isNotNull(), F.col("bnn") % 2),
        }
    )
    return base.unionByName(one.select(*base.columns)).cache()


STEPS = {
    "counters": (split.add_counters, {}),
    "employment": (biography.add_employment, {}),
    "employment_compat": (biography.add_employment, {"compat": True}),
    "establishment": (biography.add_establishment, {}),
    "establishment_compat": (biography.add_establishment, {"compat": True}),
    "jobs": (biography.add_jobs, {}),
    "jobs_compat": (biography.add_jobs, {"compat": True}),
    "benefits": (biography.add_benefits, {}),
    "parallel": (panel.add_parallel_totals, {}),
}


@pytest.mark.parametrize("block", [3, 50])
@pytest.mark.parametrize("name", STEPS)
def test_spread_equals_whole(crowded, name, block):
    step, options = STEPS[name]
    data = biography.add_flags(crowded) if "jobs" in name else crowded
    if name == "parallel":  # whole amounts, so that the order of addition does not show
        data = data.withColumns({c: F.round("tentgelt_gr") for c in ("tentgelt_gr", "wage_imp")})
    whole = step(by_person(data, row_limit=10**9), **options).merged()
    people = by_person(data, row_limit=30, block=block)
    assert people.heavy is not None
    assert rows_of(step(people, **options).merged()) == rows_of(whole)


def test_panel_steps_spread_equals_whole(crowded):
    data = crowded.withColumns(
        {
            "wage_imp": F.round(F.col("tentgelt_gr")),
            "tentgelt_gr": F.round(F.col("tentgelt_gr")),
            "tage_bet": (F.col("spell") % 7).cast("long"),
            "level1": F.lit(0), "level2": F.lit(0),
        }
    )
    for handling in ("wage", "tenure"):
        parts = []
        for limit in (10**9, 30):
            people = panel.handle_parallel_episodes(by_person(data, row_limit=limit), handling)
            parts.append(rows_of(panel.add_year_totals(people).merged()))
        assert parts[0] == parts[1]


@pytest.mark.parametrize("name", ["counters", "jobs", "benefits"])
def test_sparse_spells_take_few_slices(crowded, name):
    """Spells far apart: slices are cut by rank, so a person has one for each block of rows and one more."""
    step, options = STEPS[name]
    data = biography.add_flags(crowded) if name == "jobs" else crowded
    data = data.withColumn("spell", F.col("spell") * 10**9)
    people = by_person(data, row_limit=30, block=50)
    sizes = people.heavy.groupBy("persnr", SLICE).count()
    most = sizes.groupBy("persnr").agg(F.count("*").alias("slices"), F.sum("count").alias("rows"), F.max("count").alias("most"))
    assert most.where("slices > rows / 50 + 2").isEmpty()
    per_spell = data.groupBy("persnr", "spell").count().agg(F.max("count")).first()[0]
    assert most.agg(F.max("most")).first()[0] <= 50 + per_spell
    order = people.heavy.groupBy("persnr", SLICE).agg(F.min("spell").alias("low"), F.max("spell").alias("high"))
    pairs = order.alias("a").join(order.alias("b"), F.expr(f"a.persnr = b.persnr AND a.{SLICE} < b.{SLICE} AND a.high >= b.low"))
    assert pairs.isEmpty()
    whole = step(by_person(data, row_limit=10**9), **options).merged()
    assert rows_of(step(people, **options).merged()) == rows_of(whole)


def test_persons_are_heavy_by_their_split_rows(spark):
    """Two episodes of 40 years are 80 rows."""
    rows = [{"persnr": 1, "spell": s, "begepi": "1960-01-01", "endepi": "1999-12-31", "ao_region": 1001} for s in (1, 2)]
    rows += [{"persnr": 2, "spell": s, "begepi": f"1990-{s:02d}-01", "endepi": f"1990-{s:02d}-20", "ao_region": 1001} for s in range(1, 11)]
    rows += [{"persnr": 3, "spell": 1, "begepi": "1990-05-01", "endepi": "1980-01-01"}, {"persnr": 3, "spell": 2}]
    df = hand(spark, rows)
    people = prepare_people(df, default_lookups(spark), row_limit=50, block=20)
    assert [r.persnr for r in people.heavy.select("persnr").distinct().collect()] == [1]
    assert people.heavy.count() == 80 and people.ordinary.count() == 10
    assert rows_of(people.merged()) == rows_of(prepare_people(df, default_lookups(spark)).merged())
    assert person_sizes(df, 50, rows=split.years_touched())[1] == 90


def test_heavy_adapter_equals_ordinary(spark, sf_dir):
    ordinary = episode_people(spark, sf_dir)
    heavy = episode_people(spark, sf_dir, row_limit=12, block=40)
    assert ordinary.heavy is None and heavy.heavy is not None
    assert rows_of(heavy.merged()) == rows_of(ordinary.merged())


def test_heavy_persons_are_found(crowded):
    assert [r.persnr for r in heavy_persons(crowded, 200).collect()] == [1_000_000]
    assert heavy_persons(crowded, 10**9) is None


def test_any_number_of_persons_may_be_heavy(crowded):
    people = by_person(crowded, row_limit=0)
    assert people.ordinary.count() == 0
    assert people.heavy.count() == crowded.where("persnr is not null").count()
    assert "LeftAnti" in people.ordinary._jdf.queryExecution().optimizedPlan().toString()


def test_whole_job_with_heavy_persons(spark, sf_dir):
    episodes = episode_people(spark, sf_dir).merged().where(F.col("persnr") % 3 == 0)
    columns = ["persnr", "nspell", "year", "begepi", "tage_erw", "tage_job", "tage_lst",
               "year_days_emp", "parallel_jobs"]
    whole = prepare_panel(episodes).select(*columns)
    spread = prepare_panel(episodes, row_limit=12, block=5).select(*columns)
    assert rows_of(spread) == rows_of(whole)
