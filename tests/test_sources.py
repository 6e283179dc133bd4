"""Loading, batching and writing; the shape of the plans."""

import pytest
from pyspark.sql import functions as F

from careerpanel.functions.people import by_person
from careerpanel.operators import panel
from careerpanel.plans import pipeline
from careerpanel.plans.adapter import episodes
from careerpanel.schema import EPISODES, PANEL, check_key, conform
from careerpanel.sources import ingest
from careerpanel.sources.lookups import default_lookups
from tests.helpers import rows_of


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("data") / "orig")
    ingest.append_batches(ingest.assign_batches(episodes(spark, sf_dir), 200), path)
    return path


def test_read_back(spark, sf_dir, stored):
    df = ingest.read_episodes(spark, stored)
    assert df.columns == [*EPISODES.fieldNames(), "pn_batch"]
    assert rows_of(df.drop("pn_batch")) == rows_of(episodes(spark, sf_dir))


def test_batches_never_split_a_person(spark, sf_dir):
    df = ingest.assign_batches(episodes(spark, sf_dir), 200)
    per_person = df.groupBy("persnr").agg(F.countDistinct("pn_batch").alias("n"))
    assert per_person.where("n > 1").count() == 0
    plan = ingest.batch_plan(episodes(spark, sf_dir), 200).orderBy("pn_batch").collect()
    assert plan[0]["min_row"] == 1 and plan[-1]["max_row"] == 1500
    assert all(a["max_row"] + 1 == b["min_row"] for a, b in zip(plan, plan[1:]))
    assert all(r["max_row"] // 200 + 1 == r["pn_batch"] for r in plan)


def test_batches_of_heavy_persons(spark, sf_dir):
    df = episodes(spark, sf_dir)
    heavy = ingest.assign_batches(df, 200, parts=12)
    assert rows_of(heavy) == rows_of(ingest.assign_batches(df, 200))


def test_append_adds(spark, sf_dir, tmp_path):
    path = str(tmp_path / "store")
    df = ingest.assign_batches(episodes(spark, sf_dir), 500)
    ingest.append_batches(df.where("pn_batch = 1"), path)
    ingest.append_batches(df.where("pn_batch <> 1"), path)
    assert spark.read.parquet(path).count() == 1500


def test_a_batch_is_one_file(spark, sf_dir, tmp_path):
    path = tmp_path / "few"
    df = ingest.assign_batches(episodes(spark, sf_dir), 100).repartition(20)
    ingest.append_batches(df, str(path))
    files = [len(list(batch.glob("*.parquet"))) for batch in path.glob("pn_batch=*")]
    assert len(files) > 3 and max(files) == 1


def test_rows_without_a_person_raise(spark, sf_dir):
    df = episodes(spark, sf_dir).withColumn("persnr", F.when(F.col("spell") > 1, F.col("persnr")))
    with pytest.raises(Exception, match="no persnr"):
        ingest.assign_batches(df, 100).count()


def test_nan_is_null(spark, sf_dir):
    df = conform(episodes(spark, sf_dir).withColumn("tentgelt_gr", F.lit(float("nan"))))
    assert df.where("tentgelt_gr is not null").count() == 0


def test_csv_source(spark, sf_dir, tmp_path):
    path = str(tmp_path / "csv")
    episodes(spark, sf_dir).write.csv(path, header=True)
    assert rows_of(ingest.read_episodes(spark, path, "csv")) == rows_of(episodes(spark, sf_dir))


def test_checks(spark, sf_dir, tmp_path):
    df = episodes(spark, sf_dir)
    with pytest.raises(ValueError, match="lacks bnn"):
        conform(df.drop("bnn"))
    with pytest.raises(ValueError, match="not a key"):
        check_key(df.withColumn("spell", F.lit(1)))
    path = str(tmp_path / "twice")
    df.unionByName(df.where("persnr = 1")).write.parquet(path)
    with pytest.raises(ValueError, match="not a key"):
        ingest.read_episodes(spark, path, check=True)
    with pytest.raises(Exception, match="not a key"):
        pipeline.prepare_panel(ingest.read_episodes(spark, path))


def test_panel_store(spark, sf_dir, tmp_path):
    path = str(tmp_path / "panel")
    df = pipeline.prepare_panel(episodes(spark, sf_dir)).cache()
    ingest.write_panel(df, path)
    again = spark.read.parquet(path)
    assert again.columns == PANEL
    assert again.count() == df.count()
    per_year = again.groupBy("persnr", "year").count()
    assert per_year.where("count > 1").count() == 0
    assert again.where("year_days_emp > 366 or year_days_benefits > 366").count() == 0
    assert again.where("cens = 1 and wage_imp < wage").count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_biographies_take_one_exchange(spark, stored):
    """All windows and lookups over stored episodes run behind one exchange by person."""
    people = pipeline.build_biographies(by_person(ingest.read_episodes(spark, stored)))
    rows = people.map(pipeline.enrich_episodes, default_lookups(spark))
    plan = _plan(rows.map(pipeline.prepare_wages).merged())
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SinglePartition" not in plan
    assert plan.count("BroadcastHashJoin") == 5
    assert plan.count("Sort [") == 6
    assert "SortMergeJoin" not in plan and "Python" not in plan


def test_panel_takes_one_exchange(spark, stored):
    rows = ingest.read_episodes(spark, stored).withColumns(
        {"year": F.year("begepi"), **{c: F.lit(1.0) for c in ("wage_imp", "tage_bet", "tage_job", "tage_erw", "tage_lst")}}
    )
    plan = _plan(pipeline.finish_panel(rows))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SinglePartition" not in plan
    # totals, main episode, counter and yearly totals share one sort
    assert plan.count("Sort [") == 1
    assert "WindowGroupLimit" in _plan(panel.main_episode(rows))


def test_scans_read_only_what_they_need(spark, stored):
    df = ingest.read_episodes(spark, stored, check=False)
    plan = _plan(panel.alive_on(df.withColumn("year", F.year("begepi"))).select("persnr"))
    schema = plan.split("ReadSchema: ")[1].split(">")[0]
    assert schema == "struct<persnr:bigint,begepi:date,endepi:date"
