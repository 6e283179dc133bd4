"""Range placement, batches that arrive exactly once, bucketed tables; F1 with one exchange, its
numbers and reports."""

import pytest
from pyspark.sql import functions as F

from careerpanel.operators import censor, enrich, reports, split
from careerpanel.plans import pipeline
from careerpanel.plans.adapter import episodes
from careerpanel.schema import PANEL
from careerpanel.sources import ingest, staging, store
from careerpanel.sources.lookups import default_lookups
from tests.helpers import episodes as hand
from tests.helpers import rows_of


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- S2


def _expected(df, size):
    counts = df.groupBy("persnr").count().orderBy("persnr").collect()
    out, so_far = {}, 0
    for row in counts:
        so_far += row["count"]
        out[row["persnr"]] = so_far // size + 1
    return out


@pytest.mark.parametrize("size", [7, 400, 10**6])
@pytest.mark.parametrize("parts", [1, 40])
def test_batches_by_range(spark, sf_dir, size, parts):
    """One person has a third of the rows, spread over many parts and batches."""
    df = episodes(spark, sf_dir)
    heavy = df.withColumns({"persnr": F.lit(70).cast("long"), "spell": F.col("persnr") * 1000 + F.col("spell")}).where("spell % 2 = 0")
    df = df.unionByName(heavy)
    want = _expected(df, size)
    got = ingest.assign_batches(df, size, parts)
    assert {(r.persnr, r.pn_batch) for r in got.select("persnr", "pn_batch").distinct().collect()} == set(want.items())
    assert rows_of(got.drop("pn_batch")) == rows_of(df)


def test_assignment_takes_no_join(spark, sf_dir, tmp_path):
    episodes(spark, sf_dir).write.parquet(str(tmp_path / "in"))
    plan = _plan(ingest.assign_batches(ingest.read_episodes(spark, str(tmp_path / "in"), check=False), 200))
    assert "Join" not in plan and "Exchange" not in plan and "Window" not in plan


def test_a_row_takes_one_look_up_of_its_batch(spark, sf_dir, tmp_path):
    """No row goes through the batches of its part, of which there may be thousands."""
    episodes(spark, sf_dir).write.parquet(str(tmp_path / "in"))
    df = ingest.read_episodes(spark, str(tmp_path / "in"))
    got = ingest.assign_batches(df, 3, 1)
    assert "lambda" not in _plan(got)
    assert {(r.persnr, r.pn_batch) for r in got.select("persnr", "pn_batch").distinct().collect()} == set(_expected(df, 3).items())


def test_no_rows_no_batches(spark):
    empty = hand(spark, [])
    assert ingest.assign_batches(empty, 10).count() == 0
    assert ingest.batch_plan(empty, 10).count() == 0


# --- S3


@pytest.fixture
def batched(spark, sf_dir):
    return ingest.assign_batches(episodes(spark, sf_dir), 300)


def test_an_append_that_is_repeated_changes_nothing(spark, batched, tmp_path):
    s = store.EpisodeStore(spark, str(tmp_path / "s"))
    first = s.append(batched.where("pn_batch <= 3"))
    assert sorted(r.pn_batch for r in first.collect()) == [1, 2, 3]
    assert s.append(batched.where("pn_batch <= 3")).isEmpty()
    assert [r.pn_batch for r in s.append(batched.where("pn_batch >= 3")).orderBy("pn_batch").collect()][0] == 4
    assert s.append(batched).isEmpty()
    assert rows_of(s.read().drop("load")) == rows_of(batched)
    assert s.ledger().count() == batched.select("pn_batch").distinct().count()


@pytest.mark.parametrize("step", ["_write", "_enter"])
def test_an_append_that_broke_off_is_made_good(spark, batched, tmp_path, monkeypatch, step):
    """The rows, or the rows but not the ledger, were partly written: nothing of it counts, and a retry mends it."""
    s = store.EpisodeStore(spark, str(tmp_path / "s"))
    s.append(batched.where("pn_batch = 1"))
    whole = getattr(store.EpisodeStore, step)

    def broken(self, df):
        if step == "_write":
            whole(self, df.where("persnr % 2 = 0"))
        raise OSError("the job was killed")

    with monkeypatch.context() as m:
        m.setattr(store.EpisodeStore, step, broken)
        with pytest.raises(OSError):
            s.append(batched.where("pn_batch <= 4"))
    assert rows_of(s.read().drop("load")) == rows_of(batched.where("pn_batch = 1"))
    s.append(batched.where("pn_batch <= 4"))
    assert rows_of(s.read().drop("load")) == rows_of(batched.where("pn_batch <= 4"))


def test_other_rows_under_the_name_of_a_batch_raise(spark, batched, tmp_path):
    s = store.EpisodeStore(spark, str(tmp_path / "s"))
    s.append(batched)
    before = rows_of(s.read())
    with pytest.raises(ValueError, match="hold other rows already"):
        s.append(batched.where("pn_batch = 2 and spell > 1"))
    with pytest.raises(Exception, match="no pn_batch"):
        s.append(batched.withColumn("pn_batch", F.lit(None).cast("long")))
    assert rows_of(s.read()) == before
    assert not s.append(batched.withColumn("persnr", F.col("persnr") + 10**6), load="2").isEmpty()
    assert s.read().count() == 2 * len(before)


def test_reads_prune_batches(spark, batched, tmp_path):
    s = store.EpisodeStore(spark, str(tmp_path / "s"))
    s.append(batched)
    plan = _plan(s.read().where("pn_batch = 2").select("persnr"))
    assert "PartitionFilters: [" in plan and "pn_batch" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_folders_by_leading_bits(spark):
    numbers = [1, 511, 512, 513, 1023, 1024, 1027, 1028, 54_321, 3 * 2**40 + 5, 0, -7]
    got = spark.createDataFrame([(n,) for n in numbers], "b bigint").select("b", store.folder_of(F.col("b")).alias("f")).collect()
    assert {r.b: r.f for r in got} == {n: n >> (s := max(0, n.bit_length() - 9) if n > 0 else 0) << s for n in numbers}
    assert spark.range(1, 100_000).select(store.folder_of(F.col("id"))).distinct().count() < 2600


def test_batches_that_share_a_folder_arrive_once(spark, sf_dir, tmp_path, monkeypatch):
    """Complete batches stay as they are when others of their folder are added, come again, or break off."""
    monkeypatch.setattr(store, "FOLDER_BITS", 1)
    batched = staging.stage(ingest.assign_batches(episodes(spark, sf_dir), 100))
    s = store.EpisodeStore(spark, str(tmp_path / "s"))
    s.append(batched.where("pn_batch in (1, 2, 9)"))
    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(store.EpisodeStore, "_enter", lambda *_: (_ for _ in ()).throw(OSError("the job was killed")))
        s.append(batched.where("pn_batch in (8, 10, 11)"))
    assert rows_of(s.read().drop("load")) == rows_of(batched.where("pn_batch in (1, 2, 9)"))
    for part in ("pn_batch in (9, 10, 11)", "pn_batch <= 12", "pn_batch > 0"):
        s.append(batched.where(part))
        assert rows_of(s.read().drop("load")) == rows_of(batched.where("pn_batch in (1, 2) or pn_batch in (9, 10, 11)" if "in" in part else part))
    assert rows_of(s.read([10, 3]).drop("load")) == rows_of(batched.where("pn_batch in (3, 10)"))


def test_folders_of_one_batch_are_read_as_before(spark, batched, tmp_path):
    """A store that was written when each batch had a folder."""
    batched.withColumn("load", F.lit("1")).write.partitionBy("pn_batch", "load").parquet(str(tmp_path / "s" / "rows"))
    counts = batched.groupBy("pn_batch").agg(F.count("*").alias("n"), F.lit(0).cast("decimal(38,0)").alias("print"))
    counts.select(F.lit("1").alias("load"), "*").write.parquet(str(tmp_path / "s" / "ledger"))
    assert rows_of(store.EpisodeStore(spark, str(tmp_path / "s")).read().drop("load")) == rows_of(batched)


# --- S5, F1


def test_bucketed_panel_needs_no_exchange(spark, sf_dir, tmp_path):
    path = str(tmp_path / "panel")
    numbers, found = pipeline.store_panel(episodes(spark, sf_dir), path)
    table = store.open_bucketed(spark, path)
    assert table.columns == PANEL and table.count() == numbers["panel_rows"]
    assert len(list((tmp_path / "panel").glob("part-*"))) <= 4  # a file for each bucket
    assert "Exchange hashpartitioning" not in _plan(table.groupBy("persnr").count())
    joined = table.hint("merge").join(store.open_bucketed(spark, path).select("persnr", F.col("year").alias("other")), "persnr")
    assert "Exchange" not in _plan(joined.select("persnr", "other"))
    assert "SelectedBucketsCount: 1 out of" in _plan(table.where("persnr = 7").groupBy("persnr").count())
    assert sum(r["n"] for r in found["span"]) == numbers["episodes"]


def test_the_job_takes_one_exchange(spark, sf_dir, tmp_path):
    """Of the whole job's rows; tables of a row per cell, part or report move as they like."""
    path = str(tmp_path / "in")
    episodes(spark, sf_dir).write.parquet(path)
    seen = []
    write = pipeline.stage_bucketed
    pipeline.stage_bucketed = lambda df, *a: seen.append(_plan(df)) or write(df, *a)
    try:
        run = pipeline.run_panel(ingest.read_episodes(spark, path, check=False))
    finally:
        pipeline.stage_bucketed = write
    assert len(seen) == 1 and seen[0].count("Exchange hashpartitioning") == 1
    plan = _plan(run.panel)
    assert "Exchange hashpartitioning" not in plan and "SinglePartition" not in plan and "Bucketed: true" in plan
    assert run.panel.count() > 0


def test_a_task_gets_few_rows_of_a_large_table(spark, sf_dir, monkeypatch):
    """A bucket is a task's work: its sorts and windows take memory by its rows."""
    monkeypatch.setattr(pipeline, "person_sizes", lambda *a, **o: (None, 6_000_000))
    monkeypatch.setattr(pipeline, "stage_bucketed", lambda df, key, order, buckets, name: df)
    _, buckets = pipeline.prepared_buckets(episodes(spark, sf_dir), default_lookups(spark))
    assert 6_000_000 / buckets <= 250_000


def test_numbers_of_a_run(spark, sf_dir):
    df = episodes(spark, sf_dir)
    turned = df.where("persnr = 1").withColumns({"begepi": F.lit("1999-05-01").cast("date"), "endepi": F.lit("1998-05-01").cast("date"), "spell": F.col("spell") + 1000})
    open_ = df.where("persnr = 2").withColumns({"endepi": F.lit(None).cast("date"), "spell": F.col("spell") + 1000})
    lost = turned.count() + open_.count()
    runs = []
    for limit in (10**6, 20):
        run = pipeline.run_panel(df.unionByName(turned).unionByName(open_), row_limit=limit, block=7)
        panel = run.panel.collect()
        numbers = run.numbers()
        assert numbers["episodes"] == 1500 + lost and numbers["dropped"] == lost
        assert numbers["rows"] == run.prepared.merged().count() > 1500
        assert numbers["counters_missing"] == numbers["draws_below"] == 0
        assert numbers["panel_rows"] == len(panel)
        assert numbers["cells_fitted"] <= numbers["cells"] == run.fits.count()
        runs.append((numbers, panel))
    assert runs[0][0] == runs[1][0] and 0 < runs[0][0]["draws"] <= runs[0][0]["censored"]


def test_reports_equal_their_operators(spark, sf_dir):
    lookups = default_lookups(spark)
    run = pipeline.run_panel(episodes(spark, sf_dir))
    rows, plain = run.prepared.merged(), episodes(spark, sf_dir)
    want = {
        "span": split.span_report(plain),
        "ambiguous_2digit": enrich.crosswalk_loss(plain, lookups.occupation, "kldb92_2", "n_kldb92_2"),
        "ambiguous_blossfeld": enrich.crosswalk_loss(plain, lookups.blossfeld, "occ_blo", "n_occ_blo"),
        "education": enrich.education_report(rows),
        "censored": censor.censoring_report(rows),
        "censored_by_education": censor.censoring_by_education(rows),
        "censored_by_age": censor.censoring_by_age(rows),
        "censored_by_hours": censor.censoring_by_hours(rows),
        "censored_by_gender": censor.censoring_by_gender(rows),
    }
    assert set(want) == set(run.reports)
    for name, report in want.items():
        assert run.reports[name].columns == report.columns
        assert rows_of(run.reports[name]) == rows_of(report), name


def test_reports_take_one_scan(spark, sf_dir):
    run = pipeline.run_panel(episodes(spark, sf_dir), reports=False)
    plan = _plan(reports.report_counts(run.prepared.merged()))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "Expand" in plan


def test_scratch_leaves_nothing(spark, sf_dir, tmp_path, monkeypatch):
    df, shared = episodes(spark, sf_dir), tmp_path / "shared"
    monkeypatch.setattr(staging, "shared_folder", lambda _: str(shared))
    pipeline.store_panel(df, str(tmp_path / "panel"))
    assert list(shared.iterdir()) == []
    with pytest.raises(ValueError, match="broken"), staging.scratch(spark):
        staging.stage(spark.range(3))
        staging.stage_bucketed(spark.range(3), "id", ["id"], 2)
        raise ValueError("broken")
    assert list(shared.iterdir()) == []


def test_scratch_keeps_what_it_is_told_to(spark, tmp_path, monkeypatch):
    shared = tmp_path / "shared"
    monkeypatch.setattr(staging, "shared_folder", lambda _: str(shared))
    with staging.scratch(spark):
        with staging.scratch(spark) as keep:
            kept = keep(staging.stage(spark.range(5)).where("id > 1"), "kept")
        assert [p.name.split("-")[1] for p in shared.iterdir()] == ["kept"] and kept.count() == 3
    assert list(shared.iterdir()) == []
    with staging.scratch(spark) as keep:
        kept = keep(spark.range(2))
    assert kept.count() == 2
