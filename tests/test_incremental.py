"""Deliveries that arrive one by one give the panel that the whole job gives on all of them."""

import pytest
from pyspark.sql import functions as F

from careerpanel.plans import pipeline
from careerpanel.plans.adapter import episodes
from careerpanel.plans.incremental import PanelStore
from careerpanel.schema import PANEL
from careerpanel.sources import store as stores
from tests.helpers import rows_of

SIZE = 120


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return episodes(spark, sf_dir).cache()


@pytest.fixture(scope="module")
def parts(rows):
    """Early episodes of most persons; later ones of a few of them and new persons; the last ones of one."""
    few = F.col("persnr").isin(7, 8, 10, 70)
    last = (F.col("persnr") == 70) & (F.col("spell") > 9)
    second = ~last & ((few & (F.col("spell") > 3)) | (F.col("persnr") > 130))
    return [rows.where(~second & ~last), rows.where(second), rows.where(last)]


def _equal(store, whole):
    """Sums are taken in another order, so wages are compared with a tolerance."""
    wages = [c for c in PANEL if c.startswith(("parallel_wage", "year_labor", "wage", "ln_wage"))]
    others = [c for c in PANEL if c not in wages]
    a, b = (df.orderBy("persnr", "year", "nspell").select(*others, *wages).collect() for df in (store.panel(), whole))
    assert [r[: len(others)] for r in a] == [r[: len(others)] for r in b]
    for x, y in zip(a, b, strict=True):
        for u, v in zip(x[len(others) :], y[len(others) :], strict=True):
            assert u == v or abs(u - v) <= 1e-6 * abs(v)
    return len(a) > 500


@pytest.fixture(scope="module")
def filled(spark, rows, parts, tmp_path_factory):
    store = PanelStore(spark, str(tmp_path_factory.mktemp("store") / "s"), SIZE)
    seen = []
    for load, part in enumerate(parts):
        added = store.deliver(part, str(load))
        pending = spark.createDataFrame(store.pending().toArrow(), "load string, pn_batch bigint")
        plan = store.touched_rows(pending)._jdf.queryExecution().executedPlan().toString()
        store.refresh(reports=False)
        files = {p: p.stat().st_mtime_ns for p in (tmp_path_factory.getbasetemp().glob("store*/s/panel/pn_batch=*/*.parquet"))}
        seen.append(({r.pn_batch for r in added.collect()}, plan, files))
    return store, seen


def test_deliveries_equal_the_whole_job(filled, rows):
    store, _ = filled
    fits, bound = store.wages()
    assert _equal(store, pipeline.prepare_panel(rows, fits=fits, bound=bound))


def test_only_touched_batches_are_read_and_written(filled, parts):
    _, seen = filled
    (first, _, _), (second, _, before), (third, plan, after) = seen
    assert len(first) > 8 and len(third) == 1 and third < first
    assert min(second - first) == max(first) + 1  # new persons come behind
    batch = third.pop()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "pn_batch#" in filters and f"= {batch})" in filters
    same = {p for p in before if after.get(p) == before[p]}
    assert {p.parent.name for p in set(after) - same} == {f"pn_batch={batch}"}


def test_persons_stay_in_one_batch(filled):
    store, _ = filled
    per_person = store.episodes.read().groupBy("persnr").agg(F.countDistinct("pn_batch").alias("n"))
    assert per_person.where("n > 1").isEmpty()


def test_a_delivery_that_comes_again_changes_nothing(filled, parts):
    store, _ = filled
    before = rows_of(store.episodes.read())
    for load, part in enumerate(parts):
        assert store.deliver(part, str(load)).isEmpty()
    assert store.refresh() is None
    assert rows_of(store.episodes.read()) == before


def test_refit_equals_the_whole_job(filled, rows):
    store, _ = filled
    store.refit()
    assert _equal(store, pipeline.prepare_panel(rows))


def test_steps_that_broke_off_are_made_good(spark, rows, parts, tmp_path, monkeypatch):
    store = PanelStore(spark, str(tmp_path / "s"), 500)
    store.deliver(parts[0], "a")
    replace, enter = PanelStore._replace, type(store.episodes)._enter

    def no_panel(self, name, new, persons):
        if name == "panel":
            raise OSError("the job was killed")
        replace(self, name, new, persons)

    def no_ledger(self, new):
        raise OSError("the job was killed")

    with monkeypatch.context() as m:
        m.setattr(PanelStore, "_replace", no_panel)
        with pytest.raises(OSError):
            store.refresh()
    with monkeypatch.context() as m:
        m.setattr(type(store.episodes), "_enter", no_ledger)
        with pytest.raises(OSError):
            store.deliver(rows.where("persnr > 130"), "b")
    store.refresh()
    store.deliver(rows.where("persnr > 130"), "b")
    for load, part in (("c", parts[1].where("persnr <= 130")), ("d", parts[2])):
        store.deliver(part, load)
    store.refresh()
    fits, bound = store.wages()
    assert _equal(store, pipeline.prepare_panel(rows, fits=fits, bound=bound))


def test_the_same_episode_in_two_deliveries_raises(spark, rows, tmp_path):
    store = PanelStore(spark, str(tmp_path / "s"))
    store.deliver(rows.where("persnr = 1"), "a")
    store.deliver(rows.where("persnr = 1 and spell = 1"), "b")
    with pytest.raises(Exception, match="not a key"):
        store.refresh()


def test_many_batches_take_few_folders(spark, rows, tmp_path, monkeypatch):
    """Later folders hold several batches, and a refresh leaves the other batches of its folders as they are."""
    monkeypatch.setattr(stores, "FOLDER_BITS", 2)
    store = PanelStore(spark, str(tmp_path / "s"), 20)
    late = (F.col("persnr") % 9 == 0) & (F.col("spell") > 4)
    new = F.col("persnr") > 140
    for load, part in enumerate((rows.where(~late & ~new), rows.where(late), rows.where(new & ~late))):
        store.deliver(part, str(load))
        store.refresh(reports=False)
    batches = store.panel().select("pn_batch").distinct().count()
    assert batches > 40
    for table in ("panel", "state", "episodes/rows"):
        assert len(list((tmp_path / "s" / table).glob("pn_batch=*"))) < 20, table
    fits, bound = store.wages()
    assert _equal(store, pipeline.prepare_panel(rows, fits=fits, bound=bound))


def test_rows_that_all_go_leave_no_folder(spark, rows, tmp_path):
    store = PanelStore(spark, str(tmp_path / "s"), 20)
    some = rows.where("persnr < 6").selectExpr("*", "persnr as pn_batch")
    persons = some.select("persnr", "pn_batch").distinct()
    store._replace("panel", some, persons)
    store._replace("panel", some.where("pn_batch <> 2"), persons.where("pn_batch <= 2"))
    assert rows_of(stores.read_folders(spark, f"{store.path}/panel").drop("_folder")) == rows_of(some.where("pn_batch <> 2"))
    assert not list((tmp_path / "s" / "panel").glob("pn_batch=2"))
