"""The exact quantile by a rank sketch, and the wage bound with its defaults (C14)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from careerpanel.functions import quantile
from careerpanel.functions.metrics import Metrics
from careerpanel.operators import censor

KINDS = {
    "spread": lambda r: r.lognormal(size=30_000),
    "tied": lambda r: r.integers(0, 7, 30_000).astype(float),
    "equal": lambda r: np.full(30_000, 2.5),
    "two": lambda r: np.where(np.arange(30_000) < 29_700, 1.0, 9.0),
    "tail": lambda r: np.concatenate([np.full(29_000, 1.0), r.normal(size=1000) ** 2 * 1e9]),
    "few": lambda r: np.array([3.0, 1.0, 2.0]),
    "one": lambda r: np.array([4.0]),
}


@pytest.mark.parametrize("small", [200_000, 50])
@pytest.mark.parametrize("kind", KINDS)
def test_equals_numpy(spark, monkeypatch, kind, small):
    """Counted at once, after a sketch, and after sketches of ever fewer values."""
    monkeypatch.setattr(quantile, "SMALL", small)
    x = KINDS[kind](np.random.default_rng(1))
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (math.nan,)], "x double").repartition(5)
    for q in (0.31, 1.0):
        assert quantile.exact_quantile(df, "x", q) == pytest.approx(np.quantile(x, q), rel=1e-12)


def test_a_sketch_that_is_off_is_mended(spark, monkeypatch):
    """Bounds that miss the ranks are widened until they hold them."""
    monkeypatch.setattr(quantile, "SMALL", 100)
    monkeypatch.setattr(quantile, "SKETCH", 8)
    monkeypatch.setattr(quantile, "OFF", 1e-5)
    x = np.random.default_rng(2).normal(size=20_000)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    assert quantile.exact_quantile(df, "x", 0.9) == pytest.approx(np.quantile(x, 0.9), rel=1e-12)


def test_nothing_has_no_quantile(spark):
    assert quantile.exact_quantile(spark.createDataFrame([(None,)], "x double"), "x", 0.5) is None


@pytest.mark.parametrize("compat", [False, True])
def test_wage_bound_with_its_defaults(spark, compat):
    """Ten times the 99 % quantile; one wage lies beyond it."""
    logs = [0.01 * i for i in range(1, 200)] + [60.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(logs)] + [(999, None)], "id int, ln_wage_imp double")
    rows = {r.id: r for r in censor.cap_wage(df, compat=compat).collect()}
    values = np.array(logs) if compat else np.exp(logs)
    bound = 10 * np.quantile(values, 0.99)
    assert values[-1] > bound > values[-2]
    assert rows[999].wage_imp is None and rows[999].ln_wage_imp is None
    if compat:
        assert rows[199].ln_wage_imp == pytest.approx(bound) and rows[199].wage_imp == pytest.approx(math.exp(60.0))
    else:
        assert rows[199].wage_imp == pytest.approx(bound) and rows[199].ln_wage_imp == pytest.approx(math.log(bound))
    assert all(rows[i].ln_wage_imp == v for i, v in enumerate(logs[:-1]))
    assert censor.bound_wage(df, None, compat).where("wage_imp is not null").count() == 200


def test_metrics_add_up(spark):
    metrics = Metrics()
    for n in (3, 0, 4):
        metrics.watch(spark.range(n), rows=F.count("*"), even=F.count_if(F.col("id") % 2 == 0)).collect()
    assert metrics.numbers() == {"rows": 7, "even": 4}
