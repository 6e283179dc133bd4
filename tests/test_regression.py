"""The censored regression and its draws."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from careerpanel.functions import normal
from careerpanel.operators import tobit

X = ["x1", "x2"]


def _sample(spark, n=4000, share=0.3, seed=1, cells=2):
    """y = 1 + 0.5 x1 - 0.2 x2 + 0.4 e, cut at the limit that censors about ``share`` of it."""
    rng = np.random.default_rng(seed)
    x1, x2 = rng.integers(0, 6, n), rng.integers(0, 2, n)
    cell = rng.integers(0, cells, n)
    y = 1 + 0.5 * x1 - 0.2 * x2 + 0.4 * rng.standard_normal(n)
    limit = np.quantile(y, 1 - share) if share else y.max() + 1
    cens = (y > limit).astype(int)
    rows = zip(cell.tolist(), np.minimum(y, limit).tolist(), cens.tolist(),
               x1.tolist(), x2.tolist())
    return spark.createDataFrame(list(rows), "cell int, y double, cens int, x1 int, x2 int")


def _fit(df, x=X):
    return tobit.fit_censored(df, ["cell"], "y", "cens", x)


def test_without_censoring_it_is_least_squares(spark):
    df = _sample(spark, share=0)
    import duckdb

    con = duckdb.connect()
    con.register("t", df.toPandas())
    expected = dict(
        (r[0], r[1:])
        for r in con.execute(
            "SELECT cell, regr_intercept(y, x1), regr_slope(y, x1) FROM t GROUP BY cell"
        ).fetchall()
    )
    for row in _fit(df, ["x1"]).collect():
        assert row["status"] == "ok"
        assert row["beta"] == pytest.approx(list(expected[row["cell"]]), abs=1e-9)


@pytest.mark.parametrize("share", [0.02, 0.2, 0.5])
def test_known_parameters_are_recovered(spark, share):
    for row in _fit(_sample(spark, 20000, share)).collect():
        assert row["beta"] == pytest.approx([1, 0.5, -0.2], abs=0.05)
        assert row["sigma"] == pytest.approx(0.4, abs=0.02)
        assert row["steps"] < 12


def _loglik(p, pdf):
    x = np.column_stack([np.ones(len(pdf)), pdf[X]])
    e = (pdf["y"].to_numpy() - x @ p[:-1]) / p[-1]
    tail = np.array([math.log(0.5 * math.erfc(v / math.sqrt(2))) for v in e])
    dens = -0.5 * e**2 - math.log(p[-1]) - 0.5 * math.log(2 * math.pi)
    return np.where(pdf["cens"] == 1, tail, dens).sum()


def test_the_fit_is_a_maximum_of_the_plain_likelihood(spark):
    """Computed over all rows at once with numpy and finite differences."""
    df = _sample(spark, 3000, 0.3, cells=1)
    row = _fit(df).first()
    pdf, p = df.toPandas(), np.array([*row["beta"], row["sigma"]])
    best = _loglik(p, pdf)
    for i in range(len(p)):
        step = np.zeros(len(p))
        step[i] = 1e-4
        up, down = _loglik(p + step, pdf), _loglik(p - step, pdf)
        assert up < best and down < best
        assert abs(up - down) / 2e-4 < 0.01


def test_collapsing_and_partitions_do_not_matter(spark):
    df = _sample(spark)
    one = {r["cell"]: r["beta"] for r in _fit(df.coalesce(1)).collect()}
    many = {r["cell"]: r["beta"] for r in _fit(df.repartition(7, "y")).collect()}
    for cell, beta in one.items():
        assert many[cell] == pytest.approx(beta, rel=1e-8)


def test_cells_without_a_fit_are_listed(spark):
    rows = (
        [(0, 1.0 + i % 3, 0, i % 3, 1) for i in range(9)]  # exact line, one gender
        + [(1, 2.0, 1, i % 3, i % 2) for i in range(9)]  # all censored
        + [(2, 1.0, 0, 1, 0), (2, 2.0, 0, 2, 0)]  # two rows
        + [(3, 1.0 + i % 3 + 0.1 * (i % 2), 0, i % 3, 1) for i in range(12)]  # constant x2
    )
    df = spark.createDataFrame(rows, "cell int, y double, cens int, x1 int, x2 int")
    out = {r["cell"]: r for r in _fit(df).collect()}
    assert out[0]["status"] == "no residual variance"
    assert out[1]["status"] == "no uncensored rows"
    assert out[2]["status"] == "too few uncensored rows"
    assert out[3]["status"] == "ok" and out[3]["rank"] == 2 and out[3]["beta"][2] == 0
    assert out[1]["beta"] is None


def _prepared(spark):
    columns = ("persnr long, spell long, begepi date, endepi date, quelle_gr int, marginal int,"
               " year int, educ_tmp int, east int, cens int, frau int, age int, tage_job long,"
               " ln_wage double, ln_limit_assess4 double")
    rng = np.random.default_rng(3)
    import datetime

    day = datetime.date(2000, 1, 1)
    rows = []
    for i in range(3000):
        age, frau, job = int(rng.integers(20, 60)), i % 2, int(rng.integers(1, 4000))
        y = 3.5 + 0.01 * age - 0.2 * frau + 0.4 * rng.standard_normal()
        cens = int(y > 4.3)
        rows.append((i, 1, day, day, 1 if i % 10 else 2, int(i % 15 == 0), 2000, 1,
                     0 if i % 7 else None, cens, frau, age, job, min(y, 4.3), 4.3))
    df = spark.createDataFrame(rows, columns)
    from careerpanel.operators.censor import add_controls

    return add_controls(df.withColumn("educ", F.col("educ_tmp")))


def test_draws(spark):
    df = _prepared(spark)
    fits = tobit.fit_censored(df.where(tobit.in_sample()))
    assert fits.first()["status"] == "ok"
    out = tobit.draw_censored(df, fits, seed=5)
    assert tobit.check_draws(out) is out
    sample = tobit.in_sample()
    counts = out.agg(
        F.count_if(sample & (F.col("cens") == 1) & (F.col("ln_wage_imp") <= 4.3)).alias("low"),
        F.count_if(sample & (F.col("cens") == 1) & F.col("ln_wage_imp").isNull()).alias("none"),
        F.count_if(sample & (F.col("cens") == 0) & (F.col("ln_wage_imp") != F.col("ln_wage"))).alias("changed"),
        F.count_if(~sample & F.col("ln_wage_imp").isNotNull()).alias("outside"),
    ).first()
    assert tuple(counts) == (0, 0, 0, 0)
    same = tobit.draw_censored(df.repartition(5), fits, seed=5)
    other = tobit.draw_censored(df, fits, seed=6)
    key = lambda d: {r[0]: r[1] for r in d.where("cens = 1").select("persnr", "ln_wage_imp").collect()}
    assert key(out) == key(same)
    assert key(out) != key(other)
    # a filter on the draw must not blow the plan up
    assert out.where(F.col("ln_wage_imp") > 4.31).count() > 0


def test_draws_follow_the_fitted_tail(spark):
    df = _prepared(spark)
    fits = tobit.fit_censored(df.where(tobit.in_sample()))
    row = fits.first()
    out = tobit.draw_censored(df, fits).where(tobit.in_sample() & (F.col("cens") == 1)).toPandas()
    x = np.column_stack([np.ones(len(out)), out[tobit.REGRESSORS].astype(float)])
    cdf = np.vectorize(lambda v: 0.5 * math.erfc(-v / math.sqrt(2)))
    xb = x @ np.array(row["beta"])
    floor = cdf((4.3 - xb) / row["sigma"])
    place = (cdf((out["ln_wage_imp"] - xb) / row["sigma"]) - floor) / (1 - floor)
    assert abs(place.mean() - 0.5) < 4 / math.sqrt(12 * len(out))


@pytest.mark.parametrize("shift", [0, 25, 35, 45, 200])
def test_draws_far_beyond_the_mean(spark, shift):
    """The limit lies ``shift`` standard deviations further up; no draw is lost or below it."""
    df = _prepared(spark)
    fits = tobit.fit_censored(df.where(tobit.in_sample()))
    lower = F.transform("beta", lambda b, i: F.when(i == 0, b - shift * F.col("sigma")).otherwise(b))
    drawn = tobit.draw_censored(df, fits.withColumn("beta", lower)).where(tobit.in_sample() & (F.col("cens") == 1))
    low, none = drawn.agg(F.count_if(F.col("ln_wage_imp") < 4.3), F.count_if(F.col("ln_wage_imp").isNull())).first()
    assert (low, none) == (0, 0)


def test_cells_without_a_maximum_raise(spark):
    fits = spark.createDataFrame([(1, "ok", [0.0]), (2, "too few uncensored rows", None)], "c int, status string, beta array<double>")
    assert tobit.check_fits(fits) is fits
    with pytest.raises(ValueError, match="without a maximum"):
        tobit.check_fits(fits.withColumn("status", F.lit("not converged")))


def test_a_draw_below_the_limit_raises(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "ln_wage_imp double, ln_wage double")
    with pytest.raises(ValueError, match="1 imputed"):
        tobit.check_draws(df)


def test_uniform_is_keyed(spark):
    import datetime
    import hashlib

    day = datetime.date(2000, 5, 1)
    df = spark.createDataFrame([(7, 3, day)], "persnr long, spell long, begepi date")
    digest = hashlib.md5(b"7|3|2000-05-01|11").hexdigest()
    assert df.select(tobit.uniform(11)).first()[0] == (int(digest[:13], 16) + 0.5) / 2**52


def test_normal_functions(spark):
    zs = [-30.0, -8.0, -5.7, -4.0, -1.0, -0.5, -0.1, 0.0, 0.3, 0.66, 1.0, 2.0, 5.0]
    z = F.col("z")
    df = spark.createDataFrame([(v,) for v in zs], "z double").select(
        "z", normal.lower_tail(z).alias("p"), normal.log_lower_tail(z).alias("lp"),
        normal.mills(z).alias("m"),
    )
    for r in df.withColumn("q", normal.quantile(F.col("p"))).collect():
        p = 0.5 * math.erfc(-r["z"] / math.sqrt(2))
        density = math.exp(-r["z"] ** 2 / 2) / math.sqrt(2 * math.pi)
        assert r["p"] == pytest.approx(p, rel=1e-12)
        assert r["lp"] == pytest.approx(math.log(p), rel=1e-12)
        assert r["m"] == pytest.approx(density / p, rel=1e-12)
        assert r["q"] == pytest.approx(r["z"], abs=1e-9)


def test_normal_functions_of_a_batch():
    zs = np.array([-200.0, -30.0, -5.7, -1.0, -0.5, -0.1, 0.0, 0.3, 1.0, 5.0, 40.0])
    for z, log_tail, ratio in zip(zs, *normal.tail_of_batch(zs), strict=True):
        if z > -38:
            p = 0.5 * math.erfc(-z / math.sqrt(2))
            log_p = math.log(p) if z < 0 else math.log1p(-0.5 * math.erfc(z / math.sqrt(2)))
            assert log_tail == pytest.approx(log_p, rel=1e-12, abs=1e-300)
            assert ratio == pytest.approx(math.exp(-z * z / 2) / math.sqrt(2 * math.pi) / p, rel=1e-12, abs=1e-300)
        assert np.isfinite([log_tail, ratio]).all()


def test_null_cell_keys_are_a_cell(spark):
    draw = np.random.default_rng(7)
    rows = []
    for cell in ("a", None):
        for x in draw.normal(size=200):
            y = 1 + 0.5 * x + draw.normal()
            rows.append((cell, float(x), float(min(y, 1.5)), int(y >= 1.5), 1.5))
    df = spark.createDataFrame(rows, "cell string, x double, ln_wage double, cens int, ln_limit_assess4 double")
    fits = tobit.fit_censored(df, cells=["cell"], x=["x"]).collect()
    assert {(r.cell, r.status) for r in fits} == {("a", "ok"), (None, "ok")}


def test_a_step_is_compiled(spark):
    """The JVM leaves methods above 8,000 bytes to its interpreter."""
    import re

    names = [*tobit.REGRESSORS, "c", "n"]
    points = spark.range(9).select(F.col("id").alias("_cell"), *[F.rand().alias(c) for c in names])
    params = spark.range(9).select(F.col("id").alias("_cell"), F.array(F.rand()).alias("delta"), F.rand().alias("theta"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        query = tobit.censored_sums(points, params, tobit.REGRESSORS)._jdf.queryExecution()
        text = spark._jvm.PythonSQLUtils.explainString(query, "codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000


def test_each_fit_has_no_slope(spark):
    df = _sample(spark)
    fits = _fit(df)
    assert tobit.fit_slopes(df, fits, ["cell"], "y", "cens", X).agg(F.max("slope")).first()[0] < 1e-4
    off = fits.withColumn("sigma", F.col("sigma") * 1.1)
    assert tobit.fit_slopes(df, off, ["cell"], "y", "cens", X).agg(F.min("slope")).first()[0] > 1e-2


def test_a_draw_below_the_limit_ends_the_job(spark):
    df = _prepared(spark)
    fits = tobit.fit_censored(df.where(tobit.in_sample())).withColumn("sigma", F.lit(float("nan")))
    with pytest.raises(Exception, match="a draw is missing"):
        tobit.draw_censored(df, fits).select("ln_wage_imp").collect()


def test_an_episode_given_twice_ends_the_job(spark):
    from careerpanel.plans.adapter import episodes
    from careerpanel.plans.pipeline import prepare_panel

    df = episodes(spark, "/root/testdata/sf0.001")
    with pytest.raises(Exception, match="is not a key"):
        prepare_panel(df.unionByName(df))
    with pytest.raises(ValueError, match="is not a key"):
        prepare_panel(df.unionByName(df), row_limit=5)


def test_cells_solved_by_sums_over_tasks_equal_those_solved_in_one(spark):
    """The way of very large cells, and both ways side by side; a cell without censored rows and one without a fit."""
    df = _sample(spark, n=2000, cells=3).withColumn("cens", F.when(F.col("cell") == 2, 0).otherwise(F.col("cens")))
    df = df.unionByName(df.limit(2).withColumn("cell", F.lit(9).cast(df.schema["cell"].dataType)))
    middle = df.where("cell = 0 AND cens = 1").count()
    fit = lambda n: tobit.fit_censored(df, ["cell"], "y", "cens", X, cell_points=n).orderBy("cell").collect()
    small, large, mixed = map(fit, (10**6, 0, middle - 1))
    assert [r.status for r in small][:3] == ["ok"] * 3 and small[0].steps > 2 and len(small) == 4
    for a, b, c in zip(small, large, mixed, strict=True):
        assert a.status == b.status == c.status and a.rank == b.rank == c.rank and a.n_cens == b.n_cens == c.n_cens
        if a.sigma is not None:
            for other in (b, c):
                assert other.sigma == pytest.approx(a.sigma, rel=1e-7)
                assert other.beta == pytest.approx(a.beta, rel=1e-5, abs=1e-9)
