"""S4, J1-J10, C3-C6 and C14 on lookups and small frames."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from careerpanel.functions import quantile
from careerpanel.operators import censor, enrich
from careerpanel.sources import lookups

# fixed values: the published lists of ambiguous occupation groups (first, middle and last ones)
TWO_DIGIT = {1: "1,2,3 and 4", 3: "7,8,9,10 and 11", 36: "33,34 and 37", 108: "86 and 89"}
BLOSSFELD = {1: "1,11 and 5", 74: "11,7 and 6", 98: "7,6 and 9", 108: "8,9 and 7", 117: "7 and 6"}


@pytest.mark.parametrize(
    "name, target, n_col, keys, expected",
    [
        ("occupation", "kldb92_2", "n_kldb92_2", 14, TWO_DIGIT),
        ("blossfeld", "occ_blo", "n_occ_blo", 36, BLOSSFELD),
    ],
)
def test_ambiguous_keys(spark, name, target, n_col, keys, expected):
    table = getattr(lookups.default_lookups(spark), name)
    got = {r[0]: r[1] for r in enrich.crosswalk_ambiguity(table, target, n_col).collect()}
    assert len(got) == keys
    assert {k: got[k] for k in expected} == expected


def test_sizes_and_counts(spark):
    t = lookups.default_lookups(spark)
    sizes = {n: getattr(t, n).count() for n in lookups.LOOKUP_ROWS}
    assert sizes == {"cpi": 43, "ceiling": 86, "marginal": 86, "occupation": 140, "blossfeld": 162}
    assert t.occupation.where("n_kldb92_2 = 1").count() == 106
    assert t.blossfeld.where("n_occ_blo = 1").count() == 84
    assert t.cpi.where("year = 2015").first()["cpi"] == 100


def test_csv_lookups(spark, tmp_path):
    paths = {}
    for name, (rows, names) in lookups.LOOKUP_ROWS.items():
        keep = [i for i, c in enumerate(names) if c != "place"]
        lines = [",".join(names[i] for i in keep)]
        lines += [",".join(repr(row[i]) for i in keep) for row in rows]
        paths[name] = str(tmp_path / f"{name}.csv")
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
    read, built = lookups.read_lookups(spark, **paths), lookups.default_lookups(spark)
    for name in paths:
        a, b = getattr(read, name), getattr(built, name)
        assert a.exceptAll(b.select(a.columns)).count() == 0
        assert a.count() == b.count()
    report = enrich.crosswalk_ambiguity(read.blossfeld, "occ_blo", "n_occ_blo")
    assert report.where("beruf_gr = 82").first()["matched"] == "4,6 and 5"


def test_three_digit_crosswalk_fans_out(spark, tmp_path):
    path = tmp_path / "three.csv"
    path.write_text("beruf_gr,kldb92_3,n_kldb92_3\n5,141,1\n1,11,2\n1,12,2\n")
    table = lookups.read_crosswalk(spark, str(path), "kldb92_3", "n_kldb92_3")
    df = spark.createDataFrame([(1,), (5,), (9,)], "beruf_gr int")
    out = enrich.add_crosswalk(df, table).orderBy("beruf_gr", "kldb92_3")
    assert [tuple(r)[:2] for r in out.collect()] == [(1, 11), (1, 12), (5, 141), (9, None)]
    one = enrich.add_unique_crosswalk(df, table, "kldb92_3", "n_kldb92_3", "occ3")
    assert sorted(tuple(r) for r in one.collect() if r["occ3"]) == [(5, 141)]


def test_unknown_values_stay_null(spark):
    df = spark.createDataFrame(
        [(2000, None, 50.0, 7), (2000, 17001, 50.0, 2), (2020, 3001, 50.0, 12), (2000, 3001, None, None)],
        "year int, ao_region int, tentgelt_gr double, ausbildung int",
    )
    t = lookups.default_lookups(spark)
    out = enrich.add_region(enrich.add_education(df))
    out = enrich.deflate(enrich.add_marginal(enrich.add_ceiling(out, t.ceiling), t.marginal), t.cpi)
    rows = {(r["year"], r["ao_region"]): r for r in out.collect()}
    assert rows[2000, None]["east"] is None and rows[2000, 17001]["east"] is None
    assert rows[2000, None]["cpi"] == 79.9 and rows[2000, None]["wage_defl"] == 100 * 50 / 79.9
    assert rows[2020, 3001]["limit_assess"] is None and rows[2020, 3001]["wage_defl"] is None
    assert rows[2000, 3001]["marginal"] is None and rows[2000, 3001]["limit_assess"] > 0
    assert [rows[k]["educ"] for k in ((2000, None), (2000, 17001), (2020, 3001))] == [None, 2, 3]


@pytest.mark.parametrize("q", [0.0, 0.5, 0.9, 0.99, 1.0])
def test_exact_quantile(spark, q, monkeypatch):
    monkeypatch.setattr(quantile, "SMALL", 20)
    monkeypatch.setattr(quantile, "SKETCH", 16)
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.lognormal(0, 2, 3000), np.full(1500, 2.5), [1e9]])
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "v double")
    assert quantile.exact_quantile(df, "v", q) == pytest.approx(np.quantile(x, q), rel=1e-12)


def test_quantile_of_nothing(spark):
    assert quantile.exact_quantile(spark.createDataFrame([(None,)], "v double"), "v", 0.5) is None


def test_cap(spark):
    df = spark.createDataFrame([(float(np.log(v)),) for v in [1.0] * 99 + [1000.0]], "ln_wage_imp double")
    wages = lambda **k: sorted(r["wage_imp"] for r in censor.cap_wage(df, **k).collect())
    bound = 10 * np.quantile([1.0] * 99 + [1000.0], 0.99)
    assert wages()[-1] == pytest.approx(bound)
    assert wages(compat=True)[-1] == pytest.approx(1000)
    logs = [r["ln_wage_imp"] for r in censor.cap_wage(df, compat=True).collect()]
    assert max(logs) == pytest.approx(10 * np.quantile(np.log([1.0] * 99 + [1000.0]), 0.99))


def test_age_bands(spark):
    df = spark.createDataFrame(
        [(a, 3, 1, c) for a, c in [(17, 1), (18, 0), (24, 1), (25, 1), (59, 0), (60, 1), (61, 1)]],
        "age int, educ int, quelle_gr int, cens int",
    )
    assert [tuple(r) for r in censor.censoring_by_age(df).collect()] == [
        ("18 to 25", 0.5), ("25 to 30", 1.0), ("55 to 60", 0.5)
    ]
