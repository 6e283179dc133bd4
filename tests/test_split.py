"""E1-E6 on hand tables."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from careerpanel.functions.frames import days
from careerpanel.operators import split
from careerpanel.plans.adapter import episodes as adapter
from tests.helpers import date, episodes, values

EDGES = [
    ("2003-01-01", "2003-12-31"),  # one whole year
    ("2003-12-31", "2004-01-01"),  # two days, two years
    ("2004-02-29", "2004-02-29"),  # leap day
    ("2001-05-10", "2008-03-02"),  # eight years
    ("2003-05-01", None),
    ("2003-05-01", "2002-05-01"),
]


@pytest.fixture(scope="module")
def edges(spark):
    return episodes(
        spark,
        [
            {"persnr": 1, "spell": i, "begepi": b, "endepi": e}
            for i, (b, e) in enumerate(EDGES, 1)
        ],
    )


def test_bounds_of_pieces(edges):
    out = split.split_episodes(edges)
    assert values(out.where("spell = 2"), "begepi", "endepi", "year", "age") == [
        (date("2003-12-31"), date("2003-12-31"), 2003, 43),
        (date("2004-01-01"), date("2004-01-01"), 2004, 44),
    ]
    eight = values(out.where("spell = 4"), "begepi", "endepi")
    assert len(eight) == 8
    assert eight[0] == (date("2001-05-10"), date("2001-12-31"))
    assert eight[3] == (date("2004-01-01"), date("2004-12-31"))
    assert eight[-1] == (date("2008-01-01"), date("2008-03-02"))
    assert values(out.where("spell = 1"), "begepi", "endepi") == [
        (date("2003-01-01"), date("2003-12-31"))
    ]


def test_unusable_rows_vanish_and_are_counted(edges):
    seen = Observation("split")
    out = split.split_episodes(edges, seen)
    assert out.where("spell > 4").count() == 0
    assert seen.get["dropped"] == 2


def test_split_keeps_days_and_rows(spark, sf_dir):
    raw = adapter(spark, sf_dir)
    out = split.split_episodes(raw)
    total = lambda df: df.agg(F.sum(days())).first()[0]
    assert total(out) == total(raw)
    assert out.count() == split.add_span(raw).agg(F.sum("span_year")).first()[0]
    assert out.where(F.year("begepi") != F.year("endepi")).count() == 0
    assert out.count() == out.select("persnr", "spell", "begepi").distinct().count()


def test_counters(spark):
    rows = [
        {"persnr": 1, "spell": s, "begepi": "2000-01-01", "endepi": "2000-02-01", "quelle_gr": q}
        for s, q in [(1, 2), (2, 1), (3, 1)]
    ]
    out = split.add_counters(episodes(spark, rows))
    assert values(out, "level1", "level2") == [(0, 2), (0, 0), (1, 1)]
    assert split.check_counters(out) is out
    with pytest.raises(ValueError, match="1 rows"):
        split.check_counters(out.withColumn("level1", F.when(F.col("spell") > 1, F.col("level1"))))
