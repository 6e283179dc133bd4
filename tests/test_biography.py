"""B1-B11 on hand tables."""

import datetime

import pytest

from careerpanel.operators import biography
from tests.helpers import date, episodes, values


def _jobs(spark, second_start, reason, **options):
    """A job to 31 Dec 1999 and one from ``second_start``; the dates of the second."""
    rows = [
        {"persnr": 1, "spell": 1, "begepi": "1999-12-01", "endepi": "1999-12-31",
         "bnn": 1, "grund_gr": reason},
        {"persnr": 1, "spell": 2, "begepi": second_start,
         "endepi": second_start + datetime.timedelta(days=9), "bnn": 1, "grund_gr": 1},
    ]
    out = biography.add_jobs(biography.add_flags(episodes(spark, rows)), **options)
    return values(out, "ein_job", "tage_job")


@pytest.mark.parametrize(
    "gap, reason, fresh, fresh_compat",
    [
        (92, 0, False, False),
        (93, 0, True, True),
        (93, 3, True, True),
        (93, 5, True, True),
        (93, 1, False, True),
        (93, None, False, True),
        (366, 1, False, True),
        (367, 1, True, True),
    ],
)
def test_job_gaps(spark, gap, reason, fresh, fresh_compat):
    start = datetime.date(2000, 1, 1) + datetime.timedelta(days=gap)
    first = (date("1999-12-01"), 31)
    second = (start, 10) if fresh else (date("1999-12-01"), 41)
    assert _jobs(spark, start, reason) == [first, second]
    compat = [(None, None)] * 2 if fresh_compat else [first, (date("1999-12-01"), 41)]
    assert _jobs(spark, start, reason, compat=True) == compat


def test_jobs_without_firm_or_status_have_no_dates(spark):
    rows = [
        {"persnr": 1, "spell": 1, "begepi": "2000-01-01", "endepi": "2000-01-31", "bnn": None},
        {"persnr": 1, "spell": 2, "begepi": "2000-02-01", "endepi": "2000-02-29", "bnn": 1,
         "erwstat_gr": None},
        {"persnr": 1, "spell": 3, "begepi": "2000-03-01", "endepi": "2000-03-31", "bnn": 1},
    ]
    out = biography.add_jobs(biography.add_flags(episodes(spark, rows)))
    assert values(out, "azubi", "emp", "ein_job") == [
        (0, 1, None), (None, None, None), (0, 1, date("2000-03-01"))
    ]


def test_parallel_rows_of_a_job(spark):
    """The end reason of the first row counts, the end date of the last."""
    rows = [
        {"persnr": 1, "spell": 1, "begepi": "2000-01-01", "endepi": "2000-01-10", "bnn": 1,
         "grund_gr": 0},
        {"persnr": 1, "spell": 2, "begepi": "2000-01-01", "endepi": "2000-01-20", "bnn": 1,
         "grund_gr": 1},
        {"persnr": 1, "spell": 3, "begepi": "2000-05-01", "endepi": "2000-05-10", "bnn": 1},
    ]
    out = biography.add_jobs(biography.add_flags(episodes(spark, rows)))
    first, fresh = date("2000-01-01"), date("2000-05-01")
    assert values(out, "ein_job", "tage_job") == [(first, 10), (first, 10), (fresh, 10)]


def test_employment(spark):
    rows = [
        {"persnr": 1, "spell": 1, "begepi": "2000-01-01", "endepi": "2000-01-10", "erwstat_gr": 2},
        {"persnr": 1, "spell": 2, "begepi": "2000-02-01", "endepi": "2000-02-10"},
        {"persnr": 1, "spell": 3, "begepi": "2000-02-01", "endepi": "2000-02-20"},
        {"persnr": 1, "spell": 4, "begepi": "2000-03-01", "endepi": "2000-03-05", "quelle_gr": 2,
         "erwstat_gr": None},
        {"persnr": 1, "spell": 5, "begepi": "2000-04-01", "endepi": "2000-04-05"},
    ]
    df = episodes(spark, rows)
    assert values(biography.add_employment(df), "ein_erw", "tage_erw") == [
        (date("2000-02-01"), n) for n in (0, 10, 10, 10, 15)
    ]
    assert values(biography.add_employment(df, compat=True), "ein_erw", "tage_erw") == [
        (date("2000-01-01"), None), (date("2000-02-01"), 10), (date("2000-02-01"), 10),
        (date("2000-01-01"), 10), (date("2000-02-01"), 15),
    ]


def test_establishment(spark):
    rows = [
        {"persnr": 1, "spell": 1, "begepi": "2000-01-01", "endepi": "2000-01-10", "bnn": 1},
        {"persnr": 1, "spell": 2, "begepi": "2000-01-01", "endepi": "2000-01-10", "bnn": 1},
        {"persnr": 1, "spell": 3, "begepi": "2000-02-01", "endepi": "2000-02-10", "bnn": None},
        {"persnr": 1, "spell": 4, "begepi": "2000-03-01", "endepi": "2000-03-05", "bnn": 1},
    ]
    df = episodes(spark, rows)
    first = date("2000-01-01")
    assert values(biography.add_establishment(df), "ein_bet", "tage_bet") == [
        (first, 10), (first, 10), (None, None), (first, 15)
    ]
    assert values(biography.add_establishment(df, compat=True), "ein_bet")[2] == date("2000-02-01")


@pytest.mark.parametrize("days_after, receipts", [(9, 1), (10, 1), (11, 2)])
@pytest.mark.parametrize("source", [2, 16])
def test_benefit_gaps(spark, days_after, receipts, source):
    end = datetime.date(2000, 1, 31)
    start = end + datetime.timedelta(days=days_after)
    rows = [
        {"persnr": 1, "spell": 1, "begepi": "2000-01-01", "endepi": end, "quelle_gr": 2},
        {"persnr": 1, "spell": 2, "begepi": start, "endepi": start, "quelle_gr": source},
        {"persnr": 1, "spell": 3, "begepi": start, "endepi": start, "quelle_gr": 2},
        {"persnr": 1, "spell": 4, "begepi": "2000-06-01", "endepi": "2000-06-02"},
    ]
    out = biography.add_benefits(episodes(spark, rows))
    assert values(out, "anz_lst") == [1, receipts, receipts, receipts]
    assert values(out, "tage_lst") == [31, 32, 32, 32]
    assert values(out, "ende_vor") == [None, end, start, start]
