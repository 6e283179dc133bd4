"""Hand tables and comparison of frames."""

import datetime

from careerpanel.schema import EPISODES


def date(text):
    return None if text is None else datetime.date.fromisoformat(text)


def episodes(spark, rows):
    """An episode table from dicts; columns left out are null, dates may be text."""
    defaults = {"gebjahr": 1960, "frau": 0, "erwstat_gr": 1, "quelle_gr": 1}
    full = []
    for row in rows:
        row = {**defaults, **row}
        row.setdefault("begorig", row.get("begepi"))
        for c in ("begorig", "begepi", "endepi"):
            if isinstance(row.get(c), str):
                row[c] = date(row[c])
        full.append(tuple(row.get(f.name) for f in EPISODES))
    return spark.createDataFrame(full, EPISODES)


def rows_of(df, columns=None):
    columns = sorted(columns or df.columns)
    key = [tuple((v is None, str(v)) for v in r) for r in df.select(*columns).collect()]
    return sorted(key)


def values(df, *columns, order=("persnr", "spell", "begepi")):
    out = [tuple(r) for r in df.orderBy(*order).select(*columns).collect()]
    return [r[0] for r in out] if len(columns) == 1 else out
