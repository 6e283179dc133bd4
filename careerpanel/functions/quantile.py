"""Exact quantile of a column without sorting it or holding its values in one task."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from careerpanel.sources.staging import stage

#: Size of the rank sketch, and the share of all ranks by which its answers may be off on either side, with room.
SKETCH, OFF = 4096, 0.002
#: Values that are counted one by one and handed to the driver.
SMALL = 200_000


def exact_quantile(df: DataFrame, col: str, q: float) -> float | None:
    """Continuous quantile ``q`` of ``col`` with linear interpolation; nulls and NaN do not count.

    The values are written once, and counted as they are. A mergeable sketch of ranks gives two bounds
    between which both wanted ranks lie; one more pass counts what is below them and each value between
    them. So a table of up to SMALL / OFF values takes two jobs beside the written column; a larger one
    takes a sketch of the values between the bounds before, and so on. The answer is exact: if the sketch
    is ever off by more than OFF, the bounds are widened.
    """
    seen = Observation()
    values = df.select(F.nanvl(F.col(col).cast("double"), F.lit(None)).alias("x")).where("x IS NOT NULL")
    values = values.observe(seen, F.count("x").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
    values = stage(values, "values")
    n, low, high = (seen.get[c] for c in ("n", "low", "high"))
    if not n:
        return None
    place = q * (n - 1)
    k = math.floor(place)
    lower, upper = _ranks(values, k, min(k + 1, n - 1), low, high, n)
    return lower if place == k else lower + (place - k) * (upper - lower)


def _ranks(values: DataFrame, first: int, second: int, low: float, high: float, n: int) -> tuple[float, float]:
    """The values of ranks ``first`` and ``second`` (from 0) of all ``values``; they lie in [low, high], as do ``n`` values."""
    x, below, off = F.col("x"), 0, OFF
    while low < high and n > SMALL:
        ranks = [max(0.0, (first - below) / n - off), min(1.0, (second - below) / n + off)]
        sketch = values.where(x.between(low, high)).agg(F.kll_sketch_agg_double("x", SKETCH).alias("s"))
        bounds = [F.kll_sketch_get_quantile_double("s", F.lit(r)) for r in ranks]
        a, b = sketch.select(*(c.alias(name) for c, name in zip(bounds, "ab", strict=True))).first()
        a, b = (low if ranks[0] == 0 else a), (high if ranks[1] == 1 else b)
        if 2 * off * n <= SMALL or (a, b) == (low, high):
            if found := _between(values, first, second, a, b):
                return found
        else:
            less, inside = values.agg(F.count_if(x < a), F.count_if(x.between(a, b))).first()
            if less <= first and second < less + inside:
                low, high, below, n = a, b, less, inside
                continue
        off *= 4
    return (low, low) if low == high else _between(values, first, second, low, high)


def _between(values: DataFrame, first: int, second: int, low: float, high: float) -> tuple[float, float] | None:
    """The values of both ranks, if they lie in [low, high]: one row per distinct value (about SMALL at most, as
    ``low`` and ``high`` were chosen), and one for all below."""
    place = F.when(F.col("x") >= low, F.col("x"))
    rows = values.where(F.col("x") <= high).groupBy(place.alias("x")).agg(F.count(F.lit(1)).alias("n")).toArrow()
    x, n = rows["x"].to_numpy(), rows["n"].to_numpy()  # null, for all below, becomes NaN
    order = np.argsort(np.where(np.isnan(x), -np.inf, x), kind="stable")
    found = [x[order][at] if at < len(x) else math.nan for at in np.searchsorted(np.cumsum(n[order]), [first, second], side="right")]
    return None if np.isnan(found).any() else (float(found[0]), float(found[1]))
