"""Small helpers shared by all operators: null rules, window specs and day counts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: The slice of a heavy person's row.
SLICE = "_slice"
SO_FAR = (Window.unboundedPreceding, Window.currentRow)
BEFORE = (Window.unboundedPreceding, -1)
ALL = (Window.unboundedPreceding, Window.unboundedFollowing)


def three_valued(cond: Column, yes, no) -> Column:
    """``yes`` where the condition holds, ``no`` where it fails, null where it is unknown."""
    return F.when(cond, yes).when(~cond, no)


def days(beg: str = "begepi", end: str = "endepi") -> Column:
    """Length of an episode in days; both bounds belong to it."""
    return (F.datediff(end, beg) + 1).cast("long")


def ordered(keys: Iterable[str], order: Iterable[str]) -> WindowSpec:
    """Window over ``keys``, ascending by ``order``.

    ``spell`` and the bounds of split episodes are never null, so the plain order is used: it is
    the one Spark sorts partition keys by, and windows with a common prefix then share a sort.
    """
    return Window.partitionBy(*keys).orderBy(*order)


def running(keys: Iterable[str], order: Iterable[str]) -> WindowSpec:
    """Like :func:`ordered`, with the frame from the first row to the current one."""
    return ordered(keys, order).rowsBetween(*SO_FAR)


def pack(df: DataFrame, keep: Iterable[str]) -> DataFrame:
    """All columns but ``keep`` as one struct ``_rest``.

    A row of few columns moves through a chain of sorts and windows as one copy of bytes; code
    generated for a very wide row exceeds what the JVM compiles and runs many times slower.
    """
    keep = [c for c in df.columns if c in {*keep, SLICE}]
    rest = [c for c in df.columns if c not in keep]
    return df.select(*keep, F.struct(*rest).alias("_rest")) if rest else df


def unpack(df: DataFrame) -> DataFrame:
    """Undo :func:`pack`."""
    if "_rest" not in df.columns:
        return df
    return df.select(*[c for c in df.columns if c != "_rest"], "_rest.*")


def left_null_safe(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on ``keys`` in which null matches null; adds the other columns of ``other``."""
    right = other.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    cond = None
    for k in keys:
        eq = df[k].eqNullSafe(right[f"_right_{k}"])
        cond = eq if cond is None else cond & eq
    return df.join(right, cond, "left").drop(*[f"_right_{k}" for k in keys])
