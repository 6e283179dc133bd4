"""Carrying state between the slices of a heavy person."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, WindowSpec

from careerpanel.functions.frames import left_null_safe, ordered


def carry(
    df: DataFrame,
    keys: list[str],
    slices: list[str],
    parts: dict[str, Column],
    scan: Callable[[DataFrame, WindowSpec], DataFrame],
) -> DataFrame:
    """Join to each row what the earlier slices of its group say.

    ``parts`` are aggregates per (``keys``, ``slices``), combined on the map side. ``scan`` turns
    them into the carried columns with windows over ``keys`` ordered by ``slices``; it sees one
    row per slice, not the rows themselves. It must return ``keys``, ``slices`` and new columns.
    """
    pieces = df.groupBy(*keys, *slices).agg(*[c.alias(n) for n, c in parts.items()])
    carried = scan(pieces, ordered(keys, slices))
    return left_null_safe(df, carried, keys + slices)
