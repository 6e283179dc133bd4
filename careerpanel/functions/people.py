"""Placing episodes by person so that neither an ordinary nor a very large person hurts.

Almost every biography rule is a window over one person. Ordinary persons are small, so one
``repartition("persnr")`` serves all of their windows. A person that holds a large part of the
table must not end in one task, so such persons are found first (a map-side combined count over
one column) and kept in a second frame. On that frame each rule runs over *slices* of the person
(runs of ``spell`` ranks, or a start day and such a run); what a slice needs to know of the
slices before it is aggregated, scanned per person over one row per slice, and joined back.

Bounds: an ordinary person has at most ``row_limit`` rows. There are at most rows / ``row_limit`` heavy
persons; they are a written table that is joined, never a list in a plan. Slices are cut by the rank of ``spell``
and not by its value, so whatever the numbers look like, a slice starts at most ``block`` rows behind the one
before, and a person has one slice for each ``block`` rows and one more. (``persnr``, ``spell``, ``begepi``) is a key.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from careerpanel.functions.frames import BEFORE, SLICE
from careerpanel.sources.staging import stage

ROW_LIMIT = 1_000_000
BLOCK = 250_000


def person_sizes(
    df: DataFrame, row_limit: int = ROW_LIMIT, key: str = "persnr", rows: Column | None = None
) -> tuple[DataFrame | None, int]:
    """The persons with more than ``row_limit`` rows as a written table of one column (None without any), and
    the number of all rows. ``rows`` says how many rows a row is going to be, if not one."""
    n = F.count(F.lit(1)) if rows is None else F.sum(rows)
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(n.alias("n"))
    total = Observation()
    counts = counts.observe(total, F.sum("n").alias("rows"))
    heavy = stage(counts.where(F.col("n") > row_limit).select(key), "heavy")
    return None if heavy.isEmpty() else heavy, total.get["rows"] or 0


def heavy_persons(df: DataFrame, row_limit: int = ROW_LIMIT, key: str = "persnr") -> DataFrame | None:
    """The persons with more than ``row_limit`` rows as a written table of one column; None without any."""
    return person_sizes(df, row_limit, key)[0]


def split_heavy(df: DataFrame, heavy: DataFrame, key: str = "persnr") -> tuple[DataFrame, DataFrame]:
    """The rows of all other persons (and those without one), and the rows of heavy persons."""
    return tuple(df.join(heavy, key, how).select(*df.columns) for how in ("left_anti", "left_semi"))


@dataclass(frozen=True)
class People:
    """Episodes of ordinary persons, placed by ``persnr``, and those of heavy persons (or None)."""

    ordinary: DataFrame
    heavy: DataFrame | None = None
    block: int = BLOCK
    heavy_ids: DataFrame | tuple[()] = ()

    def map(self, fn: Callable[..., DataFrame], *args, **options) -> "People":
        """Apply a row-wise step to both parts."""
        heavy = None if self.heavy is None else fn(self.heavy, *args, **options)
        return People(fn(self.ordinary, *args, **options), heavy, self.block, self.heavy_ids)

    def merged(self) -> DataFrame:
        return self.ordinary if self.heavy is None else self.ordinary.unionByName(self.heavy.drop(SLICE))


def by_person(
    df: DataFrame,
    row_limit: int = ROW_LIMIT,
    block: int = BLOCK,
    heavy_ids: DataFrame | tuple[()] | None = None,
    key: str = "persnr",
    parts: int | None = None,
) -> People:
    """Split off heavy persons and place the others by person: the one wide exchange of a job.

    ``heavy_ids`` are those of :func:`person_sizes`, () for none, None if they are to be found.
    """
    by = [key] if parts is None else [parts, key]
    if heavy_ids is None:
        heavy_ids = heavy_persons(df, row_limit, key)
    if heavy_ids is None or isinstance(heavy_ids, tuple):
        return People(df.repartition(*by), None, block)
    ordinary, heavy = split_heavy(df, heavy_ids, key)
    if "spell" in df.columns:
        heavy = with_slices(heavy, block, key)
    return People(ordinary.repartition(*by), heavy, block, heavy_ids)


class PersonStep:
    """A rule over whole persons: ``whole`` for ordinary ones, ``spread`` for heavy ones.

    Call it with a :class:`People`, or with a DataFrame, which is then placed and merged again.
    """

    def __init__(self, whole: Callable[..., DataFrame], spread: Callable[..., DataFrame]):
        self.whole = whole
        self.spread = spread
        self.__doc__ = whole.__doc__
        self.__name__ = whole.__name__.lstrip("_")

    def __call__(self, data, **options):
        if not isinstance(data, People):
            return self(by_person(data), **options).merged()
        heavy = data.heavy
        if heavy is not None:
            # the spread rules join a frame with its own aggregates: cut the lineage each time
            heavy = stage(self.spread(heavy, data.block, **options))
        return People(self.whole(data.ordinary, **options), heavy, data.block, data.heavy_ids)


def with_slices(df: DataFrame, block: int, key: str = "persnr") -> DataFrame:
    """Adds the slice of each row: the rows in order of (``key``, ``spell``), cut after every ``block`` rows.

    Rows are dealt by range, so a person takes as many tasks as their rows fill; a row's number is its place in
    the part and the number of rows of the parts before it, of which there is one number per part. Rows of one
    ``spell`` share the place of the first of them, and so the slice.
    """
    order = [F.col(key), F.col("spell")]
    ranged = df.drop(SLICE).repartitionByRange(*order).sortWithinPartitions(*order)
    number = F.monotonically_increasing_id()
    rows = ranged.withColumns({"_part": F.shiftright(number, 33).cast("int"), "_at": number.bitwiseAND((1 << 33) - 1)})
    rows = stage(rows.withColumn("_at", F.min("_at").over(Window.partitionBy(key, "spell"))), "slices")
    before = F.sum("n").over(Window.orderBy("_part").rowsBetween(*BEFORE))
    parts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).select("_part", F.coalesce(before, F.lit(0)).alias("_offset"))
    place = F.floor((F.col("_offset") + F.col("_at")) / F.lit(block)).cast("long")
    return rows.join(F.broadcast(parts), "_part").withColumn(SLICE, place).drop("_part", "_at", "_offset")  # a row per part


def with_block(df: DataFrame, block: int) -> DataFrame:
    """Adds ``_block``, the slice of a heavy person that a row belongs to: that of :func:`with_slices`, or by the
    value of ``spell`` where rows were not placed by :func:`by_person`."""
    known = F.col(SLICE) if SLICE in df.columns else F.floor(F.col("spell") / F.lit(block)).cast("long")
    return df.withColumn("_block", known)
