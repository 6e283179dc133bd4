"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space of the contracts: what ``bytes.split()`` splits on, too.
SPACES = r"[\x20\x09-\x0D]+"
#: Rows that a mapped function takes at once.
SLICE = 1000


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(text_or_empty(id_col)) % modulus


def row_key(id_col: str, text_col: str) -> Column:
    """64 bits that name a row by id and text. Only equal rows should have equal keys; users of the
    key that need certainty compare what they joined."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def map_slices(
    df: DataFrame, fn: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], schema: str, rows: int = SLICE
) -> DataFrame:
    """``mapInArrow`` in slices of ``rows``. ``fn`` is called once in each task and returns the function
    for a slice, which may keep state in between."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = fn()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                out = step(batch.slice(at, rows))
                if out is not None:
                    yield out

    return df.mapInArrow(run, schema)


def strings(batch: pa.RecordBatch, i: int) -> list[str]:
    """Column ``i``, null as empty."""
    return [x or "" for x in batch.column(i).to_pylist()]


def lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """A list column from one array per row."""
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate(arrays) if arrays else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))
