"""Ranked lexical search: hashed sketches of maxima bound each document's score, exact scores in descending bound."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from careerpanel.llm.common import map_slices, strings
from careerpanel.sources.staging import stage

#: Documents that a search returns for each item.
TOP = 50
#: Cells of a sketch for each distinct term, and the largest sketch (2 to this power); a fuller sketch only
#: bounds less closely. SHIFTS takes a term's cells out of its hash.
ROOM, LARGEST, SHIFTS = 16, 20, (0, 21, 42)
#: Rows of highest bound, for each row of the result, that are scored first to find a threshold.
FIRST = 4
#: Distinct (item, term) pairs that are looked up at once; more items go in further passes.
BLOCK = 20_000
#: Terms whose hashes a task keeps, cells that it works on at once, and what rounding may take from a bound.
CACHE, CELLS, MARGIN = 400_000, 4_000_000, 1e-4
#: Impacts in whole numbers: IMPACT * tf // (TF * tf + LENGTH * m).
IMPACT, TF, LENGTH = 10**9, 1000, 20
#: Letters and digits of ASCII and all other characters make terms.
_TABLE = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    """The maximal runs of letters, digits and non-ASCII characters, A-Z in lower case."""
    return text.encode().lower().translate(_TABLE).split()


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, level, sketch) of every row: number of terms, and a sketch of 2 ** level bytes.

    Each distinct term falls on three cells by its hash; a cell keeps the maximum of what falls on it. What is
    folded is a term's tf (255 for more): a document's impacts grow with tf, so the maximum of tf gives the
    maximum of impacts for any collection that the document is searched in. Rows without terms have none.
    """

    def start():
        known: dict[bytes, int] = {}

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, levels, sketches = [], [], []
            for text in strings(batch, 1):
                counts = Counter(terms(text))
                for t in counts:
                    if t not in known:
                        known[t] = xxhash.xxh3_64_intdigest(t)
                h = np.fromiter(map(known.__getitem__, counts), np.uint64, len(counts))
                tf = np.fromiter(counts.values(), np.int64, len(counts))
                if len(known) > CACHE:
                    known.clear()
                level = min(LARGEST, max(5, (ROOM * len(counts)).bit_length()))
                sketch = np.zeros(1 << level, np.uint8)
                order = np.argsort(tf, kind="stable")  # of values that fall on a cell the last one stays
                for cells in _cells(h[order], level):
                    sketch[cells] = np.maximum(sketch[cells], np.minimum(tf[order], 255))
                sizes.append(int(tf.sum()))
                levels.append(level)
                sketches.append(sketch.tobytes() if sizes[-1] else None)
            return pa.record_batch([batch.column(0), pa.array(sizes, pa.int64()), pa.array(levels, pa.int32()), pa.array(sketches, pa.binary())], names=["id", "n", "level", "sketch"])

        return step

    kind = docs.schema[id_col].dataType.simpleString()
    return map_slices(docs.select(id_col, text_col), start, f"id {kind}, n bigint, level int, sketch binary", rows=200)


def _cells(hashes: np.ndarray, level: int) -> list[np.ndarray]:
    mask = np.uint64((1 << level) - 1)
    return [(hashes >> np.uint64(s) & mask).astype(np.int64) for s in SHIFTS]


def looked_up(sketches: np.ndarray, hashes: np.ndarray, level: int) -> np.ndarray:
    """For each sketch (a row) the least cell of each term: no less than the term's tf, 255 standing for more."""
    out = None
    for cells in _cells(hashes, level):
        out = sketches[:, cells] if out is None else np.minimum(out, sketches[:, cells])
    return out


@dataclass
class Block:
    """Items that are searched at once: their numbers, and their terms with weights."""

    queries: list[int]
    terms: list[list[bytes]]
    weights: dict[bytes, int]
    total: int
    length: int

    def norm(self, n):
        """m of documents of ``n`` terms."""
        return 50 + (50 * n * self.total) // self.length

    def matrix(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the distinct terms, and their weights in each item (a row per term)."""
        names = sorted(self.weights)
        place = {t: i for i, t in enumerate(names)}
        out = np.zeros((len(names), len(self.queries)), np.float32)
        for j, mine in enumerate(self.terms):
            for t in mine:
                if t in place:
                    out[place[t], j] = self.weights[t]
        return np.array([xxhash.xxh3_64_intdigest(t) for t in names], np.uint64), out


def _frequencies(docs: DataFrame, wanted: set[bytes], text_col: str) -> dict[bytes, int]:
    """Number of rows with each of the ``wanted`` terms (those of one block of items)."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in strings(batch, 0):
                counts.update(sent.value.intersection(terms(text)))
        yield pa.record_batch([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])

    found = docs.select(text_col).mapInArrow(run, "term binary, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    return {bytes(r["term"]): r["n"] for r in found.collect()}


def _bounds(index: DataFrame, block: Block, fn, schema: str) -> DataFrame:
    """Maps slices of the index by ``fn``(ids, bounds), which is made once for each task and returns rows or None;
    what its ``end()`` returns comes last. ``bounds`` has a row per document and a column per item."""
    sent = index.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        hashes, weights = block.matrix()
        step = fn()
        for batch in batches:
            n, levels = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for level in np.unique(levels[n > 0]):
                mine = np.flatnonzero((levels == level) & (n > 0))
                many = max(1, CELLS // max(len(hashes), 1 << int(level)))
                for at in range(0, len(mine), many):
                    some = mine[at : at + many]
                    sketch = np.frombuffer(b"".join(batch.column(3).take(pa.array(some)).to_pylist()), np.uint8).reshape(len(some), -1)
                    tf = looked_up(sketch, hashes, int(level))
                    m = block.norm(n[some]).astype(np.float32)[:, None]
                    impact = tf * np.float32(IMPACT) / (tf * np.float32(TF) + LENGTH * m)
                    impact[tf == 255] = IMPACT / TF
                    out = step(batch.column(0).take(pa.array(some)), impact @ weights * (1 + MARGIN) + 1)
                    if out is not None:
                        yield out
        out = step.end()
        if out is not None:
            yield out

    return index.select("id", "n", "level", "sketch").mapInArrow(run, schema)


class _Best:
    """The documents of a task with the largest bounds of each item."""

    def __init__(self, queries: list[int], kind: pa.DataType, top: int):
        self.queries, self.kind, self.top = queries, kind, top
        self.bound = np.zeros((0, len(queries)), np.float32)
        self.ids = np.zeros((0, len(queries)), object)

    def __call__(self, ids: pa.Array, bounds: np.ndarray) -> None:
        mine = np.array(ids.to_pylist(), object)[:, None].repeat(bounds.shape[1], 1)
        bound, both = np.concatenate([self.bound, bounds]), np.concatenate([self.ids, mine])
        best = np.argpartition(-bound, min(self.top, len(bound)) - 1, axis=0)[: self.top]
        self.bound, self.ids = np.take_along_axis(bound, best, 0), np.take_along_axis(both, best, 0)

    def end(self) -> pa.RecordBatch | None:
        q = np.tile(np.array(self.queries, np.int64), len(self.bound))
        return pa.record_batch([pa.array(q), pa.array(self.ids.ravel().tolist(), self.kind), pa.array(self.bound.ravel().astype(float))], names=["q", "id", "bound"])


class _Above:
    """The items that a document's bound admits it to."""

    def __init__(self, queries: list[int], least: np.ndarray):
        self.queries, self.least = np.array(queries, np.int64), least

    def __call__(self, ids: pa.Array, bounds: np.ndarray) -> pa.RecordBatch:
        row, column = np.nonzero(bounds >= self.least)
        return pa.record_batch([pa.array(self.queries[column]), ids.take(pa.array(row))], names=["q", "id"])

    def end(self) -> None:
        return None


def _exact(docs: DataFrame, chosen: DataFrame, block: Block, id_col: str, text_col: str) -> DataFrame:
    """(q, id, score) with a score above 0 of the rows whose id ``chosen`` (q, id) pairs with an item."""
    sent = docs.sparkSession.sparkContext.broadcast(block)
    kind = docs.schema[id_col].dataType.simpleString()

    def start():
        block = sent.value
        mine = {q: [(t, block.weights[t]) for t in dict.fromkeys(ts) if t in block.weights] for q, ts in zip(block.queries, block.terms, strict=True)}

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows, queries, scores = [], [], []
            for i, (text, wanted) in enumerate(zip(strings(batch, 1), batch.column(2).to_pylist(), strict=True)):
                words = terms(text)
                tf, m = Counter(words), block.norm(len(words))
                for q in wanted:
                    score = sum(w * (IMPACT * tf[t] // (TF * tf[t] + LENGTH * m)) for t, w in mine[q] if t in tf)
                    if score > 0:
                        rows.append(i)
                        queries.append(q)
                        scores.append(score)
            return pa.record_batch([pa.array(queries, pa.int64()), batch.column(0).take(pa.array(rows, pa.int64())), pa.array(scores, pa.int64())], names=["q", "id", "score"])

        return step

    wanted = stage(chosen.distinct().groupBy("id").agg(F.collect_list("q").alias("wanted")), "chosen")  # at most a block's items each
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    pairs = texts.join(wanted, F.col("_id").eqNullSafe(F.col("id"))).select("_id", "_text", "wanted")
    return map_slices(pairs, start, f"q bigint, id {kind}, score bigint", rows=200)


def _ranked(scored: DataFrame, top: int) -> DataFrame:
    """The ``top`` rows of each item, ranked. Spark cuts each task's rows to these before they move."""
    w = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    index: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(item, rank, id, score): for each item the ``top`` rows of ``docs`` of highest score above 0, equal
    scores by ascending id (null last).

    ``index`` is that of ``build_index``, written once for many searches; without it, it is built. Sketches
    bound all scores from above. The FIRST * ``top`` rows of highest bound are scored exactly; the ``top``-th of
    these scores is a threshold, and then all rows whose bound reaches it are scored. So nothing that belongs
    in the result is missed. Items go in blocks of about BLOCK terms, each in passes over index and texts; tasks get
    a block's items alone, and no document is sent to the driver.

    Null and empty texts and items match nothing. Rows that repeat are ranked each; items of equal id and
    text are one. Empty tables give no rows. Other columns aren't read.
    """
    spark = docs.sparkSession
    index = stage(build_index(docs, id_col, text_col), "index") if index is None else index
    size = index.where("n > 0").agg(F.count("*").alias("total"), F.sum("n").alias("length")).first()

    def item_terms():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [sorted(set(terms(t))) for t in strings(batch, 1)]
            flat = pa.array([t for ts in found for t in ts], pa.binary())
            ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            return pa.record_batch([batch.column(0), pa.ListArray.from_arrays(ends, flat)], names=["item", "terms"])

        return step

    kinds = items.schema[item_id].dataType.simpleString(), docs.schema[id_col].dataType.simpleString()
    asked = map_slices(items.select(item_id, item_text).distinct(), item_terms, f"item {kinds[0]}, terms array<binary>")
    asked = stage(asked.where(F.size("terms") > 0).withColumn("q", F.monotonically_increasing_id()), "items")
    amount = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    out = spark.createDataFrame([], f"q bigint, id {kinds[1]}, score bigint, rank int")
    passes = -(-amount // BLOCK) if size["total"] else 0
    for i in range(passes):
        rows = asked.where(F.pmod(F.xxhash64("q"), F.lit(passes)) == i).toArrow().to_pylist()
        if rows:
            out = out.unionByName(_block(docs, index, rows, size, top, id_col, text_col))
    named = out.join(asked.select("q", "item"), "q")
    return named.select(F.col("item").alias(item_id), "rank", F.col("id").alias(id_col), "score")


def _block(docs: DataFrame, index: DataFrame, rows: list[dict], size, top: int, id_col: str, text_col: str) -> DataFrame:
    queries, asked = [r["q"] for r in rows], [r["terms"] for r in rows]
    df = _frequencies(docs, {t for ts in asked for t in ts}, text_col)
    n = size["total"]
    weights = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for t, d in df.items()}
    block = Block(queries, asked, weights, n, size["length"])
    kind = docs.schema[id_col].dataType.simpleString()
    arrow = index.select("id").limit(0).toArrow().schema.field(0).type

    best = _bounds(index, block, lambda: _Best(queries, arrow, FIRST * top), f"q bigint, id {kind}, bound double")
    w = Window.partitionBy("q").orderBy(F.desc("bound"), "id")
    first = best.withColumn("place", F.row_number().over(w)).where(F.col("place") <= FIRST * top).select("q", "id")
    known = _ranked(_exact(docs, first, block, id_col, text_col), top).groupBy("q").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    least = {r["q"]: r["least"] for r in known.collect() if r["n"] >= top}  # one row per item of the block
    floors = np.array([least.get(q, 1) for q in queries], np.float32)
    chosen = _bounds(index, block, lambda: _Above(queries, floors), f"q bigint, id {kind}")
    return stage(_ranked(_exact(docs, chosen, block, id_col, text_col), top), "ranked")
