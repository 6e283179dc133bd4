"""Benchmark items inside documents: MinHash containment search by size of item, verified exactly."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careerpanel.llm.common import lists, map_slices, strings
from careerpanel.llm.jaccard import Shingler
from careerpanel.sources.staging import stage

#: Shingles of items that are sent to tasks at once; more items go in further passes.
BLOCK = 1_000_000
#: A-Z are lowered before; other ASCII characters than letters and digits separate words.
_TABLE = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


class PlainShingler(Shingler):
    """Words in lower case without ASCII punctuation."""

    def words(self, text: str) -> list[bytes]:
        return text.lower().encode().translate(_TABLE).split()


def sketch_size(n: int, percent: int) -> int:
    """MinHash values of an item of ``n`` shingles: one more than what any item of its size class (a power
    of two up to its double) can miss in a document that holds ``percent`` of it. So one of them is met."""
    largest = (1 << n.bit_length()) - 1
    return min(n, largest * (100 - percent) // 100 + 1)


def item_sketches(items: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(item, width, shingles, sketch): an item's set, and the least of its hashes."""

    def start():
        shingle = PlainShingler(width)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = strings(batch, 1)
            sets = [shingle(t) for t in texts]
            widths = pa.array([min(width, len(shingle.words(t))) for t in texts], pa.int32())
            sketches = [s[: sketch_size(len(s), percent)].view(np.int64) for s in sets]
            return pa.record_batch([batch.column(0), widths, lists([s.view(np.int64) for s in sets], pa.int64()), lists(sketches, pa.int64())], names=["item", "width", "shingles", "sketch"])

        return step

    kind = items.schema[id_col].dataType.simpleString()
    return map_slices(items.select(id_col, text_col), start, f"item {kind}, width int, shingles array<bigint>, sketch array<bigint>")


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    width: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(id, item, n_shingles, n_shared, containment): one row for each row of ``docs`` and item of which the
    text holds at least ``percent`` of the shingles.

    Shingles are runs of ``width`` words; an item of fewer words is one shingle, looked for as such. Null
    and empty texts hold nothing, null and empty items are in nothing. Repeated rows and items give a
    result each. Whole texts are read. Items are sent to the documents' tasks in blocks of about BLOCK
    shingles, each in a pass over the documents; documents are not shuffled. No item is missed: a text
    with enough of an item's shingles has one of its sketch.
    """
    found = stage(item_sketches(items, width, percent, item_id, item_text).where(F.size("shingles") > 0), "items")
    total = found.agg(F.sum(F.size("shingles"))).first()[0] or 0
    passes = max(1, -(-total // BLOCK))
    turn = F.pmod(F.xxhash64("shingles"), F.lit(passes))
    kinds = [docs.schema[id_col].dataType.simpleString(), items.schema[item_id].dataType.simpleString()]
    schema = f"id {kinds[0]}, item {kinds[1]}, n_shingles bigint, n_shared bigint, containment double"
    out = None
    for i in range(passes):
        block = found.where(turn == i).toArrow()
        part = map_slices(docs.select(id_col, text_col), _search(docs, block, width, percent), schema)
        out = part if out is None else out.unionByName(part)
    return out.select(F.col("id").alias(id_col), F.col("item").alias(item_id), "n_shingles", "n_shared", "containment")


def _search(docs: DataFrame, block: pa.Table, width: int, percent: int):
    def numbers(column: str) -> list[np.ndarray]:
        return [np.array(x, np.int64).view(np.uint64) for x in block[column].to_pylist()]

    sets, sketches = numbers("shingles"), numbers("sketch")
    keys = np.concatenate([*sketches, np.empty(0, np.uint64)])
    owner = np.repeat(np.arange(len(sketches)), [len(s) for s in sketches])
    order = np.argsort(keys, kind="stable")
    keys, owner = keys[order], owner[order]
    mask = np.uint64((1 << max(10, (8 * len(keys)).bit_length())) - 1)
    table = np.zeros(int(mask) + 1, bool)
    table[keys & mask] = True
    ids, widths = block["item"], sorted(set(block["width"].to_pylist()))
    sent = docs.sparkSession.sparkContext.broadcast((sets, keys, owner, mask, table, ids, widths))

    def start():
        sets, keys, owner, mask, table, ids, widths = sent.value
        shingle = PlainShingler(width)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows, items, shared = [], [], []
            for i, text in enumerate(strings(batch, 1)):
                hashes = shingle.hashes(shingle.words(text))
                rolled = [shingle.rolled(hashes, w) for w in widths if w <= len(hashes)]
                if not rolled:
                    continue
                rolled = np.concatenate(rolled)
                near = rolled[table[rolled & mask]]
                a, b = np.searchsorted(keys, near), np.searchsorted(keys, near, side="right")
                if not (b > a).any():
                    continue
                whole = np.unique(rolled)
                for k in np.unique(np.concatenate([owner[x:y] for x, y in zip(a, b, strict=True)])):
                    n = int(np.isin(sets[k], whole, assume_unique=True).sum())
                    if 100 * n >= percent * len(sets[k]):
                        rows.append(i)
                        items.append(int(k))
                        shared.append(n)
            n = np.array([len(sets[k]) for k in items], np.int64)
            item = ids.combine_chunks().take(pa.array(items, pa.int64()))
            id_ = batch.column(0).take(pa.array(rows, pa.int64()))
            return pa.record_batch([id_, item, pa.array(n), pa.array(shared, pa.int64()), pa.array(np.array(shared) / np.maximum(n, 1), pa.float64())], names=["id", "item", "n_shingles", "n_shared", "containment"])

        return step

    return start
