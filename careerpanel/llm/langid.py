"""Language identification with bit-sliced Bloom filters over letter n-grams."""

from __future__ import annotations

import sys
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careerpanel.llm.common import map_slices, strings
from careerpanel.sources.staging import stage

N = 3
HASHES = 3
#: A gram is in a language's filter if its share of the language's grams is at least MIN_SHARE, which bounds
#: a filter to 1 / MIN_SHARE grams, and at least RATIO times its largest share in any language.
MIN_SHARE, RATIO = 1e-5, 0.25
BITS_PER_GRAM = 12
UNKNOWN = "und"
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def letter_table() -> np.ndarray:
    """For each code point itself if it is a letter or a mark, a space otherwise."""
    points = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    keep = np.fromiter((unicodedata.category(chr(i))[0] in "LM" for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return np.where(keep, points, 32).astype(np.uint32)


def grams(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gram, row) of the N-grams of all texts: lower case, each run of other characters one space, a
    space at either end. A gram packs N code points of 21 bits; it holds a letter."""
    joined = np.frombuffer("\0".join(texts).lower().encode("utf-32-le", "replace"), np.uint32)
    # a zero may also stand in a text; the ends of texts are found by their lower-cased lengths
    ends = np.cumsum([len(t.lower()) + 1 for t in texts])
    marks = np.zeros(len(joined) + 1, bool)
    marks[ends - 1] = True
    points = np.append(table[joined], np.uint32(32))
    row = np.repeat(np.arange(len(texts)), np.diff(np.concatenate([[0], ends])))
    space = points == 32
    keep = ~space | marks | np.concatenate([[True], ~space[:-1]]) | np.concatenate([[True], marks[:-1]])
    points, row = points[keep].astype(np.uint64), row[keep]
    first = np.concatenate([[True], row[1:] != row[:-1]])
    # a space before each text's first letter
    lead = first & (points != 32)
    at = np.flatnonzero(lead)
    points, row = np.insert(points, at, np.uint64(32)), np.insert(row, at, row[at])
    if len(points) < N:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    gram = points[: -(N - 1)] << np.uint64(42) | points[1:-1] << np.uint64(21) | points[2:]
    ok = (row[: -(N - 1)] == row[N - 1 :]) & (points[1:-1] != 32)
    return gram[ok], row[: -(N - 1)][ok]


@dataclass
class Model:
    """One slice for each position of the filters: bit l says that language l has the position set."""

    languages: list[str]
    slices: np.ndarray  # positions x words of 64 languages
    false_rate: np.ndarray

    def masks(self, gram: np.ndarray) -> np.ndarray:
        """The languages that contain each gram, as bits: one row of words per gram."""
        found = None
        for m in _MULTIPLIERS[:HASHES]:
            at = self.slices[positions(gram, m, len(self.slices))]
            found = at if found is None else found & at
        return found


def positions(gram: np.ndarray, multiplier: np.uint64, size: int) -> np.ndarray:
    mixed = (gram ^ gram >> np.uint64(29)) * multiplier
    mixed ^= mixed >> np.uint64(32)
    return (mixed * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(64 - int(size).bit_length() + 1)


def gram_counts(rows: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """(lang, gram, n): counts over the whole texts, summed in each slice before the shuffle."""

    def start():
        table = letter_table()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            langs, texts = np.array(batch.column(0).to_pylist(), object), strings(batch, 1)
            names, grams_, counts = [], [], []
            for lang in sorted(set(langs)):
                found, n = np.unique(grams([t for t, x in zip(texts, langs, strict=True) if x == lang], table)[0], return_counts=True)
                names += [lang] * len(found)
                grams_.append(found.view(np.int64))
                counts.append(n)
            return pa.record_batch([pa.array(names, pa.string()), pa.array(np.concatenate(grams_)), pa.array(np.concatenate(counts), pa.int64())], names=["lang", "gram", "n"])

        return step

    out = map_slices(rows.select(F.col(lang_col).cast("string"), text_col), start, "lang string, gram bigint, n bigint")
    return out.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(rows: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """Learn from all given rows with a language. The driver gets the selected grams, at most 1 / MIN_SHARE
    for each language, whatever the input's size."""
    counts = stage(gram_counts(rows.where(F.col(lang_col).isNotNull()), lang_col, text_col), "grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    shares = counts.join(totals, "lang").select("lang", "gram", (F.col("n") / F.col("total")).alias("share")).where(F.col("share") >= MIN_SHARE)
    most = shares.groupBy("gram").agg(F.max("share").alias("most"))
    chosen = shares.join(most, "gram").where(F.col("share") >= RATIO * F.col("most")).select("lang", "gram").toArrow()
    langs = np.array(chosen["lang"].to_pylist(), object)
    gram = chosen["gram"].to_numpy().view(np.uint64)
    names = sorted(set(langs))
    sizes = [int((langs == x).sum()) for x in names]
    size = 1 << max(10, (BITS_PER_GRAM * max(sizes, default=1)).bit_length())
    slices = np.zeros((size, max(1, -(-len(names) // 64))), np.uint64)
    for i, name in enumerate(names):
        for m in _MULTIPLIERS[:HASHES]:
            at = np.unique(positions(gram[langs == name], m, size))
            slices[at, i // 64] |= np.uint64(1) << np.uint64(i % 64)
    filled = np.array([(slices[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).mean() for i in range(len(names))])
    return Model(names, slices, filled**HASHES)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: dict[str, Column] | None = None) -> DataFrame:
    """(id, lang_pred, score) of every row, and the columns of ``carry``.

    Each language's count is that of the text's grams in its filter, less the false positives that its
    filter gives: (hits - grams * rate) / (1 - rate). The largest wins, of equal ones the first by name.
    The score is the winner's count as a share of the text's grams, kept within 0 and 1. A null text, a
    text without a letter, and any text when nothing was learned: 'und' and 0. Repeated rows give repeated
    results; whole texts of any length are read; there is no shuffle.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    carry = carry or {}
    names = ["id", "lang_pred", "score", *carry]

    def start():
        table = letter_table()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            model = sent.value
            texts = strings(batch, 1)
            gram, row = grams(texts, table)
            n = np.bincount(row, minlength=len(texts))
            masks = model.masks(gram)
            counts = np.zeros((len(texts), max(1, len(model.languages))))
            for i, rate in enumerate(model.false_rate):
                hits = np.bincount(row, (masks[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).astype(float), minlength=len(texts))
                counts[:, i] = (hits - n * rate) / (1 - rate)
            best = counts.argmax(axis=1)
            known = np.array([any(map(str.isalpha, t)) for t in texts], bool) & (n > 0) & bool(model.languages)
            pred = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
            score = np.where(known, np.clip(counts[np.arange(len(texts)), best] / np.maximum(n, 1), 0, 1), 0.0)
            return pa.record_batch([batch.column(0), pa.array(pred, pa.string()), pa.array(score), *batch.columns[2:]], names=names)

        return step

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col), *(c.alias(k) for k, c in carry.items()))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([f"id {kinds['id']}", "lang_pred string", "score double", *(f"`{k}` {kinds[k]}" for k in carry)])
    return map_slices(rows, start, schema, rows=500).withColumnRenamed("id", id_col)
