"""Spelling variants of a corpus' words: near words by an index of variable-length grams, and the form they stand for."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careerpanel.llm.common import strings
from careerpanel.sources.staging import stage

#: Words whose counts a task keeps before it hands them on.
CACHE = 300_000
#: A word has at least LEAST code points and AGAIN occurrences; a form at least FACTOR times those of its variant.
LEAST, AGAIN, FACTOR = 7, 2, 10
#: Lengths of grams. A word of LEAST code points with its two borders has LEAST + 2, so whatever one edit
#: touches, a gram of at most LEAST + 2 - SHORTEST is left.
SHORTEST, LONGEST = 3, 6
#: A gram in more than LIST words is extended, as long as at most GRAMS grams of a length are that frequent.
LIST, GRAMS = 50, 250_000
#: Longer words are cut into two grams, their halves.
WIDE = 64
#: Words of a merged list above which they are told apart by all that is left of them.
HOT = 64
#: Code points that a task works on at once.
CELLS = 500_000
_RUN = re.compile(f"[a-zÀ-ÿ]{{{LEAST},}}")
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words of all whole texts that have at least LEAST code points and AGAIN occurrences.

    A run of letters is lower-cased in A-Z. With h = crc32 of "id:run", a null id as empty, a run whose h is a
    multiple of 31 loses its code point h mod length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}

        def rows() -> pa.RecordBatch:
            out = pa.record_batch([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        crc, get = zlib.crc32, counts.get
        for batch in batches:
            for name, text in zip(strings(batch, 0), strings(batch, 1), strict=True):
                start = crc(f"{name}:".encode())
                for word in _RUN.findall(text.encode().lower().decode()):
                    h = crc(word.encode(), start)
                    if not h % 31:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < LEAST:
                            continue
                    counts[word] = get(word, 0) + 1
                if len(counts) > CACHE:
                    yield rows()
        yield rows()

    parts = docs.select(F.col(id_col).cast("string"), text_col).mapInArrow(run, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= AGAIN)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * _B
    return x ^ x >> np.uint64(29)


def padded(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each, between a 1 and a 2."""
    body = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)
    return np.pad(np.pad(body, ((0, 0), (1, 0)), constant_values=1), ((0, 0), (0, 1)), constant_values=2).astype(np.uint64)


def gram_hashes(codes: np.ndarray) -> dict[int, np.ndarray]:
    """For each length of gram the hashes of the grams at each place."""
    out, h = {}, np.zeros_like(codes)
    for q in range(1, LONGEST + 1):
        n = codes.shape[1] - q + 1
        h = _mix((h[:, :n] + np.uint64(1)) * _A + codes[:, q - 1 :])
        if q >= SHORTEST:
            out[q] = h
    return out


def _by_length(words: list[str]) -> Iterator[np.ndarray]:
    """Places of the words of each length, in pieces of about CELLS code points."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    for same in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
        if len(same):
            step = max(1, CELLS // int(sizes[same[0]]))
            yield from (same[at : at + step] for at in range(0, len(same), step))


@dataclass
class Dictionary:
    """The frequent grams of each length, sorted by hash, and how often they occur. A gram of a word is extended
    while it is frequent, so the grams that end a word's decomposition are rare or as long as they can be."""

    grams: dict[int, tuple[np.ndarray, np.ndarray]]

    def frequency(self, q: int, hashes: np.ndarray) -> np.ndarray:
        """0 for a gram that isn't frequent."""
        known, counts = self.grams[q]
        if not len(known):
            return np.zeros(hashes.shape, np.int64)
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        return np.where(known[at] == hashes, counts[at], 0)


def gram_dictionary(words: DataFrame) -> Dictionary:
    """Counts all grams of words up to WIDE and keeps those that occur more than LIST times. The bound rises
    where more than GRAMS grams of a length could pass it, so the driver and each task hold at most
    (LONGEST - SHORTEST + 1) * GRAMS grams; longer lists are then merged, and no word is lost."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list[np.ndarray]] = {q: [] for q in range(SHORTEST, LONGEST + 1)}

        def rows() -> Iterator[pa.RecordBatch]:
            for q, parts in kept.items():
                hashes, n = np.unique(np.concatenate([*parts, np.empty(0, np.uint64)]), return_counts=True)
                parts.clear()
                yield pa.record_batch([pa.array(np.full(len(n), q, np.int32)), pa.array(hashes.view(np.int64)), pa.array(n)], names=["q", "gram", "n"])

        held = 0
        for batch in batches:
            words = [w for w in batch.column(0).to_pylist() if len(w) <= WIDE]
            for some in _by_length(words):
                for q, hashes in gram_hashes(padded([words[i] for i in some])).items():
                    kept[q].append(hashes.ravel())
                    held += hashes.size
            if held > 8 * CELLS:
                yield from rows()
                held = 0
        yield from rows()

    counts = stage(words.select("word").mapInArrow(run, "q int, gram bigint, n bigint").groupBy("q", "gram").agg(F.sum("n").alias("n")), "grams")
    most = counts.groupBy("q").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0
    found = counts.where(F.col("n") > max(LIST, -(-most // GRAMS))).toArrow()
    q, grams, n = (found[c].to_numpy() for c in ("q", "gram", "n"))
    out = {}
    for size in range(SHORTEST, LONGEST + 1):
        mine = grams[q == size].view(np.uint64)
        order = np.argsort(mine)
        out[size] = mine[order], n[q == size][order]
    return Dictionary(out)


def _affected_free(codes: np.ndarray, dictionary: Dictionary) -> tuple[np.ndarray, ...]:
    """Of words of one length: the grams that are left of each place and right of it, as (order, key, sum).

    At each place of a word starts one gram, the first that isn't frequent. It depends on nothing beyond its
    end. So an edit affects just the grams that hold its place; near words have all others in common: those
    before it at the same distance from the start, those behind it at the same distance from the end.
    ``order`` puts rare grams first; ``key`` names the least gram, ``sum`` names all.
    """
    n, width = codes.shape
    hashes = gram_hashes(codes)
    places = width - SHORTEST + 1
    length, gram, often = np.full((n, places), SHORTEST), hashes[SHORTEST].copy(), np.zeros((n, places), np.int64)
    for q in range(SHORTEST, LONGEST + 1):
        here = length == q
        often[here] = dictionary.frequency(q, gram[here])
        if q < LONGEST:
            grow = here[:, : width - q] & (often[:, : width - q] > 0)
            length[:, : width - q][grow] = q + 1
            gram[:, : width - q][grow] = hashes[q + 1][grow]
    rank = np.minimum(often, 0x7FFFFFFF).astype(np.uint64) << np.uint64(32)
    at = np.arange(places, dtype=np.uint64)
    from_start, from_end = _mix(gram + (at + np.uint64(1)) * _A), _mix((gram ^ _B) + (np.uint64(width) - at) * _A)
    rows = np.arange(n)
    lo, lk, ls = np.full((n, width + 1), _NONE), np.zeros((n, width + 1), np.uint64), np.zeros((n, width + 1), np.uint64)
    for p in range(places):
        end = p + length[:, p]
        order = rank[:, p] | from_start[:, p] >> np.uint64(32)
        better = order < lo[rows, end]
        lo[rows[better], end[better]], lk[rows[better], end[better]] = order[better], from_start[better, p]
        ls[rows, end] += from_start[:, p]
    for e in range(1, width + 1):
        better = lo[:, e - 1] <= lo[:, e]
        lo[better, e], lk[better, e] = lo[better, e - 1], lk[better, e - 1]
        ls[:, e] += ls[:, e - 1]
    ro, rk, rs = np.full((n, width + 1), _NONE), np.zeros((n, width + 1), np.uint64), np.zeros((n, width + 1), np.uint64)
    for p in range(width - 1, -1, -1):
        ro[:, p], rk[:, p], rs[:, p] = ro[:, p + 1], rk[:, p + 1], rs[:, p + 1]
        if p < places:
            order = rank[:, p] | from_end[:, p] >> np.uint64(32)
            better = order <= ro[:, p]
            ro[better, p], rk[better, p] = order[better], from_end[better, p]
            rs[:, p] += from_end[:, p]
    return lo, lk, ls, ro, rk, rs


def _keys(words: list[str], dictionary: Dictionary) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
    """(word, key, spot, is_short) of words of one length, see ``postings``."""
    size = len(words[0])
    if size > WIDE:
        for short in (False, True):
            m = size - (not short)
            for side in (0, 1):
                half = [w[: m // 2] if side == 0 else w[len(w) - (m - m // 2) :] for w in words]
                key = np.array([xxhash.xxh3_64_intdigest(h.encode(), seed=2 * m + side) for h in half], np.uint64)
                yield np.arange(len(words)), key, np.zeros(len(words), np.int32), short
        return
    codes = padded(words)
    lo, lk, ls, ro, rk, rs = _affected_free(codes, dictionary)
    for short in (False, True):
        spots = np.arange(1, size + 1 + short)  # a lost code point, or a border at which one is put in
        behind = spots + (not short)
        left = lo[:, spots] <= ro[:, behind]
        order, key = np.where(left, lo[:, spots], ro[:, behind]), np.where(left, lk[:, spots], rk[:, behind])
        m = np.uint64(size - (not short))
        single = order < np.uint64(1 << 32)
        key = _mix(key * _A + m)
        first = single.copy()
        for j in range(1, len(spots)):  # equal keys of neighbouring spots are one row
            first[:, j] &= ~(single[:, j - 1] & (key[:, j] == key[:, j - 1]))
        w, _ = np.nonzero(first)
        yield w, key[first], np.zeros(len(w), np.int32), short
        merged = _mix(_mix(ls[:, spots] * _A + rs[:, behind]) * _B + (m + (spots.astype(np.uint64) << np.uint64(32)))[None, :])
        w, j = np.nonzero(~single)
        yield w, merged[~single], spots[j].astype(np.int32), short


def postings(words: DataFrame, dictionary: Dictionary) -> DataFrame:
    """(key, spot, short, word, n): the lists of the gram index in which a word meets its near words.

    For each place at which an edit may be, the grams that it affects are set aside; a near word is in the
    lists of all others. If the rarest of them is in at most LIST words, its list is enough (spot 0).
    Else their lists are merged: the key stands for all grams that the edit leaves, and for its spot. The
    longer of two words of unlike length loses a code point, the shorter (``short``) gets one.
    """
    sent = words.sparkSession.sparkContext.broadcast(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            for some in _by_length(words):
                for w, key, spot, short in _keys([words[i] for i in some], sent.value):
                    if len(w):
                        mine = batch.take(pa.array(some[w]))
                        yield pa.record_batch([pa.array(key.view(np.int64)), pa.array(spot), pa.array(np.full(len(w), short)), mine.column(0), mine.column(1)], names=["key", "spot", "short", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "key bigint, spot int, short boolean, word string, n bigint")


def _rest() -> Column:
    """The word without the code point at ``spot``, or a shorter word as it is."""
    cut = F.concat(F.expr("substring(word, 1, spot - 1)"), F.expr("substring(word, spot + 1)"))
    return F.when(F.col("short"), F.col("word")).otherwise(cut)


def near_words(words: DataFrame) -> DataFrame:
    """(a, na, b, nb): all pairs of words (word, n) that differ by one inserted, deleted or replaced code point, a < b.

    Words meet in lists of the gram index and are verified there. A list of one gram holds at most the
    dictionary's bound. A merged list above HOT words is dealt again by what is left of each word, so that no
    list pairs many words that aren't near.
    """
    lists = stage(postings(words, gram_dictionary(words)), "postings")
    hot = stage(lists.where("spot > 0").groupBy("key").count().where(F.col("count") > HOT).select("key", F.lit(True).alias("hot")), "hot")
    if not hot.isEmpty():
        key = F.when(F.col("hot"), F.xxhash64("key", _rest())).otherwise(F.col("key"))
        lists = stage(lists.join(hot, "key", "left").select(key.alias("key"), "short", "word", "n"), "postings")
    a = lists.select("key", F.col("short").alias("sa"), F.col("word").alias("a"), F.col("n").alias("na"))
    b = lists.select("key", F.col("short").alias("sb"), F.col("word").alias("b"), F.col("n").alias("nb"))
    near = a.join(b, "key").where((F.col("a") < F.col("b")) & ~(F.col("sa") & F.col("sb")) & (F.levenshtein("a", "b", 1) == 1))
    return near.select("a", "na", "b", "nb").distinct()


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``word_counts``.

    ``n_near`` counts its near words. The form is the near word of largest n, of equal ones the smallest in
    code-point order, if that n is at least FACTOR times the word's; else null. The root is the last of the
    forms of forms, the word itself if it has none. Each form's n is FACTOR times the one before, so forms
    never turn back and doubling steps end soon. Null and empty texts have no words, an empty table no rows;
    repeated rows count each; no further column is read. Words of any length are compared whole.
    """
    words = stage(word_counts(docs, id_col, text_col), "words")
    near = stage(near_words(words), "near")
    both = near.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("m"))
    both = both.unionByName(near.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("na").alias("m")))
    best = F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best")
    around = both.groupBy("word").agg(F.count("*").alias("n_near"), best)
    enough = -F.col("best.m") >= FACTOR * F.col("n")
    out = words.join(around, "word", "left").select(
        "word",
        F.when(enough, F.col("best.other")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(enough, -F.col("best.m")).alias("form_n"),
    )
    out = stage(out, "forms")
    roots = out.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = stage(roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went")), "roots")
        if roots.where("went").isEmpty():
            break
        roots = roots.drop("went")
    return out.join(roots.select("word", "root"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
