"""Quality rules: plain bounds, and robust outliers among transformed statistics by language and source."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from careerpanel.llm.common import map_slices, strings
from careerpanel.sources.staging import stage

#: The base rule: fewer words fail, and a larger share (percent) of words in repeated windows of WINDOW words.
FEW_WORDS, REPEATED, WINDOW = 50, 50, 3
#: Transformed statistics are whole numbers of 1 / GRID, so their sums don't depend on any order.
GRID = 1000
#: Least standard deviations of the transformed statistics, as most texts have no symbols or repeats at all.
FLOORS = {"x_length": 0.06, "x_symbols": 0.08, "x_lines": 0.15, "x_repeats": 0.15}
#: The share of a group's rows that the estimate is made from, and the chance that a normal row is rejected.
SHARE, REJECT = 0.75, 0.0005
#: A group of fewer rows is judged by its language, a language of fewer by all.
LEAST = 50
#: Concentration steps, and bins in which distances are compared.
STEPS, BINS = 8, 1024
_SYMBOLS, _SPACES = b"#*$%&|<>", b" \t\n\x0b\x0c\r"
_X = list(FLOORS)


class Words:
    """Numbers for the words of a task's texts; they start anew before they outgrow 21 bits."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def numbers(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > 1 << 20:
            self.known.clear()
        known = self.known
        for w in set(words).difference(known):
            known[w] = len(known)
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def repeated_words(ids: np.ndarray) -> int:
    """Number of words in windows of WINDOW words that occur twice or more, the first included."""
    if len(ids) < 2 * WINDOW - 2:
        return 0
    name = ids
    for i in range(1, WINDOW):
        if name.max(initial=0) >= 1 << 42 or ids.max() >= 1 << 21:
            name = np.unique(name, return_inverse=True)[1]
            ids = np.unique(ids, return_inverse=True)[1] if ids.max() >= 1 << 21 else ids
        name = name[:-1] * (int(ids.max()) + 1) + ids[i:]
    order = np.argsort(name, kind="stable")
    same = np.flatnonzero(np.diff(name[order]) == 0)
    if not len(same):
        return 0
    steps = np.zeros(len(ids) + 1, np.int64)
    start = np.unique(np.concatenate([order[same], order[same + 1]]))
    np.add.at(steps, start, 1)
    np.add.at(steps, start + WINDOW, -1)
    return int((np.cumsum(steps) > 0).sum())


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words) of every row's
    whole text; null has none of anything. ``n_lines`` counts the lines with a word."""

    def start():
        known = Words()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for text in strings(batch, 3):
                raw = text.encode()
                words = raw.split()
                lines = [x for x in raw.split(b"\n") if x.strip()]
                rows.append((
                    len(words),
                    len(text) - len(raw) + len(raw.translate(None, _SPACES)),
                    len(raw) - len(raw.translate(None, _SYMBOLS)),
                    len(lines),
                    len(lines) - len(set(lines)),
                    repeated_words(known.numbers(words)),
                ))
            counts = np.array(rows, np.int64).reshape(-1, 6)
            return pa.record_batch([*batch.columns[:3], *(pa.array(counts[:, i]) for i in range(6))], names=["id", "lang", "source", *names])

        return step

    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"))
    return map_slices(source, start, f"id {kind}, lang string, source string, " + ", ".join(f"{n} bigint" for n in names))


def transformed() -> dict[str, Column]:
    """The statistics as whole numbers of 1 / GRID: the log of the mean length of words, and square roots of
    the shares of symbols, of repeated lines and of repeated words, whose spread then hardly depends on them."""
    share = lambda a, b: F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)))
    x = [F.log(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))), share("n_symbols", "n_words"), share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words")]
    return {name: F.round(GRID * c).cast("bigint") for name, c in zip(_X, x, strict=True)}


def chi2(x: float, df: int) -> float:
    """Distribution function for an even number of degrees."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(df // 2))


def chi2_quantile(p: float, df: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2(mid, df) < p else (low, mid)
    return low


def _group(level: int) -> Column:
    """The group of a row by language and source (0), by language (1) or of all rows (2), as text."""
    parts = [F.lit(level).alias("level"), *[F.col(c) for c in ("lang", "source")[: 2 - level]]]
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "true"})


def _moments() -> list[Column]:
    out = [F.count("*").alias("n")]
    out += [F.sum(x).alias(f"s_{x}") for x in _X]
    return out + [F.sum(F.col(x) * F.col(y)).alias(f"s_{x}_{y}") for i, x in enumerate(_X) for y in _X[i:]]


def _distance() -> Column:
    """Squared Mahalanobis distance of ``x`` from ``mean`` with the inverse covariance ``inv`` (row by row)."""
    d = [F.col(x) / GRID - F.col("mean")[i] for i, x in enumerate(_X)]
    terms = [(1 if i == j else 2) * d[i] * d[j] * F.col("inv")[len(_X) * i + j] for i in range(len(_X)) for j in range(i, len(_X))]
    return reduce(lambda a, b: a + b, terms)


def solve(moments: DataFrame, factor: float) -> DataFrame:
    """(of, total, mean, inv): centre and inverse of ``factor`` times the covariance, plus the squared FLOORS.
    One row per group, solved where it is."""
    names = [c for c in moments.columns if c not in ("of", "total")]

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            col = {c: batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(float) for c in names}
            mean = np.stack([col[f"s_{x}"] / col["n"] for x in _X], 1) / GRID
            cov = np.zeros((len(mean), len(_X), len(_X)))
            for i, x in enumerate(_X):
                for j, y in enumerate(_X[i:], i):
                    cov[:, i, j] = cov[:, j, i] = col[f"s_{x}_{y}"] / col["n"] / GRID**2 - mean[:, i] * mean[:, j]
            inv = np.linalg.inv(factor * cov + np.diag([f * f for f in FLOORS.values()]))
            return pa.record_batch([batch.column(0), batch.column(1), pa.array(list(mean), pa.list_(pa.float64())), pa.array(list(inv.reshape(len(mean), -1)), pa.list_(pa.float64()))], names=["of", "total", "mean", "inv"])

        return step

    return map_slices(moments.select("of", "total", *names), start, "of string, total bigint, mean array<double>, inv array<double>")


def estimates(points: DataFrame) -> DataFrame:
    """(of, total, mean, inv) of each group ``of`` of ``points`` (of and the transformed statistics): the minimum
    covariance determinant by concentration steps.

    A step takes the SHARE of a group's rows that are nearest by the last estimate (whole bins of distances)
    and estimates from these; the determinant falls with each step, and after STEPS of them hardly changes. The
    first estimate is medians and their deviations. All rows of a group are in each step; they are summed by bin before they move, so a group may
    hold any share of all rows, and groups may be many. The covariance of the nearest rows is made consistent
    for normal rows by a factor.
    """
    df = len(_X)
    inner = chi2_quantile(SHARE, df)
    factor = SHARE / chi2(inner, df + 2)
    # rows of equal numbers are one value to these medians, so they hold few values however many rows there are
    middle = points.groupBy("of").agg(F.count("*").alias("total"), *(F.expr(f"percentile({x}, 0.5)").alias(f"m_{x}") for x in _X))
    middle = stage(middle, "middle")
    off = points.join(middle, "of").groupBy("of").agg(*(F.expr(f"percentile(abs({x} - m_{x}), 0.5)").alias(f"d_{x}") for x in _X))
    wide = [F.pow(F.col(f"d_{x}") * 1.4826 / GRID, 2) + FLOORS[x] ** 2 for x in _X]
    inv = F.array(*(1 / wide[i] if i == j else F.lit(0.0) for i in range(df) for j in range(df)))
    now = stage(middle.join(off, "of").select("of", "total", F.array(*(F.col(f"m_{x}") / GRID for x in _X)).alias("mean"), inv.alias("inv")), "estimates")
    place = F.least(F.floor(F.log2(1 + _distance()) * (BINS / 16)), F.lit(BINS - 1)).cast("int")
    nearer = Window.partitionBy("of").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # at most BINS rows
    for _ in range(STEPS):
        bins = points.join(now, "of").groupBy("of", "total", place.alias("bin")).agg(*_moments())
        near = bins.withColumn("before", F.coalesce(F.sum("n").over(nearer), F.lit(0))).where(F.col("before") < F.ceil(SHARE * F.col("total")))
        sums = [c for c in near.columns if c not in ("of", "total", "bin", "before")]
        moments = stage(near.groupBy("of", "total").agg(*(F.sum(c).alias(c) for c in sums)), "moments")
        now = stage(solve(moments, factor), "estimates")
    return now


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance, kept) of every row.

    The base rule fails texts of few words or of mostly repeated ones. The others are judged by the squared
    robust distance of their transformed statistics in their language and source (null is a value of its
    own; groups under LEAST rows go by language or by all): above the chi-square quantile of 1 - REJECT they
    aren't kept. ``distance`` is null where the base rule fails. Null and empty texts fail; if no group is
    large enough, the base rule decides. Repeated rows are judged alike; an empty table gives no rows; other
    columns aren't read, whatever they are called. The length of a text is judged by the base rule alone.
    """
    failed = (F.col("n_words") < FEW_WORDS) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words"))
    rows = text_statistics(docs, id_col, text_col, lang_col, source_col).withColumn("base_failed", failed)
    rows = stage(rows.withColumns(transformed()), "statistics")
    sound = rows.where(~F.col("base_failed"))
    points = sound.select(F.explode(F.array(*map(_group, range(3)))).alias("of"), *_X)
    found = stage(estimates(points).where(F.col("total") >= LEAST), "estimates")
    out = rows
    for level in range(3):
        mine = found.select(F.col("of").alias(f"of_{level}"), F.struct("mean", "inv").alias(f"by_{level}"))
        out = out.withColumn(f"of_{level}", _group(level)).join(mine, f"of_{level}", "left")
    out = out.withColumn("by", F.coalesce("by_0", "by_1", "by_2")).withColumns({"mean": F.col("by.mean"), "inv": F.col("by.inv")})
    distance = F.when(~F.col("base_failed"), _distance())
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= chi2_quantile(1 - REJECT, len(_X)), F.lit(True))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance"]
    return out.withColumn("distance", distance).select(F.col("id").alias(id_col), *names, kept.alias("kept"))
