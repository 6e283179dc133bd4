"""Censored normal regression per cell and draws above the limit.

The model is fitted in Olsen's (1978) parameters delta = beta / sigma and theta = 1 / sigma, in
which the log-likelihood is concave. Rows that share a cell and all regressors are collapsed first:
uncensored ones to a count and two sums, censored ones to a count per limit. Uncensored points then
enter only through moments, taken once. The cells' moments are a table. A cell of ordinary size is placed with
its censored points once and solved there to the end; a very large one is solved by steps, each of which is one
aggregation over its points, wherever they lie.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careerpanel.functions import normal
from careerpanel.functions.frames import left_null_safe
from careerpanel.functions.metrics import Metrics
from careerpanel.operators.censor import CELL
from careerpanel.sources.staging import stage

REGRESSORS = ["frau", "age", "age_sq", "age_old", "age_sq_old", "tage_job", "tenure_sq"]
KEY = ["persnr", "spell", "begepi"]
MAX_STEPS = 60
TOLERANCE = 1e-6
FAR = 30
#: Censored points of a cell that a task takes at once; cells with more are solved by sums over tasks.
CELL_POINTS = 1_000_000
BELOW = 1e-9


def in_sample(x: list[str] = REGRESSORS, y: str = "ln_wage", cens: str = "cens") -> Column:
    """Employment above the marginal threshold in a known region with complete regressors."""
    cond = (F.col("quelle_gr") == 1) & (F.col("marginal") == 0) & F.col("east").isNotNull()
    for c in [*x, y, cens, "ln_limit_assess4", "endepi"]:
        cond = cond & F.col(c).isNotNull()
    return F.coalesce(cond, F.lit(False))


def design_points(
    df: DataFrame,
    cells: list[str] = CELL,
    y: str = "ln_wage",
    cens: str = "cens",
    x: list[str] = REGRESSORS,
) -> DataFrame:
    """Rows collapsed to distinct cells, regressors and (if censored) limits."""
    return (
        df.select(*cells, F.col(cens).cast("int").alias("cens"), F.col(y).alias("y"),
                  *[F.col(c).cast("double").alias(c) for c in x])
        .groupBy(*cells, "cens", *x, F.when(F.col("cens") == 1, F.col("y")).alias("c"))
        .agg(
            F.count(F.lit(1)).cast("double").alias("n"),
            F.sum("y").alias("sy"),
            F.sum(F.col("y") * F.col("y")).alias("syy"),
        )
    )


def _regressor_columns(x: list[str]) -> list[Column]:
    return [F.lit(1.0), *[F.col(c) for c in x]]


def _pairs(k: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(k) for j in range(i, k)]


def design_moments(
    points: DataFrame, cells: list[str] = CELL, x: list[str] = REGRESSORS
) -> DataFrame:
    """Per cell: number of rows of each kind and the uncensored moments n, X'X, X'y, y'y."""
    xs = _regressor_columns(x)
    free = F.col("cens") == 0

    def total(c):
        return F.sum(F.when(free, c).otherwise(0.0))

    return points.groupBy(*cells).agg(
        total(F.col("n")).alias("n_free"),
        F.sum(F.when(~free, F.col("n")).otherwise(0.0)).alias("n_cens"),
        F.count_if(~free).alias("n_points"),
        *[total(F.col("n") * xs[i] * xs[j]).alias(f"xx_{i}_{j}") for i, j in _pairs(len(xs))],
        *[total(F.col("sy") * c).alias(f"xy_{i}") for i, c in enumerate(xs)],
        total(F.col("syy")).alias("yy"),
    )


def _cell_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch and cell: log-likelihood, gradient and Hessian terms of censored points, summed."""
    for batch in batches:
        if not batch.num_rows:
            continue
        cell, n, z = (batch.column(i).to_numpy() for i in range(3))
        log_tail, lam = normal.tail_of_batch(z)
        ll, nl, nw = n * log_tail, n * lam, n * lam * (lam + z)
        aug = batch.column(3).flatten().to_numpy().reshape(len(cell), -1)
        i, j = np.triu_indices(aug.shape[1])
        terms = np.column_stack([ll, nl[:, None] * aug, nw[:, None] * aug[:, i] * aug[:, j]])
        order = np.argsort(cell, kind="stable")
        known, first = np.unique(cell[order], return_index=True)
        sums = np.add.reduceat(terms[order], first)
        yield pa.RecordBatch.from_arrays([pa.array(known), pa.array(list(sums))], ["_cell", "sums"])


def censored_sums(points: DataFrame, params: DataFrame, x: list[str]) -> DataFrame:
    """(``_cell``, ``sums``): log-likelihood, gradient and Hessian of the censored points at the parameters.

    Both frames carry ``_cell``. Normal functions and products are too much for one compiled method of the JVM:
    numpy computes and sums them per batch, so that few rows are left to add up.
    """
    xs = _regressor_columns(x)
    index = F.lit(0.0)
    for i, c in enumerate(xs):
        index = index + F.col("delta")[i] * c
    return (
        points.join(params.select("_cell", "delta", "theta"), "_cell")
        .select("_cell", "n", (index - F.col("theta") * F.col("c")).alias("z"), F.array(*xs, -F.col("c")).alias("aug"))
        .mapInArrow(_cell_sums, "_cell bigint, sums array<double>")
        .select("_cell", F.posexplode("sums"))
        .groupBy("_cell", "pos")
        .agg(F.sum("col").alias("sum"))
        .groupBy("_cell")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "sum"))), lambda s: s["sum"]).alias("sums"))
    )


#: What a cell carries from step to step, besides its moments; vectors are in scaled coordinates, but for
#: ``delta`` and ``theta``, which are those of the trial point, or of the maximum once it is found.
_VECTOR = T.ArrayType(T.DoubleType())
STATE = (
    T.StructType()
    .add("keep", T.ArrayType(T.IntegerType()))
    .add("scale", _VECTOR)
    .add("at", _VECTOR)
    .add("ll", T.DoubleType())
    .add("step", _VECTOR)
    .add("trial", _VECTOR)
    .add("steps", T.IntegerType())
    .add("slope", T.DoubleType())
    .add("status", T.StringType())
    .add("delta", _VECTOR)
    .add("theta", T.DoubleType())
    .add("sums", _VECTOR)
)


class _Cell:
    """One cell: its moments and the point that Newton's method has reached."""

    def __init__(self, row: dict):
        self.n_free, self.n_cens, self.yy = row["n_free"], row["n_cens"], row["yy"]
        self.xy = np.array(row["xy"])
        k = len(self.xy)
        self.xx = np.zeros((k, k))
        self.xx[np.triu_indices(k)] = row["xx"]
        self.xx = np.triu(self.xx) + np.triu(self.xx, 1).T
        self.keep, self.steps, self.status = row["keep"] or [], row["steps"] or 0, row["status"] or "open"
        self.ll = -np.inf if row["ll"] is None else row["ll"]
        self.slope = np.inf if row["slope"] is None else row["slope"]
        for name in ("scale", "at", "step", "trial"):
            setattr(self, name, None if row[name] is None else np.array(row[name]))

    def state(self) -> dict:
        """The columns of STATE."""
        names = ("keep", "scale", "at", "ll", "step", "trial", "steps", "slope", "status")
        out = {name: getattr(self, name) for name in names}
        point = self.at if self.status == "ok" else self.trial
        if point is not None:
            delta = np.zeros(len(self.xy))
            delta[self.keep] = point[:-1] / self.scale
            out |= {"delta": delta, "theta": point[-1]}
        return {name: v.tolist() if isinstance(v, (np.ndarray, np.generic)) else v for name, v in out.items()}

    def start(self) -> None:
        """Least squares on the uncensored rows; drops columns that depend on earlier ones."""
        n, k = self.n_free, len(self.xy)
        if n == 0:
            self.status = "no uncensored rows"
            return
        self.scale = np.sqrt(np.diag(self.xx) / n)
        safe = np.where(self.scale > 0, self.scale, 1.0)
        a = self.xx / np.outer(safe, safe) / n
        self.keep = []
        for j in range(k):
            left = a[j, j]
            if self.keep:
                part = a[np.ix_(self.keep, self.keep)]
                left -= a[j, self.keep] @ np.linalg.solve(part, a[self.keep, j])
            if left > 1e-9:
                self.keep.append(j)
        if n <= len(self.keep):
            self.status = "too few uncensored rows"
            return
        s = safe[self.keep]
        self.scale = s
        xx, xy = self.xx[np.ix_(self.keep, self.keep)] / np.outer(s, s), self.xy[self.keep] / s
        beta = np.linalg.solve(xx, xy)
        rss = self.yy - beta @ xy
        if rss <= 1e-12 * max(self.yy, 1.0):
            self.status = "no residual variance"
            return
        theta = np.sqrt((n if self.n_cens == 0 else n - len(self.keep)) / rss)
        self.trial = np.append(beta * theta, theta)
        if self.n_cens == 0:
            self.at, self.slope, self.status = self.trial, 0.0, "ok"
            self.ll = self.free_part(self.trial)[0]

    def free_part(self, p: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Uncensored log-likelihood (without the constant), gradient and Hessian."""
        s = self.scale
        xx, xy = self.xx[np.ix_(self.keep, self.keep)] / np.outer(s, s), self.xy[self.keep] / s
        d, t, n = p[:-1], p[-1], self.n_free
        ll = n * np.log(t) - (t * t * self.yy - 2 * t * d @ xy + d @ xx @ d) / 2
        grad = np.append(t * xy - xx @ d, n / t - t * self.yy + d @ xy)
        top = np.hstack([-xx, xy[:, None]])
        return ll, grad, np.vstack([top, np.append(xy, -n / t**2 - self.yy)])

    def update(self, sums: list[float] | None) -> None:
        """Accept or halve the last step, given the censored part at the trial point."""
        if sums is None:
            self.status = "no rows"
            return
        m = len(self.xy) + 1
        places, s = [*self.keep, m - 1], np.append(self.scale, 1.0)
        full = np.zeros((m, m))
        full[np.triu_indices(m)] = sums[1 + m :]
        full = np.triu(full) + np.triu(full, 1).T
        g = np.array(sums[1 : 1 + m])[places] / s
        h = full[np.ix_(places, places)] / np.outer(s, s)
        ll, grad, hess = self.free_part(self.trial)
        ll, grad, hess = ll + sums[0], grad + g, hess - h
        self.steps += 1
        if not np.isfinite(ll) or ll < self.ll - 1e-11 * abs(self.ll):
            if self.at is None:
                self.status = "no finite likelihood"
                return
            self._shorten()
        else:
            self.at, self.ll = self.trial, ll
            try:
                self.step = np.linalg.solve(-hess, grad)
            except np.linalg.LinAlgError:
                self.status = "singular"
                return
            self.slope = float(grad @ self.step)
            self.trial = self.at + self.step
            if self.slope <= TOLERANCE and self.trial[-1] > 0:
                # so close, one more step leaves an error far below this one
                self.at, self.status = self.trial, "ok"
                return
            while self.trial[-1] <= 0:
                self._shorten()
        if self.steps >= MAX_STEPS:
            self.status = "not converged"

    def _shorten(self) -> None:
        self.step = self.step / 2
        self.trial = self.at + self.step


def _solve(cells: pa.Table, points: pa.Table) -> pa.Table:
    """Newton's method on one cell with all of its censored points."""
    rows = cells.to_pylist()
    for row in rows:
        cell = _Cell(row)
        n, c = points["n"].to_numpy(), points["c"].to_numpy()
        aug = np.column_stack([np.ones(len(n)), *(points[name].to_numpy() for name in points.column_names[1:-2]), -c])
        places = np.triu_indices(aug.shape[1])
        while cell.status == "open":
            at = cell.state()
            z = aug @ np.append(at["delta"], at["theta"])
            log_tail, lam = normal.tail_of_batch(z)
            second = (aug * (n * lam * (lam + z))[:, None]).T @ aug
            cell.update([n @ log_tail, *((n * lam) @ aug), *second[places]] if len(n) else None)
        row.update(cell.state())
    return pa.Table.from_pylist(rows, schema=cells.schema)


def _begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _each_cell(batches, lambda cell, row: cell.start())


def _advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _each_cell(batches, lambda cell, row: cell.update(row["sums"]))


def _each_cell(batches, act) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        for row in rows:
            act(cell := _Cell(row), row)
            row.update(cell.state())
        yield pa.RecordBatch.from_pylist(rows, schema=batch.schema)


def fit_censored(
    df: DataFrame,
    cells: list[str] = CELL,
    y: str = "ln_wage",
    cens: str = "cens",
    x: list[str] = REGRESSORS,
    metrics: Metrics | None = None,
    cell_points: int = CELL_POINTS,
) -> DataFrame:
    """The regression of ``y`` on ``x`` per cell, right-censored where ``cens`` is 1.

    Returns one row per cell with ``beta`` (intercept first, 0 for dropped columns), ``sigma``
    and diagnostics; both are null where a cell has no fit, and ``status`` says why. Null is a cell key
    like any other. The cells are a table, one row each, so there may be any number of them. Those with up to
    ``cell_points`` censored points meet their points in one task each and are solved to the end there: the number
    of jobs doesn't depend on the number of steps. Each step over larger cells sums up over all tasks and
    writes those still open; the driver sees how many are open, and no more. ``metrics`` counts
    ``cells`` and, of these, ``cells_fitted``.
    """
    points = stage(design_points(df, cells, y, cens, x), "points")
    pairs = _pairs(len(x) + 1)
    state = design_moments(points, cells, x).select(
        F.monotonically_increasing_id().alias("_cell"), *cells, "n_free", "n_cens", "n_points", "yy",
        F.array(*[f"xx_{i}_{j}" for i, j in pairs]).alias("xx"),
        F.array(*[f"xy_{i}" for i in range(len(x) + 1)]).alias("xy"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in STATE],
    )
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in state.schema])
    state = stage(state.mapInArrow(_begin, schema), "cells")
    is_open, large = F.col("status") == "open", F.col("n_points") > cell_points
    own = left_null_safe(points.where(F.col("cens") == 1), state.where(is_open).select(*cells, "_cell", large.alias("_large")), cells)
    own = own.where(F.col("_cell").isNotNull())
    small = own.where(~F.col("_large")).select(F.col("_cell").alias("_own"), *x, "c", "n").groupBy("_own")
    solved = state.where(is_open & ~large).groupBy("_cell").cogroup(small).applyInArrow(_solve, schema)
    ended = [state.where(~is_open), stage(solved, "solved")]
    state = state.where(is_open & large)
    n_open = state.count()
    if n_open:
        censored = stage(own.where("_large").select("_cell", *x, "c", "n"), "censored")
    while n_open:
        state = state.drop("sums")
        sums = censored_sums(censored, state, x)
        state = state.join(sums, "_cell", "left").select(*schema.names)
        state = stage(state.mapInArrow(_advance, schema), "cells")
        ended.append(state.where(~is_open))
        state = state.where(is_open)
        n_open = state.count()
    found = F.col("status") == "ok"
    theta = F.col("theta")
    out = reduce(DataFrame.unionByName, ended).select(
        *cells,
        *[F.col(c).cast("long").alias(c) for c in ("n_free", "n_cens")],
        "status",
        "steps",
        F.coalesce(F.size("keep"), F.lit(0)).alias("rank"),
        F.when(found, 1 / theta).alias("sigma"),
        F.when(found, F.transform("delta", lambda d: d / theta)).alias("beta"),
        F.when(found, F.col("ll")).alias("loglik"),
        F.when(found, F.col("slope")).alias("decrement"),
    )
    if metrics is not None:
        out = metrics.watch(out, cells=F.count(F.lit(1)), cells_fitted=F.count_if(F.col("status") == "ok"))
    return stage(out, "fits")


def check_fits(fits: DataFrame) -> DataFrame:
    """Raises if the regression of a cell ended without a maximum, else hands the frame on. Cells that
    have too few rows for a fit are no error."""
    failed = F.col("status").isin("not converged", "no finite likelihood", "singular", "no rows")
    if bad := fits.where(failed).drop("beta").limit(5).collect():
        raise ValueError(f"cells without a maximum, for example {bad}")
    return fits


def uniform(seed: int, key: list[str] = KEY) -> Column:
    """A number in (0, 1) that depends only on the row key and the seed, not on partitions."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in key], F.lit(str(seed)))
    digits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")
    return (digits + 0.5) / F.lit(2.0**52)


def draw_censored(
    df: DataFrame,
    fits: DataFrame,
    seed: int = 0,
    cells: list[str] = CELL,
    x: list[str] = REGRESSORS,
) -> DataFrame:
    """``ln_wage_imp``, a draw above the limit for censored rows, ``ln_wage`` for others.

    The draw is taken in the upper tail of the fitted distribution beyond ``ln_limit_assess4``.
    Rows outside the sample and censored rows of a cell without a fit stay null. Where the limit is
    more than FAR standard deviations above the mean, the tail is taken as exp(-z * z / 2), which is
    exact there to one part in FAR squared and, unlike the distribution function, does not underflow.
    A draw that is missing or below the observed wage ends the job.
    """
    known = fits.select(*cells, "beta", "sigma")
    xb = F.col("beta")[0]
    for i, c in enumerate(x, 1):
        xb = xb + F.col("beta")[i] * F.col(c)
    sigma, sample = F.col("sigma"), in_sample(x)
    beyond = (F.col("_xb") - F.col("ln_limit_assess4")) / sigma
    tail = uniform(seed) * normal.bound(beyond, normal.lower_tail)
    far = -F.sqrt(beyond * beyond - 2 * F.log(uniform(seed)))
    z = F.when(beyond < -FAR, far).otherwise(normal.bound(tail, normal.quantile))
    draw = F.col("_xb") - sigma * z
    right = (F.col("_draw") >= F.col("ln_wage") - BELOW) & ~F.isnan("_draw")
    right = F.coalesce(right, F.lit(False))
    return (
        left_null_safe(df, known, cells)
        .withColumn("_xb", F.when(sample & (F.col("cens") == 1), xb))
        .withColumn("_draw", F.when(F.col("_xb").isNotNull(), draw))
        .withColumn(
            "ln_wage_imp",
            F.when(F.col("_xb").isNotNull() & ~right, F.raise_error(F.lit("a draw is missing or below the observed wage")))
            .when(F.col("_xb").isNotNull(), F.col("_draw"))
            .when(sample & (F.col("cens") == 0), F.col("ln_wage")),
        )
        .drop("beta", "sigma", "_xb", "_draw")
    )


def draws_below(df: DataFrame, tolerance: float = BELOW) -> DataFrame:
    """Number of imputed wages below the observed one (one row, should be 0)."""
    return df.agg(
        F.count_if(F.col("ln_wage_imp") < F.col("ln_wage") - tolerance).alias("below")
    )


def watch_draws(df: DataFrame, metrics: Metrics, x: list[str] = REGRESSORS, tolerance: float = BELOW) -> DataFrame:
    """C11, C12 on the way: ``metrics`` counts the censored rows of the sample, the draws that were made for them
    (those in cells without a fit get none), draws below the observed wage, and employment outside the sample."""
    censored = in_sample(x) & (F.col("cens") == 1)
    return metrics.watch(
        df,
        censored=F.count_if(censored),
        draws=F.count_if(censored & F.col("ln_wage_imp").isNotNull()),
        draws_below=F.count_if(F.col("ln_wage_imp") < F.col("ln_wage") - tolerance),
        outside=F.count_if((F.col("quelle_gr") == 1) & ~in_sample(x)),
    )


def places_in_tail(drawn: DataFrame, fits: DataFrame, cells: list[str] = CELL, x: list[str] = REGRESSORS) -> DataFrame:
    """Censored rows of the sample and ``place``: the share of the fitted tail above the limit that lies beyond
    the draw, null without a fit. If fit and draw are right, it is the uniform number that the draw was made of."""
    xb = F.col("beta")[0]
    for i, c in enumerate(x, 1):
        xb = xb + F.col("beta")[i] * F.col(c)
    rows = drawn.where(in_sample(x) & (F.col("cens") == 1))

    def beyond(c: str) -> Column:
        return normal.log_lower_tail((F.col("_xb") - F.col(c)) / F.col("sigma"))

    rows = left_null_safe(rows, fits.select(*cells, "beta", "sigma"), cells).withColumn("_xb", xb)
    return rows.withColumn("place", F.exp(beyond("ln_wage_imp") - beyond("ln_limit_assess4"))).drop("beta", "sigma", "_xb")


def fit_slopes(
    df: DataFrame, fits: DataFrame, cells: list[str] = CELL, y: str = "ln_wage", cens: str = "cens", x: list[str] = REGRESSORS
) -> DataFrame:
    """Per cell of ``fits``: ``slope``, the largest slope of the plain likelihood of the rows at the fitted point.

    Slopes are per row, with regressors in units of their root mean square; at a maximum they are 0, but
    for columns that the fit dropped, which count as 0.
    """
    xs = _regressor_columns(x)
    xb = F.col("beta")[0]
    for i, c in enumerate(x, 1):
        xb = xb + F.col("beta")[i] * F.col(c)
    rows = left_null_safe(df.select(*cells, cens, y, *x), fits.select(*cells, "beta", "sigma"), cells)
    rows = rows.withColumn("_e", (F.col(y) - xb) / F.col("sigma"))
    e, free = F.col("_e"), F.col(cens) == 0
    rows = rows.withColumn("_pull", F.when(free, e).otherwise(normal.mills(-e)))
    pull = F.col("_pull")
    scores = [F.abs(F.sum(pull * c)) / F.sqrt(F.count("_e") * F.sum(F.lit(1.0) * c * c)) for c in xs]
    used = [F.first("beta")[i] != 0 for i in range(len(xs))]
    spread = F.abs(F.avg(F.when(free, e * e - 1).otherwise(e * pull)))
    slopes = rows.groupBy(*cells).agg(
        F.greatest(*[F.when(u, s).otherwise(0.0) for u, s in zip(used, scores, strict=True)], spread).alias("slope")
    )
    return left_null_safe(fits, slopes, cells)


def check_draws(df: DataFrame) -> DataFrame:
    """C12 as an assertion: raises if a draw is below the limit, else hands the frame on."""
    below = draws_below(df).first()["below"]
    if below:
        raise ValueError(f"{below} imputed wages lie below the observed wage")
    return df
