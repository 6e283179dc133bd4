"""All reports of the job out of one scan: E3, J3, J6 and C2-C6."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from careerpanel.operators import enrich
from careerpanel.operators.censor import AGE_EDGES
from careerpanel.sources.lookups import Lookups

#: What the reports are grouped by, and the sets of them that are counted.
AXES = ["span_year", "beruf_gr", "educ", "ausbildung", "age_category", "teilzeit", "frau"]
SETS = [["span_year"], ["beruf_gr"], ["educ", "ausbildung"], ["educ"], ["educ", "age_category"], ["teilzeit"], ["frau"], []]


def age_category(edges: tuple[int, ...] = AGE_EDGES) -> Column:
    """The age band of C4; the last one includes its end, other ages have none."""
    band = F.lit(None).cast("string")
    for low, high in reversed(list(zip(edges, edges[1:]))):
        inside = (F.col("age") >= low) & ((F.col("age") <= high) if high == edges[-1] else (F.col("age") < high))
        band = F.when(inside, f"{low} to {high}").otherwise(band)
    return band


def set_id(axes: list[str]) -> int:
    """The ``grouping_id`` of a set: a bit for each axis that is left out, the first axis highest."""
    return sum((axis not in axes) << i for i, axis in enumerate(reversed(AXES)))


def report_counts(df: DataFrame) -> DataFrame:
    """(set, AXES, n, episodes, cens0, cens1) of prepared split rows, by one aggregation over grouping sets.

    ``n`` counts rows, ``episodes`` those that begin an episode, ``cens0`` and ``cens1`` the rows in employment
    below and above the limit. Tasks add up before anything moves; the result has a row per value of a set.
    """
    flagged = F.when(F.col("quelle_gr") == 1, F.col("cens"))
    rows = df.select(
        (F.year("endepi_orig") - F.year("begepi_orig") + 1).alias("span_year"),
        "beruf_gr", "educ", "ausbildung", age_category().alias("age_category"), "teilzeit", "frau",
        (F.col("year") == F.year("begepi_orig")).alias("_first"),
        flagged.alias("_cens"),
    )
    return rows.groupingSets([[F.col(a) for a in axes] for axes in SETS], *AXES).agg(
        F.grouping_id().cast("int").alias("set"),
        F.count(F.lit(1)).alias("n"),
        F.count_if("_first").alias("episodes"),
        F.count_if(F.col("_cens") == 0).alias("cens0"),
        F.count_if(F.col("_cens") == 1).alias("cens1"),
    )


def _of(counts: DataFrame, *axes: str) -> DataFrame:
    return counts.where(F.col("set") == set_id(list(axes)))


def _share() -> Column:
    return (F.col("cens1") / (F.col("cens0") + F.col("cens1"))).alias("share_censored")


def split_reports(counts: DataFrame, lookups: Lookups) -> dict[str, DataFrame]:
    """The single reports of :func:`report_counts` (written before, as each of them reads it), as the operators
    E3, J3, J6 and C2 to C6 give them. Episodes that the split drops have no span here."""
    flagged = F.col("cens0") + F.col("cens1") > 0
    names = F.create_map(*[F.lit(v) for kv in ((1, "Low"), (2, "Medium"), (3, "High")) for v in kv])
    hours = F.when(F.col("teilzeit").isNull(), "Missing FT-Info").when(F.col("teilzeit") == 0, "Fulltime").when(F.col("teilzeit") == 1, "Parttime")
    gender = F.when(F.col("frau") == 0, "Men").when(F.col("frau") == 1, "Women")
    both = _of(counts).select(F.explode(F.array(*[F.struct(F.lit(c).alias("cens"), F.col(f"cens{c}").alias("n")) for c in (0, 1)])).alias("r"))
    both = both.select("r.cens", "r.n").where(F.col("n") > 0)
    keys = _of(counts, "beruf_gr").where(F.col("episodes") > 0).select("beruf_gr", F.col("episodes").alias("n_episodes"))
    age = _of(counts, "educ", "age_category").where((F.col("educ") == 3) & F.col("age_category").isNotNull() & flagged)

    def ambiguous(crosswalk: DataFrame, target: str) -> DataFrame:
        return keys.join(enrich.crosswalk_ambiguity(crosswalk, target, f"n_{target}"), "beruf_gr")

    return {
        "span": _of(counts, "span_year").where("episodes > 0").select("span_year", F.col("episodes").alias("n")).orderBy(F.desc("n"), "span_year"),
        "ambiguous_2digit": ambiguous(lookups.occupation, "kldb92_2"),
        "ambiguous_blossfeld": ambiguous(lookups.blossfeld, "occ_blo"),
        "education": _of(counts, "educ", "ausbildung").select("educ", "ausbildung", "n").orderBy(F.asc_nulls_last("ausbildung")),
        "censored": both.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy())),  # two rows
        "censored_by_education": _of(counts, "educ").where(flagged).select(F.coalesce(names[F.col("educ")], F.lit("Missing")).alias("education"), "cens0", "cens1", _share()),
        "censored_by_age": age.select("age_category", _share()).orderBy("age_category"),
        "censored_by_hours": _of(counts, "teilzeit").where(flagged).groupBy(hours.alias("hours")).agg(F.sum("cens0").alias("cens0"), F.sum("cens1").alias("cens1")).select("hours", _share()),
        "censored_by_gender": _of(counts, "frau").where(flagged).groupBy(gender.alias("gender")).agg(F.sum("cens0").alias("cens0"), F.sum("cens1").alias("cens1")).select("gender", _share()),
    }
