"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local threads. Every query is run in full
into a sink that keeps nothing, planning included, after one small query that starts the session.
"""

from __future__ import annotations

import json
import os
import time

from careerpanel.functions.session import local_session
from careerpanel.plans.catalog import QUERIES

HEADLINE = [
    "e4_split",
    "e5_counters",
    "b3_days_employment",
    "b5_days_firm",
    "b8_days_job",
    "b11_benefit_days",
    "j2_occ_blossfeld",
    "j10_deflate",
    "c1_censor",
    "c10_fit",
    "c14_cap",
    "p2_main_by_wage",
    "p6_year_totals",
    "p8_cut",
    "s2_assign",
    "f1_panel_full",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = local_session(cpus, "8g", **{"spark.sql.shuffle.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("e1_year_age")
    seconds = {name: round(run(name), 3) for name in HEADLINE}
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": {n: round(rows / s) for n, s in seconds.items()},
                "episodes": rows,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
