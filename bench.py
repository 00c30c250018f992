"""Time the layer builds and the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import time

from ledgerflow.plans import quality
from ledgerflow.session import build_session
from verification import catalog, catalog_checks  # noqa: F401
from verification.catalog import AS_OF
from verification.context import context

HEADLINE = (
    "p2_stage_clients",
    "p3_stage_credits",
    "p6_stage_remboursements",
    "p7_stage_transactions",
    "d1_dim_date",
    "d3_dim_client",
    "k1_fact_transactions",
    "k2_fact_credits",
    "k3_fact_remboursements",
    "q03_duplicates",
    "q10_orphan_references",
    "q12_texts_changed",
    "m00_all_controls",
    "w3_prior_year",
    "x1_by_region_and_segment",
    "x3_repayment_measures",
    "x4_performance_branch_month",
    "v1_top_branches",
    "v4_branches_to_watch",
    "v7_slicers_performance",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    x = context(spark, sf_dir)
    seconds: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - start, 3)

    def drain(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    timed("build_raw", lambda: x.raw)
    timed("build_staging", lambda: x.staging)
    timed("build_mart", lambda: x.mart)
    for name in HEADLINE:
        timed(name, lambda name=name: drain(catalog.QUERIES[name](x)))
    timed("quality_full_report", lambda: drain(quality.full_report(x.raw, x.staging, AS_OF)))
    print(
        json.dumps(
            {
                "metric": "warehouse_build_and_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
