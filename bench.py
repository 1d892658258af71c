"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores;
BENCH_QUERIES may list other query names.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

HEADLINE = [
    "pair_timing_stats", "cohort_flow", "nearest_measurement", "window_features",
    "window_flags_dose", "assemble_wide", "pre_post_change_stats", "missingness",
    "volume_summary", "table1", "percentile_ladder", "band_counts", "group_dose_summary",
    "provider_summary", "annual_trends", "choice_by_quarter", "zscore", "charlson", "sofa",
    "sepsis_event", "lmm_variance", "lmm_bootstrap", "glmm_mor", "impute_pmm",
]


def main() -> None:
    from tidemark.plans.catalog import QUERIES
    from tidemark.session import build_session, release_scratch

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.checkpoint.dir": os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="bench-")})
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()
    seconds = {}
    for name in names:
        begun = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begun, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    release_scratch(spark)
    spark.stop()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir)}))


if __name__ == "__main__":
    main()
