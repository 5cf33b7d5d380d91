"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the
local cores. Every query runs to its end (all rows produced, none kept).
`panel_rows_per_sec` counts the rows of the panels that the whole-panel
query builds: 10 combinations x customers x 120 years.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from panelweft.catalog import all_queries  # noqa: E402
from panelweft.catalog.inputs import table  # noqa: E402
from panelweft.scale import clear_staging  # noqa: E402

HEADLINE = [
    "interp_regions",
    "project",
    "splice_rebase",
    "allocate_and_freeze",
    "allocate_yearly",
    "reconcile_to_target",
    "apply_or_fallback",
    "row_fallback",
    "regime_smooth",
    "coverage_rings",
    "zonal_fallback",
    "zonal_stage",
    "quantiles",
    "gated_snapshot",
    "verify_inputs",
    "pct_diff_stats",
    "tiered_compare",
    "assemble_panel",
    "quality_report",
    "cube_codes",
    "panel_reconciled",
]
PANEL = "panel_reconciled"


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("panelweft-bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="bench-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()

    def run(name: str) -> float:
        start = time.time()
        queries[name][0](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.time() - start, 3)

    run("allocate_fixed")  # start-up of the JVM's code paths
    times = {name: run(name) for name in HEADLINE}
    rows = table(spark, folder, "customer").count() * 120 * 10
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")),
                "panel_rows": rows,
                "panel_rows_per_sec": round(rows / times[PANEL]),
            }
        )
    )
    clear_staging(spark)
    spark.stop()


if __name__ == "__main__":
    main()
