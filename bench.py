"""Time the headline operators; prints one JSON line.

Reads ``$BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) on ``local[$BENCH_CPUS]``.
The wide table, the logs and the lists made of them are stored before the clock starts,
as the jobs find them in practice; every query then runs to the end into a
sink that drops its rows. Median of ``$BENCH_RUNS`` runs (default 3).
"""

from __future__ import annotations

import json
import os
import time
from statistics import median

from tagloom.session import build_session
from testbed.queries import QUERIES
from testbed.tables import Tables

HEADLINE = [
    "latest_cells",
    "clean_export",
    "tags_as_string",
    "export_json_array",
    "last_update",
    "flat_updates",
    "vendor_updates",
    "prefix_scan_keys",
    "dirty_columns",
    "dirty_summary",
    "get_row",
    "lookup_vendor_tags",
    "audience_filter",
    "tag_reach_top200",
    "tag_to_devices_set",
    "campaign_filter",
    "explode_results",
    "ingest_id_file",
    "ingest_campaign_audience",
    "delete_rows",
    "delete_column",
    "apply_mutations",
    "export_job",
    "audit_job",
    "import_job_taglist",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = Tables(spark, sf_dir)
    cells, logs = tables.cells().count(), tables.logs().count()
    for stored in (tables.nested, tables.retarget, tables.taglist):
        stored()
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](tables).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(median(times), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cells": cells,
                "log_rows": logs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
