"""Wall time of the registered queries.

Runs each query of ``HEADLINE`` on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``, after
one unmeasured run, and prints one JSON line.  A query's time includes planning, the
datasets it writes and the full evaluation of its result.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

import workload  # noqa: E402

HEADLINE = (
    "scan_parquet",
    "partition_scan",
    "partition_list",
    "write_roundtrip",
    "partition_roundtrip",
    "append_union",
    "compact_roundtrip",
    "cluster_roundtrip",
    "geoparquet_roundtrip",
    "geoparquet_shapes",
    "footer_bbox",
    "import_xy",
    "export_import",
    "export_xy",
    "export_geojson",
    "export_cells",
    "centroid",
    "reproject",
    "bbox",
    "cell_index",
    "cells_of_line",
    "cells_of_polygon",
    "cell_rollup",
    "reject_split",
    "max_string_lengths",
    "complex_to_string",
    "schema_csv",
    "slugify",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quadrille-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    queries = workload.registered()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in names:
        run(name)
        times[name] = round(run(name), 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
