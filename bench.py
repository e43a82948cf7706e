"""Wall time of the headline queries, as one line of JSON.

`BENCH_SF_DIR` is the folder of tables, `BENCH_CPUS` the number of local cores. Every query is written
to Spark's no-op sink, so all its rows are computed and none are collected. A few queries of each kind are run
before, so that the code is compiled; what is shown is the median of three runs.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from pathlib import Path
from statistics import median

from pyspark.sql import SparkSession

from graphloom.plans import queries

WARM_UP = ["rel_scan_any", "expand_directed", "table_skip", "meta_scan", "temporal_fns", "store_reload_parquet"]
RUNS = 3
HEADLINE = [
    "node_scan_any",
    "rel_scan_any",
    "anonymous_rel",
    "expand_directed",
    "expand_undirected",
    "undirected_distinct",
    "multi_hop",
    "multi_hop_region",
    "optional_expand",
    "optional_chain",
    "optional_count",
    "exists_pattern",
    "exists_flag",
    "inline_exists",
    "var_length_1_2",
    "var_length_closing",
    "var_length_optional",
    "group_entity_agg",
    "return_entity",
    "order_by_page",
    "table_skip",
    "table_distinct_on",
    "eav_explode_vertex",
    "eav_explode_edge",
    "meta_scan",
    "property_regroup",
    "upsert_docs",
    "document_edits",
    "graph_union_expand",
    "recommendation",
    "sql_view_graph",
    "math_fns",
    "temporal_fns",
    "duration_fns",
    "store_reload_parquet",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    built = queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        built[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in WARM_UP:
        run(name)
    seconds = {name: round(median(run(name) for _ in range(RUNS)), 3) for name in HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
