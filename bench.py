"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR is the table folder, BENCH_CPUS the local cores, BENCH_RUNS the timed runs
per query (the median counts, after one run that does not). Results are computed whole
and thrown away by the ``noop`` sink; queries that write tables write them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.functions import ColumnMap, add_audit, project  # noqa: E402
from tidemark.operators import first_versions, scd1_upsert, scd2_merge  # noqa: E402
from tidemark.plans import staged  # noqa: E402
from warehouse_queries import REGISTERED  # noqa: E402

HEADLINE = (
    "map_orders_mart map_expression map_audit_hash load_orders_mart full_load_partitioned export_mart_sorted "
    "incremental_slice incremental_latest next_watermark incremental_runs scd1_upsert_products scd1_upsert_shuffled "
    "apply_changes scd2_changes scd2_merge_clients scd2_merge_shuffled scd2_replay scd2_rebuild_events scd2_as_of "
    "scd2_as_of_sorted profile_table key_candidates lineage_columns lineage_datasets run_audit dq_unique dq_orphans "
    "dq_lengths dq_scd2 reconcile stream_incremental stream_scd2 stream_append change_feed_runs as_of_events "
    "incremental_skip scd2_extend_shuffled map_bad_values incremental_date_watermark run_audit_log "
    "scd2_late_corrections reconcile_by_ranges"
).split()

LINES = [
    ColumnMap("line_id", "STRING", expression="concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)", pk=True),
    ColumnMap("quantity", "DECIMAL(18,2)", source="l_quantity"),
    ColumnMap("price", "DECIMAL(18,2)", source="l_extendedprice"),
    ColumnMap("status", "STRING", source="l_linestatus"),
]
KEYS, TRACKED = ["line_id"], ["quantity", "price", "status"]


def merges(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], DataFrame]]:
    """Merges of 1, 10 and 100 per cent of the order lines into all of them, both join shapes."""
    lines = project(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), LINES).dropDuplicates(KEYS)
    target = staged(add_audit(lines, "2026-01-01", "bench"), "bench-target")
    history = staged(first_versions(target, "2026-01-01"), "bench-history")
    found = {}
    for percent in (1, 10, 100):
        part = lines.where(F.pmod(F.xxhash64("line_id"), F.lit(100)) < percent)
        changed = part.withColumn("quantity", (F.col("quantity") + 1).cast("decimal(18,2)"))
        batch = staged(add_audit(changed, "2026-01-02", "bench"), f"bench-batch-{percent}")
        for shape, small in (("broadcast", True), ("shuffle", False)):
            found[f"scd1_{percent}pct_{shape}"] = lambda b=batch, s=small: scd1_upsert(
                target, b, KEYS, TRACKED, small_batch=s, null_keys=False
            )
            found[f"scd2_{percent}pct_{shape}"] = lambda b=batch, s=small: scd2_merge(
                history, b, KEYS, TRACKED, "2026-01-02", small_batch=s, null_keys=False
            )
    return found


def timed(make: Callable[[], DataFrame], runs: int) -> float:
    seconds = []
    for _ in range(runs + 1):
        begin = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        seconds.append(time.perf_counter() - begin)
    return round(statistics.median(seconds[1:]), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    settings = {
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),  # one machine: any folder is shared
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    times = {name: timed(lambda n=name: REGISTERED[n][0](spark, sf_dir), runs) for name in HEADLINE}
    times |= {name: timed(make, runs) for name, make in merges(spark, sf_dir).items()}
    print(
        json.dumps(
            {
                "metric": "median seconds per query, summed",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": cpus,
                "runs": runs,
                "settings": settings,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
