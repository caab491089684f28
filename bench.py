"""Times the sample queries and a whole load; prints one line of JSON.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of cores.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from grovelift import StateStore, run_table
from grovelift.plans.config import upsert_config
from grovelift.plans.sample_queries import QUERIES
from grovelift.sources.bindings import forest
from grovelift.sources.files import TargetTable

TABLE = "orders"


def session(cpus: str) -> SparkSession:
    folder = tempfile.mkdtemp(prefix="run-")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("grovelift-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .config("spark.checkpoint.dir", f"{folder}/checkpoints")
        .getOrCreate()
    )


def prepare_load(spark: SparkSession, sf_dir: str) -> StateStore:
    """Store the order forest as the tables of a configured load."""
    inputs = forest(spark, sf_dir)
    state = StateStore(spark, "bench").create()
    inputs.source.write.saveAsTable("bench.src")
    inputs.metadata.write.saveAsTable("bench.meta")
    inputs.allowed.write.saveAsTable("bench.allowed")
    row = {"table_name": TABLE, "metadata_id_column": inputs.id_column}
    for role, name in (("source", "src"), ("target", "tgt"), ("metadata", "meta")):
        row[f"{role}_database"] = "spark_catalog"
        row[f"{role}_schema"] = "bench"
        row[f"{role}_table"] = name
    upsert_config(state, spark.range(1).select(*[F.lit(v).alias(k) for k, v in row.items()]))
    TargetTable(spark, "bench.tgt").create().load_initial(inputs.target)
    return state


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    rows: dict[str, int] = {}

    def timed(name, call):
        start = time.perf_counter()
        out = call()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
        return out

    for table in Path(sf_dir).glob("*.parquet"):  # warm up: readers, then compiled code
        spark.read.parquet(str(table)).write.format("noop").mode("overwrite").save()
    for name in ("migrated_target", "config_upsert"):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name, query in QUERIES.items():
        timed(name, lambda q=query: q(spark, sf_dir).write.format("noop").mode("overwrite").save())

    state = prepare_load(spark, sf_dir)
    options = {"excluded_id": forest(spark, sf_dir).excluded_id}
    first = timed("run_load", lambda: run_table(state, TABLE, "bench.allowed", **options))
    timed("run_load_again", lambda: run_table(state, TABLE, "bench.allowed", **options))
    rows.update({f"step_{step}": n for step, n in first.rows.items()})
    print(
        json.dumps(
            {
                "metric": "total time of all sample queries and a load",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(Path(sf_dir).name.removeprefix("sf")),
                "rows_loaded": rows,
            }
        )
    )


if __name__ == "__main__":
    main()
