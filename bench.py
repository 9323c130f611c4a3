"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs to completion into Spark's ``noop`` sink (every row is
computed, nothing is collected).  A warm-up pass on the smallest data set
and one untimed run at size compile the hot code first; each query is then timed and the
median of three runs (five for the headline) is reported.  ``value`` is the headline job: the full clean →
price → daily-aggregate pipeline over the lineitem adapter.  ``job_csv_lineitem``
times the whole job the way the original tool is measured: transaction CSV
files in (staged beforehand, untimed), aggregate CSV and dead-letter CSV out.
``daily_volume_mixed`` is the headline with every second payload in a form that
the canonical patterns do not match (extra keys), so that it needs the JSON parser.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from daybook.operators.aggregate import daily_volume  # noqa: E402
from daybook.operators.clean import clean  # noqa: E402
from daybook.operators.prices import inline_prices  # noqa: E402
from daybook.plans.jobs import daily_volume_job  # noqa: E402
from daybook.plans.queries import QUERIES, stage_prices_csv  # noqa: E402
from daybook.session import build_session, configure, scratch_path  # noqa: E402
from daybook.sinks.files import csv_writer  # noqa: E402
from daybook.sources import tables as T  # noqa: E402

HEADLINE = "daily_volume_lineitem"
BENCH_QUERIES = ("daily_volume_lineitem", "daily_volume_mixed", "daily_volume", "dead_letters", "reject_counts",
                 "merge_partials")
WARMUP_DIR = "/root/testdata/sf0.001"


def _mixed(spark, sf_dir: str):
    """The lineitem adapter with extra JSON keys in every second row, through the pipeline."""
    configure(spark)
    raw = T.lineitem_transactions(spark, sf_dir)
    other = F.xxhash64("props", "nums") % 2 == 0
    for name in ("props", "nums"):
        raw = raw.withColumn(name, F.when(other, F.concat(F.lit('{"k": [1, 2], '), F.substr(name, F.lit(2)))).otherwise(F.col(name)))
    return daily_volume(clean(raw), inline_prices(spark, T.LINEITEM_PRICES), broadcast=True)


def _run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    {**QUERIES, "daily_volume_mixed": _mixed}[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def _stage_lineitem_csv(spark, sf_dir: str) -> str:
    """The lineitem adapter as transaction CSV files (staged once, not timed)."""
    path = scratch_path(spark, "bench-lineitem-csv")
    csv_writer(T.lineitem_transactions(spark, sf_dir)).csv(path)
    return path


def _run_job(spark, tx_path: str, prices_path: str) -> float:
    """The whole job as the original tool runs it: CSV in, aggregate CSV and dead letters out."""
    t0 = time.perf_counter()
    daily_volume_job(spark, tx_path, prices_path,
                     output=scratch_path(spark, "bench-out"), errors=scratch_path(spark, "bench-err"))
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        f"local[{cpus}]",
        app_name="daybook-bench",
        shuffle_partitions=cpus,
        extra_conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")},
    )
    # JIT warm-up: the small set first, then one untimed run of each query at size.
    if os.path.isdir(WARMUP_DIR):
        for name in BENCH_QUERIES:
            _run(spark, name, WARMUP_DIR)
    for name in BENCH_QUERIES:
        _run(spark, name, sf_dir)
    times = {name: round(statistics.median(_run(spark, name, sf_dir) for _ in range(5 if name == HEADLINE else 3)), 3)
             for name in BENCH_QUERIES}
    tx_csv = _stage_lineitem_csv(spark, sf_dir)
    prices_csv = stage_prices_csv(spark, T.LINEITEM_PRICES)
    _run_job(spark, tx_csv, prices_csv)
    times["job_csv_lineitem"] = round(statistics.median(_run_job(spark, tx_csv, prices_csv) for _ in range(3)), 3)
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": f"{HEADLINE}_seconds",
        "value": times[HEADLINE],
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "rows": rows,
        "rows_per_sec": round(rows / times[HEADLINE]) if times[HEADLINE] else None,
        "job_csv_rows_per_sec": round(rows / times["job_csv_lineitem"]),
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
