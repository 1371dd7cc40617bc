"""Benchmark the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is fully executed with a ``noop`` write (every row computed, nothing
collected to the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.customer_job import run_customer_job  # noqa: E402
from tidemark.plans.queries import AS_OF, QUERIES, orders_clean, raw_customer_rows, write_orders_csv  # noqa: E402
from tidemark.plans.sales_job import run_sales_job  # noqa: E402
from tidemark.session import local_session, scratch_path  # noqa: E402
from tidemark.streaming.ingest import ingest_sales  # noqa: E402

HEADLINE = tuple(QUERIES)  # every query of the library proper


#: text states it, for the same result as sales_with_segments.
YARDSTICK = """
WITH seg AS (
  SELECT customer_id, sum(amount) AS total_spent, count(sale_id) AS total_orders,
         CASE WHEN sum(amount) > 5000 AND count(sale_id) > 10 THEN 'VIP'
              WHEN sum(amount) > 1000 AND count(sale_id) > 5 THEN 'High Value'
              WHEN count(sale_id) > 3 THEN 'Regular' ELSE 'New' END AS customer_segment
  FROM sales GROUP BY customer_id)
SELECT s.*, sum(amount) OVER (PARTITION BY s.customer_id, sales_month) AS monthly_total,
       sum(amount) OVER (PARTITION BY s.customer_id, sales_year) AS yearly_total,
       avg(amount) OVER (PARTITION BY s.customer_id, sales_month) AS avg_order_value,
       row_number() OVER (PARTITION BY s.customer_id, sales_month ORDER BY amount DESC, sale_id) AS order_rank_in_month,
       sum(amount) OVER (PARTITION BY s.customer_id ORDER BY sale_date RANGE UNBOUNDED PRECEDING) AS running_total,
       seg.customer_segment, seg.total_spent, seg.total_orders
FROM sales s LEFT JOIN seg ON s.customer_id = seg.customer_id
"""


def yardstick(spark, sf_dir: str):
    orders_clean(spark, sf_dir).createOrReplaceTempView("sales")
    return spark.sql(YARDSTICK)


EXTRA = {"survey_windows_as_written": yardstick}


def run(spark, name: str, sf_dir: str) -> float:
    fn = QUERIES.get(name) or EXTRA[name]
    t = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def time_jobs(spark, sf_dir: str) -> dict[str, float]:
    """Whole jobs from raw CSV (files prepared outside the timing)."""
    root = scratch_path(spark, "bench-raw")
    write_orders_csv(spark, sf_dir, f"{root}/sales/all")
    raw_customer_rows(spark, sf_dir).write.option("header", "true").csv(f"{root}/customers/all")
    write_orders_csv(spark, sf_dir, f"{root}/drops/d1", "early")
    out = {}
    for rep in ("cold", "warm"):
        t = time.perf_counter()
        run_customer_job(spark, root, scratch_path(spark, "bench-out"), AS_OF)
        out[f"customer_job_{rep}"] = round(time.perf_counter() - t, 3)
        t = time.perf_counter()
        run_sales_job(spark, root, scratch_path(spark, "bench-out"), AS_OF)
        out[f"sales_job_{rep}"] = round(time.perf_counter() - t, 3)
    ing = scratch_path(spark, "bench-ingest")
    t = time.perf_counter()
    ingest_sales(spark, f"{root}/drops", f"{ing}/staged", f"{ing}/_checkpoint")
    out["ingest_batch"] = round(time.perf_counter() - t, 3)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, app="tidemark-bench", **{"spark.sql.shuffle.partitions": str(cpus)})
    run(spark, "customer_segments", sf_dir)  # JVM warm-up, not reported
    cold, warm = {}, {}
    for name in HEADLINE:
        cold[name] = round(run(spark, name, sf_dir), 3)
        warm[name] = round(run(spark, name, sf_dir), 3)
    # Like for like: the yardstick and our plan take turns, the best of three each.
    turns = {name: [] for name in ("sales_with_segments", *EXTRA)}
    for _ in range(3):
        for name, took in turns.items():
            took.append(run(spark, name, sf_dir))
    compare = {name: round(min(took), 3) for name, took in turns.items()}
    jobs = time_jobs(spark, sf_dir)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds_warm",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "cold_total": round(sum(cold.values()), 3),
                "comparison": compare,
                "jobs": jobs,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
