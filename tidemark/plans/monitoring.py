"""Registered queries of what watches the pipeline: the streaming gate, arrival notices,
mergeable quality states and drift, the jobs' own outputs and run events."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.customers import clean_customers, customer_lineage
from tidemark.operators.quality_state import (
    RANK_ERROR,
    DriftRule,
    drift,
    load_states,
    merge_states,
    quality_state,
    save_states,
    summarize,
)
from tidemark.operators.sales import clean_sales, kept_rows
from tidemark.plans.customer_job import run_customer_job
from tidemark.plans.oracle import DEDUP, METRICS, ORDERS_SALES, RAW_CUSTOMERS, ROUNDTRIP, SEGMENTS, TEXT_SALES, TS, clean
from tidemark.plans.oracle import SQL as BASE_SQL
from tidemark.plans.queries import AS_OF, REQUIRED_JOBS, ROUNDTRIP_COLUMNS, local_times, raw_customer_rows, write_orders_csv
from tidemark.plans.publish_job import publish_sales
from tidemark.plans.sales_job import run_sales_job
from tidemark.schemas import RAW_CUSTOMERS as RAW_CUSTOMER_SCHEMA
from tidemark.schemas import RAW_SALES
from tidemark.session import materialize, scratch_path
from tidemark.sinks import read_events, write_partitioned, write_plain
from tidemark.sources.files import read_raw
from tidemark.sources.layouts import list_files
from tidemark.sources.tables import job_runs, load, orders_as_sales
from tidemark.streaming.notices import ingest_notices, staged_notices
from tidemark.streaming.readiness_gate import current_gate, stream_readiness

LABELS = ("customer_state", "sales_state")

# ------------------------------------------------------------------------ streams


def q_readiness_stream(spark: SparkSession, sf: str) -> DataFrame:
    """All job runs in two drops, the newer ones first and a third of those once more; the
    stream's last verdicts are the batch gate's."""
    root = scratch_path(spark, "readiness-stream")
    runs = job_runs(load(spark, sf, "events")).select("job_name", "job_run_id", "state", "started_on")
    key = F.crc32("job_run_id") % 3
    go = lambda: stream_readiness(spark, f"{root}/in", f"{root}/out", f"{root}/_checkpoint", REQUIRED_JOBS, LABELS, delay="36500 days")
    runs.filter(key != 0).write.json(f"{root}/in/drop=1")
    go()
    runs.filter(key != 1).write.json(f"{root}/in/drop=2")
    go()
    return current_gate(spark, f"{root}/out").drop("timed_out")


def q_notice_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """K2: sales files read by the notices that name them: repeated, out of order, of files
    that come later, never come, or aren't data."""
    root = scratch_path(spark, "notices")
    orders_as_sales(load(spark, sf, "orders")).repartition(6, "sale_id").write.option("header", "true").csv(f"{root}/buckets/raw/sales/drop")
    named = list_files(spark, f"{root}/buckets").select(
        F.lit("raw").alias("bucket"), F.concat(F.lit("sales/drop/"), F.element_at(F.split("path", "/"), -1)).alias("key")
    )
    absent = named.withColumn("key", F.concat(F.lit("sales/none/"), "key"))
    other = named.withColumn("key", F.concat("key", F.lit(".json")))

    def send(rows: DataFrame, drop: int) -> None:
        record = F.struct(F.struct(F.struct(F.col("bucket").alias("name")).alias("bucket"), F.struct("key").alias("object")).alias("s3"))
        rows.select(F.to_json(F.struct(F.array(record).alias("Records"))).alias("body")).write.json(f"{root}/in/drop={drop}")
        ingest_notices(spark, f"{root}/in", f"{root}/buckets", f"{root}/staged", f"{root}/ledger", f"{root}/_checkpoint")

    part = F.crc32("key") % 3
    send(named.filter(part != 0).unionByName(named.filter(part == 1)).unionByName(absent), 1)
    send(named.filter(part != 1).unionByName(other), 2)
    return clean_sales(kept_rows(staged_notices(spark, f"{root}/staged", f"{root}/ledger")), as_of=AS_OF).select(*ROUNDTRIP_COLUMNS)


# ------------------------------------------------------------------- quality states

WATCHED = ("amount", "customer_id", "sale_date")
POINTS = (0.05, 0.25, 0.5, 0.75, 0.95)
DISTINCT_ERROR = 0.05  # three standard errors


def _as_number(c: str) -> Column:
    return (F.unix_date(c) if c == "sale_date" else F.col(c)).cast("double")


def q_quality_state(spark: SparkSession, sf: str) -> DataFrame:
    """A state per order year, one of them written twice, merged; estimates are held
    against the exact distinct counts and ranks of all rows."""
    store = scratch_path(spark, "quality-states")
    sales = orders_as_sales(load(spark, sf, "orders"), null_customer_every=10)
    states = quality_state(sales.withColumn("year", F.year("sale_date")), WATCHED, ["year"])
    save_states(states.filter("year < 1996"), store, "old")
    save_states(states.filter("year >= 1996"), store, "new")
    save_states(states.filter("year >= 1996"), store, "new")
    told = summarize(merge_states(load_states(spark, store)), POINTS)
    values = sales.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column_name"), _as_number(c).alias("v")) for c in WATCHED))))
    q = lambda i: F.col("quantiles")[i]
    # A handful of summary rows: the planner sees that and sends them to the values.
    ranks = (
        values.join(told.select("column_name", "quantiles"), "column_name")
        .groupBy("column_name")
        .agg(
            F.count_distinct("v").alias("exact"),
            *(F.try_divide(F.count_if(F.col("v") < q(i)), F.count("v")).alias(f"_below{i}") for i in range(len(POINTS))),
            *(F.try_divide(F.count_if(F.col("v") <= q(i)), F.count("v")).alias(f"_upto{i}") for i in range(len(POINTS))),
        )
    )
    within = F.lit(True)
    for i, p in enumerate(POINTS):
        within = within & (F.col(f"_below{i}") <= p + RANK_ERROR) & (F.col(f"_upto{i}") >= p - RANK_ERROR)
    close = F.abs(F.col("distinct") - F.col("exact")) <= F.greatest(F.col("exact") * DISTINCT_ERROR, F.lit(1.0))
    return told.join(ranks, "column_name").select(
        "column_name", "n_rows", "n_nulls", "n_broken", "low", "high", close.alias("distinct_within"), within.alias("quantiles_within")
    )


DRIFT_RULES = tuple(DriftRule("amount", kind, 0.15) for kind in ("psi", "ks", "null_share")) + (DriftRule("customer_id", "distinct", 0.15),)


def q_quality_drift(spark: SparkSession, sf: str) -> DataFrame:
    """A run against one of the same distribution, one with amounts up by half, one
    that lost a third of its amounts, and one with half the customers."""
    sales = orders_as_sales(load(spark, sf, "orders"))
    half = F.col("sale_id") % 2 == 0
    old, new = sales.filter(half), sales.filter(~half)
    state = lambda d: merge_states(quality_state(d, ("amount", "customer_id")))
    lost = F.when(F.floor(F.col("sale_id") / 2) % 3 != 0, F.col("amount"))
    cases = {
        "reshuffled": new,
        "amounts_up": new.withColumn("amount", F.col("amount") * 1.5),
        "amounts_lost": new.withColumn("amount", lost),
        "customers_merged": new.withColumn("customer_id", F.floor(F.col("customer_id") / 2)),
    }
    before, out = materialize(state(old), "quality-before"), None
    for name, run in cases.items():
        told = drift(before, state(run), DRIFT_RULES).select(F.lit(name).alias("case_name"), "column_name", "kind", "passed")
        out = told if out is None else out.unionByName(told)
    return out


DRIFT_SQL = """WITH sides AS (
  SELECT o_orderkey AS k, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount, o_custkey AS customer_id FROM orders),
old AS (SELECT amount, customer_id FROM sides WHERE k % 2 = 0),
cases AS (
  SELECT 'reshuffled' AS case_name, amount, customer_id FROM sides WHERE k % 2 <> 0
  UNION ALL SELECT 'amounts_up', amount * 1.5, customer_id FROM sides WHERE k % 2 <> 0
  UNION ALL SELECT 'amounts_lost', CASE WHEN (k // 2) % 3 <> 0 THEN amount END, customer_id FROM sides WHERE k % 2 <> 0
  UNION ALL SELECT 'customers_merged', amount, customer_id // 2 FROM sides WHERE k % 2 <> 0),
points AS (
  SELECT case_name, amount AS v, 0 AS o, 1 AS n FROM cases WHERE amount IS NOT NULL
  UNION ALL SELECT c.case_name, old.amount, 1, 0 FROM old, (SELECT DISTINCT case_name FROM cases) c),
upto AS (
  SELECT case_name, SUM(o) OVER w / SUM(o) OVER (PARTITION BY case_name) AS fo, SUM(n) OVER w / SUM(n) OVER (PARTITION BY case_name) AS fn
  FROM points WINDOW w AS (PARTITION BY case_name ORDER BY v)),
tenths AS (SELECT quantile_disc(amount, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS ts FROM old),
bins AS (
  SELECT case_name, len(list_filter(ts, lambda t: v > t)) AS bin, SUM(o) AS o, SUM(n) AS n FROM points, tenths GROUP BY ALL),
shares AS (
  SELECT case_name, greatest(o / SUM(o) OVER (PARTITION BY case_name), 0.0001) AS so, greatest(n / SUM(n) OVER (PARTITION BY case_name), 0.0001) AS sn
  FROM bins),
told AS (
  SELECT case_name, 'amount' AS column_name, 'ks' AS kind, MAX(abs(fn - fo)) AS value FROM upto GROUP BY case_name
  UNION ALL SELECT case_name, 'amount', 'psi', SUM((sn - so) * ln(sn / so)) FROM shares GROUP BY case_name
  UNION ALL SELECT case_name, 'amount', 'null_share', COUNT(*) FILTER (WHERE amount IS NULL) / COUNT(*) FROM cases GROUP BY case_name
  UNION ALL SELECT case_name, 'customer_id', 'distinct',
    abs(COUNT(DISTINCT customer_id) - (SELECT COUNT(DISTINCT customer_id) FROM old)) / (SELECT COUNT(DISTINCT customer_id) FROM old)
  FROM cases GROUP BY case_name)
SELECT case_name, column_name, kind, value <= 0.15 AS passed FROM told"""


# ------------------------------------------------------------------------ publishing


def q_published_sales(spark: SparkSession, sf: str) -> DataFrame:
    """A reader of the catalog after the first run, after a run that failed, and after
    the next good one; the failed run changes nothing."""
    root, database = scratch_path(spark, "published"), f"published_{uuid.uuid4().hex[:12]}"
    told: list[DataFrame] = []

    def read(case: str) -> None:
        seen = spark.table(f"{database}.processed_sales")
        told.append(seen.select(F.lit(case).alias("case_name"), "sale_id", "customer_id", "amount", "running_total", "customer_segment"))

    write_orders_csv(spark, sf, f"{root}/raw/sales/drop=1", "early")
    publish_sales(spark, f"{root}/raw", f"{root}/out", AS_OF, database)
    read("first")
    try:
        publish_sales(spark, f"{root}/none", f"{root}/out", AS_OF, database)
    except Exception:  # raised by the job; what its readers see is what is asked for
        pass
    read("failed")
    write_orders_csv(spark, sf, f"{root}/raw/sales/drop=2", "late")
    publish_sales(spark, f"{root}/raw", f"{root}/out", AS_OF, database)
    read("second")
    return told[0].unionByName(told[1]).unionByName(told[2])


def _published(case: str, rows: str) -> str:
    return f"""SELECT '{case}' AS case_name, * FROM (WITH {TEXT_SALES.replace("FROM orders", rows)}, {clean('text_sales')}, {METRICS}, {SEGMENTS}
SELECT m.sale_id, m.customer_id, m.amount, m.running_total, s.customer_segment FROM metrics m LEFT JOIN segments s USING (customer_id))"""


# ---------------------------------------------------------------- sources and outputs


def q_json_raw(spark: SparkSession, sf: str) -> DataFrame:
    """A5: raw sales as JSON lines, read with the declared types."""
    root = scratch_path(spark, "json-raw")
    orders_as_sales(load(spark, sf, "orders")).write.json(f"{root}/sales/part=1")
    return clean_sales(read_raw(spark, f"{root}/sales", RAW_SALES, fmt="json"), as_of=AS_OF).select(*ROUNDTRIP_COLUMNS)


def q_plain_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A10: cleaned customers, written as plain Parquet twice (the second replaces the first)."""
    path = scratch_path(spark, "customers-plain")
    customers = clean_customers(raw_customer_rows(spark, sf), AS_OF)
    write_plain(customers.filter(F.lit(False)), path)
    write_plain(customers, path)
    return local_times(spark.read.parquet(path))


def q_customers_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned customers, partitioned by registration year."""
    path = scratch_path(spark, "customers-partitioned")
    write_partitioned(clean_customers(raw_customer_rows(spark, sf), AS_OF), path, ["registration_year"], spread_by=["customer_id"])
    return local_times(spark.read.parquet(path))


def q_customer_lineage(spark: SparkSession, sf: str) -> DataFrame:
    """Where each customer's row comes from."""
    rows = customer_lineage(clean_customers(raw_customer_rows(spark, sf), AS_OF), "raw/customers/", AS_OF)
    return rows.select("customer_id", "data_lineage.job_name", "data_lineage.processed_at", "data_lineage.source_path")


def q_run_events(spark: SparkSession, sf: str) -> DataFrame:
    """What both jobs log over the whole tables, and a run without its input."""
    root = scratch_path(spark, "run-events")
    write_orders_csv(spark, sf, f"{root}/raw/sales/drop=1")
    raw = raw_customer_rows(spark, sf).select(*RAW_CUSTOMER_SCHEMA.names)
    raw.write.option("header", "true").csv(f"{root}/raw/customers/drop=1")
    run_sales_job(spark, f"{root}/raw", f"{root}/out", AS_OF)
    run_customer_job(spark, f"{root}/raw", f"{root}/out", AS_OF)
    try:
        run_customer_job(spark, f"{root}/none", f"{root}/out", AS_OF)
    except Exception:  # the job logs its failure and raises; the log is what is asked for
        pass
    told = F.from_json(
        "detail", "job_name string, status string, records_processed bigint, raw_records bigint, total_records bigint, error_message string"
    )
    return read_events(spark, f"{root}/out/pipeline_events").withColumn("d", told).select(
        "event_type", "d.job_name", "d.status", "d.records_processed", F.coalesce("d.total_records", "d.raw_records").alias("records_read"),
        F.col("d.error_message").isNotNull().alias("has_error"),
    )


QUERIES = {
    "readiness_stream": q_readiness_stream,
    "notice_ingest": q_notice_ingest,
    "quality_state": q_quality_state,
    "quality_drift": q_quality_drift,
    "published_sales": q_published_sales,
    "json_raw": q_json_raw,
    "plain_roundtrip": q_plain_roundtrip,
    "customers_partitioned": q_customers_partitioned,
    "customer_lineage": q_customer_lineage,
    "run_events": q_run_events,
}

STATE_SQL = """WITH sales AS (
  SELECT CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount,
         CAST(CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_custkey END AS DOUBLE) AS customer_id,
         CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS sale_date FROM orders),
long AS (
  SELECT 'amount' AS column_name, amount AS v FROM sales UNION ALL SELECT 'customer_id', customer_id FROM sales
  UNION ALL SELECT 'sale_date', sale_date FROM sales)
SELECT column_name, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE v IS NULL) AS n_nulls, CAST(0 AS BIGINT) AS n_broken,
       MIN(v) AS low, MAX(v) AS high, true AS distinct_within, true AS quantiles_within
FROM long GROUP BY column_name"""

SQL = {
    "readiness_stream": BASE_SQL["readiness_gate"],
    "notice_ingest": f"WITH {TEXT_SALES}, {clean('text_sales')} {ROUNDTRIP}",
    "quality_state": STATE_SQL,
    "quality_drift": DRIFT_SQL,
    "published_sales": " UNION ALL ".join(
        [_published(c, "FROM orders WHERE o_orderdate < DATE '1998-01-01'") for c in ("first", "failed")] + [_published("second", "FROM orders")]
    ),
    "json_raw": f"WITH {TEXT_SALES}, {clean('text_sales')} {ROUNDTRIP}",
    "plain_roundtrip": BASE_SQL["processed_customers"],
    "customers_partitioned": BASE_SQL["processed_customers"],
    "customer_lineage": f"WITH {RAW_CUSTOMERS}, {DEDUP} SELECT CAST(customer_id AS VARCHAR) AS customer_id, 'customer_data_etl' AS job_name, {TS} AS processed_at, "
    "'raw/customers/' AS source_path FROM dedup",
    "run_events": f"""WITH {ORDERS_SALES}, {clean('orders_sales')}, {RAW_CUSTOMERS}, {DEDUP}
SELECT 'ETL Job Completed' AS event_type, 'sales-data-etl' AS job_name, 'SUCCESS' AS status,
       (SELECT COUNT(*) FROM clean) AS records_processed, (SELECT COUNT(*) FROM orders) AS records_read, false AS has_error
UNION ALL SELECT 'ETL Job Completed', 'customer-data-etl', 'SUCCESS', (SELECT COUNT(*) FROM dedup), (SELECT COUNT(*) FROM raw_customers), false
UNION ALL SELECT 'Data Quality Check', 'customer-data-etl', NULL, NULL,
       (SELECT COUNT(*) FROM raw_customers), false
UNION ALL SELECT 'ETL Job Failed', 'customer-data-etl', 'FAILED', NULL, NULL, true""",
}
