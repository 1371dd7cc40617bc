"""Registered queries: each maps the given tables through the library's operators.

Every query reads whole tables (no id subsets, no row caps). Run-time constants
(``AS_OF`` and the rule parameters) are fixed here so the SQL oracle in
``tidemark.plans.oracle`` can state the same values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.constants import CUSTOMER_JOB, SALES_JOB
from tidemark.functions import age_group, email_domain, full_name
from tidemark.operators.customers import clean_customers, dedup_latest, enrich_customers, map_customers
from tidemark.operators.drift import infer_types, schema_drift
from tidemark.operators.events import (
    classify_events,
    job_failures,
    job_metrics,
    job_run_metrics,
    job_outcomes,
    match_rules,
    orchestration_log,
    readiness,
    route_events,
    validate_manifest,
)
from tidemark.operators.metrics import business_metrics, order_rank, running_total, top_orders
from tidemark.operators.quality import (
    Rule,
    check,
    customer_quality,
    orphans,
    quality_score,
    sales_quality,
)
from tidemark.operators.sales import as_of_literal, clean_sales, reject_sales
from tidemark.operators.segments import (
    attach_segments,
    customer_segments,
    enrich_sales,
    segment_distribution,
)
from tidemark.plans.sales_job import process_sales
from tidemark.session import scratch_path
from tidemark.sinks import write_partitioned
from tidemark.sources.events import malformed_events, parse_bus_events, parse_manifest
from tidemark.sources.files import CORRUPT_COLUMN, read_customers, read_sales
from tidemark.streaming.ingest import (
    current_gold,
    current_segments,
    ingest_and_refresh,
    ingest_sales,
    staged_clean,
    stream_segments,
)
from tidemark.sources.tables import (
    bus_records,
    customer_as_sales,
    customer_contacts,
    events_as_sales,
    job_runs,
    load,
    manifest_records,
    orders_as_sales,
    orders_with_hot_customer,
    part_ages,
    raw_customers,
    start_reports,
)

AS_OF = "2024-06-01 00:00:00"
QUALITY_AS_OF = "2001-12-31 00:00:00"
TOP_K = 3
RAW_BUCKETS = ("raw-view",)
WATCHED_JOBS = (f"data-pipeline-{CUSTOMER_JOB}-dev",)
REQUIRED_JOBS = (f"data-pipeline-{CUSTOMER_JOB}-dev", f"data-pipeline-{SALES_JOB}-dev")

QUALITY_RULES = (
    Rule("customer_id_present", "not_null", "customer_id", weight=3.0),
    Rule("sale_id_unique", "unique", "sale_id", weight=3.0),
    Rule("amount_in_range", "range", "amount", low=0.01, high=400000.0, threshold=99.0),
    Rule("status_allowed", "allowed", "product_id", values=("F", "O"), threshold=95.0),
    Rule("customer_known", "reference", "customer_id", weight=2.0, threshold=90.0),
    Rule("sale_recent", "freshness", "sale_date", max_age_days=1800, threshold=50.0),
)

SalesQuery = Callable[[SparkSession, str], DataFrame]


# ------------------------------------------------------------------ shared inputs


def orders_clean(spark: SparkSession, sf: str) -> DataFrame:
    return clean_sales(orders_as_sales(load(spark, sf, "orders")), as_of=AS_OF)


def events_clean(spark: SparkSession, sf: str) -> DataFrame:
    return clean_sales(events_as_sales(load(spark, sf, "events")), as_of=AS_OF)


def raw_customer_rows(spark: SparkSession, sf: str) -> DataFrame:
    return raw_customers(load(spark, sf, "orders"), load(spark, sf, "customer"))


def active_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with a positive balance: the reference table for C2 and the rules."""
    return (
        load(spark, sf, "customer")
        .filter(F.col("c_acctbal") > 0)
        .select(F.col("c_custkey").alias("customer_id"))
    )


# ------------------------------------------------------------------------ queries


def q_customer_segments(spark: SparkSession, sf: str) -> DataFrame:
    return customer_segments(orders_clean(spark, sf))


def q_segment_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return segment_distribution(customer_segments(orders_clean(spark, sf)))


def q_sales_enriched(spark: SparkSession, sf: str) -> DataFrame:
    return events_clean(spark, sf)


def q_amount_bands(spark: SparkSession, sf: str) -> DataFrame:
    return (
        events_clean(spark, sf)
        .groupBy("amount_category")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum("amount").cast("decimal(38,2)").alias("total_amount"),
        )
    )


def q_business_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return business_metrics(orders_clean(spark, sf), strategy="auto")


def q_business_metrics_skew_safe(spark: SparkSession, sf: str) -> DataFrame:
    return business_metrics(orders_clean(spark, sf), strategy="skew_safe")


HOT_MAX_ROWS = 1000


def q_business_metrics_hot_customer(spark: SparkSession, sf: str) -> DataFrame:
    """A third of the orders under one customer; ``auto`` sends that customer's rows
    to the skew-safe plan and all others to the window plan."""
    sales = clean_sales(orders_with_hot_customer(load(spark, sf, "orders")), as_of=AS_OF)
    return process_sales(sales, "auto", max_rows=HOT_MAX_ROWS)


def q_order_rank_in_month(spark: SparkSession, sf: str) -> DataFrame:
    return order_rank(orders_clean(spark, sf)).select(
        "sale_id", "customer_id", "sales_month", "amount", "order_rank_in_month"
    )


def q_order_rank_skew_safe(spark: SparkSession, sf: str) -> DataFrame:
    return order_rank(events_clean(spark, sf), strategy="skew_safe").select(
        "sale_id", "customer_id", "sales_month", "amount", "order_rank_in_month"
    )


def q_running_total(spark: SparkSession, sf: str) -> DataFrame:
    return running_total(events_clean(spark, sf)).select(
        "sale_id", "customer_id", "sale_date", "amount", "running_total"
    )


def q_top_orders(spark: SparkSession, sf: str) -> DataFrame:
    return top_orders(orders_clean(spark, sf), k=TOP_K).select(
        "sale_id", "customer_id", "sales_month", "amount", "order_rank_in_month"
    )


def q_sales_with_segments(spark: SparkSession, sf: str) -> DataFrame:
    """The sales job's output: metrics plus segment columns in one plan (C1 without
    a join when no customer is hot; see process_sales)."""
    return process_sales(orders_clean(spark, sf))


def q_segments_join(spark: SparkSession, sf: str) -> DataFrame:
    """C1 as the reference writes it: a left join of segment columns onto each sale."""
    sales = orders_clean(spark, sf)
    return attach_segments(sales, customer_segments(sales)).select(
        "customer_id", "sale_id", "amount", "customer_segment", "total_spent", "total_orders"
    )


def q_customer_quality_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return customer_quality(raw_customer_rows(spark, sf), job_name=CUSTOMER_JOB)


def q_sales_quality_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return sales_quality(customer_as_sales(load(spark, sf, "customer")))


def q_dedup_customers(spark: SparkSession, sf: str) -> DataFrame:
    raw = raw_customer_rows(spark, sf)
    return dedup_latest(raw.filter(F.col("customer_id").isNotNull()))


def local_times(customers: DataFrame) -> DataFrame:
    """The contract's instant as the time of day it was given as, whatever the session's zone."""
    return customers.withColumn("processed_timestamp", F.col("processed_timestamp").cast("timestamp_ntz"))


def q_processed_customers(spark: SparkSession, sf: str) -> DataFrame:
    return local_times(clean_customers(raw_customer_rows(spark, sf), as_of=AS_OF))


def q_mapped_customers(spark: SparkSession, sf: str) -> DataFrame:
    """B12 alone: every raw customer row (no filter, no dedup) enriched and mapped
    to the 13-column contract with its explicit casts."""
    return local_times(map_customers(enrich_customers(raw_customer_rows(spark, sf), as_of=AS_OF)))


def q_age_groups(spark: SparkSession, sf: str) -> DataFrame:
    return part_ages(load(spark, sf, "part")).withColumn("age_group", age_group("age"))


def q_email_domain(spark: SparkSession, sf: str) -> DataFrame:
    return customer_contacts(load(spark, sf, "customer")).select(
        F.col("c_custkey").alias("customer_id"), "email", email_domain("email").alias("email_domain")
    )


def q_full_name(spark: SparkSession, sf: str) -> DataFrame:
    return customer_contacts(load(spark, sf, "customer")).select(
        F.col("c_custkey").alias("customer_id"),
        "first_name",
        "last_name",
        full_name("first_name", "last_name").alias("full_name"),
    )


def q_orphan_orders(spark: SparkSession, sf: str) -> DataFrame:
    return orphans(orders_clean(spark, sf), active_customers(spark, sf)).select(
        "sale_id", "customer_id", "amount", "sale_date"
    )


def q_quality_report(spark: SparkSession, sf: str) -> DataFrame:
    """I6/I8 on the orders, whose status is missing on every eleventh."""
    status = F.when(F.col("sale_id") % 11 != 0, F.col("product_id"))
    return check(
        orders_clean(spark, sf).withColumn("product_id", status),
        QUALITY_RULES,
        "processed_sales",
        references={"customer_known": active_customers(spark, sf)},
        as_of=as_of_literal(QUALITY_AS_OF),
    )


def q_quality_score(spark: SparkSession, sf: str) -> DataFrame:
    return quality_score(q_quality_report(spark, sf))


def q_reject_rows(spark: SparkSession, sf: str) -> DataFrame:
    return reject_sales(customer_as_sales(load(spark, sf, "customer")), as_of=AS_OF).select(
        "sale_id", "customer_id", "amount", "reject_reason"
    )


def q_manifest_validation(spark: SparkSession, sf: str) -> DataFrame:
    records = parse_manifest(manifest_records(load(spark, sf, "events")))
    return validate_manifest(records)


def q_event_routing(spark: SparkSession, sf: str) -> DataFrame:
    events = parse_bus_events(bus_records(load(spark, sf, "events")))
    routed = route_events(classify_events(events))
    return match_rules(routed, RAW_BUCKETS, WATCHED_JOBS).select(
        "event_id", "event_class", "action", "target", "arguments", "matched_rule"
    )


def q_orchestration_log(spark: SparkSession, sf: str) -> DataFrame:
    source = load(spark, sf, "events")
    events = parse_bus_events(bus_records(source).withColumn("original_event", F.col("body")))
    return orchestration_log(route_events(classify_events(events)), as_of_literal(AS_OF), start_reports(source))


def q_malformed_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events whose JSON was cut, or is missing, kept with a reason."""
    records = bus_records(load(spark, sf, "events"))
    cut = F.when(F.col("event_id") % 13 == 0, F.expr("left(body, length(body) - 2)")).otherwise(F.col("body"))
    broken = records.withColumn("body", F.when(F.col("event_id") % 17 != 0, cut))
    return malformed_events(broken).select("event_id", "reject_reason")


def q_job_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return job_outcomes(job_runs(load(spark, sf, "events")))


def q_job_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return job_metrics(job_runs(load(spark, sf, "events")), finished_only=False)


def q_job_failures(spark: SparkSession, sf: str) -> DataFrame:
    return job_failures(job_runs(load(spark, sf, "events")), as_of_literal(AS_OF))


def q_job_run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return job_run_metrics(job_runs(load(spark, sf, "events")), as_of_literal(AS_OF))


def q_clean_sales_rules(spark: SparkSession, sf: str) -> DataFrame:
    """B1/B2 on rows that fail them: account balances as amounts, some null customers."""
    sales = customer_as_sales(load(spark, sf, "customer"))
    return clean_sales(sales, as_of=AS_OF).select("sale_id", "customer_id", "amount", "amount_category")


def q_business_metrics_null_customer(spark: SparkSession, sf: str) -> DataFrame:
    """E6 by both plans on rows with hot null and non-null customers: no group is hot
    above the limit, all are below it."""
    orders = orders_as_sales(load(spark, sf, "orders"))
    customer = (
        F.when(F.col("sale_id") % 5 == 0, F.lit(None))
        .when(F.col("sale_id") % 3 == 0, F.lit(-1))
        .otherwise(F.col("customer_id"))
    )
    sales = orders.select(
        "sale_id", customer.cast("bigint").alias("customer_id"), "amount", "sale_date",
        F.year("sale_date").alias("sales_year"), F.month("sale_date").alias("sales_month"),
    )
    above = business_metrics(sales, "auto", max_rows=1 << 40).withColumn("limit_kind", F.lit("above"))
    below = business_metrics(sales, "auto", max_rows=20).withColumn("limit_kind", F.lit("below"))
    return above.unionByName(below)


def q_readiness_gate(spark: SparkSession, sf: str) -> DataFrame:
    return readiness(
        job_runs(load(spark, sf, "events")), REQUIRED_JOBS, labels=("customer_state", "sales_state")
    )


# ------------------------------------------------------- sources, sinks, streams

ROUNDTRIP_COLUMNS = ("sale_id", "customer_id", "amount", "sale_date", "sales_year", "sales_month", "amount_category")


def write_orders_csv(spark: SparkSession, sf: str, folder: str, batch: str = "all") -> None:
    """Raw sales CSV files from orders; ``batch`` splits arrival into before/after 1998."""
    raw = orders_as_sales(load(spark, sf, "orders"))
    if batch == "early":
        raw = raw.filter(F.col("sale_date") < F.lit("1998-01-01").cast("date"))
    elif batch == "late":
        raw = raw.filter(F.col("sale_date") >= F.lit("1998-01-01").cast("date"))
    raw.write.mode("append").option("header", "true").csv(folder)


def q_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A1/A2: raw CSV (text ids) read back with the declared schema, then cleaned."""
    root = scratch_path(spark, "csv-roundtrip")
    write_orders_csv(spark, sf, f"{root}/sales/part=1")
    return clean_sales(read_sales(spark, root), as_of=AS_OF).select(*ROUNDTRIP_COLUMNS)


def q_customers_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A1: raw customers as CSV with its columns in another order, one column too many, and
    every ninth order's age as text: those lines are marked, and the rest is read by name."""
    root = scratch_path(spark, "customers-csv")
    raw = raw_customer_rows(spark, sf)
    age = F.when(F.col("age") % 9 == 0, F.lit("n/a")).otherwise(F.col("age").cast("string"))
    mixed = raw.select("email", age.alias("age"), "customer_id", F.lit("x").alias("channel"), *(
        c for c in reversed(raw.columns) if c not in ("email", "age", "customer_id")
    ))
    mixed.write.option("header", "true").csv(f"{root}/customers/part=1")
    read = read_customers(spark, root, keep_corrupt=True)
    bad = F.col(CORRUPT_COLUMN).isNotNull()
    return read.select(*raw.columns, bad.alias("malformed")).withColumn("customer_id", F.col("customer_id").cast("bigint"))


def q_partitioned_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Processed sales written hive-partitioned, partitions recovered on read."""
    path = scratch_path(spark, "sales-partitioned")
    write_partitioned(
        process_sales(orders_clean(spark, sf)), path, ["sales_year", "sales_month"], spread_by=["customer_id"]
    )
    return spark.read.parquet(path).select(
        "sale_id", "customer_id", "amount", "sale_date", "sales_year", "sales_month",
        "monthly_total", "order_rank_in_month", "running_total", "customer_segment",
    )


def q_incremental_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """A4/K1: files arrive in two drops; each stream run ingests only the new ones."""
    root = scratch_path(spark, "ingest")
    raw, staged, ckpt = f"{root}/raw", f"{root}/staged", f"{root}/_checkpoint"
    write_orders_csv(spark, sf, f"{raw}/drop=1", "early")
    ingest_sales(spark, raw, staged, ckpt)
    write_orders_csv(spark, sf, f"{raw}/drop=2", "late")
    ingest_sales(spark, raw, staged, ckpt)
    ingest_sales(spark, raw, staged, ckpt)  # nothing new: adds no rows
    return staged_clean(spark, staged, AS_OF).select(*ROUNDTRIP_COLUMNS)


def q_incremental_gold_eager(spark: SparkSession, sf: str) -> DataFrame:
    """§7.4, written out at once (``arrivals.q_incremental_gold`` merges when read): two drops of files; each micro-batch refreshes only the customers it touched."""
    root = scratch_path(spark, "gold-refresh")
    raw, staged, gold, ckpt = f"{root}/raw", f"{root}/staged", f"{root}/gold", f"{root}/_checkpoint"
    write_orders_csv(spark, sf, f"{raw}/drop=1", "early")
    ingest_and_refresh(spark, raw, staged, gold, ckpt, as_of=AS_OF)
    write_orders_csv(spark, sf, f"{raw}/drop=2", "late")
    ingest_and_refresh(spark, raw, staged, gold, ckpt, as_of=AS_OF)
    return current_gold(spark, gold).select(
        "sale_id", "customer_id", "amount", "sale_date", "monthly_total", "yearly_total",
        "order_rank_in_month", "running_total", "customer_segment", "total_orders",
    )


def q_rolling_segments(spark: SparkSession, sf: str) -> DataFrame:
    """K4: segments maintained by a stateful stream across two drops of files."""
    root = scratch_path(spark, "segments-stream")
    raw, updates, ckpt = f"{root}/raw", f"{root}/updates", f"{root}/_checkpoint"
    write_orders_csv(spark, sf, f"{raw}/drop=1", "early")
    stream_segments(spark, raw, updates, ckpt)
    write_orders_csv(spark, sf, f"{raw}/drop=2", "late")
    stream_segments(spark, raw, updates, ckpt)
    return current_segments(spark, updates)


def orders_text_versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two arrivals of one raw table as text: the later one drops o_orderstatus,
    adds a boolean o_channel, codes with leading zeros, integers of 23 digits, numbers
    with exponents and times, writes some customer keys as codes ('C-…') and the
    priority as its leading digit."""
    o = load(spark, sf, "orders")
    old = o.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        "o_orderpriority",
    )
    new = o.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("C-"), F.col("o_custkey").cast("string")))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("o_custkey"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        F.substring("o_orderpriority", 1, 1).alias("o_orderpriority"),
        F.when(F.col("o_orderstatus") == "F", F.lit("true")).otherwise(F.lit("false")).alias("o_channel"),
        F.lpad((F.col("o_orderkey") % 90000).cast("string"), 5, "0").alias("o_zip"),
        F.concat(F.lit("7"), F.lpad(F.col("o_orderkey").cast("string"), 22, "0")).alias("o_wide"),
        F.concat((F.col("o_orderkey") % 9 + 1).cast("string"), F.lit("e5")).alias("o_rate"),
        F.concat(
            F.date_format("o_orderdate", "yyyy-MM-dd"),
            F.when(F.col("o_orderkey") % 4 == 0, F.lit("")).otherwise(F.lit(" 12:30:05")),
        ).alias("o_at"),
    )
    return old, new


def q_schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    old, new = orders_text_versions(spark, sf)
    return schema_drift(infer_types(old), infer_types(new))


def q_inferred_types(spark: SparkSession, sf: str) -> DataFrame:
    return infer_types(orders_text_versions(spark, sf)[1])


def q_sales_customer_enriched(spark: SparkSession, sf: str) -> DataFrame:
    """Processed sales joined to processed customers (inner, on customer_id)."""
    sales = orders_clean(spark, sf).select("sale_id", "customer_id", "amount", "sale_date")
    customers = clean_customers(raw_customer_rows(spark, sf), as_of=AS_OF).select(
        "customer_id", "full_name", "age_group", "email_domain", "registration_year"
    )
    return enrich_sales(sales, customers)


QUERIES: dict[str, SalesQuery] = {
    "customer_segments": q_customer_segments,
    "segment_distribution": q_segment_distribution,
    "sales_enriched": q_sales_enriched,
    "amount_bands": q_amount_bands,
    "business_metrics": q_business_metrics,
    "business_metrics_skew_safe": q_business_metrics_skew_safe,
    "business_metrics_hot_customer": q_business_metrics_hot_customer,
    "order_rank_in_month": q_order_rank_in_month,
    "order_rank_skew_safe": q_order_rank_skew_safe,
    "running_total": q_running_total,
    "top_orders": q_top_orders,
    "sales_with_segments": q_sales_with_segments,
    "segments_join": q_segments_join,
    "customer_quality_metrics": q_customer_quality_metrics,
    "sales_quality_metrics": q_sales_quality_metrics,
    "dedup_customers": q_dedup_customers,
    "processed_customers": q_processed_customers,
    "mapped_customers": q_mapped_customers,
    "age_groups": q_age_groups,
    "email_domain": q_email_domain,
    "full_name": q_full_name,
    "orphan_orders": q_orphan_orders,
    "quality_report": q_quality_report,
    "quality_score": q_quality_score,
    "reject_rows": q_reject_rows,
    "manifest_validation": q_manifest_validation,
    "event_routing": q_event_routing,
    "orchestration_log": q_orchestration_log,
    "malformed_events": q_malformed_events,
    "job_outcomes": q_job_outcomes,
    "job_metrics": q_job_metrics,
    "job_failures": q_job_failures,
    "job_run_metrics": q_job_run_metrics,
    "clean_sales_rules": q_clean_sales_rules,
    "business_metrics_null_customer": q_business_metrics_null_customer,
    "readiness_gate": q_readiness_gate,
    "csv_roundtrip": q_csv_roundtrip,
    "customers_csv_roundtrip": q_customers_csv_roundtrip,
    "partitioned_roundtrip": q_partitioned_roundtrip,
    "incremental_ingest": q_incremental_ingest,
    "rolling_segments": q_rolling_segments,
    "incremental_gold_eager": q_incremental_gold_eager,
    "schema_drift": q_schema_drift,
    "inferred_types": q_inferred_types,
    "sales_customer_enriched": q_sales_customer_enriched,
}

