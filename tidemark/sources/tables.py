"""Adapters from the given parquet tables to the pipeline's raw shapes.

Each adapter is a projection (plus, for raw customers, one join), so it runs
wherever the tables live and grows with them. Edge cases the pipeline must handle
(null ids, bad date text, missing '@', null ages) are derived deterministically
from key columns, so the same rows are edge rows in Spark and in the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.constants import AMOUNT_TYPE, CUSTOMER_JOB, SALES_JOB
from tidemark.functions import job_full_name


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def orders_as_sales(orders: DataFrame, null_customer_every: int | None = None) -> DataFrame:
    """orders → (sale_id, customer_id, product_id, product_name, amount, sale_date)."""
    cust = F.col("o_custkey")
    if null_customer_every:
        cust = _null_when(F.col("o_orderkey") % null_customer_every == 0, cust)
    return orders.select(
        F.col("o_orderkey").alias("sale_id"),
        cust.alias("customer_id"),
        F.col("o_orderstatus").alias("product_id"),
        F.col("o_orderpriority").alias("product_name"),
        F.col("o_totalprice").cast(AMOUNT_TYPE).alias("amount"),
        F.to_date("o_orderdate").alias("sale_date"),
    )


def orders_with_hot_customer(orders: DataFrame, every: int = 3, hot_key: int = -1) -> DataFrame:
    """orders as sales where every ``every``-th order belongs to one hot customer:
    a third of all rows under one key, growing with the table."""
    sales = orders_as_sales(orders)
    return sales.withColumn(
        "customer_id",
        F.when(F.col("sale_id") % every == 0, F.lit(hot_key).cast("bigint")).otherwise(F.col("customer_id")),
    )


def events_as_sales(events: DataFrame, scale: int = 4, bad_date_every: int = 97) -> DataFrame:
    """events → raw sales with date *text*; every ``bad_date_every``-th id gets 'bad'.

    Amounts are scaled (as decimals) so all four amount bands occur.
    """
    date_text = F.when(F.col("event_id") % bad_date_every == 0, F.lit("bad")).otherwise(
        F.date_format("ts", "yyyy-MM-dd")
    )
    return events.select(
        F.col("event_id").alias("sale_id"),
        F.col("user_id").alias("customer_id"),
        F.col("event_type").alias("product_id"),
        F.col("props").alias("product_name"),
        (F.col("value").cast(AMOUNT_TYPE) * F.lit(scale)).cast(AMOUNT_TYPE).alias("amount"),
        date_text.alias("sale_date"),
    )


def customer_as_sales(customer: DataFrame, null_customer_every: int = 10) -> DataFrame:
    """customer → raw sales whose amount is the account balance (some are <= 0)."""
    return customer.select(
        F.col("c_custkey").alias("sale_id"),
        _null_when(F.col("c_custkey") % null_customer_every == 0, F.col("c_custkey")).alias(
            "customer_id"
        ),
        F.col("c_mktsegment").alias("product_id"),
        F.col("c_name").alias("product_name"),
        F.col("c_acctbal").cast(AMOUNT_TYPE).alias("amount"),
        F.lit("2024-01-01").alias("sale_date"),
    )


def customer_contacts(customer: DataFrame, no_at_every: int = 7) -> DataFrame:
    """customer → (c_custkey, first_name, last_name, email, phone).

    last_name is null for the BUILDING segment; every ``no_at_every``-th key has
    an email without '@'.
    """
    first = F.substring_index("c_name", "#", 1)
    last = _null_when(F.col("c_mktsegment") == "BUILDING", F.substring_index("c_name", "#", -1))
    local = F.concat_ws(".", F.lower(first), last)
    domain = F.concat(F.lower("c_mktsegment"), F.lit(".com"))
    email = F.when(F.col("c_custkey") % no_at_every == 0, F.concat(local, domain)).otherwise(
        F.concat(local, F.lit("@"), domain)
    )
    phone = F.concat_ws("-", F.col("c_nationkey").cast("string"), F.col("c_custkey").cast("string"))
    return customer.select(
        "c_custkey",
        first.alias("first_name"),
        last.alias("last_name"),
        email.alias("email"),
        phone.alias("phone"),
    )


def raw_customers(
    orders: DataFrame,
    customer: DataFrame,
    null_id_every: int = 101,
    null_age_every: int = 53,
) -> DataFrame:
    """One raw customer record per order (so ~10 versions per customer to dedup), and
    one for each customer without orders.

    registration_date is the order date; the latest record per customer wins.
    """
    contacts = customer_contacts(customer)
    joined = contacts.join(orders, orders.o_custkey == contacts.c_custkey, "left")
    age = _null_when(
        F.col("o_orderkey") % null_age_every == 0, (F.col("o_orderkey") % 80 + 15).cast("int")
    )
    return joined.select(
        _null_when(F.col("o_orderkey") % null_id_every == 0, F.col("c_custkey")).alias("customer_id"),
        "first_name",
        "last_name",
        "email",
        "phone",
        age.alias("age"),
        F.col("o_orderpriority").alias("city"),
        F.col("o_orderstatus").alias("state"),
        F.to_date("o_orderdate").alias("registration_date"),
    )


def part_ages(part: DataFrame, null_age: int = 51) -> DataFrame:
    """part → (p_partkey, age) with age = p_size*2-1 (1..99), null where it equals ``null_age``."""
    age = F.col("p_size") * 2 - 1
    return part.select("p_partkey", _null_when(age == null_age, age).cast("int").alias("age"))


def _object_key(event_id: Column, null_key_every: int = 11) -> Column:
    prefix = (
        F.when(event_id % 3 == 0, F.lit("customers/"))
        .when(event_id % 3 == 1, F.lit("sales/"))
        .otherwise(F.lit("other/"))
    )
    suffix = (
        F.when(event_id % 5 <= 2, F.lit(".csv"))
        .when(event_id % 5 == 3, F.lit(".CSV"))
        .otherwise(F.lit(".json"))
    )
    key = F.concat(prefix, event_id.cast("string"), suffix)
    return _null_when(event_id % null_key_every == 0, key)


def _bucket(event_type: Column) -> Column:
    return F.concat(F.lit("raw-"), event_type)


def manifest_records(events: DataFrame) -> DataFrame:
    """events → file-arrival notifications as JSON text: (event_id, body)."""
    record = F.struct(
        F.struct(
            F.struct(_bucket(F.col("event_type")).alias("name")).alias("bucket"),
            F.struct(_object_key(F.col("event_id")).alias("key")).alias("object"),
        ).alias("s3")
    )
    return events.select(
        "event_id", F.to_json(F.struct(F.array(record).alias("Records"))).alias("body")
    )


def bus_records(events: DataFrame) -> DataFrame:
    """events → bus events as JSON text: (event_id, body).

    view → file created; click → schedule (even ids carry the schedule marker in
    resources[0]); purchase/error → job state SUCCEEDED/FAILED; signup → other.
    """
    et = F.col("event_type")
    eid = F.col("event_id")
    source = (
        F.when(et == "view", "aws.s3")
        .when(et == "click", "aws.events")
        .when(et.isin("purchase", "error"), "aws.glue")
        .otherwise("custom.app")
    )
    detail_type = (
        F.when(et == "view", "Object Created")
        .when(et == "click", "Scheduled Event")
        .when(et.isin("purchase", "error"), "Glue Job State Change")
        .otherwise("User Signup")
    )
    resources = F.when(
        et == "click",
        F.array(
            F.when(eid % 2 == 0, F.lit("arn:rule/daily-etl-schedule Scheduled Event")).otherwise(
                F.lit("arn:rule/daily-etl-schedule")
            )
        ),
    )
    job = job_full_name(
        F.when(F.col("user_id") % 2 == 0, F.lit(CUSTOMER_JOB)).otherwise(F.lit(SALES_JOB))
    )
    is_job = et.isin("purchase", "error")
    detail = F.struct(
        F.when(et == "view", F.struct(_bucket(et).alias("name"))).alias("bucket"),
        F.when(et == "view", F.struct(_object_key(eid).alias("key"))).alias("object"),
        F.when(is_job, job).alias("jobName"),
        F.when(is_job, F.concat(F.lit("jr_"), eid.cast("string"))).alias("jobRunId"),
        F.when(et == "purchase", F.lit("SUCCEEDED")).when(et == "error", F.lit("FAILED")).alias("state"),
    )
    body = F.to_json(
        F.struct(
            source.alias("source"),
            detail_type.alias("detail-type"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("time"),
            resources.alias("resources"),
            detail.alias("detail"),
        )
    )
    return events.select("event_id", body.alias("body"))


def start_reports(events: DataFrame, refused_every: int = 8) -> DataFrame:
    """events → what a launcher reports for each: (event_id, run_id, start_error).

    Every ``refused_every``-th start is refused and has no run id.
    """
    refused = F.col("event_id") % refused_every == 0
    return events.select(
        "event_id",
        F.when(~refused, F.concat(F.lit("run_"), F.col("event_id").cast("string"))).alias("run_id"),
        F.when(refused, F.lit("Start refused")).alias("start_error"),
    )


def job_runs(events: DataFrame) -> DataFrame:
    """events → job runs: error events are FAILED runs; of the others every seventh
    still runs, every seventh was stopped, and the rest SUCCEEDED.

    execution_time_seconds is null for 'view' events (to exercise the default 0);
    error_message is null for every third failure (to exercise 'Unknown error').
    """
    et = F.col("event_type")
    return events.select(
        job_full_name(
            F.when(F.col("user_id") % 2 == 0, F.lit(CUSTOMER_JOB)).otherwise(F.lit(SALES_JOB))
        ).alias("job_name"),
        F.concat(F.lit("jr_"), F.col("event_id").cast("string")).alias("job_run_id"),
        F.when(et == "error", F.lit("FAILED"))
        .when(F.col("event_id") % 7 == 1, F.lit("RUNNING"))
        .when(F.col("event_id") % 7 == 2, F.lit("STOPPED"))
        .otherwise(F.lit("SUCCEEDED"))
        .alias("state"),
        F.col("ts").alias("started_on"),
        _null_when(et == "view", F.floor(F.col("value") * 10).cast("bigint")).alias(
            "execution_time_seconds"
        ),
        F.when(
            (et == "error") & (F.col("event_id") % 3 != 0),
            F.concat(F.lit("Task failed: "), F.col("props")),
        ).alias("error_message"),
    )
