"""Registered queries of what arrives over time: discovery, catalog, contracts, deltas, the event log.

Each writes arrivals derived from the given tables under the scratch folder, runs the
library over them arrival by arrival, and returns what a single pass over everything must
give: the SQL below states that, knowing nothing of arrivals.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.contracts import ColumnRule, apply_contract, refusal_counts
from tidemark.operators.quality import sales_quality
from tidemark.operators.sales import as_of_literal, clean_sales, reject_sales
from tidemark.plans.discovery_job import discovered, evolve_catalog, update_discovery
from tidemark.plans.oracle import INFER, ORDERS_TEXT_NEW, ORDERS_TEXT_OLD, SEGMENTS, TEXT_SALES, clean
from tidemark.plans.oracle import SQL as BASE_SQL
from tidemark.plans.queries import AS_OF, orders_text_versions, write_orders_csv
from tidemark.schemas import RAW_SALES
from tidemark.session import scratch_path
from tidemark.sources.layouts import read_mixed
from tidemark.sources.tables import bus_records, load, orders_as_sales
from tidemark.streaming.deltas import fold_gold, ingest_deltas, merged_gold, merged_segments
from tidemark.streaming.event_log import read_event_log, stream_event_log

# ------------------------------------------------------------------ discovery, catalog


def _text_arrivals(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Three arrivals: the older version in two parts, then the newer with other columns."""
    old, new = orders_text_versions(spark, sf)
    even = F.col("o_orderkey").cast("bigint") % 2 == 0
    return [old.where(even), old.where(~even), new]


def _discover(spark: SparkSession, sf: str, database: str | None = None) -> tuple[str, list[DataFrame]]:
    root, drifts = scratch_path(spark, "discovery"), []
    for i, rows in enumerate(_text_arrivals(spark, sf)):
        rows.write.option("header", "true").csv(f"{root}/raw/drop={i}")
        update_discovery(spark, f"{root}/raw", f"{root}/store")
        if database:
            drifts.append(evolve_catalog(spark, f"{root}/store", database, "orders_raw"))
    return f"{root}/store", drifts


def q_incremental_discovery(spark: SparkSession, sf: str) -> DataFrame:
    """Types over three arrivals from the stored profiles; each arrival read its own files only."""
    store, _ = _discover(spark, sf)
    return discovered(spark, store).drop("place")


def _catalog(spark: SparkSession, sf: str) -> tuple[str, list[DataFrame]]:
    database = f"discovery_{uuid.uuid4().hex[:12]}"
    _, drifts = _discover(spark, sf, database)
    return f"`{database}`.orders_raw", drifts


def q_catalog_schema(spark: SparkSession, sf: str) -> DataFrame:
    """The catalog's schema after three arrivals, with what the last one changed."""
    table, drifts = _catalog(spark, sf)
    schema = [(f.name, f.dataType.simpleString()) for f in spark.table(table).schema]
    columns = spark.createDataFrame(schema, "column_name string, catalog_type string")
    return columns.join(drifts[-1].select("column_name", "old_type", "change"), "column_name", "left")


def q_catalog_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of all arrivals through SQL, in the catalog's types."""
    table, _ = _catalog(spark, sf)
    return spark.sql(
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_channel, o_wide, o_rate, "
        f"CAST(o_at AS TIMESTAMP_NTZ) AS o_at FROM {table}"
    )


ALL_TEXT = f"{ORDERS_TEXT_OLD}, {ORDERS_TEXT_NEW}, all_text AS (SELECT * FROM old_text UNION ALL BY NAME SELECT * FROM new_text)"


# ------------------------------------------------------------------------- raw files


def q_mixed_headers(spark: SparkSession, sf: str) -> DataFrame:
    """A1, A2: sales files with three headers (order, names in capitals, a column less or more) in one read."""
    root = scratch_path(spark, "mixed-headers")
    raw = orders_as_sales(load(spark, sf, "orders"))
    part = lambda i: raw.where(F.col("sale_id") % 3 == i)
    part(0).write.option("header", "true").csv(f"{root}/sales/a")
    turned = part(1).select(*(F.col(c).alias(c.upper()) for c in reversed(raw.columns)), F.lit("web").alias("channel"))
    turned.write.option("header", "true").csv(f"{root}/sales/b")
    part(2).drop("product_name").write.option("header", "true").csv(f"{root}/sales/c")
    return read_mixed(spark, root, RAW_SALES).select(
        "sale_id", "customer_id", "product_id", "product_name", F.col("amount").cast("decimal(18,2)").alias("amount"), "sale_date"
    )


# ------------------------------------------------------------------------- contracts

SALES_CONTRACT = (
    ColumnRule("sale_id", "bigint", required=True),
    ColumnRule("customer_id", "int", required=True),
    ColumnRule("amount", "decimal(18,2)", required=True, low="0.01", high="400000"),
    ColumnRule("sale_date", "date", date_format="yyyy-MM-dd"),
    ColumnRule("product_name", "string", max_length=12, allowed=("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")),
)


def broken_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as text with values that no type holds: every seventh amount has 17 digits or
    more, every eleventh is text, every thirteenth customer passes an int, some dates don't exist."""
    o = load(spark, sf, "orders")
    key = F.col("o_orderkey")
    amount = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    return o.select(
        key.cast("string").alias("sale_id"),
        F.when(key % 13 == 0, F.concat(F.lit("9999999999"), F.col("o_custkey")))
        .when(key % 17 == 0, F.lit(""))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("customer_id"),
        F.when(key % 7 == 0, F.concat(F.lit("12345678901234"), amount)).when(key % 11 == 0, F.lit("n/a")).otherwise(amount).alias("amount"),
        F.when(key % 19 == 0, F.lit("2024-02-30")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("sale_date"),
        F.col("o_orderpriority").alias("product_name"),
    )


BROKEN = """broken AS (
  SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS sale_id,
         CASE WHEN o_orderkey % 13 = 0 THEN '9999999999' || o_custkey WHEN o_orderkey % 17 = 0 THEN ''
              ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
         CASE WHEN o_orderkey % 7 = 0 THEN '12345678901234' || CAST(o_totalprice AS DECIMAL(18,2))
              WHEN o_orderkey % 11 = 0 THEN 'n/a' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS amount,
         CASE WHEN o_orderkey % 19 = 0 THEN '2024-02-30' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS sale_date,
         o_orderpriority AS product_name, CAST(o_totalprice AS DECIMAL(18,2)) AS price
  FROM orders)"""


def q_contract_refusals(spark: SparkSession, sf: str) -> DataFrame:
    """Refused values by column and reason."""
    return refusal_counts(apply_contract(broken_sales(spark, sf), SALES_CONTRACT), SALES_CONTRACT)


def q_contract_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every row, typed, with the number of its refused values."""
    checked = apply_contract(broken_sales(spark, sf), SALES_CONTRACT)
    return checked.select("sale_id", "customer_id", "amount", "sale_date", "product_name", F.size("reasons").alias("refused"))


def q_sales_out_of_range(spark: SparkSession, sf: str) -> DataFrame:
    """Amounts that the output type can't hold are rejected with a reason; the rest is kept."""
    raw = broken_sales(spark, sf)
    kept = clean_sales(raw, as_of=AS_OF).select("sale_id", "amount", F.lit(None).cast("string").alias("reject_reason"))
    return kept.unionByName(reject_sales(raw, as_of=AS_OF).select("sale_id", F.lit(None).cast("decimal(18,2)").alias("amount"), "reject_reason"))


def q_sales_quality_out_of_range(spark: SparkSession, sf: str) -> DataFrame:
    """I2 on the same rows."""
    return sales_quality(broken_sales(spark, sf))


# ---------------------------------------------------------------------------- deltas


def _deltas(spark: SparkSession, sf: str, fold: bool) -> str:
    root = scratch_path(spark, "gold-deltas")
    raw, store, ckpt = f"{root}/raw", f"{root}/store", f"{root}/_checkpoint"
    write_orders_csv(spark, sf, f"{raw}/drop=1", "early")
    ingest_deltas(spark, raw, store, ckpt)
    if fold:
        fold_gold(spark, store, AS_OF)
    write_orders_csv(spark, sf, f"{raw}/drop=2", "late")
    ingest_deltas(spark, raw, store, ckpt)
    ingest_deltas(spark, raw, store, ckpt)  # nothing new: adds nothing
    return store


GOLD_COLUMNS = (
    "sale_id", "customer_id", "amount", "sale_date", "monthly_total", "yearly_total",
    "order_rank_in_month", "running_total", "customer_segment", "total_orders",
)


def q_incremental_gold(spark: SparkSession, sf: str) -> DataFrame:
    """§7.4: two drops; each batch writes its rows and its customers' states, readers merge."""
    return merged_gold(spark, _deltas(spark, sf, fold=False), AS_OF).select(*GOLD_COLUMNS)


def q_folded_gold(spark: SparkSession, sf: str) -> DataFrame:
    """§7.4: the first drop folded into a base; only customers of the second are computed again."""
    return merged_gold(spark, _deltas(spark, sf, fold=True), AS_OF).select(*GOLD_COLUMNS)


def q_merged_segments(spark: SparkSession, sf: str) -> DataFrame:
    """K4: segments from the batches' states, without a sale being read."""
    return merged_segments(spark, _deltas(spark, sf, fold=False))


# ------------------------------------------------------------------------- event log


def q_event_log_once(spark: SparkSession, sf: str) -> DataFrame:
    """All events in two files' drops, the second with every third event of the first again."""
    root = scratch_path(spark, "event-log")
    records = bus_records(load(spark, sf, "events"))
    first = F.col("event_id") % 2 == 0
    records.where(first).write.json(f"{root}/in/drop=1")
    stream_event_log(spark, f"{root}/in", f"{root}/log", f"{root}/_checkpoint", as_of_literal(AS_OF), delay="36500 days")
    again = records.where(~first | (F.col("event_id") % 3 == 0))
    again.unionByName(records.where(F.col("event_id") % 5 == 0)).write.json(f"{root}/in/drop=2")
    stream_event_log(spark, f"{root}/in", f"{root}/log", f"{root}/_checkpoint", as_of_literal(AS_OF), delay="36500 days")
    return read_event_log(spark, f"{root}/log").select("event_id", "orchestration_timestamp", "event_processed", "status")


QUERIES = {
    "incremental_discovery": q_incremental_discovery,
    "catalog_schema": q_catalog_schema,
    "catalog_rows": q_catalog_rows,
    "mixed_headers": q_mixed_headers,
    "contract_refusals": q_contract_refusals,
    "contract_rows": q_contract_rows,
    "sales_out_of_range": q_sales_out_of_range,
    "sales_quality_out_of_range": q_sales_quality_out_of_range,
    "incremental_gold": q_incremental_gold,
    "folded_gold": q_folded_gold,
    "merged_segments": q_merged_segments,
    "event_log_once": q_event_log_once,
}

SQL = {
    "incremental_discovery": f"WITH {ALL_TEXT} " + INFER.format(src="all_text"),
    "catalog_schema": f"WITH {ALL_TEXT}, o AS (" + INFER.format(src="old_text") + "), n AS (" + INFER.format(src="all_text") + ") "
    "SELECT n.column_name, n.inferred_type AS catalog_type, o.inferred_type AS old_type, "
    "CASE WHEN o.inferred_type IS NULL THEN 'added' WHEN o.inferred_type <> n.inferred_type THEN 'type_changed' "
    "ELSE 'unchanged' END AS change FROM n LEFT JOIN o ON o.column_name = n.column_name",
    "catalog_rows": f"WITH {ALL_TEXT} SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_custkey, o_orderstatus, "
    "CAST(o_totalprice AS DOUBLE) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, CAST(o_channel AS BOOLEAN) AS o_channel, "
    "CAST(o_wide AS DECIMAL(38,0)) AS o_wide, CAST(o_rate AS DOUBLE) AS o_rate, CAST(o_at AS TIMESTAMP) AS o_at FROM all_text",
    "mixed_headers": f"WITH {TEXT_SALES} SELECT * REPLACE (CASE WHEN CAST(sale_id AS BIGINT) % 3 = 2 THEN NULL ELSE product_name END AS product_name, "
    "strftime(sale_date, '%Y-%m-%d') AS sale_date) FROM text_sales",
    "contract_refusals": f"""WITH {BROKEN}, refused AS (
  SELECT 'customer_id' AS column_name, CASE WHEN customer_id = '' THEN 'missing' ELSE 'out_of_range' END AS reason
  FROM broken WHERE customer_id = '' OR k % 13 = 0
  UNION ALL
  SELECT 'amount', CASE WHEN k % 7 = 0 THEN 'out_of_range' WHEN k % 11 = 0 THEN 'broken' ELSE 'out_of_range' END
  FROM broken WHERE k % 7 = 0 OR k % 11 = 0 OR price < 0.01 OR price > 400000
  UNION ALL
  SELECT 'sale_date', 'broken' FROM broken WHERE k % 19 = 0
  UNION ALL
  SELECT 'product_name', CASE WHEN length(product_name) > 12 THEN 'too_long' ELSE 'not_allowed' END FROM broken
  WHERE length(product_name) > 12 OR product_name NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW'))
SELECT column_name, reason, COUNT(*) AS n FROM refused GROUP BY ALL""",
    "contract_rows": f"""WITH {BROKEN}
SELECT k AS sale_id, TRY_CAST(customer_id AS INTEGER) AS customer_id,
       CASE WHEN k % 7 <> 0 AND k % 11 <> 0 THEN price END AS amount, TRY_CAST(sale_date AS DATE) AS sale_date, product_name,
       CAST((CASE WHEN k % 13 = 0 OR k % 17 = 0 THEN 1 ELSE 0 END)
         + (CASE WHEN k % 7 = 0 OR k % 11 = 0 OR price < 0.01 OR price > 400000 THEN 1 ELSE 0 END)
         + (CASE WHEN k % 19 = 0 THEN 1 ELSE 0 END)
         + (CASE WHEN length(product_name) > 12 OR product_name NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW') THEN 1 ELSE 0 END)
         AS INTEGER) AS refused
FROM broken""",
    "sales_out_of_range": f"""WITH {BROKEN}
SELECT sale_id, CASE WHEN k % 7 <> 0 AND k % 11 <> 0 AND price > 0 THEN price END AS amount,
       CASE WHEN k % 7 = 0 THEN 'amount_out_of_range' WHEN k % 11 = 0 THEN 'null_amount'
            WHEN price <= 0 THEN 'non_positive_amount' END AS reject_reason
FROM broken""",
    "sales_quality_out_of_range": f"""WITH {BROKEN}
SELECT COUNT(*) AS total_records, CAST(0 AS BIGINT) AS null_customer_ids,
       COUNT(*) FILTER (WHERE k % 7 <> 0 AND k % 11 <> 0 AND price <= 0) AS invalid_amounts,
       (COUNT(*) - COUNT(*) FILTER (WHERE k % 7 <> 0 AND k % 11 <> 0 AND price <= 0)) / CAST(COUNT(*) AS DOUBLE) * 100 AS valid_records_percentage,
       COUNT(*) FILTER (WHERE k % 7 <> 0 AND k % 11 <> 0 AND price > 0) / CAST(COUNT(*) AS DOUBLE) * 100 AS exact_valid_percentage
FROM broken""",
    "incremental_gold": BASE_SQL["incremental_gold_eager"],
    "folded_gold": BASE_SQL["incremental_gold_eager"],
    "merged_segments": f"WITH {TEXT_SALES}, {clean('text_sales')}, {SEGMENTS} SELECT * FROM segments",
    "event_log_once": f"SELECT event_id, '{AS_OF.replace(' ', 'T')}' AS orchestration_timestamp, "
    "CASE event_type WHEN 'view' THEN 'Object Created' WHEN 'click' THEN 'Scheduled Event' "
    "WHEN 'signup' THEN 'User Signup' ELSE 'Glue Job State Change' END AS event_processed, "
    "CAST(NULL AS VARCHAR) AS status FROM events",
}
