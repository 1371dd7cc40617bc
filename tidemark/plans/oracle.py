"""Independent SQL (DuckDB dialect) for each registered query.

Written from the rules, not from the Spark code: window functions where Spark
uses aggregates and joins, ``row_number`` where Spark uses ``max(struct)``, and
so on. Types are cast so both engines report the same ones (DuckDB returns
BIGINT for year/month/dayofweek/row_number/date_diff; Spark returns INT).
"""

from __future__ import annotations

from tidemark.plans.queries import AS_OF, QUALITY_AS_OF, TOP_K

TS = f"TIMESTAMP '{AS_OF}'"

ORDERS_SALES = """orders_sales AS (
  SELECT o_orderkey AS sale_id, o_custkey AS customer_id, o_orderstatus AS product_id,
         o_orderpriority AS product_name, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
         CAST(o_orderdate AS DATE) AS sale_date
  FROM orders)"""

EVENTS_SALES = """events_sales AS (
  SELECT event_id AS sale_id, user_id AS customer_id, event_type AS product_id,
         props AS product_name,
         CAST(CAST(value AS DECIMAL(18,2)) * 4 AS DECIMAL(18,2)) AS amount,
         CAST(TRY_STRPTIME(CASE WHEN event_id % 97 = 0 THEN 'bad'
                                ELSE strftime(ts, '%Y-%m-%d') END, '%Y-%m-%d') AS DATE) AS sale_date
  FROM events)"""

CUSTOMER_SALES = """customer_sales AS (
  SELECT c_custkey AS sale_id,
         CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_custkey END AS customer_id,
         CAST(c_acctbal AS DECIMAL(18,2)) AS amount
  FROM customer)"""


def clean(src: str, name: str = "clean") -> str:
    return f"""{name} AS (
  SELECT sale_id, customer_id, product_id, product_name, amount, sale_date,
         CAST(year(sale_date) AS INTEGER) AS sales_year,
         CAST(month(sale_date) AS INTEGER) AS sales_month,
         CAST(quarter(sale_date) AS INTEGER) AS sales_quarter,
         CAST(dayofweek(sale_date) + 1 AS INTEGER) AS day_of_week,
         COALESCE(dayofweek(sale_date) + 1 IN (1, 7), false) AS is_weekend,
         CASE WHEN amount < 100 THEN 'Small' WHEN amount < 500 THEN 'Medium'
              WHEN amount < 1000 THEN 'Large' ELSE 'Very Large' END AS amount_category,
         {TS} AS processed_timestamp,
         'sales_system' AS data_source,
         'sales-data-etl' AS etl_job_name
  FROM {src}
  WHERE customer_id IS NOT NULL AND amount > 0)"""


SEGMENTS = """segments AS (
  SELECT customer_id, total_spent, total_orders, avg_order_value, last_purchase_date,
         first_purchase_date,
         CAST(date_diff('day', first_purchase_date, last_purchase_date) AS INTEGER)
           AS customer_lifetime_days,
         CASE WHEN total_spent > 5000 AND total_orders > 10 THEN 'VIP'
              WHEN total_spent > 1000 AND total_orders > 5 THEN 'High Value'
              WHEN total_orders > 3 THEN 'Regular' ELSE 'New' END AS customer_segment
  FROM (SELECT customer_id,
               CAST(SUM(amount) AS DECIMAL(38,2)) AS total_spent,
               COUNT(sale_id) AS total_orders,
               CAST(SUM(amount) AS DOUBLE) / COUNT(amount) AS avg_order_value,
               MAX(sale_date) AS last_purchase_date,
               MIN(sale_date) AS first_purchase_date
        FROM clean GROUP BY customer_id))"""

METRICS = """metrics AS (
  SELECT c.*,
    CAST(SUM(amount) OVER (PARTITION BY customer_id, sales_month) AS DECIMAL(38,2)) AS monthly_total,
    CAST(SUM(amount) OVER (PARTITION BY customer_id, sales_year) AS DECIMAL(38,2)) AS yearly_total,
    CAST(SUM(amount) OVER (PARTITION BY customer_id, sales_month) AS DOUBLE)
      / COUNT(amount) OVER (PARTITION BY customer_id, sales_month) AS avg_order_value,
    CAST(row_number() OVER (PARTITION BY customer_id, sales_month
                            ORDER BY amount DESC, sale_id ASC NULLS FIRST) AS INTEGER)
      AS order_rank_in_month,
    CAST(SUM(amount) OVER (PARTITION BY customer_id ORDER BY sale_date ASC NULLS FIRST
                           RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(38,2))
      AS running_total
  FROM clean c)"""

RAW_CUSTOMERS = """contacts AS (
  SELECT c_custkey, split_part(c_name, '#', 1) AS first_name,
         CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE split_part(c_name, '#', 2) END AS last_name,
         c_mktsegment, c_nationkey
  FROM customer),
contacts2 AS (
  SELECT c_custkey, first_name, last_name,
         CASE WHEN c_custkey % 7 = 0
              THEN concat_ws('.', lower(first_name), last_name) || lower(c_mktsegment) || '.com'
              ELSE concat_ws('.', lower(first_name), last_name) || '@' || lower(c_mktsegment) || '.com'
         END AS email,
         CAST(c_nationkey AS VARCHAR) || '-' || CAST(c_custkey AS VARCHAR) AS phone
  FROM contacts),
raw_customers AS (
  SELECT CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE c_custkey END AS customer_id,
         first_name, last_name, email, phone,
         CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE CAST(o_orderkey % 80 + 15 AS INTEGER) END AS age,
         o_orderpriority AS city, o_orderstatus AS state,
         CAST(o_orderdate AS DATE) AS registration_date
  FROM contacts2 LEFT JOIN orders ON o_custkey = c_custkey)"""

DEDUP = """dedup AS (
  SELECT customer_id, first_name, last_name, email, phone, age, city, state, registration_date
  FROM (SELECT *, row_number() OVER (
          PARTITION BY customer_id
          ORDER BY registration_date DESC NULLS LAST, first_name DESC NULLS LAST,
                   last_name DESC NULLS LAST, email DESC NULLS LAST, phone DESC NULLS LAST,
                   age DESC NULLS LAST, city DESC NULLS LAST, state DESC NULLS LAST) AS rn
        FROM raw_customers WHERE customer_id IS NOT NULL)
  WHERE rn = 1)"""

OBJECT_KEY = """CASE WHEN event_id % 11 = 0 THEN NULL ELSE
    (CASE event_id % 3 WHEN 0 THEN 'customers/' WHEN 1 THEN 'sales/' ELSE 'other/' END)
    || CAST(event_id AS VARCHAR)
    || (CASE WHEN event_id % 5 <= 2 THEN '.csv' WHEN event_id % 5 = 3 THEN '.CSV' ELSE '.json' END)
  END"""

JOB_RUNS = """runs AS (
  SELECT CASE WHEN user_id % 2 = 0 THEN 'data-pipeline-customer-data-etl-dev'
              ELSE 'data-pipeline-sales-data-etl-dev' END AS job_name,
         'jr_' || CAST(event_id AS VARCHAR) AS job_run_id,
         CASE WHEN event_type = 'error' THEN 'FAILED' WHEN event_id % 7 = 1 THEN 'RUNNING'
              WHEN event_id % 7 = 2 THEN 'STOPPED' ELSE 'SUCCEEDED' END AS state,
         ts AS started_on,
         CASE WHEN event_type = 'view' THEN NULL ELSE CAST(floor(value * 10) AS BIGINT) END
           AS execution_time_seconds,
         CASE WHEN event_type = 'error' AND event_id % 3 <> 0 THEN 'Task failed: ' || props END
           AS error_message
  FROM events)"""

QUALITY_REPORT = f"""WITH {ORDERS_SALES}, {clean("orders_sales")},
active AS (SELECT DISTINCT c_custkey FROM customer WHERE c_acctbal > 0),
r AS (
  SELECT 'customer_id_present' AS rule, 'not_null' AS kind, 'customer_id' AS column_name,
         (SELECT COUNT(*) FROM clean) AS checked,
         (SELECT COUNT(*) FROM clean WHERE customer_id IS NULL) AS failed,
         3.0 AS weight, 100.0 AS threshold
  UNION ALL
  SELECT 'sale_id_unique', 'unique', 'sale_id', (SELECT COUNT(*) FROM clean),
         (SELECT COUNT(sale_id) - COUNT(DISTINCT sale_id) FROM clean), 3.0, 100.0
  UNION ALL
  SELECT 'amount_in_range', 'range', 'amount', (SELECT COUNT(*) FROM clean),
         (SELECT COUNT(*) FROM clean WHERE amount < 0.01 OR amount > 400000.0), 1.0, 99.0
  UNION ALL
  SELECT 'status_allowed', 'allowed', 'product_id', (SELECT COUNT(*) FROM clean WHERE sale_id % 11 <> 0),
         (SELECT COUNT(*) FROM clean WHERE sale_id % 11 <> 0 AND product_id NOT IN ('F', 'O')), 1.0, 95.0
  UNION ALL
  SELECT 'customer_known', 'reference', 'customer_id', (SELECT COUNT(*) FROM clean),
         (SELECT COUNT(*) FROM clean c WHERE NOT EXISTS
            (SELECT 1 FROM active a WHERE a.c_custkey = c.customer_id)), 2.0, 90.0
  UNION ALL
  SELECT 'sale_recent', 'freshness', 'sale_date', (SELECT COUNT(*) FROM clean),
         (SELECT COUNT(*) FROM clean
          WHERE date_diff('day', sale_date, DATE '{QUALITY_AS_OF[:10]}') > 1800), 1.0, 50.0),
report AS (
  SELECT 'processed_sales' AS table_name, rule, kind, column_name,
         CAST(checked AS BIGINT) AS checked, CAST(failed AS BIGINT) AS failed,
         CAST(weight AS DOUBLE) AS weight,
         CASE WHEN checked > 0 THEN CAST(checked - failed AS DOUBLE) / CAST(checked AS DOUBLE) * 100
              ELSE 100.0 END AS pass_rate,
         threshold
  FROM r)"""


TEXT_SALES = """text_sales AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS sale_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         o_orderstatus AS product_id, o_orderpriority AS product_name,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(o_orderdate AS DATE) AS sale_date
  FROM orders)"""

ROUNDTRIP = "SELECT sale_id, customer_id, amount, sale_date, sales_year, sales_month, amount_category FROM clean"

ORDERS_TEXT_OLD = """old_text AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
         o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice,
         strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
  FROM orders)"""

ORDERS_TEXT_NEW = """new_text AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
         CASE WHEN o_orderstatus = 'P' THEN 'C-' || CAST(o_custkey AS VARCHAR)
              ELSE CAST(o_custkey AS VARCHAR) END AS o_custkey,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice,
         strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
         substr(o_orderpriority, 1, 1) AS o_orderpriority,
         CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS o_channel,
         lpad(CAST(o_orderkey % 90000 AS VARCHAR), 5, '0') AS o_zip,
         '7' || lpad(CAST(o_orderkey AS VARCHAR), 22, '0') AS o_wide,
         CAST(o_orderkey % 9 + 1 AS VARCHAR) || 'e5' AS o_rate,
         strftime(o_orderdate, '%Y-%m-%d') || CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE ' 12:30:05' END AS o_at
  FROM orders)"""

# Per column (UNPIVOT of the text table): count values that look like each type.
_INT, _NUM = "'-?(0|[1-9][0-9]*)'", "'-?(0|[1-9][0-9]*)(\\.[0-9]+)?([eE][+-]?[0-9]+)?'"
_DAY = "[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}"
INFER = f"""SELECT column_name,
  CASE WHEN n = 0 THEN 'string' WHEN i = n THEN 'bigint' WHEN w = n THEN 'decimal(38,0)' WHEN d = n THEN 'double'
       WHEN t = n THEN 'date' WHEN ts = n THEN 'timestamp' WHEN b = n THEN 'boolean' ELSE 'string' END AS inferred_type,
  n AS non_null, total
FROM (
  SELECT column_name,
    COUNT(*) FILTER (WHERE v IS NOT NULL AND v <> '') AS n,
    COUNT(*) FILTER (WHERE regexp_full_match(v, {_INT}) AND TRY_CAST(v AS BIGINT) IS NOT NULL) AS i,
    COUNT(*) FILTER (WHERE regexp_full_match(v, {_INT}) AND TRY_CAST(v AS DECIMAL(38,0)) IS NOT NULL) AS w,
    COUNT(*) FILTER (WHERE regexp_full_match(v, {_NUM}) AND TRY_CAST(v AS DOUBLE) IS NOT NULL) AS d,
    COUNT(*) FILTER (WHERE regexp_full_match(v, '{_DAY}') AND TRY_CAST(v AS DATE) IS NOT NULL) AS t,
    COUNT(*) FILTER (WHERE regexp_full_match(v, '{_DAY}([ T][0-9]{{{{2}}}}:[0-9]{{{{2}}}}:[0-9]{{{{2}}}}(\\.[0-9]{{{{1,6}}}})?)?')
                     AND TRY_CAST(v AS TIMESTAMP) IS NOT NULL) AS ts,
    COUNT(*) FILTER (WHERE lower(v) IN ('true', 'false')) AS b,
    (SELECT COUNT(*) FROM {{src}}) AS total
  FROM (SELECT column_name, trim(v) AS v FROM (UNPIVOT {{src}} ON COLUMNS(*) INTO NAME column_name VALUE v))
  GROUP BY column_name)"""

ROUTING = (
    "SELECT event_id, event_type, event_class, k, ts, job_name, state, "
    "CASE WHEN event_class = 'file_created' AND job IS NOT NULL THEN 'start_job' "
    "WHEN event_class = 'scheduled' THEN 'start_workflow' "
    "WHEN event_class = 'job_state_change' AND state = 'SUCCEEDED' THEN 'job_succeeded' "
    "WHEN event_class = 'job_state_change' AND state = 'FAILED' THEN 'job_failed' END AS action, "
    "CASE WHEN event_class = 'file_created' AND job IS NOT NULL THEN 'data-pipeline-' || job || '-dev' "
    "WHEN event_class = 'scheduled' THEN 'data-pipeline-main-workflow-dev' "
    "WHEN event_class = 'job_state_change' THEN job_name END AS target, "
    "CASE WHEN event_type = 'view' THEN 'file_created' "
    "WHEN event_class = 'job_state_change' AND job_name = 'data-pipeline-customer-data-etl-dev' "
    "THEN 'job_state_rule' END AS matched_rule "
    "FROM (SELECT event_id, event_type, k, ts, "
    "CASE WHEN event_type = 'view' THEN 'file_created' "
    "WHEN event_type = 'click' AND event_id % 2 = 0 THEN 'scheduled' "
    "WHEN event_type IN ('purchase', 'error') THEN 'job_state_change' ELSE 'other' END AS event_class, "
    "CASE WHEN event_type = 'view' THEN (CASE WHEN contains(COALESCE(k, ''), 'customers/') "
    "THEN 'customer-data-etl' WHEN contains(COALESCE(k, ''), 'sales/') THEN 'sales-data-etl' END) END AS job, "
    "CASE WHEN event_type = 'purchase' THEN 'SUCCEEDED' WHEN event_type = 'error' THEN 'FAILED' END AS state, "
    "CASE WHEN event_type IN ('purchase', 'error') THEN (CASE WHEN user_id % 2 = 0 "
    "THEN 'data-pipeline-customer-data-etl-dev' ELSE 'data-pipeline-sales-data-etl-dev' END) END AS job_name "
    f"FROM (SELECT *, {OBJECT_KEY} AS k FROM events))"
)

SQL: dict[str, str] = {
    "customer_segments": f"WITH {ORDERS_SALES}, {clean('orders_sales')}, {SEGMENTS} "
    "SELECT * FROM segments",
    "segment_distribution": f"WITH {ORDERS_SALES}, {clean('orders_sales')}, {SEGMENTS} "
    "SELECT customer_segment, COUNT(*) AS customer_count FROM segments GROUP BY customer_segment",
    "sales_enriched": f"WITH {EVENTS_SALES}, {clean('events_sales')} SELECT * FROM clean",
    "amount_bands": f"WITH {EVENTS_SALES}, {clean('events_sales')} "
    "SELECT amount_category, COUNT(*) AS order_count, "
    "CAST(SUM(amount) AS DECIMAL(38,2)) AS total_amount FROM clean GROUP BY amount_category",
    "business_metrics": f"WITH {ORDERS_SALES}, {clean('orders_sales')}, {METRICS} SELECT * FROM metrics",
    "business_metrics_skew_safe": f"WITH {ORDERS_SALES}, {clean('orders_sales')}, {METRICS} "
    "SELECT * FROM metrics",
    "order_rank_in_month": f"WITH {ORDERS_SALES}, {clean('orders_sales')}, {METRICS} "
    "SELECT sale_id, customer_id, sales_month, amount, order_rank_in_month FROM metrics",
    "order_rank_skew_safe": f"WITH {EVENTS_SALES}, {clean('events_sales')}, {METRICS} "
    "SELECT sale_id, customer_id, sales_month, amount, order_rank_in_month FROM metrics",
    "running_total": f"WITH {EVENTS_SALES}, {clean('events_sales')}, {METRICS} "
    "SELECT sale_id, customer_id, sale_date, amount, running_total FROM metrics",
    "top_orders": f"WITH {ORDERS_SALES}, {clean('orders_sales')}, {METRICS} "
    "SELECT sale_id, customer_id, sales_month, amount, order_rank_in_month FROM metrics "
    f"WHERE order_rank_in_month <= {TOP_K}",
    "sales_with_segments": f"WITH {ORDERS_SALES}, {clean('orders_sales')}, {METRICS}, {SEGMENTS} "
    "SELECT m.*, s.customer_segment, s.total_spent, s.total_orders "
    "FROM metrics m LEFT JOIN segments s USING (customer_id)",
    "customer_quality_metrics": f"WITH {RAW_CUSTOMERS}, "
    "st AS (SELECT COUNT(*) AS total_records, COUNT(*) FILTER (WHERE customer_id IS NULL) AS null_records, "
    "COUNT(DISTINCT customer_id) AS d FROM raw_customers), "
    "st2 AS (SELECT total_records, null_records, "
    "CAST(total_records - d - CASE WHEN null_records > 0 THEN 1 ELSE 0 END AS BIGINT) AS duplicate_records "
    "FROM st) "
    "SELECT 'customer-data-etl' AS job_name, total_records, null_records, duplicate_records, "
    "CASE WHEN total_records > 0 THEN CAST(null_records AS DOUBLE) / CAST(total_records AS DOUBLE) * 100 "
    "ELSE 0.0 END AS null_percentage, "
    "CASE WHEN total_records > 0 THEN CAST(duplicate_records AS DOUBLE) / CAST(total_records AS DOUBLE) * 100 "
    "ELSE 0.0 END AS duplicate_percentage FROM st2",
    "sales_quality_metrics": f"WITH {CUSTOMER_SALES}, "
    "st AS (SELECT COUNT(*) AS total_records, "
    "COUNT(*) FILTER (WHERE customer_id IS NULL) AS null_customer_ids, "
    "COUNT(*) FILTER (WHERE amount <= 0) AS invalid_amounts, "
    "COUNT(*) FILTER (WHERE customer_id IS NOT NULL AND amount > 0) AS v FROM customer_sales) "
    "SELECT total_records, null_customer_ids, invalid_amounts, "
    "CASE WHEN total_records = 0 THEN NULL ELSE "
    "CAST(total_records - null_customer_ids - invalid_amounts AS DOUBLE) / CAST(total_records AS DOUBLE) * 100 "
    "END AS valid_records_percentage, "
    "CASE WHEN total_records = 0 THEN NULL ELSE CAST(v AS DOUBLE) / CAST(total_records AS DOUBLE) * 100 "
    "END AS exact_valid_percentage FROM st",
    "dedup_customers": f"WITH {RAW_CUSTOMERS}, {DEDUP} SELECT * FROM dedup",
    "processed_customers": f"WITH {RAW_CUSTOMERS}, {DEDUP} "
    "SELECT CAST(customer_id AS VARCHAR) AS customer_id, concat_ws(' ', first_name, last_name) AS full_name, email, "
    "regexp_extract(email, '@(.+)', 1) AS email_domain, phone, age, "
    "CASE WHEN age < 25 THEN 'Young' WHEN age < 45 THEN 'Adult' WHEN age < 65 THEN 'Middle-aged' "
    "ELSE 'Senior' END AS age_group, city, state, "
    "CAST(year(registration_date) AS INTEGER) AS registration_year, "
    f"{TS} AS processed_timestamp, 'customer_system' AS data_source, "
    "'customer-data-etl' AS etl_job_name FROM dedup",
    "age_groups": "SELECT p_partkey, age, CASE WHEN age < 25 THEN 'Young' WHEN age < 45 THEN 'Adult' "
    "WHEN age < 65 THEN 'Middle-aged' ELSE 'Senior' END AS age_group "
    "FROM (SELECT p_partkey, CAST(CASE WHEN p_size * 2 - 1 = 51 THEN NULL ELSE p_size * 2 - 1 END "
    "AS INTEGER) AS age FROM part)",
    "email_domain": f"WITH {RAW_CUSTOMERS} SELECT c_custkey AS customer_id, email, "
    "regexp_extract(email, '@(.+)', 1) AS email_domain FROM contacts2",
    "full_name": f"WITH {RAW_CUSTOMERS} SELECT c_custkey AS customer_id, first_name, last_name, "
    "concat_ws(' ', first_name, last_name) AS full_name FROM contacts2",
    "orphan_orders": f"WITH {ORDERS_SALES}, {clean('orders_sales')} "
    "SELECT sale_id, customer_id, amount, sale_date FROM clean c WHERE NOT EXISTS "
    "(SELECT 1 FROM customer WHERE c_acctbal > 0 AND c_custkey = c.customer_id)",
    "quality_report": f"{QUALITY_REPORT} SELECT table_name, rule, kind, column_name, checked, failed, "
    "weight, pass_rate, pass_rate >= threshold AS passed FROM report",
    "quality_score": f"{QUALITY_REPORT} SELECT table_name, "
    "list_sum(list(pass_rate * weight ORDER BY rule)) / list_sum(list(weight ORDER BY rule)) AS quality_score, "
    "COUNT(*) AS rules_checked, COUNT(*) FILTER (WHERE pass_rate >= threshold) AS rules_passed "
    "FROM report GROUP BY table_name",
    "reject_rows": f"WITH {CUSTOMER_SALES} SELECT sale_id, customer_id, amount, "
    "CASE WHEN customer_id IS NULL THEN 'null_customer_id' WHEN amount IS NULL THEN 'null_amount' "
    "WHEN amount <= 0 THEN 'non_positive_amount' END AS reject_reason FROM customer_sales "
    "WHERE customer_id IS NULL OR amount IS NULL OR amount <= 0",
    "manifest_validation": f"SELECT event_id, bucket, key, is_valid, "
    "CASE WHEN is_valid THEN 'File ' || COALESCE(key, 'None') || ' in bucket ' || bucket || ' is valid.' "
    "ELSE 'File ' || COALESCE(key, 'None') || ' in bucket ' || bucket || ' is invalid or missing.' END "
    "AS message FROM (SELECT event_id, 'raw-' || event_type AS bucket, key, "
    "COALESCE(key IS NOT NULL AND key <> '' AND suffix(key, '.csv'), false) AS is_valid "
    f"FROM (SELECT *, {OBJECT_KEY} AS key FROM events))",
    "event_routing": "SELECT event_id, event_class, action, target, CASE WHEN action = 'start_job' THEN "
    "'{\"--trigger_event\":\"S3_OBJECT_CREATED\",\"--source_bucket\":\"raw-view\",\"--source_key\":\"' || k || '\"}' END "
    "AS arguments, matched_rule FROM (" + ROUTING + ")",
    "job_outcomes": f"WITH {JOB_RUNS} SELECT job_name, job_run_id, state, started_on FROM runs "
    "WHERE state IN ('SUCCEEDED', 'FAILED')",
    "job_metrics": f"WITH {JOB_RUNS} SELECT job_name, COUNT(*) AS runs, "
    "COUNT(*) FILTER (WHERE state = 'SUCCEEDED') AS succeeded, "
    "COUNT(*) FILTER (WHERE state = 'FAILED') AS failed, "
    "CAST(SUM(COALESCE(execution_time_seconds, 0)) AS BIGINT) AS total_execution_seconds, "
    "CAST(SUM(COALESCE(execution_time_seconds, 0)) AS DOUBLE) / COUNT(*) AS avg_execution_seconds, "
    "CAST(MAX(COALESCE(execution_time_seconds, 0)) AS BIGINT) AS max_execution_seconds "
    "FROM runs GROUP BY job_name",
    "job_failures": f"WITH {JOB_RUNS} SELECT job_name, job_run_id, "
    f"COALESCE(error_message, 'Unknown error') AS error_message, started_on, {TS} AS failure_time FROM runs "
    "WHERE state = 'FAILED'",
    "job_run_metrics": f"WITH {JOB_RUNS} SELECT job_name, job_run_id, 'SUCCESS' AS status, "
    f"CAST(COALESCE(execution_time_seconds, 0) AS BIGINT) AS execution_time_seconds, {TS} AS completion_time "
    "FROM runs WHERE state = 'SUCCEEDED'",
    "clean_sales_rules": f"WITH {CUSTOMER_SALES} SELECT sale_id, customer_id, amount, "
    "CASE WHEN amount < 100 THEN 'Small' WHEN amount < 500 THEN 'Medium' "
    "WHEN amount < 1000 THEN 'Large' ELSE 'Very Large' END AS amount_category "
    "FROM customer_sales WHERE customer_id IS NOT NULL AND amount > 0",
    "business_metrics_null_customer": f"""WITH {ORDERS_SALES}, clean AS (
  SELECT sale_id, CASE WHEN sale_id % 5 = 0 THEN NULL WHEN sale_id % 3 = 0 THEN -1 ELSE customer_id END AS customer_id,
         amount, sale_date, CAST(year(sale_date) AS INTEGER) AS sales_year, CAST(month(sale_date) AS INTEGER) AS sales_month
  FROM orders_sales), {METRICS}
SELECT p.limit_kind, metrics.* FROM metrics CROSS JOIN (VALUES ('above'), ('below')) p(limit_kind)""",
    "readiness_gate": f"WITH {JOB_RUNS}, latest AS (SELECT run_window, job_name, state FROM ("
    "SELECT CAST(started_on AS DATE) AS run_window, job_name, state, row_number() OVER ("
    "PARTITION BY CAST(started_on AS DATE), job_name ORDER BY started_on DESC, job_run_id DESC) AS rn "
    "FROM runs) WHERE rn = 1) "
    "SELECT run_window, "
    "MAX(CASE WHEN job_name = 'data-pipeline-customer-data-etl-dev' THEN state END) AS customer_state, "
    "MAX(CASE WHEN job_name = 'data-pipeline-sales-data-etl-dev' THEN state END) AS sales_state, "
    "COALESCE(MAX(CASE WHEN job_name = 'data-pipeline-customer-data-etl-dev' THEN state END) = 'SUCCEEDED', false) "
    "AND COALESCE(MAX(CASE WHEN job_name = 'data-pipeline-sales-data-etl-dev' THEN state END) = 'SUCCEEDED', false) "
    "AS ready FROM latest GROUP BY run_window",
    "csv_roundtrip": f"WITH {TEXT_SALES}, {clean('text_sales')} {ROUNDTRIP}",
    "incremental_ingest": f"WITH {TEXT_SALES}, {clean('text_sales')} {ROUNDTRIP}",
    "partitioned_roundtrip": f"WITH {ORDERS_SALES}, {clean('orders_sales')}, {METRICS}, {SEGMENTS} "
    "SELECT m.sale_id, m.customer_id, m.amount, m.sale_date, m.sales_year, m.sales_month, "
    "m.monthly_total, m.order_rank_in_month, m.running_total, s.customer_segment "
    "FROM metrics m LEFT JOIN segments s USING (customer_id)",
    "rolling_segments": f"WITH {TEXT_SALES}, {clean('text_sales')}, {SEGMENTS} SELECT * FROM segments",
    "inferred_types": f"WITH {ORDERS_TEXT_NEW} " + INFER.format(src="new_text"),
    "schema_drift": f"WITH {ORDERS_TEXT_OLD}, {ORDERS_TEXT_NEW}, "
    "o AS (" + INFER.format(src="old_text") + "), n AS (" + INFER.format(src="new_text") + ") "
    "SELECT COALESCE(o.column_name, n.column_name) AS column_name, o.inferred_type AS old_type, "
    "n.inferred_type AS new_type, CASE WHEN o.inferred_type IS NULL THEN 'added' "
    "WHEN n.inferred_type IS NULL THEN 'removed' WHEN o.inferred_type <> n.inferred_type THEN 'type_changed' "
    "ELSE 'unchanged' END AS change FROM o FULL OUTER JOIN n ON o.column_name = n.column_name",
    "sales_customer_enriched": f"WITH {ORDERS_SALES}, {clean('orders_sales')}, {RAW_CUSTOMERS}, {DEDUP} "
    "SELECT c.customer_id, c.sale_id, c.amount, c.sale_date, "
    "concat_ws(' ', d.first_name, d.last_name) AS full_name, "
    "CASE WHEN d.age < 25 THEN 'Young' WHEN d.age < 45 THEN 'Adult' WHEN d.age < 65 THEN 'Middle-aged' "
    "ELSE 'Senior' END AS age_group, regexp_extract(d.email, '@(.+)', 1) AS email_domain, "
    "CAST(year(d.registration_date) AS INTEGER) AS registration_year "
    "FROM clean c JOIN dedup d ON c.customer_id = d.customer_id",
    "orchestration_log": f"""SELECT event_id, '{AS_OF.replace(" ", "T")}' AS orchestration_timestamp,
  CASE WHEN NOT failed THEN detail_type END AS event_processed,
  CASE WHEN failed THEN NULL WHEN action IS NULL THEN '[]' ELSE '[{{' || CASE action
    WHEN 'start_job' THEN '"job_name":"' || target || '","job_run_id":"run_' || event_id || '","status":"STARTED"'
    WHEN 'start_workflow' THEN '"workflow_name":"' || target || '",' || CASE WHEN refused
      THEN '"status":"FAILED","error":"Start refused"'
      ELSE '"workflow_run_id":"run_' || event_id || '","status":"STARTED"' END
    ELSE '"job_name":"' || target || '","job_run_id":"jr_' || event_id || '","state":"' || state || '","processed":true'
    END || '}}]' END AS results,
  CASE WHEN failed THEN 'FAILED' END AS status,
  CASE WHEN failed THEN 'Start refused' END AS error,
  CASE WHEN failed THEN '{{"source":"aws.s3","detail-type":"Object Created","time":"'
    || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '","detail":{{"bucket":{{"name":"raw-view"}},"object":{{"key":"' || k || '"}}}}}}'
    END AS original_event
FROM (SELECT *, event_id % 8 = 0 AS refused, COALESCE(action = 'start_job', false) AND event_id % 8 = 0 AS failed,
  CASE event_type WHEN 'view' THEN 'Object Created' WHEN 'click' THEN 'Scheduled Event'
    WHEN 'signup' THEN 'User Signup' ELSE 'Glue Job State Change' END AS detail_type FROM ({ROUTING}))""",
    "malformed_events": "SELECT event_id, CASE WHEN event_id % 17 = 0 THEN 'null_body' ELSE 'malformed_json' END "
    "AS reject_reason FROM events WHERE event_id % 17 = 0 OR event_id % 13 = 0",
    "customers_csv_roundtrip": f"WITH {RAW_CUSTOMERS} SELECT * REPLACE (CASE WHEN age % 9 = 0 THEN NULL ELSE age END AS age), "
    "COALESCE(age % 9 = 0, false) AS malformed FROM raw_customers",
    "incremental_gold_eager": f"WITH {TEXT_SALES}, {clean('text_sales')}, {METRICS}, {SEGMENTS} "
    "SELECT m.sale_id, m.customer_id, m.amount, m.sale_date, m.monthly_total, m.yearly_total, "
    "m.order_rank_in_month, m.running_total, s.customer_segment, s.total_orders "
    "FROM metrics m LEFT JOIN segments s USING (customer_id)",
    "segments_join": f"WITH {ORDERS_SALES}, {clean('orders_sales')}, {SEGMENTS} "
    "SELECT c.customer_id, c.sale_id, c.amount, s.customer_segment, s.total_spent, s.total_orders "
    "FROM clean c LEFT JOIN segments s USING (customer_id)",
    "business_metrics_hot_customer": "WITH hot_sales AS (SELECT o_orderkey AS sale_id, "
    "CASE WHEN o_orderkey % 3 = 0 THEN CAST(-1 AS BIGINT) ELSE o_custkey END AS customer_id, "
    "o_orderstatus AS product_id, o_orderpriority AS product_name, "
    "CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(o_orderdate AS DATE) AS sale_date FROM orders), "
    f"{clean('hot_sales')}, {METRICS}, {SEGMENTS} "
    "SELECT m.*, s.customer_segment, s.total_spent, s.total_orders "
    "FROM metrics m LEFT JOIN segments s USING (customer_id)",
    "mapped_customers": f"WITH {RAW_CUSTOMERS} "
    "SELECT CAST(customer_id AS VARCHAR) AS customer_id, concat_ws(' ', first_name, last_name) AS full_name, email, "
    "regexp_extract(email, '@(.+)', 1) AS email_domain, phone, age, "
    "CASE WHEN age < 25 THEN 'Young' WHEN age < 45 THEN 'Adult' WHEN age < 65 THEN 'Middle-aged' "
    "ELSE 'Senior' END AS age_group, city, state, "
    "CAST(year(registration_date) AS INTEGER) AS registration_year, "
    f"{TS} AS processed_timestamp, 'customer_system' AS data_source, "
    "'customer-data-etl' AS etl_job_name FROM raw_customers",
}
