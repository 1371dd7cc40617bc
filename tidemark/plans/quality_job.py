"""The data-quality job (doc-only in the reference: "validation rules, quality
scoring, report generation"). Our design: rule checks over the processed tables,
one weighted score per table, the report and scores written as Parquet."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.quality import Rule, check, quality_score
from tidemark.operators.sales import as_of_literal
from tidemark.sinks import write_plain

SALES_RULES = (
    Rule("customer_id_present", "not_null", "customer_id", weight=3.0),
    Rule("sale_id_unique", "unique", "sale_id", weight=3.0),
    Rule("amount_positive", "range", "amount", low=0.01),
    Rule("customer_known", "reference", "customer_id", weight=2.0, threshold=95.0),
)

CUSTOMER_RULES = (
    Rule("customer_id_present", "not_null", "customer_id", weight=3.0),
    Rule("customer_id_unique", "unique", "customer_id", weight=3.0),
    Rule("age_plausible", "range", "age", low=0, high=120),
    Rule(
        "age_group_allowed",
        "allowed",
        "age_group",
        values=("Young", "Adult", "Middle-aged", "Senior"),
    ),
)


def quality_report(
    sales: DataFrame,
    customers: DataFrame,
    as_of: _dt.datetime | str | None = None,
    sales_rules=SALES_RULES,
    customer_rules=CUSTOMER_RULES,
) -> DataFrame:
    """Report rows for both processed tables (sales reference-checked against customers)."""
    ts = as_of_literal(as_of)
    refs = {r.name: customers.select("customer_id") for r in sales_rules if r.kind == "reference"}
    return check(sales, sales_rules, "processed_sales", refs, ts).unionByName(
        check(customers, customer_rules, "processed_customers", {}, ts)
    )


def run_quality_job(
    spark: SparkSession, out_root: str, as_of: _dt.datetime | str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Read the processed tables, write quality_report and quality_scores."""
    out = out_root.rstrip("/")
    report = quality_report(
        spark.read.parquet(f"{out}/sales"), spark.read.parquet(f"{out}/customers"), as_of
    )
    write_plain(report, f"{out}/quality_report")
    written = spark.read.parquet(f"{out}/quality_report")
    write_plain(quality_score(written), f"{out}/quality_scores")
    return written, spark.read.parquet(f"{out}/quality_scores")
