"""Data-quality operators.

The reference runs a separate count action per metric (the input is read again
for each). Here each metric set is one aggregate over one scan. The quality job's
rule set is not specified by the reference (it has no code); ``check`` /
``quality_score`` are our design, documented in the README.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sales import sales_validity, typed_amount


def _pct(part: Column, total: Column) -> Column:
    return (part.cast("double") / total.cast("double")) * F.lit(100)


def customer_quality(df: DataFrame, job_name: str, key: str = "customer_id") -> DataFrame:
    """Total, null ids, duplicates, and their percentages (0 on empty input).

    ``duplicate_records`` equals ``count - count(dropDuplicates([key]))``: all null
    keys collapse to one surviving row, so n null keys add n-1.
    """
    k = F.col(key)
    stats = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(k.isNull()).alias("null_records"),
        F.count_distinct(k).alias("_distinct"),
    )
    total = F.col("total_records")
    dup = total - F.col("_distinct") - F.when(F.col("null_records") > 0, 1).otherwise(0)
    return stats.select(
        F.lit(job_name).alias("job_name"),
        "total_records",
        "null_records",
        dup.cast("bigint").alias("duplicate_records"),
        F.when(total > 0, _pct(F.col("null_records"), total)).otherwise(F.lit(0.0)).alias(
            "null_percentage"
        ),
        F.when(total > 0, _pct(dup, total)).otherwise(F.lit(0.0)).alias("duplicate_percentage"),
    )


def quality_from_counts(job_name: str, total: int, nulls: int, distinct_ids: int) -> dict:
    """I1 from three observed counts (raw rows, null ids, rows after dedup): the same
    numbers ``customer_quality`` computes, for jobs that already have the counts."""
    dup = total - distinct_ids - (1 if nulls > 0 else 0)
    return {
        "job_name": job_name,
        "total_records": total,
        "null_records": nulls,
        "duplicate_records": dup,
        "null_percentage": (nulls / total) * 100 if total > 0 else 0,
        "duplicate_percentage": (dup / total) * 100 if total > 0 else 0,
    }


def sales_quality(df: DataFrame) -> DataFrame:
    """Total, null customer ids, amounts <= 0, and the valid percentage.

    ``valid_records_percentage`` keeps the reference formula (a null amount is not
    counted as invalid; a row with both faults is subtracted twice); null on empty
    input instead of a division error. ``exact_valid_percentage`` counts rows that
    pass the job's filter.
    """
    amount = typed_amount(df)
    cust = F.col("customer_id")
    stats = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(cust.isNull()).alias("null_customer_ids"),
        F.count_if(amount <= 0).alias("invalid_amounts"),
        F.count_if(sales_validity(df)).alias("_valid"),
    )
    total = F.col("total_records")
    return stats.select(
        "total_records",
        "null_customer_ids",
        "invalid_amounts",
        (
            F.try_divide(
                (total - F.col("null_customer_ids") - F.col("invalid_amounts")).cast("double"),
                total.cast("double"),
            )
            * F.lit(100)
        ).alias("valid_records_percentage"),
        (F.try_divide(F.col("_valid").cast("double"), total.cast("double")) * F.lit(100)).alias(
            "exact_valid_percentage"
        ),
    )


def orphans(sales: DataFrame, customers: DataFrame, key: str = "customer_id") -> DataFrame:
    """Sales whose customer is not in the customer table (a left anti join)."""
    return sales.join(customers.select(key), key, "left_anti")


# --------------------------------------------------------------------------- rules


@dataclass(frozen=True)
class Rule:
    """One quality rule. ``kind`` is one of not_null, unique, range, allowed,
    reference, freshness. ``weight`` feeds the quality score."""

    name: str
    kind: str
    column: str
    low: float | None = None
    high: float | None = None
    values: Sequence[str] = field(default_factory=tuple)
    max_age_days: int | None = None
    weight: float = 1.0
    threshold: float = 100.0


def _failed_expr(rule: Rule, as_of: Column | None) -> Column:
    c = F.col(rule.column)
    if rule.kind == "not_null":
        return F.count_if(c.isNull())
    if rule.kind == "range":
        bad = F.lit(False)
        if rule.low is not None:
            bad = bad | (c < F.lit(rule.low))
        if rule.high is not None:
            bad = bad | (c > F.lit(rule.high))
        return F.count_if(c.isNotNull() & bad)
    if rule.kind == "allowed":
        return F.count_if(c.isNotNull() & ~c.isin(*rule.values))
    if rule.kind == "freshness":
        return F.count_if(
            c.isNotNull() & (F.datediff(F.to_date(as_of), F.to_date(c)) > F.lit(rule.max_age_days))
        )
    raise ValueError(f"rule kind {rule.kind!r} is not a row-level rule")


def check(
    df: DataFrame,
    rules: Sequence[Rule],
    table_name: str,
    references: dict[str, DataFrame] | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """One row per rule: (table_name, rule, kind, column_name, checked, failed,
    pass_rate, weight, passed).

    ``checked`` counts the rows a rule can judge: all rows for not_null, the rows with a
    value for the others, so missing values don't lift the pass rate of a value rule.
    Without such a row the rate is 100.

    All rules are one aggregate over one scan (reference rules join the distinct
    reference keys first); the single result row is unpivoted into rule rows.
    """
    references = references or {}
    # Each reference rule adds a hit flag by a left join against the distinct
    # reference keys, so every rule is counted in the same single aggregate.
    data = df
    for i, r in enumerate(rules):
        if r.kind == "reference":
            ref = references[r.name]
            keys = ref.select(F.col(ref.columns[0]).alias(r.column)).distinct()
            data = data.join(keys.withColumn(f"_hit{i}", F.lit(True)), r.column, "left")
    aggs = []
    for i, r in enumerate(rules):
        judged = F.lit(1) if r.kind == "not_null" else F.col(r.column)
        aggs.append(F.count(judged).alias(f"_n{i}"))
        if r.kind == "unique":
            aggs.append(F.count_distinct(F.col(r.column)).alias(f"_d{i}"))
        elif r.kind == "reference":
            aggs.append(
                F.count_if(F.col(r.column).isNotNull() & F.col(f"_hit{i}").isNull()).alias(f"_f{i}")
            )
        else:
            aggs.append(_failed_expr(r, as_of).alias(f"_f{i}"))
    stats = data.agg(*aggs)
    entries = []
    for i, r in enumerate(rules):
        if r.kind == "unique":
            failed = F.col(f"_n{i}") - F.col(f"_d{i}")
        else:
            failed = F.col(f"_f{i}")
        entries.append(
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit(r.kind).alias("kind"),
                F.lit(r.column).alias("column_name"),
                F.col(f"_n{i}").alias("checked"),
                failed.cast("bigint").alias("failed"),
                F.lit(float(r.weight)).alias("weight"),
                F.lit(float(r.threshold)).alias("_threshold"),
            )
        )
    # Unpivot the one stats row into one row per rule.
    report = stats.select(F.lit(table_name).alias("table_name"), F.inline(F.array(*entries)))
    rate = F.when(
        F.col("checked") > 0,
        (F.col("checked") - F.col("failed")).cast("double") / F.col("checked").cast("double") * 100,
    ).otherwise(F.lit(100.0))
    return (
        report.withColumn("pass_rate", rate)
        .withColumn("passed", F.col("pass_rate") >= F.col("_threshold"))
        .drop("_threshold")
    )


def quality_score(report: DataFrame) -> DataFrame:
    """Weighted mean of rule pass rates per table, plus rule counts.

    A table's rules (a short, given list) are added up in the order of their names, so
    the score doesn't depend on how rows were partitioned.
    """
    def added(value: Column) -> Column:
        of_rules = F.array_sort(F.collect_list(F.struct(F.col("rule"), value.alias("x"))))
        return F.aggregate(of_rules, F.lit(0.0), lambda total, r: total + r["x"])

    return report.groupBy("table_name").agg(
        (added(F.col("pass_rate") * F.col("weight")) / added(F.col("weight"))).alias("quality_score"),
        F.count(F.lit(1)).alias("rules_checked"),
        F.count_if("passed").alias("rules_passed"),
    )
