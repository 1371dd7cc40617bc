"""Customer cleaning, dedup, enrichment and output mapping."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.constants import CUSTOMER_JOB, CUSTOMER_LINEAGE_JOB, CUSTOMER_SOURCE
from tidemark.functions import age_group, email_domain, full_name
from tidemark.operators.sales import as_of_literal
from tidemark.schemas import PROCESSED_CUSTOMER_COLUMNS


def dedup_latest(
    df: DataFrame, key: str = "customer_id", latest_by: Sequence[str] = ("registration_date",)
) -> DataFrame:
    """One row per key: the greatest ``latest_by``, ties broken by the other columns.

    Deterministic replacement for ``dropDuplicates([key])``. Written as ``max`` of a
    struct (latest_by first, then the remaining columns in schema order), which
    compares field by field with nulls lowest — i.e. descending, nulls last. It is
    an aggregate, so it is combined map-side before the shuffle and a hot key
    never reaches one task as a whole group.
    """
    rest = [c for c in df.columns if c != key and c not in latest_by]
    ordered = list(latest_by) + rest
    picked = df.groupBy(key).agg(F.max(F.struct(*ordered)).alias("_pick"))
    return picked.select(*[F.col(f"_pick.{c}").alias(c) if c != key else F.col(key) for c in df.columns])


def enrich_customers(
    df: DataFrame,
    as_of: _dt.datetime | str | None = None,
    job_name: str = CUSTOMER_JOB,
    data_source: str = CUSTOMER_SOURCE,
    null_age_label: str | None = None,
) -> DataFrame:
    return df.withColumns(
        {
            "full_name": full_name("first_name", "last_name"),
            "email_domain": email_domain("email"),
            "age_group": age_group("age", null_label=null_age_label),
            "registration_year": F.year("registration_date"),
            "processed_timestamp": as_of_literal(as_of),
            "data_source": F.lit(data_source),
            "etl_job_name": F.lit(job_name),
        }
    )


def customer_lineage(
    df: DataFrame, source_path: str, as_of: _dt.datetime | str | None = None
) -> DataFrame:
    """The lineage struct, kept as its own narrow table keyed by customer_id."""
    return df.select(
        "customer_id",
        F.struct(
            F.lit(CUSTOMER_LINEAGE_JOB).alias("job_name"),
            as_of_literal(as_of).alias("processed_at"),
            F.lit(source_path).alias("source_path"),
        ).alias("data_lineage"),
    )


def map_customers(df: DataFrame) -> DataFrame:
    """rename/cast/prune to the 13-column output contract."""
    cols = []
    for name, dtype in PROCESSED_CUSTOMER_COLUMNS:
        cols.append(F.col(name).cast(dtype).alias(name))
    return df.select(*cols)


def clean_customers(
    df: DataFrame,
    as_of: _dt.datetime | str | None = None,
    job_name: str = CUSTOMER_JOB,
    null_age_label: str | None = None,
) -> DataFrame:
    """Filter null ids, keep the latest row per id, enrich, map to the output contract."""
    valid = df.filter(F.col("customer_id").isNotNull())
    return map_customers(
        enrich_customers(dedup_latest(valid), as_of, job_name, null_age_label=null_age_label)
    )


def reject_customers(df: DataFrame, as_of: _dt.datetime | str | None = None) -> DataFrame:
    """Rows the customer job drops for a null id (duplicates are not rejects)."""
    return (
        df.filter(F.col("customer_id").isNull())
        .withColumn("reject_reason", F.lit("null_customer_id"))
        .withColumn("rejected_at", as_of_literal(as_of))
    )
