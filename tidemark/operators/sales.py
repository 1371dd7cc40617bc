"""Sales cleaning and enrichment."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.constants import AMOUNT_TYPE, RAW_AMOUNT_TYPE, SALES_JOB, SALES_SOURCE
from tidemark.functions import amount_category, date_parts, is_weekend, parse_date
from tidemark.operators.drift import NUMBER_PATTERN


def as_of_literal(as_of: _dt.datetime | str | None) -> Column:
    """One timestamp per run (a literal), instead of re-reading the clock per action."""
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def typed_amount(df: DataFrame, column: str = "amount") -> Column:
    """Amounts as exact decimals, not yet rounded; text that is not a number becomes null.

    A number of more digits than the type has is null too; ``reject_reason`` tells the two apart.
    """
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.DecimalType):
        return F.col(column)
    return F.col(column).try_cast(RAW_AMOUNT_TYPE)


def sales_validity(df: DataFrame) -> Column:
    """The row filter of the sales job: a customer and a positive amount that the output type holds."""
    amount = typed_amount(df)
    return F.col("customer_id").isNotNull() & (amount > 0) & amount.try_cast(AMOUNT_TYPE).isNotNull()


def clean_sales(
    df: DataFrame,
    as_of: _dt.datetime | str | None = None,
    job_name: str = SALES_JOB,
    data_source: str = SALES_SOURCE,
    with_provenance: bool = True,
) -> DataFrame:
    """Drop rows without a customer or with a non-positive amount; add date parts and bands.

    One projection after the filter, so the whole step is a single codegen stage and
    the not-null filter reaches a Parquet scan as a pushed filter.
    """
    date = parse_date("sale_date", df.schema["sale_date"].dataType)
    filtered = df.filter(sales_validity(df)).withColumns(
        {"amount": typed_amount(df).try_cast(AMOUNT_TYPE), "sale_date": date}
    )
    parts = date_parts("sale_date")
    cols = {
        **parts,
        "is_weekend": is_weekend(parts["day_of_week"]),
        "amount_category": amount_category("amount"),
    }
    if with_provenance:
        cols.update(
            {
                "processed_timestamp": as_of_literal(as_of),
                "data_source": F.lit(data_source),
                "etl_job_name": F.lit(job_name),
            }
        )
    return filtered.withColumns(cols)


CORRUPT_COLUMN = "_corrupt_record"


def reject_reason(df: DataFrame) -> Column:
    """The first rule a raw sales row fails (null when the job keeps it). A line
    that did not parse as the declared types (``_corrupt_record`` set) is
    ``malformed_row``."""
    amount = typed_amount(df)
    first = F.when(F.lit(False), F.lit(None).cast("string"))
    if CORRUPT_COLUMN in df.columns:
        first = F.when(F.col(CORRUPT_COLUMN).isNotNull(), "malformed_row")
    text = not isinstance(df.schema["amount"].dataType, T.DecimalType)
    too_wide = amount.isNull() & F.trim(F.col("amount").cast("string")).rlike(NUMBER_PATTERN) if text else F.lit(False)
    return (
        first.when(F.col("customer_id").isNull(), "null_customer_id")
        .when(too_wide, "amount_out_of_range")
        .when(amount.isNull(), "null_amount")
        .when(amount <= 0, "non_positive_amount")
        .when(amount.try_cast(AMOUNT_TYPE).isNull(), "amount_out_of_range")
    )


def stage_sales(raw: DataFrame) -> DataFrame:
    """Raw rows with a typed amount and ``reject_reason`` — one table for kept and
    rejected rows, written in one pass."""
    return raw.withColumns({"amount": typed_amount(raw), "reject_reason": reject_reason(raw)})


def kept_rows(staged: DataFrame) -> DataFrame:
    """The staged rows the job keeps, without the staging-only columns."""
    drop = [c for c in ("reject_reason", CORRUPT_COLUMN, "batch_id", "customer_bucket") if c in staged.columns]
    return staged.filter(F.col("reject_reason").isNull()).drop(*drop)


def reject_sales(df: DataFrame, as_of: _dt.datetime | str | None = None) -> DataFrame:
    """Rows the sales job drops, with the first failing reason."""
    return (
        df.withColumn("reject_reason", reject_reason(df))
        .filter(F.col("reject_reason").isNotNull())
        .withColumn("rejected_at", as_of_literal(as_of))
    )
