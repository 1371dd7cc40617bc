"""Column expressions: pure functions from Columns to a Column (JVM-side, codegen)."""

from tidemark.functions.bands import age_group, amount_category, band, customer_segment
from tidemark.functions.dates import date_parts, is_weekend, iso_time, parse_date
from tidemark.functions.text import email_domain, full_name, job_full_name, nested_or

__all__ = [
    "age_group",
    "amount_category",
    "band",
    "customer_segment",
    "date_parts",
    "is_weekend",
    "iso_time",
    "parse_date",
    "email_domain",
    "full_name",
    "job_full_name",
    "nested_or",
]
