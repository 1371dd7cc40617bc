"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.constants import DATE_FORMAT


def parse_date(c: Column | str, dtype: T.DataType | None = None, fmt: str = DATE_FORMAT) -> Column:
    """Text → date with bad text as null (never an error under ANSI mode).

    Dates pass through; timestamps are truncated to their date.
    """
    col = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, T.DateType):
        return col
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(col)
    return F.try_to_date(col.cast("string"), fmt)


def is_weekend(day_of_week: Column | str = "day_of_week") -> Column:
    """1 = Sunday, 7 = Saturday; a null day is not a weekend."""
    d = F.col(day_of_week) if isinstance(day_of_week, str) else day_of_week
    return F.when(d.isin(1, 7), True).otherwise(False)


def date_parts(sale_date: Column | str = "sale_date") -> dict[str, Column]:
    d = F.col(sale_date) if isinstance(sale_date, str) else sale_date
    return {
        "sales_year": F.year(d),
        "sales_month": F.month(d),
        "sales_quarter": F.quarter(d),
        "day_of_week": F.dayofweek(d),
    }


def iso_time(c: Column | str) -> Column:
    """A timestamp as ISO text; the fraction, in microseconds, only where it isn't zero."""
    ts = F.col(c) if isinstance(c, str) else c
    fraction = F.date_format(ts, ".SSSSSS")
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(fraction == ".000000", whole).otherwise(F.concat(whole, fraction))
