"""Config-driven CASE expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.constants import (
    AGE_BANDS,
    AGE_DEFAULT,
    AMOUNT_BANDS,
    AMOUNT_DEFAULT,
    SEGMENT_DEFAULT,
    SEGMENT_RULES,
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def band(value: Column | str, bands: Sequence[tuple[float, str]], default: str) -> Column:
    """Half-open bands: the first ``value < bound`` wins, else ``default``.

    A null value fails every test and falls through to ``default``.
    """
    v = _col(value)
    expr = None
    for bound, label in bands:
        expr = F.when(v < F.lit(bound), label) if expr is None else expr.when(v < F.lit(bound), label)
    return F.lit(default) if expr is None else expr.otherwise(default)


def age_group(
    age: Column | str = "age",
    bands: Sequence[tuple[float, str]] = AGE_BANDS,
    default: str = AGE_DEFAULT,
    null_label: str | None = None,
) -> Column:
    """Age band; a null age lands in ``default`` unless ``null_label`` is given."""
    expr = band(age, bands, default)
    if null_label is not None:
        expr = F.when(_col(age).isNull(), F.lit(null_label)).otherwise(expr)
    return expr


def amount_category(
    amount: Column | str = "amount",
    bands: Sequence[tuple[float, str]] = AMOUNT_BANDS,
    default: str = AMOUNT_DEFAULT,
) -> Column:
    return band(amount, bands, default)


def customer_segment(
    total_spent: Column | str = "total_spent",
    total_orders: Column | str = "total_orders",
    rules: Sequence[tuple[str, float | None, float | None]] = SEGMENT_RULES,
    default: str = SEGMENT_DEFAULT,
) -> Column:
    """Strict ``>`` tests on spend and order count, first match wins."""
    spent, orders = _col(total_spent), _col(total_orders)
    expr = None
    for label, min_spent, min_orders in rules:
        cond = F.lit(True)
        if min_spent is not None:
            cond = cond & (spent > F.lit(min_spent))
        if min_orders is not None:
            cond = cond & (orders > F.lit(min_orders))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return F.lit(default) if expr is None else expr.otherwise(default)
