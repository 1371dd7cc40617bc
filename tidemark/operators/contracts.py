"""Declared columns compiled to casts that can't fail.

Under ANSI rules one value that its type can't hold fails a whole job. Here a contract, one
rule a column, becomes two expressions for each: the typed value, null where there is none,
and the reason why a value was refused. Rows keep going with all their reasons; who wants them
apart takes ``accepted`` and ``refused``.

All of it is column expressions in one projection: nothing is shuffled or read twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.drift import INT_PATTERN, NUMBER_PATTERN

MISSING, BROKEN, OUT_OF_RANGE, TOO_LONG, NOT_ALLOWED = "missing", "broken", "out_of_range", "too_long", "not_allowed"
REASONS = "reasons"

_INTEGERS = ("tinyint", "smallint", "int", "bigint")
_NUMBERS = ("float", "double", "decimal")


@dataclass(frozen=True)
class ColumnRule:
    """One column of a contract. ``dtype`` is a Spark SQL type; text is trimmed unless it is kept as string.

    ``low`` and ``high`` are the least and greatest value allowed, as SQL literals of the type
    (``"0.01"``, ``"2020-01-01"``); ``date_format`` is that of date text.
    """

    name: str
    dtype: str
    required: bool = False
    low: str | None = None
    high: str | None = None
    max_length: int | None = None
    allowed: Sequence[str] = field(default_factory=tuple)
    date_format: str | None = None


def _is_number(rule: ColumnRule) -> bool:
    return rule.dtype.startswith((*_INTEGERS, *_NUMBERS))


def typed(rule: ColumnRule, value: Column) -> Column:
    """The value in its type, null where it has none."""
    if rule.dtype == "string":
        return value
    if rule.dtype == "date" and rule.date_format:
        return F.try_to_date(F.trim(value), rule.date_format)
    cast = F.trim(value).try_cast(rule.dtype)
    if rule.dtype in ("float", "double"):  # a number's text only: no NaN, no infinity
        return F.when(~F.isnan(cast) & (F.abs(cast) != float("inf")), cast)
    return cast


def refusal(rule: ColumnRule, value: Column) -> Column:
    """Why the value can't be taken, or null. A missing value is only refused where one is required."""
    text = value if rule.dtype == "string" else F.trim(value)
    empty = text.isNull() | (text == "")
    reason = F.when(empty, F.lit(MISSING) if rule.required else F.lit(None).cast("string"))
    if rule.max_length is not None:
        reason = reason.when(F.length(value) > rule.max_length, F.lit(TOO_LONG))
    found = typed(rule, value)
    if rule.dtype != "string":
        if _is_number(rule):
            # A well-formed number without a value is one that the type can't hold.
            pattern = INT_PATTERN if rule.dtype in _INTEGERS else NUMBER_PATTERN
            signed = F.regexp_replace(text, r"^([+-]?)0+(?=[0-9])", "$1")  # leading zeros are no fault of a number
            reason = reason.when(found.isNull() & F.regexp_replace(signed, r"^\+", "").rlike(pattern), F.lit(OUT_OF_RANGE))
        reason = reason.when(found.isNull(), F.lit(BROKEN))
    for limit, beyond in ((rule.low, lambda v, x: v < x), (rule.high, lambda v, x: v > x)):
        if limit is not None:
            reason = reason.when(beyond(found, F.lit(limit).cast(rule.dtype)), F.lit(OUT_OF_RANGE))
    if rule.allowed:
        reason = reason.when(~text.isin(*rule.allowed), F.lit(NOT_ALLOWED))
    return reason


def apply_contract(rows: DataFrame, rules: Sequence[ColumnRule], reasons: str = REASONS) -> DataFrame:
    """``rows`` with the rules' columns typed, the others as they are, and ``reasons``: an array of
    (column_name, reason, value) of every value that was refused, in the rules' order.

    Input columns are taken as text, whatever they are; one that the table lacks is missing
    in every row.
    """
    text = {r.name: F.col(f"`{r.name}`").cast("string") if r.name in rows.columns else F.lit(None).cast("string") for r in rules}
    found = [
        F.struct(F.lit(r.name).alias("column_name"), refusal(r, text[r.name]).alias("reason"), text[r.name].alias("value"))
        for r in rules
    ]
    others = [F.col(f"`{c}`") for c in rows.columns if c not in text and c != reasons]
    return rows.select(
        *(typed(r, text[r.name]).alias(r.name) for r in rules),
        *others,
        F.filter(F.array(*found), lambda x: x["reason"].isNotNull()).alias(reasons),
    )


def accepted(checked: DataFrame, reasons: str = REASONS) -> DataFrame:
    """The rows without a refused value."""
    return checked.where(F.size(reasons) == 0).drop(reasons)


def refused(checked: DataFrame, reasons: str = REASONS) -> DataFrame:
    """One row for each refused value: the row's columns, column_name, reason and value."""
    rest = [F.col(f"`{c}`") for c in checked.columns if c not in (reasons, "column_name", "reason", "value")]
    return checked.select(*rest, F.inline(reasons))


def refusal_counts(checked: DataFrame, rules: Sequence[ColumnRule], reasons: str = REASONS) -> DataFrame:
    """(column_name, reason, n): one aggregate of counts, combined before it is shuffled."""
    names = F.array(*[F.lit(r.name) for r in rules])
    each = checked.select(F.inline(reasons)).where(F.array_contains(names, F.col("column_name")))
    return each.groupBy("column_name", "reason").agg(F.count(F.lit(1)).alias("n"))


def all_typed(rules: Sequence[ColumnRule], row: dict[str, Column]) -> Column:
    """Whether no value of a row (name → text) is refused: a filter for plans that keep accepted rows only."""
    return reduce(lambda a, b: a & b, [refusal(r, row[r.name]).isNull() for r in rules], F.lit(True))
