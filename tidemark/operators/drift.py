"""Schema discovery and drift over raw text columns (A11, re-aimed).

The reference runs a daily schema-discovery pass over the raw files and updates
the catalog in place. Here inference reads *all* rows of the text columns (no
sample): every value is classified once (integer, wide integer, decimal, date,
timestamp, boolean, text) and the kinds are counted per column in one partial
aggregate. The narrowest type that fits every value wins.
A number has no leading zero (codes such as ``02139`` stay text), and integers that
their type can't hold take a wider one. Drift is a full outer join of two (column, type) tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns for what a text value "looks like".
INT_PATTERN = r"^-?(0|[1-9][0-9]*)$"
NUMBER_PATTERN = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
DATE_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIMESTAMP_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?$"

LARGEST_BIGINT = "9223372036854775807"

# What a value can be, and the types in the order they are tried: a column has the first
# type whose kinds cover all its values.
EMPTY, INTEGER, WIDE, NUMBER, DATE, TIMESTAMP, BOOLEAN, TEXT = range(8)
TYPES = (
    ("bigint", (INTEGER,)),
    ("decimal(38,0)", (INTEGER, WIDE)),
    ("double", (INTEGER, WIDE, NUMBER)),
    ("date", (DATE,)),
    ("timestamp", (DATE, TIMESTAMP)),
    ("boolean", (BOOLEAN,)),
)


def _text(c: str) -> Column:
    return F.trim(F.col(c).cast("string"))


def value_kind(v: Column) -> Column:
    """The kind of one text value: EMPTY for null and '', else the first that fits.

    Whether an integer fits is told from its digits: a cast that fails costs an exception
    each, and a column of wide integers would fail on every row.
    """
    digits = F.regexp_replace(v, "^-", "")
    fits = (F.length(v) < 19) | (F.length(digits) < 19) | ((F.length(digits) == 19) & (digits <= LARGEST_BIGINT))
    return (
        F.when(v.isNull() | (v == ""), F.lit(EMPTY))
        .when(v.rlike(INT_PATTERN) & fits, F.lit(INTEGER))
        .when(v.rlike(INT_PATTERN) & (F.length(digits) <= 38), F.lit(WIDE))
        .when(v.rlike(NUMBER_PATTERN), F.lit(NUMBER))
        .when(v.rlike(DATE_PATTERN) & v.try_cast("date").isNotNull(), F.lit(DATE))
        .when(v.rlike(TIMESTAMP_PATTERN) & v.try_cast("timestamp_ntz").isNotNull(), F.lit(TIMESTAMP))
        .when(F.lower(v).isin("true", "false"), F.lit(BOOLEAN))
        .otherwise(F.lit(TEXT))
    )


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, inferred_type, non_null, total) for each column.

    The values of a row stream through one small classifier and are counted by
    (column, kind) in the same stage: each task sends a few counts per column. (One
    ``count_if`` per column and type makes a method too large to be compiled; it took
    five times as long.) A column without any value is a string.
    """
    cols = list(columns or df.columns)
    long = df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("i"), _text(c).alias("v")) for i, c in enumerate(cols)])))
    counts = long.select("i", value_kind(F.col("v")).alias("k")).groupBy("i", "k").agg(F.count(F.lit(1)).alias("n"))

    name = F.get(F.array(*map(F.lit, cols)), F.col("i"))
    return types_of(counts, "i").select(name.alias("column_name"), "inferred_type", "non_null", "total")


def types_of(counts: DataFrame, by: str) -> DataFrame:
    """(by, inferred_type, non_null, total) from counts (by, k, n) of values by kind.

    Counts of parts of a table add up to those of the whole, so the types of all files
    follow from the files' own counts.
    """

    def covered(of: Sequence[int]) -> Column:
        return F.coalesce(F.sum(F.when(F.col("k").isin(*of), F.col("n"))), F.lit(0))

    n = F.col("non_null")
    inferred = F.when(n == 0, F.lit("string"))
    for t, (type_name, _) in enumerate(TYPES):
        inferred = inferred.when(F.col(f"n{t}") == n, F.lit(type_name))
    stats = counts.groupBy(by).agg(
        covered(range(INTEGER, TEXT + 1)).alias("non_null"),
        F.sum("n").alias("total"),
        *(covered(of).alias(f"n{t}") for t, (_, of) in enumerate(TYPES)),
    )
    return stats.select(by, inferred.otherwise(F.lit("string")).alias("inferred_type"), "non_null", "total")


def widened(a: Column, b: Column) -> Column:
    """The least type that holds the values of both: the join of a lattice.

    Below all is null (a column without a value), above all string; numbers widen from
    bigint over decimal(38,0) to double, dates to timestamps.
    """
    out = F.when(a.isNull(), b).when(b.isNull() | (a == b), a)
    for chain in (("bigint", "decimal(38,0)", "double"), ("date", "timestamp")):
        for i in range(len(chain) - 1, 0, -1):
            both = a.isin(*chain[: i + 1]) & b.isin(*chain[: i + 1])
            out = out.when(both & ((a == chain[i]) | (b == chain[i])), F.lit(chain[i]))
    return out.otherwise(F.lit("string"))


def schema_drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """Compare two (column_name, inferred_type) tables: added, removed, type_changed, unchanged."""
    o = old.select("column_name", F.col("inferred_type").alias("old_type"))
    n = new.select("column_name", F.col("inferred_type").alias("new_type"))
    joined = o.join(n, "column_name", "full_outer")
    change = (
        F.when(F.col("old_type").isNull(), F.lit("added"))
        .when(F.col("new_type").isNull(), F.lit("removed"))
        .when(F.col("old_type") != F.col("new_type"), F.lit("type_changed"))
        .otherwise(F.lit("unchanged"))
    )
    return joined.withColumn("change", change)
