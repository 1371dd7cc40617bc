"""Per-customer window metrics on sales rows.

The reference computes five windows over three partition specs:

* ``monthly_total``, ``avg_order_value`` over (customer_id, sales_month) — all
  years of one calendar month pool together (``month_scope="month"``, default);
* ``yearly_total`` over (customer_id, sales_year);
* ``order_rank_in_month`` = row_number over (customer_id, sales_month) by amount
  desc (we add sale_id as tie-breaker);
* ``running_total`` over (customer_id) by sale_date, RANGE frame, so rows of one
  date share a total and null dates come first.

Two physical strategies give identical rows:

``window``  one hash exchange on customer_id, then all windows in that partitioning.
            Cheapest, but every row of a customer goes to one task.
``skew_safe`` totals are partial aggregates per (customer, date) — at most one row
            per calendar day per customer, whatever the row count — then windowed
            over that small table and joined back; the rank uses the range-sliced
            row_number. No task ever holds a whole customer.
``auto``    splits the rows: customers with more than ``max_rows`` rows (found by a
            key-only partial aggregate) take ``skew_safe``, all others ``window``;
            the two results are unioned. Without hot customers this is exactly
            the ``window`` plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.constants import TOTAL_TYPE
from tidemark.operators.ranking import (
    number_slices,
    rank_slices,
    row_number_skew_safe,
    row_number_window,
    split_hot,
)

DEFAULT_MAX_GROUP_ROWS = 4_000_000


def rank_order() -> list[Column]:
    """Amount descending, then sale_id ascending (nulls first) as the tie-breaker."""
    return [F.col("amount").desc(), F.col("sale_id").asc_nulls_first()]


def _month_key(month_scope: str) -> list[str]:
    if month_scope == "month":
        return ["customer_id", "sales_month"]
    if month_scope == "year_month":
        return ["customer_id", "sales_year", "sales_month"]
    raise ValueError(f"month_scope must be 'month' or 'year_month', not {month_scope!r}")


def check_strategy(strategy: str) -> str:
    if strategy not in ("auto", "window", "skew_safe"):
        raise ValueError(f"unknown strategy {strategy!r}")
    return strategy


def metrics_window(df: DataFrame, month_scope: str) -> DataFrame:
    """All five windows over one hash exchange on customer_id, with two sorts.

    Each sort serves two windows. The rank's sort (customer, month, amount desc,
    sale_id) also serves the monthly sum and average, whose required ordering is
    its prefix. The running total is ordered by (year, date) — the same peers as
    by date alone, since the year follows from the date — and the yearly total is
    written as a RANGE frame over the current year on the same customer partition,
    so both run on one (customer, year, date) sort.
    """
    month_keys = _month_key(month_scope)
    month = Window.partitionBy(*month_keys)
    by_year = Window.partitionBy("customer_id").orderBy(F.col("sales_year").asc_nulls_first())
    running = (
        Window.partitionBy("customer_id")
        .orderBy(F.col("sales_year").asc_nulls_first(), F.col("sale_date").asc_nulls_first())
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    amount = F.col("amount")
    out = (
        df.repartition("customer_id")
        .withColumn("running_total", F.sum(amount).over(running).cast(TOTAL_TYPE))
        .withColumn(
            "yearly_total",
            F.sum(amount).over(by_year.rangeBetween(Window.currentRow, Window.currentRow)).cast(TOTAL_TYPE),
        )
        .withColumn("order_rank_in_month", F.row_number().over(month.orderBy(*rank_order())))
        .withColumns(
            {
                "monthly_total": F.sum(amount).over(month).cast(TOTAL_TYPE),
                "avg_order_value": F.sum(amount).over(month).cast("double") / F.count(amount).over(month),
            }
        )
    )
    return out.select(*df.columns, *METRIC_COLUMNS)


def daily_totals(df: DataFrame, month_scope: str = "month", customer_totals: bool = False) -> DataFrame:
    """Per (customer_id, sale_date): month/year totals, month average, running total.

    With ``customer_totals`` also the customer's total_spent and total_orders.

    The only pass over the rows is a partial aggregate; everything after it works
    on at most one row per customer and calendar day.
    """
    daily = (
        df.groupBy("customer_id", "sale_date")
        .agg(
            F.sum("amount").alias("_day_sum"),
            F.count("amount").alias("_day_n"),
            *([F.count("sale_id").alias("_day_orders")] if customer_totals else []),
        )
        .withColumns({"sales_year": F.year("sale_date"), "sales_month": F.month("sale_date")})
        .repartition("customer_id")
    )
    month = Window.partitionBy(*_month_key(month_scope))
    year = Window.partitionBy("customer_id", "sales_year")
    # Dates are unique per customer here, so a ROWS frame equals the RANGE frame.
    running = (
        Window.partitionBy("customer_id")
        .orderBy(F.col("sale_date").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    whole = Window.partitionBy("customer_id")
    totals = [
        F.sum("_day_sum").over(whole).cast(TOTAL_TYPE).alias("total_spent"),
        F.sum("_day_orders").over(whole).alias("total_orders"),
    ]
    return daily.select(
        "customer_id",
        "sale_date",
        F.sum("_day_sum").over(month).cast(TOTAL_TYPE).alias("monthly_total"),
        F.sum("_day_sum").over(year).cast(TOTAL_TYPE).alias("yearly_total"),
        (F.sum("_day_sum").over(month).cast("double") / F.sum("_day_n").over(month)).alias(
            "avg_order_value"
        ),
        F.sum("_day_sum").over(running).cast(TOTAL_TYPE).alias("running_total"),
        *(totals if customer_totals else []),
    )


def attach_daily(df: DataFrame, daily: DataFrame) -> DataFrame:
    """Join per-date metrics back to every row; null customers and dates match null ones.

    Adaptive execution broadcasts ``daily`` only when its measured size is below
    the broadcast threshold; otherwise it is a sort-merge join whose skewed
    partitions (a hot customer-date) are split by the skew-join rule.
    """
    d = daily.alias("_d")
    s = df.alias("_s")
    cond = F.col("_s.customer_id").eqNullSafe(F.col("_d.customer_id")) & F.col("_s.sale_date").eqNullSafe(
        F.col("_d.sale_date")
    )
    extra = [c for c in daily.columns if c not in ("customer_id", "sale_date")]
    return s.join(d, cond, "inner").select("_s.*", *[F.col(f"_d.{c}") for c in extra])


METRIC_COLUMNS = (
    "monthly_total",
    "yearly_total",
    "avg_order_value",
    "order_rank_in_month",
    "running_total",
)
CUSTOMER_TOTALS = ("total_spent", "total_orders")


def metrics_skew_safe(df: DataFrame, month_scope: str, customer_totals: bool = False) -> DataFrame:
    """Rank by range slices; totals from the per-date table, joined back once.

    ``df`` is read once, to write the slices: the ranks and the per-date table both
    come from them. ``customer_totals`` adds total_spent and total_orders.
    """
    keys = _month_key(month_scope)
    slices = rank_slices(df, keys, rank_order())
    ranked = number_slices(slices, keys, "order_rank_in_month")
    joined = attach_daily(ranked, daily_totals(slices, month_scope, customer_totals))
    return joined.select(*df.columns, *METRIC_COLUMNS, *(CUSTOMER_TOTALS if customer_totals else ()))


def business_metrics(
    df: DataFrame,
    strategy: str = "auto",
    month_scope: str = "month",
    max_rows: int = DEFAULT_MAX_GROUP_ROWS,
) -> DataFrame:
    """Add monthly_total, yearly_total, avg_order_value, order_rank_in_month, running_total."""
    if check_strategy(strategy) == "auto":
        light, hot = split_hot(df, ["customer_id"], max_rows)
        if hot is None:
            return metrics_window(df, month_scope)
        return metrics_window(light, month_scope).unionByName(metrics_skew_safe(hot, month_scope))
    if strategy == "window":
        return metrics_window(df, month_scope)
    return metrics_skew_safe(df, month_scope)


def order_rank(
    df: DataFrame,
    strategy: str = "auto",
    month_scope: str = "month",
    max_rows: int = DEFAULT_MAX_GROUP_ROWS,
) -> DataFrame:
    """E4 alone: order_rank_in_month."""
    keys = _month_key(month_scope)
    name = "order_rank_in_month"
    if check_strategy(strategy) == "auto":
        light, hot = split_hot(df, keys, max_rows)
        if hot is None:
            return row_number_window(df, keys, rank_order(), name)
        return row_number_window(light, keys, rank_order(), name).unionByName(
            row_number_skew_safe(hot, keys, rank_order(), name)
        )
    if strategy == "window":
        return row_number_window(df, keys, rank_order(), name)
    return row_number_skew_safe(df, keys, rank_order(), name)


def running_total(df: DataFrame) -> DataFrame:
    """E5 alone, always in the skew-safe form: daily partial sums, running sum, join back."""
    daily = (
        df.groupBy("customer_id", "sale_date")
        .agg(F.sum("amount").alias("_day_sum"))
        .withColumn(
            "running_total",
            F.sum("_day_sum")
            .over(
                Window.partitionBy("customer_id")
                .orderBy(F.col("sale_date").asc_nulls_first())
                .rowsBetween(Window.unboundedPreceding, Window.currentRow)
            )
            .cast(TOTAL_TYPE),
        )
        .drop("_day_sum")
    )
    return attach_daily(df, daily)


def top_orders(df: DataFrame, k: int = 3, month_scope: str = "month") -> DataFrame:
    """the k largest orders per customer-month.

    ``row_number() <= k`` is planned as a WindowGroupLimit that runs partially
    before the shuffle, so each map task forwards at most k rows per group.
    """
    keys = _month_key(month_scope)
    return row_number_window(df, keys, rank_order(), "order_rank_in_month").filter(
        F.col("order_rank_in_month") <= k
    )
