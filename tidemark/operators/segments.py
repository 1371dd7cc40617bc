"""Customer segmentation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.constants import SEGMENT_DEFAULT, SEGMENT_RULES, TOTAL_TYPE
from tidemark.functions import customer_segment


def customer_segments(
    sales: DataFrame,
    rules: Sequence[tuple[str, float | None, float | None]] = SEGMENT_RULES,
    default: str = SEGMENT_DEFAULT,
    with_row_count: bool = False,
) -> DataFrame:
    """One row per customer: spend, order count, average, first/last date, segment.

    A plain group-by: partial aggregation runs before the shuffle, so a customer
    with a third of all rows still sends one partial row per map task.
    ``total_orders`` counts non-null sale ids, as the reference does.
    ``with_row_count`` adds ``_n`` (all rows), so the same aggregate also gives
    the group sizes the hot-customer split needs.
    """
    extra = [F.count(F.lit(1)).alias("_n")] if with_row_count else []
    agg = sales.groupBy("customer_id").agg(
        *extra,
        F.sum("amount").cast(TOTAL_TYPE).alias("total_spent"),
        F.count("sale_id").alias("total_orders"),
        (F.sum("amount").cast("double") / F.count("amount")).alias("avg_order_value"),
        F.max("sale_date").alias("last_purchase_date"),
        F.min("sale_date").alias("first_purchase_date"),
    )
    return agg.withColumns(
        {
            "customer_lifetime_days": F.datediff("last_purchase_date", "first_purchase_date"),
            "customer_segment": customer_segment("total_spent", "total_orders", rules, default),
        }
    )


def attach_segments(sales: DataFrame, segments: DataFrame) -> DataFrame:
    """Left join of the segment columns onto every sale, USING customer_id.

    No broadcast hint: the segment table grows with the customer count, so the
    choice is left to adaptive execution, which broadcasts only a measured-small
    side and splits skewed join partitions otherwise.
    """
    seg = segments.select("customer_id", "customer_segment", "total_spent", "total_orders")
    return sales.join(seg, "customer_id", "left")


def segment_distribution(segments: DataFrame) -> DataFrame:
    """Customers per segment, kept as a DataFrame (not collected to a dict)."""
    return segments.groupBy("customer_segment").agg(F.count(F.lit(1)).alias("customer_count"))


def segment_map(segments: DataFrame) -> DataFrame:
    """The segment → count dictionary as one MapType cell (segments are few)."""
    dist = segment_distribution(segments)
    return dist.agg(
        F.map_from_entries(
            F.array_sort(F.collect_list(F.struct("customer_segment", "customer_count")))
        ).alias("customer_segments")
    )


def enrich_sales(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Sales with their customer's attributes (inner join on customer_id).

    Customers are one row per id after dedup; the join is left to adaptive
    execution (broadcast only when the customer side measures small, else a
    sort-merge join with skewed partitions split).
    """
    return sales.join(customers, "customer_id", "inner")
