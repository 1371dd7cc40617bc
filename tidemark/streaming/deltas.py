"""Incremental gold without rereading history (K4, SURVEY §7.4).

``ingest.refresh_sales_gold`` recomputes touched customers in each micro-batch, from their
staged history. Every metric of a sale depends on its customer's other sales (totals and
segment on all, the rank on the month's, the running total on the earlier ones), so rows that
are written out with their metrics must all be written anew whenever a customer buys again.

Here a micro-batch writes in proportion to itself alone:

* its rows, cleaned of nothing, under ``rows/batch_id=<n>``;
* one mergeable state for each of its customers (sums, counts, dates) under ``state/batch_id=<n>``.

It reads no history. Readers merge: ``merged_segments`` adds up the states, and
``merged_gold`` takes the folded rows of customers without a newer state as they are and runs
the metrics for the others only, over their folded rows and the newer ones. The states also
tell the hot customers, so nothing is counted for that. ``fold_gold`` writes the merge down as
the next base, when the newer states are a large enough part of all (``due``).

Every folder is written as a whole and counts when it is complete; a replayed batch writes its
own folders again. Old bases stay until the next fold, for readers that still use them.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.constants import TOTAL_TYPE
from tidemark.functions import customer_segment
from tidemark.operators.metrics import DEFAULT_MAX_GROUP_ROWS
from tidemark.operators.sales import clean_sales, kept_rows, stage_sales
from tidemark.plans.sales_job import process_sales
from tidemark.schemas import RAW_SALES
from tidemark.session import materialize
from tidemark.sinks import write_plain
from tidemark.sources.files import stream_raw
from tidemark.streaming.ingest import _hadoop_fs, _numbered, _started

STATE = ("spent", "orders", "amounts", "last_purchase_date", "first_purchase_date", "n")


def customer_state(clean: DataFrame) -> DataFrame:
    """Mergeable sums of each customer's sales; ``n`` counts rows."""
    return clean.groupBy("customer_id").agg(
        F.sum("amount").cast("decimal(38,2)").alias("spent"),
        F.count("sale_id").alias("orders"),
        F.count("amount").alias("amounts"),
        F.max("sale_date").alias("last_purchase_date"),
        F.min("sale_date").alias("first_purchase_date"),
        F.count(F.lit(1)).alias("n"),
    )


def merge_states(states: DataFrame) -> DataFrame:
    """States of the same customers, added up."""
    return states.groupBy("customer_id").agg(
        F.sum("spent").cast("decimal(38,2)").alias("spent"),
        F.sum("orders").alias("orders"),
        F.sum("amounts").alias("amounts"),
        F.max("last_purchase_date").alias("last_purchase_date"),
        F.min("first_purchase_date").alias("first_purchase_date"),
        F.sum("n").alias("n"),
    )


def ingest_deltas(
    spark: SparkSession, raw_dir: str, root: str, checkpoint: str, *, fmt: str = "csv", max_files: int | None = None
):
    """One stream run (availableNow) over the new files: rows and states, a folder of each for a micro-batch.

    A new checkpoint would read every file again, so over the rows of another one it fails.
    """
    root = root.rstrip("/")
    if not _started(spark, checkpoint) and (_numbered(spark, f"{root}/rows", "batch_id") or _numbered(spark, f"{root}/base", "v")):
        raise ValueError(f"{root} holds the rows of another checkpoint than {checkpoint}")
    staged = stage_sales(stream_raw(spark, raw_dir, RAW_SALES, fmt, max_files, keep_corrupt=True))

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = f"{root}/rows/batch_id={batch_id}"
        write_plain(batch, rows)
        mine = clean_sales(kept_rows(batch.sparkSession.read.parquet(rows)), with_provenance=False)
        write_plain(customer_state(mine), f"{root}/state/batch_id={batch_id}")

    query = (
        staged.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def _versions(spark: SparkSession, root: str) -> tuple[int | None, list[int]]:
    """The newest complete base, and the batches after it whose state (written last) is complete."""
    bases = _numbered(spark, f"{root}/base", "v", need_success=True)
    base = bases[-1] if bases else None
    done = _numbered(spark, f"{root}/state", "batch_id", need_success=True)
    return base, [n for n in done if base is None or n > base]


def _folders(spark: SparkSession, root: str, kind: str, batches: list[int]) -> DataFrame:
    return spark.read.parquet(*[f"{root}/{kind}/batch_id={n}" for n in batches])


def _states(spark: SparkSession, root: str, base: int | None, newer: list[int]) -> DataFrame:
    """All customers' merged states: the base's and those after it."""
    parts = [spark.read.parquet(f"{root}/base_state/v={base}")] if base is not None else []
    if newer:
        parts.append(_folders(spark, root, "state", newer))
    if not parts:
        raise ValueError(f"no batches under {root}")
    rows = parts[0]
    for extra in parts[1:]:
        rows = rows.unionByName(extra)
    return merge_states(rows)


def merged_segments(spark: SparkSession, root: str) -> DataFrame:
    """The customer segments over all batches, from the states alone: no sale is read."""
    root = root.rstrip("/")
    state = _states(spark, root, *_versions(spark, root))
    return state.select(
        "customer_id",
        F.col("spent").cast(TOTAL_TYPE).alias("total_spent"),
        F.col("orders").alias("total_orders"),
        (F.col("spent").cast("double") / F.col("amounts")).alias("avg_order_value"),
        "last_purchase_date",
        "first_purchase_date",
    ).withColumns(
        {
            "customer_lifetime_days": F.datediff("last_purchase_date", "first_purchase_date"),
            "customer_segment": customer_segment("total_spent", "total_orders"),
        }
    )


def merged_gold(
    spark: SparkSession,
    root: str,
    as_of: _dt.datetime | str,
    strategy: str = "auto",
    max_rows: int = DEFAULT_MAX_GROUP_ROWS,
) -> DataFrame:
    """Processed sales as of the last batch; metrics run only for customers with sales after the base."""
    root = root.rstrip("/")
    base, newer = _versions(spark, root)
    if base is not None and not newer:
        return spark.read.parquet(f"{root}/base/v={base}")
    sizes = _states(spark, root, base, newer).select("customer_id", F.col("n").alias("_n"))
    clean = clean_sales(kept_rows(_folders(spark, root, "rows", newer)), as_of)
    if base is None:
        return process_sales(clean, strategy, max_rows=max_rows, sizes=sizes)
    # A row for each customer of the newer batches, once: adaptive execution knows its size.
    touched = materialize(_folders(spark, root, "state", newer).select("customer_id").distinct(), "touched")
    folded = spark.read.parquet(f"{root}/base/v={base}")
    mine = folded.join(touched, "customer_id", "left_semi").select(*clean.columns).unionByName(clean)
    redone = process_sales(mine, strategy, max_rows=max_rows, sizes=sizes.join(touched, "customer_id", "left_semi"))
    return folded.join(touched, "customer_id", "left_anti").unionByName(redone)


def due(spark: SparkSession, root: str, share: float = 0.1) -> bool:
    """Whether the states after the base are at least ``share`` of its customers."""
    root = root.rstrip("/")
    base, newer = _versions(spark, root)
    if not newer:
        return False
    if base is None:
        return True
    return _folders(spark, root, "state", newer).count() >= share * spark.read.parquet(f"{root}/base_state/v={base}").count()


def fold_gold(spark: SparkSession, root: str, as_of: _dt.datetime | str, max_rows: int = DEFAULT_MAX_GROUP_ROWS) -> int | None:
    """Write the merge as ``base/v=<last batch>`` and drop the states it holds; the rows (with their rejects) stay.

    The base's rows are written last, so a base counts only with its states; readers leave
    batches at or below it out.
    """
    root = root.rstrip("/")
    base, newer = _versions(spark, root)
    if not newer:
        return base
    top = newer[-1]
    write_plain(_states(spark, root, base, newer), f"{root}/base_state/v={top}")
    write_plain(merged_gold(spark, root, as_of, max_rows=max_rows).hint("rebalance", "customer_id"), f"{root}/base/v={top}")
    old = [f"{root}/state/batch_id={n}" for n in newer]
    for kind in ("base", "base_state"):
        old += [f"{root}/{kind}/v={n}" for n in _numbered(spark, f"{root}/{kind}", "v") if n < (top if base is None else base)]
    for folder in old:
        path, fs = _hadoop_fs(spark, folder)
        fs.delete(path, True)
    return top
