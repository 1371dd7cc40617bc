"""Incremental ingestion (A4, K1, K2, K4) and the gold rebuild.

The reference gets incrementality from per-job run state: each run sees only
new files, and then computes windows, dedup and segments *per batch* — so a
customer's totals are wrong as soon as their sales span two runs. Here:

* ``ingest_sales`` — a file stream (only new files per trigger) appends staged
  rows to a Parquet table through the exactly-once file sink; the checkpoint
  only advances when a batch is committed.
* ``rebuild_sales_gold`` — gold tables (metrics, segments) are recomputed over
  the whole staged table into a fresh version folder, never in place.
* ``ingest_and_refresh`` — per micro-batch: append the staged rows, then
  recompute gold only for the customers the batch touched, into a folder of its
  own; ``current_gold`` reads each customer's newest rows and ``compact_gold``
  folds the batches into a base.
* ``stream_segments`` — segment aggregates kept up to date by a stateful
  streaming aggregation; each batch's updated customers are written to their
  own ``batch_id`` partition (overwritten on replay, so idempotent) and read back
  as the latest row per customer.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.constants import TOTAL_TYPE
from tidemark.functions import customer_segment
from tidemark.operators.sales import clean_sales, kept_rows, stage_sales
from tidemark.operators.metrics import DEFAULT_MAX_GROUP_ROWS
from tidemark.plans.sales_job import process_sales
from tidemark.schemas import RAW_SALES
from tidemark.session import materialize, release_scratch, scratch_mark
from tidemark.sinks import write_partitioned, write_plain
from tidemark.sources.files import stream_raw


def ingest_sales(
    spark: SparkSession,
    raw_dir: str,
    staged_path: str,
    checkpoint: str,
    fmt: str = "csv",
    processing_time: str | None = None,
    max_files: int | None = None,
):
    """Run the ingest stream. Default trigger: availableNow (all new files, then stop);
    with ``processing_time`` it keeps running (event-driven arrival, K2).
    ``max_files`` caps files per micro-batch (all files are still read)."""
    staged = stage_sales(stream_raw(spark, raw_dir, RAW_SALES, fmt, max_files, keep_corrupt=True))
    writer = (
        staged.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", staged_path)
        .outputMode("append")
    )
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    query = writer.start()
    if not processing_time:
        query.awaitTermination()
    return query


def staged_clean(spark: SparkSession, staged_path: str, as_of: _dt.datetime | str) -> DataFrame:
    """The valid staged rows, cleaned (the input of every gold table)."""
    return clean_sales(kept_rows(spark.read.parquet(staged_path)), as_of)


def rebuild_sales_gold(
    spark: SparkSession,
    staged_path: str,
    gold_root: str,
    version: str,
    as_of: _dt.datetime | str,
    strategy: str = "auto",
    max_rows: int = DEFAULT_MAX_GROUP_ROWS,
) -> str:
    """Recompute processed sales and segments over the whole staged table into
    ``<gold_root>/v=<version>``; readers switch versions, nothing is rewritten in place."""
    from tidemark.operators.segments import customer_segments

    out = f"{gold_root.rstrip('/')}/v={version}"
    mark = scratch_mark()
    try:
        clean = staged_clean(spark, staged_path, as_of)
        # One per-customer aggregate gives the segments and the hot-customer sizes.
        segments = materialize(customer_segments(clean, with_row_count=True), "segments")
        write_plain(segments.drop("_n"), f"{out}/customer_segments")
        processed = process_sales(clean, strategy, max_rows=max_rows, sizes=segments.select("customer_id", "_n"))
        write_partitioned(processed, f"{out}/sales", ["sales_year", "sales_month"], spread_by=["customer_id"])
    finally:
        release_scratch(spark, mark)
    return out


# ------------------------------------------------------- incremental gold refresh

DEFAULT_BUCKETS = 64


def customer_bucket(buckets: int = DEFAULT_BUCKETS) -> Column:
    return F.pmod(F.xxhash64("customer_id"), F.lit(buckets)).cast("int")


def refresh_sales_gold(
    spark: SparkSession,
    staged_path: str,
    gold_path: str,
    batch_id: int,
    as_of: _dt.datetime | str,
    strategy: str = "auto",
    max_rows: int = DEFAULT_MAX_GROUP_ROWS,
) -> None:
    """Recompute processed sales for the customers with a valid row in batch ``batch_id``.

    Every metric is per customer (all windows partition by customer_id), so these
    customers' whole history up to the batch gives exactly the rows a full rebuild
    would give for them. The history is read from the touched buckets' files alone
    (partition pruning on a list of at most the number of buckets) and reduced to the
    touched customers by a semi join before anything is shuffled for the windows.

    The rows go to ``<gold_path>/updates/batch_id=<n>``; nothing else is written, so
    readers see a refresh as a whole or not at all, and a replay rewrites its own folder.
    """
    mark = scratch_mark()
    try:
        stage = spark.read.parquet(staged_path)
        valid = stage.filter((F.col("batch_id") == batch_id) & F.col("reject_reason").isNull())
        touched = materialize(valid.select("customer_id", "customer_bucket").distinct(), "touched")
        # At most as many values as there are buckets: a bounded list.
        pruned = [r.customer_bucket for r in touched.select("customer_bucket").distinct().collect()]
        if not pruned:
            return
        history = stage.filter(F.col("customer_bucket").isin(*sorted(pruned)) & (F.col("batch_id") <= batch_id))
        mine = kept_rows(history).join(touched.select("customer_id"), "customer_id", "left_semi")
        out = process_sales(clean_sales(mine, as_of), strategy, max_rows=max_rows)
        write_plain(out.hint("rebalance", "customer_id"), f"{gold_path.rstrip('/')}/updates/batch_id={batch_id}")
    finally:
        release_scratch(spark, mark)


def _gold_versions(spark: SparkSession, gold_path: str) -> tuple[int | None, list[int]]:
    """The newest complete base, and the complete updates after it."""
    root = gold_path.rstrip("/")
    bases = _numbered(spark, f"{root}/base", "v", need_success=True)
    base = bases[-1] if bases else None
    updates = _numbered(spark, f"{root}/updates", "batch_id", need_success=True)
    return base, [n for n in updates if base is None or n > base]


def current_gold(spark: SparkSession, gold_path: str) -> DataFrame:
    """Processed sales as of the last refresh: of each customer the rows of their newest version.

    The newest versions come from a key-only aggregate that is combined map-side. With
    a single version nothing is joined.
    """
    root = gold_path.rstrip("/")
    base, updates = _gold_versions(spark, gold_path)
    parts = [] if base is None else [spark.read.parquet(f"{root}/base/v={base}").withColumn("_version", F.lit(base))]
    if updates:
        folders = [f"{root}/updates/batch_id={n}" for n in updates]
        newer = spark.read.option("basePath", f"{root}/updates").parquet(*folders)
        parts.append(newer.withColumn("_version", F.col("batch_id").cast("int")).drop("batch_id"))
    if not parts:
        raise ValueError(f"no gold rows under {gold_path}")
    if len(parts) + len(updates) <= 2 and (base is None or not updates):
        return parts[0].drop("_version")
    rows = parts[0]
    for extra in parts[1:]:
        rows = rows.unionByName(extra)
    newest = rows.groupBy("customer_id").agg(F.max("_version").alias("_version"))
    return rows.join(newest, ["customer_id", "_version"]).drop("_version")


def compact_gold(spark: SparkSession, gold_path: str) -> int | None:
    """Fold the refreshes into ``<gold_path>/base/v=<last batch>`` and delete what it covers.

    Crash-safe: the base is complete (``_SUCCESS``) before anything is deleted, and
    readers ignore updates at or below the newest base. The base before it stays, for
    readers that still use it.
    """
    root = gold_path.rstrip("/")
    base, updates = _gold_versions(spark, gold_path)
    if not updates:
        return base
    top = updates[-1]
    write_plain(current_gold(spark, gold_path).hint("rebalance", "customer_id"), f"{root}/base/v={top}")
    old = [f"{root}/updates/batch_id={n}" for n in _numbered(spark, f"{root}/updates", "batch_id") if n <= top]
    old += [f"{root}/base/v={n}" for n in _numbered(spark, f"{root}/base", "v") if n < (base if base is not None else top)]
    for folder in old:
        path, fs = _hadoop_fs(spark, folder)
        fs.delete(path, True)
    return top


def ingest_and_refresh(
    spark: SparkSession,
    raw_dir: str,
    staged_path: str,
    gold_path: str,
    checkpoint: str,
    buckets: int = DEFAULT_BUCKETS,
    *,
    as_of: _dt.datetime | str,
    fmt: str = "csv",
    max_files: int | None = None,
    max_rows: int = DEFAULT_MAX_GROUP_ROWS,
):
    """One stream run (availableNow): each micro-batch appends its staged rows
    (``batch_id`` partition, overwritten on replay) and refreshes the gold rows
    of the customers it touched.

    ``buckets`` is fixed for the life of a staged table; choose it so that a bucket's
    history is a few files. A new checkpoint would read every file again, so with
    staged rows of another stream the run fails instead of doubling them.
    """
    if not _started(spark, checkpoint) and _numbered(spark, staged_path, "customer_bucket"):
        raise ValueError(f"{staged_path} holds the rows of another checkpoint than {checkpoint}")
    staged = stage_sales(stream_raw(spark, raw_dir, RAW_SALES, fmt, max_files, keep_corrupt=True))

    def handle(batch: DataFrame, batch_id: int) -> None:
        # Staged rows land in (customer_bucket, batch_id) partitions: a replay
        # overwrites exactly its own partitions, and a refresh reads only the
        # buckets it needs.
        placed = batch.withColumns({"customer_bucket": customer_bucket(buckets), "batch_id": F.lit(batch_id)})
        write_partitioned(placed, staged_path, ["customer_bucket", "batch_id"], spread_by=["customer_id"], replace="touched")
        refresh_sales_gold(spark, staged_path, gold_path, batch_id, as_of, max_rows=max_rows)

    query = (
        staged.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


# ----------------------------------------------------------------- rolling segments


def _segment_state(clean: DataFrame) -> DataFrame:
    """Mergeable per-customer aggregates (sum, counts, min, max)."""
    return clean.groupBy("customer_id").agg(
        F.sum("amount").alias("spent"),
        F.count("sale_id").alias("orders"),
        F.count("amount").alias("amounts"),
        F.max("sale_date").alias("last_purchase_date"),
        F.min("sale_date").alias("first_purchase_date"),
    )


def stream_segments(
    spark: SparkSession,
    raw_dir: str,
    updates_path: str,
    checkpoint: str,
    fmt: str = "csv",
    base_path: str | None = None,
):
    """K4: run the segment stream once over all new files (availableNow).

    Update folders are numbered on from the newest one that is there when a checkpoint
    is first used, bases under ``base_path`` included (give it where updates are
    compacted): after a reset, the state that is built anew replaces the older one
    instead of hiding below it.
    """
    first = _first_number(spark, checkpoint, updates_path, base_path)
    # The batch job's staging rule: malformed lines are marked, and then not kept.
    stream = stream_raw(spark, raw_dir, RAW_SALES, fmt, keep_corrupt=True)
    clean = clean_sales(kept_rows(stage_sales(stream)), with_provenance=False)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch_id", F.lit(first + batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(updates_path)
        )

    query = (
        _segment_state(clean)
        .writeStream.outputMode("update")
        .foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


STATE_COLUMNS = ("spent", "orders", "amounts", "last_purchase_date", "first_purchase_date")


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _numbered(spark: SparkSession, root: str, prefix: str, need_success: bool = False) -> list[int]:
    """Sorted n of the ``<prefix>=<n>`` folders under ``root`` (metadata listing only)."""
    p, fs = _hadoop_fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if not name.startswith(prefix + "="):
            continue
        if need_success and not fs.exists(st.getPath().suffix("/_SUCCESS")):
            continue  # an unfinished write
        out.append(int(name.split("=", 1)[1]))
    return sorted(out)


def _started(spark: SparkSession, checkpoint: str) -> bool:
    """Whether a stream has planned a batch with this checkpoint."""
    path, fs = _hadoop_fs(spark, f"{checkpoint.rstrip('/')}/offsets")
    return fs.exists(path)


FIRST = "first_batch"


def _first_number(spark: SparkSession, checkpoint: str, updates_path: str, base_path: str | None) -> int:
    """The number of this checkpoint's first update; kept with it as an empty folder's name."""
    root = checkpoint.rstrip("/")
    known = _numbered(spark, root, FIRST)
    if known:
        return known[-1]
    taken = [] if _started(spark, checkpoint) else _numbered(spark, updates_path, "batch_id")
    if base_path and not _started(spark, checkpoint):
        taken += _numbered(spark, base_path, "v")
    first = max(taken, default=-1) + 1
    path, fs = _hadoop_fs(spark, f"{root}/{FIRST}={first}")
    fs.mkdirs(path)
    return first


def _latest_state(spark: SparkSession, updates_path: str, base_path: str | None) -> DataFrame:
    """Latest raw state per customer: the newest complete base plus the update
    batches newer than it (older batches are not read at all)."""
    root = updates_path.rstrip("/")
    version = None
    parts = []
    if base_path:
        done = _numbered(spark, base_path, "v", need_success=True)
        if done:
            version = done[-1]
            base = spark.read.parquet(f"{base_path.rstrip('/')}/v={version}")
            parts.append(base.withColumn("batch_id", F.lit(version)))
    batches = [b for b in _numbered(spark, root, "batch_id") if version is None or b > version]
    if batches:
        newer = spark.read.option("basePath", root).parquet(*[f"{root}/batch_id={b}" for b in batches])
        parts.append(newer.select("customer_id", *STATE_COLUMNS, F.col("batch_id").cast("int")))
    if not parts:
        raise ValueError(f"no segment state under {updates_path}")
    state = parts[0].withColumn("batch_id", F.col("batch_id").cast("int"))
    for extra in parts[1:]:
        state = state.unionByName(extra)
    return state.groupBy("customer_id").agg(F.max_by(F.struct(*STATE_COLUMNS), F.col("batch_id")).alias("s"))


def compact_segment_updates(spark: SparkSession, updates_path: str, base_path: str) -> int | None:
    """Fold the update batches into ``<base_path>/v=<last batch>`` and delete the
    batches it covers. Crash-safe: the base is complete (``_SUCCESS``) before any
    batch is deleted, and readers ignore batches at or below the newest base."""
    batches = _numbered(spark, updates_path.rstrip("/"), "batch_id")
    if not batches:
        return None
    top = batches[-1]
    latest = _latest_state(spark, updates_path, base_path).select("customer_id", "s.*")
    latest.write.mode("overwrite").parquet(f"{base_path.rstrip('/')}/v={top}")
    for b in batches:
        p, fs = _hadoop_fs(spark, f"{updates_path.rstrip('/')}/batch_id={b}")
        fs.delete(p, True)
    return top


def current_segments(spark: SparkSession, updates_path: str, base_path: str | None = None) -> DataFrame:
    """Latest state per customer (base + newer update batches), finished into segment columns.

    ``max_by`` over batch_id is an aggregate (combined map-side), so a customer
    updated in every batch is still reduced before the shuffle.
    """
    latest = _latest_state(spark, updates_path, base_path)
    return latest.select(
        "customer_id",
        F.col("s.spent").cast(TOTAL_TYPE).alias("total_spent"),
        F.col("s.orders").alias("total_orders"),
        (F.col("s.spent").cast("double") / F.col("s.amounts")).alias("avg_order_value"),
        F.col("s.last_purchase_date").alias("last_purchase_date"),
        F.col("s.first_purchase_date").alias("first_purchase_date"),
    ).withColumns(
        {
            "customer_lifetime_days": F.datediff("last_purchase_date", "first_purchase_date"),
            "customer_segment": customer_segment("total_spent", "total_orders"),
        }
    )
