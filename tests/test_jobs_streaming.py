"""End-to-end jobs on the README files, incremental ingestion and rolling segments."""

import json
import os
import shutil

from conftest import DATA, rows
from pyspark.sql import functions as F

from tidemark.operators.sales import clean_sales
from tidemark.operators.segments import customer_segments
from tidemark.plans.customer_job import run_customer_job
from tidemark.plans.quality_job import run_quality_job
from tidemark.plans.sales_job import run_sales_job
from tidemark.schemas import RAW_SALES
from tidemark.sources.files import read_raw
from tidemark.streaming.ingest import (
    current_segments,
    ingest_sales,
    rebuild_sales_gold,
    staged_clean,
    stream_segments,
)

AS_OF = "2024-06-01 00:00:00"


def make_raw(root):
    os.makedirs(f"{root}/customers/2024", exist_ok=True)
    os.makedirs(f"{root}/sales/2024", exist_ok=True)
    shutil.copy(f"{DATA}/customers.csv", f"{root}/customers/2024/customers.csv")
    shutil.copy(f"{DATA}/sales.csv", f"{root}/sales/2024/sales.csv")


def test_jobs_end_to_end(spark, tmp):
    raw, out = f"{tmp}/raw", f"{tmp}/processed"
    make_raw(raw)
    cust = run_customer_job(spark, raw, out, AS_OF)
    assert cust["records_processed"] == 5 and cust["quality"]["duplicate_records"] == 0
    sales = run_sales_job(spark, raw, out, AS_OF)
    assert sales["records_processed"] == 8
    assert sales["valid_records_percentage"] == 100.0
    assert (sales["total_records"], sales["null_customer_ids"], sales["invalid_amounts"]) == (8, 0, 0)
    assert cust["raw_records"] == 5 and cust["quality"]["total_records"] == 5
    assert sales["customer_segments"] == {"New": 5}
    # hive partitions recovered as ints; pruning on the written table
    written = spark.read.parquet(f"{out}/sales")
    jan = written.filter((F.col("sales_year") == 2024) & (F.col("sales_month") == 1))
    assert jan.count() == 8
    assert "PartitionFilters: [isnotnull(sales_year" in jan._jdf.queryExecution().executedPlan().toString()
    parts = sorted(p for p in os.listdir(f"{out}/customers") if "=" in p)
    assert parts == ["registration_year=2022", "registration_year=2023"]
    events = spark.read.parquet(f"{out}/pipeline_events")
    kinds = sorted(r.event_type for r in events.collect())
    assert kinds == ["Data Quality Check", "ETL Job Completed", "ETL Job Completed"]
    detail = [json.loads(r.detail) for r in events.filter("event_type = 'Data Quality Check'").collect()][0]
    assert detail["total_records"] == 5
    report, scores = run_quality_job(spark, out, AS_OF)
    assert report.count() == 8
    assert {r.table_name: r.quality_score for r in scores.collect()} == {
        "processed_sales": 100.0,
        "processed_customers": 100.0,
    }


def test_failed_job_logs_and_raises(spark, tmp):
    out = f"{tmp}/processed"
    try:
        run_sales_job(spark, f"{tmp}/missing", out, AS_OF)
        raise AssertionError("expected a failure")
    except Exception as exc:  # noqa: BLE001
        assert "AssertionError" not in type(exc).__name__
    ev = spark.read.parquet(f"{out}/pipeline_events").collect()
    assert [e.event_type for e in ev] == ["ETL Job Failed"]
    assert json.loads(ev[0].detail)["status"] == "FAILED"


def split_sales(spark, folder, which):
    df = read_raw(spark, f"{DATA}/sales.csv", RAW_SALES)
    part = df.filter(F.col("sale_id").cast("int") <= 4) if which == 1 else df.filter(F.col("sale_id").cast("int") > 4)
    part.coalesce(1).write.option("header", "true").csv(folder)


def test_incremental_equals_full(spark, tmp):
    raw, staged, ckpt = f"{tmp}/raw", f"{tmp}/staged", f"{tmp}/ckpt"
    split_sales(spark, f"{raw}/a", 1)
    ingest_sales(spark, raw, staged, ckpt)
    assert spark.read.parquet(staged).count() == 4
    split_sales(spark, f"{raw}/b", 2)
    ingest_sales(spark, raw, staged, ckpt)
    ingest_sales(spark, raw, staged, ckpt)  # no new files
    assert spark.read.parquet(staged).count() == 8
    full = clean_sales(read_raw(spark, f"{DATA}/sales.csv", RAW_SALES), AS_OF)
    inc = staged_clean(spark, staged, AS_OF)
    assert inc.select(*full.columns).exceptAll(full).count() == 0
    gold = rebuild_sales_gold(spark, staged, f"{tmp}/gold", "1", AS_OF)
    seg = spark.read.parquet(f"{gold}/customer_segments")
    assert rows(seg, "customer_id", "total_orders") == rows(customer_segments(full), "customer_id", "total_orders")


def test_rolling_segments_merge_batches(spark, tmp):
    raw, upd, ckpt = f"{tmp}/raw", f"{tmp}/updates", f"{tmp}/ckpt"
    split_sales(spark, f"{raw}/a", 1)
    stream_segments(spark, raw, upd, ckpt)
    split_sales(spark, f"{raw}/b", 2)
    stream_segments(spark, raw, upd, ckpt)
    full = customer_segments(clean_sales(read_raw(spark, f"{DATA}/sales.csv", RAW_SALES)))
    got = current_segments(spark, upd)
    cols = ["customer_id", "total_spent", "total_orders", "first_purchase_date", "last_purchase_date", "customer_segment"]
    assert rows(got, *cols) == rows(full, *cols)


def test_processing_time_trigger_keeps_running(spark, tmp):
    raw, staged, ckpt = f"{tmp}/raw", f"{tmp}/staged", f"{tmp}/ckpt"
    split_sales(spark, f"{raw}/a", 1)
    query = ingest_sales(spark, raw, staged, ckpt, processing_time="1 second")
    try:
        query.processAllAvailable()
        split_sales(spark, f"{raw}/b", 2)
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert spark.read.parquet(staged).count() == 8


def gold_equals_one_shot(spark, gold, df=None):
    from tidemark.plans.sales_job import process_sales
    from tidemark.streaming.ingest import current_gold

    df = read_raw(spark, f"{DATA}/sales.csv", RAW_SALES) if df is None else df
    full = process_sales(clean_sales(df, AS_OF), "window")
    got = current_gold(spark, gold).select(*full.columns)
    return got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0


def test_gold_refresh_recomputes_only_touched_customers(spark, tmp):
    from tidemark.streaming.ingest import compact_gold, ingest_and_refresh

    raw, staged, gold, ckpt = f"{tmp}/raw", f"{tmp}/staged", f"{tmp}/gold", f"{tmp}/ckpt"
    split_sales(spark, f"{raw}/a", 1)
    ingest_and_refresh(spark, raw, staged, gold, ckpt, buckets=2, as_of=AS_OF)
    first = sorted(os.listdir(f"{gold}/updates/batch_id=0"))
    # second drop: sales 5..8 (customers 2, 4, 5, 1); customer 3 shares a bucket with some of them
    split_sales(spark, f"{raw}/b", 2)
    ingest_and_refresh(spark, raw, staged, gold, ckpt, buckets=2, as_of=AS_OF)
    assert sorted(os.listdir(f"{gold}/updates/batch_id=0")) == first  # nothing is rewritten in place
    written = spark.read.parquet(f"{gold}/updates/batch_id=1")
    assert {r.customer_id for r in written.select("customer_id").distinct().collect()} == {"1", "2", "4", "5"}
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        spark.read.parquet(staged).filter(F.col("customer_bucket").isin(0, 1)).explain("formatted")
    assert "PartitionFilters: [customer_bucket" in buf.getvalue()  # a refresh reads only touched buckets
    assert gold_equals_one_shot(spark, gold)
    assert compact_gold(spark, gold) == 1 and os.listdir(f"{gold}/updates") == []
    assert gold_equals_one_shot(spark, gold)
    assert compact_gold(spark, gold) == 1  # nothing new
    # an unfinished refresh is not seen
    spark.range(1).write.parquet(f"{gold}/updates/batch_id=9")
    os.remove(f"{gold}/updates/batch_id=9/_SUCCESS")
    assert gold_equals_one_shot(spark, gold)


def test_gold_refresh_after_compaction(spark, tmp):
    from tidemark.streaming.ingest import compact_gold, ingest_and_refresh

    raw, staged, gold, ckpt = f"{tmp}/raw", f"{tmp}/staged", f"{tmp}/gold", f"{tmp}/ckpt"
    split_sales(spark, f"{raw}/a", 1)
    ingest_and_refresh(spark, raw, staged, gold, ckpt, buckets=4, as_of=AS_OF)
    assert compact_gold(spark, gold) == 0
    split_sales(spark, f"{raw}/b", 2)
    ingest_and_refresh(spark, raw, staged, gold, ckpt, buckets=4, as_of=AS_OF)
    assert gold_equals_one_shot(spark, gold)
    assert compact_gold(spark, gold) == 1 and gold_equals_one_shot(spark, gold)


def test_new_checkpoint_over_staged_rows_fails(spark, tmp):
    import pytest

    from tidemark.streaming.ingest import ingest_and_refresh

    raw, staged, gold = f"{tmp}/raw", f"{tmp}/staged", f"{tmp}/gold"
    split_sales(spark, f"{raw}/a", 1)
    ingest_and_refresh(spark, raw, staged, gold, f"{tmp}/ckpt", as_of=AS_OF)
    with pytest.raises(ValueError, match="another checkpoint"):
        ingest_and_refresh(spark, raw, staged, gold, f"{tmp}/ckpt2", as_of=AS_OF)


def test_segments_after_a_checkpoint_reset(spark, tmp):
    """A new checkpoint reads all files again; its updates must count, not those in the old base."""
    from tidemark.streaming.ingest import compact_segment_updates

    raw, upd, base = f"{tmp}/raw", f"{tmp}/updates", f"{tmp}/base"
    split_sales(spark, f"{raw}/a", 1)
    stream_segments(spark, raw, upd, f"{tmp}/ckpt", base_path=base)
    compact_segment_updates(spark, upd, base)
    split_sales(spark, f"{raw}/b", 2)
    stream_segments(spark, raw, upd, f"{tmp}/ckpt2", base_path=base)
    assert [d for d in os.listdir(upd) if d.startswith("batch_id=")] == ["batch_id=1"]
    full = customer_segments(clean_sales(read_raw(spark, f"{DATA}/sales.csv", RAW_SALES)))
    cols = ["customer_id", "total_spent", "total_orders", "first_purchase_date", "last_purchase_date", "customer_segment"]
    assert rows(current_segments(spark, upd, base), *cols) == rows(full, *cols)


def test_many_small_batches_equal_one_shot(spark, tmp):
    """Four files, one per micro-batch: staged rows and refreshed gold equal one-shot processing."""
    from tidemark.streaming.ingest import ingest_and_refresh

    raw, staged, gold, ckpt = f"{tmp}/raw", f"{tmp}/staged", f"{tmp}/gold", f"{tmp}/ckpt"
    df = read_raw(spark, f"{DATA}/sales.csv", RAW_SALES)
    for i in range(4):
        df.filter(F.col("sale_id").cast("int") % 4 == i).coalesce(1).write.option("header", "true").csv(f"{raw}/f{i}")
    ingest_and_refresh(spark, raw, staged, gold, ckpt, buckets=8, as_of=AS_OF, max_files=1)
    batches = {r.batch_id for r in spark.read.parquet(staged).select("batch_id").distinct().collect()}
    assert len(batches) == 4
    assert gold_equals_one_shot(spark, gold, df)


def test_segment_compaction(spark, tmp):
    from tidemark.streaming.ingest import compact_segment_updates

    raw, upd, base, ckpt = f"{tmp}/raw", f"{tmp}/updates", f"{tmp}/base", f"{tmp}/ckpt"
    split_sales(spark, f"{raw}/a", 1)
    stream_segments(spark, raw, upd, ckpt)
    top = compact_segment_updates(spark, upd, base)
    assert top == 0 and not [d for d in os.listdir(upd) if d.startswith("batch_id=")]
    split_sales(spark, f"{raw}/b", 2)
    stream_segments(spark, raw, upd, ckpt)  # new batch lands after the base
    full = customer_segments(clean_sales(read_raw(spark, f"{DATA}/sales.csv", RAW_SALES)))
    cols = ["customer_id", "total_spent", "total_orders", "first_purchase_date", "last_purchase_date", "customer_segment"]
    assert rows(current_segments(spark, upd, base), *cols) == rows(full, *cols)
    assert compact_segment_updates(spark, upd, base) == 1
    assert rows(current_segments(spark, upd, base), *cols) == rows(full, *cols)


def test_sales_job_hot_customer_path(spark, tmp):
    """Threshold 2: customer 1 (three sales) takes the skew-safe path inside the job."""
    from tidemark.plans.sales_job import process_sales

    raw, out = f"{tmp}/raw", f"{tmp}/processed"
    make_raw(raw)
    run_sales_job(spark, raw, out, AS_OF, max_rows=2)
    full = process_sales(clean_sales(read_raw(spark, f"{DATA}/sales.csv", RAW_SALES), AS_OF), "window")
    got = spark.read.parquet(f"{out}/sales").select(*full.columns)
    assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0
    seg = spark.read.parquet(f"{out}/customer_segments")
    assert "_n" not in seg.columns and seg.count() == 5


def test_gold_refresh_with_hot_customers(spark, tmp):
    """Threshold 1: customers with two or more sales take the skew-safe path inside
    each micro-batch's refresh; the gold table still equals one-shot processing."""
    from tidemark.streaming.ingest import ingest_and_refresh

    raw, staged, gold, ckpt = f"{tmp}/raw", f"{tmp}/staged", f"{tmp}/gold", f"{tmp}/ckpt"
    split_sales(spark, f"{raw}/a", 1)
    split_sales(spark, f"{raw}/b", 2)
    ingest_and_refresh(spark, raw, staged, gold, ckpt, buckets=4, as_of=AS_OF, max_files=1, max_rows=1)
    assert gold_equals_one_shot(spark, gold)


def test_replayed_batch_is_idempotent(spark, tmp):
    """A crash after a batch's writes but before its commit: the stream replays the
    batch, which overwrites its own partitions — no duplicate rows, same gold."""
    from tidemark.streaming.ingest import ingest_and_refresh

    raw, staged, gold, ckpt = f"{tmp}/raw", f"{tmp}/staged", f"{tmp}/gold", f"{tmp}/ckpt"
    split_sales(spark, f"{raw}/a", 1)
    split_sales(spark, f"{raw}/b", 2)
    ingest_and_refresh(spark, raw, staged, gold, ckpt, buckets=4, as_of=AS_OF)
    assert os.path.exists(f"{ckpt}/commits/0")
    os.remove(f"{ckpt}/commits/0")  # the batch ran, its commit was lost
    if os.path.exists(f"{ckpt}/commits/.0.crc"):
        os.remove(f"{ckpt}/commits/.0.crc")  # with its local checksum file
    ingest_and_refresh(spark, raw, staged, gold, ckpt, buckets=4, as_of=AS_OF)
    assert os.path.exists(f"{ckpt}/commits/0")
    assert spark.read.parquet(staged).count() == 8
    assert gold_equals_one_shot(spark, gold)


def test_rolling_segments_replay_is_idempotent(spark, tmp):
    raw, upd, ckpt = f"{tmp}/raw", f"{tmp}/updates", f"{tmp}/ckpt"
    split_sales(spark, f"{raw}/a", 1)
    split_sales(spark, f"{raw}/b", 2)
    stream_segments(spark, raw, upd, ckpt)
    os.remove(f"{ckpt}/commits/0")  # the batch's update was written, its commit lost
    if os.path.exists(f"{ckpt}/commits/.0.crc"):
        os.remove(f"{ckpt}/commits/.0.crc")
    stream_segments(spark, raw, upd, ckpt)
    assert [d for d in os.listdir(upd) if d.startswith("batch_id=")] == ["batch_id=0"]
    full = customer_segments(clean_sales(read_raw(spark, f"{DATA}/sales.csv", RAW_SALES)))
    cols = ["customer_id", "total_spent", "total_orders", "first_purchase_date", "last_purchase_date", "customer_segment"]
    assert rows(current_segments(spark, upd), *cols) == rows(full, *cols)
