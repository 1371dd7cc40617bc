"""Runs that follow other runs, other jobs or other rows: nothing stale, lost or shared by accident."""

import threading

from conftest import SF_SMALL
from pyspark.sql import functions as F

from tidemark.operators.metrics import business_metrics, running_total
from tidemark.operators.sales import clean_sales, kept_rows, stage_sales
from tidemark.operators.segments import customer_segments
from tidemark.plans.customer_job import run_customer_job
from tidemark.plans.queries import write_orders_csv
from tidemark.plans.sales_job import run_sales_job
from tidemark.schemas import RAW_SALES
from tidemark.session import materialize, release_scratch, scratch_mark
from tidemark.sinks import write_partitioned
from tidemark.sources.files import stream_raw  # noqa: F401  (the stream reads through it)
from tidemark.streaming.ingest import current_segments, stream_segments

AS_OF = "2024-06-01 00:00:00"
CUSTOMER_HEADER = "customer_id,first_name,last_name,email,phone,age,city,state,registration_date\n"
SALES_HEADER = "sale_id,customer_id,product_id,product_name,amount,sale_date\n"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_second_customer_run_leaves_no_stale_year(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    put(raw / "customers/a.csv", CUSTOMER_HEADER + "1,A,B,a@x.com,1,30,C,S,2022-01-01\n2,C,D,c@x.com,2,40,C,S,2023-01-01\n")
    run_customer_job(spark, str(raw), out, AS_OF)
    put(raw / "customers/b.csv", CUSTOMER_HEADER + "1,A,B,a@x.com,1,30,C,S,2024-01-01\n")
    summary = run_customer_job(spark, str(raw), out, AS_OF)
    got = spark.read.parquet(f"{out}/customers")
    assert sorted((r.customer_id, r.registration_year) for r in got.collect()) == [("1", 2024), ("2", 2023)]
    assert summary["records_processed"] == 2 and summary["quality"]["duplicate_records"] == 1
    assert "completion_time" in summary


def test_second_sales_run_drops_withdrawn_rows(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    put(raw / "sales/a.csv", SALES_HEADER + "1,1,p,n,10.00,2023-01-01\n2,1,p,n,20.00,2024-02-01\n")
    run_sales_job(spark, str(raw), out, AS_OF)
    put(raw / "sales/a.csv", SALES_HEADER + "2,1,p,n,20.00,2024-02-01\n")
    summary = run_sales_job(spark, str(raw), out, AS_OF)
    assert summary["records_processed"] == 1
    assert [r.sale_id for r in spark.read.parquet(f"{out}/sales").collect()] == ["2"]


def test_malformed_customers_are_quarantined(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    put(raw / "customers/a.csv", CUSTOMER_HEADER + "1,A,B,a@x.com,1,30,C,S,2022-01-01\n2,C,D,c@x.com,2,xx,C,S,2023-01-01\n3,short\n")
    summary = run_customer_job(spark, str(raw), out, AS_OF)
    assert summary["records_processed"] == 1 and summary["raw_records"] == 3
    rejects = spark.read.parquet(f"{out}/rejects/customers")
    assert [r.reject_reason for r in rejects.collect()] == ["malformed_row", "malformed_row"]


def test_amount_rule_sees_unrounded_amounts(spark):
    raw = spark.createDataFrame([("1", "1", "p", "n", "0.004", "2024-01-01"), ("2", "1", "p", "n", "0", "2024-01-01")], [f.name for f in RAW_SALES])
    staged = stage_sales(raw)
    assert [r.reject_reason for r in staged.orderBy("sale_id").collect()] == [None, "non_positive_amount"]
    assert [r.sale_id for r in clean_sales(kept_rows(staged), AS_OF).collect()] == ["1"]


def test_null_and_hot_customers_agree_by_every_plan(spark):
    rows = [(i, None if i % 2 else 7, float(i % 5 + 1), f"2024-0{i % 3 + 1}-01") for i in range(40)] + [(100, 8, 1.0, None)]
    df = spark.createDataFrame(rows, "sale_id long, customer_id long, amount double, d string")
    df = df.select("sale_id", "customer_id", F.col("amount").cast("decimal(18,2)").alias("amount"), F.to_date("d").alias("sale_date"))
    df = df.withColumns({"sales_year": F.year("sale_date"), "sales_month": F.month("sale_date")})
    want = sorted(map(str, business_metrics(df, "window").collect()))
    assert len(want) == 41
    for how in ({"strategy": "skew_safe"}, {"max_rows": 3}, {"max_rows": 100}):
        assert sorted(map(str, business_metrics(df, **how).collect())) == want
    assert running_total(df).count() == 41


def test_rolling_segments_equal_the_batch_with_malformed_lines(spark, tmp_path):
    text = SALES_HEADER + "1,1,p,n,10.00,2024-01-01\n2,1,p,n,60.00,2024-01-02,extra,extra\n3,1,p\n4,2,p,n,5.00,2024-01-01\n"
    put(tmp_path / "raw/sales/a.csv", text)
    summary = run_sales_job(spark, str(tmp_path / "raw"), str(tmp_path / "out"), AS_OF)
    assert summary["total_records"] == 4
    stream_segments(spark, str(tmp_path / "raw/sales"), str(tmp_path / "updates"), str(tmp_path / "ckpt"))
    cols = ["customer_id", "total_spent", "total_orders"]
    batch = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out/customer_segments")).select(*cols).collect()))
    rolling = sorted(map(tuple, current_segments(spark, str(tmp_path / "updates")).select(*cols).collect()))
    assert batch == rolling


def test_jobs_in_two_threads_keep_their_scratch(spark):
    mark = scratch_mark()
    kept = {}
    worker = threading.Thread(target=lambda: kept.update(df=materialize(spark.range(5), "other-thread")))
    worker.start()
    worker.join()
    mine = materialize(spark.range(3), "this-thread")
    assert mine.count() == 3
    assert len(release_scratch(spark, mark)) == 1
    assert kept["df"].count() == 5


def test_a_hot_folder_is_written_by_many_tasks(spark, tmp_path):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        df = spark.range(200_000).select(F.xxhash64("id").alias("v"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
        write_partitioned(df, str(tmp_path / "p"), ["k"])
        files = {r["file"]: r["n"] for r in spark.read.parquet(str(tmp_path / "p")).groupBy(F.input_file_name().alias("file")).agg(F.count("v").alias("n")).collect()}
        hot = [n for f, n in files.items() if "/k=0/" in f]
        assert len(hot) >= 4 and max(hot) <= 200_000 / 3 / 2
    finally:
        spark.conf.set(key, before)


def test_orders_csv_helper_writes_rows(spark, tmp_path):
    write_orders_csv(spark, SF_SMALL, str(tmp_path / "o"))
    assert customer_segments(clean_sales(spark.read.option("header", True).csv(str(tmp_path / "o")), AS_OF)).count() > 0
