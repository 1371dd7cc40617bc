"""The streaming gate, arrival notices, mergeable quality states and drift."""

import json
import math
import os
import random

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators.events import job_metrics, readiness
from tidemark.operators.quality_state import (
    DriftRule,
    drift,
    load_states,
    merge_states,
    quality_state,
    save_states,
    summarize,
)
from tidemark.plans import publish_job
from tidemark.streaming.notices import ingest_notices, missing_files, staged_notices
from tidemark.streaming.readiness_gate import PROVIDER, SHUFFLE, current_gate, newest_runs, stream_readiness

# ---------------------------------------------------------------------- gate

RUN = ("job_name", "job_run_id", "state", "started_on")
RUN_TYPES = "job_name string, job_run_id string, state string, started_on timestamp"


def put_runs(folder, name, runs):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w", encoding="utf-8") as f:
        f.write("\n".join(json.dumps(dict(zip(RUN, r, strict=True))) for r in runs))


def gate(spark, tmp, **options):
    before = spark.conf.get(PROVIDER), spark.conf.get(SHUFFLE)
    stream_readiness(spark, f"{tmp}/in", f"{tmp}/out", f"{tmp}/ck", ["c", "s"], ["cs", "ss"], partitions=2, **options)
    assert (spark.conf.get(PROVIDER), spark.conf.get(SHUFFLE)) == before
    return {str(r.run_window): (r.cs, r.ss, r.ready, r.timed_out) for r in current_gate(spark, f"{tmp}/out").collect()}


def test_gate_tells_late_windows_and_drops_them(spark, tmp):
    put_runs(f"{tmp}/in", "a", [
        ("c", "1", "SUCCEEDED", "2024-01-01T10:00:00"), ("s", "2", "RUNNING", "2024-01-01T11:00:00"),
        ("c", "9", "SUCCEEDED", None), ("other", "9", "SUCCEEDED", "2024-01-01T10:00:00"),
    ])
    out = gate(spark, tmp)
    assert out == {"None": ("SUCCEEDED", None, False, False), "2024-01-01": ("SUCCEEDED", "RUNNING", False, False)}
    put_runs(f"{tmp}/in", "b", [
        ("s", "2", "SUCCEEDED", "2024-01-01T11:00:00"), ("s", "2", "RUNNING", "2024-01-01T11:00:00"),
        ("c", "3", "FAILED", "2024-01-02T11:00:00"), ("c", "1", "SUCCEEDED", "2024-01-01T10:00:00"),
    ])
    out = gate(spark, tmp)
    assert out["2024-01-01"] == ("SUCCEEDED", "SUCCEEDED", True, False)
    assert out["2024-01-02"] == ("FAILED", None, False, False)
    put_runs(f"{tmp}/in", "c", [("c", "4", "SUCCEEDED", "2024-01-09T11:00:00")])
    out = gate(spark, tmp)  # the watermark passes the deadlines of both days: one is ready, one isn't
    assert out["2024-01-01"] == ("SUCCEEDED", "SUCCEEDED", True, False)
    assert out["2024-01-02"] == ("FAILED", None, False, True)
    put_runs(f"{tmp}/in", "d", [("s", "5", "SUCCEEDED", "2024-01-02T12:00:00")])
    assert gate(spark, tmp)["2024-01-02"] == ("FAILED", None, False, True)  # behind the watermark


def test_gate_equals_the_batch_gate_in_any_order(spark, tmp):
    rng = random.Random(5)
    runs = []
    for i in range(400):
        at = None if i % 97 == 0 else f"2024-03-{rng.randint(1, 4):02d}T{rng.randint(0, 23):02d}:00:00"
        runs.append((rng.choice(["c", "s", "x"]), f"r{i % 150:03d}", rng.choice(["SUCCEEDED", "FAILED", "RUNNING", "STOPPED", None]), at))
    sent = runs + rng.sample(runs, 200)
    rng.shuffle(sent)
    for part in range(3):
        put_runs(f"{tmp}/in", f"p{part}", sent[part::3])
    streamed = gate(spark, tmp, delay="3650 days", max_files=1)
    table = spark.createDataFrame(runs, "job_name string, job_run_id string, state string, started_on string").withColumn(
        "started_on", F.col("started_on").cast("timestamp")
    )
    batch = readiness(table, ["c", "s"], ["cs", "ss"])
    assert streamed == {str(r.run_window): (r.cs, r.ss, r.ready, False) for r in batch.collect()}


def test_rows_are_reduced_before_they_meet():
    frame = pd.DataFrame({"run_window": ["d"] * 4 + ["e"], "job_name": ["c", "c", "s", "c", "c"], "job_run_id": ["1", "2", "1", "2", None],
                          "terminal": [True, False, True, True, None], "state": ["FAILED", "RUNNING", "FAILED", "SUCCEEDED", None],
                          "at": [5, 5, 1, 5, 7], "due": [9] * 5})
    (out,) = newest_runs([frame])
    assert sorted(zip(out.run_window, out.job_name, out.state.fillna("-"))) == [("d", "c", "SUCCEEDED"), ("d", "s", "FAILED"), ("e", "c", "-")]


def test_metrics_count_the_seconds_of_finished_runs(spark):
    runs = spark.createDataFrame(
        [("a", "SUCCEEDED", 10), ("a", "FAILED", None), ("a", "RUNNING", 99), ("a", "STOPPED", None), ("b", "RUNNING", 5)],
        "job_name string, state string, execution_time_seconds bigint",
    )
    out = rows(job_metrics(runs), "job_name", "runs", "total_execution_seconds", "avg_execution_seconds", "max_execution_seconds")
    assert out == [("a", 4, 10, 5.0, 10), ("b", 1, None, None, None)]


# ------------------------------------------------------------------- notices


def send(spark, tmp, name, keys, bucket="raw"):
    os.makedirs(f"{tmp}/in", exist_ok=True)
    records = [{"s3": {"bucket": {"name": bucket}, "object": {"key": k}}} for k in keys]
    with open(f"{tmp}/in/{name}.json", "w", encoding="utf-8") as f:
        f.write(json.dumps({"body": json.dumps({"Records": records})}) + "\n" + json.dumps({"body": "not json"}) + "\n")
    ingest_notices(spark, f"{tmp}/in", f"{tmp}/b", f"{tmp}/staged", f"{tmp}/ledger", f"{tmp}/ck")


def put_file(tmp, key, text):
    path = f"{tmp}/b/raw/{key}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_notices_are_followed_once_each(spark, tmp):
    put_file(tmp, "sales/a.csv", "sale_id,customer_id,amount\n1,c1,5.00\n2,,7\n")
    put_file(tmp, "sales/b [1]/{x}.csv", "amount,sale_id,customer_id\n12345678901234567.00,3,c3\n")
    put_file(tmp, "sales/unnamed.csv", "sale_id,customer_id,amount\n99,c9,1\n")
    put_file(tmp, "customers/c.csv", "customer_id\n1\n")
    send(spark, tmp, "1", ["sales/a.csv", "sales/a.csv", "sales/late.csv", "customers/c.csv", "sales/a.csv.gz", "", None])
    staged = lambda: rows(staged_notices(spark, f"{tmp}/staged", f"{tmp}/ledger"), "sale_id", "reject_reason")
    assert staged() == [("1", None), ("2", "null_customer_id")]
    assert rows(missing_files(spark, f"{tmp}/ledger"), "bucket", "key") == [("raw", "sales/late.csv")]
    put_file(tmp, "sales/late.csv", "sale_id,customer_id,amount\n4,c4,1\n")
    send(spark, tmp, "2", ["sales/b [1]/{x}.csv", "sales/a.csv", "sales/late.csv"])
    send(spark, tmp, "3", ["sales/late.csv"])
    assert staged() == [("1", None), ("2", "null_customer_id"), ("3", "amount_out_of_range"), ("4", None)]
    assert missing_files(spark, f"{tmp}/ledger").count() == 0


# ------------------------------------------------------------ quality states


def test_states_merge_to_the_state_of_the_union(spark, tmp):
    data = spark.range(3000).select(
        (F.col("id") % 7).alias("part_no"),
        F.when(F.col("id") % 10 == 0, None).when(F.col("id") == 11, float("nan")).when(F.col("id") == 12, float("-inf"))
        .otherwise(F.col("id").cast("double")).alias("x"),
        F.concat(F.lit("v"), F.col("id") % 40).alias("odd name"),
        F.lit(None).cast("int").alias("none"),
    )
    names = ["x", "odd name", "none"]
    parts = quality_state(data, names, ["part_no"])
    save_states(parts.filter("part_no < 3"), f"{tmp}/s", "a")
    save_states(parts, f"{tmp}/s", "b")
    save_states(parts.filter("part_no >= 3"), f"{tmp}/s", "b")  # a part written again replaces its own states
    merged = {r.column_name: r for r in summarize(merge_states(load_states(spark, f"{tmp}/s"))).collect()}
    whole = {r.column_name: r for r in summarize(quality_state(data, names)).collect()}
    exact = ("n_rows", "n_nulls", "n_broken", "low", "high", "null_share")
    for name in names:
        assert [merged[name][c] for c in exact] == [whole[name][c] for c in exact]
    assert [merged["x"][c] for c in exact] == [3000, 300, 2, 1.0, 2999.0, 0.1]
    assert abs(merged["x"].distinct - 2698) <= 0.05 * 2698 and merged["odd name"].distinct == 40
    for p, q in zip((0.05, 0.25, 0.5, 0.75, 0.95), merged["x"].quantiles, strict=True):
        assert abs(q / 3000 - p) <= 0.01
    assert merged["none"].low is None and merged["none"].quantiles is None and merged["none"].distinct == 0
    empty = summarize(quality_state(data.filter(F.lit(False)), names)).collect()
    assert {(r.n_rows, r.null_share, r.distinct) for r in empty} == {(0, None, 0)}


def test_drift_fails_on_a_shift_and_not_on_a_reshuffle(spark):
    data = spark.range(4000).select((F.col("id") % 1000).cast("double").alias("x"), F.lit(None).cast("double").alias("none"))
    rules = [DriftRule(c, k, 0.1) for c in ("x", "none", "absent") for k in ("psi", "ks", "null_share", "distinct")]
    state = lambda d: quality_state(d, ["x", "none"])

    def told(new, old=data):
        return {(r.column_name, r.kind): (r.value, r.passed) for r in drift(state(old), state(new), rules).collect()}

    same = told(data.orderBy(F.rand(3)).repartition(7))
    assert all(passed == (column != "absent") for (column, _), (_, passed) in same.items())
    assert same[("none", "ks")] == (0.0, True) and same[("absent", "ks")] == (None, False)
    moved = told(data.withColumn("x", F.col("x") + 300))
    assert abs(moved[("x", "ks")][0] - 0.3) <= 0.02 and not moved[("x", "ks")][1] and not moved[("x", "psi")][1]
    assert moved[("x", "null_share")][1] and moved[("x", "distinct")][1]
    came = told(data.withColumn("none", F.col("x")))
    assert came[("none", "psi")] == (math.inf, False) and came[("none", "null_share")] == (1.0, False)
    assert came[("none", "distinct")] == (math.inf, False)
    with pytest.raises(ValueError, match="unknown kinds"):
        drift(state(data), state(data), [DriftRule("x", "chi", 1)])


# ----------------------------------------------------------------- publishing

SALES = "sale_id,customer_id,product_id,product_name,amount,sale_date\n"


def test_readers_see_whole_runs_only(spark, tmp, monkeypatch):
    def drop(name, text):
        os.makedirs(f"{tmp}/raw/sales", exist_ok=True)
        with open(f"{tmp}/raw/sales/{name}.csv", "w", encoding="utf-8") as f:
            f.write(SALES + text)

    def seen():
        return rows(spark.table("published_test.processed_sales"), "sale_id", "running_total")

    def publish():
        return publish_job.publish_sales(spark, f"{tmp}/raw", f"{tmp}/out", "2024-06-01 00:00:00", "published_test")

    drop("a", "1,c1,p,n,10.00,2024-01-01\n")
    assert publish()["run"] == 1
    first = seen()
    reader = spark.table("published_test.processed_sales")
    drop("b", "2,c1,p,n,5.00,2024-01-02\n")
    whole = publish_job.run_sales_job

    def broken(*args, **options):
        whole(*args, **options)  # everything is written, and then the run fails
        raise RuntimeError("lost")

    monkeypatch.setattr(publish_job, "run_sales_job", broken)
    with pytest.raises(RuntimeError, match="lost"):
        publish()
    assert seen() == first and len(first) == 1
    monkeypatch.setattr(publish_job, "run_sales_job", whole)
    assert publish()["run"] == 3
    assert [r[0] for r in seen()] == ["1", "2"] and rows(reader, "sale_id") == [("1",)]
    assert spark.table("published_test.customer_segments").count() == 1
    assert publish_job.drop_old_runs(spark, f"{tmp}/out", "published_test", published=3, keep=1) == [1]
    assert sorted(os.listdir(f"{tmp}/out")) == ["run=2", "run=3"] and len(seen()) == 2
    assert not spark.catalog.tableExists("published_test.processed_sales_run1")
