"""Event-table operators: manifests, classification, routing, job runs, readiness."""

import datetime as dt
import json

from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators.events import (
    classify_events,
    job_failures,
    job_metrics,
    match_rules,
    orchestration_log,
    readiness,
    route_events,
    validate_manifest,
)
from tidemark.plans.queries import q_job_metrics
from tidemark.schemas import JOB_RUNS
from tidemark.functions import iso_time
from tidemark.sources.events import malformed_events, parse_bus_events, parse_manifest

CUST = "data-pipeline-customer-data-etl-dev"
SALES = "data-pipeline-sales-data-etl-dev"


def bodies(spark, docs):
    return spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "id long, body string")


def test_manifest_validation(spark):
    records = [
        {"s3": {"bucket": {"name": "raw"}, "object": {"key": k}}} if k is not None else {"s3": {"bucket": {"name": "raw"}}}
        for k in ["customers/a.csv", "sales/d.CSV", "other/e.json", None, ""]
    ]
    df = bodies(spark, [{"Records": records}, {"Records": []}, {}])
    out = validate_manifest(parse_manifest(df))
    got = rows(out, "key", "is_valid", "message")
    assert got == [
        ("", False, "File  in bucket raw is invalid or missing."),
        ("customers/a.csv", True, "File customers/a.csv in bucket raw is valid."),
        ("other/e.json", False, "File other/e.json in bucket raw is invalid or missing."),
        ("sales/d.CSV", False, "File sales/d.CSV in bucket raw is invalid or missing."),
        (None, False, "File None in bucket raw is invalid or missing."),
    ]


def file_event(key):
    return {"source": "aws.s3", "detail-type": "Object Created", "detail": {"bucket": {"name": "raw"}, "object": {"key": key}}}


def test_classify_and_route(spark):
    docs = [
        file_event("customers/a.csv"),
        file_event("sales/2024/b.csv"),
        file_event("customers/sales/c.csv"),
        file_event("sales/d.CSV"),
        file_event("other/e.json"),
        {"source": "aws.events", "detail-type": "Scheduled Event", "resources": ["rule Scheduled Event"]},
        {"source": "aws.events", "detail-type": "Scheduled Event", "resources": []},
        {"source": "aws.glue", "detail-type": "Glue Job State Change", "detail": {"jobName": CUST, "state": "SUCCEEDED"}},
        {"source": "aws.glue", "detail-type": "Glue Job State Change", "detail": {"jobName": SALES, "state": "FAILED"}},
        {"source": "x"},
    ]
    out = match_rules(route_events(classify_events(parse_bus_events(bodies(spark, docs)))), ["raw"], [CUST])
    got = {r["id"]: (r["event_class"], r["action"], r["target"], r["matched_rule"]) for r in out.collect()}
    assert got[0] == ("file_created", "start_job", CUST, "file_created")
    assert got[1] == ("file_created", "start_job", SALES, "file_created")
    assert got[2][2] == CUST  # first match wins
    assert got[3][2] == SALES
    assert got[4][1:3] == (None, None)
    assert got[5][:2] == ("scheduled", "start_workflow")
    assert got[6][0] == "other"
    assert got[7] == ("job_state_change", "job_succeeded", CUST, "job_state_rule")
    assert got[8] == ("job_state_change", "job_failed", SALES, None)
    assert got[9][0] == "other"


def test_orchestration_log(spark):
    docs = [
        file_event("customers/a.csv"),
        file_event("sales/b.csv"),
        {"source": "aws.events", "detail-type": "Scheduled Event", "resources": ["rule Scheduled Event"]},
        {"source": "aws.events", "detail-type": "Scheduled Event", "resources": ["rule Scheduled Event"]},
        {"source": "aws.glue", "detail-type": "Glue Job State Change", "detail": {"jobName": CUST, "jobRunId": "r", "state": "RUNNING"}},
        {"source": "aws.glue", "detail-type": "Glue Job State Change"},
        {"source": "x"},
    ]
    events = bodies(spark, docs).withColumnRenamed("id", "event_id").withColumn("original_event", F.col("body"))
    starts = spark.createDataFrame(
        [(0, "j0", None), (1, None, "no capacity"), (2, "w2", None), (3, None, "busy")], "event_id long, run_id string, start_error string"
    )
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    got = {r.event_id: r for r in orchestration_log(route_events(classify_events(parse_bus_events(events))), at, starts).collect()}
    flow = "data-pipeline-main-workflow-dev"
    want = {
        0: [{"job_name": CUST, "job_run_id": "j0", "status": "STARTED"}],
        2: [{"workflow_name": flow, "workflow_run_id": "w2", "status": "STARTED"}],
        3: [{"workflow_name": flow, "status": "FAILED", "error": "busy"}],
        4: [{"job_name": CUST, "job_run_id": "r", "state": "RUNNING", "processed": True}],
        5: [{"job_name": "", "job_run_id": "", "state": "", "processed": True}],
        6: [],
    }
    for i, results in want.items():
        assert json.loads(got[i].results) == results and got[i].status is None
        assert got[i].event_processed == docs[i].get("detail-type", "")
    assert got[1].results is None and (got[1].status, got[1].error) == ("FAILED", "no capacity")
    assert json.loads(got[1].original_event) == docs[1]
    assert got[0].orchestration_timestamp == "2024-01-01T00:00:00"


def test_malformed_events(spark):
    texts = ['{"source":"x"}', '{"source":', "not json", "", None, "[1]", '{"Records":[]}']
    df = spark.createDataFrame(list(enumerate(texts)), "id long, body string")
    got = rows(malformed_events(df), "id", "reject_reason")
    bad = "malformed_json"
    assert got == [(1, bad), (2, bad), (3, bad), (4, "null_body"), (5, bad)]
    assert parse_bus_events(df).count() == len(texts)


def test_iso_time(spark):
    df = spark.createDataFrame([(t(1),), (dt.datetime(2024, 1, 1, 1, 2, 3, 450),), (None,)], "ts timestamp_ntz")
    got = [r[0] for r in df.select(iso_time("ts")).collect()]
    assert got == [t(1).isoformat(), "2024-01-01T01:02:03.000450", None]


def runs(spark, data):
    return spark.createDataFrame(data, JOB_RUNS)


def t(h):
    return dt.datetime(2024, 1, 1, h)


def test_job_metrics_and_failures(spark):
    df = runs(
        spark,
        [
            (CUST, "1", "SUCCEEDED", t(1), 10, None),
            (CUST, "2", "FAILED", t(2), None, None),
            (CUST, "3", "FAILED", t(3), 30, "boom"),
        ],
    )
    m = job_metrics(df).first()
    assert (m.runs, m.succeeded, m.failed, m.total_execution_seconds, m.max_execution_seconds) == (3, 1, 2, 40, 30)
    assert rows(job_failures(df, F.lit("t")), "job_run_id", "error_message") == [("2", "Unknown error"), ("3", "boom")]


def test_job_metrics_query_takes_the_seconds_of_every_run(spark, tmp):
    """Ids 1 and 2 of each seven still run or were stopped: their seconds count like the others'."""
    events = [
        (0, 2, "purchase", 1.0, "{}"),
        (1, 2, "purchase", 9.0, "{}"),  # RUNNING
        (2, 2, "click", 4.0, "{}"),  # STOPPED
        (3, 2, "view", 50.0, "{}"),  # no seconds: 0
        (4, 2, "error", 2.0, "{}"),
        (8, 1, "click", 0.5, "{}"),  # the only run of its job is RUNNING
        (9, None, "click", None, "{}"),  # STOPPED, no user, no seconds
    ]
    table = spark.createDataFrame(events, "event_id long, user_id long, event_type string, value double, props string")
    table.withColumn("ts", F.lit(t(1))).write.parquet(f"{tmp}/events.parquet")
    columns = ("job_name", "runs", "succeeded", "failed", "total_execution_seconds", "avg_execution_seconds", "max_execution_seconds")
    assert rows(q_job_metrics(spark, tmp), *columns) == [(CUST, 5, 2, 1, 160, 32.0, 90), (SALES, 2, 0, 0, 5, 2.5, 5)]


def test_readiness_gate(spark):
    day = dt.datetime(2024, 1, 1)
    d2 = dt.datetime(2024, 1, 2)
    d3 = dt.datetime(2024, 1, 3)
    df = runs(
        spark,
        [
            (CUST, "1", "SUCCEEDED", day, 1, None),  # only customer → not ready
            (CUST, "2", "SUCCEEDED", d2, 1, None),
            (SALES, "3", "SUCCEEDED", d2, 1, None),  # both → ready
            (CUST, "4", "SUCCEEDED", d3, 1, None),
            (SALES, "5", "FAILED", d3, 1, None),  # one failed → not ready
        ],
    )
    got = rows(readiness(df, [CUST, SALES], ["c", "s"]), "run_window", "ready")
    assert got == [(day.date(), False), (d2.date(), True), (d3.date(), False)]
