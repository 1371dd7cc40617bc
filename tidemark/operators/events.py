"""Event-table operators: the data half of orchestration.

The reference handles one event per function call. Here events are rows, so
millions of file notifications or job-state events are classified, routed and
summarised as ordinary DataFrame work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.constants import (
    CUSTOMER_JOB,
    CUSTOMERS_PREFIX,
    ENVIRONMENT_DEFAULT,
    JOB_STATE_DETAIL_TYPE,
    JOB_EVENT_SOURCE,
    INVALID_FILE_MESSAGE,
    PROJECT_DEFAULT,
    FILE_CREATED_DETAIL_TYPE,
    FILE_EVENT_SOURCE,
    FILE_TRIGGER,
    SALES_JOB,
    SALES_PREFIX,
    SCHEDULE_MARKER,
    SCHEDULE_SOURCE,
    STATE_FAILED,
    STATE_STARTED,
    STATE_SUCCEEDED,
    UNKNOWN_ERROR,
    VALID_FILE_MESSAGE,
    VALID_SUFFIX,
)
from tidemark.functions import iso_time, job_full_name

# ------------------------------------------------------------------ file manifests


def validate_manifest(records: DataFrame, suffix: str = VALID_SUFFIX) -> DataFrame:
    """One row per notification record: (bucket, key, is_valid, message).

    Expects the exploded records (see sources.events.parse_manifest). A key is
    valid when it is non-empty and ends with ``suffix`` (case-sensitive). Missing
    values print as ``None`` in the message, as the reference's f-string does.
    """
    key = F.col("key")
    valid = key.isNotNull() & (key != "") & key.endswith(suffix)
    shown_key = F.coalesce(key, F.lit("None"))
    shown_bucket = F.coalesce(F.col("bucket"), F.lit("None"))
    return records.withColumns(
        {
            "is_valid": valid,
            "message": F.when(valid, F.format_string(VALID_FILE_MESSAGE, shown_key, shown_bucket)).otherwise(
                F.format_string(INVALID_FILE_MESSAGE, shown_key, shown_bucket)
            ),
        }
    )


# --------------------------------------------------------------------- bus events


def classify_events(events: DataFrame) -> DataFrame:
    """event_class by first match — file_created, scheduled, job_state_change, other.

    As in the reference, a scheduled event is recognised by the marker text in
    ``resources[0]`` (missing or empty list → not scheduled).
    """
    src, dtype = F.col("source"), F.col("detail_type")
    first_resource = F.coalesce(F.get(F.col("resources"), 0), F.lit(""))
    cls = (
        F.when((src == FILE_EVENT_SOURCE) & (dtype == FILE_CREATED_DETAIL_TYPE), F.lit("file_created"))
        .when((src == SCHEDULE_SOURCE) & first_resource.contains(SCHEDULE_MARKER), F.lit("scheduled"))
        .when((src == JOB_EVENT_SOURCE) & (dtype == JOB_STATE_DETAIL_TYPE), F.lit("job_state_change"))
        .otherwise(F.lit("other"))
    )
    return events.withColumn("event_class", cls)


def route_events(
    events: DataFrame, project: str = PROJECT_DEFAULT, environment: str = ENVIRONMENT_DEFAULT
) -> DataFrame:
    """What each classified event asks for: (action, target, arguments).

    ``arguments`` is what a started job is told, as JSON: the trigger, bucket and key.
    File events: key containing 'customers/' → customer job, else 'sales/' → sales
    job (order matters), else nothing. Scheduled events start the main workflow.
    Job-state events report the job's terminal state.
    """
    key = F.coalesce(F.col("key"), F.lit(""))
    job = F.when(key.contains(CUSTOMERS_PREFIX), F.lit(CUSTOMER_JOB)).when(
        key.contains(SALES_PREFIX), F.lit(SALES_JOB)
    )
    cls = F.col("event_class")
    state = F.col("state")
    action = (
        F.when((cls == "file_created") & job.isNotNull(), F.lit("start_job"))
        .when(cls == "scheduled", F.lit("start_workflow"))
        .when((cls == "job_state_change") & (state == STATE_SUCCEEDED), F.lit("job_succeeded"))
        .when((cls == "job_state_change") & (state == STATE_FAILED), F.lit("job_failed"))
        .when(cls == "job_state_change", F.lit("job_state_recorded"))
    )
    target = (
        F.when((cls == "file_created") & job.isNotNull(), job_full_name(job, project, environment))
        .when(cls == "scheduled", job_full_name(F.lit("main-workflow"), project, environment))
        .when(cls == "job_state_change", F.col("job_name"))
    )
    given = F.struct(
        F.lit(FILE_TRIGGER).alias("--trigger_event"),
        F.col("bucket").alias("--source_bucket"),
        F.col("key").alias("--source_key"),
    )
    arguments = F.when((cls == "file_created") & job.isNotNull(), F.to_json(given))
    return events.withColumns({"action": action, "target": target, "arguments": arguments})


def match_rules(
    events: DataFrame, raw_buckets: Sequence[str], job_names: Sequence[str]
) -> DataFrame:
    """Which event rule (if any) matches: file-created on a raw bucket, or a
    state change of a known job. The schedule rule has no pattern (cron)."""
    src, dtype = F.col("source"), F.col("detail_type")
    rule = F.when(
        (src == FILE_EVENT_SOURCE) & (dtype == FILE_CREATED_DETAIL_TYPE) & F.col("bucket").isin(*raw_buckets),
        F.lit("file_created"),
    ).when(
        (src == JOB_EVENT_SOURCE) & (dtype == JOB_STATE_DETAIL_TYPE) & F.col("job_name").isin(*job_names),
        F.lit("job_state_rule"),
    )
    return events.withColumn("matched_rule", rule)


def orchestration_log(routed: DataFrame, at: Column, starts: DataFrame | None = None) -> DataFrame:
    """One log row per handled event, the orchestrator's completion or failure event.

    ``starts`` is what the launcher reported, one row per event it acted on: (event_id,
    run_id, start_error). Without it every start counts as done, with an unknown run id.

    * ``results`` is JSON text: job and run id of a start; of a workflow, or its error; of
      a job's state change with the state; ``[]`` for events that ask for nothing.
    * A job that could not be started fails its event: ``status`` is FAILED, with the error
      and, where ``routed`` carries it, the original event; it has no results.
    """
    if starts is None:
        no_text = F.lit(None).cast("string")
        told = routed.withColumns({"run_id": no_text, "start_error": no_text})
    else:
        told = routed.join(starts.select("event_id", "run_id", "start_error"), "event_id", "left")
    action, error = F.col("action"), F.col("start_error")
    job, flow = action == "start_job", action == "start_workflow"
    state = F.col("event_class") == "job_state_change"
    start_status = F.when(error.isNull(), F.lit(STATE_STARTED)).otherwise(F.lit(STATE_FAILED))
    # to_json leaves null fields out, so each kind of result shows its own.
    result = F.struct(
        F.when(flow, F.col("target")).alias("workflow_name"),
        F.when(flow, F.col("run_id")).alias("workflow_run_id"),
        F.when(job | state, F.col("target")).alias("job_name"),
        F.when(job, F.col("run_id")).when(state, F.col("job_run_id")).alias("job_run_id"),
        F.when(state, F.col("state")).alias("state"),
        F.when(state, F.lit(True)).alias("processed"),
        F.when(job | flow, start_status).alias("status"),
        F.when(flow, error).alias("error"),
    )
    failed = F.coalesce(job, F.lit(False)) & error.isNotNull()
    results = F.when(action.isNotNull(), F.to_json(F.array(result))).otherwise(F.lit("[]"))
    original = F.col("original_event") if "original_event" in routed.columns else F.lit(None).cast("string")
    return told.select(
        "event_id",
        iso_time(at).alias("orchestration_timestamp"),
        F.when(~failed, F.col("detail_type")).alias("event_processed"),
        F.when(~failed, results).alias("results"),
        F.when(failed, F.lit(STATE_FAILED)).alias("status"),
        F.when(failed, error).alias("error"),
        F.when(failed, original).alias("original_event"),
    )


# ----------------------------------------------------------------------- job runs

TERMINAL_STATES = (STATE_SUCCEEDED, STATE_FAILED)


def job_outcomes(runs: DataFrame) -> DataFrame:
    """Terminal job runs only (SUCCEEDED or FAILED)."""
    return runs.filter(F.col("state").isin(*TERMINAL_STATES)).select(
        "job_name", "job_run_id", "state", "started_on"
    )


def job_metrics(runs: DataFrame, finished_only: bool = True) -> DataFrame:
    """Per job — runs, successes, failures, execution seconds (missing → 0).

    ``finished_only=False`` takes the seconds of every run, whatever its state. Otherwise runs
    that still run or were stopped count as runs, but not in the seconds, and without a
    finished run the seconds are null.
    """
    secs = F.coalesce(F.col("execution_time_seconds"), F.lit(0))
    if finished_only:
        secs = F.when(F.col("state").isin(*TERMINAL_STATES), secs)
    return runs.groupBy("job_name").agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(F.col("state") == STATE_SUCCEEDED).alias("succeeded"),
        F.count_if(F.col("state") == STATE_FAILED).alias("failed"),
        F.sum(secs).cast("bigint").alias("total_execution_seconds"),
        F.try_divide(F.sum(secs).cast("double"), F.count(secs)).alias("avg_execution_seconds"),
        F.max(secs).cast("bigint").alias("max_execution_seconds"),
    )


def job_run_metrics(runs: DataFrame, at: Column) -> DataFrame:
    """J5, a row for each successful run: id, status, execution seconds (missing → 0), completion time."""
    return runs.filter(F.col("state") == STATE_SUCCEEDED).select(
        "job_name",
        "job_run_id",
        F.lit("SUCCESS").alias("status"),
        F.coalesce(F.col("execution_time_seconds"), F.lit(0)).cast("bigint").alias("execution_time_seconds"),
        at.alias("completion_time"),
    )


def job_failures(runs: DataFrame, at: Column) -> DataFrame:
    """Failed runs with their error text ('Unknown error' when missing) and the time of the report."""
    return runs.filter(F.col("state") == STATE_FAILED).select(
        "job_name",
        "job_run_id",
        F.coalesce(F.col("error_message"), F.lit(UNKNOWN_ERROR)).alias("error_message"),
        "started_on",
        at.alias("failure_time"),
    )


def readiness(
    runs: DataFrame,
    required: Sequence[str],
    labels: Sequence[str] | None = None,
    window: Column | None = None,
) -> DataFrame:
    """Per run window, ready when the latest run of *every* required job succeeded.

    This follows the workflow's AND condition, not the orchestrator's shortcut
    (which fires on either job). ``window`` defaults to the run date. The latest
    run per (window, job) is a max_by aggregate — combined map-side, so a busy job
    never sends all its runs to one task. Of two notices of one run the one with a
    terminal state counts. ``streaming.readiness_gate`` gives the same as a stream.
    """
    win = window if window is not None else F.to_date("started_on")
    newest = F.struct("started_on", "job_run_id", F.col("state").isin(*TERMINAL_STATES), "state")
    latest = (
        runs.filter(F.col("job_name").isin(*required))
        .withColumn("run_window", win)
        .groupBy("run_window", "job_name")
        .agg(F.max_by("state", newest).alias("latest_state"))
    )
    names = list(labels) if labels else [f"state_{i}" for i in range(len(required))]
    per_job = [
        F.max(F.when(F.col("job_name") == j, F.col("latest_state"))).alias(n)
        for j, n in zip(required, names)
    ]
    ready = F.lit(True)
    for n in names:
        ready = ready & F.coalesce(F.col(n) == STATE_SUCCEEDED, F.lit(False))
    return latest.groupBy("run_window").agg(*per_job).withColumn("ready", ready)
