"""The orchestration log as a stream, each event once.

Notifications are delivered at least once: an event can come twice, late, or again after a
restart. Three things keep its log row single:

* ``dropDuplicatesWithinWatermark`` on the event id, with state that is dropped once the
  watermark has passed, so it doesn't grow with the history;
* each micro-batch writes a folder of its own, which a replay of the batch writes again;
* a job's own events go to a folder named by run and kind (``record_run_event``), so a
  rerun of a run replaces them.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.events import classify_events, orchestration_log, route_events
from tidemark.schemas import PIPELINE_EVENTS
from tidemark.sinks import event_rows, write_plain
from tidemark.sources.events import parse_bus_events
from tidemark.streaming.ingest import _numbered

EVENT_FILE = "event_id bigint, body string"


def stream_event_log(
    spark: SparkSession,
    events_dir: str,
    log_path: str,
    checkpoint: str,
    at: Column,
    delay: str = "1 day",
    max_files: int | None = None,
):
    """Run the log stream once over all new event files (JSON lines of event_id and body).

    An event's time is the bus's own (``time`` of its body). Events without a readable time
    can't be told from late ones: they are logged, and deduplicated within their batch only.
    """
    reader = spark.readStream.schema(EVENT_FILE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    read = reader.json(events_dir).withColumn("original_event", F.col("body"))
    timed = parse_bus_events(read).withColumn("event_time", F.col("time").try_cast("timestamp"))
    once = timed.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["event_id"])
    # Stateful operators drop rows that are behind the watermark; null times never are.
    log = orchestration_log(route_events(classify_events(once)), at)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_plain(batch, f"{log_path.rstrip('/')}/batch_id={batch_id}")

    query = log.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def read_event_log(spark: SparkSession, log_path: str) -> DataFrame:
    """The log rows of all complete batches."""
    root = log_path.rstrip("/")
    done = _numbered(spark, root, "batch_id", need_success=True)
    if not done:
        raise ValueError(f"no log under {log_path}")
    return spark.read.parquet(*[f"{root}/batch_id={n}" for n in done])


def record_run_event(
    path: str, run_id: str, event_type: str, detail: DataFrame, event_time: _dt.datetime | None = None
) -> None:
    """Write a run's event of one kind to its own folder: a rerun of the run replaces it."""
    spark = detail.sparkSession
    rows = event_rows(spark, run_id, event_type, detail, event_time)
    out = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "event_type")
    out.parquet(path)


def read_run_events(spark: SparkSession, path: str) -> DataFrame:
    """All recorded events, in the columns of the event log."""
    return spark.read.schema(PIPELINE_EVENTS).parquet(path).select(*PIPELINE_EVENTS.names)
