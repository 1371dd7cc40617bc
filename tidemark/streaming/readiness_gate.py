"""The readiness gate as a stream (J7): a verdict per run window, and a deadline for it.

State per window is the newest run of each required job, so it is as small as the list of
jobs and repeated, shuffled or late notices can't change the outcome. A window's timer
fires once the watermark has passed its end and the grace time: a window that is not ready
then is told as ``timed_out``, and its state is dropped. No run of it can follow, as Spark
drops rows behind the watermark.

A busy window's runs don't all meet in one task: each task first reduces its rows to the
newest run of every job and window.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.constants import STATE_SUCCEEDED
from tidemark.operators.events import TERMINAL_STATES
from tidemark.sinks import write_plain
from tidemark.streaming.ingest import _numbered

RUN_FILE = "job_name string, job_run_id string, state string, started_on timestamp"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SHUFFLE = "spark.sql.shuffle.partitions"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"

# What tells a window's newest run of a job, as in ``events.readiness``.
NEWER = ["at", "job_run_id", "terminal", "state"]
REDUCED = "run_window string, job_name string, job_run_id string, terminal boolean, state string, at bigint, due bigint"


def newest_runs(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each batch of rows the newest run of every window and job."""
    for rows in batches:
        ordered = rows.sort_values(NEWER, na_position="first", kind="stable")
        yield ordered.drop_duplicates(["run_window", "job_name"], keep="last")


def _order(run: tuple) -> tuple:
    """Sort key with nulls first."""
    return tuple((v is not None, v) for v in run)


class ReadinessGate(StatefulProcessor):
    """Emits a window's verdict whenever a required job's newest state changes, and at its deadline."""

    def __init__(self, required: Sequence[str], labels: Sequence[str]):
        self.required, self.labels = list(required), list(labels)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._newest = handle.getMapState("newest", "job_name string", "at bigint, job_run_id string, terminal boolean, state string")
        self._told = handle.getValueState("told", "version bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        changed, due = False, None
        for chunk in rows:
            for r in chunk.itertuples(index=False):
                run = tuple(None if pd.isna(v) else v for v in (r.at, r.job_run_id, r.terminal, r.state))
                run = (None if run[0] is None else int(run[0]), run[1], None if run[2] is None else bool(run[2]), run[3])
                due = None if pd.isna(r.due) else int(r.due)
                job = (r.job_name,)
                held = tuple(self._newest.getValue(job)) if self._newest.containsKey(job) else None
                if held is None or _order(run) > _order(held):
                    self._newest.updateValue(job, run)
                    changed = changed or held is None or held[3] != run[3]
        if due is not None and not self._told.exists():
            self._handle.registerTimer(due)
        if changed:
            yield self._verdict(key[0], timed_out=False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        verdict = self._verdict(key[0], timed_out=True)
        self._newest.clear()
        self._told.clear()
        if not verdict["ready"].iloc[0]:
            yield verdict

    def _verdict(self, window: str, timed_out: bool) -> pd.DataFrame:
        version = (self._told.get()[0] if self._told.exists() else 0) + 1
        self._told.update((version,))
        states = [self._newest.getValue((j,))[3] if self._newest.containsKey((j,)) else None for j in self.required]
        row = dict(zip(self.labels, states, strict=True))
        ready = all(s == STATE_SUCCEEDED for s in states)
        return pd.DataFrame([{"run_window": window, **row, "ready": ready, "timed_out": timed_out, "version": version}])

    def close(self) -> None:
        pass


def gate_updates(
    runs: DataFrame, required: Sequence[str], labels: Sequence[str], delay: str = "1 day", grace_seconds: int = 0
) -> DataFrame:
    """Streaming runs (``RUN_FILE``) → verdicts: (run_window, a state per job, ready, timed_out, version).

    The window is the run date, as in ``events.readiness``. Its deadline is ``grace_seconds``
    after its end, by the watermark (newest start less ``delay``). Runs of other jobs are
    left out; runs without a start share the window ``''``, which has no deadline.
    """
    day = F.to_date("started_on")
    read = runs.filter(F.col("job_name").isin(*required)).select(
        F.coalesce(day.cast("string"), F.lit("")).alias("run_window"),
        "job_name",
        "job_run_id",
        F.col("state").isin(*TERMINAL_STATES).alias("terminal"),
        "state",
        F.unix_micros("started_on").alias("at"),
        (F.unix_millis(F.date_add(day, 1).cast("timestamp")) + F.lit(grace_seconds * 1000)).alias("due"),
    )
    reduced = read.mapInPandas(newest_runs, REDUCED)
    timed = reduced.withColumn("started_on", F.timestamp_micros("at")).withWatermark("started_on", delay)
    out = ", ".join(["run_window string", *(f"{n} string" for n in labels), "ready boolean, timed_out boolean, version bigint"])
    gate = ReadinessGate(required, labels)
    return timed.groupBy("run_window").transformWithStateInPandas(gate, out, "update", "eventTime")


def stream_readiness(
    spark: SparkSession,
    runs_dir: str,
    out_path: str,
    checkpoint: str,
    required: Sequence[str],
    labels: Sequence[str],
    delay: str = "1 day",
    grace_seconds: int = 0,
    max_files: int | None = None,
    partitions: int = 4,
):
    """Run the gate once over all new run files (JSON lines); each micro-batch's verdicts go to
    a folder of their own, which a replay writes again.

    ``partitions`` share the state, for the life of the checkpoint; it holds a row per open
    window and job. The state needs the RocksDB provider; the session's own settings are left
    as they were.
    """
    reader = spark.readStream.schema(RUN_FILE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    updates = gate_updates(reader.json(runs_dir), required, labels, delay, grace_seconds)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_plain(batch, f"{out_path.rstrip('/')}/batch_id={batch_id}")

    writer = updates.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)
    asked = {PROVIDER: ROCKSDB, SHUFFLE: str(partitions)}
    before = {name: spark.conf.get(name) for name in asked}
    for name, value in asked.items():
        spark.conf.set(name, value)
    try:
        query = writer.trigger(availableNow=True).start()  # takes a copy of the settings
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    query.awaitTermination()
    return query


def current_gate(spark: SparkSession, out_path: str) -> DataFrame:
    """Each window's last verdict, in the columns of ``events.readiness`` and ``timed_out``."""
    root = out_path.rstrip("/")
    done = _numbered(spark, root, "batch_id", need_success=True)
    if not done:
        raise ValueError(f"no verdicts under {out_path}")
    told = spark.read.parquet(*[f"{root}/batch_id={n}" for n in done])
    values = [c for c in told.columns if c not in ("run_window", "version")]
    last = told.groupBy("run_window").agg(F.max_by(F.struct(*values), "version").alias("v"))
    return last.select(F.nullif("run_window", F.lit("")).cast("date").alias("run_window"), "v.*")
