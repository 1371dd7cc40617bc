"""Sinks (A8-A10, A13-A16): partitioned Parquet, catalog tables, the event log."""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import PIPELINE_EVENTS


def write_partitioned(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    mode: str = "overwrite",
    spread_by: Sequence[str] = (),
    replace: str = "all",
) -> None:
    """Hive-partitioned Parquet.

    Rows are rebalanced on the partition keys before the write: a folder's rows
    meet in few tasks, so there is no small-file explosion, and adaptive execution
    cuts a folder that holds a third of the data into as many tasks as its size
    asks for. Nothing is sampled, so the rows are computed once. Files come out
    sorted on ``spread_by``, so their min/max statistics let later scans skip files.

    ``replace``: ``all`` replaces the whole output, whatever the session's
    ``partitionOverwriteMode`` says; ``touched`` only the partitions written.
    """
    overwrite = {"all": "static", "touched": "dynamic"}[replace]
    out = df.hint("rebalance", *keys) if keys else df
    if spread_by:
        out = out.sortWithinPartitions(*keys, *spread_by)
    out.write.mode(mode).option("partitionOverwriteMode", overwrite).partitionBy(*keys).parquet(path)


def write_plain(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A10: unpartitioned Parquet."""
    df.write.mode(mode).parquet(path)


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """CREATE DATABASE IF NOT EXISTS."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")


def save_table(
    df: DataFrame,
    database: str,
    table: str,
    keys: Sequence[str] = (),
    mode: str = "overwrite",
    path: str | None = None,
) -> str:
    """A catalog table (partitioned when ``keys`` are given); returns its name."""
    name = f"`{database}`.`{table}`"
    writer = (df.hint("rebalance", *keys) if keys else df).write.mode(mode).format("parquet")
    if keys:
        writer = writer.partitionBy(*keys)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return name


def register_table(spark: SparkSession, database: str, table: str, path: str, keys: Sequence[str] = ()) -> str:
    """A catalog table over Parquet that lies at ``path``; nothing is copied.

    An older table of that name is replaced (its files stay), and the partition
    folders are registered.
    """
    name = f"`{database}`.`{table}`"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    schema = spark.read.parquet(path).schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parts = f" PARTITIONED BY ({', '.join(f'`{k}`' for k in keys)})" if keys else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{parts} LOCATION '{path}'")
    if keys:
        repair_partitions(spark, database, table)
    return name


def register_views(spark: SparkSession, tables: dict[str, str]) -> list[str]:
    """Expose written Parquet outputs to ``spark.sql`` as temporary views
    (name → path). Partition columns are recovered, so SQL filters on them prune."""
    for name, path in tables.items():
        spark.read.parquet(path).createOrReplaceTempView(name)
    return sorted(tables)


def repair_partitions(spark: SparkSession, database: str, table: str) -> None:
    """Register partition folders written outside the catalog."""
    spark.sql(f"MSCK REPAIR TABLE `{database}`.`{table}`")


def event_rows(
    spark: SparkSession, run_id: str, event_type: str, detail: DataFrame, event_time: _dt.datetime | None = None
) -> DataFrame:
    """One event row per detail row: (run_id, event_type, detail JSON, event_time).

    ``detail`` is a (usually one-row) DataFrame of metrics; it is encoded with
    ``to_json`` on the executors, never collected.
    """
    ts = event_time or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    return detail.select(
        F.lit(run_id).alias("run_id"),
        F.lit(event_type).alias("event_type"),
        F.to_json(F.struct(*detail.columns)).alias("detail"),
        F.lit(ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz").alias("event_time"),
    )


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PIPELINE_EVENTS).parquet(path)


def new_run_id() -> str:
    return uuid.uuid4().hex
