"""JSON event records as DataFrame sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import nested_or
from tidemark.schemas import BUS_EVENT, MANIFEST
from tidemark.sources.files import CORRUPT_COLUMN, with_corrupt_column


def malformed_events(df: DataFrame, schema: T.StructType = BUS_EVENT, body: str = "body") -> DataFrame:
    """The rows the parsers below can't read, with all their columns and a ``reject_reason``:
    ``null_body``, or ``malformed_json`` for text that is not JSON of this schema."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    parsed = F.from_json(F.col(body), with_corrupt_column(schema), options)
    reason = F.when(F.col(body).isNull(), F.lit("null_body")).when(
        (F.trim(body) == "") | F.col("_m").isNull() | F.col(f"_m.{CORRUPT_COLUMN}").isNotNull(), F.lit("malformed_json")
    )
    marked = df.withColumn("_m", parsed).withColumn("reject_reason", reason).drop("_m")
    return marked.filter(F.col("reject_reason").isNotNull())


def parse_manifest(df: DataFrame, body: str = "body") -> DataFrame:
    """File-arrival notifications → one row per record: (..., bucket, key).

    Other input columns (e.g. an id) are carried along; an empty or missing
    ``Records`` array yields no rows, as iterating an empty list does. Bodies that
    are not JSON are the business of ``malformed_events``.
    """
    keep = [c for c in df.columns if c != body]
    parsed = df.select(*keep, F.from_json(F.col(body), MANIFEST).alias("_m"))
    return parsed.select(*keep, F.explode("_m.Records").alias("_r")).select(
        *keep,
        F.col("_r.s3.bucket.name").alias("bucket"),
        F.col("_r.s3.object.key").alias("key"),
    )


def parse_bus_events(df: DataFrame, body: str = "body") -> DataFrame:
    """Bus events → flat columns: source, detail_type, time, resources, bucket, key,
    job_name, job_run_id, state. A missing text field is '' (H15), a missing time or
    list of resources null. Bodies that are not JSON give a row of such defaults; see
    ``malformed_events``."""
    keep = [c for c in df.columns if c != body]
    e = F.from_json(F.col(body), BUS_EVENT).alias("_e")
    return df.select(*keep, e).select(
        *keep,
        nested_or("_e.source").alias("source"),
        nested_or("_e.`detail-type`").alias("detail_type"),
        F.col("_e.time").alias("time"),
        F.col("_e.resources").alias("resources"),
        nested_or("_e.detail.bucket.name").alias("bucket"),
        nested_or("_e.detail.object.key").alias("key"),
        nested_or("_e.detail.jobName").alias("job_name"),
        nested_or("_e.detail.jobRunId").alias("job_run_id"),
        nested_or("_e.detail.state").alias("state"),
    )
