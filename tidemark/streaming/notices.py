"""Ingest that follows arrival notices instead of listing folders.

A stream over the notices reads the files that they name, each once. A notice may come
twice, late or in any order, and may name a file that is not there (yet):

* the notices of a micro-batch are made distinct and those of files that earlier batches
  have read are left out (an anti join with the ledger);
* the rows and the batch's ledger go to folders named by the batch, which a replay writes
  again; the ledger is written last, so a file counts as read only when its rows are there;
* a file that is not found is put down as such and is read when a later notice names it.

A file is known by bucket and key: one that is overwritten under its old key is not read
again. The names of one micro-batch's files reach the driver, as in any file read;
``max_files`` bounds the notice files of a batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.constants import SALES_PREFIX
from tidemark.operators.events import validate_manifest
from tidemark.operators.sales import stage_sales
from tidemark.schemas import RAW_SALES
from tidemark.sinks import write_plain
from tidemark.sources.events import parse_manifest
from tidemark.sources.layouts import list_files, literal_path, read_files
from tidemark.streaming.ingest import _hadoop_fs, _numbered

# Amounts stay text until they are staged, so that one out of range gets its reason.
SALES_TEXT = T.StructType([T.StructField(f.name, T.StringType()) if f.name == "amount" else f for f in RAW_SALES])
LEDGER = "bucket string, key string, found boolean"


def _batches(spark: SparkSession, root: str, below: int | None = None) -> list[str]:
    done = [n for n in _numbered(spark, root, "batch_id", need_success=True) if below is None or n < below]
    return [f"{root}/batch_id={n}" for n in done]


def ingest_notices(
    spark: SparkSession,
    notices_dir: str,
    buckets_root: str,
    staged_path: str,
    ledger_path: str,
    checkpoint: str,
    prefix: str = SALES_PREFIX,
    max_files: int | None = None,
):
    """Run once over all new notice files (JSON lines with a ``body``); the sales files they
    name lie at ``<buckets_root>/<bucket>/<key>``. Only valid keys under ``prefix`` are read."""
    staged, ledger = staged_path.rstrip("/"), ledger_path.rstrip("/")
    reader = spark.readStream.schema("body string")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))

    def handle(batch: DataFrame, batch_id: int) -> None:
        valid = validate_manifest(parse_manifest(batch)).filter(F.col("is_valid") & F.col("key").startswith(prefix))
        named = valid.filter(F.col("bucket").isNotNull()).select("bucket", "key").distinct()
        earlier = _batches(spark, ledger, below=batch_id)
        if earlier:
            read = spark.read.schema(LEDGER).parquet(*earlier).filter("found").select("bucket", "key")
            named = named.join(read, ["bucket", "key"], "left_anti")
        entries, paths = [], []
        for r in named.collect():
            path = f"{buckets_root.rstrip('/')}/{r.bucket}/{r.key}"
            p, fs = _hadoop_fs(spark, path)
            entries.append((r.bucket, r.key, fs.exists(p)))
            if entries[-1][2]:
                paths.append(literal_path(path))
        files = {f.file: f.path for f in list_files(spark, paths, "*").collect()} if paths else {}
        write_plain(stage_sales(read_files(spark, files, SALES_TEXT)), f"{staged}/batch_id={batch_id}")
        write_plain(spark.createDataFrame(entries, LEDGER), f"{ledger}/batch_id={batch_id}")

    query = (
        reader.json(notices_dir)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def staged_notices(spark: SparkSession, staged_path: str, ledger_path: str) -> DataFrame:
    """The staged rows of all complete batches (kept and rejected)."""
    done = {p.rsplit("/", 1)[1] for p in _batches(spark, ledger_path.rstrip("/"))}
    if not done:
        raise ValueError(f"no complete batch under {ledger_path}")
    return spark.read.parquet(*[f"{staged_path.rstrip('/')}/{name}" for name in sorted(done)])


def missing_files(spark: SparkSession, ledger_path: str) -> DataFrame:
    """(bucket, key) of files that were named but have not been found so far."""
    seen = spark.read.schema(LEDGER).parquet(*_batches(spark, ledger_path.rstrip("/")))
    return seen.groupBy("bucket", "key").agg(F.bool_or("found").alias("found")).filter(~F.col("found")).drop("found")
