"""Runs published as a switch (A8, A9, A14): readers see a whole old run or a whole new one.

Each run of a job writes a folder of its own under the output root; its tables are
registered under the run's number, and only then the views that readers use are pointed at
them, one statement each. A run that fails is never pointed at, and what it wrote is never
read. A reader that has begun keeps the run it began with until ``drop_old_runs``.

Runs of one output root must not overlap in time.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import SparkSession

from tidemark.plans.customer_job import run_customer_job
from tidemark.plans.sales_job import run_sales_job
from tidemark.sinks import ensure_database, register_table
from tidemark.streaming.ingest import _hadoop_fs, _numbered

SALES_TABLES = {"processed_sales": ("sales", ("sales_year", "sales_month")), "customer_segments": ("customer_segments", ())}
CUSTOMER_TABLES = {"processed_customers": ("customers", ("registration_year",)), "customer_lineage": ("lineage/customers", ())}


def _publish(spark: SparkSession, job, tables: dict, raw_root: str, out_root: str, as_of, database: str, options: dict) -> dict:
    root = out_root.rstrip("/")
    number = max(_numbered(spark, root, "run"), default=0) + 1  # failed runs count too: their folders stay theirs
    path, fs = _hadoop_fs(spark, f"{root}/run={number}")
    fs.mkdirs(path)
    summary = job(spark, raw_root, f"{root}/run={number}", as_of, **options)
    ensure_database(spark, database)
    for name, (folder, keys) in tables.items():
        register_table(spark, database, f"{name}_run{number}", f"{root}/run={number}/{folder}", keys)
    for name in tables:
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS SELECT * FROM `{database}`.`{name}_run{number}`")
    return {**summary, "run": number}


def publish_sales(
    spark: SparkSession, raw_root: str, out_root: str, as_of: _dt.datetime | str, database: str, **options
) -> dict:
    """The sales job, published as ``processed_sales`` and ``customer_segments``; its summary and run number."""
    return _publish(spark, run_sales_job, SALES_TABLES, raw_root, out_root, as_of, database, options)


def publish_customers(
    spark: SparkSession, raw_root: str, out_root: str, as_of: _dt.datetime | str, database: str, **options
) -> dict:
    """The customer job, published as ``processed_customers`` and ``customer_lineage``."""
    return _publish(spark, run_customer_job, CUSTOMER_TABLES, raw_root, out_root, as_of, database, options)


def drop_old_runs(
    spark: SparkSession, out_root: str, database: str, published: int, tables: dict = SALES_TABLES, keep: int = 1
) -> list[int]:
    """Drop the tables and folders of the runs before ``published``, but for the last ``keep`` of them.

    ``published`` is the run number of the last summary, ``tables`` those of the job whose
    output root this is: the two jobs have roots of their own.
    """
    root = out_root.rstrip("/")
    older = [n for n in _numbered(spark, root, "run") if n < published]
    gone = older[: max(len(older) - keep, 0)]
    for n in gone:
        for name in tables:
            spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}_run{n}`")
        path, fs = _hadoop_fs(spark, f"{root}/run={n}")
        fs.delete(path, True)
    return gone
