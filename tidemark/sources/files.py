"""Raw file sources (A1-A5): typed CSV / JSON reads, batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.constants import CUSTOMERS_PREFIX, SALES_PREFIX
from tidemark.schemas import RAW_CUSTOMERS, RAW_SALES

CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "sep": ",",
    "recursiveFileLookup": "true",
    # Check each file's header against the schema that is read, so a file with another
    # layout fails instead of loading silently wrong.
    "enforceSchema": "false",
    # Malformed values become null instead of failing the read; the quality
    # metrics and reject rows then account for them.
    "mode": "PERMISSIVE",
}


def raw_path(bucket_uri: str, prefix: str) -> str:
    """A3: '<root>/customers/' or '<root>/sales/' from a run parameter."""
    return f"{bucket_uri.rstrip('/')}/{prefix}"


CORRUPT_COLUMN = "_corrupt_record"
# A reader that parses only the needed columns doesn't notice a line that is malformed
# elsewhere: whether it does must not depend on the query.
CORRUPT_OPTIONS = {"columnNameOfCorruptRecord": CORRUPT_COLUMN, "columnPruning": "false"}


def with_corrupt_column(schema: T.StructType, name: str = CORRUPT_COLUMN) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(name, T.StringType())])


def layout(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> T.StructType:
    """The columns of the CSV files under ``path`` in the order of their header (the first
    file's), with the declared types; columns that aren't declared are text."""
    header = spark.read.options(**{**CSV_OPTIONS, **options}).csv(path).columns
    declared = {f.name: f for f in schema.fields}
    return T.StructType([declared.get(c, T.StructField(c, T.StringType())) for c in header])


def read_raw(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "csv",
    keep_corrupt: bool = False,
    **options: str,
) -> DataFrame:
    """Typed batch read of raw files under ``path`` (all subfolders).

    CSV columns are found by their header name: their order is free, further columns
    are left out and missing ones are null. All files of one read must have the same
    header; one that differs fails the read.

    With ``keep_corrupt`` a line whose values do not parse as the declared types
    keeps its raw text in ``_corrupt_record`` (its typed fields are null), so the
    job can quarantine it instead of silently treating the value as missing.
    """
    found = layout(spark, path, schema, **options) if fmt == "csv" else schema
    if keep_corrupt:
        schema, found = with_corrupt_column(schema), with_corrupt_column(found)
        options = {**CORRUPT_OPTIONS, **options}
    reader = spark.read.schema(found)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
    elif fmt == "json":
        reader = reader.option("recursiveFileLookup", "true").option("mode", "PERMISSIVE")
    else:
        raise ValueError(f"unsupported raw format {fmt!r}")
    rows = reader.options(**options).format(fmt).load(path)
    return rows.select(
        *(F.col(f.name) if f.name in found.names else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields)
    )


def read_customers(spark: SparkSession, root: str, fmt: str = "csv", keep_corrupt: bool = False) -> DataFrame:
    """A1: raw customers under ``<root>/customers/``."""
    return read_raw(spark, raw_path(root, CUSTOMERS_PREFIX), RAW_CUSTOMERS, fmt, keep_corrupt)


def read_sales(spark: SparkSession, root: str, fmt: str = "csv", keep_corrupt: bool = False) -> DataFrame:
    """A2: raw sales under ``<root>/sales/``."""
    return read_raw(spark, raw_path(root, SALES_PREFIX), RAW_SALES, fmt, keep_corrupt)


def stream_raw(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "csv",
    max_files: int | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """A4: a typed read as a file stream: each trigger sees only new files.

    A stream's schema is fixed when it starts, so CSV files must have the declared
    columns in their declared order; a file with another header fails the batch.
    """
    if keep_corrupt:
        schema = with_corrupt_column(schema)
    reader = spark.readStream.schema(schema)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
    if keep_corrupt:
        reader = reader.options(**CORRUPT_OPTIONS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.format(fmt).load(path)


def read_processed(spark: SparkSession, path: str, merge_schema: bool = True) -> DataFrame:
    """Processed Parquet whose files may come from runs with different column sets
    (A11 on the processed side): the union of the columns, missing ones null."""
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)
