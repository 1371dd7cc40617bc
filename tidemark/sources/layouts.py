"""CSV files with different headers, read together.

Spark takes one header for all files of a read. Here the files are grouped by their header
line; each group is one typed read, and columns are matched by name.
"""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.files import CSV_OPTIONS

FILE = "_file"


def literal_path(path: str) -> str:
    """A path as a reader must get it, which takes paths as patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def list_files(spark: SparkSession, path: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """(path, file, length, modified) of all files under ``path`` (or at the paths); no content is read.

    ``path`` is what a reader takes, ``file`` what rows read from it carry as their file.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return found.select(
        "path", F.col("_metadata.file_path").alias("file"), "length", F.col("modificationTime").alias("modified")
    )


@dataclass(frozen=True)
class Layout:
    """Files with one header: its column names, and the paths."""

    columns: tuple[str, ...]
    paths: tuple[str, ...]


def column_names(head: str) -> tuple[str, ...]:
    """The names of a header line: lower case, without blanks around; a missing or repeated one gets its place."""
    names: list[str] = []
    for i, cell in enumerate(next(csv.reader([head.removeprefix("﻿")]), [])):
        name = cell.strip().lower() or f"_c{i}"
        names.append(name if name not in names else f"{name}{i}")
    return tuple(names)


def layouts(spark: SparkSession, paths: dict[str, str]) -> list[Layout]:
    """The files (file → path) grouped by header, in the order of the header lines; empty files are left out.

    The header is a file's first line: the first of its first block. Only these lines, and
    the paths that the reads get anyway, reach the driver.
    """
    if not paths:
        return []
    lines = spark.read.text([literal_path(p) for p in sorted(paths.values())]).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )
    first = lines.where("block = 0").withColumn("i", F.monotonically_increasing_id())
    heads = first.groupBy("file").agg(F.min_by("value", "i").alias("head"))
    by_head = heads.groupBy("head").agg(F.collect_list("file").alias("files")).orderBy("head").collect()
    out: dict[tuple[str, ...], list[str]] = {}
    for r in by_head:
        out.setdefault(column_names(r.head), []).extend(paths[f] for f in r.files)
    return [Layout(names, tuple(sorted(of))) for names, of in out.items()]


def read_layout(spark: SparkSession, layout: Layout) -> DataFrame:
    """The rows of one layout as text, with the file each comes from."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in layout.columns])
    options = {**CSV_OPTIONS, "enforceSchema": "true"}  # the names are known; the header line is left out
    rows = spark.read.schema(schema).options(**options).csv([literal_path(p) for p in layout.paths])
    return rows.select(*(F.col(f"`{c}`") for c in layout.columns), F.col("_metadata.file_path").alias(FILE))


def read_mixed(spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*.csv") -> DataFrame:
    """Typed rows of all files under ``path``, whatever the order and choice of columns in each.

    Columns a file lacks are null, others are left out. A value that its column's type can't
    hold is null; rows that need a reason for it go through ``operators.contracts``.
    """
    return read_files(spark, {r.file: r.path for r in list_files(spark, path, pattern).collect()}, schema)


def read_files(spark: SparkSession, files: dict[str, str], schema: T.StructType) -> DataFrame:
    """``read_mixed`` for given files (file → path, as ``list_files`` gives them)."""
    wanted = {f.name.lower(): f for f in schema.fields}
    out = None
    for layout in layouts(spark, files):
        rows = read_layout(spark, layout)
        part = rows.select(
            *(
                (F.col(f"`{name}`").try_cast(f.dataType) if name in layout.columns else F.lit(None).cast(f.dataType)).alias(f.name)
                for name, f in wanted.items()
            )
        )
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)
