"""Helpers that several operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpoint_root, materialize

__all__ = ["checkpoint_root", "checked_broadcast", "held_out", "labelled_sample", "materialize", "read_table"]

#: Labelled rows per class a model is fitted on at most (documented bound).
MAX_PER_CLASS = 10_000
#: One row in FOLDS is held out from every fit.
FOLDS = 5


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the fold no model learns from: crc32 of the id's text, mod 5, is 0. Null ids: false."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def checked_broadcast(df: DataFrame, rows: int, bound: int) -> DataFrame:
    """``df`` with a broadcast hint where ``rows`` (its counted or limited size) is within ``bound``."""
    return F.broadcast(df) if rows <= bound else df


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int = MAX_PER_CLASS) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, text, label) of the training fold, and the number of labelled ids by class.

    At most ``per_class`` ids of each class, picked by hash: the same ids whatever
    the partitioning. Null labels and ids are left out; an id labelled twice takes
    the larger label, a document stored twice its smallest text.
    """
    one = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
    )
    sizes = {r["label"]: r["count"] for r in one.groupBy("label").count().collect()}
    order = F.xxhash64("doc_id", F.lit(17))
    picked = None
    for value in (0, 1):
        part = one.where(F.col("label") == value).orderBy(order, "doc_id").limit(per_class)
        picked = part if picked is None else picked.union(part)
    rows = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(checked_broadcast(picked, 2 * per_class, 100_000), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
    )
    return rows, sizes
