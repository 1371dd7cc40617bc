"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in hash-shuffled order, repeated as often as the
targets allow. A copy's virtual finish time is the source's words up to its end, divided by
the source's target. Sorted by it, the queues advance together in proportion to their
targets, and the sort is cut where the words served reach the total budget. The budget is
the targets' sum, so the cut is at the time 1: every source has then been served its target,
and a copy in service is taken up to the word it has reached.

Running sums of a source never meet in one task: documents go to buckets by their hash,
bucket totals are summed along each source, and only within a bucket are rows ordered.

Defined cases: a null text has size 0; a source with no words has target 0 and is taken
whole, 0 words, at time 0; the null source is the last one; rows with the same id are
separate documents, ordered by size and text hash; an empty table has no targets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, read_table

WEIGHTS = (3.0, 1.0, 2.0)
#: The targets' sum as a share of all words, and a source's target as a share of its own.
SHARE, MOST = 1.5, 2.0
#: Rows of a source that are ordered together, about, and buckets of a source at least.
PER_BUCKET, LEAST_BUCKETS = 20_000, 256
SEED = 11


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _sized(docs: DataFrame, seed: int, *more: str) -> DataFrame:
    size = word_count(F.col("text"))
    h, tie = F.xxhash64("doc_id", F.lit(seed)), F.xxhash64(F.coalesce("text", F.lit("")))
    top = F.shiftrightunsigned(h, 33)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", size.alias("size"), top.alias("h33"), h.alias("h"), tie.alias("tie"), *more)


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, rows, source_size, target) from (source, rows, source_size).

    Sources take the weights in turn, by code point, null last. Targets are shares of
    ``share`` times all words by weight; one above ``most`` times its source's words
    stops there and the rest is dealt again. The level L at which the targets
    min(most * size, weight * L) add up to the budget lies after the sources of lowest
    size per weight have stopped, so it follows from running sums over that order.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    cycle = F.array(*map(F.lit, weights))
    w = sources.withColumn("weight", F.get(cycle, ((F.row_number().over(by_name) - 1) % len(weights)).cast("int")))
    w = w.withColumn("most", F.lit(float(most)) * F.col("source_size")).withColumn("full_at", F.col("most") / F.col("weight"))
    order = Window.orderBy("full_at", F.col("source").isNull(), F.col("source").cast("binary"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    ahead = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0.0))
    w = w.withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(every)).withColumn("pos", F.row_number().over(order))
    w = w.withColumn("level", (F.col("budget") - ahead("most")) / (F.sum("weight").over(every) - ahead("weight")))
    # The level is that of the first source that is not full at it; those before it are.
    w = w.withColumn("at", F.min(F.when(F.col("level") < F.col("full_at"), F.struct("pos", "level"))).over(every))
    full = F.col("at").isNull() | (F.col("pos") < F.col("at.pos"))
    target = F.when(full, F.col("most")).otherwise(F.col("weight") * F.col("at.level"))
    return w.select("source", "rows", "source_size", target.alias("target"))


ORDER = ("h33", "h", "doc_id", "size", "tie")


def queued(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """Every document with its queue's columns and ``before``, the words ahead of it in its source's shuffled order."""
    sized = materialize(_sized(docs, seed), "mix-sizes")
    sources = sized.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("source_size"))
    known = targets(sources, weights, share, most).withColumn("key", F.xxhash64(F.col("source").isNull(), "source"))
    known = materialize(known.withColumnRenamed("source", "queue"), "mix-targets")
    buckets = F.greatest(F.lit(LEAST_BUCKETS), F.ceil(F.col("rows") / PER_BUCKET)).cast("long")
    # Buckets are ranges of the hash's top 31 bits, which also lead the order within them.
    bucket = F.floor(F.col("h33").cast("double") / float(1 << 31) * buckets).cast("long")
    placed = sized.join(known, F.col("source").eqNullSafe(F.col("queue"))).drop("queue").withColumn("bucket", bucket)
    totals = placed.groupBy("key", "bucket").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("key", "bucket", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("offset"))
    order = Window.partitionBy("key", "bucket").orderBy(*ORDER)
    rows = placed.join(offsets, ["key", "bucket"]).withColumn("seq", F.row_number().over(order))
    here = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("before", F.col("offset") + here)


def schedule(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """Every copy of every document, globally sorted by virtual finish time.

    Adds epoch, finish and taken (the words served before the budget is spent) to the
    columns of ``queued``.
    """
    epochs = F.sequence(F.lit(0), F.lit(max(0, math.ceil(most) - 1)))
    copies = queued(docs, weights, share, most, seed).withColumn("epoch", F.explode(epochs))
    ahead = F.col("before") + F.col("epoch") * F.col("source_size")
    finish = F.when(F.col("target") > 0, (ahead + F.col("size")) / F.col("target")).otherwise(F.lit(0.0))
    # Sizes are whole words: up to the time 1 a source is served floor(target) of them.
    taken = F.least(F.col("size"), F.greatest(F.lit(0), F.floor("target").cast("long") - ahead))
    return copies.withColumn("finish", finish).withColumn("taken", taken).orderBy("finish", "key", "epoch", "bucket", "seq")


def taken_words(docs: DataFrame, **how) -> DataFrame:
    """doc_id, size, source_size, target, taken (its copies together), finish (of the first copy); sorted by it."""
    same = ["key", "bucket", "seq", "doc_id", "size", "source_size", "target"]
    per_doc = schedule(docs, **how).groupBy(*same).agg(F.sum("taken").alias("taken"), F.min("finish").alias("finish"))
    return per_doc.orderBy("finish", "key", "seq").select("doc_id", "size", "source_size", "target", "taken", "finish")


def mix(docs: DataFrame, seed: int = SEED, **how) -> DataFrame:
    """``docs`` with each row as often as the mix takes it; a copy in service at the end is kept whole.

    A copy is taken if it stands in its source's order up to the last one served, which
    a table of one row for each source and epoch tells: no text is shuffled. An epoch that
    is served in full takes all documents, those without words too; a source without
    words is taken once.
    """
    whole = F.when(F.col("source_size") == 0, F.col("epoch") == 0).otherwise((F.col("epoch") + 1) * F.col("source_size") <= F.floor("target"))
    plan = schedule(docs, seed=seed, **how).where((F.col("taken") > 0) | whole)
    last = plan.groupBy("source", "epoch").agg(F.max(F.struct(*ORDER)).alias("last"))
    cuts = materialize(last.groupBy("source").agg(F.collect_list("last").alias("lasts")).select(F.col("source").alias("queue"), "lasts"), "mix-cuts")
    own = _sized(docs.withColumn("_row", F.struct(*docs.columns)), seed, "_row")
    place = F.struct(*ORDER)
    chosen = own.join(cuts, F.col("source").eqNullSafe(F.col("queue"))).withColumn("copies", F.filter("lasts", lambda c: place <= c))
    return chosen.select("_row", F.explode("copies")).select("_row.*")


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(read_table(spark, sf_dir, "documents"))
