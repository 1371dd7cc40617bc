"""row_number() per group that never sends one whole group to one task.

``Window.partitionBy(g).orderBy(o)`` hashes every row of a group to one task; a
customer holding a third of the data would then be sorted by one core. Here the
rows are range-partitioned on (group, order) instead, so a hot group is cut into
many contiguous slices of the sort order, one per range partition. Each slice is
numbered while it is written, and each slice's offset is the number of rows of
its group in earlier slices, summed over a small (group, slice) table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidemark.session import materialize, shuffle_partitions


def _key(group_cols: Sequence[str]) -> Column:
    # One struct key: struct equality treats null fields as equal, so rows with a
    # null group column stay in one group and the join below stays a plain
    # equi-join on one column.
    return F.struct(*[F.col(c) for c in group_cols])


def row_number_skew_safe(
    df: DataFrame,
    group_cols: Sequence[str],
    order: Sequence[Column],
    name: str = "row_number",
    num_slices: int | None = None,
) -> DataFrame:
    """Add ``name`` = row_number() over (partition by group_cols order by order).

    Rows are range-partitioned on (group, order) into ``num_slices`` slices and
    sorted inside each slice; every row records its slice and its position in the
    slice. Then rank = position - (first position of the group in the slice) + 1
    + (rows of the group in earlier slices), where the last two come from a
    (group, slice) table with at most (groups + slices) rows. That table is joined
    back by adaptive execution: broadcast when it is small (few, hot groups), so
    the rows are shuffled once; otherwise a sort-merge join.

    ``order`` should be a total order within a group (add a unique tie-breaker),
    as for any repeatable row_number.
    """
    return number_slices(rank_slices(df, group_cols, order, num_slices), group_cols, name)


SLICE_COLUMNS = ("_rk_slice", "_rk_pos")


def rank_slices(
    df: DataFrame, group_cols: Sequence[str], order: Sequence[Column], num_slices: int | None = None
) -> DataFrame:
    """``df`` in its slices, written once, with every row's slice and position (``SLICE_COLUMNS``)."""
    n = num_slices or shuffle_partitions(df.sparkSession)
    key = _key(group_cols)
    # The range partitioner samples with a seed taken from its RDD id, so two plan
    # branches would cut different slices. Write the sliced rows once (slice and
    # position as columns) to a table in the shared checkpoint folder, which also
    # cuts the lineage, and let both branches read that table.
    return materialize(
        df.repartitionByRange(n, key, *order)
        .sortWithinPartitions(key, *order)
        .withColumns({"_rk_slice": F.spark_partition_id(), "_rk_pos": F.monotonically_increasing_id()}),
        "rank-slices",
    )


def number_slices(slices: DataFrame, group_cols: Sequence[str], name: str = "row_number") -> DataFrame:
    """The rows of ``rank_slices`` with their rank in place of slice and position."""
    ranged = slices.withColumn("_rk_grp", _key(group_cols))
    before = Window.partitionBy("_rk_grp").orderBy("_rk_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        ranged.groupBy("_rk_grp", "_rk_slice")
        .agg(F.min("_rk_pos").alias("_rk_start"), F.count(F.lit(1)).alias("_rk_n"))
        .withColumn("_rk_before", F.coalesce(F.sum("_rk_n").over(before), F.lit(0)))
        .drop("_rk_n")
    )
    rank = F.col("_rk_pos") - F.col("_rk_start") + 1 + F.col("_rk_before")
    return (
        ranged.join(offsets, ["_rk_grp", "_rk_slice"])
        .withColumn(name, rank.cast("int"))
        .drop("_rk_grp", *SLICE_COLUMNS, "_rk_start", "_rk_before")
    )


def row_number_window(
    df: DataFrame, group_cols: Sequence[str], order: Sequence[Column], name: str = "row_number"
) -> DataFrame:
    """The plain window form, for data whose largest group is known to be small."""
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w))


def hot_keys_from_sizes(
    sizes: DataFrame, key_cols: Sequence[str], max_rows: int, size_col: str = "_n"
) -> DataFrame | None:
    """The keys whose group has more than ``max_rows`` rows, from a (keys, size)
    table; None when there are none.

    However many they are, they are written to the checkpoint folder and returned
    without a hint: the joins against them broadcast by measured size or not at all.
    """
    seen = Observation("hot_keys")  # counted by the write itself: no job to look for a row
    keys = sizes.filter(F.col(size_col) > max_rows).select(*key_cols)
    hot = materialize(keys.observe(seen, F.count(F.lit(1)).alias("n")), "hot-keys")
    return hot if seen.get["n"] else None


def split_by_keys(df: DataFrame, key_cols: Sequence[str], keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is not in ``keys``, rows whose key is); keys compare null-safe."""
    cond = None
    for c in key_cols:
        term = df[c].eqNullSafe(keys[c])
        cond = term if cond is None else cond & term
    return df.join(keys, cond, "left_anti"), df.join(keys, cond, "left_semi")


def split_hot(
    df: DataFrame, key_cols: Sequence[str], max_rows: int, sizes: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """Split rows into (light, hot): hot rows belong to groups with more than
    ``max_rows`` rows. ``hot`` is None when there is no such group.

    The group sizes are a partial aggregate over the key columns only, unless the
    caller already has them (``sizes``: keys plus a ``_n`` row count).
    """
    if sizes is None:
        sizes = df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("_n"))
    keys = hot_keys_from_sizes(sizes, key_cols, max_rows)
    if keys is None:
        return df, None
    return split_by_keys(df, key_cols, keys)
