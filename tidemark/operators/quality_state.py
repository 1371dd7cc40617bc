"""Quality metrics that add up (I1, I2, I6): a small state per partition, merged at will, and
the drift between two of them (I6, I8).

A state row holds a column's counts, bounds and two sketches: HyperLogLog for distinct
values, KLL for quantiles. States of partitions, drops or days merge into the state of their
union, so a table's quality is known without its old rows being read again, and a partition
that is written anew replaces its own state only.

Bounds: counts, smallest and largest values are exact. Distinct counts have a standard error
of 1.04 / sqrt(2 ** ``LOG_K``) = 1.6 %; ranks of quantiles are within ``RANK_ERROR`` (99 %).

Null values count as nulls. Numbers that are NaN or infinite count as ``broken`` and stay out
of bounds and sketches. A column without a value has null bounds and quantiles and 0 distinct.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_K = 12
KLL_K = 800
RANK_ERROR = 0.005
GRID = 200  # quantiles that stand for a distribution when two are compared: to half a percent
SMALLEST_SHARE = 1e-4  # an empty bin's share in the stability index

COUNTS = ("n_rows", "n_nulls", "n_broken")


def _number(field: T.StructField) -> Column | None:
    """The value as a double; days since 1970 for dates, None for columns without an order of size."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.NumericType):
        return c.cast("double")
    if isinstance(field.dataType, T.DateType):
        return F.unix_date(c).cast("double")
    return None


def quality_state(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per group of ``by`` and column: (by..., column_name, counts, low, high, distinct_sketch, quantile_sketch).

    One aggregate over one scan, combined map-side, so a partition that holds a third of
    all rows sends one row per task.
    """
    fields = {f.name: f for f in df.schema}
    aggs, entries = [], []
    for i, name in enumerate(columns):
        c, number = F.col(f"`{name}`"), _number(fields[name])
        if number is None:
            broken, value = F.lit(False), F.lit(None).cast("double")
        else:
            broken = F.isnan(number) | (F.abs(number) == F.lit(float("inf")))
            value = F.when(~broken, number)
        text = F.when(~broken, c.cast("string"))
        aggs += [
            F.count(F.lit(1)).alias(f"_r{i}"),
            F.count_if(c.isNull()).alias(f"_n{i}"),
            F.count_if(broken).alias(f"_b{i}"),
            F.min(value).alias(f"_l{i}"),
            F.max(value).alias(f"_h{i}"),
            F.hll_sketch_agg(text, F.lit(LOG_K)).alias(f"_d{i}"),
            F.kll_sketch_agg_double(value, F.lit(KLL_K)).alias(f"_q{i}"),
        ]
        parts = zip("rnblhdq", (*COUNTS, "low", "high", "distinct_sketch", "quantile_sketch"), strict=True)
        entries.append(F.struct(F.lit(name).alias("column_name"), *(F.col(f"_{p}{i}").alias(a) for p, a in parts)))
    keys = [F.col(f"`{k}`") for k in by]
    return df.groupBy(*keys).agg(*aggs).select(*keys, F.inline(F.array(*entries)))


def merge_states(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """States of parts → the state of their union, per group of ``by``."""
    return states.groupBy(*by, "column_name").agg(
        *(F.sum(c).alias(c) for c in COUNTS),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch", F.lit(KLL_K)).alias("quantile_sketch"),
    )


def _quantiles(points: Sequence[float]) -> Column:
    """Estimated quantiles; null where the sketch saw no number."""
    asked = F.array(*(F.lit(float(p)) for p in points))
    return F.when(F.col("low").isNotNull(), F.kll_sketch_get_quantile_double("quantile_sketch", asked))


def summarize(states: DataFrame, points: Sequence[float] = (0.05, 0.25, 0.5, 0.75, 0.95)) -> DataFrame:
    """Readable form of states: counts, null share, distinct estimate, bounds, quantiles at ``points``."""
    kept = [c for c in states.columns if not c.endswith("_sketch")]
    return states.select(
        *kept,
        F.try_divide(F.col("n_nulls").cast("double"), F.col("n_rows").cast("double")).alias("null_share"),
        F.hll_sketch_estimate("distinct_sketch").alias("distinct"),
        _quantiles(points).alias("quantiles"),
    )


# ------------------------------------------------------------------------------- store


def save_states(states: DataFrame, store: str, part: str) -> None:
    """Write one part's states; the same part written again replaces them."""
    out = states.withColumn("part", F.lit(part)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.partitionBy("part").parquet(store)


def load_states(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "false").parquet(store).withColumn("part", F.col("part").cast("string"))


# ------------------------------------------------------------------------------- drift


@dataclass(frozen=True)
class DriftRule:
    """What may change between two states. ``kind``:

    * ``psi``: population stability index over tenths of the older distribution;
    * ``ks``: largest distance between the two cumulative distributions;
    * ``null_share``: absolute change of the share of nulls;
    * ``distinct``: relative change of the number of distinct values.
    """

    column: str
    kind: str
    limit: float


def _share_up_to(grid: str, x: Column) -> Column:
    """Share of a distribution's quantiles that are at most ``x``."""
    return F.size(F.filter(F.col(grid), lambda g: g <= x)).cast("double") / F.lit(float(GRID))


def _psi() -> Column:
    tenths = F.array_sort(F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(9)), lambda i: F.element_at("old_grid", i * (GRID // 10)))))

    def shares(grid: str) -> Column:
        upto = F.concat(F.array(F.lit(0.0)), F.transform(tenths, lambda x: _share_up_to(grid, x)), F.array(F.lit(1.0)))
        steps = F.zip_with(F.slice(upto, F.lit(2), F.size(upto) - 1), F.slice(upto, F.lit(1), F.size(upto) - 1), lambda b, a: b - a)
        return F.transform(steps, lambda s: F.greatest(s, F.lit(SMALLEST_SHARE)))

    terms = F.zip_with(shares("new_grid"), shares("old_grid"), lambda n, o: (n - o) * F.ln(n / o))
    return F.aggregate(terms, F.lit(0.0), lambda total, t: total + t)


def _ks() -> Column:
    points = F.array_distinct(F.concat("old_grid", "new_grid"))
    gaps = F.transform(points, lambda x: F.abs(_share_up_to("new_grid", x) - _share_up_to("old_grid", x)))
    return F.array_max(gaps)


def drift(old: DataFrame, new: DataFrame, rules: Sequence[DriftRule]) -> DataFrame:
    """One row per rule: (column_name, kind, value, limit, passed), from two merged states.

    A column that has numbers in one state only has an infinite distance; with none in
    either it has 0. A rule on a column that either state lacks has a null value and fails.
    """
    grid = [(i - 0.5) / GRID for i in range(1, GRID + 1)]

    def side(states: DataFrame, name: str) -> DataFrame:
        return summarize(states, grid).select(
            "column_name",
            F.col("quantiles").alias(f"{name}_grid"),
            F.col("null_share").alias(f"{name}_null"),
            F.col("distinct").cast("double").alias(f"{name}_distinct"),
        )

    def compared(value: Column) -> Column:
        no_old, no_new = F.col("old_grid").isNull(), F.col("new_grid").isNull()
        return F.when(no_old & no_new, F.lit(0.0)).when(no_old | no_new, F.lit(float("inf"))).otherwise(value)

    grown = F.abs(F.col("new_distinct") - F.col("old_distinct"))
    values = {
        "psi": compared(_psi()),
        "ks": compared(_ks()),
        "null_share": F.abs(F.coalesce("new_null", F.lit(0.0)) - F.coalesce("old_null", F.lit(0.0))),
        "distinct": F.when(grown == 0, F.lit(0.0)).when(F.col("old_distinct") == 0, F.lit(float("inf"))).otherwise(
            F.try_divide(grown, F.col("old_distinct"))
        ),
    }
    unknown = sorted({r.kind for r in rules} - set(values))
    if unknown:
        raise ValueError(f"unknown kinds of drift rules: {', '.join(unknown)}")
    both = side(old, "old").join(side(new, "new"), "column_name")
    stacked = both.select("column_name", F.inline(F.array(*(F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in values.items()))))
    # The rules are a short list given by the caller.
    asked = old.sparkSession.createDataFrame([(r.column, r.kind, float(r.limit)) for r in rules], "column_name string, kind string, limit double")
    out = asked.join(stacked, ["column_name", "kind"], "left")
    passed = F.coalesce(F.col("value") <= F.col("limit"), F.lit(False))
    return out.select("column_name", "kind", "value", "limit", passed.alias("passed"))
