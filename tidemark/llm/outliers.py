"""Quality rules: plain text rules, and robust multivariate outliers of text statistics.

Everything runs as DataFrame expressions. Each document's counts give a vector of four
transformed statistics. For every language and source a minimum-covariance-determinant
estimate is found by concentration steps: from medians and quartiles on, the three quarters
of the rows with the smallest Mahalanobis distances give the next mean and covariance. A
last step reweights: the rows within the usual range give the estimate that is used. A
document beyond the cutoff distance of its group is rejected.

A step is one grouped aggregation by group and distance bin, whose counts, sums and products
are of integers: results don't depend on the order of rows, and a hot group is summed up
before the shuffle like any other. A variance below its floor is raised to it, so a statistic
that is constant in a group can't make every other value an outlier; others stay as they are.

Defined cases: a null or empty text has no words and fails the base rules; null languages and
sources are groups of their own; documents that fail the base rules don't shape the
estimates; groups of few documents take the estimate of all their language's documents, those
of its large groups too; repeated rows count.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, read_table

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Rows below which a group takes the estimate of its whole language.
LEAST_ROWS = 200
#: Statistics are rounded to this part of one.
SCALE = 1000
STATS = ("word_length", "symbols", "dup_lines", "repeats")
#: Part of a floor's square that every variance gets on top: covariances stay invertible.
RIDGE = 0.001
#: Share of rows that a step keeps, and steps.
KEEP, STEPS = 0.75, 4
# For 4 variables, chi-square quantiles at 0.975 (reweighting) and at
# 1 - 1e-8 (rejection), and what makes the kept rows' covariance consistent at KEEP.
USUAL, CUTOFF, CONSISTENT = 11.14, 43.0, 1.48
#: What rejects a document alone, in a group that has no spread of its own: words so many times
#: as long as usual, symbols a word, the share of repeated lines, the share of repeated words.
#: They set the floors of the standard deviations.
ALONE = (1.7, 0.2, 0.8, 0.47)
FLOORS = tuple(x / math.sqrt(CUTOFF) for x in (math.log(ALONE[0]), math.asinh(50 * ALONE[1]), math.asinh(10 * ALONE[2]), math.asinh(10 * ALONE[3])))
BINS = 16

BLANKS = " \t\n\x0b\f\r"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _repeated(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more, each word once.

    Windows are compared by 64-bit hash. Texts without a repeated window need no more
    than the distinct hashes; in the others equal hashes become neighbours by sorting.
    """

    def covered(at: Column) -> Column:
        step = F.transform(at, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - x, F.lit(3))))
        return F.aggregate(step, F.lit(0), lambda a, x: a + x)

    def places(s: Column) -> Column:
        twin = lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))
        return _let(F.array_sort(F.transform(F.filter(s, twin), lambda x: x["i"])), covered)

    def compare(h: Column) -> Column:
        slow = _let(F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), places)
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(slow)

    hashes = F.transform(F.slice(words, 1, F.size(words) - 2), lambda x, i: F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(_let(hashes, compare))


def counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of every row's whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    count = lambda chars: F.length(text) - F.length(F.translate(text, chars, ""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    of_words = _let(words, lambda w: F.struct(F.size(w).alias("n"), _repeated(w).alias("r")))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(BLANKS))) > 0)
    of_lines = _let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("d")))
    rows = docs.select(
        "doc_id", "lang", "source", of_words.alias("w"), of_lines.alias("l"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"), count("#*$%&|<>").cast("long").alias("n_symbols"),
    )
    out = rows.select(
        "doc_id", "lang", "source", F.col("w.n").cast("long").alias("n_words"), "word_chars", "n_symbols",
        F.col("l.d").cast("long").alias("n_dup_lines"), F.col("w.r").cast("long").alias("n_repeat_words"), F.col("l.n").cast("long").alias("n_lines"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def vectors(counted: DataFrame) -> DataFrame:
    """``counted`` with its group (key, its language's shared key) and the four statistics as integers x0..x3."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    values = (
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        F.asinh(50.0 * F.col("n_symbols") / n),
        F.asinh(10.0 * F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        F.asinh(10.0 * F.col("n_repeat_words") / n),
    )
    key = lambda *cols: F.xxhash64(*(x for c in cols for x in (F.col(c).isNull(), F.col(c))))
    x = {f"x{j}": F.round(v * SCALE).cast("long") for j, v in enumerate(values)}
    return counted.withColumns({**x, "own": key("lang", "source"), "shared": key("lang")})


def _start(rows: DataFrame) -> DataFrame:
    """(key, m0..m3, s00..s33): medians, and squared interquartile ranges on the diagonal. Binned to 0.02."""
    width = SCALE // 50
    long = rows.select("key", F.posexplode(F.array(*(F.floor(F.col(f"x{j}") / width) for j in range(4)))).alias("stat", "bin"))
    hist = long.groupBy("key", "stat", "bin").agg(F.count(F.lit(1)).alias("n"))
    by = Window.partitionBy("key", "stat")
    hist = hist.withColumn("upto", F.sum("n").over(by.orderBy("bin"))).withColumn("all", F.sum("n").over(by))
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("all"), (F.col("bin") + 0.5) * width))
    q = hist.groupBy("key", "stat").agg(at(0.5).alias("m"), ((at(0.75) - at(0.25)) / 1.349).alias("sd"))
    pick = lambda c, j: F.max(F.when(F.col("stat") == j, F.col(c)))
    q = q.groupBy("key").agg(*(pick("m", j).alias(f"m{j}") for j in range(4)), *(pick("sd", j).alias(f"d{j}") for j in range(4)))
    spread = [(F.col(f"d{j}") * F.col(f"d{j}") if i == j else F.lit(0.0)).alias(f"s{i}{j}") for i in range(4) for j in range(i + 1)]
    return q.select("key", *(f"m{j}" for j in range(4)), *spread)


def _factored(estimate: DataFrame, scale: float) -> DataFrame:
    """(key, m0..m3, l00..l33): the Cholesky factor of the scaled covariance, small variances raised to their floors."""
    out = estimate
    for i in range(4):
        for j in range(i + 1):
            a = F.col(f"s{i}{j}") * scale
            if i == j:
                floor = (FLOORS[i] * SCALE) ** 2
                a = F.greatest(a, F.lit(floor)) + RIDGE * floor
            for k in range(j):
                a = a - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            out = out.withColumn(f"l{i}{j}", F.sqrt(a) if i == j else a / F.col(f"l{j}{j}"))
    return out.select("key", *(f"m{j}" for j in range(4)), *(f"l{i}{j}" for i in range(4) for j in range(i + 1)))


def _distance(rows: DataFrame, factored: DataFrame) -> DataFrame:
    """``rows`` with the squared Mahalanobis distance d2, by forward substitution."""
    out = rows.join(factored, "key")
    for i in range(4):
        y = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(i):
            y = y - F.col(f"l{i}{k}") * F.col(f"y{k}")
        out = out.withColumn(f"y{i}", y / F.col(f"l{i}{i}"))
    d2 = sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(1, 4)), F.col("y0") * F.col("y0"))
    return out.withColumn("d2", d2).drop(*factored.columns[1:], *(f"y{i}" for i in range(4)))


def _moments(rows: DataFrame, factored: DataFrame, usual: float | None) -> DataFrame:
    """Means and covariances of each group's nearest rows: the KEEP share, or those within ``usual``."""
    binned = _distance(rows, factored).withColumn("bin", F.floor(F.log2(F.col("d2") + 1) * BINS))
    sums = [F.sum(f"x{i}").alias(f"t{i}") for i in range(4)]
    products = [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}{j}") for i in range(4) for j in range(i + 1)]
    bins = binned.groupBy("key", "bin").agg(F.count(F.lit(1)).alias("n"), *sums, *products)
    by = Window.partitionBy("key")
    before = F.coalesce(F.sum("n").over(by.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    if usual is None:
        near = F.col("before") < KEEP * F.col("all")
    else:  # the nearest bin counts in any case
        near = (F.col("bin") <= F.floor(F.log2(F.lit(usual + 1.0)) * BINS)) | (F.col("before") == 0)
    kept = bins.withColumn("before", before).withColumn("all", F.sum("n").over(by)).where(near)
    names = [c for c in bins.columns if c[0] in "tp"]
    total = kept.groupBy("key").agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in names))
    means = [(F.col(f"t{i}") / F.col("n")).alias(f"m{i}") for i in range(4)]
    spread = [
        F.greatest(F.lit(0.0), F.col(f"p{i}{j}") / F.col("n") - F.col(f"t{i}") / F.col("n") * F.col(f"t{j}") / F.col("n")).alias(f"s{i}{j}")
        if i == j
        else (F.col(f"p{i}{j}") / F.col("n") - F.col(f"t{i}") / F.col("n") * F.col(f"t{j}") / F.col("n")).alias(f"s{i}{j}")
        for i in range(4)
        for j in range(i + 1)
    ]
    return total.select("key", *means, *spread)


def estimates(rows: DataFrame) -> DataFrame:
    """(key, m0..m3, l00..l33) of every group of ``rows`` (key, x0..x3)."""
    now = _factored(materialize(_start(rows).coalesce(4), "mcd"), 1.0)
    for _ in range(STEPS):
        now = _factored(materialize(_moments(rows, now, None).coalesce(4), "mcd"), CONSISTENT)
    return _factored(materialize(_moments(rows, now, USUAL).coalesce(4), "mcd"), 1.0)


def judge(docs: DataFrame) -> DataFrame:
    """The counts of every row, d2 (null where no estimate applies) and kept."""
    rows = vectors(materialize(counts(docs), "quality-counts"))
    sizes = rows.where(~F.col("base_failed")).groupBy("own").agg(F.count(F.lit(1)).alias("n"))
    large = materialize(sizes.where(F.col("n") >= LEAST_ROWS).select("own", F.lit(True).alias("large")).coalesce(4), "mcd-groups")
    keyed = rows.join(large, "own", "left").withColumn("key", F.when(F.col("large"), F.col("own")).otherwise(F.col("shared")))
    shaping = keyed.where(~F.col("base_failed"))
    # A language's estimate is made of all its rows, where any group of it needs one.
    needed = shaping.where(F.col("large").isNull()).select("shared").distinct()
    every = shaping.join(needed, "shared", "left_semi").select(F.col("shared").alias("key"), "x0", "x1", "x2", "x3")
    found = estimates(shaping.where("large").select("key", "x0", "x1", "x2", "x3").unionAll(every))
    tested = _distance(keyed.where(~F.col("base_failed")), found).withColumn("kept", F.col("d2") <= CUTOFF)
    failed = keyed.where("base_failed").withColumn("d2", F.lit(None).cast("double")).withColumn("kept", F.lit(False))
    return tested.select(*failed.columns).unionByName(failed)


def op10_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = judge(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "d2")
