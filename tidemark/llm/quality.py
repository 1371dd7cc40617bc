"""Quality classifier: histogram gradient-boosted trees over document statistics.

Executors turn each whole text into a vector of statistics. The trees are fitted on a
bounded labelled sample: values are put into quantile bins once, every level's splits come
from gradient histograms by node, feature and bin. The fitted trees are flattened into
arrays of features, thresholds and leaf values in heap order, so a batch of documents walks
all trees by numpy indexing.

Defined cases: a null text is empty; an empty text has all statistics 0 and is scored like
any other; without labels of both classes the score is the share of label 1, or 0.5.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import MAX_PER_CLASS, held_out, labelled_sample, read_table

THRESHOLD = 0.3
TREES, DEPTH, BINS, RATE, LEAST_WEIGHT, RIDGE = 60, 4, 48, 0.15, 5.0, 1.0

STATISTICS = (
    "words", "word_length", "longest_word", "distinct_words", "distinct_triples", "same_as_before",
    "lines", "distinct_lines", "upper", "digits", "symbols", "bars", "exclamations", "full_stops",
    "commas", "other_marks", "not_ascii", "blanks", "top_byte",
)


def _bytes(chars: str) -> np.ndarray:
    return np.array([ord(c) for c in chars])


UPPER, DIGITS = np.arange(65, 91), np.arange(48, 58)
SYMBOLS, MARKS = _bytes("#*$%&<>@^~_=+\\{}[]/"), _bytes("\"'():;?-`")
BLANKS = _bytes(" \t\n\x0b\f\r")


def statistics(text: bytes) -> list[float]:
    """The values of STATISTICS of a UTF-8 text."""
    size = max(1, len(text))
    seen = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    words = text.split()
    n = max(1, len(words))
    lines = [x for x in text.split(b"\n") if x.strip()]
    triples = max(1, len(words) - 2)
    share = lambda codes: float(seen[codes].sum()) / size
    return [
        math.log1p(len(words)),
        sum(map(len, words)) / n,
        float(max(map(len, words), default=0)),
        len(set(words)) / n,
        len(set(zip(words, words[1:], words[2:], strict=False))) / triples if len(words) > 2 else 1.0,
        sum(map(eq, words, words[1:])) / n,
        math.log1p(len(lines)),
        len(set(lines)) / max(1, len(lines)),
        share(UPPER),
        share(DIGITS),
        share(SYMBOLS),
        share(124),
        share(33),
        share(46),
        share(44),
        share(MARKS),
        float(seen[128:].sum()) / size,
        share(BLANKS),
        float(np.delete(seen, BLANKS).max()) / size,
    ]


@dataclass
class Trees:
    """Flat trees in heap order: node i has the children 2 i + 1 and 2 i + 2; leaves follow the inner nodes."""

    base: float = 0.0
    feature: np.ndarray = field(default_factory=lambda: np.zeros((0, 2**DEPTH - 1), dtype=np.int32))
    threshold: np.ndarray = field(default_factory=lambda: np.zeros((0, 2**DEPTH - 1)))
    leaf: np.ndarray = field(default_factory=lambda: np.zeros((0, 2**DEPTH)))

    def scores(self, x: np.ndarray) -> np.ndarray:
        inner = self.feature.shape[1]
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            while inner and at.size and at[0] < inner:  # all rows are on the same level
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            total += leaf[at - inner]
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> Trees:
    """Fit the trees by logistic loss on weighted rows."""
    share = float(np.average(y, weights=w)) if len(y) else 0.5
    if not len(y) or not 0 < share < 1:
        return Trees(base=math.log((share + 1e-3) / (1 - share + 1e-3)))
    n, f = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(f)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    inner = 2**DEPTH - 1
    base = math.log(share / (1 - share))
    margin = np.full(n, base)
    feature = np.zeros((TREES, inner), dtype=np.int32)
    threshold = np.full((TREES, inner), np.inf)  # no split: all rows go left
    leaf = np.zeros((TREES, inner + 1))
    for t in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)
        at = np.zeros(n, dtype=np.int64)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            here = at - first
            best_gain, best = np.full(width, 1e-6), [None] * width
            for j in range(f):
                cell = here * BINS + binned[:, j]
                left_g = np.bincount(cell, g, width * BINS).reshape(width, BINS).cumsum(axis=1)
                left_h = np.bincount(cell, h, width * BINS).reshape(width, BINS).cumsum(axis=1)
                all_g, all_h = left_g[:, -1:], left_h[:, -1:]
                right_g, right_h = all_g - left_g, all_h - left_h
                gain = left_g**2 / (left_h + RIDGE) + right_g**2 / (right_h + RIDGE) - all_g**2 / (all_h + RIDGE)
                gain[(left_h < LEAST_WEIGHT * 0.05) | (right_h < LEAST_WEIGHT * 0.05)] = 0
                gain[:, len(edges[j]) :] = 0
                cut = gain.argmax(axis=1)
                for k in np.flatnonzero(gain[np.arange(width), cut] > best_gain):
                    best_gain[k], best[k] = gain[k, cut[k]], (j, cut[k])
            for k, split in enumerate(best):
                if split:
                    feature[t, first + k], threshold[t, first + k] = split[0], edges[split[0]][split[1]]
            at = 2 * at + 1 + (x[np.arange(n), feature[t, at]] > threshold[t, at])
        ends = at - inner
        leaf[t] = -RATE * np.bincount(ends, g, inner + 1) / (np.bincount(ends, h, inner + 1) + RIDGE)
        margin += leaf[t][ends]
    return Trees(base, feature, threshold, leaf)


def _matrix(texts: list[bytes]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], dtype=np.float64).reshape(len(texts), len(STATISTICS))


def _sample_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "x": list(_matrix([t.encode() for t in batch["text"]]))})


def fit(docs: DataFrame, labels: DataFrame, per_class: int = MAX_PER_CLASS) -> Trees:
    """Learn from the statistics of at most ``per_class`` documents of each class outside the held-out fold."""
    sample, sizes = labelled_sample(docs, labels, "quality", per_class)
    rows = sample.mapInPandas(_sample_rows, "doc_id long, label int, x array<double>").toPandas().sort_values("doc_id")
    got = rows["label"].value_counts().to_dict()
    weight = np.array([sizes.get(v, 0) / max(1, got.get(v, 0)) for v in (0, 1)])
    y = rows["label"].to_numpy(dtype=np.int64)
    x = np.stack(rows["x"].to_list()) if len(rows) else np.zeros((0, len(STATISTICS)))
    return grow(x, y.astype(float), weight[y] if len(y) else np.zeros(0))


def _scorer(trees: Trees) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = trees.scores(_matrix(batch.column("text").to_pylist()))
            predicted = pa.array((scores >= THRESHOLD).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores), predicted], names=["doc_id", "score", "predicted"])

    return run


def score(docs: DataFrame, trees: Trees) -> DataFrame:
    """doc_id, score and predicted of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(_scorer(trees), "doc_id long, score double, predicted int")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    trees = fit(docs, read_table(spark, sf_dir, "labels"))
    return score(docs, trees).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
