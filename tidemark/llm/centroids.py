"""Centroid clustering: exact rounds of assignment by equal-average equal-variance search.

Components become integers, so distances, sums and centroids are exact and reruns agree
however the rows are partitioned. For a vector x and a centroid c of dimension d, with
component sums S and deviations V (V^2 = sum of (component - mean)^2),

    |x - c|^2  >=  (S_x - S_c)^2 / d  +  (V_x - V_c)^2.

Centroids are sorted by their sums. A vector scans outward from its own sum in both
directions; a direction ends when the first term alone passes the best distance (it only
grows from there), a centroid is skipped when both terms do, and what is left is calculated
in integers. The bounds are exact integers, or floats with room for their rounding, so ties
are never lost; of equal distances the smaller number wins.

A round sends k * (d + 1) sums from each task; the driver holds the k centroids.

Defined cases: vectors that are null, of another dimension, or hold null or non-finite
components are left out; a vector without an id hashes as the empty id and takes part;
repeated ids are vectors of their own, and of equal hashes the smaller components come
first; fewer vectors than k make fewer centroids; no vector gives no rows. Components too
large for 64-bit arithmetic are calculated in Python integers; a distance, or a sum of
distances, that a long can't hold is null.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import materialize, read_table

CLUSTERS, DIM, ROUNDS, SCALE = 40, 64, 5, 256
SALT = "2:"

LARGEST = (1 << 63) - 1
#: Sums travel in pieces of so many bits: no sum of pieces can pass a decimal(38).
PIECE = 40

KEPT = "vec_id long, q binary, wide array<string>"
ASSIGNED = "vec_id long, cluster int, distance long"
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def small_bits(dim: int) -> int:
    """Components below 2 to this power keep every product of the search in 64 bits."""
    return (60 - 2 * math.ceil(math.log2(max(dim, 2)))) // 2 - 1


def _floor(x: float, scale: int) -> int:
    """floor(scale * x) where the product may pass the range of doubles."""
    return math.floor(x * scale) if abs(x) < 1e300 else int(x) * scale


def _quantised(dim: int, scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(vec_id, q, wide): 64-bit integers as bytes, or as text where one of them is too large."""
    limit = float(1 << small_bits(dim))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column("embedding")
            right = pc.fill_null(pc.equal(pc.list_value_length(col), dim), False)
            ids, col = batch.column("vec_id").filter(right), col.filter(right)
            x = pc.cast(col.flatten(), pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dim)
            finite = np.isfinite(x).all(axis=1)
            ids, x = ids.filter(pa.array(finite)), x[finite]
            fits = (np.abs(x) * scale < limit).all(axis=1) if len(x) else np.zeros(0, dtype=bool)
            q = np.floor(np.where(fits[:, None], x, 0.0) * scale).astype("<i8")
            raw = [row.tobytes() if ok else None for row, ok in zip(q, fits, strict=True)]
            wide = [None if ok else [str(_floor(v, scale)) for v in row.tolist()] for row, ok in zip(x, fits, strict=True)]
            yield pa.RecordBatch.from_arrays([ids, pa.array(raw, pa.binary()), pa.array(wide, pa.list_(pa.string()))], names=["vec_id", "q", "wide"])

    return run


class Search:
    """The centroids in the order of their sums."""

    def __init__(self, centroids: list[list[int]]):
        self.all, self.dim = centroids, len(centroids[0])
        sums = [sum(c) for c in centroids]
        self.order = sorted(range(len(centroids)), key=lambda i: (sums[i], i))
        self.sums = [sums[i] for i in self.order]
        self.small = max(abs(v) for c in centroids for v in c) < 1 << small_bits(self.dim)
        if self.small:
            self.c = np.array([centroids[i] for i in self.order], dtype=np.int64)
            self.number = np.array(self.order, dtype=np.int64)
            self.s = np.array(self.sums, dtype=np.int64)
            self.v = self._deviation(self.c, self.s)

    def _deviation(self, x: np.ndarray, s: np.ndarray) -> np.ndarray:
        return np.sqrt((self.dim * (x * x).sum(axis=1) - s * s).astype(np.float64) / self.dim)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid and the squared distance, by row of small integers."""
        s = x.sum(axis=1)
        v = self._deviation(x, s)
        start = np.searchsorted(self.s, s)
        best = np.full(len(x), (1 << 62) // self.dim, dtype=np.int64)
        number = np.full(len(x), len(self.all), dtype=np.int64)
        ways = {1: np.arange(len(x)), -1: np.arange(len(x))}  # rows that still scan up, and down
        for step in range(len(self.all)):
            for way in (1, -1):
                rows = ways[way]
                at = start[rows] + step if way == 1 else start[rows] - 1 - step
                inside = (at >= 0) & (at < len(self.all))
                rows, at = rows[inside], at[inside]
                gap = s[rows] - self.s[at]
                gap *= gap
                goes_on = gap <= self.dim * best[rows]
                ways[way] = rows = rows[goes_on]
                at, gap = at[goes_on], gap[goes_on]
                low = gap / self.dim + (v[rows] - self.v[at]) ** 2
                near = low - (1e-9 * low + 1e-3) <= best[rows]
                rows, at = rows[near], at[near]
                if not len(rows):
                    continue
                d = x[rows] - self.c[at]
                d = np.einsum("ij,ij->i", d, d)
                better = (d < best[rows]) | ((d == best[rows]) & (self.number[at] < number[rows]))
                best[rows[better]], number[rows[better]] = d[better], self.number[at[better]]
            if not len(ways[1]) and not len(ways[-1]):
                break
        return number, best

    def nearest_wide(self, x: list[int]) -> tuple[int, int]:
        """The same for one vector, in integers of any size."""
        s, best, number = sum(x), None, len(self.all)
        up = next((i for i, c in enumerate(self.sums) if c >= s), len(self.sums))
        for way in (range(up, len(self.sums)), range(up - 1, -1, -1)):
            for i in way:
                if best is not None and (s - self.sums[i]) ** 2 > self.dim * best:
                    break
                d = sum((a - b) ** 2 for a, b in zip(x, self.all[self.order[i]], strict=True))
                if best is None or (d, self.order[i]) < (best, number):
                    best, number = d, self.order[i]
        return number, best


def _rows(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, list[int]]]]:
    """Places and integers of the small vectors; places and integers of the wide ones."""
    raw, wide = batch.column("q"), batch.column("wide")
    small = np.flatnonzero(raw.is_valid().to_numpy(zero_copy_only=False))
    x = np.frombuffer(b"".join(raw.drop_null().to_pylist()), dtype="<i8").reshape(len(small), dim)
    large = np.flatnonzero(wide.is_valid().to_numpy(zero_copy_only=False))
    return small, x, [(int(i), [int(v) for v in wide[int(i)].as_py()]) for i in large]


def _assign(search: Search, batch: pa.RecordBatch) -> tuple[np.ndarray, list[int | None], np.ndarray, np.ndarray, list]:
    small, x, large = _rows(batch, search.dim)
    cluster, distance = np.zeros(batch.num_rows, dtype=np.int64), [None] * batch.num_rows
    if search.small:
        number, best = search.nearest(x)
    else:
        found = [search.nearest_wide(row) for row in x.tolist()]
        number, best = np.array([n for n, _ in found], dtype=np.int64), [d for _, d in found]
    cluster[small] = number
    for i, d in zip(small.tolist(), best if isinstance(best, list) else best.tolist(), strict=True):
        distance[i] = d
    for i, row in large:
        cluster[i], distance[i] = search.nearest_wide(row)
    return cluster, [None if d > LARGEST else d for d in distance], small, x, large


def _assigned(search: Search) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance, *_ = _assign(search, batch)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], names=["vec_id", "cluster", "distance"])

    return run


def _pieces(total: int) -> list[tuple[int, int]]:
    """(place, piece) with the sum of piece << (PIECE * place) equal to ``total``."""
    sign, rest, out = (-1 if total < 0 else 1), abs(total), []
    while rest:
        out.append((len(out), sign * (rest & ((1 << PIECE) - 1))))
        rest >>= PIECE
    return out


def _summed(search: Search) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(cluster, i, place, piece) of a task's sums; ``i`` is the component, or -1 for the count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[int]] = {}
        for batch in batches:
            cluster, _, small, x, large = _assign(search, batch)
            parts = [(int(c), [int((cluster[small] == c).sum()), *x[cluster[small] == c].sum(axis=0).tolist()]) for c in np.unique(cluster[small])]
            parts += [(int(cluster[i]), [1, *row]) for i, row in large]
            for c, part in parts:
                sums[c] = [a + b for a, b in zip(sums.get(c, [0] * len(part)), part, strict=True)]
        rows = [(c, i - 1, place, piece) for c, part in sums.items() for i, total in enumerate(part) for place, piece in _pieces(total)]
        cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["cluster", "i", "place", "piece"])

    return run


def _moved(kept: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Every non-empty centroid's vectors' floor(sum / count); at most k * (d + 1) sums, in pieces, reach the driver."""
    dim = len(centroids[0])
    parts = kept.mapInArrow(_summed(Search(centroids)), "cluster int, i int, place int, piece long")
    total = parts.groupBy("cluster", "i", "place").agg(F.sum(F.col("piece").cast("decimal(38,0)")).alias("piece"))
    sums: dict[int, list[int]] = {}
    for r in total.collect():
        sums.setdefault(r.cluster, [0] * (dim + 1))[r.i + 1] += int(r.piece) << (PIECE * r.place)
    return [[v // sums[c][0] for v in sums[c][1:]] if c in sums else old for c, old in enumerate(centroids)]


def quantise(vectors: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """(vec_id, q, wide): the kept vectors' integers floor(scale * x)."""
    typed = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return typed.mapInArrow(_quantised(dim, scale), KEPT)


def first_centroids(kept: DataFrame, k: int = CLUSTERS, dim: int = DIM, salt: str = SALT) -> list[list[int]]:
    """The k kept vectors with the smallest hash of salt and id."""
    name = F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = kept.withColumn("h", F.sha2(name, 256)).orderBy("h", "q", "wide").limit(k).collect()
    return [np.frombuffer(r.q, dtype="<i8").tolist() if r.q is not None else [int(v) for v in r.wide] for r in first]


def cluster(vectors: DataFrame, k: int = CLUSTERS, dim: int = DIM, rounds: int = ROUNDS, scale: int = SCALE, salt: str = SALT) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector after ``rounds`` rounds."""
    spark = vectors.sparkSession
    kept = materialize(quantise(vectors, dim, scale), "clusters-kept")
    centroids = first_centroids(kept, k, dim, salt)
    if not centroids:
        return spark.createDataFrame([], RESULT)
    for _ in range(rounds):
        centroids = _moved(kept, centroids)
    assigned = materialize(kept.mapInArrow(_assigned(Search(centroids)), ASSIGNED), "clusters-assigned")
    of = assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("d"), F.count_if(F.col("distance").isNull()).alias("lost")
    ).collect()  # at most k rows
    inside = {r.cluster: None if r.lost else int(r.d) for r in of}
    every = None if None in inside.values() else sum(inside.values())

    def held(total: int | None) -> int | None:
        return None if total is None or total > LARGEST else total

    rows = [
        (c, held(total), held(every), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
        for c, total in inside.items()
    ]
    named = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # k rows at most: as small as the number of clusters, whatever the table.
    return assigned.join(F.broadcast(named), "cluster").select(*T.StructType.fromDDL(RESULT).names)


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``embeddings`` in 40 clusters after five rounds."""
    return cluster(read_table(spark, sf_dir, "embeddings"))


def _sql(k: int = CLUSTERS, dim: int = DIM, rounds: int = ROUNDS, scale: int = SCALE, salt: str = SALT) -> str:
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim})""",
        f"""c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h, q) - 1 AS INTEGER) AS cluster, q AS c
  FROM (SELECT sha256('{salt}' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, q FROM kept ORDER BY h, q LIMIT {k}))""",
    ]
    distance = "CAST(list_sum(list_transform(list_zip(q, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT)"
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT r, min(struct_pack(d := {distance}, n := cluster)) AS best FROM kept CROSS JOIN c{i} GROUP BY r)""")
        if i < rounds:
            parts.append(f"""m{i} AS MATERIALIZED (
  SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS c
  FROM (SELECT cluster, j, sum(v) AS s, count(*) AS n
        FROM (SELECT a.best.n AS cluster, unnest(q) AS v, generate_subscripts(q, 1) AS j FROM kept JOIN a{i} a USING (r))
        GROUP BY cluster, j)
  GROUP BY cluster)""")
            parts.append(f"c{i + 1} AS MATERIALIZED (SELECT cluster, coalesce(m.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} m USING (cluster))")
    last = rounds
    return f"""WITH {', '.join(parts)}
SELECT vec_id, best.n AS cluster, best.d AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.n) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM kept JOIN a{last} USING (r) JOIN c{last} f ON f.cluster = best.n"""


OP13_SQL = _sql()
