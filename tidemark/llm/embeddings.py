"""Embedding near-duplicates: an exact metric range join around pivots.

Vectors are scaled to length 1, where a cosine of at least t is a distance of at most
r = sqrt(2 - 2 t). Equal vectors are joined into one representative first. Every
representative goes to the cell of its nearest pivot. By the triangle inequality a vector x
can only have a neighbour in the cell of pivot p, of radius R, if d(x, p) <= R + r; so x is
also sent to those of the cells after its own that pass this test. Each pair meets in one
cell only. A cell's members and its visitors are dealt into blocks of bounded size, and each pair of blocks is one task: a blocked matrix product whose links leave as
counts by vector and as spanning stars, never as pairs.

The answer is exact for any data; how many cells a vector is sent to depends on how the
distances spread. In many dimensions random vectors are all about equally far from each
other, the test excludes few cells, and the work grows with the square of the table.

Defined cases: a vector's length, however large or small, changes nothing; null or zero vectors, and those with null, infinite or NaN components, link
with nothing, and so do rows without a vec_id; vectors of different dimension don't link;
rows that repeat a vec_id have links of their own but are one node of the components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, read_table
from tidemark.llm.components import components
from tidemark.llm.simhash import lowest

COSINE = 0.9
#: Representatives per pivot, and the most pivots of a dimension (which the driver collects).
PER_PIVOT, MAX_PIVOTS = 4_000, 256
#: Vectors in a block of members, and of visitors.
BLOCK, VISITORS = 4_096, 16_384
#: Rounding room of the distance tests; pairs this near to the least cosine are calculated anew.
SLACK = 1e-9


def _unit(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), dtype="<f8").reshape(len(raw), -1)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _scaled(x: np.ndarray) -> np.ndarray | None:
    """The vector in a range where its squares neither overflow nor vanish; null if it is zero or not finite.

    Scaling is by a power of two, so no angle changes; vectors of ordinary length stay as they are.
    """
    if not len(x) or not np.isfinite(x).all() or not x.any():
        return None
    with np.errstate(over="ignore", under="ignore"):
        if 1e-200 < (x * x).sum() < 1e200:
            return x
    return np.ldexp(x, -int(np.frexp(np.abs(x).max())[1]))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, dim, raw): the components as doubles; raw is null for vectors that can't link."""
    for batch in batches:
        out, dims = [], []
        for v in batch.column("embedding").to_pylist():
            x = None if v is None or None in v else _scaled(np.array(v, dtype="<f8"))
            out.append(None if x is None else x.tobytes())
            dims.append(0 if x is None else len(x))
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(dims, pa.int32()), pa.array(out, pa.binary())], names=["vec_id", "dim", "raw"])


def _by_dim(batch: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    dims = batch["dim"].to_numpy()
    for dim in np.unique(dims):
        yield int(dim), np.flatnonzero(dims == dim)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x @ pivots.T)))


def _homes(pivots: dict[int, np.ndarray]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Adds the cell (the nearest pivot's number) and the distance to it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cell, far = np.zeros(len(batch), dtype=np.int64), np.full(len(batch), 2.0)
            for dim, at in _by_dim(batch):
                if dim in pivots:
                    d = _distances(_unit(batch["raw"].iloc[at].tolist()), pivots[dim])
                    cell[at] = d.argmin(axis=1)
                    far[at] = d[np.arange(len(at)), cell[at]]
            yield batch.assign(cell=cell, far=far)

    return run


def _sent(pivots: dict[int, np.ndarray], reach: dict, blocks: dict, guests: dict, radius: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Rows of the block pairs each vector takes part in: as ``own`` it is searched, as ``asks`` it searches.

    By (dimension, cell): its radius, its blocks of members; by dimension the blocks of
    visitors. ``b`` is a member block, or, from -1 down, a block of visitors.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, at in _by_dim(batch):
                rows = batch.iloc[at]
                homes, salt = rows["cell"].to_numpy(), rows["salt"].to_numpy()
                every = np.arange(len(rows))
                here = np.array([blocks[dim, c] for c in homes.tolist()])
                mine, visiting = salt % here, salt // 1024 % guests[dim]

                def part(i, cell, a, b, own, asks, rows=rows):
                    return rows.iloc[i][["dim", "rep", "key", "n", "raw"]].assign(cell=cell, a=a, b=b, own=own, asks=asks)

                for k in range(int(here.max())):  # its block with every block of its cell
                    i = every[here > k]
                    yield part(i, homes[i], np.minimum(mine[i], k), np.maximum(mine[i], k), mine[i] <= k, mine[i] >= k)
                if dim not in pivots:
                    continue
                for v in range(guests[dim]):  # its block with every block of its cell's visitors
                    yield part(every, homes, mine, -1 - v, True, False)
                d = _distances(_unit(rows["raw"].tolist()), pivots[dim])
                for cell in range(len(pivots[dim])):
                    if (dim, cell) in reach:  # as a visitor with every block of a later cell
                        i = every[(homes < cell) & (d[:, cell] <= reach[dim, cell] + radius + SLACK)]
                        for a in range(blocks[dim, cell] if len(i) else 0):
                            yield part(i, cell, a, -1 - visiting[i], False, True)

    return run


def _join(cosine: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Links of one block pair: (rep, key, links, low), for vectors that have any."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["rep", "key"], kind="stable")
        own, asks = np.flatnonzero(group["own"].to_numpy()), np.flatnonzero(group["asks"].to_numpy())
        n, reps = group["n"].to_numpy(), group["rep"].to_numpy()
        links = np.zeros(len(group), dtype=np.int64)
        same = bool(group["b"].iloc[0] == group["a"].iloc[0])
        if not len(own) or not len(asks):
            return pd.DataFrame({"rep": reps[:0], "key": group["key"].to_numpy()[:0], "links": links[:0], "low": reps[:0]})
        raw = group["raw"].tolist()
        x = _unit(raw)

        def found() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for i in range(0, len(asks), 512):
                some = asks[i : i + 512]
                c = x[some] @ x[own].T
                p, q = np.nonzero(c >= cosine - SLACK)
                edge = np.flatnonzero(np.abs(c[p, q] - cosine) <= SLACK)
                p, q = some[p], own[q]
                if len(edge):  # too near to tell from scaled vectors: by definition
                    keep = np.ones(len(p), dtype=bool)
                    for e in edge:
                        u, v = np.frombuffer(raw[p[e]], dtype="<f8"), np.frombuffer(raw[q[e]], dtype="<f8")
                        keep[e] = float(u @ v) / (float(np.sqrt(u @ u)) * float(np.sqrt(v @ v))) >= cosine
                    p, q = p[keep], q[keep]
                if same:
                    p, q = p[p < q], q[p < q]
                np.add.at(links, p, n[q])
                np.add.at(links, q, n[p])
                yield p, q

        low = lowest(len(group), found())
        some = np.flatnonzero(links)
        return pd.DataFrame({"rep": reps[some], "key": group["key"].to_numpy()[some], "links": links[some], "low": reps[low[some]]})

    return run


def _pivots(reps: DataFrame, sizes: dict[int, int]) -> dict[int, np.ndarray]:
    """Up to MAX_PIVOTS vectors of each dimension of more than one block, picked by hash."""
    out = {}
    for dim, size in sizes.items():
        if size > BLOCK:
            wanted = min(MAX_PIVOTS, -(-size // PER_PIVOT))
            rows = reps.where(F.col("dim") == dim).orderBy(F.xxhash64("key", F.lit(3)), "key").limit(wanted).select("raw").collect()
            out[dim] = _unit([bytes(r["raw"]) for r in rows])
    return out


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row (vec_id, n_links, component_id, kept) for each row of ``vectors`` (vec_id, embedding)."""
    typed = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    packed = typed.mapInArrow(_packed, "vec_id long, dim int, raw binary")
    packed = packed.withColumn("raw", F.when(F.col("vec_id").isNotNull(), F.col("raw")))
    packed = packed.withColumns({"key": F.xxhash64("raw"), "key2": F.xxhash64("raw", F.lit(7))})
    packed = materialize(packed, "vectors")
    linkable = packed.where("raw is not null")
    one = linkable.groupBy("dim", "key", "key2").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("raw").alias("raw"))
    one = materialize(one, "vectors-distinct")
    sizes = {r["dim"]: r["count"] for r in one.groupBy("dim").count().collect()}
    pivots = _pivots(one, sizes)
    homes = one.mapInPandas(_homes(pivots), "dim int, key long, key2 long, rep long, n long, raw binary, cell long, far double")
    homes = materialize(homes.withColumn("salt", F.pmod(F.xxhash64("key", F.lit(9)), F.lit(1 << 40))), "vectors-homes")
    # One row for each pivot at most.
    cells = homes.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()
    reach = {(r["dim"], r["cell"]): r["far"] for r in cells}
    blocks = {(r["dim"], r["cell"]): -(-r["n"] // BLOCK) for r in cells}
    guests = {dim: -(-size // VISITORS) for dim, size in sizes.items()}
    radius = float(np.sqrt(2.0 - 2.0 * cosine))
    sent = homes.drop("key2", "far").mapInPandas(
        _sent(pivots, reach, blocks, guests, radius),
        "dim int, rep long, key long, n long, raw binary, cell long, a long, b long, own boolean, asks boolean",
    )
    met = sent.groupBy("dim", "cell", "a", "b").applyInPandas(_join(cosine), "rep long, key long, links long, low long")
    met = materialize(met, "vector-links")
    totals = met.groupBy("key").agg(F.sum("links").alias("links"))
    found = components(met, "rep", "low")
    counted = one.join(totals, "key", "left").select("key", "key2", "rep", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"))
    classes = counted.join(found, F.col("rep") == F.col("node"), "left").select("key", "key2", "links", F.coalesce("component", "rep").alias("part"))
    out = packed.select("vec_id", "key", "key2", F.col("raw").isNotNull().alias("ok")).join(
        classes.withColumn("ok", F.lit(True)), ["key", "key2", "ok"], "left"
    )
    part = F.coalesce("part", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), part.alias("component_id"), F.coalesce(F.col("vec_id") == part, F.lit(False)).alias("kept"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))
