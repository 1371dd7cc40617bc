"""Near-duplicate documents: 64-bit SimHash fingerprints linked through BK-trees.

A fingerprint is the bitwise majority of the XXH64 hashes of a text's word shingles. Two
fingerprints within 3 bits agree on at least one of four 16-bit bands, so each distinct
fingerprint goes to four shards, by band and band value, and every link is found in one of
them. A shard's tasks hold BK-trees, one for each band value: children are keyed by their
integer Hamming distance to the parent, and a search follows only the edges within the
radius. The trees travel through the shuffle, never through the driver, as they grow with
the corpus; a band value with very many fingerprints is cut into blocks, and each block's
tree is sent to the searches of every later block. Links leave a task as a spanning star of
what hangs together there, so a dense group never turns into all its pairs.

Defined cases: a null text is empty; texts without words have the fingerprint zero and link
like any other; repeated rows and ids link through their equal fingerprints; a row without an
id gets the component of the rows with its fingerprint, and null where none of them has an
id: such a fingerprint links nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import checked_broadcast, materialize, read_table
from tidemark.llm.components import components

WORDS, SEED, RADIUS = 3, 42, 3
BANDS = RADIUS + 1
#: Rows a shard should hold, and fingerprints in one block of a band value.
PER_SHARD, PER_BLOCK = 40_000, 8_000
#: Hashes added up at once; bounds the memory for very long texts.
HASH_BLOCK = 1 << 16
WEIGHTS = (1 << np.arange(64, dtype=np.uint64)).astype(np.uint64)


def fingerprint(text: bytes) -> int:
    """The unsigned 64-bit SimHash of a UTF-8 text."""
    words = text.lower().split()  # of bytes: A-Z only, and the six ASCII blanks
    if not words:
        return 0
    if len(words) < WORDS:
        grams = [b" ".join(words)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[: -WORDS] + 1))
        grams = [joined[a:b] for a, b in zip(starts.tolist(), ends[WORDS - 1 :].tolist(), strict=True)]
    ones = np.zeros(64, dtype=np.int64)
    hashed = xxhash.xxh64_intdigest
    for i in range(0, len(grams), HASH_BLOCK):
        h = np.array([hashed(g, SEED) for g in grams[i : i + HASH_BLOCK]], dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(WEIGHTS[2 * ones > len(grams)].sum(dtype=np.uint64))


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.fromiter(map(fingerprint, batch.column("text").to_pylist()), dtype=np.uint64, count=batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64))], names=["doc_id", "fp"])


def _keyed_fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same with the row's key."""
    for batch in batches:
        for out in _fingerprints(iter([batch])):
            yield pa.RecordBatch.from_arrays([*out.columns, batch.column("k1"), batch.column("k2")], names=["doc_id", "fp", "k1", "k2"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row; fp has the fingerprint's bits in a signed long."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(_fingerprints, "doc_id long, fp long")


class Forest:
    """BK-trees over fingerprints, one for each value of ``tree``, built level by level."""

    def __init__(self, fps: np.ndarray, tree: np.ndarray):
        n = len(fps)
        self.fps = fps
        self.child = np.full((n, 65), -1, dtype=np.int32)  # by distance to the parent
        rest = np.arange(n)
        _, first, group = np.unique(tree, return_index=True, return_inverse=True)
        self.root_of = dict(zip(tree[first].tolist(), first.tolist(), strict=True))
        node = first[group]  # where each fingerprint stands
        rest = rest[node != rest]
        node = node[rest]
        while len(rest):
            d = np.bitwise_count(fps[rest] ^ fps[node]).astype(np.int64)
            key = node * 65 + d
            _, first, group = np.unique(key, return_index=True, return_inverse=True)
            self.child[node[first], d[first]] = rest[first]
            node = rest[first][group]
            left = node != rest
            rest, node = rest[left], node[left]

    def search(self, fps: np.ndarray, roots: np.ndarray, radius: int = RADIUS, block: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of (index of the searched, index of the found) within the radius."""
        for i in range(0, len(fps), block):
            who, node = np.arange(i, min(i + block, len(fps))), roots[i : i + block]
            while len(who):
                d = np.bitwise_count(fps[who] ^ self.fps[node]).astype(np.int64)
                near = d <= radius
                if near.any():
                    yield who[near], node[near]
                nexts = []
                for k in range(-radius, radius + 1):
                    e = d + k
                    ok = (e >= 0) & (e <= 64)
                    to = self.child[node[ok], e[ok]]
                    on = to >= 0
                    nexts.append((who[ok][on], to[on].astype(np.int64)))
                who, node = (np.concatenate(x) for x in zip(*nexts, strict=True))


def lowest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For items 0..n-1, the smallest item each hangs together with; pairs come in blocks and aren't kept."""
    label = np.arange(n)
    for a, b in pairs:
        while True:
            x, y = label[a], label[b]
            low, high = np.minimum(x, y), np.maximum(x, y)
            apart = low < high
            if not apart.any():
                break
            np.minimum.at(label, high[apart], low[apart])
            while (label[label] < label).any():
                label = label[label]
    return label


def _links(group: pd.DataFrame) -> pd.DataFrame:
    """Stars of linked representatives among a shard's rows.

    Rows with ``own`` are the fingerprints of the tree they name; rows with
    ``searches`` look for their neighbours in it.
    """
    order = np.lexsort((group["rep"].to_numpy(), ~group["own"].to_numpy()))  # members first, then by representative
    group = group.iloc[order]
    fps, reps, tree = group["fp"].to_numpy().view(np.uint64), group["rep"].to_numpy(), group["tree"].to_numpy()
    members = int(group["own"].sum())
    forest = Forest(fps[:members], tree[:members])
    roots = np.array([forest.root_of.get(t, -1) for t in tree.tolist()], dtype=np.int64)
    asks = np.flatnonzero((roots >= 0) & group["searches"].to_numpy())
    pairs = ((asks[a], b) for a, b in forest.search(fps[asks], roots[asks]))
    low = lowest(len(fps), pairs)
    tied = np.flatnonzero(low != np.arange(len(fps)))
    return pd.DataFrame({"a": reps[tied], "b": reps[low[tied]]})


def links(distinct: DataFrame) -> DataFrame:
    """(a, b): representatives whose fingerprints are within the radius, enough of them to connect all such.

    ``distinct`` has one row (fp, rep) for each fingerprint.
    """
    value = lambda b: F.shiftrightunsigned("fp", 16 * b).bitwiseAND(F.lit(0xFFFF))
    banded = distinct.select("fp", "rep", F.explode(F.array(*(value(b) + F.lit(b << 16) for b in range(BANDS)))).alias("key"))
    sizes = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    crowded = sizes.where(F.col("n") > PER_BLOCK).select("key", F.ceil(F.col("n") / PER_BLOCK).cast("int").alias("blocks"))
    placed = banded.join(crowded, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    placed = placed.withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    # Each pair of blocks of a band value meets once: the later one searches the earlier one's tree.
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # A row for each block its own meets: what the shards hold follows from the sizes.
    held = sizes.agg(F.sum(F.col("n") * F.ceil(F.col("n") / PER_BLOCK)).alias("rows")).first()["rows"] or 0
    shards = max(1, -(-held // PER_SHARD))
    rows = met.select(
        "fp", "rep",
        F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("tree"),
        (F.col("mine") <= F.col("other")).alias("own"), (F.col("mine") >= F.col("other")).alias("searches"),
    )
    return rows.withColumn("shard", F.pmod("tree", F.lit(shards))).groupBy("shard").applyInPandas(_links, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row (doc_id, fp, component_id) for each row of ``docs``."""
    prints = materialize(fingerprints(docs), "simhash")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-distinct")
    named = distinct.where(F.col("rep").isNotNull())
    found = components(links(named), "a", "b")
    classes = distinct.join(found, distinct["rep"] == found["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


#: Row keys (two longs each) that are broadcast at most; more meet their rows in a shuffle.
BROADCAST_KEYS = 1_000_000


def _unused(docs: DataFrame, name: str) -> str:
    """The name, or one with more underscores where the table has it."""
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    return name


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group of linked fingerprints: of those with the smallest id the first by the row's hash.

    Groups are of fingerprints, not of ids: rows that share an id but no near text are
    groups of their own, and rows without an id are linked, and come last in their
    group. Of rows alike in every column one stays. Only hashes of the rows that go
    are joined with the texts, so where these are few no text is shuffled.
    """
    columns, one, two = docs.columns, *(_unused(docs, n) for n in ("row_key_one", "row_key_two"))
    keyed = docs.withColumns({one: F.xxhash64(*columns), two: F.xxhash64(F.lit(1), *reversed(columns))})
    rows = keyed.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"),
        F.col(one).alias("k1"), F.col(two).alias("k2"),
    )
    prints = materialize(rows.mapInArrow(_keyed_fingerprints, "doc_id long, fp long, k1 long, k2 long"), "simhash")
    distinct = materialize(prints.select("fp").distinct().select("fp", F.col("fp").alias("rep")), "simhash-distinct")
    linked = components(links(distinct), "a", "b").select(F.col("node").alias("fp"), F.col("component").alias("group"))
    # A row of the documents is a key; equal rows share theirs.
    keys = prints.join(linked, "fp", "left").withColumn("group", F.coalesce("group", "fp"))
    keys = materialize(keys.groupBy("group", "k1", "k2").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n")), "simhash-keys")
    first = keys.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2")).alias("first"))
    first = first.select(F.col("first.k1").alias("k1"), F.col("first.k2").alias("k2"), F.lit(True).alias("stays"))
    odd = keys.join(first, ["k1", "k2"], "left").where("stays is null or n > 1")
    odd = materialize(odd.select(F.col("k1").alias(one), F.col("k2").alias(two), F.col("stays").isNotNull().alias("stays")), "simhash-odd")
    few = odd.limit(BROADCAST_KEYS + 1).count()
    kept = keyed.join(checked_broadcast(odd.drop("stays"), few, BROADCAST_KEYS), [one, two], "left_anti").select(*columns)
    # Rows that stay and occur more than once: all columns are equal, so any value of each is theirs.
    again = keyed.join(checked_broadcast(odd.where("stays").drop("stays"), few, BROADCAST_KEYS), [one, two], "left_semi")
    once = again.groupBy(one, two).agg(*(F.any_value(F.col(f"`{c}`")).alias(c) for c in columns)).select(*columns)
    return kept.unionByName(once)


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
