"""URL filters: host and path rules, and exact list membership by a Bloom filter cascade.

The cascade's first level holds the listed keys. The next holds the keys of the corpus that
are not listed but pass the first; the one after that the listed keys that pass the second,
and so on until no key of the corpus is answered wrongly. A key's membership is then the
parity of the first level that doesn't have it: exact for every key of the corpus, without
a join against the list.

The keys are dealt into shards by hash and each shard builds its own cascade from the
distinct keys. Cascades are broadcast as long as their counted size is within a bound;
beyond it the pages are probed in several passes, each with as many shards as fit.

Defined cases: a null url, or one without "://", has empty host and path, fits no rule and
has the key of the empty host; repeated rows each get their verdict; an empty list blocks
nothing; keys are compared by two 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, read_table

# The rules (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Words in a host's labels by which the registered query lists hosts.
LISTED_WORDS = ("ads-track", "adult", "bets", "casino", "pills", "spam")

FALSE_FIRST, FALSE_REST = 0.05, 0.5
LEVELS = 64
#: Keys a shard should hold, and bytes of cascades that are broadcast at once.
PER_SHARD, BROADCAST_BYTES = 200_000, 64 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)


class Bloom:
    def __init__(self, bits: np.ndarray, hashes: int):
        self.bits, self.hashes = bits, hashes

    @classmethod
    def of(cls, keys: np.ndarray, rate: float, level: int) -> Bloom:
        size = max(64, math.ceil(-len(keys) * math.log(rate) / math.log(2) ** 2))
        out = cls(np.zeros(-(-size // 8), dtype=np.uint8), max(1, round(-math.log2(rate))))
        at = out._places(keys, level).ravel()
        np.bitwise_or.at(out.bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        return out

    def _places(self, keys: np.ndarray, level: int) -> np.ndarray:
        """Bit numbers, a row for each hash: two hashes of the key, stirred by the level."""
        with np.errstate(over="ignore"):
            a = (keys[:, 0] ^ np.uint64(level + 1)) * MIX
            b = (keys[:, 1] + np.uint64(level)) * MIX | np.uint64(1)
            a ^= a >> np.uint64(29)
            b ^= (b >> np.uint64(31)) << np.uint64(1)
            at = a[None, :] + np.arange(self.hashes, dtype=np.uint64)[:, None] * b[None, :]
            at ^= at >> np.uint64(33)
        return (at % np.uint64(len(self.bits) * 8)).astype(np.int64)

    def has(self, keys: np.ndarray, level: int) -> np.ndarray:
        at = self._places(keys, level)
        return ((self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0)


def cascade(keys: np.ndarray, listed: np.ndarray) -> list[Bloom]:
    """Levels that tell the listed keys from the others among ``keys`` (n x 2 unsigned hashes)."""
    levels: list[Bloom] = []
    ins, outs = keys[listed], keys[~listed]
    while len(ins):
        if len(levels) >= LEVELS:
            raise ValueError("a listed key and another have the same hashes")
        level = len(levels)
        levels.append(Bloom.of(ins, FALSE_REST if level else FALSE_FIRST, level))
        ins, outs = outs[levels[-1].has(outs, level)], ins
    return levels


def member(levels: list[Bloom], keys: np.ndarray) -> np.ndarray:
    """Whether each key is listed: the first level without it has an odd number (from 0), or none lacks it and they are odd many."""
    answer = np.full(len(keys), len(levels) % 2 == 1)
    open_ = np.arange(len(keys))
    for i, bloom in enumerate(levels):
        has = bloom.has(keys[open_], i)
        answer[open_[~has]] = i % 2 == 1
        open_ = open_[has]
    return answer


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key, F.lit(1)).alias("h1"), F.xxhash64(key, F.lit(2)).alias("h2")


def _build(group: pd.DataFrame) -> pd.DataFrame:
    keys = group[["h1", "h2"]].to_numpy(dtype=np.int64).view(np.uint64)
    levels = cascade(keys, group["listed"].to_numpy(dtype=bool))
    shard = int(group["shard"].iloc[0])
    return pd.DataFrame({"shard": shard, "level": range(len(levels)), "hashes": [b.hashes for b in levels], "bits": [b.bits.tobytes() for b in levels]})


def _probe(levels: dict[int, list[tuple[int, bytes]]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blooms = {s: [Bloom(np.frombuffer(bits, dtype=np.uint8), k) for k, bits in x] for s, x in levels.items()}
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2")], axis=1)
            shard = batch.column("shard").to_numpy()
            listed = np.zeros(len(keys), dtype=bool)
            for s in np.unique(shard).tolist():
                at = np.flatnonzero(shard == s)
                listed[at] = member(blooms.get(s, []), keys[at])
            rest = [batch.column(c) for c in batch.schema.names if c not in ("h1", "h2", "shard")]
            names = [c for c in batch.schema.names if c not in ("h1", "h2", "shard")]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(listed)], names=[*names, "listed"])

    return run


def mark_listed(rows: DataFrame, key: str, listed_keys: DataFrame) -> DataFrame:
    """``rows`` with a column ``listed``: whether ``key`` is among ``listed_keys`` (column ``key``).

    ``rows`` must have none of the columns h1, h2, shard and listed.
    """
    text = F.coalesce(F.col(key), F.lit(""))
    marked = listed_keys.select(F.coalesce("key", F.lit("")).alias("key"), F.lit(True).alias("listed"))
    every = rows.select(text.alias("key"), F.lit(False).alias("listed")).union(marked).groupBy("key").agg(F.max("listed").alias("listed"))
    universe = materialize(every.select(*_hashes(F.col("key")), "listed"), "url-keys")
    shards = max(1, -(-universe.count() // PER_SHARD))
    shard = F.pmod("h1", F.lit(shards)).alias("shard")
    built = universe.select("h1", "h2", "listed", shard).groupBy("shard").applyInPandas(_build, "shard long, level int, hashes int, bits binary")
    built = materialize(built, "url-cascades")
    sizes = {r["shard"]: r["n"] for r in built.groupBy("shard").agg(F.sum(F.length("bits")).alias("n")).collect()}
    # Shards that are broadcast together: as many as the bound allows.
    passes, room = [[]], BROADCAST_BYTES
    for s in range(shards):
        if passes[-1] and sizes.get(s, 0) > room:
            passes.append([])
            room = BROADCAST_BYTES
        passes[-1].append(s)
        room -= sizes.get(s, 0)
    keyed = rows.select("*", *_hashes(text)).withColumn("shard", shard)
    schema = rows.schema.add("listed", "boolean")
    parts = []
    for some in passes:
        low, high = some[0], some[-1]
        levels: dict[int, list] = {}
        for r in built.where(F.col("shard").between(low, high)).orderBy("shard", "level").collect():  # within BROADCAST_BYTES
            levels.setdefault(r["shard"], []).append((r["hashes"], bytes(r["bits"])))
        mine = keyed.where(F.col("shard").between(low, high)) if len(passes) > 1 else keyed
        parts.append(mine.mapInArrow(_probe(levels), schema))
    return reduce(DataFrame.unionAll, parts)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty if it is null or has no scheme."""
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def rule_of(host: Column, path: Column) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, or null."""
    cases = None
    for verdict, name, start in sorted(RULES, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        value = F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))
        cases = F.when(fits, value) if cases is None else cases.when(fits, value)
    return cases


def judge(pages: DataFrame, listed_hosts: DataFrame) -> DataFrame:
    """page_id, host, path, rule and verdict of every page; without a rule, listed hosts are blocked."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path")))
    rows = rows.select("page_id", "host", "path", F.col("rule.rule").alias("rule"), F.col("rule.verdict").alias("ruled"))
    marked = mark_listed(rows, "host", listed_hosts)
    own = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return marked.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    host, _ = host_and_path(F.col("url"))
    listed = pages.select(host.alias("key")).where(F.col("key").rlike("|".join(LISTED_WORDS))).distinct()
    return judge(pages, listed)


OP9_SQL = f"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR suffix(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
  WHEN rule IS NOT NULL THEN 'block'
  WHEN regexp_matches(host, '{"|".join(LISTED_WORDS)}') THEN 'block'
  ELSE 'allow' END AS verdict
FROM ruled
"""
