"""Phrase collocations: candidates that pass the Apriori test, counted by broadcast double-array tries.

Texts are lower-cased (A-Z) and cut into pieces at separators, pieces into words; everything
is by language. A phrase can only be frequent if its parts are, so phrases are gathered level
by level:

1. one pass counts the words, exactly, and adjacent pairs by hash into buckets;
2. for each further length one pass counts by hash the phrases both of whose parts (without
   the last, and without the first word) fell into frequent buckets;
3. one pass gathers the distinct phrases all of whose buckets are frequent. Buckets only add
   up, so no frequent phrase is lost. Phrases with a word or part that is no candidate go.

The candidates are sorted and dealt into tries of bounded size, built where they are dealt.
As many as fit a bound of bytes are broadcast at a time. A pass over the texts starts at every
word at once and advances all states byte by byte with numpy, dropping those that leave the
trie; the states that accept at a word's end are counted by ``bincount``, and the tasks'
counts are summed. Counts are exact: the tries compare bytes, hashes only thin candidates.

There are as many buckets as bytes of text, so few phrases share one. Their counts travel as
blocks of 65,536 buckets, and the driver gets about 100 bits for each frequent bucket: two
marks, of which a rare bucket has both by chance in one of 2,000 cases. A text is worked through in slices of bounded
size, cut between words, where a slice sees the words of phrases that begin in it.

Defined cases: null or empty texts have no words; a null language is ``und``; repeated rows
count each time; words are told by their bytes and may be of any length; no phrase with
enough occurrences gives no rows. Two phrases of one task with the same 64-bit hash would
be gathered as one (one chance in 10^7 for a task that gathers 10^6 phrases).
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, read_table
from tidemark.session import shuffle_partitions

MAX_WORDS, MIN_COUNT, TOP = 3, 10, 2000
#: A longer phrase with at least this share (percent) of a candidate's count replaces it.
COVERED = 50
NO_LANG = "und"

#: Bytes of a slice of text, words a task counts before it sends them, phrases of a trie, bytes of tries broadcast at once.
SLICE, HELD, PER_TRIE, BROADCAST_BYTES = 1 << 20, 300_000, 100_000, 64 << 20
#: Phrases whose counts travel in one row; frequent buckets for each part of a language's gathered phrases.
PART, PER_PART = 2048, 10_000
#: Hashes of gathered phrases that a task remembers, so as not to gather them again.
SEEN = 4_000_000
#: Places of a block; buckets at least and at most; marks at most, all as powers of 2.
BLOCK_BITS, LEAST_BITS, MOST_BITS, MARK_BITS = 16, 24, 40, 28

BLANK, END = 32, 10
# Bytes as the words' pattern sees them (blanks, separators, lower case).
TABLE = bytes(
    BLANK if b in b" \t" else END if b in b".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
ODD = np.uint64(0x9E3779B97F4A7C15)


# ------------------------------------------------------------------ texts to words


def slices(text: bytes, ahead: int, size: int | None = None) -> Iterator[tuple[bytes, int]]:
    """(bytes, own): parts of a translated text; ``own`` bytes are the part's, the rest are words ahead of its end."""
    size = size or SLICE
    word, at = re.compile(rb" *[^ \n]+"), 0
    while at < len(text):
        if len(text) - at <= size:
            yield text[at:], len(text) - at
            return
        cut = text.rfind(b"\n", at, at + size) + 1 or text.rfind(b" ", at, at + size) + 1
        if cut <= at:  # one word fills the slice: up to its end
            cut = min((i for i in (text.find(b"\n", at), text.find(b" ", at)) if i >= 0), default=len(text) - 1) + 1
        end = cut
        if text[cut - 1] != END:
            for _ in range(ahead):
                found = word.match(text, end)
                if not found:
                    break
                end = found.end()
        yield text[at:end], cut - at
        at = cut


def by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    """The translated texts of each language, a separator after each, about a slice at a time."""
    text, lang = batch.column("text").cast(pa.binary()), batch.column("lang").dictionary_encode()
    code = lang.indices.to_numpy()
    size = pc.binary_length(text).to_numpy()
    for i, name in enumerate(lang.dictionary.to_pylist()):
        rows = np.flatnonzero(code == i)
        part = np.cumsum(size[rows]) // SLICE
        for at in np.split(rows, np.flatnonzero(np.diff(part)) + 1):
            yield name, (b"\n".join(text.take(pa.array(at)).to_pylist()) + b"\n").translate(TABLE)


class Words:
    """The words of a slice: bytes with one blank or separator after each word, and where words start and end."""

    def __init__(self, text: bytes, own: int):
        data = np.frombuffer(text, dtype=np.uint8)
        inside = (data != BLANK) & (data != END)
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
        first, last = edge[::2], edge[1::2]  # of each word, end exclusive
        self.own = int(np.searchsorted(first, own))
        breaks = np.flatnonzero(data == END)
        # A phrase can't go on after a word that a separator follows before the next word.
        self.stops = np.ones(len(first), dtype=bool)
        self.stops[:-1] = np.searchsorted(breaks, first[1:]) > np.searchsorted(breaks, last[:-1])
        length = last - first
        self.end = np.cumsum(length + 1) - 1
        self.start = self.end - length
        out = np.empty(int(length.sum()) + len(first), dtype=np.uint8)
        kept = np.ones(len(out), dtype=bool)
        kept[self.end] = False
        out[kept] = data[inside]
        out[self.end] = np.where(self.stops, END, BLANK)
        self.data = out

    def hashes(self, lang: str) -> np.ndarray:
        """A 64-bit hash of each word and the language."""
        with np.errstate(over="ignore"):
            step, back = powers(len(self.data) + 1)  # of an odd number, whose inverse undoes a place
            total = np.zeros(len(self.data) + 1, dtype=np.uint64)
            np.cumsum((self.data.astype(np.uint64) + np.uint64(0x51ED27)) * step[: len(self.data)], out=total[1:])
            h = (total[self.end] - total[self.start]) * back[self.start]
            seed = np.uint64(hash_text(lang))
            return stirred(h ^ seed)

    def phrases(self, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the phrase of n words from each of the slice's own words, and whether there is one."""
        total, there = h[: self.own].copy(), np.ones(self.own, dtype=bool)
        with np.errstate(over="ignore"):
            for k in range(1, n):
                ok = np.zeros(self.own, dtype=bool)
                m = max(0, min(self.own, len(h) - k))
                ok[:m] = ~self.stops[k - 1 : k - 1 + m]
                there &= ok
                total[:m] = total[:m] * ODD + h[k : k + m]
        return stirred(total), there

    def text(self, i: int, n: int) -> bytes:
        return self.data[self.start[i] : self.end[i + n - 1]].tobytes()


POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of ODD and of its inverse mod 2^64; a task calculates them once."""
    if not POWERS or len(POWERS[0][0]) < n:
        inverse = np.uint64(pow(int(ODD), -1, 1 << 64))
        with np.errstate(over="ignore"):
            POWERS[:] = [(np.cumprod(np.full(n, ODD)), np.cumprod(np.full(n, inverse)))]
    return POWERS[0]


def hash_text(s: str) -> int:
    h = 0xCBF29CE484222325
    for b in s.encode():
        h = (h ^ b) * 0x100000001B3 % (1 << 64)
    return h


def stirred(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * ODD
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


# --------------------------------------------------------------- buckets by hash


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places and the sums of their counts."""
    at, where = np.unique(np.concatenate([a for a, _ in parts]), return_inverse=True)
    n = np.bincount(where, weights=np.concatenate([n for _, n in parts]), minlength=len(at))
    return at, n.astype(np.int64)


class Buckets:
    """Counts by place, sent as one row for each block of places."""

    def __init__(self):
        self.parts, self.held, self.merged = [], 0, 0

    def add(self, at: np.ndarray, n: np.ndarray | None = None) -> None:
        if n is None:
            at, n = np.unique(at, return_counts=True)
        self.parts.append((at.astype(np.int64), n.astype(np.int64)))
        self.held += len(at)
        if self.held > 2 * max(HELD, self.merged):
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.parts = [_added(self.parts)]
        self.held = self.merged = len(self.parts[0][0])
        return self.parts[0]

    def rows(self) -> list[tuple[int, bytes]]:
        """(block, data): places in the block and counts up to 255 (what is more is as frequent)."""
        at, n = self.merge()
        block = at >> BLOCK_BITS
        cut = [*np.flatnonzero(np.diff(block, prepend=-1)).tolist(), len(at)]
        places = (at & ((1 << BLOCK_BITS) - 1)).astype("<u2")
        counts = np.minimum(n, 255).astype(np.uint8)
        return [(int(block[lo]), places[lo:hi].tobytes() + counts[lo:hi].tobytes()) for lo, hi in itertools.pairwise(cut)]


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(data) // 3
    return np.frombuffer(data[: 2 * n], dtype="<u2"), np.frombuffer(data[2 * n :], dtype=np.uint8)


def _by_block(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(block, places, counts) of rows sorted by block; a block's rows are added up as they come."""
    now, found = None, Buckets()
    for batch in batches:
        for block, data in zip(batch["block"].tolist(), batch["data"].tolist(), strict=True):
            if block != now and now is not None:
                yield now, *found.merge()
                found = Buckets()
            now = block
            found.add(*_unpacked(data))
    if now is not None:
        yield now, *found.merge()


def _frequent_rows(least: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The buckets counted ``least`` times or more, by their full number."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block, at, n in _by_block(batches):
            kept = at[n >= least]
            if len(kept):
                yield pd.DataFrame({"bucket": kept + (block << BLOCK_BITS)})

    return run


def _places(bucket: np.ndarray, bits: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places of a bucket among 2^width each: its first bits, and a hash's."""
    first = bucket >> (bits - width) if bits > width else bucket
    return first, (1 << width) + (stirred(bucket.astype(np.uint64)) >> np.uint64(64 - width)).astype(np.int64)


def _place_rows(bits: int, width: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = Buckets()
        for batch in batches:
            for at in _places(batch["bucket"].to_numpy(), bits, width):
                found.add(at)
        yield pd.DataFrame(found.rows(), columns=["block", "data"]).astype({"block": "int64"})

    return run


def _mark_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for block, at, _ in _by_block(batches):
        bits = np.zeros(1 << BLOCK_BITS, dtype=bool)
        bits[at] = True
        yield pd.DataFrame({"block": [block], "bits": [np.packbits(bits, bitorder="little").tobytes()]})


def _sorted_blocks(rows: DataFrame) -> DataFrame:
    return rows.select("block", "data").repartition(shuffle_partitions(rows.sparkSession), "block").sortWithinPartitions("block")


@dataclass
class Marks:
    """The frequent ones of 2^bits buckets: a bucket is, if both its places are marked (some others are too)."""

    bits: int
    width: int
    packed: np.ndarray
    kept: int

    def of(self, h: np.ndarray) -> np.ndarray:
        first, second = _places((h >> np.uint64(64 - self.bits)).astype(np.int64), self.bits, self.width)
        ok = (self.packed[first >> 3] >> (first & 7).astype(np.uint8)) & 1 == 1
        at = second[ok]
        ok[ok] = (self.packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return ok


def frequent(blocks: DataFrame, bits: int, least: int) -> Marks:
    """What the driver gets are 2^(width + 1) bits: about 100 for each frequent bucket, 2^(MARK_BITS + 1) at most."""
    kept = materialize(_sorted_blocks(blocks).mapInPandas(_frequent_rows(least), "bucket long"), "phrase-buckets")
    n = kept.count()
    width = int(np.clip((32 * n).bit_length(), BLOCK_BITS, min(bits, MARK_BITS)))
    out = np.zeros((2 << width) // 8, dtype=np.uint8)
    per = (1 << BLOCK_BITS) // 8
    marks = _sorted_blocks(kept.mapInPandas(_place_rows(bits, width), "block long, data binary")).mapInPandas(_mark_rows, "block long, bits binary")
    for r in marks.collect():
        out[r.block * per : (r.block + 1) * per] = np.frombuffer(r.bits, dtype=np.uint8)
    return Marks(bits, width, out, n)


# ------------------------------------------------------------------ passes for candidates

BLOCKS = "block long, data binary"
FIRST = f"lang string, phrase string, n long, {BLOCKS}"


def _first_pass(bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of words, and of pairs by bucket."""

    def words(counts: dict[str, Counter]) -> pa.RecordBatch:
        rows = [(lang, w.decode("utf-8", "surrogatepass"), n) for lang, c in counts.items() for w, n in c.items()]
        counts.clear()
        lang, word, n = zip(*rows, strict=True) if rows else ((), (), ())
        empty = [None] * len(rows)
        return _batch(FIRST, [lang, word, n, empty, empty])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, pairs, shift = {}, Buckets(), np.uint64(64 - bits)
        for batch in batches:
            for lang, text in by_lang(batch):
                for part, own in slices(text, 1):
                    counts.setdefault(lang, Counter()).update(part[:own].split())
                    w = Words(part, own)
                    h, there = w.phrases(w.hashes(lang), 2)
                    pairs.add(h[there] >> shift)
                    if sum(map(len, counts.values())) > HELD:
                        yield words(counts)
        yield words(counts)
        yield _blocks(FIRST, pairs)

    return run


def _kinds(ddl: str) -> list[tuple[str, pa.DataType]]:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return [(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))]


def _batch(ddl: str, cols: list) -> pa.RecordBatch:
    kinds = _kinds(ddl)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(cols, kinds, strict=True)], names=[n for n, _ in kinds])


def _blocks(ddl: str, buckets: Buckets) -> pa.RecordBatch:
    block, data = list(zip(*buckets.rows(), strict=True)) or [(), ()]
    given = {"block": block, "data": data}
    return _batch(ddl, [given.get(name, [None] * len(block)) for name, _ in _kinds(ddl)])


def _safe(w: Words, lang: str, marks: list[Marks], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the phrases of n words, and those of whose shorter parts all buckets are marked.

    ``marks`` are those of 2, 3, ... words.
    """
    h = w.hashes(lang)
    whole, there = w.phrases(h, n)
    for k in range(2, min(n, len(marks) + 2)):
        part = w.phrases(h, k)[0]
        later = np.concatenate([part, np.zeros(n, dtype=np.uint64)])
        if w.own < len(h):  # parts that begin ahead of the slice's own words
            more = _ahead(w, h, k, n)
            later[len(part) : len(part) + len(more)] = more
        ok = marks[k - 2].of(later)
        for i in range(n - k + 1):
            there &= ok[i : i + len(there)]
    return whole, there


def _ahead(w: Words, h: np.ndarray, k: int, n: int) -> np.ndarray:
    """Hashes of the phrases of k words that begin among the words ahead of the slice's end."""
    out = []
    with np.errstate(over="ignore"):
        for i in range(w.own, min(len(h), w.own + n)):
            if i + k <= len(h):
                total = h[i : i + 1].copy()
                for j in range(1, k):
                    total = total * ODD + h[i + j]
                out.append(stirred(total)[0])
    return np.array(out, dtype=np.uint64)


def _bucket_pass(n: int, bits: int, marks: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts by bucket of the phrases of n words whose parts may be frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Buckets()
        for batch in batches:
            for lang, text in by_lang(batch):
                for part, own in slices(text, n - 1):
                    h, there = _safe(Words(part, own), lang, marks.value, n)
                    found.add(h[there] >> np.uint64(64 - bits))
        yield _blocks(BLOCKS, found)

    return run


GATHERED = "lang string, part int, data binary"


def _gather_pass(longest: int, parts: int, marks: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Phrases that may be frequent, a row for those of a language and part; a task repeats few of them."""

    def rows(found: dict[tuple[str, int], list[bytes]]) -> pa.RecordBatch:
        cols = [(lang, part, b"\n".join(phrases)) for (lang, part), phrases in found.items()]
        found.clear()
        return _batch(GATHERED, list(zip(*cols, strict=True)) or [()] * 3)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {n: np.zeros(0, dtype=np.uint64) for n in range(2, longest + 1)}
        found, held = {}, 0
        for batch in batches:
            for lang, text in by_lang(batch):
                for part, own in slices(text, longest - 1):
                    w = Words(part, own)
                    for n in seen:
                        h, there = _safe(w, lang, marks.value, n)
                        at = np.flatnonzero(there)
                        at = at[marks.value[n - 2].of(h[at])]
                        new, one = np.unique(h[at], return_index=True)
                        known = seen[n] if len(seen[n]) < SEEN else seen[n][:0]
                        place = np.searchsorted(known, new)
                        fresh = np.append(known, ~new[-1:])[place] != new if len(new) else np.zeros(0, dtype=bool)
                        seen[n] = np.insert(known, place[fresh], new[fresh])
                        group = (new[fresh] % np.uint64(parts)).astype(np.int64).tolist()
                        for i, g in zip(at[one[fresh]].tolist(), group, strict=True):
                            found.setdefault((lang, g), []).append(w.text(i, n))
                        held += len(group)
                    if held > HELD:
                        yield rows(found)
                        held = 0
        yield rows(found)

    return run


def _distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(lang, phrase, words), each once, of rows sorted by language and part; a part has about PER_PART phrases."""

    def rows(lang: str, phrases: set[bytes]) -> pd.DataFrame:
        words = [p.count(b" ") + 1 for p in phrases]
        return pd.DataFrame({"lang": lang, "phrase": [p.decode("utf-8", "surrogatepass") for p in phrases], "words": words}).astype({"words": "int32"})

    now, phrases = None, set()
    for batch in batches:
        for lang, part, data in zip(batch["lang"].tolist(), batch["part"].tolist(), batch["data"].tolist(), strict=True):
            if now != (lang, part):
                if now is not None:
                    yield rows(now[0], phrases)
                now, phrases = (lang, part), set()
            phrases.update(data.split(b"\n"))
    if now is not None:
        yield rows(now[0], phrases)


# ------------------------------------------------------------------------- tries


@dataclass
class Trie:
    """A double array: the child of state s by byte b is t = base[s] + b where check[t] == s.

    The root is state 0. A phrase ends in a child by END; there base holds its number.
    """

    base: np.ndarray
    check: np.ndarray
    phrases: int

    @classmethod
    def of(cls, phrases: list[bytes]) -> Trie:
        """From distinct phrases in ascending order, level by level with all states of a level at once."""
        data = np.frombuffer(b"".join(p + bytes([END]) for p in phrases), dtype=np.uint8)
        length = np.array([len(p) + 1 for p in phrases], dtype=np.int64)
        offset = np.cumsum(length) - length
        slots = _Slots()
        state = np.zeros(len(phrases), dtype=np.int64)  # of each phrase so far
        alive, depth = np.arange(len(phrases)), 0
        while len(alive):
            byte = data[offset[alive] + depth].astype(np.int64)
            parent = state[alive]
            new = np.ones(len(alive), dtype=bool)
            new[1:] = (parent[1:] != parent[:-1]) | (byte[1:] != byte[:-1])
            child = slots.place(parent[new], byte[new])
            state[alive] = child[np.cumsum(new) - 1]
            depth += 1
            alive = alive[length[alive] > depth]
        base, check = slots.base, slots.check
        base[state] = np.arange(len(phrases))
        used = int(np.flatnonzero(check >= 0).max(initial=0)) + 257
        return cls(np.pad(base, (0, 256))[:used].astype(np.int32), np.pad(check, (0, 256), constant_values=-1)[:used].astype(np.int32), len(phrases))

    def counted(self, w: Words) -> np.ndarray:
        """Occurrences of each phrase that begin at the slice's own words.

        All words' states advance together, a byte a round; a state that leaves the trie is dropped.
        """
        at, found = w.start[: w.own], []
        state = np.zeros(len(at), dtype=np.int32)
        while len(at):
            byte = w.data[at]
            done = np.flatnonzero((byte == BLANK) | (byte == END))
            if len(done):
                end = self.base[state[done]] + END
                ok = self.check[end] == state[done]
                found.append(self.base[end[ok]])
            to = self.base[state] + byte
            on = np.flatnonzero((self.check[to] == state) & (byte != END))
            state, at = to[on], at[on] + 1
        return np.bincount(np.concatenate(found) if found else np.zeros(0, np.int32), minlength=self.phrases)


class _Slots:
    """The arrays while they are filled, and the free places."""

    def __init__(self, size: int = 1 << 12):
        self.base, self.check = np.zeros(size, dtype=np.int64), np.full(size, -1, dtype=np.int64)
        self.check[0] = 0  # the root; a place below 256 could get a negative base
        self.free, self.rng = np.arange(256, size - 256), np.random.default_rng(0)

    def _grow(self, room: int) -> None:
        size = len(self.base)
        more = max(size, 2 * room)
        self.base = np.concatenate([self.base, np.zeros(more, dtype=np.int64)])
        self.check = np.concatenate([self.check, np.full(more, -1, dtype=np.int64)])
        places = np.arange(256, size + more - 256)
        self.free = places[self.check[places] < 0]

    def _take(self, n: int, least: int | None = None) -> np.ndarray:
        """n free places (or ``least`` at least), the lowest first; they stay free until they are given away."""
        while True:
            self.free = self.free[self.check[self.free] < 0]
            if len(self.free) >= (least or n):
                return self.free[:n]
            self._grow(n)

    def place(self, parent: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Places for children given by parent (equal ones next to each other) and byte; sets the parents' base."""
        cut = np.flatnonzero(np.diff(parent, prepend=-1))
        many = np.diff(np.append(cut, len(parent)))
        out = np.empty(len(parent), dtype=np.int64)
        # Only children first need no search: any free place will do.
        for first in sorted(np.unique(many).tolist(), reverse=True):
            group = cut[many == first]
            rows = group[:, None] + np.arange(first)
            if first == 1:
                spots = self._take(len(group))
                self._give(parent[group], spots - byte[group])
                out[group] = spots
                self.check[spots] = parent[group]
                self.free = self.free[len(group) :]
                continue
            size = max(4 * len(group), 256)
            while len(group):  # try a free place for the first child of each, keep what fits
                pool = self._take(min(size, max(len(group), len(self.free))), len(group))
                spots = pool[self.rng.permutation(len(pool))[: len(group)]]
                at = (spots - byte[group])[:, None] + byte[rows]
                ok = (at < len(self.check)).all(axis=1)
                ok[ok] &= (self.check[at[ok]] < 0).all(axis=1)
                tried = np.flatnonzero(ok)
                flat = at[tried].ravel()
                _, one = np.unique(flat, return_index=True)
                clear = np.zeros(len(flat), dtype=bool)
                clear[one] = True
                won = tried[clear.reshape(-1, first).all(axis=1)]
                self._give(parent[group[won]], spots[won] - byte[group[won]])
                self.check[at[won].ravel()] = np.repeat(parent[group[won]], first)
                out[rows[won].ravel()] = at[won].ravel()
                left = np.ones(len(group), dtype=bool)
                left[won] = False
                if 4 * len(won) < len(group):  # crowded: look further on, and beyond all places make more
                    if size >= len(self.free):
                        self._grow(first * int(left.sum()))
                    size *= 4
                group, rows = group[left], rows[left]
        return out

    def _give(self, parent: np.ndarray, base: np.ndarray) -> None:
        self.base[parent] = base


TRIES = "trie long, lang string, bytes long, base binary, check binary, phrases array<string>"


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (lang, phrase) rows to tries of at most PER_TRIE phrases of one language."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32

    def built(lang: str, phrases: list[str]) -> pa.RecordBatch:
        nonlocal number
        trie = Trie.of([p.encode("utf-8", "surrogatepass") for p in phrases])
        number += 1
        base, check = trie.base.astype("<i4").tobytes(), trie.check.astype("<i4").tobytes()
        cols = [[number], [lang], [len(base) + len(check)], [base], [check], [phrases]]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.string())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in TRIES.split(", ")])

    lang, held = None, []
    for batch in batches:
        for of, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True):
            if held and (of != lang or len(held) >= PER_TRIE):
                yield built(lang, held)
                held = []
            lang = of
            held.append(phrase)
    if held:
        yield built(lang, held)


COUNTS = "trie long, part int, width int, data binary"


def _count_pass(tries: Broadcast, ahead: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's occurrences of the broadcast tries' phrases, a row of counts for each run of PART phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[tuple[int, Trie]]] = {}
        for number, lang, base, check, phrases in tries.value:
            known.setdefault(lang, []).append((number, Trie(np.frombuffer(base, "<i4"), np.frombuffer(check, "<i4"), phrases)))
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for lang, text in by_lang(batch):
                if lang in known:
                    for part, own in slices(text, ahead):
                        w = Words(part, own)
                        for number, trie in known[lang]:
                            total[number] = total.get(number, 0) + trie.counted(w)
        for number, n in total.items():
            rows = []
            for lo in range(0, len(n), PART):
                part = n[lo : lo + PART]
                if part.any():
                    packed = part.astype(np.min_scalar_type(part.max()))
                    rows.append((number, lo // PART, packed.itemsize, packed.tobytes()))
            yield _batch(COUNTS, list(zip(*rows, strict=True)) or [()] * 4)

    return run


def _summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(trie, i, n) of all tasks' counts, sorted by trie and part."""

    def rows(at: tuple[int, int], total: np.ndarray) -> pd.DataFrame:
        i = np.flatnonzero(total)
        return pd.DataFrame({"trie": at[0], "i": i + at[1] * PART, "n": total[i]}).astype({"i": "int32"})

    now, total = None, None
    for batch in batches:
        for trie, part, width, data in zip(*(batch[c].tolist() for c in ("trie", "part", "width", "data")), strict=True):
            n = np.frombuffer(data, dtype=f"u{width}").astype(np.int64)
            if now != (trie, part):
                if now is not None:
                    yield rows(now, total)
                now, total = (trie, part), n
            else:
                total += n
    if now is not None:
        yield rows(now, total)


def count_phrases(texts: DataFrame, candidates: DataFrame, longest: int) -> DataFrame:
    """(lang, phrase, n): occurrences of the distinct candidates (lang, phrase) in texts (lang, text).

    Tries are built in tasks and written; a group of them that fits BROADCAST_BYTES is
    broadcast, counted in one pass over the texts, and let go before the next.
    """
    spark = texts.sparkSession
    tasks = max(1, -(-candidates.count() // PER_TRIE))
    ordered = candidates.select("lang", "phrase").repartitionByRange(tasks, "lang", "phrase").sortWithinPartitions("lang", "phrase")
    tries = materialize(ordered.mapInArrow(_build, TRIES), "phrase-tries")
    passes, room = [], 0
    for r in tries.select("trie", "bytes").orderBy("trie").collect():  # a row for up to PER_TRIE phrases
        if not passes or room + r.bytes > BROADCAST_BYTES:
            passes.append([])
            room = 0
        passes[-1].append(r.trie)
        room += r.bytes
    parts = []
    for members in passes:
        some = tries.where(F.col("trie").isin(members)).select("trie", "lang", "base", "check", F.size("phrases").alias("k")).collect()
        sent = spark.sparkContext.broadcast([(r.trie, r.lang, bytes(r.base), bytes(r.check), r.k) for r in some])
        part = texts.mapInArrow(_count_pass(sent, longest - 1), COUNTS).repartition(shuffle_partitions(spark), "trie", "part")
        part = part.sortWithinPartitions("trie", "part").mapInPandas(_summed, "trie long, i int, n long")
        parts.append(materialize(part, "phrase-counts"))
        sent.destroy()
    named = tries.select("trie", "lang", F.posexplode("phrases").alias("i", "phrase"))
    if not parts:
        return named.select("lang", "phrase", F.lit(0).cast("long").alias("n"))
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    return named.join(counts, ["trie", "i"]).select("lang", "phrase", "n")


# ------------------------------------------------------------------------- scores


def phrase_counts(docs: DataFrame, longest: int = MAX_WORDS, least: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """Exact counts (lang, phrase, words, n) of the words, and of the phrases of 2 to ``longest`` words that occur ``least`` times."""
    spark = docs.sparkSession
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG))
    texts = docs.select(lang.alias("lang"), F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = int(np.clip(int(size).bit_length(), LEAST_BITS, MOST_BITS))
    first = materialize(texts.mapInArrow(_first_pass(bits), FIRST), "phrase-words")
    words = first.where(F.col("block").isNull()).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    words = materialize(words.select("lang", "phrase", F.lit(1).alias("words"), "n"), "phrase-words")
    marks = [frequent(first.where(F.col("block").isNotNull()), bits, least)]
    for n in range(3, longest + 1):
        sent = spark.sparkContext.broadcast(marks)
        marks.append(frequent(texts.mapInArrow(_bucket_pass(n, bits, sent), BLOCKS), bits, least))
        sent.destroy()
    sent = spark.sparkContext.broadcast(marks)
    parts = max(1, -(-sum(m.kept for m in marks) // PER_PART))
    gathered = texts.mapInArrow(_gather_pass(longest, parts, sent), GATHERED).repartition(shuffle_partitions(spark), "lang", "part")
    gathered = gathered.sortWithinPartitions("lang", "part").mapInPandas(_distinct, "lang string, phrase string, words int")
    gathered = materialize(gathered, "phrase-gathered")
    sent.destroy()
    # Of a frequent phrase each word is frequent (checked for pairs), and each part without an end a candidate.
    known = words.where(F.col("n") >= least).select("lang", F.col("phrase").alias("part"))
    safe = None
    for n in range(2, longest + 1):
        of = gathered.where(F.col("words") == n)
        for part in (F.substring_index("phrase", " ", n - 1), F.substring_index("phrase", " ", 1 - n)):
            of = of.withColumn("part", part).join(known, ["lang", "part"], "left_semi").select("lang", "phrase", "words")
        of = materialize(of, "phrase-candidates")
        known = of.select("lang", F.col("phrase").alias("part"))
        safe = of if safe is None else safe.unionByName(of)
    counts = count_phrases(texts, safe, longest).where(F.col("n") >= least)
    phrases = counts.select("lang", "phrase", (F.size(F.split("phrase", " "))).alias("words"), "n")
    return words, materialize(phrases, "phrase-frequent")


def _joined(words: Column, start: Column, n: Column) -> Column:
    return F.array_join(F.slice(words, start, n), " ")


def collocations(docs: DataFrame, longest: int = MAX_WORDS, least: int = MIN_COUNT, top: int = TOP, covered: int = COVERED) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases by their weakest cut's score."""
    words, phrases = phrase_counts(docs, longest, least)
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))  # a row for each language
    counts = words.where(F.col("n") >= least).unionByName(phrases).select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    of = phrases.withColumn("w", F.split("phrase", " ")).withColumnRenamed("n", "a")
    k = F.col("k")
    cuts = of.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", "a", "k",
        _joined(F.col("w"), F.lit(1), k).alias("before"), _joined(F.col("w"), k + 1, F.col("words") - k).alias("after"),
    )
    cuts = cuts.join(counts.withColumnsRenamed({"part": "before", "f": "l"}), ["lang", "before"])
    cuts = cuts.join(counts.withColumnsRenamed({"part": "after", "f": "r"}), ["lang", "after"])
    # Exact up to counts of 10^15: products of two have 30 digits, the scaled one 37. A score is at most 10^6.
    wide = {f"_{c}": F.col(c).cast("decimal(15,0)") for c in ("a", "l", "r")}
    cuts = cuts.withColumns(wide)
    score = F.expr("(CAST(1000000 AS DECIMAL(7,0)) * (_a * _a)) DIV (_l * _r)")
    weakest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("s"))
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda m: F.transform(F.sequence(F.lit(1), F.col("words") - m + 1), lambda i: _joined(F.col("w"), i, m)),
        )
    )
    longer = of.where("words > 2").select("lang", "a", F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = weakest.join(longer, ["lang", "phrase"], "left").where(
        F.col("most").isNull() | (F.col("most").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * covered)
    )
    order = Window.partitionBy("lang").orderBy(F.col("s.score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("s.l").alias("l"), F.col("s.r").alias("r"),
        "n", F.col("s.score").cast("long").alias("score"),
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of every language of all ``documents``."""
    return collocations(read_table(spark, sf_dir, "documents"))


OP11_SQL = f"""WITH pieces AS (
  SELECT coalesce(lang, '{NO_LANG}') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
w AS MATERIALIZED (
  SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
f1 AS MATERIALIZED (
  SELECT lang, p, count(*) AS f FROM (SELECT lang, unnest(w) AS p FROM w) GROUP BY ALL),
f2 AS MATERIALIZED (
  SELECT lang, p, count(*) AS f
  FROM (SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: array_to_string(w[i:i+1], ' '))) AS p FROM w WHERE len(w) > 1)
  GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
f3 AS MATERIALIZED (
  SELECT lang, p, count(*) AS f
  FROM (SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' '))) AS p FROM w WHERE len(w) > 2)
  GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
f AS MATERIALIZED (SELECT * FROM f1 UNION ALL SELECT * FROM f2 UNION ALL SELECT * FROM f3),
c AS (SELECT lang, p, f AS a, string_split(p, ' ') AS w FROM f2 UNION ALL SELECT lang, p, f, string_split(p, ' ') FROM f3),
cuts AS (SELECT lang, p, a, k, array_to_string(w[1:k], ' ') AS p1, array_to_string(w[k+1:], ' ') AS p2
         FROM (SELECT *, unnest(range(1, len(w))) AS k FROM c)),
scored AS (
  SELECT cuts.lang, cuts.p, a, k, x.f AS l, y.f AS r,
         (CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.p = p1 JOIN f y ON y.lang = cuts.lang AND y.p = p2),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
longer AS (
  SELECT lang, p, max(f) AS most
  FROM (SELECT lang, f, unnest([array_to_string(string_split(p, ' ')[1:2], ' '), array_to_string(string_split(p, ' ')[2:3], ' ')]) AS p FROM f3)
  GROUP BY ALL),
kept AS (
  SELECT weakest.* FROM weakest LEFT JOIN longer USING (lang, p)
  WHERE most IS NULL OR CAST(100 AS HUGEINT) * most < CAST({COVERED} AS HUGEINT) * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank, p AS phrase, a, l, r,
       CAST((SELECT sum(f) FROM f1 WHERE f1.lang = kept.lang) AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept QUALIFY rank <= {TOP}"""
