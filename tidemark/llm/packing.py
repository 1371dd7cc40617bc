"""Packing token sequences by minimum bin slack.

Documents are tokenised and closed with an end id. Full windows of a document become
sequences of their own; the remaining pieces of a partition wait in a pool of bounded size.
From the pool's multiset of lengths a window takes the longest piece and fills the rest by a
bitset subset-sum: every length enters with its count in binary parts, bit t of the bitset
says that t tokens can be reached, and the parts are backtracked from the fullest reachable
t. What the last pool of a partition can't fill whole is cut to whole windows, and its rest
to powers of two, which are not padded: no sequence needs padding.

Each partition packs its own documents, so nothing is shuffled and memory is bounded by the
pool. Sequence ids carry the partition's number.

Ids are those of the library ``tokenizers``; its byte-level vocabulary is applied through
``tiktoken``, which gives the same ids several times faster, and the ids of pieces of text
that repeat are remembered. The vocabulary file's added tokens, as ``<|endoftext|>``, are
found in a text first and have their own ids, as in the library; the parts between them are
encoded each by itself.

Defined cases: a null text is empty, and an empty document is the end id alone; a document
of any length is cut; rows with the same id are separate documents with pieces of their own.
"""

from __future__ import annotations

import base64
import json
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import read_table

WINDOW, END_ID = 2048, 1
VOCABULARY = "byte_bpe_50k"
#: Remaining pieces a pool holds before windows are made of them, and is left with.
POOL, POOL_REST = 6_000, 1_500
#: Characters tokenised at once, and remembered pieces of text.
TEXT_BLOCK, REMEMBERED = 1 << 21, 500_000
#: A blank before another character starts a new piece of text: the vocabulary's pattern
#: never joins the blank with what is before it.
SPLIT = re.compile(r" (?=[^\s])")


class Tokenizer:
    """Texts to little-endian uint32 ids, by way of a memory of repeated pieces."""

    def __init__(self, vocabulary: str = VOCABULARY):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        self.bytes_of[list(ranks.values())] = [len(x) for x in ranks]
        self.memory: dict[str, bytes] = {}
        with open(public_tokenizers.path(f"{vocabulary}.json"), encoding="utf-8") as f:
            added = json.load(f)["added_tokens"]
        if odd := [t["content"] for t in added if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]:
            raise ValueError(f"added tokens that are not matched as they stand: {odd}")
        self.added = {t["content"]: int(t["id"]).to_bytes(4, "little") for t in added}
        # Of tokens that start at the same place the longest is meant.
        names = sorted(self.added, key=len, reverse=True)
        self.find_added = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text: added tokens have their own, the parts between them are encoded."""
        if self.find_added is None or not any(name in t for t in texts for name in self.added):
            return self._encode_parts(texts)
        split = [self.find_added.split(t) for t in texts]
        parts = iter(self._encode_parts([p for x in split for p in x[::2]]))
        return [b"".join(self.added[p] if k % 2 else next(parts) for k, p in enumerate(x)) for x in split]

    def _encode_parts(self, texts: list[str]) -> list[bytes]:
        split = [SPLIT.split(t) for t in texts]
        wanted = set()
        for parts in split:
            wanted.update(parts[1:])
        if len(self.memory) + len(wanted) > REMEMBERED:
            self.memory.clear()
        new = list(wanted.difference(self.memory))
        if new:
            # All new pieces as one text; the ids' lengths tell where each ends.
            sizes = np.cumsum([len(p.encode()) + 1 for p in new])
            ids = np.array(self.encoding.encode_ordinary(" " + " ".join(new)), dtype="<u4")
            ends = (np.searchsorted(np.cumsum(self.bytes_of[ids]), sizes) + 1) * 4
            raw, at = ids.tobytes(), 0
            for piece, end in zip(new, ends.tolist(), strict=True):
                self.memory[piece] = raw[at:end]
                at = end
        get = self.memory.__getitem__
        first = [np.array(self.encoding.encode_ordinary(p[0]), dtype="<u4").tobytes() for p in split]
        return [a + b"".join(map(get, p[1:])) for a, p in zip(first, split, strict=True)]


def tokenizer(vocabulary: str = VOCABULARY) -> Tokenizer:
    """This worker process's tokenizer: kept between tasks in tiktoken's own registry of encodings."""
    from tiktoken import registry

    name = f"packing:{vocabulary}"
    if name not in registry.ENCODINGS:
        registry.ENCODINGS[name] = Tokenizer(vocabulary)
    return registry.ENCODINGS[name]


def fill(counts: dict[int, int], room: int, lengths: list[int]) -> dict[int, int]:
    """Counts of pieces, by length, whose sum is as near to ``room`` as can be, and not above.

    ``lengths`` gives the order in which lengths enter; the search ends when the room is met.
    """
    reach, mask, want = 1, (1 << (room + 1)) - 1, 1 << room
    steps = []
    for length in lengths:
        left = min(counts[length], room // length)
        part = 1
        while left > 0:
            take = min(part, left)
            more = (reach << (length * take)) & mask & ~reach
            if more:
                steps.append((length, take, reach))
                reach |= more
            left -= take
            part *= 2
        if reach & want:
            break
    total, taken = reach.bit_length() - 1, defaultdict(int)
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            taken[length] += take
            total -= length * take
    return dict(taken)


def windows(counts: dict[int, int], room: int, least: int) -> Iterator[tuple[list[int], int]]:
    """(lengths of a window's pieces, how often), longest first, until fewer than ``least`` pieces are left.

    Changes ``counts``. A window holds the longest piece left and the best filling of
    the rest; a pattern is repeated as long as all its pieces last.
    """
    left = sum(counts.values())
    lengths = sorted(counts, reverse=True)
    while left >= max(least, 1):
        lengths = [x for x in lengths if counts.get(x)]
        longest = lengths[0]
        counts[longest] -= 1
        rest = fill(counts, room - longest, [x for x in lengths if x <= room - longest and counts[x]]) if longest < room else {}
        counts[longest] += 1
        need = dict(rest)
        need[longest] = need.get(longest, 0) + 1
        often = min(counts[x] // n for x, n in need.items())
        if least > 1:
            often = max(1, min(often, (left - least) // sum(need.values()) + 1))
        for x, n in need.items():
            counts[x] -= n * often
        left -= often * sum(need.values())
        yield [x for x, n in sorted(need.items(), reverse=True) for _ in range(n)], often


class Packer:
    """The pool of one partition. Emits rows (doc, start, ids, doc_tokens, sequence, offset)."""

    def __init__(self, first_sequence: int, window: int = WINDOW):
        self.window, self.next, self.rows = window, first_sequence, []
        self.pool: dict[int, list] = defaultdict(list)
        self.waiting = 0

    def _sequence(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, ids, total, self.next, offset))
            offset += len(ids) // 4
        self.next += 1

    def add(self, doc, ids: bytes) -> None:
        total, w = len(ids) // 4, self.window
        whole = total // w * w
        for start in range(0, whole, w):
            self._sequence([(doc, start, ids[start * 4 : (start + w) * 4], total)])
        if whole < total:
            self.pool[total - whole].append((doc, whole, ids[whole * 4 :], total))
            self.waiting += 1
            if self.waiting >= POOL:
                self._pack(POOL_REST)

    def _pack(self, least: int) -> list[list[tuple]]:
        """Emit full windows; put the others' pieces back, or return them when the pool is to be emptied."""
        open_windows = []
        counts = {x: len(p) for x, p in self.pool.items() if p}
        for lengths, often in windows(counts, self.window, least):
            for _ in range(often):
                pieces = [self.pool[x].pop() for x in lengths]
                self.waiting -= len(pieces)
                if sum(lengths) == self.window:
                    self._sequence(pieces)
                else:
                    open_windows.append(pieces)
        if least > 0:  # not full: they may do better with the pieces to come
            for pieces in open_windows:
                for piece in pieces:
                    self.pool[len(piece[2]) // 4].append(piece)
                    self.waiting += 1
            open_windows = []
            if self.waiting >= POOL:  # a pool that can't fill a window must not grow
                self._cut([p for x in list(self.pool) for p in self.pool.pop(x)])
                self.waiting = 0
        return open_windows

    def _cut(self, pieces: list[tuple]) -> None:
        """Lay pieces end to end and cut them to windows, the rest to powers of two."""
        total = sum(len(p[2]) // 4 for p in pieces)
        sizes = [self.window] * (total // self.window)
        rest = total % self.window
        sizes += [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        queue = iter(pieces)
        piece = None
        for size in sizes:
            held, out = 0, []
            while held < size:
                if piece is None:
                    piece = next(queue)
                doc, start, ids, of = piece
                take = min(size - held, len(ids) // 4)
                out.append((doc, start, ids[: take * 4], of))
                held += take
                piece = (doc, start + take, ids[take * 4 :], of) if take * 4 < len(ids) else None
            self._sequence(out)

    def finish(self) -> None:
        self._cut([p for pieces in self._pack(0) for p in pieces])

    def take(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


PACKED = "doc_id long, start long, ids binary, doc_tokens long, sequence_id long, offset long"
NAMES = ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    doc, start, ids, total, sequence, offset = zip(*rows, strict=True) if rows else [()] * 6
    arrays = [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(ids, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays + [pa.array(x, pa.int64()) for x in (total, sequence, offset)], names=NAMES)


def _pack(vocabulary: str, window: int, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = tokenizer(vocabulary), end_id.to_bytes(4, "little")
        packer = Packer(TaskContext.get().partitionId() << 33, window)
        for batch in batches:
            docs, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            i = 0
            while i < len(docs):
                block, size = [], 0
                while i + len(block) < len(docs) and (not block or size < TEXT_BLOCK):
                    block.append(texts[i + len(block)].as_py() or "")
                    size += len(block[-1])
                for doc, ids in zip(docs[i : i + len(block)], tokens.encode(block), strict=True):
                    packer.add(doc, ids + end)
                i += len(block)
                if rows := packer.take():
                    yield _batch(rows)
        packer.finish()
        if rows := packer.take():
            yield _batch(rows)

    return run


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row for each piece: doc_id, start, ids (little-endian uint32), doc_tokens, sequence_id, offset."""
    if window & (window - 1):
        raise ValueError("the window must be a power of two")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_pack(vocabulary, window, end_id), PACKED)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(read_table(spark, sf_dir, "documents")))


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with their length and checksum in place of the ids."""
    length = (F.octet_length("ids") / 4).cast("long")
    return pieces.select("doc_id", "start", length.alias("length"), F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
