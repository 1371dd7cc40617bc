"""Collocations, WARC archives and centroid clusters against brute force and SQL."""

import collections
import glob
import gzip
import hashlib
import math
import os
import re
import sys
from fractions import Fraction

import numpy as np
import pytest
from conftest import ROOT, SF_SMALL

from tidemark.llm import centroids, collocations, warc
from tidemark.llm.queries import QUERIES, SQL
from tidemark.session import scratch_path

sys.path.insert(0, os.path.join(ROOT, "tests"))
import oracle_check  # noqa: E402


@pytest.mark.parametrize("name", ["op11_collocations", "op12_warc", "op13_centroid_clusters"])
def test_query_matches_sql(spark, name):
    ok, msg, _ = oracle_check.compare(spark, oracle_check.duck(SF_SMALL), name, QUERIES[name], SQL[name], SF_SMALL)
    assert ok, msg


# ---------------------------------------------------------------- op11


def brute_collocations(rows, longest, least, top, covered):
    f, total = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    f[lang, tuple(words[i : i + n])] += 1
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    lost = set()
    for (lang, p), a in found.items():
        for n in range(2, len(p)):
            for i in range(len(p) - n + 1):
                inner = (lang, p[i : i + n])
                if inner in found and 100 * a >= covered * found[inner]:
                    lost.add(inner)
    out = collections.defaultdict(list)
    for (lang, p), a in found.items():
        if (lang, p) not in lost:
            cuts = [(1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {
        (lang, i + 1, p.decode(), -a, l, r, total[lang], -s)
        for lang, ps in out.items()
        for i, (s, a, p, l, r) in enumerate(sorted(ps)[:top])
    }


@pytest.fixture(scope="module")
def phrase_rows():
    rng = np.random.default_rng(3)
    words = ["New", "york", "city", "of", "the", "Über", "naïve", "x" * 70, "a", "b"]
    text = lambda n: "".join(words[i] + sep for i, sep in zip(rng.integers(0, len(words), n), rng.choice([" ", "  ", "\t", ", ", ".", "\n", "\r\n", " ; "], n, p=[0.6, 0.1, 0.05, 0.05, 0.05, 0.05, 0.05, 0.05])))
    rows = [("en", text(40)) for _ in range(60)] + [(None, text(30)) for _ in range(30)] + [("und", text(30)) for _ in range(20)]
    rows += [("en", text(20_000)), ("de", None), ("de", ""), (None, None), ("fr", " \n\t."), ("es", "uno dos " * 12), ("es", "uno dos " * 12)]
    return rows


@pytest.mark.parametrize(
    ("longest", "small"),
    [(3, {}), (4, {"SLICE": 200, "PER_TRIE": 7, "BROADCAST_BYTES": 6000}), (2, {"SLICE": 11, "HELD": 5}), (3, {"MOST_BITS": 16, "SLICE": 1})],
)
def test_collocations(spark, phrase_rows, longest, small, monkeypatch):
    for name, value in small.items():
        monkeypatch.setattr(collocations, name, value)
    rows = [(lang, text[:3000] if text and small else text) for lang, text in phrase_rows]
    docs = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "1 as n", "'x' as phrase", "2 as trie", "3 as a", "'y' as part").repartition(3)
    got = collocations.collocations(docs, longest, least=5, top=40)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {tuple(r) for r in got.collect()} == brute_collocations(rows, longest, 5, 40, 50)


def test_no_collocations(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(none).count() == 0
    assert collocations.collocations(spark.createDataFrame([("en", "one two"), ("en", None)], "lang string, text string")).count() == 0


def test_collocation_scores_pass_64_bits(spark, monkeypatch):
    big = 3_000_000_000
    words = spark.createDataFrame([("en", "a", 1, 2 * big), ("en", "b", 1, big)], "lang string, phrase string, words int, n long")
    phrases = spark.createDataFrame([("en", "a b", 2, big)], "lang string, phrase string, words int, n long")
    monkeypatch.setattr(collocations, "phrase_counts", lambda *_: (words, phrases))
    assert [tuple(r) for r in collocations.collocations(None).collect()] == [("en", 1, "a b", big, 2 * big, big, 3 * big, 500_000)]


def test_trie_slices_and_states():
    rng = np.random.default_rng(1)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(1, 9))) for _ in range(3000)]
    phrases = sorted({" ".join(rng.choice(words, rng.integers(2, 4))).encode() for _ in range(5000)})
    trie = collocations.Trie.of(phrases)
    for i in rng.integers(0, len(phrases), 200).tolist():  # walked a byte at a time
        state = 0
        for b in phrases[i] + b"\n":
            child = trie.base[state] + b
            assert trie.check[child] == state
            state = child
        assert trie.base[state] == i
    text = b" \n".join(phrases[i] for i in rng.integers(0, len(phrases), 400).tolist())
    for size in (1, 30, 1000):
        parts = list(collocations.slices(text, 2, size))
        assert b"".join(p[:own] for p, own in parts) == text


# ---------------------------------------------------------------- op12

PAGES = [
    (1, "http://a/", "x" * 1200), (2, "http://b/", "x" * 1200), (9, None, "x" * 1200), (9, "http://again/", "x" * 1200), (None, "http://n/", "x" * 1200),
    (4, "http://short/", "y" * 999), (5, "http://short2/", "y" * 999), (6, "http://c d\r\nX: 1/", None), (7, "http://e/", ""),
    (8, "http://ü/", "Ünï😀\r\n\r\n" * 200), (None, None, "z" * 3000), (None, None, "z" * 3000), (11, "http://w/", "WARC/1.1\r\n\r\n" * 300),
    (12, "http://w2/", "WARC/1.1\r\n\r\n" * 300), (-3, "http://neg/", "WARC/1.1\r\n\r\n" * 300),
]


def brute_pages(pages, least=1000):
    best = {}
    for i, _, html in pages:
        if i is not None:
            best[html or ""] = max(best.get(html or "", i), i)
    out = []
    for i, _, html in pages:
        data = (html or "").encode()
        first = best.get(html or "") if len(data) >= least else None
        revisit = first is not None and first != i
        out.append((i, "revisit" if revisit else "response", first if revisit else None, len(data), hashlib.sha1(data).hexdigest()))
    return collections.Counter(out)


@pytest.fixture(scope="module")
def pages(spark):
    extra = "*", "'o' as offset", "1 as length", "'d' as digest", "'k' as key", "0 as first", "2 as bytes", "'p' as payload", "3 as refers_to"
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr(*extra).repartition(3)


def seen(df):
    return collections.Counter((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in df.collect())


@pytest.mark.parametrize("groups", [0, 200_000])
def test_archives(spark, pages, groups, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_GROUPS", groups)
    root = scratch_path(spark, "warc-test")
    index = warc.write_archives(pages, root, archive_bytes=2000)
    got = warc.read_records(index, root)
    assert seen(got) == brute_pages(PAGES) == seen(index)
    bodies = collections.Counter((r.page_id, r.url, bytes(r.payload).decode()) for r in got.collect() if r.record_type == "response")
    assert bodies <= collections.Counter((i, u, h or "") for i, u, h in PAGES)
    # Another reader: the archives are plain sequences of gzip members.
    local = root.removeprefix("file:")
    records = b"".join(gzip.open(p).read() for p in glob.glob(f"{local}/*.warc.gz"))
    kinds = collections.Counter(re.findall(rb"WARC/1\.1\r\nWARC-Type: (\w+)\r\n", records))
    assert kinds[b"response"] + kinds[b"revisit"] == len(PAGES)
    assert b"WARC-Target-URI: http://c%20d%0D%0AX:%201/\r\n" in records


def test_selected_records_and_orphans(spark, pages):
    root = scratch_path(spark, "warc-test")
    index = warc.write_archives(pages, root)
    warc.write_archives(pages, root)  # archives that the index doesn't name
    some = warc.read_records(index.where("page_id in (8, 11)"), root)
    assert sorted((r.page_id, r.payload_bytes) for r in some.collect()) == [(8, len(PAGES[9][2].encode())), (11, 3600)]
    wrong = index.where("page_id = 8").selectExpr("archive", "offset", "length", "url", "'00' as payload_digest")
    with pytest.raises(Exception, match="another record"):
        warc.read_records(wrong, root).collect()
    empty = warc.write_archives(pages.limit(0), root)
    assert empty.count() == 0
    assert warc.read_records(empty, root).count() == 0


def test_broken_payload_is_told():
    row = {"page_id": 1, "url": "u", "payload": b"abc", "digest": hashlib.sha1(b"abd").hexdigest(), "bytes": 3, "refers_to": None}
    with pytest.raises(ValueError, match="digest"):
        warc.parsed(warc.packed(warc.record(row, "2024-01-01T00:00:00Z")))


def test_ranges_are_coalesced():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 25, 5), ("a", 100, 5), ("b", 0, 5), ("b", 5, 90), ("b", 95, 50)]
    assert warc.ranges(rows, gap=5, most=100) == [(0, 3), (3, 4), (4, 6), (6, 7)]
    assert warc.ranges([]) == []


# ---------------------------------------------------------------- op13


def brute_clusters(rows, k, dim, rounds, scale=256):
    kept = [(i, [math.floor(Fraction(x) * scale) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    c = [v for _, v in sorted(((name(i), v) for i, v in kept))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, w, strict=True)), n) for n, w in enumerate(c))
    for _ in range(rounds):
        of = collections.defaultdict(list)
        for _, v in kept:
            of[near(v)[1]].append(v)
        c = [[sum(x) // len(of[n]) for x in zip(*of[n], strict=True)] if n in of else w for n, w in enumerate(c)]
    best = [(i, *near(v)) for i, v in kept]
    inside = collections.Counter()
    for _, d, n in best:
        inside[n] += d
    long = lambda d: d if d < 1 << 63 else None
    return collections.Counter(
        (i, n, long(d), long(inside[n]), long(sum(inside.values())), hashlib.sha256(",".join(map(str, c[n])).encode()).hexdigest()) for i, d, n in best
    )


def vectors(kind):
    rng = np.random.default_rng(5)
    x = [(i, rng.normal(size=4).round(1).tolist()) for i in range(120)]
    x += [(3, [0.5] * 4), (3, [0.5] * 4), (None, [0.25] * 4), (200, None), (201, []), (202, [1.0] * 3), (203, [1.0, None, 1.0, 1.0])]
    x += [(204, [1.0, float("nan"), 1.0, 1.0]), (205, [float("inf")] * 4), (206, [-0.001] * 4)]
    if kind != "small":
        x += [(300, [1e9, 0.0, 0.0, 1.0]), (301, [1e9, 1.0, 0.0, 1.0]), (302, [-3e5, 7.0, 0.0, 0.0])]
    if kind == "huge":
        x += [(303, [1e200, 0.0, 0.0, 0.0]), (304, [1.7e308, -1.7e308, 0.0, 0.0])]
    return x


@pytest.mark.parametrize("kind", ["small", "wide", "huge"])
@pytest.mark.parametrize("k", [7, 500])
def test_clusters(spark, kind, k):
    rows = vectors(kind)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as cluster", "2 as q", "'w' as wide", "3 as h").repartition(3)
    got = centroids.cluster(df, k=k, dim=4, rounds=3)
    assert collections.Counter(tuple(r) for r in got.collect()) == brute_clusters(rows, k, 4, 3)


def test_no_clusters(spark):
    none = spark.createDataFrame([(1, None), (2, [1.0])], "vec_id long, embedding array<float>")
    assert centroids.cluster(none).count() == 0
    assert centroids.cluster(none.limit(0)).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_search_keeps_ties():
    rng = np.random.default_rng(2)
    for spread in (2, 1000, (1 << 22) - 1):
        c = rng.integers(-spread, spread + 1, (30, 16))
        c = np.concatenate([c, c[:5], c[:5, ::-1]])  # equal centroids, and equal sums and deviations
        x = np.concatenate([rng.integers(-spread, spread + 1, (200, 16)), c])
        d = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
        number, best = centroids.Search(c.tolist()).nearest(x)
        assert (number == d.argmin(axis=1)).all()
        assert (best == d.min(axis=1)).all()
        wide = centroids.Search(c.tolist())
        assert [wide.nearest_wide(v) for v in x[:50].tolist()] == list(zip(number[:50].tolist(), best[:50].tolist(), strict=True))
