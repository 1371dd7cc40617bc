"""Tool calls, embeddings, URL filters and components against brute force."""

import json
import os
import sys

import numpy as np
import pytest
from conftest import ROOT, SF_SMALL

from tidemark.llm import embeddings, toolcalls, urlfilter
from tidemark.llm.common import read_table
from tidemark.llm.components import components

sys.path.insert(0, os.path.join(ROOT, "tests"))
import oracle_check  # noqa: E402


def unite(n, pairs):
    part = list(range(n))

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        part[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components(spark):
    rng = np.random.default_rng(0)
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + rng.integers(200, 400, (120, 2)).tolist()
    df = spark.createDataFrame([*pairs, (None, 5), (7, 7)], "a long, b long")
    want = unite(400, pairs)
    got = {r.node: r.component for r in components(df, "a", "b").collect()}
    linked = {x for p in pairs if p[0] != p[1] for x in p}
    assert got == {i: want[i] for i in linked}
    assert components(df.limit(0), "a", "b").count() == 0


@pytest.mark.parametrize("block", [20, 4096])
def test_embedding_links(spark, block, monkeypatch):
    for name, value in (("BLOCK", block), ("VISITORS", 2 * block), ("PER_PIVOT", max(10, block))):
        monkeypatch.setattr(embeddings, name, value)
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 16))
    x = [(centres[i % 12] + rng.normal(scale=0.13, size=16)).astype(np.float32).tolist() for i in range(150)]
    x += [x[0], x[0], [2 * v for v in x[1]], None, [0.0] * 16, [float("nan")] * 16, [None, *x[2][1:]], [float("inf")] * 16, x[3][:8], []]
    got = {r.vec_id: r for r in embeddings.near_duplicates(spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<float>")).collect()}
    good = [i for i, v in enumerate(x) if v and None not in v and np.isfinite(v).all() and any(v) and len(v) == 16]
    a = np.array([x[i] for i in good], dtype=np.float64)
    norm = np.sqrt((a * a).sum(axis=1))
    near = (a @ a.T) / np.outer(norm, norm) >= 0.9
    part = unite(len(x), [(good[i], good[j]) for i, j in zip(*np.nonzero(near), strict=True)])
    links = dict.fromkeys(range(len(x)), 0) | {i: int(near[k].sum()) - 1 for k, i in enumerate(good)}
    assert {i: (r.n_links, r.component_id, r.kept) for i, r in got.items()} == {i: (links[i], part[i], part[i] == i) for i in links}


def test_embedding_edge_tables(spark):
    schema = "vec_id long, embedding array<double>"
    assert embeddings.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = embeddings.near_duplicates(spark.createDataFrame([(None, [1.0]), (1, [1.0]), (1, [1.0])], schema)).collect()
    assert sorted((r.vec_id or -1, r.n_links, r.kept) for r in rows) == [(-1, 0, False), (1, 1, True), (1, 1, True)]


def test_embedding_lengths_change_no_link(spark):
    x = [[1e200, 1e200], [1e200, 1e200], [1e-200, 1e-200], [1.0, 1.0], [5e-324, 5e-324], [1.7e308, 1.6e308], [1e200, -1e200], [0.0, 0.0], [1e-300, 0.0], [3.0, 0.0]]
    rows = embeddings.near_duplicates(spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in rows} == {
        **dict.fromkeys((0, 1, 2, 3, 4, 5), (5, 0)), 6: (0, 6), 7: (0, 7), 8: (1, 8), 9: (1, 8)
    }


def test_url_filter_matches_sql(spark):
    ok, message, _ = oracle_check.compare(spark, oracle_check.duck(SF_SMALL), "op9", urlfilter.op9_url_filter, urlfilter.OP9_SQL, SF_SMALL)
    assert ok, message


def test_url_edges(spark):
    urls = ["http://EXAMPLE.com/en/x", "https://www.example.com/en/", "ftp://a.www.example.com/en/q?x#y", "http://x.net/fr/", "http://x.net", "http://notexample.com/en/", "x", None, "", "http://", "://com/a", "http://a.com", "http://Casino.org?x://y", "http://b.org#/en/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "1 as host", "2 as h1", "'q' as shard")
    listed = spark.createDataFrame([("casino.org",), (None,)], "key string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(pages, listed).collect()}
    assert got[0] == ("example.com", "/en/x", "example.com/en/", "block") and got[1][2:] == ("www.example.com/en/", "allow")
    assert got[2] == ("a.www.example.com", "/en/q", "www.example.com/en/", "allow") and got[3][2:] == ("net/fr/", "block")
    assert got[4] == ("x.net", "", None, "allow") and got[5][2:] == ("com/", "allow")
    assert got[6] == ("", "", None, "block") and got[7] == got[8] == got[9] == got[6]  # the empty host is listed here
    assert got[10] == ("com", "/a", "com/", "allow") and got[11][2:] == (None, "allow")
    assert got[12] == ("casino.org", "", None, "block") and got[13] == ("b.org", "", None, "allow")
    assert urlfilter.judge(pages.limit(0), listed).count() == 0


def test_cascade_is_exact(spark, monkeypatch):
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, (20_000, 2), dtype=np.uint64)
    listed = rng.random(20_000) < 0.2
    levels = urlfilter.cascade(keys, listed)
    assert len(levels) > 2 and (urlfilter.member(levels, keys) == listed).all()
    monkeypatch.setattr(urlfilter, "PER_SHARD", 50)
    monkeypatch.setattr(urlfilter, "BROADCAST_BYTES", 40)  # several passes
    rows = spark.range(500).selectExpr("id", "concat('k', id) as key_text")
    marked = urlfilter.mark_listed(rows, "key_text", spark.range(0, 500, 3).selectExpr("concat('k', id) as key"))
    assert {r.id for r in marked.where("listed").collect()} == set(range(0, 500, 3)) and marked.count() == 500


def test_tool_calls(spark):
    call = lambda i, **k: {"id": i, "name": "search", "arguments": {"query": "q"}, **k}
    say = lambda *calls: json.dumps({"content": "x", "tool_calls": list(calls)})
    answer = lambda i, c: json.dumps({"tool_call_id": i, "content": c})
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", say(call("c", depends_on=["b"]), call("b", arguments={"query": {"$ref": "a"}}), call("a"))),
        (1, 2, "tool", answer("a", {"z": 1, "b": [1.5, "é"]})), (1, 3, "tool", answer("a", "again")), (1, 4, "tool", answer("x", None)),
        (2, 0, "assistant", say(call("p", depends_on=["q"]), call("q", depends_on=["p"]), call("r", depends_on=["nowhere"]))),
        (2, 1, "assistant", say(call("r"), call("s", arguments='{"limit":2,"query":"t"}'), call("t", arguments="{"), call(None), {"id": "u", "name": "other"})),
        (3, 0, "assistant", "{not json"), (3, 1, None, None), (None, 0, "assistant", say(call("a"))), (3, 2, "tool", '{"tool_call_id": "\\ud800", "content": 1e999}'),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as kind", "2 as level")
    out = toolcalls.link_tool_calls(df).collect()
    calls = {(r.conv_id, r.call_id): r for r in out if r.kind == "call"}
    assert {k[1]: r.level for k, r in calls.items() if k[0] == 1} == {"a": 0, "b": 1, "c": 2}
    assert calls[1, "a"].linked and calls[1, "a"].json == '{"arguments":{"query":"q"},"id":"a","name":"search","result":{"b":[1.5,"é"],"z":1}}'
    assert calls[1, "b"].error == "query: not string" and not calls[1, "c"].linked
    assert calls[2, "p"].error == calls[2, "q"].error == "cycle" and calls[2, "p"].level is None
    assert calls[2, "r"].turn == 0 and calls[2, "r"].level == 0 and calls[2, "s"].valid
    assert calls[2, "t"].error == "arguments: not JSON" and calls[2, "u"].error == "name: unknown"
    kinds = sorted(r.kind for r in out if r.kind != "call")
    assert kinds == ["message"] * 8 + ["orphan_result", "repeated_call", "repeated_result", "unkeyed_call", "unkeyed_call"]
    assert all(json.loads(r.json) is not None for r in out if r.kind == "message")
    twice = toolcalls.link_tool_calls(df.where("conv_id = 1").union(df.where("conv_id = 1"))).collect()
    assert sorted(r.kind for r in twice).count("repeated_call") == 3 and sum(r.kind == "repeated_result" for r in twice) == 4
    assert toolcalls.link_tool_calls(df.limit(0)).count() == 0


def test_deep_json_is_an_error_of_its_row(spark):
    deep = lambda n: "[" * n + "]" * n
    call = lambda a: json.dumps({"content": "x", "tool_calls": [{"id": "a", "name": "measure", "arguments": a}]})
    rows = [(i, 0, "assistant", call('{"values":[1],"of":{"x":' + deep(n) + "}}")) for i, n in enumerate((400, 600, 1500, 9000, 60_000))]
    rows += [(10 + i, 0, role, '{"tool_call_id":"a","content":' + deep(n) + "}") for i, (role, n) in enumerate([("tool", 1500), ("assistant", 9000), ("tool", 60_000), ("tool", 300)])]
    inside = '{"content":"x","tool_calls":[{"id":"a","name":"measure","arguments":{"values":[1],"of":{"x":' + deep(1500) + "}}}]}"
    out = toolcalls.link_tool_calls(spark.createDataFrame([*rows, (20, 0, "assistant", inside)], "conv_id long, turn long, role string, text string")).collect()
    errors = {r.conv_id: r.error for r in out if r.kind == "call"}
    assert errors == {0: None, **dict.fromkeys((1, 2, 3, 4), "arguments: nested too deeply")}
    assert {r.conv_id: r.error for r in out if r.conv_id >= 10 and r.kind == "message"} == dict.fromkeys((10, 11, 12, 20), "nested too deeply")
    assert [r.kind for r in out if r.conv_id == 13] == ["orphan_result"]


def test_random_dependencies_against_a_plain_sort(spark):
    rng = np.random.default_rng(4)
    rows, want = [], {}
    for conv in range(12):
        n = int(rng.integers(2, 9))
        needs = {i: sorted({int(j) for j in rng.integers(0, n, rng.integers(0, 3)) if conv % 3 == 0 or j < i}) for i in range(n)}
        calls = [{"id": f"c{i}", "name": "search", "arguments": {"query": "q"}, "depends_on": [f"c{j}" for j in needs[i]]} for i in rng.permutation(n).tolist()]
        rows.append((conv, 0, "assistant", json.dumps({"content": "", "tool_calls": calls})))
        level, left = {}, set(range(n))
        while ready := [i for i in left if all(j in level for j in needs[i])]:
            level |= {i: max((level[j] + 1 for j in needs[i]), default=0) for i in ready}
            left -= set(ready)
        want |= {(conv, f"c{i}"): level.get(i) for i in range(n)}
    out = toolcalls.link_tool_calls(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {(r.conv_id, r.call_id): r.level for r in out if r.kind == "call"} == want
    assert {k for k, v in want.items() if v is None} == {(r.conv_id, r.call_id) for r in out if r.error == "cycle"}


def test_tool_call_query_covers_the_table(spark):
    table = read_table(spark, SF_SMALL, "conversations")
    out = toolcalls.op1_tool_calls(spark, SF_SMALL)
    assert out.where("kind = 'message'").count() == table.count()
    want = sum(len(r.text or "") % 4 + 1 for r in table.where("role = 'assistant'").collect())
    assert out.where("kind = 'call'").count() == want and out.where("kind = 'call' and linked and valid").count() > 0
