"""Discovery and catalog over arrivals, contracts, delta gold, the event log."""

import datetime as dt
import json
import os
import shutil

import pytest
from conftest import DATA, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.contracts import ColumnRule, accepted, all_typed, apply_contract, refused
from tidemark.operators.drift import infer_types, widened
from tidemark.operators.sales import as_of_literal, clean_sales
from tidemark.operators.segments import customer_segments
from tidemark.plans.discovery_job import discovered, evolve_catalog, live_arrivals, profiles, update_discovery
from tidemark.plans.sales_job import process_sales, run_sales_job
from tidemark.schemas import RAW_SALES
from tidemark.sources.files import read_raw
from tidemark.sources.layouts import column_names, layouts, list_files, read_layout, read_mixed
from tidemark.streaming.deltas import due, fold_gold, ingest_deltas, merged_gold, merged_segments
from tidemark.streaming.event_log import read_event_log, read_run_events, record_run_event, stream_event_log
from tidemark.streaming.ingest import current_segments, ingest_and_refresh, stream_segments

AS_OF = "2024-06-01 00:00:00"


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


# ---------------------------------------------------------------- layouts


def test_column_names():
    assert column_names('﻿Id,"a,b" ,,id') == ("id", "a,b", "_c2", "id3")
    assert column_names("") == ()


def test_files_with_different_headers(spark, tmp):
    put(f"{tmp}/in/a.csv", "sale_id,customer_id,amount\n1,10,5.50\n2,11,x\n")
    put(f"{tmp}/in/b c/b.csv", 'AMOUNT,"Sale_Id",extra\n7,"3",z\n')
    put(f"{tmp}/in/empty.csv", "")
    put(f"{tmp}/in/only_header.csv", "sale_id\n")
    put(f"{tmp}/in/notes.txt", "not,a,table\n")
    got = read_mixed(spark, f"{tmp}/in", RAW_SALES)
    assert got.schema.names == RAW_SALES.names
    out = {r.sale_id: (r.customer_id, r.amount and float(r.amount), r.product_id) for r in got.collect()}
    assert out == {"1": ("10", 5.5, None), "2": ("11", None, None), "3": (None, 7.0, None)}
    assert read_mixed(spark, f"{tmp}/in", RAW_SALES, pattern="*.none").count() == 0


# ---------------------------------------------------------------- discovery


def full_pass(spark, raw):
    files = {r.file: r.path for r in list_files(spark, raw).collect()}
    whole = None
    for layout in layouts(spark, files):
        part = read_layout(spark, layout).drop("_file")
        whole = part if whole is None else whole.unionByName(part, allowMissingColumns=True)
    return {tuple(r) for r in infer_types(whole).collect()}


def found(spark, store):
    return {tuple(r) for r in discovered(spark, store).drop("place").collect()}


def test_discovery_reads_new_files_only_and_follows_deletes(spark, tmp):
    raw, store, db = f"{tmp}/raw", f"{tmp}/store", "disc_" + os.path.basename(tmp).replace("-", "_")
    put(f"{raw}/1/a.csv", "id,when,flag\n1,2024-01-01,true\n2,2024-01-02,false\n")
    put(f"{raw}/1/b.csv", "id,when,flag\n3,2024-01-03,true\n")
    assert update_discovery(spark, raw, store) == 0
    assert found(spark, store) == full_pass(spark, raw)
    first = evolve_catalog(spark, store, db, "t")
    assert {r.column_name: r.change for r in first.collect()} == {"id": "added", "when": "added", "flag": "added"}
    assert update_discovery(spark, raw, store) is None  # nothing new

    put(f"{raw}/2/c.csv", "id,price,when\n99999999999999999999,1.5,2024-01-04 10:00:00\n")
    put(f"{raw}/2/d.csv", "ID\nx9\n")
    assert update_discovery(spark, raw, store) == 1
    second = profiles(spark, store).where("arrival = 1 and column_name is null")
    assert {os.path.basename(r.file): r.n for r in second.collect()} == {"c.csv": 1, "d.csv": 1}  # no file of before
    assert found(spark, store) == full_pass(spark, raw)
    drift = {r.column_name: (r.old_type, r.new_type, r.change) for r in evolve_catalog(spark, store, db, "t").collect()}
    assert drift == {
        "id": ("bigint", "string", "type_changed"), "when": ("date", "timestamp", "type_changed"),
        "flag": ("boolean", "boolean", "unchanged"), "price": (None, "double", "added"),
    }
    table = spark.table(f"{db}.t")
    assert table.columns == ["id", "when", "flag", "price"]
    assert sorted(r.id for r in table.collect()) == ["1", "2", "3", "99999999999999999999", "x9"]

    os.remove(f"{raw}/2/d.csv")  # the only text: ids are numbers again
    put(f"{raw}/1/a.csv", "id,when\n1,2024-01-01\n5,\n6,2024-01-09\n")  # changed, and without flags
    os.remove(f"{raw}/1/b.csv")
    assert update_discovery(spark, raw, store) == 2
    assert live_arrivals(spark, store) == ([2], [0, 1, 2])
    assert found(spark, store) == full_pass(spark, raw)
    drift = {r.column_name: r.change for r in evolve_catalog(spark, store, db, "t").collect()}
    assert drift == {"id": "type_changed", "when": "unchanged", "flag": "removed", "price": "unchanged"}
    assert dict(spark.table(f"{db}.t").dtypes) == {"id": "decimal(38,0)", "when": "timestamp", "price": "double"}
    assert sorted(int(r.id) for r in spark.table(f"{db}.t").collect()) == [1, 5, 6, 99999999999999999999]
    again = evolve_catalog(spark, store, db, "t")
    assert {r.change for r in again.collect()} == {"unchanged"}

    # A run that failed before its commit is not seen, and is written over.
    put(f"{raw}/3/e.csv", "id,late\n8,1\n")
    assert update_discovery(spark, raw, store) == 3
    shutil.rmtree(f"{store}/commits/arrival=3")
    assert live_arrivals(spark, store)[0] == [2] and "late" not in {r[0] for r in found(spark, store)}
    assert update_discovery(spark, raw, store) == 3
    assert found(spark, store) == full_pass(spark, raw)
    spark.sql(f"DROP DATABASE {db} CASCADE")


VALUES = st.sampled_from(["1", "-7", "007", "12345678901234567890", "1.5", "2e3", "2024-01-01", "2024-02-30", "2024-01-01 10:00:00", "true", "FALSE", "x", "", None])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.lists(VALUES, min_size=1, max_size=4), st.lists(VALUES, min_size=1, max_size=4)), min_size=10, max_size=10))
def test_types_widen_as_a_lattice(spark, pairs):
    """The type of two sets of values is the join of their types (columns without a value are below all)."""
    def types(pick):
        n = max(len(pick(p)) for p in pairs)
        data = [tuple(dict(enumerate(pick(p))).get(i) for p in pairs) for i in range(n)]
        df = spark.createDataFrame(data, ", ".join(f"c{i} string" for i in range(len(pairs))))
        return {r.column_name: r.inferred_type if r.non_null else None for r in infer_types(df).collect()}

    a, b, both = types(lambda p: p[0]), types(lambda p: p[1]), types(lambda p: p[0] + p[1])
    df = spark.createDataFrame([(c, a[c], b[c]) for c in a], "c string, a string, b string")
    assert {r.c: r.w for r in df.select("c", widened(F.col("a"), F.col("b")).alias("w")).collect()} == both
    assert {r.c: r.w for r in df.select("c", widened(F.col("b"), F.col("a")).alias("w")).collect()} == both


# ---------------------------------------------------------------- contracts

RULES = (
    ColumnRule("i", "int", required=True), ColumnRule("d", "decimal(5,2)", low="0", high="500"), ColumnRule("f", "double"),
    ColumnRule("t", "date", date_format="yyyy-MM-dd"), ColumnRule("b", "boolean"), ColumnRule("s", "string", max_length=3, allowed=("a", "bb", "long")),
)


def test_contract_gives_every_value_its_reason(spark):
    data = [
        ("1", "1.005", "1e3", "2024-02-29", "true", "a"), (" 007 ", "+5", "-0.5", None, "FALSE", None),
        ("3000000000", "1000", "1e999", "2024-02-30", "yes!", "long"), ("x", "-0.01", "NaN", "29.02.2024", "", "zz"),
        (None, "501", "Infinity", "", None, ""), ("1.5", "abc", "1,5", "0000-00-00", "maybe", "bb"),
    ]
    df = spark.createDataFrame(data, "i string, d string, f string, t string, b string, s string").selectExpr("*", "1 as reason", "2 as value")
    out = apply_contract(df, RULES)
    assert dict(out.dtypes)["d"] == "decimal(5,2)"
    got = [[(x.column_name, x.reason) for x in r.reasons] for r in out.collect()]
    assert got == [
        [], [],
        [("i", "out_of_range"), ("d", "out_of_range"), ("f", "out_of_range"), ("t", "broken"), ("b", "broken"), ("s", "too_long")],
        [("i", "broken"), ("d", "out_of_range"), ("f", "broken"), ("t", "broken"), ("s", "not_allowed")],
        [("i", "missing"), ("d", "out_of_range"), ("f", "broken")],
        [("i", "broken"), ("d", "broken"), ("f", "broken"), ("t", "broken"), ("b", "broken")],
    ]
    first = out.collect()[1]
    assert (first.i, float(first.d), first.b, first.reason, first.value) == (7, 5.0, False, 1, 2)
    assert accepted(out).count() == 2 and refused(out).count() == sum(map(len, got))
    assert df.where(all_typed(RULES, {r.name: F.col(r.name) for r in RULES})).count() == 2
    lacking = apply_contract(df.drop("i"), RULES)
    assert all("missing" in [x.reason for x in r.reasons] for r in lacking.collect())
    assert apply_contract(df.limit(0), RULES).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=40) | st.decimals().map(str) | st.integers().map(str) | st.dates().map(str), min_size=1, max_size=30))
def test_no_value_fails_a_contract(spark, texts):
    kinds = ("tinyint", "int", "bigint", "decimal(10,2)", "decimal(38,0)", "float", "double", "date", "timestamp", "boolean", "string")
    rules = tuple(ColumnRule(f"c{i}", k, low="0" if k == "int" else None) for i, k in enumerate(kinds))
    df = spark.createDataFrame([(t.replace("\x00", "") if t.isprintable() else "?",) * len(kinds) for t in texts], ", ".join(f"c{i} string" for i in range(len(kinds))))
    # Python has no year 0, nor years after 9999.
    out = apply_contract(df, rules).withColumns({f"c{i}": F.col(f"c{i}").cast("string") for i in range(len(kinds))}).collect()
    assert len(out) == len(texts)
    for r in out:
        for i in range(len(kinds) - 1):
            assert (r[f"c{i}"] is None or i == 1) or not any(x.column_name == f"c{i}" for x in r.reasons)


HUGE = "sale_id,customer_id,product_id,product_name,amount,sale_date\n91,1,p,n,12345678901234567.00,2024-01-23\n92,2,p,n,99999999999999999999999999.00,2024-01-23\n93,1,p,n,10.00,2024-01-24\n"


def test_one_huge_amount_fails_no_job(spark, tmp):
    put(f"{tmp}/raw/sales/a.csv", HUGE)
    shutil.copy(f"{DATA}/sales.csv", f"{tmp}/raw/sales/b.csv")
    summary = run_sales_job(spark, f"{tmp}/raw", f"{tmp}/out", AS_OF)
    assert summary["status"] == "SUCCESS" and summary["records_processed"] == 9
    rejects = {r.sale_id: r.reject_reason for r in spark.read.parquet(f"{tmp}/out/rejects/sales").collect()}
    assert rejects["91"] == "amount_out_of_range" and len(rejects) == 2

    put(f"{tmp}/in/a.csv", HUGE)
    for _ in range(2):  # and again after a restart
        ingest_and_refresh(spark, f"{tmp}/in", f"{tmp}/staged", f"{tmp}/gold", f"{tmp}/ck1", as_of=AS_OF)
        stream_segments(spark, f"{tmp}/in", f"{tmp}/updates", f"{tmp}/ck2")
        ingest_deltas(spark, f"{tmp}/in", f"{tmp}/deltas", f"{tmp}/ck3")
    assert [r.customer_id for r in current_segments(spark, f"{tmp}/updates").collect()] == ["1"]
    assert merged_gold(spark, f"{tmp}/deltas", AS_OF).count() == 1


# ---------------------------------------------------------------- delta gold


def drop(spark, folder, condition):
    df = read_raw(spark, f"{DATA}/sales.csv", RAW_SALES).where(condition)
    df.coalesce(1).write.option("header", "true").csv(folder)


def equals_one_shot(spark, store, max_rows=1 << 40):
    full = process_sales(clean_sales(read_raw(spark, f"{DATA}/sales.csv", RAW_SALES), AS_OF), "window")
    got = merged_gold(spark, store, AS_OF, max_rows=max_rows).select(*full.columns)
    return got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0


def same_segments(spark, store):
    full = customer_segments(clean_sales(read_raw(spark, f"{DATA}/sales.csv", RAW_SALES)))
    cols = ["customer_id", "total_spent", "total_orders", "avg_order_value", "first_purchase_date", "last_purchase_date", "customer_segment"]
    return rows(merged_segments(spark, store), *cols) == rows(full, *cols)


@pytest.mark.parametrize("max_rows", [1, 1 << 40])
def test_delta_gold_equals_one_shot(spark, tmp, max_rows):
    raw, store, ckpt = f"{tmp}/raw", f"{tmp}/store", f"{tmp}/ckpt"
    with pytest.raises(ValueError, match="no batches"):
        merged_segments(spark, store)
    drop(spark, f"{raw}/a", "sale_id <= 4")
    ingest_deltas(spark, raw, store, ckpt)
    assert due(spark, store)
    assert fold_gold(spark, store, AS_OF) == 0 and not due(spark, store)
    assert os.listdir(f"{store}/state") == []
    drop(spark, f"{raw}/b", "sale_id in (5, 6)")
    ingest_deltas(spark, raw, store, ckpt)
    # A batch writes its own rows and customers, and nothing else changes.
    assert spark.read.parquet(f"{store}/rows/batch_id=1").count() == 2
    assert spark.read.parquet(f"{store}/state/batch_id=1").count() == 2
    assert due(spark, store, 0.6) and not due(spark, store, 0.7)
    drop(spark, f"{raw}/c", "sale_id > 6")
    ingest_deltas(spark, raw, store, ckpt)
    assert equals_one_shot(spark, store, max_rows) and same_segments(spark, store)
    assert fold_gold(spark, store, AS_OF, max_rows=max_rows) == 2
    assert equals_one_shot(spark, store, max_rows) and same_segments(spark, store)
    assert fold_gold(spark, store, AS_OF) == 2  # nothing new
    with pytest.raises(ValueError, match="another checkpoint"):
        ingest_deltas(spark, raw, store, f"{tmp}/ckpt2")


def test_delta_gold_leaves_other_customers_alone(spark, tmp):
    raw, store, ckpt = f"{tmp}/raw", f"{tmp}/store", f"{tmp}/ckpt"
    drop(spark, f"{raw}/a", "sale_id <> 5")
    ingest_deltas(spark, raw, store, ckpt)
    fold_gold(spark, store, "2020-01-01 00:00:00")
    drop(spark, f"{raw}/b", "sale_id = 5")
    ingest_deltas(spark, raw, store, ckpt)
    # Folded rows keep the time they were processed at: only customer 2's new sale is new.
    times = {r.customer_id: r.t for r in merged_gold(spark, store, AS_OF).groupBy("customer_id").agg(F.max("processed_timestamp").alias("t")).collect()}
    assert times["2"] == dt.datetime(2024, 6, 1) and {times[c] for c in times if c != "2"} == {dt.datetime(2020, 1, 1)}


def test_replayed_delta_batch_is_idempotent(spark, tmp):
    raw, store, ckpt = f"{tmp}/raw", f"{tmp}/store", f"{tmp}/ckpt"
    drop(spark, f"{raw}/a", "true")
    ingest_deltas(spark, raw, store, ckpt)
    for name in ("0", ".0.crc"):
        if os.path.exists(f"{ckpt}/commits/{name}"):
            os.remove(f"{ckpt}/commits/{name}")
    os.remove(f"{store}/state/batch_id=0/_SUCCESS")  # it stopped within the batch's last write
    ingest_deltas(spark, raw, store, ckpt)
    assert equals_one_shot(spark, store) and same_segments(spark, store)


# ---------------------------------------------------------------- event log


def bus_event(i, time):
    return json.dumps({"event_id": i, "body": json.dumps({"source": "aws.s3", "detail-type": "Object Created", "time": time, "detail": {"bucket": {"name": "b"}, "object": {"key": f"sales/{i}.csv"}}})})


def test_event_log_holds_each_event_once(spark, tmp):
    day = lambda d: f"2024-01-{d:02d}T00:00:00"
    put(f"{tmp}/in/1.json", "\n".join(bus_event(i, day(1)) for i in (1, 2, 2, 3)) + "\n")
    run = lambda: stream_event_log(spark, f"{tmp}/in", f"{tmp}/log", f"{tmp}/ck", as_of_literal(AS_OF), delay="5 days")
    run()
    put(f"{tmp}/in/2.json", "\n".join(bus_event(i, day(2)) for i in (4, 3, 1, 5)) + "\n")
    run()
    ids = lambda: sorted(r.event_id for r in read_event_log(spark, f"{tmp}/log").collect())
    assert ids() == [1, 2, 3, 4, 5]
    last = max(int(n) for n in os.listdir(f"{tmp}/ck/commits") if n.isdigit())
    for name in (f"{last}", f".{last}.crc"):  # the last batch's commit is lost: it runs again
        if os.path.exists(f"{tmp}/ck/commits/{name}"):
            os.remove(f"{tmp}/ck/commits/{name}")
    run()
    assert ids() == [1, 2, 3, 4, 5]
    run()
    assert ids() == [1, 2, 3, 4, 5]


def test_a_rerun_replaces_its_events(spark, tmp):
    path = f"{tmp}/events"
    for n in (1, 2):
        record_run_event(path, "run-1", "ETL Job Completed", spark.createDataFrame([(n,)], "records long"))
    record_run_event(path, "run-2", "ETL Job Completed", spark.createDataFrame([(7,)], "records long"))
    record_run_event(path, "run-2", "ETL Job Failed", spark.createDataFrame([("x",)], "error string"))
    got = sorted((r.run_id, r.event_type, r.detail) for r in read_run_events(spark, path).collect())
    assert got == [
        ("run-1", "ETL Job Completed", '{"records":2}'), ("run-2", "ETL Job Completed", '{"records":7}'), ("run-2", "ETL Job Failed", '{"error":"x"}')
    ]
