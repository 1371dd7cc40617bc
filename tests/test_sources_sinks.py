"""Raw JSON files, catalog tables and SQL access, the event log."""

import json

from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators.drift import infer_types, schema_drift
from tidemark.operators.sales import clean_sales
from tidemark.schemas import RAW_SALES
from tidemark.sinks import ensure_database, event_rows, read_events, save_table
from tidemark.sources.files import read_raw, read_sales


def test_json_raw_files(spark, tmp):
    docs = [
        {"sale_id": "1", "customer_id": "a", "amount": "10.50", "sale_date": "2024-01-06"},
        {"sale_id": "2", "customer_id": "a", "amount": "oops", "sale_date": "2024-01-07"},
        {"sale_id": "3", "customer_id": None, "amount": "5", "sale_date": "2024-01-07"},
    ]
    import os

    os.makedirs(f"{tmp}/sales/x", exist_ok=True)
    with open(f"{tmp}/sales/x/part.json", "w") as fh:
        fh.write("\n".join(json.dumps(d) for d in docs))
    df = read_sales(spark, tmp, fmt="json")
    assert df.schema == RAW_SALES
    clean = clean_sales(df)
    assert rows(clean, "sale_id", "is_weekend") == [("1", True)]


def test_catalog_tables(spark, tmp):
    ensure_database(spark, "tm_test_db", f"{tmp}/warehouse")
    df = spark.createDataFrame([(1, 2024, "a"), (2, 2023, "b")], "id int, year int, v string")
    name = save_table(df, "tm_test_db", "t", ["year"], path=f"{tmp}/t")
    got = spark.sql(f"SELECT v FROM {name} WHERE year = 2024").collect()
    assert [r.v for r in got] == ["a"]
    plan = spark.sql(f"SELECT v FROM {name} WHERE year = 2024")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    spark.sql("DROP TABLE tm_test_db.t")


def test_event_rows_roundtrip(spark, tmp):
    detail = spark.createDataFrame([(5, 1.5)], "total_records long, pct double")
    event_rows(spark, "run-1", "Data Quality Check", detail).write.parquet(f"{tmp}/ev")
    ev = read_events(spark, f"{tmp}/ev").first()
    assert ev.run_id == "run-1" and json.loads(ev.detail) == {"total_records": 5, "pct": 1.5}


def test_schema_drift_cases(spark):
    old = spark.createDataFrame(
        [("1", "2.5", "2024-01-01", "x", "true")], "a string, b string, c string, d string, e string"
    )
    new = spark.createDataFrame(
        [("1", "2", "2024-13-01", "y", "1")], "a string, b string, c string, f string, e string"
    )
    got = {r.column_name: (r.old_type, r.new_type, r.change) for r in schema_drift(infer_types(old), infer_types(new)).collect()}
    assert got == {
        "a": ("bigint", "bigint", "unchanged"),
        "b": ("double", "bigint", "type_changed"),
        "c": ("date", "string", "type_changed"),
        "d": ("string", None, "removed"),
        "e": ("boolean", "bigint", "type_changed"),
        "f": (None, "string", "added"),
    }


def test_csv_permissive_bad_values(spark, tmp):
    with open(f"{tmp}/s.csv", "w") as fh:
        fh.write("sale_id,customer_id,product_id,product_name,amount,sale_date\n")
        fh.write("1,a,p,n,abc,2024-01-01\n2,a,p,n,12.5,2024-01-01\n")
    df = read_raw(spark, f"{tmp}/s.csv", RAW_SALES)
    assert rows(df, "sale_id", "amount") == [("1", None), ("2", __import__("decimal").Decimal("12.50"))]
    assert clean_sales(df).filter(F.col("sale_id") == "1").count() == 0


def test_cluster_conf_scales_partitions():
    from tidemark.session import cluster_conf

    small = cluster_conf(1 << 30, 8)
    big = cluster_conf(100 << 40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 24
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)


def test_null_partition_on_write(spark, tmp):
    from tidemark.sinks import write_partitioned

    df = spark.createDataFrame(
        [(1, 2024, 1), (2, None, None), (3, 2024, 2)], "sale_id int, sales_year int, sales_month int"
    )
    write_partitioned(df, f"{tmp}/p", ["sales_year", "sales_month"], spread_by=["sale_id"])
    back = spark.read.parquet(f"{tmp}/p")
    assert rows(back, "sale_id", "sales_year", "sales_month") == [(1, 2024, 1), (2, None, None), (3, 2024, 2)]
    import os

    assert "sales_year=__HIVE_DEFAULT_PARTITION__" in os.listdir(f"{tmp}/p")


def test_csv_columns_by_header_name(spark, tmp):
    with open(f"{tmp}/s.csv", "w") as fh:
        fh.write("customer_id,sale_id,channel,product_id,amount,sale_date\n")
        fh.write("a,1,web,p,10,2024-01-01\nb,2,web,p,x,2024-01-02\n")
    got = read_raw(spark, f"{tmp}/s.csv", RAW_SALES, keep_corrupt=True)
    assert got.columns == [*RAW_SALES.names, "_corrupt_record"]
    assert [(r.sale_id, r.customer_id, r.product_name, r._corrupt_record) for r in got.orderBy("sale_id").collect()] == [
        ("1", "a", None, None), ("2", "b", None, "b,2,web,p,x,2024-01-02"),
    ]


def test_csv_header_is_checked(spark, tmp):
    """A second file with another header fails the read instead of loading wrong."""
    import pytest

    for name, header in (("a", "sale_id,customer_id"), ("b", "customer_id,sale_id")):
        with open(f"{tmp}/{name}.csv", "w") as fh:
            fh.write(f"{header},product_id,product_name,amount,sale_date\na,1,p,n,10,2024-01-01\n")
    with pytest.raises(Exception):
        read_raw(spark, tmp, RAW_SALES).collect()


def test_inferred_types_of_hard_values(spark):
    values = {
        "wide": ["1", "12345678901234567890123"], "code": ["02139", "10001"], "zero": ["0", "-5"], "rate": ["1e5", "2.5"],
        "at": ["2024-01-01T10:00:00", "2024-01-02"], "bad_day": ["2024-02-30", "2024-01-01"], "none": ["", None],
        "huge": ["1" * 40, "2"], "point": ["0.5", "00.5"],
    }
    df = spark.createDataFrame(list(zip(*values.values())), ", ".join(f"{c} string" for c in values))
    got = {r.column_name: (r.inferred_type, r.non_null, r.total) for r in infer_types(df).collect()}
    want = {
        "wide": "decimal(38,0)", "code": "string", "zero": "bigint", "rate": "double", "at": "timestamp",
        "bad_day": "string", "none": "string", "huge": "double", "point": "string",
    }
    assert got == {c: (t, 0 if c == "none" else 2, 2) for c, t in want.items()}


def test_malformed_rows_quarantined(spark, tmp):
    from tidemark.operators.sales import kept_rows, stage_sales

    with open(f"{tmp}/s.csv", "w") as fh:
        fh.write("sale_id,customer_id,product_id,product_name,amount,sale_date\n")
        fh.write("1,a,p,n,abc,2024-01-01\n2,a,p,n,12.5,2024-01-01\n3,,p,n,5,2024-01-01\n")
    staged = stage_sales(read_raw(spark, f"{tmp}/s.csv", RAW_SALES, keep_corrupt=True))
    assert rows(staged, "sale_id", "reject_reason") == [("1", "malformed_row"), ("2", None), ("3", "null_customer_id")]
    bad = staged.filter(F.col("reject_reason") == "malformed_row").first()
    assert bad["_corrupt_record"] == "1,a,p,n,abc,2024-01-01"
    assert kept_rows(staged).columns == [f.name for f in RAW_SALES.fields]


def test_release_scratch_deletes_only_materialized(spark, tmp):
    import os

    from tidemark.session import materialize, release_scratch, scratch_mark

    keep = f"{tmp}/keep"
    spark.range(3).write.parquet(keep)
    earlier = materialize(spark.range(2), "earlier")  # another DataFrame still depends on it
    mark = scratch_mark()
    m = materialize(spark.range(5), "t")
    assert m.count() == 5
    released = release_scratch(spark, mark)
    assert len(released) == 1 and not os.path.exists(released[0].replace("file:", ""))
    assert os.path.exists(keep) and earlier.count() == 2


def test_read_processed_merges_schemas(spark, tmp):
    from tidemark.sources.files import read_processed

    spark.createDataFrame([(1, "a")], "id int, v string").write.parquet(f"{tmp}/t/run=1")
    spark.createDataFrame([(2, "b", 3.5)], "id int, v string, extra double").write.parquet(f"{tmp}/t/run=2")
    got = read_processed(spark, f"{tmp}/t")
    assert sorted(got.columns) == ["extra", "id", "run", "v"]
    assert rows(got, "id", "extra") == [(1, None), (2, 3.5)]


def test_register_views_sql_access(spark, tmp):
    from tidemark.sinks import register_views, write_partitioned

    df = spark.createDataFrame([(1, "a", 2024), (2, "b", 2023)], "customer_id int, v string, registration_year int")
    write_partitioned(df, f"{tmp}/customers", ["registration_year"], spread_by=["customer_id"])
    assert register_views(spark, {"processed_customers_v": f"{tmp}/customers"}) == ["processed_customers_v"]
    q = spark.sql("SELECT v FROM processed_customers_v WHERE registration_year = 2024")
    assert [r.v for r in q.collect()] == ["a"]
    assert "PartitionFilters" in q._jdf.queryExecution().executedPlan().toString()
