"""Customer cleaning, dedup, enrichment, mapping and quality metrics."""

import datetime as dt

import pytest
from conftest import DATA, rows

from tidemark.functions import age_group, email_domain, full_name
from tidemark.operators.customers import clean_customers, dedup_latest, reject_customers
from tidemark.operators.quality import customer_quality
from tidemark.schemas import PROCESSED_CUSTOMER_COLUMNS, RAW_CUSTOMERS
from tidemark.sources.files import read_raw


def raw_customers(spark, data):
    return spark.createDataFrame(data, RAW_CUSTOMERS)


def row(cid, first="A", last="B", email="a@b.com", age=30, reg=dt.date(2023, 1, 1)):
    return (cid, first, last, email, "000", age, "City", "ST", reg)


def test_readme_golden(spark):
    raw = read_raw(spark, f"{DATA}/customers.csv", RAW_CUSTOMERS)
    out = clean_customers(raw, as_of="2024-06-01 00:00:00", job_name="customer-etl")
    assert [c for c, _ in PROCESSED_CUSTOMER_COLUMNS] == out.columns
    assert rows(out, "customer_id", "full_name", "age_group", "registration_year", "email_domain") == [
        ("1", "John Doe", "Adult", 2023, "email.com"),
        ("2", "Jane Smith", "Adult", 2023, "email.com"),
        ("3", "Mike Johnson", "Middle-aged", 2022, "email.com"),
        ("4", "Sarah Williams", "Adult", 2023, "email.com"),
        ("5", "David Brown", "Adult", 2023, "email.com"),
    ]
    first = out.first()
    assert first.data_source == "customer_system" and first.etl_job_name == "customer-etl"
    assert first.processed_timestamp == dt.datetime(2024, 6, 1)


def test_age_bands_and_null(spark):
    df = spark.createDataFrame([(a,) for a in (24, 25, 44, 45, 64, 65, None)], "age int")
    got = [r[0] for r in df.select(age_group("age")).collect()]
    assert got == ["Young", "Adult", "Adult", "Middle-aged", "Middle-aged", "Senior", "Senior"]
    labelled = [r[0] for r in df.select(age_group("age", null_label="Unknown")).collect()]
    assert labelled[-1] == "Unknown"


def test_names_and_email(spark):
    df = spark.createDataFrame(
        [(None, "Doe", "nodomain"), (None, None, None), ("Ann", None, "a@b@c")],
        "first string, last string, email string",
    )
    got = [tuple(r) for r in df.select(full_name("first", "last"), email_domain("email")).collect()]
    assert got == [("Doe", ""), ("", None), ("Ann", "b@c")]


def test_dedup_keeps_latest_and_is_deterministic(spark):
    df = raw_customers(
        spark,
        [
            row("1", first="Old", reg=dt.date(2022, 1, 1)),
            row("1", first="New", reg=dt.date(2023, 6, 1)),
            row("2", first="X", reg=None),
            row("2", first="Y", reg=dt.date(2020, 1, 1)),
            row("3", first="A"),
            row("3", first="B"),
        ],
    )
    got = dict(rows(dedup_latest(df), "customer_id", "first_name"))
    assert got == {"1": "New", "2": "Y", "3": "B"}


def test_null_ids_count_and_collapse(spark):
    df = raw_customers(spark, [row(None), row(None), row(None), row("1"), row("1"), row("2")])
    m = customer_quality(df, "job").first()
    assert (m.total_records, m.null_records, m.duplicate_records) == (6, 3, 3)
    assert m.null_percentage == pytest.approx(50.0)
    assert m.duplicate_percentage == pytest.approx(50.0)
    assert clean_customers(df).count() == 2
    assert reject_customers(df).count() == 3


def test_empty_percentages_zero(spark):
    m = customer_quality(raw_customers(spark, []), "job").first()
    assert (m.total_records, m.null_percentage, m.duplicate_percentage) == (0, 0.0, 0.0)


def test_quality_from_counts_matches_operator(spark):
    from tidemark.operators.quality import quality_from_counts

    df = raw_customers(spark, [row(None), row(None), row("1"), row("1"), row("1"), row("2")])
    m = customer_quality(df, "job").first().asDict()
    kept = clean_customers(df).count()
    assert quality_from_counts("job", 6, 2, kept) == m
