"""Sales cleaning, window metrics and segments: README golden rows and edge rows."""

from decimal import Decimal as D

import pytest
from conftest import DATA, rows
from pyspark.sql import functions as F

from tidemark.operators.metrics import business_metrics, order_rank, running_total, top_orders
from tidemark.operators.quality import sales_quality
from tidemark.operators.sales import clean_sales, reject_sales
from tidemark.operators.segments import attach_segments, customer_segments, segment_map
from tidemark.plans.sales_job import process_sales
from tidemark.schemas import RAW_SALES
from tidemark.sources.files import read_raw

STRATEGIES = ("window", "skew_safe")


def raw_sales(spark, data):
    """data: (sale_id, customer_id, amount, sale_date) with text ids and date text."""
    full = [(s, c, "p", "n", None if a is None else D(a), d) for s, c, a, d in data]
    return spark.createDataFrame(full, RAW_SALES)


@pytest.fixture(scope="module")
def readme_sales(spark):
    return clean_sales(read_raw(spark, f"{DATA}/sales.csv", RAW_SALES), as_of="2024-06-01 00:00:00")


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_readme_golden_metrics(spark, readme_sales, strategy):
    out = business_metrics(readme_sales, strategy=strategy)
    got = rows(
        out,
        "sale_id",
        "day_of_week",
        "is_weekend",
        "amount_category",
        "monthly_total",
        "order_rank_in_month",
        "running_total",
    )
    assert got == [
        ("1", 2, False, "Very Large", D("1375.00"), 1, D("1200.00")),
        ("2", 3, False, "Small", D("1375.00"), 3, D("1225.00")),
        ("3", 4, False, "Small", D("375.00"), 2, D("75.00")),
        ("4", 5, False, "Very Large", D("1200.00"), 1, D("1200.00")),
        ("5", 6, False, "Medium", D("375.00"), 1, D("375.00")),
        ("6", 7, True, "Large", D("500.00"), 1, D("500.00")),
        ("7", 1, True, "Large", D("800.00"), 1, D("800.00")),
        ("8", 2, False, "Medium", D("1375.00"), 2, D("1375.00")),
    ]
    avg = {r["sale_id"]: round(r["avg_order_value"], 2) for r in out.collect()}
    assert avg["1"] == 458.33 and avg["3"] == 187.5 and avg["7"] == 800.0
    yearly = {r["sale_id"]: r["yearly_total"] for r in out.collect()}
    assert yearly["1"] == D("1375.00")


def test_readme_golden_segments(spark, readme_sales):
    seg = customer_segments(readme_sales)
    assert rows(
        seg,
        "customer_id",
        "total_spent",
        "total_orders",
        "first_purchase_date",
        "customer_lifetime_days",
        "customer_segment",
    ) == [
        ("1", D("1375.00"), 3, __import__("datetime").date(2024, 1, 15), 7, "New"),
        ("2", D("375.00"), 2, __import__("datetime").date(2024, 1, 17), 2, "New"),
        ("3", D("1200.00"), 1, __import__("datetime").date(2024, 1, 18), 0, "New"),
        ("4", D("500.00"), 1, __import__("datetime").date(2024, 1, 20), 0, "New"),
        ("5", D("800.00"), 1, __import__("datetime").date(2024, 1, 21), 0, "New"),
    ]
    m = segment_map(seg).first()["customer_segments"]
    assert m == {"New": 5}


def test_amount_filter_and_bands(spark):
    df = raw_sales(
        spark,
        [
            ("1", "a", "0", "2024-01-01"),
            ("2", "a", "-5", "2024-01-01"),
            ("3", "a", None, "2024-01-01"),
            ("4", "a", "0.50", "2024-01-01"),
            ("5", "a", "99.99", "2024-01-01"),
            ("6", "a", "100", "2024-01-01"),
            ("7", "a", "499.99", "2024-01-01"),
            ("8", "a", "500", "2024-01-01"),
            ("9", "a", "999.99", "2024-01-01"),
            ("10", "a", "1000", "2024-01-01"),
            ("11", None, "10", "2024-01-01"),
        ],
    )
    got = dict(rows(clean_sales(df), "sale_id", "amount_category"))
    assert got == {
        "4": "Small",
        "5": "Small",
        "6": "Medium",
        "7": "Medium",
        "8": "Large",
        "9": "Large",
        "10": "Very Large",
    }
    q = sales_quality(df).first()
    assert (q.total_records, q.null_customer_ids, q.invalid_amounts) == (11, 1, 2)
    assert q.valid_records_percentage == pytest.approx((11 - 1 - 2) / 11 * 100)
    assert q.exact_valid_percentage == pytest.approx(7 / 11 * 100)
    reasons = dict(rows(reject_sales(df), "sale_id", "reject_reason"))
    assert reasons == {
        "1": "non_positive_amount",
        "2": "non_positive_amount",
        "3": "null_amount",
        "11": "null_customer_id",
    }


def test_empty_sales_quality_is_null(spark):
    q = sales_quality(raw_sales(spark, [])).first()
    assert q.total_records == 0 and q.valid_records_percentage is None


def test_bad_date_text(spark):
    df = clean_sales(raw_sales(spark, [("1", "a", "10", "not-a-date"), ("2", "a", "10", "2024-02-30")]))
    assert rows(df, "sale_id", "sale_date", "day_of_week", "is_weekend") == [
        ("1", None, None, False),
        ("2", None, None, False),
    ]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_window_edge_rows(spark, strategy):
    df = clean_sales(
        raw_sales(
            spark,
            [
                # same customer, same date: equal running totals
                ("1", "a", "10", "2024-03-01"),
                ("2", "a", "20", "2024-03-01"),
                ("3", "a", "5", "2024-03-02"),
                # a null date sorts first in the running total
                ("4", "a", "7", None),
                # January of two years pools into one monthly total
                ("5", "b", "100", "2023-01-10"),
                ("6", "b", "50", "2024-01-10"),
                # equal amounts in one month: lower sale_id first (text order)
                ("10", "c", "30", "2024-05-01"),
                ("9", "c", "30", "2024-05-02"),
                ("11", "c", "30", "2024-05-03"),
            ],
        )
    )
    out = business_metrics(df, strategy=strategy)
    r = {x["sale_id"]: x for x in out.collect()}
    assert r["1"]["running_total"] == r["2"]["running_total"] == D("37.00")
    assert r["4"]["running_total"] == D("7.00")
    assert r["3"]["running_total"] == D("42.00")
    assert r["5"]["monthly_total"] == r["6"]["monthly_total"] == D("150.00")
    assert (r["5"]["yearly_total"], r["6"]["yearly_total"]) == (D("100.00"), D("50.00"))
    assert [r[s]["order_rank_in_month"] for s in ("10", "11", "9")] == [1, 2, 3]
    year_month = business_metrics(df, strategy=strategy, month_scope="year_month")
    ym = {x["sale_id"]: x["monthly_total"] for x in year_month.collect()}
    assert (ym["5"], ym["6"]) == (D("100.00"), D("50.00"))


def _orders(n, total):
    """n orders whose amounts sum to ``total`` (cents exact)."""
    cents = int(round(total * 100))
    base = cents // n
    amounts = [base] * (n - 1) + [cents - base * (n - 1)]
    return [f"{a / 100:.2f}" for a in amounts]


@pytest.mark.parametrize(
    "n,total,segment",
    [
        (11, 5000.00, "High Value"),
        (11, 5000.01, "VIP"),
        (6, 1000.00, "Regular"),
        (6, 1000.01, "High Value"),
        (3, 30.0, "New"),
        (4, 40.0, "Regular"),
    ],
)
def test_segment_thresholds(spark, n, total, segment):
    data = [(str(i), "x", a, "2024-01-01") for i, a in enumerate(_orders(n, total))]
    seg = customer_segments(clean_sales(raw_sales(spark, data))).first()
    assert seg.customer_segment == segment


def test_null_sale_id_kept_not_counted(spark):
    data = [(None, "x", "10", "2024-01-01"), ("2", "x", "10", "2024-01-02")]
    clean = clean_sales(raw_sales(spark, data))
    assert clean.count() == 2
    seg = customer_segments(clean).first()
    assert (seg.total_orders, seg.total_spent) == (1, D("20.00"))


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_process_sales_matches_join(spark, readme_sales, strategy):
    expected = attach_segments(business_metrics(readme_sales, "window"), customer_segments(readme_sales))
    got = process_sales(readme_sales, strategy)
    assert sorted(got.columns) == sorted(expected.columns)
    assert got.exceptAll(expected.select(*got.columns)).count() == 0
    assert expected.select(*got.columns).exceptAll(got).count() == 0


def test_single_operators_agree(spark, readme_sales):
    full = business_metrics(readme_sales, "window")
    assert rows(order_rank(readme_sales, "skew_safe"), "sale_id", "order_rank_in_month") == rows(
        full, "sale_id", "order_rank_in_month"
    )
    assert rows(running_total(readme_sales), "sale_id", "running_total") == rows(
        full, "sale_id", "running_total"
    )
    top1 = rows(top_orders(readme_sales, 1), "sale_id")
    assert top1 == [("1",), ("4",), ("5",), ("6",), ("7",)]


def test_hot_customer_skew_safe_equals_window(spark):
    """One customer holds a third of the rows; both strategies agree and the
    skew-safe rank spreads that customer over several range slices."""
    from tidemark.operators.ranking import row_number_skew_safe
    from tidemark.operators.metrics import rank_order

    base = spark.range(0, 3000).select(
        F.col("id").cast("string").alias("sale_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 97).cast("string")).alias("customer_id"),
        F.lit("p").alias("product_id"),
        F.lit("n").alias("product_name"),
        ((F.col("id") * 7919) % 1000 + 1).cast("decimal(18,2)").alias("amount"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 60).cast("int")), "yyyy-MM-dd").alias(
            "sale_date"
        ),
    )
    df = clean_sales(base, as_of="2024-06-01 00:00:00")
    a = business_metrics(df, "window")
    b = business_metrics(df, "skew_safe")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # auto with a low threshold: the hot customer takes the skew-safe path, the rest
    # the window path, and the union equals the single-plan result.
    c = business_metrics(df, "auto", max_rows=500)
    assert c.exceptAll(a).count() == 0 and a.exceptAll(c).count() == 0
    p = process_sales(df, "auto", max_rows=500)
    w = process_sales(df, "window")
    assert p.exceptAll(w).count() == 0 and w.exceptAll(p).count() == 0
    r = order_rank(df, "auto", max_rows=100)
    assert rows(r, "sale_id", "order_rank_in_month") == rows(a, "sale_id", "order_rank_in_month")
    # The hot customer-month group is cut into several slices.
    from tidemark.session import checkpoint_root

    checkpoint_root(spark)
    hot = df.filter(F.col("customer_id") == "hot")
    sliced = (
        hot.withColumn("_g", F.struct("customer_id", "sales_month"))
        .repartitionByRange(8, F.col("_g"), *rank_order())
        .select(F.spark_partition_id().alias("p"))
        .distinct()
        .count()
    )
    assert sliced > 1
    ranked = row_number_skew_safe(hot, ["customer_id", "sales_month"], rank_order(), "rn", num_slices=8)
    assert ranked.groupBy("sales_month").agg(F.max("rn").alias("m"), F.count("*").alias("n")).filter(
        "m != n"
    ).count() == 0


def test_missing_values_are_not_checked(spark):
    """A value rule judges only rows with a value; not_null judges all."""
    from tidemark.operators.quality import Rule, check, quality_score

    df = spark.createDataFrame([(1, 5.0, "a"), (2, None, None), (3, 50.0, "z"), (None, None, "a")], "id int, x double, s string")
    rules = (
        Rule("x_range", "range", "x", low=0.0, high=10.0),
        Rule("s_known", "allowed", "s", values=("a",)),
        Rule("id_there", "not_null", "id", weight=2.0),
        Rule("id_unique", "unique", "id"),
    )
    report = check(df, rules, "t")
    got = {r.rule: (r.checked, r.failed) for r in report.collect()}
    assert got == {"x_range": (2, 1), "s_known": (3, 1), "id_there": (4, 1), "id_unique": (3, 0)}
    assert abs(quality_score(report).first().quality_score - (150 + 100 + 200 / 3 + 50) / 5) < 1e-9
