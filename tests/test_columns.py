import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from daybook.functions import columns as C


def values(spark, texts, make, kind="string"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(make(F.col("x"))).collect()]


def test_order_date(spark):
    texts = [
        "2025-01-02",
        "2025-01-01 23:59:59",
        "2025-01-02T00:00:00",
        "2022-07-20 10:32:00 UTC",
        "2025-01-01T23:30:00-05:00",
        "garbage",
        "12:30:00",
        "",
        None,
    ]
    day = dt.date
    assert values(spark, texts, C.order_date) == [
        day(2025, 1, 2),
        day(2025, 1, 1),
        day(2025, 1, 2),
        day(2022, 7, 20),
        day(2025, 1, 2),
        None,
        None,
        None,
        None,
    ]


def test_price(spark):
    assert values(spark, ["10.50", "abc", None, "1e2"], C.price) == [10.5, None, None, 100.0]
    exact = values(spark, ["19.99", "abc"], lambda c: C.price(c, "decimal"))
    assert exact == [Decimal("19.99"), None]
    with pytest.raises(ValueError):
        C.price(F.lit("1"), "euros")


def test_is_returned_is_exact(spark):
    assert values(spark, ["Returned", "returned", "", None, "returned "], C.is_returned) == [0, 1, 0, 0, 0]


def test_is_csv(spark):
    names = ["orders.csv", "data.CSV", "y.Csv", "test.txt", "folder/", "folder.csv/"]
    assert values(spark, names, C.is_csv) == [True, True, True, False, False, False]


def test_base_prefix(spark):
    keys = ["", "a/", "a/b.csv", "b.csv", "a/b/c.csv", "a/b/", None]
    assert values(spark, keys, C.base_prefix) == ["", "a/", "a/", "", "a/b/", "a/b/", ""]


def test_paths(spark):
    df = spark.createDataFrame([("orders/x/a.csv",)], "key string")
    stamp = F.lit("2025-06-07 08:09:10").cast("timestamp_ntz")
    row = df.select(
        C.archive_path(F.lit("e1"), stamp, F.col("key")).alias("a"),
        C.quarantine_path(F.lit("orders"), F.col("key")).alias("q"),
    ).first()
    assert row.a == "processed/e1/20250607_080910/orders/x/a.csv"
    assert row.q == "quarantine/orders/a.csv"


def test_writer_count(spark):
    assert values(spark, [0, 999, 1000, 2999, 10_000, 999_999_999], C.writer_count, "bigint") == [1, 1, 1, 2, 10, 10]


def test_store_record(spark):
    df = spark.createDataFrame(
        [("A", dt.date(2025, 1, 2), 10.5, 25, dt.datetime(2025, 1, 2, 3, 4, 5))],
        "category string, order_date date, value double, n bigint, at timestamp_ntz",
    )
    assert tuple(C.store_record(df).first()) == (
        "A",
        "2025-01-02",
        Decimal("10.5000"),
        Decimal(25),
        "2025-01-02T03:04:05",
    )
