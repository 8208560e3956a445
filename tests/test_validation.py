import csv
import io

import pytest
from pyspark.sql import functions as F

from daybook.operators import validation as V

FILE = "dataset string, key string, header_line string"
GOOD = {
    "orders": "order_id,user_id,created_at,status",
    "order_items": "id,order_id,product_id,sale_price",
    "products": "id,sku,cost,category,retail_price",
}


@pytest.mark.parametrize(
    "line",
    [
        "a,b,c",
        '"order_id", user_id ,created_at,status',
        '"a, b",c',
        '"say ""hi""",x',
        '"a"b,c',
        "a,,b,",
        ' "a",b',
        '""',
        "single",
        '"a,"",b",c',
    ],
)
def test_header_names_like_a_csv_reader(spark, line):
    got = spark.createDataFrame([(line,)], "x string").select(V.header_names(F.col("x"))).first()[0]
    assert got == [c.strip() for c in next(csv.reader(io.StringIO(line)))]


def test_check_headers(spark):
    rows = [
        ("orders", "good", GOOD["orders"]),
        ("orders", "extra", GOOD["orders"] + ",note"),
        ("orders", "lacks", "order_id,user_id,created_at"),
        ("orders", "case", "Order_id,user_id,created_at,status"),
        ("order_items", "items", GOOD["order_items"]),
        ("products", "products", "retail_price,category,cost,sku,id"),
        ("products", "nothing", None),
    ]
    got = {r.key: r for r in V.check_headers(spark.createDataFrame(rows, FILE)).collect()}
    assert {k for k, r in got.items() if r.is_valid} == {"good", "extra", "items", "products"}
    assert (got["extra"].missing, got["extra"].extra) == ([], ["note"])
    assert got["extra"].issues == ["Additional fields found: ['note']"]
    assert got["lacks"].issues == ["Missing mandatory fields: ['status']"]
    assert got["case"].issues == [
        "Missing mandatory fields: ['order_id']",
        "Additional fields found: ['Order_id']",
    ]
    assert got["nothing"].issues == ["Could not read file headers"]


def verdicts(spark, rows, moved=True):
    return V.file_verdicts(V.check_headers(spark.createDataFrame(rows, FILE)), F.lit(moved))


def status(spark, rows):
    return V.validation_status(V.validation_rollup(verdicts(spark, rows))).first()


def test_verdicts_and_rollup(spark):
    rows = [
        ("orders", "a", GOOD["orders"] + ",note"),
        ("orders", "b", "x"),
        ("products", "c", GOOD["products"]),
    ]
    got = {r.key: r for r in verdicts(spark, rows).collect()}
    assert [(got[k].status, got[k].issues == []) for k in "abc"] == [
        ("passed", True),
        ("quarantined", False),
        ("passed", True),
    ]
    assert {r.key: r.status for r in verdicts(spark, rows, moved=False).collect()}["b"] == "failed"
    rollup = {r.dataset: r for r in V.validation_rollup(verdicts(spark, rows)).collect()}
    counts = {d: (r.total_files, r.passed, r.failed, r.quarantined, r.status) for d, r in rollup.items()}
    assert counts == {
        "orders": (2, 1, 1, 1, "processed"),
        "order_items": (0, 0, 0, 0, "no_files"),
        "products": (1, 1, 0, 0, "processed"),
        "all": (3, 2, 1, 1, None),
    }


def test_status(spark):
    good = [(d, d, line) for d, line in GOOD.items()]
    whole = status(spark, good)
    assert (whole.status, whole.message, whole.usable_files) == ("success", None, 3)

    part = status(spark, good + [("orders", "bad", "x")])
    assert part.status == "partial_success"
    assert part.message == "1 files failed validation and were quarantined"

    missing = status(spark, [g for g in good if g[0] == "orders"])
    assert missing.status == "failure"
    assert missing.message == "Missing required data folders: ['order_items', 'products']"

    # A dataset whose files are all bad is not missing, but nothing of it can be used.
    all_bad = status(spark, good[:2] + [("products", "bad", "x")])
    assert (all_bad.status, all_bad.usable_per_dataset) == ("partial_success", 0)

    none = status(spark, [])
    assert none.status == "failure" and len(none.missing_datasets) == 3
