import random
import re
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from session_confs import configured
from daybook.operators import kpis, sales

ORDERS = "order_id bigint, user_id bigint, created_at string, status string"
ITEMS = "id bigint, order_id bigint, product_id bigint, sale_price string, status string"
PRODUCTS = "id bigint, category string"


def frames(spark, orders, items, products, money="float32"):
    return (
        sales.prepare_items(spark.createDataFrame(items, ITEMS), money),
        sales.prepare_orders(spark.createDataFrame(orders, ORDERS)),
        sales.prepare_products(spark.createDataFrame(products, PRODUCTS)),
    )


def day_rows(df):
    return {None if r.order_date is None else str(r.order_date): r for r in df.collect()}


def category_rows(df):
    return {(r.category, None if r.order_date is None else str(r.order_date)): r for r in df.collect()}


def test_small_example(spark):
    """Five items of three orders in three categories; one item returned."""
    orders = [(i, 100 + i, "2025-01-01", "done") for i in (1, 2, 3)]
    items = [
        (1, 1, 1, "10.0", "completed"),
        (2, 1, 1, "15.0", "completed"),
        (3, 2, 2, "20.0", "completed"),
        (4, 2, 2, "25.0", "returned"),
        (5, 3, 3, "30.0", "completed"),
    ]
    i, o, p = frames(spark, orders, items, [(1, "A"), (2, "B"), (3, "C")])
    day = kpis.order_daily_kpis(i, o).first()
    assert (day.total_orders, day.total_revenue, day.total_items_sold) == (3, 100.0, 5)
    assert (day.return_rate, day.unique_customers) == (0.3333, 3)
    got = {r.category: r for r in kpis.category_daily_kpis(i, o, p).collect()}
    assert {c: r.daily_revenue for c, r in got.items()} == {"A": 25.0, "B": 45.0, "C": 30.0}
    assert got["B"].avg_return_rate == 1.0 and got["A"].avg_order_value == 25.0


def test_edge_cases(spark):
    orders = [
        (1, 10, "2025-01-01 23:59:59", "x"),
        (1, 10, "2025-01-01 23:59:59", "x"),  # the same order again
        (2, 11, "2025-01-02 00:00:00", "x"),
        (3, 12, "2025-01-03", "x"),
        (4, 13, "2025-01-03", "x"),  # no item
        (5, None, "garbage", "x"),
        (6, None, "2025-01-04", "x"),
    ]
    items = [
        (1, 1, 100, "19.99", "done"),
        (2, 1, 100, "19.99", "Returned"),
        (3, 1, 100, "19.99", None),
        (4, 2, 999, "5.00", "done"),  # unknown product
        (5, 2, 100, "abc", "returned"),
        (6, 2, 100, "1.00", "returned"),
        (None, 3, 101, "7.00", "done"),  # no item id, and a product without category
        (8, 999, 100, "8.00", "done"),  # unknown order
        (9, 5, 100, "2.00", "done"),
        (10, 6, 100, "3.00", "done"),
        (11, None, 100, "3.00", "done"),
    ]
    for money in ("float32", "decimal"):
        i, o, p = frames(spark, orders, items, [(100, "Toys"), (101, None)], money)
        days = day_rows(kpis.order_daily_kpis(i, o))
        assert set(days) == {"2025-01-01", "2025-01-02", "2025-01-03", "2025-01-04", None}
        first = days["2025-01-01"]
        # Doubled sums, single orders and buyers.
        assert (float(first.total_revenue), first.total_items_sold) == (119.94, 6)
        assert (first.total_orders, first.unique_customers, first.return_rate) == (1, 1, 0.0)
        second = days["2025-01-02"]
        assert (float(second.total_revenue), second.total_items_sold, second.return_rate) == (6.0, 3, 2.0)
        assert (float(days["2025-01-03"].total_revenue), days["2025-01-03"].total_items_sold) == (7.0, 0)
        assert days["2025-01-04"].unique_customers == 0
        by = category_rows(kpis.category_daily_kpis(i, o, p))
        assert set(by) == {
            ("Toys", "2025-01-01"),
            ("Toys", "2025-01-02"),
            (None, "2025-01-03"),
            ("Toys", None),
            ("Toys", "2025-01-04"),
        }
        toys = by["Toys", "2025-01-02"]
        assert (float(toys.daily_revenue), float(toys.avg_order_value), toys.avg_return_rate) == (1.0, 1.0, 2.0)


def test_price_in_both_money_modes(spark):
    orders, items = [(1, 1, "2025-01-01", "x")], [(n, 1, 1, "19.99", "x") for n in range(3)]
    for money in ("float32", "decimal"):
        i, o, _ = frames(spark, orders, items, [(1, "A")], money)
        assert float(kpis.order_daily_kpis(i, o).first().total_revenue) == 59.97


def brute_force(orders, items, products):
    """Both tables by nested loops over exact cents."""
    days = defaultdict(lambda: [set(), 0, 0, 0, set()])
    cats = defaultdict(lambda: [set(), 0, 0])
    for item, order_id, product, price, status in items:
        cents, returned = int(Decimal(price) * 100), status == "returned"
        for oid, user, day, _ in orders:
            if oid != order_id:
                continue
            d = days[day]
            d[0].add(oid)
            d[1] += cents
            d[2] += 1
            d[3] += returned
            d[4].add(user)
            for pid, category in products:
                if pid == product:
                    c = cats[category, day]
                    c[0].add(oid)
                    c[1] += cents
                    c[2] += returned
    return days, cats


@pytest.mark.parametrize("repeats", [False, True])
def test_against_brute_force(spark, repeats):
    """A hot order, product, day and buyer each hold a third of the rows; keys may repeat."""
    rng = random.Random(7)
    hot = lambda n: 1 if rng.random() < 0.34 else rng.randrange(1, n)
    ids = [hot(40) for _ in range(60)] if repeats else range(1, 41)
    orders = [(i, hot(12), f"2025-01-{hot(9):02d}", "x") for i in ids]
    items = [
        (n, hot(45), hot(14), f"{rng.randrange(1, 10**5) / 100:.2f}", rng.choice(["returned", "done"]))
        for n in range(400)
    ]
    products = [(i, f"C{hot(4)}") for i in (list(range(1, 12)) + ([1, 2] if repeats else []))]
    days, cats = brute_force(orders, items, products)
    i, o, p = frames(spark, orders, items, products, "decimal")

    want = {d: (len(v[0]), v[1], v[2], round(v[3] / len(v[0]), 4), len(v[4])) for d, v in days.items()}

    def day_result(df):
        return {
            str(r.order_date): (
                r.total_orders,
                int(r.total_revenue * 100),
                r.total_items_sold,
                r.return_rate,
                r.unique_customers,
            )
            for r in df.collect()
        }

    lines = sales.sales_lines(i, o)
    assert day_result(kpis.order_daily_kpis(i, o)) == want
    assert day_result(kpis.order_kpis_of_lines(lines)) == want
    if not repeats:
        assert day_result(kpis.order_daily_kpis(i, o, unique_orders=True)) == want

    want = {
        k: (v[1], (2 * v[1] + len(v[0])) // (2 * len(v[0])), round(v[2] / len(v[0]), 4)) for k, v in cats.items()
    }
    for df in (kpis.category_daily_kpis(i, o, p), kpis.category_kpis_of_lines(lines, p)):
        got = {
            (r.category, str(r.order_date)): (
                int(r.daily_revenue * 100),
                int(r.avg_order_value * 100),
                r.avg_return_rate,
            )
            for r in df.collect()
        }
        assert got == want

    # Splitting the orders by day splits the table by day.
    early, late = F.col("order_date") < "2025-01-05", F.col("order_date") >= "2025-01-05"
    parts = kpis.category_daily_kpis(i, o.where(early), p).union(kpis.category_daily_kpis(i, o.where(late), p))
    whole = kpis.category_daily_kpis(i, o, p)
    assert parts.exceptAll(whole).isEmpty() and whole.exceptAll(parts).isEmpty()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, sf_dir):
    from daybook.plans import queries

    for name in ("category_daily_kpis", "order_daily_kpis", "order_daily_kpis_two_step"):
        text = plan(queries.QUERIES[name](spark, sf_dir))
        assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
        assert "Expand" not in text or name == "order_daily_kpis"
        # The scans read the used columns alone.
        scan = [line for line in text.splitlines() if "lineitem.parquet" in line and "FileScan" in line][0]
        assert "l_tax" not in scan and "l_shipdate" not in scan


def test_hot_order_is_summed_before_the_join(spark, sf_dir):
    from daybook.plans import queries

    with configured(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(queries.QUERIES["order_daily_kpis"](spark, sf_dir))
    join = text.index("SortMergeJoin")
    assert text.index("HashAggregate(keys=[order_id", join) > join
    # Items and orders are shuffled once each for the join.
    assert text.count("Exchange hashpartitioning(order_id") == 2


def test_category_table_shuffles_items_by_order_once(spark, sf_dir):
    from daybook.plans import queries

    text = plan(queries.QUERIES["category_daily_kpis"](spark, sf_dir))
    assert "BroadcastHashJoin" in text  # products
    assert text.count("Exchange hashpartitioning(order_id") <= 2  # items and orders
    with configured(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(queries.QUERIES["category_daily_kpis"](spark, sf_dir))
    assert text.count("Exchange hashpartitioning(order_id") == 2
    # Products, then orders, then one row per order and category at most for the table.
    assert text.count("Exchange hashpartitioning(product_id") == 2
    assert text.count("Exchange hashpartitioning(category") == 1


def test_hot_repeated_order_is_split(spark):
    """A third of the order rows are one order; its shuffle partition is read by several tasks."""
    from daybook import settings

    confs = {
        **settings.SKEW_SAFE,
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    with configured(spark, confs):
        rows = spark.range(0, 30000, 1, 8)
        hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
        day = F.date_add(F.lit("2000-01-01").cast("date"), F.pmod(F.xxhash64("id"), F.lit(3000)).cast("int"))
        orders = rows.select(hot.alias("order_id"), F.col("id").alias("user_id"), day.alias("order_date"))
        items = rows.select(
            F.col("id").alias("order_id"),
            F.col("id").alias("item_id"),
            (F.col("id") % 5).alias("product_id"),
            F.lit(1.0).alias("sale_price"),
            F.lit(0).alias("is_returned"),
        )
        products = spark.range(5).select(F.col("id").alias("product_id"), F.lit("A").alias("category"))
        df = kpis.category_daily_kpis(items, orders, products)
        # 10,000 copies of order 0 and 20,000 further orders, one item each.
        assert sum(r.daily_revenue for r in df.collect()) == 30000.0
        assert "skew=true" in plan(df)


@pytest.mark.parametrize("name", ["category_kpis_of_lines", "category_daily_kpis"])
def test_category_sums_of_an_order_meet_in_a_stage_of_their_own(spark, sf_dir, name):
    """The stage of the join holds one table of sums, not the sums before a shuffle and after it."""
    from daybook.plans import queries

    with configured(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(queries.QUERIES[name](spark, sf_dir))
    # A struct of order and day is named by Spark.
    assert len(re.findall(r"Exchange hashpartitioning\((_groupingexpression|order)#", text)) == 1


def test_shuffled_bytes_of_a_task_in_a_run(spark):
    """A run's tasks take a quarter of what Spark gives them, however large the tables are."""
    from daybook import settings

    with settings.during(spark, settings.RUN):
        size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert size in ("16m", str(16 << 20))
