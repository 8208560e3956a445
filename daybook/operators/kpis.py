"""The two daily tables.

Items are shuffled by order once. The day table sums them per order before the join: sums pass
through it unchanged (a repeated order row repeats the sums just as it would repeat the items),
and a hot order reaches the shuffle as one row per map task. The category table joins first and
then sums per order where the rows already lie; these sums, not the items, are shuffled once more.
Spark splits the part of a hot order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

def _orders() -> Column:
    return F.count_distinct("order_id")


def _cents(amount: Column) -> Column:
    """Half-up to 2 digits, in the type of the money mode."""
    return F.round(amount, 2)


def _share(part: Column, whole: Column) -> Column:
    """Half-up ratio to 4 digits; `whole` counts at least one order after an inner join."""
    return F.round(part / whole, 4)


def category_figures(lines: DataFrame) -> DataFrame:
    """Category and day from rows of (category, order_date, order_id, sale_price, is_returned)."""
    # By a struct, so that sums go through a shuffle of their own though the rows lie by order: a
    # task then holds the sums before it or those after it, not both beside the join's rows.
    order = F.struct("order_id", "order_date").alias("order")
    per_order = lines.groupBy(order, "category").agg(
        F.sum("sale_price").alias("sale_price"), F.sum("is_returned").alias("is_returned")
    ).select("order.order_date", "category", "sale_price", "is_returned")
    # A row per order, so rows count distinct orders.
    return per_order.groupBy("category", "order_date").agg(
        _cents(F.sum("sale_price")).alias("daily_revenue"),
        _cents(F.sum("sale_price") / F.count("*")).alias("avg_order_value"),
        _share(F.sum("is_returned"), F.count("*")).alias("avg_return_rate"),
    )


def order_figures(sums: DataFrame) -> DataFrame:
    """Day from rows of (order_date, order_id, user_id, sale_price, items, is_returned)."""
    return sums.groupBy("order_date").agg(
        _orders().alias("total_orders"),
        _cents(F.sum("sale_price")).alias("total_revenue"),
        F.sum("items").alias("total_items_sold"),
        _share(F.sum("is_returned"), _orders()).alias("return_rate"),
        F.count_distinct("user_id").alias("unique_customers"),
    )


def _sum_items(items: DataFrame, *by: str) -> DataFrame:
    return items.groupBy(*by).agg(
        F.sum("sale_price").alias("sale_price"),
        F.count("item_id").alias("items"),
        F.sum("is_returned").alias("is_returned"),
    )


def category_daily_kpis(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue, average order value and returned items per order, by category and order day.

    Takes prepared frames. Products come first, as they are usually few and then need no shuffle.
    """
    lines = items.select("order_id", "product_id", "sale_price", "is_returned").join(products, "product_id")
    return category_figures(lines.join(orders.select("order_id", "order_date"), "order_id"))


def order_daily_kpis(items: DataFrame, orders: DataFrame, unique_orders: bool = False) -> DataFrame:
    """Orders, revenue, items sold, returned items per order and buyers, by order day.

    Takes prepared frames. `unique_orders=True` states that no order key repeats; orders are
    then counted as rows and buyers by a group of their own, which spares the row expansion
    that two distinct counts need.
    """
    per_order = _sum_items(items, "order_id").join(orders, "order_id")
    return figures_of_single_orders(per_order) if unique_orders else order_figures(per_order)


def figures_of_single_orders(per_order: DataFrame) -> DataFrame:
    """The day table from one row per order."""
    per_buyer = per_order.groupBy("order_date", "user_id").agg(
        F.count("*").alias("orders"),
        F.sum("sale_price").alias("sale_price"),
        F.sum("items").alias("items"),
        F.sum("is_returned").alias("is_returned"),
    )
    return per_buyer.groupBy("order_date").agg(
        F.sum("orders").alias("total_orders"),
        _cents(F.sum("sale_price")).alias("total_revenue"),
        F.sum("items").alias("total_items_sold"),
        _share(F.sum("is_returned"), F.sum("orders")).alias("return_rate"),
        F.count("user_id").alias("unique_customers"),
    )


def category_kpis_of_lines(lines: DataFrame, products: DataFrame) -> DataFrame:
    """The category table from stored sales lines, which already carry their order's day."""
    return category_figures(lines.join(products, "product_id"))


def order_kpis_of_lines(lines: DataFrame, unique_orders: bool = False) -> DataFrame:
    """The day table from stored sales lines; see `order_daily_kpis` for `unique_orders`."""
    per_order = _sum_items(lines, "order_date", "order_id", "user_id")
    return figures_of_single_orders(per_order) if unique_orders else order_figures(per_order)


def category_totals(totals: DataFrame) -> DataFrame:
    """The category table from totals (category, order_date, orders, revenue, returned)."""
    return totals.select(
        "category",
        "order_date",
        _cents(F.col("revenue")).alias("daily_revenue"),
        _cents(F.col("revenue") / F.col("orders")).alias("avg_order_value"),
        _share(F.col("returned"), F.col("orders")).alias("avg_return_rate"),
    )


def day_totals(totals: DataFrame) -> DataFrame:
    """The day table from totals (order_date, orders, revenue, items, returned, buyers)."""
    return totals.select(
        "order_date",
        F.col("orders").alias("total_orders"),
        _cents(F.col("revenue")).alias("total_revenue"),
        F.col("items").alias("total_items_sold"),
        _share(F.col("returned"), F.col("orders")).alias("return_rate"),
        F.col("buyers").alias("unique_customers"),
    )


def buyer_sketches(lines: DataFrame, rsd: float = 0.02) -> DataFrame:
    """(order_date, buyers): a HyperLogLog sketch of each day's buyers, of a few KB whatever their
    number, from sales lines. Stored, sketches of days give those of months or of any days together
    without the lines; `rsd` is the standard deviation of the estimates, as a share."""
    size = min(21, max(4, math.ceil(2 * math.log2(1.04 / rsd))))
    return lines.groupBy("order_date").agg(F.hll_sketch_agg("user_id", F.lit(size)).alias("buyers"))


def sketched_buyers(sketches: DataFrame, *by: Column) -> DataFrame:
    """The estimated number of different buyers of each group of days."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("buyers")).alias("unique_customers"))
