"""Typed columns and the two joins: items with orders, and those with products."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from daybook.functions import columns as C


def prepare_orders(orders: DataFrame) -> DataFrame:
    """Order key, buyer and day; only text needs the careful reading of dates."""
    created_at = F.col("created_at")
    text = isinstance(orders.schema["created_at"].dataType, T.StringType)
    day = C.order_date(created_at) if text else created_at.cast("date")
    return orders.select("order_id", "user_id", day.alias("order_date"))


def name_items(items: DataFrame) -> DataFrame:
    """Item columns under unambiguous names, with the return flag and the price as it came."""
    return items.select(
        "order_id",
        F.col("id").alias("item_id"),
        "product_id",
        "sale_price",
        C.is_returned(F.col("status")).alias("is_returned"),
    )


def priced(items: DataFrame, money: str = "float32") -> DataFrame:
    """The rows with a typed price."""
    return items.withColumn("sale_price", C.price(F.col("sale_price"), money))


def prepare_items(items: DataFrame, money: str = "float32") -> DataFrame:
    return priced(name_items(items), money)


def prepare_products(products: DataFrame) -> DataFrame:
    return products.select(F.col("id").alias("product_id"), "category")


def one_per_key(rows: DataFrame, key: str) -> DataFrame:
    """One row per key, the greatest by its other columns, so that every attempt keeps the same."""
    others = [c for c in rows.columns if c != key]
    kept = rows.groupBy(key).agg(F.max(F.struct(*others)).alias("_kept"))
    return kept.select(*[c if c == key else F.col(f"_kept.{c}").alias(c) for c in rows.columns])


def sales_lines(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Inner join of prepared items and orders; a repeated order row repeats its lines."""
    return items.join(orders, "order_id")


def product_lines(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Inner join with products; lines of an unknown product drop out.

    No hint: Spark broadcasts the product side only where its size is under
    `spark.sql.autoBroadcastJoinThreshold`, and else sorts and merges, splitting hot products.
    """
    return lines.join(products, "product_id")
