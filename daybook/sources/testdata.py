"""The order, item and product datasets seen through the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderstatus").alias("status"),
    )


def order_items(spark: SparkSession, sf_dir: str, *also: str) -> DataFrame:
    """Items, with further lineitem columns where asked for."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").alias("sale_price"),
        F.when(F.col("l_returnflag") == "R", "returned")
        .when(F.col("l_returnflag") == "A", "completed")
        .otherwise("shipped")
        .alias("status"),
        *also,
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.col("p_retailprice").alias("cost"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("retail_price"),
    )


def datasets(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "orders": orders(spark, sf_dir),
        "order_items": order_items(spark, sf_dir),
        "products": products(spark, sf_dir),
    }
