"""File drops made from the star-schema tables, to work on files as they arrive in practice.

`file_catalogue` lists drops as rows only; `write_mixed_drop` and `write_plain_drop` write CSV
files with every row of the tables.
"""

from __future__ import annotations

import hashlib
import json
import sys
from collections.abc import Callable
from functools import reduce

from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from daybook import storage
from daybook.sources import testdata
from daybook.sources.csvdata import write_drop

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Header lines by the attribute that tells the files of a dataset apart.
ORDER_HEADERS = {
    "1-URGENT": "order_id,user_id,created_at,status",
    "2-HIGH": '"order_id", user_id ,created_at,"status"',
    "3-MEDIUM": "note,user_id,order_id,status,created_at",
    "4-NOT SPECIFIED": "order_id,user_id,created_at",
    "5-LOW": None,
}
ITEM_HEADERS = {
    "RF": "id,order_id,product_id,sale_price",
    "RO": "id,order_id,product_id,sale_price,status,order_date",
    "AF": "id,order_id,product_id",
    "AO": None,
    "NF": '"id","order_id","product_id","sale_price","gift, wrapped"',
    "NO": "  ",
}
PRODUCT_HEADERS = {
    "STANDARD": "id,sku,cost,category,retail_price",
    "SMALL": "id,sku,cost,category,retail_price",
    "ECONOMY": "id,name,retail_price",
    "MEDIUM": "retail_price,category,cost,sku,id",
    "PROMO": "Id,SKU,cost,category,retail_price",
    "LARGE": "id,sku,cost,category,retail_price,say \"\"hi\"\"",
}


def _by(column: Column, lines: dict[str, str | None]) -> Column:
    choice = F
    for value, line in lines.items():
        choice = choice.when(column == value, F.lit(line).cast("string"))
    return choice


def file_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dataset, key, path, modification_time, header_line): one file per customer and priority,
    supplier and line state, brand, type and size."""
    orders = testdata.table(spark, sf_dir, "orders")
    lines = testdata.table(spark, sf_dir, "lineitem")
    parts = testdata.table(spark, sf_dir, "part")
    state = F.concat("l_returnflag", "l_linestatus")

    def files(dataset: str, frame: DataFrame, *folders: str, header: Column) -> DataFrame:
        name = F.concat_ws("/", F.lit(dataset), *[F.col(c).cast("string") for c in folders])
        return frame.select(F.lit(dataset).alias("dataset"), name.alias("name"), header.alias("header_line"))

    return (
        files(
            "orders",
            orders.select("o_custkey", "o_orderpriority").distinct(),
            "o_custkey",
            "o_orderpriority",
            header=_by(F.col("o_orderpriority"), ORDER_HEADERS),
        )
        .unionByName(
            files(
                "order_items",
                lines.select("l_suppkey", state.alias("state")).distinct(),
                "l_suppkey",
                "state",
                header=_by(F.col("state"), ITEM_HEADERS),
            )
        )
        .unionByName(
            files(
                "products",
                parts.select("p_brand", "p_type", "p_size").distinct(),
                "p_brand",
                "p_type",
                "p_size",
                header=_by(F.col("p_type"), PRODUCT_HEADERS),
            )
        )
        .select(
            "dataset",
            F.concat("name", F.lit(".csv")).alias("key"),
            F.concat(F.lit("file:/drop/"), "name", F.lit(".csv")).alias("path"),
            F.lit(None).cast("timestamp").alias("modification_time"),
            "header_line",
        )
    )


def daily_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(day, dataset, key): orders by day and priority, items by ship day and return flag, and
    each product on the day it first ships."""
    orders = testdata.table(spark, sf_dir, "orders")
    lines = testdata.table(spark, sf_dir, "lineitem")
    shipped = F.col("l_shipdate").cast("date")

    def files(dataset: str, frame: DataFrame) -> DataFrame:
        return frame.toDF("day", "name").select(
            "day",
            F.lit(dataset).alias("dataset"),
            F.concat(F.lit(dataset + "/"), F.col("name").cast("string"), F.lit(".csv")).alias("key"),
        )

    first = lines.groupBy("l_partkey").agg(F.min(shipped).alias("day")).select("day", "l_partkey")
    return reduce(
        DataFrame.unionByName,
        [
            files("orders", orders.select(F.col("o_orderdate").cast("date"), "o_orderpriority").distinct()),
            files("order_items", lines.select(shipped, "l_returnflag").distinct()),
            files("products", first),
        ],
    )


# Folder and columns of the orders of each priority in the mixed drop; a file of the fourth lacks
# `status`, those of the fifth quote every field.
MIXED_ORDERS = {
    "1-URGENT": ("urgent", ["order_id", "user_id", "created_at", "status"]),
    "2-HIGH": ("high", ["user_id", "order_id", "created_at", "status"]),
    "3-MEDIUM": ("medium", ["note", "status", "created_at", "user_id", "order_id"]),
    "4-NOT SPECIFIED": ("unspecified", ["order_id", "user_id", "created_at"]),
    "5-LOW": ("low", ["order_id", "user_id", "created_at", "status"]),
}


def write_mixed_drop(spark: SparkSession, sf_dir: str, base: str, *datasets: str) -> str:
    """Orders in five folders under five kinds of header, and the given `datasets` in one each."""
    rows = testdata.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderstatus").alias("status"),
        F.concat(F.lit("made, "), F.col("o_orderpriority")).alias("note"),
        F.col("o_orderpriority").alias("priority"),
    )
    for priority, (folder, columns) in MIXED_ORDERS.items():
        part = rows.where(F.col("priority") == priority).select(*columns)
        part.write.mode("append").option("header", True).option("quoteAll", folder == "low").csv(
            f"{base}/orders/{folder}"
        )
    return write_plain_drop(spark, sf_dir, base, *datasets) if datasets else base


def write_plain_drop(spark: SparkSession, sf_dir: str, base: str, *datasets: str) -> str:
    """All rows of the given datasets (all three if none is named) under their usual headers."""
    for name, frame in testdata.datasets(spark, sf_dir).items():
        if not datasets or name in datasets:
            write_drop(frame, f"{base}/{name}/all")
    return base


def file_store(spark: SparkSession, folder: str) -> Callable[[list[dict]], bool]:
    """A keyed store for `put_rows`: a file of JSON lines per batch, named by what it holds, so
    that a batch put again replaces itself."""
    root = storage.qualified(spark, folder)

    def deliver(records: list[dict]) -> bool:
        lines = "".join(json.dumps(r, default=str, sort_keys=True) + "\n" for r in records).encode()
        system, path = fs.FileSystem.from_uri(root)
        system.create_dir(path)
        with system.open_output_stream(f"{path}/{hashlib.sha1(lines).hexdigest()}.json") as out:
            out.write(lines)
        return True

    return deliver
