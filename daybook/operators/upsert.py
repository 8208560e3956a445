"""Keyed writes into Parquet tables that lie in month folders of the run that wrote them.

A pointer file tells which run's folder is a month's present one; `read` goes by it.
"""

from __future__ import annotations

import json
from collections.abc import Collection

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from daybook import storage
from daybook.functions import columns as C

MONTH = "order_month"
POINTER = "_pointer.json"
FEW = 1 << 20  # rows that need no splitting of large months


def last_by_key(rows: DataFrame, keys: list[str], order_by: str) -> DataFrame:
    """One row per key, the one with the highest `order_by`; no sort, partial sums of one row."""
    others = [c for c in rows.columns if c not in keys]
    return (
        rows.groupBy(*keys)
        .agg(F.max_by(F.struct(*others), order_by).alias("_last"))
        .select(*[c if c in keys else F.col(f"_last.{c}").alias(c) for c in rows.columns])
    )


def merge_rows(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """`new`, and those rows of `old` whose key is not in `new`. Keys are not NULL."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def outcome_counts(keys: list[str]) -> list[Column]:
    """Rows with a full key, which a keyed table takes, and rows without."""
    return [F.count_if(C.has_keys(*keys)).alias("written"), F.count_if(~C.has_keys(*keys)).alias("rejected")]


def write_outcome(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row of `outcome_counts`, without a write."""
    return rows.agg(*outcome_counts(keys))


def pointer(spark: SparkSession, table: str) -> dict:
    """Which run's folder holds each month of the table; empty where there is no table."""
    path = f"{table}/{POINTER}"
    return json.loads(storage.read_text(spark, path)) if storage.exists(spark, path) else {}


def read(spark: SparkSession, table: str, months: Collection[str] | None = None) -> DataFrame:
    """The table, or some months of it, as the last finished write left it.

    The pointer is read once, so the frame stays the same while later runs write: their folders
    are others, and those of replaced months are kept until one more run has finished.
    """
    held = pointer(spark, table)
    schema = T.StructType.fromJson(json.loads(held["schema"]))
    wanted = {m: r for m, r in held["months"].items() if months is None or m in months}
    if not wanted:
        return spark.createDataFrame([], storage.with_partitions(schema, **{MONTH: T.StringType()}))
    schema = storage.with_partitions(schema, run=T.IntegerType(), **{MONTH: T.StringType()})
    paths = [f"{table}/run={r}/{MONTH}={m}" for m, r in wanted.items()]
    return spark.read.schema(schema).option("basePath", table).parquet(*paths).drop("run")


def _months(spark: SparkSession, folder: str) -> list[str]:
    """Months that a write left rows of."""
    names = storage.children(spark, folder)
    return sorted(n.removeprefix(f"{MONTH}=") for n in names if n.startswith(f"{MONTH}="))


def _by_month(rows: DataFrame, path: str, number: int, months: int) -> None:
    """Writes about `number` rows of so many months. Where they are few, what takes time is the files,
    one a month, and tasks write them side by side."""
    if number <= FEW:
        dealt = rows.repartition(min(months, rows.sparkSession.sparkContext.defaultParallelism), MONTH)
    else:
        dealt = rows.hint("rebalance", MONTH)  # splits large months
    dealt.write.mode("overwrite").partitionBy(MONTH).parquet(path)


def _gathered(seen: Observation) -> dict[str, int]:
    """What was observed; zeros where Spark saw that there were no rows and left the plan out."""
    try:
        return seen.get
    except Py4JJavaError as error:
        if "AssertionError" not in error.java_exception.getClass().getName():
            raise
        return {"written": 0, "rejected": 0}


def _staged(new: DataFrame, keys: list[str], work: str) -> dict[str, int]:
    """Computes `new` once into `work`; gives the counts, which the write itself has gathered."""
    spark, counts = new.sparkSession, f"{work}/_counts.json"
    if not storage.exists(spark, counts):
        seen = Observation()
        observed = new.observe(seen, *outcome_counts(keys)).where(C.has_keys(*keys))
        observed.withColumn(MONTH, C.order_month(F.col("order_date"))).write.mode("overwrite").parquet(f"{work}/new")
        storage.replace_text(spark, counts, json.dumps(_gathered(seen)))
    return json.loads(storage.read_text(spark, counts))


def upsert(
    new: DataFrame, table: str, keys: list[str], run: int, work: str, days: DataFrame | None = None
) -> dict[str, int]:
    """Puts `new` into the table at `table`: a row replaces the row of its key.

    With `days` (order_date) all old rows of these days give way, so that figures computed anew
    leave no row of such a day behind, also where the day has no figures left. Rows with a NULL
    key are counted and left out.

    `new` is computed once, into `work`, a folder of this one write. Only the months it touches
    are read and written, into a folder of the run's own number, which must be greater than those
    before. Then one small file, the pointer, is replaced: with it all months change at once. Before
    that a reader sees none of the write, and a write that broke off is repeated whole.
    """
    spark = new.sparkSession
    outcome = _staged(new, keys, work)
    held = pointer(spark, table)
    if held.get("run", -1) >= run:
        return outcome
    schema = storage.with_partitions(new.schema, **{MONTH: T.StringType()})
    fresh = spark.read.schema(schema).parquet(f"{work}/new")
    some = fresh.select(MONTH)
    if days is not None:
        days = days.where("order_date is not null").select("order_date").distinct()
        some = some.unionByName(days.select(C.order_month(F.col("order_date")).alias(MONTH)))
    touched = {r[0] for r in some.distinct().collect()}
    before = held.get("months", {})
    rows, number = fresh, outcome["written"]
    if touched & set(before):
        old = read(spark, table, touched)
        number += old.count()  # from the footers
        if days is not None:
            old = old.join(days, "order_date", "left_anti").select(*rows.columns)
        rows = merge_rows(old, fresh, keys)
    if touched:
        _by_month(rows, f"{table}/run={run}", number, len(touched))
    left = _months(spark, f"{table}/run={run}") if touched else []
    months = {m: r for m, r in before.items() if m not in touched} | dict.fromkeys(left, run)
    replaced = [f"run={r}/{MONTH}={m}" for m, r in before.items() if m in touched]
    schema = held.get("schema", json.dumps(new.schema.jsonValue()))
    text = json.dumps({"run": run, "months": months, "replaced": replaced, "schema": schema})
    storage.replace_text(spark, f"{table}/{POINTER}", text)
    for folder in held.get("replaced", ()):
        storage.delete(spark, f"{table}/{folder}")
    return outcome
