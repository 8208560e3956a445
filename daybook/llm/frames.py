"""Small helpers the operators share."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from daybook import storage

# Fixed value: a word is a run of anything but space and the five control white spaces.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written once below the shared folder and read back: cuts the lineage, so that
    neither a second use nor a lost executor computes them anew."""
    spark = rows.sparkSession
    path = storage.scratch(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def identified(rows: DataFrame) -> DataFrame:
    """The rows with `__file` and `__place`, which tell each row of a file apart and stay the
    same however often it is read. Rows that are not as Parquet files have them are stored first."""
    marks = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__place")]
    steps = rows._jdf.queryExecution().optimizedPlan().toString().splitlines()
    plain = all(re.match(r"[\s:+-]*(Project|Filter|Relation) ", step) for step in steps)
    if not (plain and steps[-1].endswith(" parquet")):
        rows = stored(rows, "rows")
    return rows.select("*", *marks)


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(column: str = "text") -> Column:
    """The text, NULL as the empty one."""
    return F.coalesce(F.col(column), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words of the whole text; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def running(
    rows: DataFrame, order: Sequence[str], by: Sequence[str] = (), value: Column | None = None, name: str = "before"
) -> DataFrame:
    """Adds `name`: the sum of `value` (1 if none is given) over the rows of the same `by` that
    come before in `order`.

    Rows are dealt to tasks by range, each task adds up its own, and one row per task and group
    carries the sums on, so no group is ever in one task. `order` should tell nearly all rows
    apart; equal rows are numbered in any order. `by` holds no NULL.
    """
    spark = rows.sparkSession
    placed = stored(
        rows.withColumn("__value", F.lit(1) if value is None else value)
        .repartitionByRange(tasks(spark), *by, *order)
        .withColumn("__task", F.spark_partition_id()),
        "running",
    )
    group = [*by, "__task"]
    ahead = (Window.unboundedPreceding, -1)
    total = F.coalesce(F.sum("__value").over(Window.partitionBy(*group).orderBy(*order).rowsBetween(*ahead)), F.lit(0))
    offsets = (
        placed.groupBy(*group)
        .agg(F.sum("__value").alias("__sum"))
        .withColumn("__offset", F.sum("__sum").over(Window.partitionBy(*by).orderBy("__task").rowsBetween(*ahead)))
        .drop("__sum")
    )
    return (
        placed.withColumn("__inside", total)
        .join(offsets, group)
        .withColumn(name, (F.col("__inside") + F.coalesce("__offset", F.lit(0))).cast("bigint"))
        .drop("__value", "__task", "__inside", "__offset")
    )


def pieces(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a piece holds about `size` bytes of `column`, or one row."""
    for batch in batches:
        lengths = batch.column(column).cast(pa.binary())
        start, held = 0, 0
        for at, value in enumerate(pc.fill_null(pc.binary_length(lengths), 0).to_pylist()):
            if held and held + value > size:
                yield batch.slice(start, at - start)
                start, held = at, 0
            held += value
        if start < batch.num_rows:
            yield batch.slice(start)
