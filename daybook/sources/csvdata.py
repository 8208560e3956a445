"""CSV files into typed columns by name, and typed tables into CSV drops."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from daybook.datasets import USED
from daybook.sources.files import literal_path


class MissingColumns(ValueError):
    """Files passed the header check but lack a column the daily figures need."""


def read_by_name(
    spark: SparkSession, files: DataFrame, dataset: str, key_type: str = "bigint"
) -> DataFrame:
    """Rows of all `files` (path, headers_found) with the used columns, whatever their order.
    Ids become `key_type`.

    One scan reads several CSV files under one positional schema, so the files are grouped by
    where the used columns stand, and each group is a scan of its own. Files that differ only
    in further columns fall into one group. The list of paths passes through the driver, which
    holds the same list for any file scan.
    """
    columns = {c: key_type if t == "bigint" else t for c, t in USED[dataset].items()}
    placed = files.select(
        "path",
        F.array(*[F.array_position("headers_found", F.lit(c)) for c in columns]).alias("places"),
    )
    groups: dict[tuple[int, ...], list[str]] = {}
    for row in placed.collect():
        groups.setdefault(tuple(row.places), []).append(row.path)
    if not groups:
        return spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in columns.items()))

    lacking = {places: paths for places, paths in groups.items() if 0 in places}
    if lacking:
        what = "; ".join(
            f"{len(paths)} file(s) such as {min(paths)} lack "
            + ", ".join(c for c, p in zip(columns, places) if p == 0)
            for places, paths in lacking.items()
        )
        raise MissingColumns(f"{dataset}: {what}")

    def scan(places: tuple[int, ...], paths: list[str]) -> DataFrame:
        names = [f"_{i}" for i in range(1, max(places) + 1)]
        for column, place in zip(columns, places):
            names[place - 1] = column
        return (
            spark.read.schema(", ".join(f"`{n}` string" for n in names))
            .option("header", True)
            .csv([literal_path(p) for p in paths])
            .select(*[F.col(c).try_cast(t).alias(c) for c, t in columns.items()])
        )

    return reduce(DataFrame.unionByName, [scan(places, paths) for places, paths in groups.items()])


def write_drop(rows: DataFrame, folder: str, columns: list[str] | None = None) -> None:
    """Rows as headered CSV files in `folder`."""
    (rows.select(*columns) if columns else rows).write.mode("append").option("header", True).csv(folder)
