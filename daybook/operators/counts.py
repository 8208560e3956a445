"""Row counts per dataset and the guard against empty input."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


class EmptyDataset(ValueError):
    """A dataset has no file or no row."""


def source_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """(dataset, source_rows), one row each; map tasks count, nothing else is shuffled."""
    return reduce(
        DataFrame.unionByName,
        [
            frame.agg(F.count("*").alias("source_rows")).select(F.lit(name).alias("dataset"), "source_rows")
            for name, frame in frames.items()
        ],
    )


def require_rows(counts: DataFrame) -> DataFrame:
    """The counts unchanged; running the query fails where a dataset is empty."""
    bad = F.concat(F.lit("One or more datasets are empty: "), F.col("dataset"))
    return counts.select(
        "dataset",
        "source_rows",
        F.when(F.col("source_rows") > 0, True).otherwise(F.raise_error(bad).cast("boolean")).alias("has_rows"),
    )
