"""Are files of all three datasets there?"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from daybook.datasets import DATASETS


def completeness_gate(files: DataFrame, *by: str) -> DataFrame:
    """One row (per `by`, such as a base folder): presence and number of files per dataset.

    `triggered` is true when no dataset is missing. Without `by` there is a row even for no
    files at all.
    """

    def present(dataset: str) -> Column:
        return F.col(f"{dataset}_files") > 0

    counted = files.groupBy(*by).agg(
        *[F.count_if(F.col("dataset") == d).alias(f"{d}_files") for d in DATASETS]
    )
    # Fixed values below: the names of the result's fields and the two messages.
    triggered = reduce(Column.__and__, [present(d) for d in DATASETS])
    return counted.select(
        *by,
        *[present(d).alias(f"has_{d}") for d in DATASETS],
        *[f"{d}_files" for d in DATASETS],
        F.array_compact(F.array(*[F.when(~present(d), d) for d in DATASETS])).alias("missing_folders"),
        triggered.alias("triggered"),
        F.when(triggered, "Complete file set").otherwise("Waiting for complete file set").alias("message"),
    )
