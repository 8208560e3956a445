"""What a run did: the file manifest, and the report row with its one-line text.

Counts come as (name, value) rows, so that one aggregate gathers them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from daybook.datasets import DATASETS
from daybook.functions import columns as C


PATH_BUCKETS = 64  # folders of the index of consumed files


def archive_manifest(verdicts: DataFrame, run_id: Column, stamp: Column) -> DataFrame:
    """One row per file: where it belongs after the run, and whether it got there.

    Passed files belong to the run's archive folder, bad ones, with their issues, to quarantine.
    A file marked `moved` counts as consumed; `unconsumed` leaves it out of the next run.
    """
    passed = F.col("status") == "passed"
    return verdicts.select(
        "dataset",
        "key",
        "path",
        "modification_time",
        F.when(passed, C.archive_path(run_id, stamp, F.col("key")))
        .otherwise(C.quarantine_path(F.col("dataset"), F.col("key")))
        .alias("target_path"),
        "status",
        "issues",
        (F.col("status") != "failed").alias("moved"),
    )


def archive_status(manifest: DataFrame) -> DataFrame:
    return manifest.agg(
        F.count_if("moved").alias("moved_files"),
        F.count_if(~F.col("moved")).alias("failed_files"),
        F.when(F.count_if(~F.col("moved")) == 0, "success").otherwise("partial_failure").alias("archive_status"),
    )


def unconsumed(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files no earlier run moved; a file written anew under an old name is a new file."""
    m = manifest.where("moved").select(
        F.col("path").alias("_path"), F.col("modification_time").alias("_time")
    ).distinct()
    same = (F.col("path") == F.col("_path")) & F.col("modification_time").eqNullSafe(F.col("_time"))
    return files.join(m, same, "left_anti")


def consumed(manifest: DataFrame) -> DataFrame:
    """(path, modification_time, bucket) of the moved files of a manifest, once each."""
    rows = manifest.where("moved").select("path", "modification_time").distinct()
    return rows.withColumn("bucket", path_bucket(F.col("path")))


def path_bucket(path: Column) -> Column:
    return F.pmod(F.xxhash64(path), F.lit(PATH_BUCKETS)).cast("int")


def file_facts(verdicts: DataFrame) -> DataFrame:
    """Counts of files, by verdict and by dataset, as (name, value)."""
    failed = F.col("status") != "passed"
    counts = {
        "total_files": F.count("*"),
        "passed": F.count_if(~failed),
        "failed": F.count_if(failed),
        "quarantined": F.count_if(F.col("status") == "quarantined"),
        "unmoved": F.count_if(F.col("status") == "failed"),
        **{d: F.count_if(~failed & (F.col("dataset") == d)) for d in DATASETS},
    }
    return verdicts.agg(*[c.alias(n) for n, c in counts.items()]).unpivot([], list(counts), "name", "value")


def source_facts(counts: DataFrame) -> DataFrame:
    """Rows read by dataset (dataset, source_rows), as (name, value)."""
    return counts.select(F.concat(F.lit("source_"), F.col("dataset")).alias("name"), F.col("source_rows").alias("value"))


def write_facts(outcomes: dict[str, DataFrame]) -> DataFrame:
    """Write outcomes (written, rejected) by report name, as (name, value)."""
    return reduce(
        DataFrame.unionByName,
        [
            # One plan per outcome: both counts come from the same row.
            outcome.select(F.col("written").alias(name), "rejected").unpivot([], [name, "rejected"], "name", "value")
            for name, outcome in outcomes.items()
        ],
    )


def _fact(*names: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("name").isin(*names), F.col("value"))), F.lit(0))


# The wording of the two report lines.
SUCCESS_LINE = (
    "SUCCESS: Execution %s - Folder %s processed successfully. Validation Results: Total files: %d, "
    "Passed: %d, Failed: %d, Quarantined: %d. Transformation Results: Records processed: %d, "
    "Category metrics: %d, Order metrics: %d, Failed records: %d, Archive status: %s"
)
FAILURE_LINE = "FAILURE: Execution %s - Folder %s failed processing. Error Details: %s"


def run_report(facts: DataFrame, run_id: str, folder: str) -> DataFrame:
    """The report row; recordsProcessed counts result rows written, sourceRows those read."""

    def by_dataset(prefix: str) -> Column:
        names = {"orders": "orders", "order_items": "orderItems", "products": "products"}
        return F.struct(*[_fact(prefix + d).alias(names[d]) for d in DATASETS])

    # The names of the report's fields.
    archive = F.when(_fact("unmoved") == 0, "success").otherwise("partial_failure")
    written = {
        "recordsProcessed": _fact("categoryMetrics", "orderMetrics"),
        "categoryMetrics": _fact("categoryMetrics"),
        "orderMetrics": _fact("orderMetrics"),
        "failedRecords": _fact("rejected"),
    }
    checked = [_fact(n) for n in ("total_files", "passed", "failed", "quarantined")]
    return facts.agg(
        F.lit("success").alias("status"),
        *[value.alias(name) for name, value in written.items()],
        archive.alias("archiveStatus"),
        F.lit(run_id).alias("executionId"),
        by_dataset("").alias("processedFiles"),
        by_dataset("source_").alias("sourceRows"),
        F.format_string(
            SUCCESS_LINE, F.lit(run_id), F.lit(folder), *checked, *written.values(), archive
        ).alias("message"),
    )


def failure_text(run_id: str, folder: str, error: str) -> str:
    return FAILURE_LINE % (run_id, folder, error)


def failure_report(facts: DataFrame, run_id: str, folder: str, line: str) -> DataFrame:
    """The report row of a run that wrote nothing: all counts 0, and the line that tells why."""
    return run_report(facts.where(F.lit(False)), run_id, folder).withColumns(
        {
            "status": F.lit("failure"),
            "archiveStatus": F.lit(None).cast("string"),
            "message": F.lit(line),
        }
    )
