"""Header check, verdict per file, counts and the verdict on the whole set.

All take and give DataFrames; a file is one row (dataset, path, header_line).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from daybook.datasets import DATASETS, REQUIRED

# A field is a quoted text (doubled quotes inside) with whatever follows it, or plain text.
_FIELD = r',("(?:[^"]|"")*(?:"|$)[^,]*|[^,]*)'
_QUOTED = r'^"((?:[^"]|"")*)"?'


def header_names(line: Column) -> Column:
    """Column names of a header line: split at commas outside quotes, unquoted, trimmed."""

    def name(field: Column) -> Column:
        plain = F.when(
            field.startswith('"'),
            F.replace(F.regexp_replace(field, _QUOTED, "$1"), F.lit('""'), F.lit('"')),
        ).otherwise(field)
        return F.regexp_replace(plain, r"^\s+|\s+$", "")

    fields = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), 1)
    return F.when(F.trim(line) != "", F.transform(fields, name))


def _required(dataset: Column) -> Column:
    """The required columns of a dataset as an array, by its name."""
    choice = F
    for name, columns in REQUIRED.items():
        choice = choice.when(dataset == name, F.array(*[F.lit(c) for c in columns]))
    return choice


def _listed(names: Column) -> Column:
    return F.concat(F.lit("['"), F.array_join(names, "', '"), F.lit("']"))


def check_headers(files: DataFrame) -> DataFrame:
    """Adds headers_found, missing, extra, is_valid and issues.

    Further columns are noted, never held against a file. NULL headers mean the file could not
    be read or is empty.
    """
    found, missing, extra = F.col("headers_found"), F.col("missing"), F.col("extra")
    required = _required(F.col("dataset"))
    named = files.withColumn("headers_found", header_names(F.col("header_line"))).withColumns(
        {
            "missing": F.filter(required, lambda c: ~F.array_contains(found, c)),
            "extra": F.coalesce(
                F.filter(found, lambda c: ~F.array_contains(required, c)), F.array().cast("array<string>")
            ),
        }
    )
    # The wording of the issues.
    unreadable = F.when(found.isNull(), F.lit("Could not read file headers"))
    lacking = F.when(F.size(missing) > 0, F.concat(F.lit("Missing mandatory fields: "), _listed(missing)))
    further = F.when(F.size(extra) > 0, F.concat(F.lit("Additional fields found: "), _listed(extra)))
    return named.withColumns(
        {
            "is_valid": found.isNotNull() & (F.size(missing) == 0),
            "issues": F.array_compact(F.array(unreadable, lacking, further)),
        }
    )


def file_verdicts(checked: DataFrame, set_aside: Column) -> DataFrame:
    """`passed`; or `quarantined` where the bad file was set aside, else `failed`.

    Issues stay with bad files only, as a passed file's notes are in `extra`.
    """
    status = (
        F.when(F.col("is_valid"), "passed").when(set_aside, "quarantined").otherwise("failed")
    )
    return checked.withColumns(
        {
            "status": status,
            "issues": F.when(F.col("is_valid"), F.array().cast("array<string>")).otherwise(F.col("issues")),
        }
    )


def validation_rollup(verdicts: DataFrame) -> DataFrame:
    """File counts per dataset and for `all`; `failed` includes quarantined files.

    A dataset without files has a row too, with status `no_files`. One global aggregate counts
    everything, so each task sends one row.
    """

    def counts(name: str, place: int, of: Column) -> Column:
        passed = of & (F.col("status") == "passed")
        total = F.count_if(of)
        return F.struct(
            F.lit(name).alias("dataset"),
            F.lit(place).alias("place"),
            total.alias("total_files"),
            F.count_if(passed).alias("passed"),
            F.count_if(of & (F.col("status") != "passed")).alias("failed"),
            F.count_if(of & (F.col("status") == "quarantined")).alias("quarantined"),
            F.when(F.lit(name == "all"), None)
            .when(total == 0, "no_files")
            .otherwise("processed")
            .alias("status"),
        )

    each = [counts(d, i, F.col("dataset") == d) for i, d in enumerate(DATASETS)]
    whole = counts("all", len(DATASETS), F.col("dataset").isin(*DATASETS))
    return verdicts.agg(F.array(*each, whole).alias("rows")).select(F.inline("rows"))


def validation_status(rollup: DataFrame) -> DataFrame:
    """One row: `failure` if a dataset has no file, else `partial_success` if a file failed."""
    single = F.col("dataset") != "all"
    missing = F.transform(
        F.array_sort(
            F.collect_list(F.when(single & (F.col("total_files") == 0), F.struct("place", "dataset")))
        ),
        lambda s: s["dataset"],
    )
    whole = rollup.agg(
        missing.alias("missing_datasets"),
        F.sum(F.when(single, F.col("total_files"))).alias("total_files"),
        F.sum(F.when(single, F.col("failed"))).alias("failed"),
        F.sum(F.when(single, F.col("passed"))).alias("usable_files"),
        F.min(F.when(single, F.col("passed"))).alias("usable_per_dataset"),
    )
    absent = F.size("missing_datasets") > 0
    # The statuses and the wording of the messages.
    return whole.select(
        F.when(absent, "failure")
        .when(F.col("failed") > 0, "partial_success")
        .otherwise("success")
        .alias("status"),
        F.when(
            absent, F.concat(F.lit("Missing required data folders: "), _listed(F.col("missing_datasets")))
        )
        .when(
            F.col("failed") > 0,
            F.concat(F.col("failed").cast("string"), F.lit(" files failed validation and were quarantined")),
        )
        .alias("message"),
        "missing_datasets",
        "total_files",
        "failed",
        "usable_files",
        "usable_per_dataset",
    )
