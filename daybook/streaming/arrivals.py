"""Runs started by arriving files.

The stream carries file names, not rows: each micro-batch is a set of new CSV files, and the
same run as in batch reads them, header by header. Spark's checkpoint remembers the files seen
and lets one query work on them at a time. Files that wait for other datasets are the state of the
stream, kept by Spark with the checkpoint.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from daybook import storage
from daybook.datasets import DATASETS
from daybook.plans import daily_run
from daybook.sources import files as arrived

# What runs in tasks is shipped whole, so workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BINARY = "path string, modificationTime timestamp, length bigint, content binary"


def file_stream(
    spark: SparkSession, base: str, files_per_batch: int = 1000, archive: str | None = None
) -> DataFrame:
    """New CSV files below `base` as (dataset, key, path, length, modification_time).

    File contents are never read: the plan drops their column. Empty files do not show up. With
    `archive`, a folder outside of `base`, Spark moves the files of a micro-batch there, under their
    whole path, when the next one begins.
    """
    root = storage.qualified(spark, base)
    path = arrived.one_slash(F.col("path"))
    key = arrived.key_of(path, root)
    reader = spark.readStream.format("binaryFile").schema(_BINARY)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", storage.qualified(spark, archive))
    return (
        reader.option("recursiveFileLookup", True)
        .option("pathGlobFilter", arrived.CSV_GLOB)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(root)
        .select(
            F.substring_index(key, "/", 1).alias("dataset"),
            key.alias("key"),
            path.alias("path"),
            "length",
            F.col("modificationTime").alias("modification_time"),
        )
        .where(F.col("dataset").isin(*arrived.DATASETS))
    )


# A file in the state; times are in microseconds.
_FILE = ["dataset", "key", "path", "length", "time"]
_HELD = "dataset array<string>, key array<string>, path array<string>, length array<bigint>, time array<bigint>"


def _holder(needed: tuple[str, ...]) -> Callable[..., Iterator[pd.DataFrame]]:
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        came = pd.concat(list(frames))
        held = pd.DataFrame(dict(zip(_FILE, state.get))) if state.exists else came[_FILE][:0]
        held = pd.concat([held, came[_FILE]]).drop_duplicates(["path", "time"])
        # Files that a run gave back start no run by themselves.
        if set(needed) <= set(held["dataset"]) and not came["returned"].all():
            if state.exists:
                state.remove()
            yield held.assign(base=key[0])
        else:
            state.update(tuple(held[name].tolist() for name in _FILE))

    return run


def complete_sets(files: DataFrame, needed: tuple[str, ...] = DATASETS) -> DataFrame:
    """Of a stream of files with `base` and `returned`, the sets that are complete: files of a base
    wait, as the state of the stream, until each needed dataset has one, and come out together.

    A file given twice counts once. `returned` marks files that came out before and could not be
    worked in: they wait with the others, but a base needs some new file to come out again. State
    is written anew for those bases only that have new files; a base's names are in one task, as
    they are in the driver when its run scans them.
    """
    rows = files.withColumn("time", F.unix_micros("modification_time")).select("base", *_FILE, "returned")
    out = rows.groupBy("base").applyInPandasWithState(
        _holder(needed),
        "dataset string, key string, path string, length bigint, time bigint, base string",
        _HELD,
        "append",
        GroupStateTimeout.NoTimeout,
    )
    return out.select("base", *_FILE[:-1], F.timestamp_micros("time").alias("modification_time"))


def _noted(tables: daily_run.Tables, batch_id: int) -> str:
    return tables.path("arrivals") + f"/batch_id={batch_id}"


def run_on_arrival(
    spark: SparkSession,
    base: str,
    tables_root: str,
    settings: daily_run.Settings = daily_run.Settings(mode="recompute"),
    files_per_batch: int = 1000,
    archive: str | None = None,
) -> DataStreamWriter:
    """A stream writer that runs whenever files arrive; add a checkpoint, a trigger, and start.

    With `require_all` the stream is the completeness gate: files wait in its state until every
    dataset has some (see `complete_sets`), and a run takes them. What a run leaves, such as good
    files beside a dataset whose files were all bad, goes back into the stream by a folder of names
    that it also reads, and waits for the next arrivals.

    Without it, whatever came is worked in at once: each micro-batch notes what came, and what no
    run has consumed of the files noted by the batch before, and the run takes these.

    A micro-batch played again has the same files, finds them consumed, and does nothing. The two
    forms are different streams: a checkpoint of the one does not go on as the other.

    With `archive` (see `file_stream`) files leave `base` once they are worked in. As no file may
    wait then, `require_all` must be off, and a run that fails stops the stream: its files stay, and
    come again when the stream is started anew.
    """
    if archive is not None and settings.require_all:
        raise ValueError("files that wait for others cannot be archived; set require_all=False")

    def on_batch(files: DataFrame, batch_id: int) -> None:
        session = files.sparkSession
        tables = daily_run.Tables(session, tables_root)
        daily_run.finish_open_run(session, tables)
        # What still waited after the batch before, and what came.
        last = [int(n.partition("=")[2]) for n in storage.children(session, tables.path("arrivals")) if "=" in n]
        before = [n for n in last if n < batch_id and storage.has_data(session, _noted(tables, n))]
        if before:
            files = files.unionByName(session.read.parquet(_noted(tables, max(before)))).distinct()
        tables.unconsumed(files).write.mode("overwrite").parquet(_noted(tables, batch_id))
        waiting = session.read.parquet(_noted(tables, batch_id))
        try:
            daily_run.run_files(session, base, waiting, tables, f"batch-{batch_id}", settings)
        except daily_run.RunFailed:
            # The report row tells why; good files wait for the next arrivals.
            if archive is not None:
                raise

    def on_sets(files: DataFrame, batch_id: int) -> None:
        session = files.sparkSession
        tables = daily_run.Tables(session, tables_root)
        daily_run.finish_open_run(session, tables)
        # Written once, so that the state moves on once.
        path = tables.path("complete") + f"/batch_id={batch_id}"
        files.drop("base").write.mode("overwrite").parquet(path)
        files = session.read.schema(arrived.FILE_SCHEMA).parquet(path)
        came = tables.unconsumed(files)
        if came.isEmpty():
            return
        try:
            daily_run.run_files(session, base, came, tables, f"batch-{batch_id}", settings)
        except daily_run.RunFailed:
            pass  # the report row tells why
        left = tables.unconsumed(files)
        if not left.isEmpty():
            left.select(*came.columns).write.mode("append").parquet(tables.path("returned"))

    found = file_stream(spark, base, files_per_batch, archive)
    if not settings.require_all:
        return found.writeStream.foreachBatch(on_batch)
    returned = daily_run.Tables(spark, tables_root).path("returned")
    storage.make_folder(spark, returned)
    back = spark.readStream.schema(arrived.FILE_SCHEMA).parquet(returned).withColumn("returned", F.lit(True))
    both = found.withColumn("returned", F.lit(False)).unionByName(back)
    sets = complete_sets(both.withColumn("base", F.lit(storage.qualified(spark, base))))
    return sets.writeStream.foreachBatch(on_sets)
