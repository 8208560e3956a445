"""Batched puts into a keyed store outside Spark."""

from __future__ import annotations

import json
import sys
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from daybook import storage
from daybook.functions import columns as C
from daybook.sources.files import opener

# What runs in tasks is shipped whole, so workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUSY = "the store was too busy"
OUTCOME = {"successful": pa.int64(), "failed": pa.int64(), "skipped": pa.int64()}


def refused(deliver: Callable[[list[dict]], bool], records: list[dict], pauses: Sequence[float]) -> str | None:
    """Why the store did not take the records, at once or after one of the pauses; None if it did."""
    try:
        if deliver(records) or any(time.sleep(pause) or deliver(records) for pause in pauses):
            return None
        return BUSY
    except Exception as error:
        return f"{type(error).__name__}: {error}"


def put_frames(
    frames: Iterator[pa.RecordBatch],
    deliver: Callable[[list[dict]], bool],
    keys: Sequence[str],
    batch_size: int,
    pauses: Sequence[float],
    numbers: Sequence[str] = (),
) -> tuple[dict[str, int], str | None]:
    """Delivers the rows of a task in batches; gives the counts and why the first batch failed that
    did. The columns `numbers` come as text and go as exact decimals, what is no number as None."""
    count, why = dict.fromkeys(OUTCOME, 0), None
    for frame in frames:
        keyed = [r for r in frame.to_pylist() if all(r[k] is not None for k in keys)]
        for row in keyed:
            for name in numbers:
                value = None if row[name] is None else Decimal(row[name])
                row[name] = value if value is None or value.is_finite() else None
        count["skipped"] += frame.num_rows - len(keyed)
        for batch in (keyed[at : at + batch_size] for at in range(0, len(keyed), batch_size)):
            latest = {tuple(r[k] for k in keys): r for r in batch}
            reason = refused(deliver, list(latest.values()), pauses)
            count["failed" if reason else "successful"] += len(batch)
            why = why or reason
    return count, why


def put_rows(
    rows: DataFrame,
    deliver: Callable[[list[dict]], bool],
    keys: Sequence[str],
    writers: int | None = None,
    batch_size: int = 25,
    pauses: Sequence[float] = (1, 2, 4),
) -> DataFrame:
    """Hands `rows` to `deliver` in batches; gives one row (successful, failed, skipped).

    `deliver(records)` runs in the tasks and says whether the store took the records; False means
    it was too busy, and the batch is offered again after each of the `pauses`. An error fails
    the batch. Rows without a full key are skipped and counted. Of rows with one key in a batch
    the last is delivered, and all of them count as successful.

    As many tasks write as hold the rows, or `writers`, for a store that bears no more. A task
    that is run again delivers its rows again, which a store that replaces by key does not
    notice. Pass rows that are stored already, so that a retry does not compute them anew. The
    puts happen when the result is read.
    """

    numbers = C.floating(rows)

    def put_partition(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            count, _ = put_frames(iter([frame]), deliver, keys, batch_size, pauses, numbers)
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()) for n in count.values()], names=list(count))

    records = C.store_record(rows, numbers=False)
    if writers is not None:
        records = records.repartition(writers)
    return records.mapInArrow(put_partition, ", ".join(f"{n} bigint" for n in OUTCOME)).agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in OUTCOME]
    )


@dataclass
class Delivered(WriterCommitMessage):
    """What one task delivered."""

    counts: dict[str, int]
    why: str | None


def keyed_store(
    deliver: Callable[[list[dict]], bool],
    keys: Sequence[str],
    batch_size: int = 25,
    pauses: Sequence[float] = (1, 2, 4),
    name: str = "keyed_put",
) -> type[DataSource]:
    """A data source that writes into the store behind `deliver`; register it, and write through
    `rows.write.format(name).option("outcome", path)`. The option `numbers` lists, as JSON, columns that
    come as text and go as decimals.

    The outcome is written as JSON when all tasks have finished: counts as of `put_rows`, and each
    task's first reason for a failed batch. Only the attempt of a task that Spark commits counts,
    so a task that runs twice counts once. A job that is given up leaves `aborted` there.
    """

    class Writer(DataSourceArrowWriter):
        def __init__(self, outcome: str, numbers: list[str]):
            self.outcome, self.numbers = outcome, numbers

        def write(self, iterator: Iterator[pa.RecordBatch]) -> Delivered:
            return Delivered(*put_frames(iterator, deliver, keys, batch_size, pauses, self.numbers))

        def _note(self, what: dict) -> None:
            system, path = opener()(self.outcome)
            with system.open_output_stream(path) as out:
                out.write(json.dumps(what).encode())

        def commit(self, messages: list) -> None:
            done = [m for m in messages if m is not None]
            sums = {n: sum(m.counts[n] for m in done) for n in OUTCOME}
            self._note({**sums, "errors": sorted({m.why for m in done if m.why}), "aborted": False})

        def abort(self, messages: list) -> None:
            self._note({"aborted": True})

    class KeyedStore(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
            return Writer(self.options["outcome"], json.loads(self.options.get("numbers", "[]")))

    return KeyedStore


def put_through(rows: DataFrame, source: type[DataSource], outcome: str, writers: int | None = None) -> dict:
    """Writes `rows` through a `keyed_store`; gives its outcome, which is kept at `outcome`.

    Pass rows that are stored already, so that a retry does not compute them anew."""
    spark = rows.sparkSession
    spark.dataSource.register(source)
    records = C.store_record(rows, numbers=False)
    if writers is not None:
        records = records.repartition(writers)
    path = storage.qualified(spark, outcome)
    numbers = json.dumps(C.floating(rows))
    records.write.format(source.name()).mode("append").option("outcome", path).option("numbers", numbers).save()
    return json.loads(storage.read_text(spark, path))
