"""Which files have arrived, and the header line of each."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from daybook import storage
from daybook.datasets import DATASETS
from daybook.functions import columns as C

# What runs in tasks is shipped whole, so workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CSV_GLOB = "*.[cC][sS][vV]"
LONGEST = 64 << 20  # bytes of a header line
FILE_SCHEMA = "dataset string, key string, path string, length bigint, modification_time timestamp"


def one_slash(path: Column) -> Column:
    """file:///a and file:/a are the same file; keep the short form."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def plain_path(uri: Column) -> Column:
    """The path behind a URL-encoded file name as Spark's metadata column gives it."""
    return one_slash(F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))))


def key_of(path: Column, base: str) -> Column:
    """The path below the base; its first folder names the dataset."""
    return F.replace(path, F.lit(base + "/"), F.lit(""))


def opener() -> Callable[[str], tuple]:
    """The task side of reading a store: (file system, path in it) of a path in Spark's form. Built
    inside one function, so that Spark ships it whole and workers need not have this package."""
    from urllib.parse import quote, unquote

    from pyarrow import fs

    def opened(path: str) -> tuple:
        scheme, _, rest = path.partition(":")
        if scheme == "file":
            return fs.LocalFileSystem(), "/" + rest.lstrip("/")
        path = {"s3a": "s3", "abfss": "abfs"}.get(scheme, scheme) + ":" + rest
        # Buckets, containers and hosts are taken as they are; the key is quoted.
        system, inner = fs.FileSystem.from_uri(quote(path, safe=":/@"))
        return system, unquote(inner) if "%" in inner else inner

    return opened


FOUND = "path string, is_folder boolean, length bigint, modification_time timestamp"


def _lister() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lists folders, one level deep, in a task. What begins with `_` or `.` is hidden."""
    from pyarrow import fs

    opened = opener()
    kinds = [pa.string(), pa.bool_(), pa.int64(), pa.timestamp("us", "UTC")]
    names = ["path", "is_folder", "length", "modification_time"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                system, inner = opened(folder)
                held = system.get_file_info(fs.FileSelector(inner, allow_not_found=True))
                seen = [f for f in held if not f.base_name.startswith(("_", "."))]
                rows = [
                    [f"{folder}/{f.base_name}" for f in seen],
                    [f.type == fs.FileType.Directory for f in seen],
                    [f.size or 0 for f in seen],
                    # Spark's file sources count in milliseconds.
                    [f.mtime_ns and f.mtime_ns // 1_000_000 * 1_000 for f in seen],
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names=names)

    return run


def inventory(spark: SparkSession, base: str, ranged: bool = True, folders_per_task: int = 16) -> DataFrame:
    """Every CSV file of the three datasets below `base`, at any depth, with size and time.

    Folders are dealt to tasks, which list them through `pyarrow`, level by level; a task holds the
    names of one folder. Names land as Parquet, only the number of folders reaches the driver. For
    a store that only Spark reads, `ranged=False` has the driver list it through Hadoop instead.
    """
    root = storage.qualified(spark, base)
    tops = [f"{root}/{d}" for d in DATASETS]
    if not ranged:
        found = spark.createDataFrame(storage.listed(spark, tops), FOUND)
        return _as_inventory(found, root)
    target, number, level = storage.scratch(spark, "inventory"), len(tops), 0
    folders = spark.createDataFrame([(t,) for t in tops], "path string")
    while number:
        path = f"{target}/level={level}"
        tasks = -(-number // folders_per_task)
        folders.repartition(tasks).mapInArrow(_lister(), FOUND).write.parquet(path)
        folders = spark.read.schema(FOUND).parquet(path).where("is_folder").select("path")
        number, level = folders.count(), level + 1
    return _as_inventory(spark.read.schema(FOUND).parquet(*[f"{target}/level={i}" for i in range(level)]), root)


def _as_inventory(found: DataFrame, root: str) -> DataFrame:
    path = one_slash(F.col("path"))
    return found.where(~F.col("is_folder") & C.is_csv(F.col("path"))).select(
        F.substring_index(key_of(path, root), "/", 1).alias("dataset"),
        key_of(path, root).alias("key"),
        path.alias("path"),
        "length",
        "modification_time",
    )


def _header_reader(longest: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The task side of the ranged read."""
    opened = opener()

    def open_stream(path: str):
        system, inner = opened(path)
        return system.open_input_stream(inner)

    def first_line(path: str) -> str | None:
        """Text up to the first line feed; None where there is none that reads as UTF-8. A file
        that has gone has no header either; other errors of the store fail the task."""
        blocks, held = [], 0
        try:
            with open_stream(path) as stream:
                while block := stream.read(4096):
                    line, feed, _ = block.partition(b"\n")
                    blocks.append(line)
                    held += len(line)
                    if held > longest:
                        return None
                    if feed:
                        break
            return b"".join(blocks).decode("utf-8").strip() or None
        except (FileNotFoundError, UnicodeDecodeError):
            return None

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(header_line=batch["path"].map(first_line))

    return read


def _opening_lines() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows that differ from the row before in the first column, in a task. It holds one batch."""
    import pyarrow.compute as pc

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            paths = batch.column(0)
            begins = pc.not_equal(paths.slice(1), paths.slice(0, len(paths) - 1)).to_pylist()
            yield batch.filter(pa.array([paths[0].as_py() != last, *begins]))
            last = paths[-1].as_py()

    return run


def headers(
    spark: SparkSession,
    files: DataFrame,
    ranged: bool = True,
    number: int | None = None,
    files_per_task: int = 200,
    longest: int = LONGEST,
) -> DataFrame:
    """`files` with the first line of each; a line of more than `longest` bytes is no header, and a
    task reads no further in it.

    `ranged` opens each file in a task and stops at the first line feed, a few KB per file: no
    Spark source can leave a file early. It goes through `pyarrow` (local, S3, GCS, HDFS and
    Azure paths). The number of tasks follows the `number` of files (counted if not given), as
    the names alone are too small for Spark to spread them. For a store that only Spark reads,
    ask for `ranged=False`: its text source gives the same lines, but reads the files whole.
    """
    if ranged:
        tasks = -(-(files.count() if number is None else number) // files_per_task)
        return files.repartition(max(1, tasks)).mapInPandas(
            _header_reader(longest), FILE_SCHEMA + ", header_line string"
        )
    paths = [r.path for r in files.select("path").collect()]
    if not paths:
        return files.withColumn("header_line", F.lit(None).cast("string"))
    # The lines of a file's first block follow each other in one task, so no line but the first of
    # each is kept, sorted or shuffled. Bytes, as a line may be no UTF-8.
    lines = (
        spark.read.option("lineSep", "\n")
        .text([literal_path(p) for p in paths])
        .where(F.col("_metadata.file_block_start") == 0)
        .select(
            F.col("_metadata.file_path").alias("uri"),
            F.when(F.octet_length("value") <= longest, F.col("value").cast("binary")).alias("line"),
        )
        .mapInArrow(_opening_lines(), "uri string, line binary")
        .select(plain_path(F.col("uri")).alias("path"), F.col("line").cast("string").alias("value"))
    )
    trimmed = F.regexp_replace("value", r"^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")
    lines = lines.select("path", F.when(F.is_valid_utf8("value"), F.nullif(trimmed, F.lit(""))).alias("header_line"))
    return files.join(lines, "path", "left").select(*files.columns, "header_line")


def _reading_test() -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    opened = opener()

    def is_readable(path: str) -> bool:
        system, inner = opened(path)
        try:
            with system.open_input_stream(inner) as stream:
                while stream.read(1 << 20):
                    pass
            return True
        except OSError:
            return False

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[batch["path"].map(is_readable)]

    return run


def readable(files: DataFrame, number: int, files_per_task: int = 8) -> DataFrame:
    """Paths of the `number` `files` (path) that can be read to their end. Tasks read them, side by
    side, in blocks."""
    tasks = max(1, -(-number // files_per_task))
    return files.select("path").repartition(tasks).mapInPandas(_reading_test(), "path string")


def literal_path(path: str) -> str:
    """The path with its glob characters escaped, for readers that expand globs."""
    return "".join("\\" + c if c in "*?[]{}\\" else c for c in path)
