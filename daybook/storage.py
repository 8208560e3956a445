"""Where tables and scratch data live: the shared file system Spark itself uses."""

from __future__ import annotations

import re
import tempfile
import uuid
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession, types as T

_MADE: list[str] = []


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _filesystem(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _filesystem(spark, path).exists(_path(spark, path))


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, in the form Spark reports file names in."""
    return _filesystem(spark, path).makeQualified(_path(spark, path)).toString().rstrip("/")


def scheme(spark: SparkSession, path: str) -> str:
    return qualified(spark, path).partition(":")[0]


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none where there is no folder."""
    if not exists(spark, path):
        return []
    return [s.getPath().getName() for s in _filesystem(spark, path).listStatus(_path(spark, path))]


def listed(spark: SparkSession, folders: list[str]) -> list[tuple[str, bool, int, datetime]]:
    """(path, False, size, time) of all files below the folders; hidden names are left out."""
    found = []
    for folder in folders:
        if not exists(spark, folder):
            continue
        files = _filesystem(spark, folder).listFiles(_path(spark, folder), True)
        while files.hasNext():
            status = files.next()
            path = status.getPath().toString()
            if not re.search(r"/[_.]", path[len(folder) :]):
                time = datetime.fromtimestamp(status.getModificationTime() / 1000, timezone.utc)
                found.append((path, False, status.getLen(), time))
    return found


def make_folder(spark: SparkSession, path: str) -> None:
    """Makes a folder; one that is there stays."""
    _filesystem(spark, path).mkdirs(_path(spark, path))


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file unless it is there already; says whether it did."""
    if exists(spark, path):
        return False
    try:
        out = _filesystem(spark, path).create(_path(spark, path), False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """What a small file holds."""
    stream = _filesystem(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


# Stores where a file shows up whole when its writer closes it, and where a rename copies.
WHOLE_PUTS = ("s3a", "s3", "gs")


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Puts a small file in the place of an older one at once: a reader finds either, whole."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    whole = scheme(spark, path) in WHOLE_PUTS
    folder, _, name = path.rpartition("/")
    target = path if whole else f"{folder}/_{name}-{uuid.uuid4().hex[:12]}"
    out = _filesystem(spark, target).create(_path(spark, target), True)
    out.write(bytearray(text.encode()))
    out.close()
    if not whole:
        context = hadoop.FileContext.getFileContext(_path(spark, qualified(spark, path)).toUri())
        over = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
        over[0] = hadoop.Options.Rename.OVERWRITE
        context.rename(_path(spark, qualified(spark, target)), _path(spark, qualified(spark, path)), over)


def delete(spark: SparkSession, path: str) -> None:
    _filesystem(spark, path).delete(_path(spark, path), True)


def has_data(spark: SparkSession, path: str) -> bool:
    """True where a finished write left its marker."""
    return exists(spark, f"{path}/_SUCCESS")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's `spark.checkpoint.dir`.

    Only where that setting is missing in a local session, as in tests, a temporary folder
    stands in; on a cluster executors would not see it. The session's scratch folders are
    deleted by `clean`.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="daybook-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _MADE.append(path)
    return path


def clean(spark: SparkSession) -> None:
    """Deletes the scratch folders this process has asked for; frames read from them are lost."""
    while _MADE:
        delete(spark, _MADE.pop())


def with_partitions(schema: T.StructType, **columns: T.DataType) -> T.StructType:
    """The schema plus partition columns, so that reading does not guess their types."""
    return T.StructType(schema.fields + [T.StructField(n, t) for n, t in columns.items()])
