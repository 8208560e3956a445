"""Column expressions. Everything here runs inside Spark's generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

RETURNED = "returned"
EXACT = "decimal(28,10)"  # 18 whole digits and 10 more; sums have 10 whole digits in reserve


def order_date(created_at: Column) -> Column:
    """Calendar day of a date, timestamp or text; unreadable text gives NULL.

    Text with a zone offset is moved to the session time zone first. Text that is only a time
    of day is not a date.
    """
    day = created_at.try_cast("date")
    return F.when(day.isNotNull(), F.coalesce(created_at.try_cast("timestamp").cast("date"), day))


def price(sale_price: Column, money: str = "float32") -> Column:
    """Sale price as 32-bit float (`float32`) or exact number (`decimal`); bad text gives NULL."""
    types = {"float32": "float", "decimal": EXACT}
    if money not in types:
        raise ValueError(f"money must be one of {sorted(types)}, not {money!r}")
    return sale_price.try_cast(types[money])


def is_returned(status: Column) -> Column:
    """1 where the text is exactly `returned`, else 0; NULL counts as 0."""
    return F.when(status == RETURNED, 1).otherwise(0)


def is_csv(key: Column) -> Column:
    """File keys ending in .csv in any case; a folder key is not a file."""
    return F.lower(key).endswith(".csv") & ~key.endswith("/")


def base_prefix(key: Column) -> Column:
    """Folder a key stands for: itself if it ends in '/', else its parent; '' at the root."""
    return F.coalesce(F.regexp_extract(key, "^(.*/)", 1), F.lit(""))


def basename(key: Column) -> Column:
    return F.substring_index(key, "/", -1)


def archive_path(run_id: Column, stamp: Column, key: Column) -> Column:
    """processed/<run>/<yyyyMMdd_HHmmss>/<key>"""
    return F.concat_ws("/", F.lit("processed"), run_id, F.date_format(stamp, "yyyyMMdd_HHmmss"), key)


def quarantine_path(dataset: Column, key: Column) -> Column:
    """quarantine/<dataset>/<file name>; two bad files of one name share one target."""
    return F.concat_ws("/", F.lit("quarantine"), dataset, basename(key))


def has_keys(*keys: str) -> Column:
    """True where no key column is NULL."""
    test = F.lit(True)
    for key in keys:
        test = test & F.col(key).isNotNull()
    return test


def order_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def writer_count(rows: Column) -> Column:
    """Writers that a small keyed store bears: one per 1,000 rows, at least 1, at most 10."""
    return F.greatest(F.lit(1), F.least(F.lit(10), F.floor(rows / 1000))).cast("int")


def floating(rows: DataFrame) -> list[str]:
    """Names of the columns of floating numbers."""
    return [f.name for f in rows.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]


def store_record(rows: DataFrame, numbers: bool = True) -> DataFrame:
    """Rows as a keyed store takes them: numbers as decimals, dates and times as ISO text.

    Decimals stay as they are. Floating numbers keep the digits they are written with, as far as
    Spark's decimals go: 18 after the point, 20 before it, a greater number is NULL. With `numbers`
    off they are the text they are written as, whatever their size, which `put` makes numbers of.
    """

    def convert(field: T.StructField) -> Column:
        c = F.col(field.name)
        if isinstance(field.dataType, T.BooleanType):
            return c
        if isinstance(field.dataType, T.IntegralType):
            return c.cast("decimal(28,0)").alias(field.name)
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            text = c.cast("string")
            return (text.try_cast("decimal(38,18)") if numbers else text).alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.date_format(c, "yyyy-MM-dd").alias(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            seconds, fraction = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.date_format(c, ".SSSSSS")
            return F.when(fraction == ".000000", seconds).otherwise(F.concat(seconds, fraction)).alias(field.name)
        return c

    return rows.select(*[convert(f) for f in rows.schema.fields])
