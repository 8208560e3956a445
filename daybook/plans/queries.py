"""Every operator as a query over the star-schema tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from daybook import storage
from daybook.datasets import CATEGORY_TABLE, ORDER_TABLE, TABLE_KEYS
from daybook.functions import columns as C
from daybook.operators import counts, gate, kpis, put, report, sales, upsert, validation
from daybook.plans import daily_run
from daybook.sources import csvdata, drops, files, testdata
from daybook.streaming import arrivals

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_ID = "run-1"
STAMP = "2026-01-02 03:04:05"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _prepared(spark, sf_dir, money="float32"):
    data = testdata.datasets(spark, sf_dir)
    return (
        sales.prepare_items(data["order_items"], money),
        sales.prepare_orders(data["orders"]),
        sales.prepare_products(data["products"]),
    )


def _lines(spark, sf_dir):
    items, orders, _ = _prepared(spark, sf_dir)
    return sales.sales_lines(items, orders)


# --- sources ---------------------------------------------------------------------------------


def _mixed(spark, sf_dir, name, *also):
    base = drops.write_mixed_drop(spark, sf_dir, storage.scratch(spark, name), *also)
    return files.inventory(spark, base)


def _folder(key):
    return F.substring_index(F.substring_index(key, "/", 2), "/", -1)


@query
def csv_scan(spark, sf_dir):
    base = drops.write_plain_drop(spark, sf_dir, storage.scratch(spark, "csv_scan"), "order_items")
    found = validation.check_headers(files.headers(spark, files.inventory(spark, base)))
    rows = csvdata.read_by_name(spark, found, "order_items")
    return rows.withColumn("sale_price", C.price(F.col("sale_price")))


@query
def csv_union_by_name(spark, sf_dir):
    inventory = _mixed(spark, sf_dir, "csv_union_by_name")
    checked = validation.check_headers(files.headers(spark, inventory)).where("is_valid")
    return sales.prepare_orders(csvdata.read_by_name(spark, checked, "orders"))


def _rows_per_file(spark, inventory):
    """The files of an inventory with the data rows each holds, so that a missed file shows."""
    folder = F.regexp_replace("path", "/[^/]*$", "")
    folders = [files.literal_path(r[0]) for r in inventory.select(folder).distinct().collect()]
    lines = spark.read.text(folders).groupBy(files.plain_path(F.col("_metadata.file_path")).alias("path"))
    return inventory.join(lines.agg((F.count("*") - 1).alias("rows")), "path")


@query
def file_inventory(spark, sf_dir):
    return (
        _rows_per_file(spark, _mixed(spark, sf_dir, "file_inventory", "order_items", "products").where(C.is_csv(F.col("key"))))
        .groupBy("dataset", _folder(F.col("key")).alias("folder"))
        .agg((F.count("*") > 0).alias("has_files"), (F.sum("length") > 0).alias("has_bytes"), F.sum("rows").alias("rows"))
    )


@query
def base_prefix(spark, sf_dir):
    """Page addresses, file keys, folder keys and bare names, as given by the tables."""
    pages = testdata.table(spark, sf_dir, "pages").select(F.col("url").alias("key"))
    catalogue = drops.file_catalogue(spark, sf_dir).select("key")
    folders = catalogue.select(F.replace("key", F.lit(".csv"), F.lit("/")).alias("key"))
    names = testdata.table(spark, sf_dir, "part").select(F.col("p_name").alias("key"))
    keys = pages.unionByName(catalogue).unionByName(folders).unionByName(names)
    return keys.select("key", C.base_prefix(F.col("key")).alias("prefix"))


@query
def source_counts(spark, sf_dir):
    return counts.source_counts(testdata.datasets(spark, sf_dir))


@query
def non_empty_guard(spark, sf_dir):
    return counts.require_rows(counts.source_counts(testdata.datasets(spark, sf_dir)))


# --- validation ------------------------------------------------------------------------------


def _heads(spark, sf_dir, name, ranged):
    """Header lines, each with the rows of all files that have it."""
    heads = _rows_per_file(spark, files.headers(spark, _mixed(spark, sf_dir, name, "order_items", "products"), ranged))
    return heads.groupBy("dataset", _folder(F.col("key")).alias("folder"), "header_line").agg(F.sum("rows").alias("rows"))


@query
def file_headers(spark, sf_dir):
    return _heads(spark, sf_dir, "file_headers", True)


@query
def file_headers_scanned(spark, sf_dir):
    return _heads(spark, sf_dir, "file_headers_scanned", False)


def _checked(spark, sf_dir):
    return validation.check_headers(drops.file_catalogue(spark, sf_dir))


def _verdicts(spark, sf_dir):
    """Bad files with a readable first line are set aside; the others resist."""
    return validation.file_verdicts(_checked(spark, sf_dir), F.col("headers_found").isNotNull())


@query
def header_columns(spark, sf_dir):
    names = validation.header_names(F.col("header_line"))
    return drops.file_catalogue(spark, sf_dir).select("key", F.array_join(names, "|").alias("names"))


@query
def schema_verdict(spark, sf_dir):
    return _checked(spark, sf_dir).select(
        "dataset",
        "key",
        "is_valid",
        F.array_join("missing", "|").alias("missing"),
        F.array_join("extra", "|").alias("extra"),
        F.array_join("issues", "; ").alias("issues"),
    )


@query
def file_verdicts(spark, sf_dir):
    return _verdicts(spark, sf_dir).select("dataset", "key", "status", F.array_join("issues", "; ").alias("issues"))


@query
def validation_rollup(spark, sf_dir):
    return validation.validation_rollup(_verdicts(spark, sf_dir)).drop("place")


@query
def validation_status(spark, sf_dir):
    status = validation.validation_status(validation.validation_rollup(_verdicts(spark, sf_dir)))
    return status.withColumn("missing_datasets", F.array_join("missing_datasets", "|"))


@query
def quarantine_split(spark, sf_dir):
    """Order keys of good files and of files set aside, from the written quarantine."""
    target = storage.scratch(spark, "quarantine")
    inventory = _mixed(spark, sf_dir, "quarantine_split", "order_items", "products")
    checked = validation.check_headers(files.headers(spark, inventory))
    daily_run.quarantined(spark, checked.withColumn("gone", F.lit(False)), target)
    good = csvdata.read_by_name(spark, checked.where("is_valid and dataset = 'orders'"), "orders")
    bad = spark.read.parquet(target).where(F.col("dataset") == "orders")
    aside = bad.select(F.split("line", ",")[0].try_cast("bigint").alias("order_id")).where("order_id is not null")
    return good.select("order_id", F.lit("good").alias("side")).unionByName(
        aside.withColumn("side", F.lit("quarantined"))
    )


@query
def quarantine_verdicts(spark, sf_dir):
    """Verdicts from a real quarantine write, with the rows of the files they are on."""
    inventory = _mixed(spark, sf_dir, "quarantine_verdicts", "order_items", "products")
    checked = validation.check_headers(files.headers(spark, inventory)).withColumn("gone", F.lit(False))
    verdicts = daily_run.quarantined(spark, checked, storage.scratch(spark, "quarantine"))
    rows = _rows_per_file(spark, inventory).select("path", "rows")
    return (
        verdicts.join(rows, "path")
        .groupBy("dataset", _folder(F.col("key")).alias("folder"), "status")
        .agg(F.sum("rows").alias("rows"))
    )


@query
def completeness_gate(spark, sf_dir):
    days = gate.completeness_gate(drops.daily_arrivals(spark, sf_dir), "day")
    return days.withColumn("missing_folders", F.array_join("missing_folders", "|"))


# --- projections -----------------------------------------------------------------------------


@query
def project_items(spark, sf_dir):
    return _prepared(spark, sf_dir)[0].select("order_id", "item_id", "sale_price", "is_returned")


@query
def order_dates(spark, sf_dir):
    return sales.prepare_orders(testdata.orders(spark, sf_dir))


@query
def float_price(spark, sf_dir):
    items = testdata.order_items(spark, sf_dir)
    return items.select("order_id", "product_id", C.price(F.col("sale_price")).alias("sale_price"))


@query
def returned_flag(spark, sf_dir):
    items = testdata.order_items(spark, sf_dir)
    return items.select("order_id", "id", "status", C.is_returned(F.col("status")).alias("is_returned"))


@query
def rounded_ratio(spark, sf_dir):
    return (
        _prepared(spark, sf_dir)[0]
        .groupBy("order_id")
        .agg(
            F.round(F.sum("sale_price") / F.count("*"), 2).alias("avg_price"),
            F.round(F.sum("is_returned") / F.count("*"), 4).alias("returned_share"),
        )
    )


def _category_with_gaps(spark, sf_dir):
    """The category table where promotional products carry no category."""
    items, orders, products = _prepared(spark, sf_dir)
    gaps = products.withColumn("category", F.nullif("category", F.lit("PROMO")))
    return kpis.category_daily_kpis(items, orders, gaps)


@query
def sink_key_filter(spark, sf_dir):
    return _category_with_gaps(spark, sf_dir).where(C.has_keys(*TABLE_KEYS[CATEGORY_TABLE]))


@query
def sink_rows(spark, sf_dir):
    return C.store_record(category_daily_kpis(spark, sf_dir))


@query
def sink_rows_six_digits(spark, sf_dir):
    """Numbers and times with more digits than money and seconds have."""
    orders = testdata.table(spark, sf_dir, "orders")
    share = (F.col("o_totalprice").cast("decimal(14,2)") * F.lit("0.000123").cast("decimal(7,6)")).cast("decimal(24,8)")
    late = F.col("o_orderdate") + F.expr("interval 7 microseconds")
    return C.store_record(orders.select("o_orderkey", share.alias("share"), late.alias("late"), "o_orderdate"))


@query
def sink_rows_orders(spark, sf_dir):
    return C.store_record(order_daily_kpis(spark, sf_dir))


@query
def archive_paths(spark, sf_dir):
    orders = testdata.orders(spark, sf_dir)
    key = F.concat(F.lit("orders/"), F.col("order_id").cast("string"), F.lit(".csv"))
    return orders.select("order_id", C.archive_path(F.lit(RUN_ID), F.col("created_at"), key).alias("target_path"))


# --- joins and aggregates --------------------------------------------------------------------


@query
def items_orders(spark, sf_dir):
    return _lines(spark, sf_dir)


@query
def items_orders_products(spark, sf_dir):
    return sales.product_lines(_lines(spark, sf_dir), _prepared(spark, sf_dir)[2])


@query
def revenue_by_category_day(spark, sf_dir):
    return category_daily_kpis(spark, sf_dir).select("category", "order_date", "daily_revenue")


@query
def revenue_by_day(spark, sf_dir):
    return order_daily_kpis(spark, sf_dir).select("order_date", "total_revenue")


@query
def distinct_orders_by_day(spark, sf_dir):
    return order_daily_kpis(spark, sf_dir).select("order_date", "total_orders")


@query
def distinct_customers_by_day(spark, sf_dir):
    return order_daily_kpis(spark, sf_dir).select("order_date", "unique_customers")


RSD = 0.02  # of the sketched counts


def _near_enough(exact, sketched, *by):
    """Exact counts, and whether the sketched ones lie within five standard deviations."""
    found = F.abs(F.col("sketched") - F.col("unique_customers"))
    near = (found <= 1 + 5 * RSD * F.col("unique_customers")).alias("near")
    return exact.join(sketched.withColumnRenamed("unique_customers", "sketched"), list(by)).select(
        *by, "unique_customers", near
    )


def _stored_sketches(spark, sf_dir, name):
    path = storage.scratch(spark, name)
    kpis.buyer_sketches(_lines(spark, sf_dir), RSD).write.parquet(path)
    return spark.read.parquet(path)


@query
def sketched_customers_by_day(spark, sf_dir):
    sketches = _stored_sketches(spark, sf_dir, "day_sketches")
    exact = distinct_customers_by_day(spark, sf_dir)
    return _near_enough(exact, kpis.sketched_buyers(sketches, F.col("order_date")), "order_date")


@query
def sketched_customers_by_month(spark, sf_dir):
    """Months from the days' stored sketches; exact counts need the lines once more."""
    sketches = _stored_sketches(spark, sf_dir, "month_sketches")
    month = C.order_month(F.col("order_date")).alias("order_month")
    exact = _lines(spark, sf_dir).groupBy(month).agg(F.count_distinct("user_id").alias("unique_customers"))
    return _near_enough(exact, kpis.sketched_buyers(sketches, month), "order_month")


@query
def avg_order_value(spark, sf_dir):
    return category_daily_kpis(spark, sf_dir).select("category", "order_date", "avg_order_value")


@query
def return_rate_by_day(spark, sf_dir):
    return order_daily_kpis(spark, sf_dir).select("order_date", "return_rate")


@query
def items_sold_by_day(spark, sf_dir):
    return order_daily_kpis(spark, sf_dir).select("order_date", "total_items_sold")


# --- the two tables --------------------------------------------------------------------------


@query
def prepared_items(spark, sf_dir):
    return _prepared(spark, sf_dir)[0]


@query
def category_daily_kpis(spark, sf_dir):
    return kpis.category_daily_kpis(*_prepared(spark, sf_dir))


@query
def order_daily_kpis(spark, sf_dir):
    return kpis.order_daily_kpis(*_prepared(spark, sf_dir)[:2])


@query
def order_daily_kpis_two_step(spark, sf_dir):
    return kpis.order_daily_kpis(*_prepared(spark, sf_dir)[:2], unique_orders=True)


@query
def category_kpis_of_lines(spark, sf_dir):
    return kpis.category_kpis_of_lines(_lines(spark, sf_dir), _prepared(spark, sf_dir)[2])


@query
def order_kpis_of_lines(spark, sf_dir):
    return kpis.order_kpis_of_lines(_lines(spark, sf_dir))


def _as_cents(figures, *names):
    return figures.withColumns({n: F.col(n).cast("decimal(28,2)") for n in names})


@query
def category_daily_kpis_decimal(spark, sf_dir):
    figures = kpis.category_daily_kpis(*_prepared(spark, sf_dir, "decimal"))
    return _as_cents(figures, "daily_revenue", "avg_order_value")


@query
def order_daily_kpis_decimal(spark, sf_dir):
    return _as_cents(kpis.order_daily_kpis(*_prepared(spark, sf_dir, "decimal")[:2]), "total_revenue")


# --- keyed writes ----------------------------------------------------------------------------


def _half(spark, sf_dir, state):
    """Daily figures of the open or the finished lines alone."""
    items = testdata.order_items(spark, sf_dir, "l_linestatus").where(F.col("l_linestatus") == state)
    return kpis.order_daily_kpis(sales.prepare_items(items), _prepared(spark, sf_dir)[1])


@query
def kpi_upsert_replace(spark, sf_dir):
    root = storage.scratch(spark, "kpi_upsert_replace")
    for step, state in enumerate(["F", "O"]):
        upsert.upsert(
            _half(spark, sf_dir, state), f"{root}/{ORDER_TABLE}", TABLE_KEYS[ORDER_TABLE], step, f"{root}/work/{step}"
        )
    return upsert.read(spark, f"{root}/{ORDER_TABLE}").drop(upsert.MONTH)


LATE = daily_run.Settings(mode="recompute", require_all=False)


def _two_runs(spark, sf_dir, name, first):
    """Finished lines with all orders and products in one run, the open lines in a later one."""
    root = storage.scratch(spark, name)
    base = drops.write_plain_drop(spark, sf_dir, f"{root}/in", "orders", "products")
    items = testdata.order_items(spark, sf_dir, "l_linestatus")
    for state, run_settings in (("F", first), ("O", LATE)):
        part = items.where(F.col("l_linestatus") == state).drop("l_linestatus")
        csvdata.write_drop(part, f"{base}/order_items/{state}")
        daily_run.run(spark, base, f"{root}/out", f"run-{state}", run_settings)
    return upsert.read(spark, f"{root}/out/{ORDER_TABLE}").drop(upsert.MONTH)


@query
def kpi_upsert_recompute(spark, sf_dir):
    return _two_runs(spark, sf_dir, "kpi_upsert_recompute", LATE)


@query
def kpi_recompute_after_replace(spark, sf_dir):
    return _two_runs(spark, sf_dir, "kpi_recompute_after_replace", daily_run.Settings())


@query
def dedup_last_by_key(spark, sf_dir):
    return upsert.last_by_key(testdata.orders(spark, sf_dir), ["user_id"], "order_id")


@query
def writer_parallelism(spark, sf_dir):
    rows = counts.source_counts(testdata.datasets(spark, sf_dir))
    return rows.withColumn("writers", C.writer_count(F.col("source_rows")))


@query
def write_outcome(spark, sf_dir):
    return upsert.write_outcome(_category_with_gaps(spark, sf_dir), TABLE_KEYS[CATEGORY_TABLE])


@query
def keyed_put(spark, sf_dir):
    """The category table put into a store that keeps a file per batch, and read back from it."""
    root = storage.scratch(spark, "keyed_put")
    category_daily_kpis(spark, sf_dir).write.parquet(f"{root}/rows")
    rows = spark.read.parquet(f"{root}/rows")
    keys = TABLE_KEYS[CATEGORY_TABLE]
    writers = rows.agg(C.writer_count(F.count("*"))).first()[0]
    source = put.keyed_store(drops.file_store(spark, f"{root}/store"), keys)
    outcome = put.put_through(rows, source, f"{root}/outcome.json", writers)
    stored = C.store_record(rows).schema
    text = ", ".join(f"`{c}` string" for c in stored.names)
    back = spark.read.schema(text).json(f"{root}/store")
    return back.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in stored.fields],
        F.lit(outcome["successful"]).cast("bigint").alias("successful"),
        F.lit(outcome["failed"]).cast("bigint").alias("failed"),
    )


# --- archive and report ----------------------------------------------------------------------


@query
def archive_manifest(spark, sf_dir):
    stamp = F.lit(STAMP).cast("timestamp_ntz")
    manifest = report.archive_manifest(_verdicts(spark, sf_dir), F.lit(RUN_ID), stamp)
    return manifest.select(
        "dataset", "key", "target_path", "status", F.array_join("issues", "; ").alias("issues"), "moved"
    )


@query
def archive_status(spark, sf_dir):
    stamp = F.lit(STAMP).cast("timestamp_ntz")
    return report.archive_status(report.archive_manifest(_verdicts(spark, sf_dir), F.lit(RUN_ID), stamp))


def _facts(spark, sf_dir):
    outcomes = {
        "categoryMetrics": write_outcome(spark, sf_dir),
        "orderMetrics": upsert.write_outcome(order_daily_kpis(spark, sf_dir), TABLE_KEYS[ORDER_TABLE]),
    }
    return (
        report.file_facts(_verdicts(spark, sf_dir))
        .unionByName(report.write_facts(outcomes))
        .unionByName(report.source_facts(source_counts(spark, sf_dir)))
    )


@query
def run_report(spark, sf_dir):
    row = report.run_report(_facts(spark, sf_dir), RUN_ID, "drop")
    fields = ["orders", "orderItems", "products"]
    return row.select(
        *[c for c in row.columns if c not in ("processedFiles", "sourceRows", "message")],
        *[F.col(f"processedFiles.{f}").alias(f"processed_{f}") for f in fields],
        *[F.col(f"sourceRows.{f}").alias(f"source_{f}") for f in fields],
    )


@query
def run_report_text(spark, sf_dir):
    return report.run_report(_facts(spark, sf_dir), RUN_ID, "drop").select("message")


# --- whole runs and streams ------------------------------------------------------------------


@query
def daily_run_category(spark, sf_dir):
    """CSV files to the category table in one run."""
    root = storage.scratch(spark, "daily_run")
    base = drops.write_plain_drop(spark, sf_dir, f"{root}/in")
    daily_run.run(spark, base, f"{root}/out", RUN_ID)
    return upsert.read(spark, f"{root}/out/{CATEGORY_TABLE}").drop(upsert.MONTH)


def _drain(spark, root, run_settings, files_per_batch, archive=None, checkpoint="checkpoint"):
    writer = arrivals.run_on_arrival(spark, f"{root}/in", f"{root}/out", run_settings, files_per_batch, archive)
    stream = writer.option("checkpointLocation", f"{root}/{checkpoint}").trigger(availableNow=True).start()
    stream.awaitTermination()


@query
def stream_order_daily_kpis(spark, sf_dir):
    """Files worked in as they come, some per micro-batch; drained, then asked again."""
    root = storage.scratch(spark, "stream_order_daily_kpis")
    drops.write_plain_drop(spark, sf_dir, f"{root}/in", "order_items", "orders")
    _drain(spark, root, LATE, 2)
    drops.write_plain_drop(spark, sf_dir, f"{root}/in", "products")
    _drain(spark, root, LATE, 1000)
    _drain(spark, root, LATE, 1000)
    return upsert.read(spark, f"{root}/out/{ORDER_TABLE}").drop(upsert.MONTH)


@query
def stream_gate(spark, sf_dir):
    """Items and orders wait in the stream until the products come."""
    root = storage.scratch(spark, "stream_gate")
    drops.write_plain_drop(spark, sf_dir, f"{root}/in", "order_items", "orders")
    gated = daily_run.Settings(mode="recompute")
    _drain(spark, root, gated, 1_000_000)
    if storage.exists(spark, f"{root}/out/{CATEGORY_TABLE}"):
        raise AssertionError("a run started before all datasets were there")
    drops.write_plain_drop(spark, sf_dir, f"{root}/in", "products")
    _drain(spark, root, gated, 1_000_000)
    return upsert.read(spark, f"{root}/out/{CATEGORY_TABLE}").drop(upsert.MONTH)


@query
def stream_archive(spark, sf_dir):
    """Rows of the files that the stream has moved to the archive: all but those of its last batch."""
    root = storage.scratch(spark, "stream_archive")
    drops.write_plain_drop(spark, sf_dir, f"{root}/in", "order_items", "orders")
    _drain(spark, root, LATE, 1_000_000, f"{root}/archive")
    drops.write_plain_drop(spark, sf_dir, f"{root}/in", "products")
    _drain(spark, root, LATE, 1_000_000, f"{root}/archive")
    lines = spark.read.option("recursiveFileLookup", True).text(f"{root}/archive")
    dataset = F.regexp_extract("_metadata.file_path", "/in/([^/]+)/", 1).alias("dataset")
    header = F.col("value").rlike("^(id|order_id),")
    return lines.groupBy(dataset).agg(F.count_if(~header).alias("rows"))


@query
def stream_batch_replayed(spark, sf_dir):
    """All files come as a micro-batch once more, under another checkpoint, and count once."""
    root = storage.scratch(spark, "stream_batch_replayed")
    drops.write_plain_drop(spark, sf_dir, f"{root}/in")
    for checkpoint in ("first", "second"):
        _drain(spark, root, LATE, 1_000_000, checkpoint=checkpoint)
    return upsert.read(spark, f"{root}/out/{ORDER_TABLE}").drop(upsert.MONTH)
