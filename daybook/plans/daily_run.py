"""One run from arrived files to updated tables."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from daybook import settings as session, storage
from daybook.datasets import CATEGORY_TABLE, DATASETS, ORDER_TABLE, TABLE_KEYS
from daybook.operators import counts, gate, kpis, report, sales, upsert, validation
from daybook.plans import history
from daybook.sources import csvdata, files as arrived


class RunFailed(RuntimeError):
    """The run stopped for a reason that lies in the files; its report row says which."""


class RunInProgress(RuntimeError):
    """Another run has begun on the same tables at the same time."""


class SettingsConflict(ValueError):
    """The tables were begun with other types."""


FOLD = 32  # runs
MODES = ("replace", "recompute")
MONEY = ("float32", "decimal")


@dataclass(frozen=True)
class Settings:
    """How a run computes and writes.

    mode: `replace` puts the figures of this run's files over the old rows of the same keys;
    `recompute` works out the affected days anew from everything delivered so far, by runs of
    either mode.
    money and key_type: types of the tables; they stay what they were in the first run. key_type
    is `string` where order, item, product or user ids are not whole numbers.
    unique_orders: states that no order key repeats, for a cheaper plan.
    drop_repeats: keeps one row per order and per product of a run; else each copy counts. A
    recompute run always counts an order or a product once.
    require_all: every dataset must have usable files and rows. Without it (recompute only) a
    run may bring, say, only late items.
    ranged: header lines are read by opening each file in a task; False where only Spark can
    read the store.
    buckets: how many the sums of a recompute run lie in, by order; as the types, it stays what it
    was in the first run. Some hundred MB each is a good size.
    """

    mode: str = "replace"
    money: str = "float32"
    key_type: str = "bigint"
    unique_orders: bool = False
    drop_repeats: bool = False
    require_all: bool = True
    ranged: bool = True
    buckets: int = history.BUCKETS

    def __post_init__(self):
        if self.mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}, not {self.mode!r}")
        if self.money not in MONEY:
            raise ValueError(f"money must be one of {MONEY}, not {self.money!r}")
        if self.mode == "replace" and not self.require_all:
            raise ValueError("only recompute runs may go without a dataset")

    def types(self) -> dict[str, str]:
        return {"money": self.money, "key_type": self.key_type, "buckets": self.buckets}


@dataclass(frozen=True)
class Claim:
    """What a run was begun with; whoever finishes it goes by this."""

    base: str
    run_id: str
    stamp: str
    checked: str
    settings: Settings

    def text(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def of(cls, text: str) -> Claim:
        held = json.loads(text)
        return cls(**{**held, "settings": Settings(**held["settings"])})


class Tables:
    """Paths below the folder that holds the results and the books of all runs."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str, seq: int | None = None) -> str:
        return f"{self.root}/{name}" + ("" if seq is None else f"/seq={seq}")

    def ledger(self) -> dict[str, int]:
        """`next`: a run's number below which all have finished; `base`: the runs before it are in
        the index of consumed files."""
        path = f"{self.root}/ledger.json"
        if not storage.exists(self.spark, path):
            return {"next": 0, "base": 0}
        return json.loads(storage.read_text(self.spark, path))

    def next_seq(self) -> int:
        """One more than the last finished run; the manifest is what a run writes last but for the ledger."""
        seq = self.ledger()["next"]
        while storage.has_data(self.spark, self.path("manifest", seq)):
            seq += 1
        return seq

    def _index(self, base: int) -> str:
        return f"{self.root}/consumed/upto={base}"

    def _indexed(self, base: int) -> DataFrame:
        schema = "path string, modification_time timestamp, bucket int"
        if not base:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._index(base))

    def _manifests(self, begin: int, end: int) -> DataFrame | None:
        paths = [self.path("manifest", seq) for seq in range(begin, end)]
        return self.spark.read.parquet(*paths) if paths else None

    def finished(self, seq: int) -> None:
        """Notes that all runs up to `seq` have finished. Each `FOLD` runs their consumed files go
        into the index: buckets of the path, sorted by it, with Parquet's Bloom filters."""
        held = self.ledger()
        base = held["base"]
        if seq + 1 - base >= FOLD:
            rows = report.consumed(self._manifests(base, seq + 1)).unionByName(self._indexed(base)).distinct()
            (
                rows.hint("rebalance", "bucket")
                .sortWithinPartitions("bucket", "path")
                .write.mode("overwrite")
                .option("parquet.bloom.filter.enabled#path", "true")
                .partitionBy("bucket")
                .parquet(self._index(seq + 1))
            )
            base = seq + 1
        storage.replace_text(self.spark, f"{self.root}/ledger.json", json.dumps({"next": seq + 1, "base": base}))
        if base != held["base"] and held["base"]:
            storage.delete(self.spark, self._index(held["base"]))

    def unconsumed(self, files: DataFrame) -> DataFrame:
        """Files that no run consumed: of the index only the buckets of these files are read, and
        the manifests of the runs since."""
        base = self.ledger()["base"]
        recent = self._manifests(base, self.next_seq())
        if recent is not None:
            files = report.unconsumed(files, recent)
        if base:
            # At most `PATH_BUCKETS` numbers.
            own = [r[0] for r in files.select(report.path_bucket(F.col("path"))).distinct().collect()]
            index = self._indexed(base).where(F.col("bucket").isin(own))
            files = report.unconsumed(files, index.withColumn("moved", F.lit(True)))
        return files

    def keep_types(self, settings: Settings) -> None:
        """Records the types at the first run, and holds later ones to them."""
        path, wanted = f"{self.root}/types.json", settings.types()
        if storage.create_new(self.spark, path, json.dumps(wanted)):
            return
        held = json.loads(storage.read_text(self.spark, path))
        if held != wanted:
            raise SettingsConflict(f"the tables below {self.root} have {held}, the run asks for {wanted}")

    def claim_path(self, seq: int) -> str:
        return f"{self.root}/runs/{seq}.json"

    def open_claim(self, seq: int) -> Claim | None:
        path = self.claim_path(seq)
        return Claim.of(storage.read_text(self.spark, path)) if storage.exists(self.spark, path) else None


def run(
    spark: SparkSession,
    base: str,
    tables_root: str,
    run_id: str,
    settings: Settings = Settings(),
    stamp: datetime | None = None,
) -> DataFrame | None:
    """Runs over the files below `base` that no earlier run consumed; gives the report row.

    Gives None, and changes nothing, while a dataset has no new file (with `require_all`) or
    none has. A run that broke off is finished first.
    """
    tables = Tables(spark, tables_root)
    finished = finish_open_run(spark, tables)
    files = tables.unconsumed(arrived.inventory(spark, base, settings.ranged))
    row = run_files(spark, base, files, tables, run_id, settings, stamp)
    return finished if row is None else row


def finish_open_run(spark: SparkSession, tables: Tables) -> DataFrame | None:
    """Completes a run that stopped half way, with the files, the settings and the id it had,
    before newer files count. If it cannot be completed it is closed with a failure report."""
    seq = tables.next_seq()
    claim = tables.open_claim(seq)
    if claim is None:
        return None
    try:
        return _finish(spark, tables, seq, claim, arrived.inventory(spark, claim.base, claim.settings.ranged))
    except RunFailed:
        return spark.read.parquet(tables.path("run_report", seq))


def run_files(
    spark: SparkSession,
    base: str,
    files: DataFrame,
    tables: Tables,
    run_id: str,
    settings: Settings = Settings(),
    stamp: datetime | None = None,
) -> DataFrame | None:
    """The run over given files (see `inventory`), none of which was consumed before."""
    seq = tables.next_seq()
    present = gate.completeness_gate(files).first()
    if not (present.triggered if settings.require_all else any(present[f"has_{d}"] for d in DATASETS)):
        return None
    tables.keep_types(settings)
    number = sum(present[f"{d}_files"] for d in DATASETS)
    checked = validation.check_headers(arrived.headers(spark, files, settings.ranged, number))
    path = tables.path("checked") + f"/{uuid.uuid4().hex}"
    checked.write.parquet(path)
    when = (stamp or datetime.now(timezone.utc)).strftime("%Y-%m-%d %H:%M:%S")
    claim = Claim(base, run_id, when, path, settings)
    if not storage.create_new(spark, tables.claim_path(seq), claim.text()):
        storage.delete(spark, path)
        raise RunInProgress(f"run {seq} below {tables.root} was begun by another call")
    return _finish(spark, tables, seq, claim)


def _finish(
    spark: SparkSession, tables: Tables, seq: int, claim: Claim, still_there: DataFrame | None = None
) -> DataFrame:
    """The run from its checked files on. `still_there`: the files of today, for a run begun
    before; what has gone since fails."""
    with session.during(spark, session.RUN):
        return _finish_as_set(spark, tables, seq, claim, still_there)


def _finish_as_set(
    spark: SparkSession, tables: Tables, seq: int, claim: Claim, still_there: DataFrame | None
) -> DataFrame:
    run_id, settings = claim.run_id, claim.settings
    checked = spark.read.parquet(claim.checked).withColumn("gone", F.lit(False))
    if still_there is not None:
        now = still_there.select("path", "modification_time", F.lit(False).alias("_gone"))
        gone = F.coalesce("_gone", F.lit(True))
        checked = checked.join(now, ["path", "modification_time"], "left").withColumn("gone", gone).drop("_gone")
        checked = checked.withColumns(
            {
                "is_valid": F.col("is_valid") & ~F.col("gone"),
                "issues": F.when(F.col("gone"), F.array(F.lit("The file has gone"))).otherwise(F.col("issues")),
            }
        )
    verdicts = quarantined(spark, checked, tables.path("quarantine", seq), settings.ranged)
    try:
        facts = _figures(spark, verdicts, tables, seq, settings)
    except (RunFailed, counts.EmptyDataset, csvdata.MissingColumns) as error:
        history.drop(spark, tables.path("history"), seq)
        line = report.failure_text(run_id, claim.base, str(error))
        failure = report.failure_report(report.file_facts(verdicts), run_id, claim.base, line)
        failure.write.mode("overwrite").parquet(tables.path("run_report", seq))
        # Bad files are set aside for good; the others stay for the next run.
        _write_manifest(verdicts, tables, seq, claim, F.col("status") == "quarantined")
        raise RunFailed(line) from error

    facts = report.file_facts(verdicts).unionByName(
        spark.createDataFrame(list(facts.items()), "name string, value bigint").coalesce(1)
    )
    report.run_report(facts, run_id, claim.base).write.mode("overwrite").parquet(tables.path("run_report", seq))
    _write_manifest(verdicts, tables, seq, claim, F.col("status") != "failed")
    storage.delete(spark, tables.path("work", seq))
    return spark.read.parquet(tables.path("run_report", seq))


def _write_manifest(verdicts, tables: Tables, seq: int, claim: Claim, moved) -> None:
    when = F.lit(claim.stamp).cast("timestamp_ntz")
    manifest = report.archive_manifest(verdicts, F.lit(claim.run_id), when).withColumns(
        {
            "moved": moved,
            # Where the lines of a bad file really are.
            "target_path": F.when(
                F.col("status") == "quarantined", F.concat(F.lit(f"quarantine/seq={seq}/dataset="), F.col("dataset"))
            ).otherwise(F.col("target_path")),
        }
    )
    manifest.write.mode("overwrite").parquet(tables.path("manifest", seq))
    tables.finished(seq)


def _readable(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(arrived.literal_path(path)).write.format("noop").mode("overwrite").save()
        return True
    except (PySparkException, Py4JJavaError):
        return False


def quarantined(spark: SparkSession, checked: DataFrame, target: str, ranged: bool = True) -> DataFrame:
    """Copies the lines of bad files to `target`, by dataset, and gives the verdict on each file.

    The lines are kept as text with their file and place, as the columns of such a file are in
    doubt. If not all files can be read, tasks try each alone, so that one leaves the others as
    they are: a file that was copied is `quarantined`, one that was not has `failed`. The files
    themselves stay where they are. Where only Spark can read the store (not `ranged`), the driver
    tries them one after the other.
    """
    named = checked.where(~F.col("is_valid") & ~F.col("gone")).select("dataset", "path", "length")
    bad = named.collect()
    source = arrived.plain_path(F.col("_metadata.file_path"))

    def copy(paths: list[str]) -> None:
        if paths:
            lines = spark.read.text([arrived.literal_path(p) for p in paths]).select(
                source.alias("path"),
                F.col("_metadata.file_block_start").alias("block_start"),
                F.monotonically_increasing_id().alias("position"),
                F.col("value").alias("line"),
            )
            rows = lines.join(named.select("dataset", "path"), "path")
            rows.write.mode("overwrite").partitionBy("dataset").parquet(target)

    filled = [r.path for r in bad if r.length]
    try:
        copy(filled)
    except (PySparkException, Py4JJavaError):
        if ranged:
            some = named.where("length > 0")
            filled = [r.path for r in arrived.readable(some, len(filled)).collect()]
        else:
            filled = [p for p in filled if _readable(spark, p)]
        copy(filled)
    aside = [(p,) for p in filled] + [(r.path,) for r in bad if not r.length]
    done = spark.createDataFrame(aside, "path string").withColumn("_aside", F.lit(True))
    outcome = F.coalesce("_aside", F.lit(False))
    return validation.file_verdicts(checked.join(done, "path", "left"), outcome).drop("_aside")


def _figures(
    spark: SparkSession, verdicts: DataFrame, tables: Tables, seq: int, settings: Settings
) -> dict[str, int]:
    """Lands the good files, computes both tables and writes them; gives the counts of rows."""
    _require_usable(verdicts, settings)
    root = tables.path("history")
    good = verdicts.where("status = 'passed'")

    def load(dataset: str) -> DataFrame:
        rows = csvdata.read_by_name(spark, good.where(F.col("dataset") == dataset), dataset, settings.key_type)
        key = {"orders": "order_id", "products": "id"}.get(dataset) if settings.drop_repeats else None
        return sales.one_per_key(rows, key) if key else rows

    typed = {
        "orders": sales.prepare_orders(load("orders")),
        # The price stays as it came; it gets its type where it is added up.
        "order_items": sales.name_items(load("order_items")),
        "products": sales.prepare_products(load("products")),
    }
    landed = session.together(
        {name: lambda n=name, rows=rows: history.land(rows, root, n, seq) for name, rows in typed.items()}
    )
    # Counted from the footers of the landed files.
    source = {r.dataset: r.source_rows for r in counts.source_counts(landed).collect()}
    empty = sorted(name for name, rows in source.items() if rows == 0)
    if empty and settings.require_all:
        raise counts.EmptyDataset(f"One or more datasets are empty: {', '.join(empty)}")

    days = None
    if settings.mode == "replace":
        figures = _replace(landed, settings)
    else:
        days, figures = _recompute(landed, root, seq, settings)

    names = {CATEGORY_TABLE: "categoryMetrics", ORDER_TABLE: "orderMetrics"}
    done = session.together(
        {
            names[table]: lambda t=table, rows=rows: upsert.upsert(
                rows, tables.path(t), TABLE_KEYS[t], seq, f"{tables.path('work', seq)}/{t}", days
            )
            for table, rows in figures.items()
        }
    )
    return {
        **{name: outcome["written"] for name, outcome in done.items()},
        "rejected": sum(outcome["rejected"] for outcome in done.values()),
        **{f"source_{name}": rows for name, rows in source.items()},
    }


def _require_usable(verdicts: DataFrame, settings: Settings) -> None:
    if not settings.require_all:
        return
    status = validation.validation_status(validation.validation_rollup(verdicts)).first()
    if status.status == "failure":
        raise RunFailed(status.message)
    if status.usable_per_dataset == 0:
        raise RunFailed(f"No usable files for a dataset ({status.message})")


def _replace(landed: dict[str, DataFrame], settings: Settings) -> dict[str, DataFrame]:
    orders, products = landed["orders"], landed["products"]
    items = sales.priced(landed["order_items"], settings.money)
    return {
        CATEGORY_TABLE: kpis.category_daily_kpis(items, orders, products),
        ORDER_TABLE: kpis.order_daily_kpis(items, orders, settings.unique_orders or settings.drop_repeats),
    }


def _recompute(
    landed: dict[str, DataFrame], root: str, seq: int, settings: Settings
) -> tuple[DataFrame, dict[str, DataFrame]]:
    days, category, day = history.recomputed(landed, root, seq, settings.money, settings.buckets)
    return days, {CATEGORY_TABLE: category, ORDER_TABLE: day}
