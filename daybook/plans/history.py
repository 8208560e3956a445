"""What all runs delivered, kept as sums, so that late files move figures by what they change.

Each run lands its typed rows in folders of its number, `seq`. A recompute run also works in its
own rows, and those of runs that did not. It reads no old lines, but sums that earlier runs left:

* `orders`: versions of orders,
* `sums`: items added up by order and product, also of orders that have not come yet,
* `products`: versions of products,
* `buyers`: orders by day and buyer,
* `days` and `categories`: the totals behind the two tables.

A run adds rows to these, signed where they count something: an order that got an item takes its
old sums out of its day and puts the new ones in. The present state is the sum, or the latest
version, of a key's rows. So a day's buyers, which are different ones counted, come from counts that
reach or leave zero, and nothing of that day is read anew.

`orders`, `sums` and `buyers` are bucketed and sorted by their key: joins and sums with them move
the run's rows only. One small file says which runs' rows count; it is replaced last. Runs add up
until `COMPACT` of them are put into one.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from daybook import storage
from daybook.operators import kpis, sales
from daybook.settings import together

BUCKETS = 16
COMPACT = 32  # runs
HASHED = 1 << 20  # a run's keys in a bucket that a task holds, to look stored rows up in; more are sorted
LANDED = ("orders", "order_items", "products")
STATE = "state.json"

# What is added up of items. Prices that are no numbers are counted apart, as they do not go away
# by subtraction; `priced` counts those that are not NULL.
MONEY = {"float32": "double", "decimal": "decimal(37,10)"}  # one digit less than a sum may have
ADDED = ("price", "priced", "nan", "up", "down", "items", "returned")
# The key of each state table, and whether it is in buckets of (the first of) it.
KEYS = {
    "orders": ["order_id"],
    "sums": ["order_id", "product_id"],
    "buyers": ["order_date", "user_id"],
    "products": ["product_id"],
    "days": ["order_date"],
    "categories": ["category", "order_date"],
}
BUCKETED = {"orders": ["order_id"], "sums": ["order_id"], "buyers": ["order_date", "user_id"]}
VERSIONS = ("orders", "products")  # the latest counts; rows of the others are added up


def _part(root: str, name: str, seq: int) -> str:
    return f"{root}/{name}/seq={seq}"


def land(rows: DataFrame, root: str, name: str, seq: int) -> DataFrame:
    """Writes a run's rows once as Parquet and gives them back from there."""
    path = _part(root, name, seq)
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def drop(spark: SparkSession, root: str, seq: int) -> None:
    """Forgets what a failed run landed."""
    for name in LANDED:
        storage.delete(spark, _part(root, name, seq))


def landed(spark: SparkSession, root: str, seq: int) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(_part(root, name, seq)) for name in LANDED}


def added(money: str) -> list[Column]:
    """`ADDED` of items (sale_price, item_id, is_returned) with a price of the money type."""
    price, odd = F.col("sale_price"), {"nan": F.lit(False), "up": F.lit(False), "down": F.lit(False)}
    finite = price
    if money == "float32":
        price = price.cast("double")
        odd = {"nan": F.isnan(price), "up": price == float("inf"), "down": price == float("-inf")}
        finite = F.when(~(odd["nan"] | odd["up"] | odd["down"]), price)
    return [
        F.coalesce(F.sum(finite), F.lit(0)).alias("price"),
        F.count(price).alias("priced"),
        *[F.count_if(test).alias(name) for name, test in odd.items()],
        F.count("item_id").alias("items"),
        F.coalesce(F.sum("is_returned"), F.lit(0)).cast("bigint").alias("returned"),
    ]


def revenue(money: str) -> Column:
    """The sum of prices that `ADDED` stands for: NULL of none, and as numbers that are none add up."""
    plain = F.when(F.col("priced") > 0, F.col("price"))
    if money != "float32":
        return plain
    up, down = F.col("up") > 0, F.col("down") > 0
    odd = F.when((F.col("nan") > 0) | (up & down), float("nan")).when(up, float("inf")).when(down, float("-inf"))
    return F.when(F.col("nan") + F.col("up") + F.col("down") > 0, odd).otherwise(plain)


class State:
    """The tables below `root`, as the runs left them whose rows count."""

    def __init__(self, spark: SparkSession, root: str, key: str, money: str, buckets: int):
        self.spark, self.root, self.buckets = spark, storage.qualified(spark, root), buckets
        sums = f"price {money}, " + ", ".join(f"{c} bigint" for c in ADDED[1:])
        self.columns = {
            "orders": f"order_id {key}, user_id {key}, order_date date",
            "sums": f"order_id {key}, product_id {key}, {sums}, lines bigint",
            "buyers": f"order_date date, user_id {key}, orders bigint",
            "products": f"product_id {key}, category string",
            "days": f"order_date date, orders bigint, {sums}, buyers bigint",
            "categories": f"category string, order_date date, orders bigint, {sums}",
        }
        held = f"{self.root}/{STATE}"
        known = json.loads(storage.read_text(spark, held)) if storage.exists(spark, held) else {}
        self.live: list[int] = known.get("live", [])
        self.done: int = known.get("done", -1)
        # Tables that hold rows; a state written before this was noted may hold any.
        self.held: set[str] = set(known.get("held", self.columns if self.live else ()))
        mark = hashlib.sha256(self.root.encode()).hexdigest()[:16]
        self.names = {name: f"daybook_{mark}_{name}" for name in self.columns}
        for name in BUCKETED:
            # Only the catalog knows of buckets; the table's files stay when its name is dropped.
            spark.sql(f"DROP TABLE IF EXISTS {self.names[name]}")
            by = ", ".join(BUCKETED[name])
            spark.sql(
                f"CREATE TABLE {self.names[name]} ({self.columns[name]}, seq int) USING parquet PARTITIONED BY (seq) "
                f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{self.root}/{name}_state'"
            )
            if self.live:
                parts = " ".join(f"PARTITION (seq={seq})" for seq in self.live)
                spark.sql(f"ALTER TABLE {self.names[name]} ADD IF NOT EXISTS {parts}")

    def schema(self, name: str) -> T.StructType:
        return T.StructType.fromDDL(self.columns[name])

    def rows(self, name: str, *also: int) -> DataFrame:
        """All rows that count, with their run, and those of the runs `also`."""
        schema, runs = storage.with_partitions(self.schema(name), seq=T.IntegerType()), [*self.live, *also]
        if not runs:
            return self.spark.createDataFrame([], schema)
        if name in BUCKETED:
            return self.spark.table(self.names[name]).where(F.col("seq").isin(runs))
        paths = [_part(self.root, f"{name}_state", seq) for seq in runs]
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}_state").parquet(*paths)

    def now(self, name: str, among: DataFrame | None = None) -> DataFrame:
        """One row per key; `among` (some of the key's columns) narrows the keys down."""
        rows, keys = self.rows(name), KEYS[name]
        if among is not None:
            rows = rows.join(among, among.columns, "left_semi")
        values = [c for c in rows.columns if c not in (*keys, "seq")]
        if name in VERSIONS:
            last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "seq").alias("_last"))
            return last.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in values])
        return rows.groupBy(*keys).agg(*[F.sum(c).cast(rows.schema[c].dataType).alias(c) for c in values])

    def dealt(self, name: str, rows: DataFrame) -> DataFrame:
        """The rows in the partitions that the buckets of a table are, so that a join with it moves
        these rows alone, also where the session has more shuffle partitions than there are buckets."""
        return rows.repartition(self.buckets, *BUCKETED[name])

    def write(self, name: str, rows: DataFrame, seq: int) -> None:
        """Adds rows as those of run `seq`, in the place of any it wrote before."""
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema(name)]
        rows = rows.select(*columns)
        if name not in BUCKETED:
            rows.write.mode("overwrite").parquet(_part(self.root, f"{name}_state", seq))
            return
        storage.delete(self.spark, _part(self.root, f"{name}_state", seq))
        self.dealt(name, rows.withColumn("seq", F.lit(seq))).write.mode("append").insertInto(self.names[name])

    def write_none(self, name: str, seq: int) -> None:
        """Run `seq` adds no rows, in the place of any it wrote before."""
        if name in BUCKETED:
            storage.delete(self.spark, _part(self.root, f"{name}_state", seq))
        else:
            self.write(name, self.spark.createDataFrame([], self.schema(name)), seq)

    def commit(self, live: list[int], done: int) -> None:
        text = json.dumps({"live": live, "done": done, "held": sorted(self.held)})
        storage.replace_text(self.spark, f"{self.root}/{STATE}", text)
        self.live, self.done = live, done

    def compact(self) -> None:
        """Puts the rows of all runs into one, of a number that comes before theirs."""
        old, base = self.live, -2 - self.done
        for name in self.columns:
            self.write(name, self.now(name), base)
        self.commit([base], self.done)
        for seq in old:
            for name in self.columns:
                storage.delete(self.spark, _part(self.root, f"{name}_state", seq))


def _new_versions(frames: list[tuple[int, DataFrame]], key: str) -> DataFrame:
    """One row per key, the greatest of the latest run."""
    rows = None
    for seq, frame in frames:
        some = frame.where(F.col(key).isNotNull()).select(key, F.lit(seq).alias("_seq"), *[c for c in frame.columns if c != key])
        rows = some if rows is None else rows.unionByName(some)
    return sales.one_per_key(rows, key).drop("_seq")


def _came(state: State, runs: list[tuple[int, dict[str, DataFrame]]], money: str, seq: int) -> None:
    """Adds to the state, as rows of run `seq`, the items, orders and products that came."""
    items = None
    for _, rows in runs:
        own = sales.priced(rows["order_items"].where("order_id is not null"), money)
        items = own if items is None else items.unionByName(own)
    came = items.groupBy("order_id", "product_id").agg(*added(money), F.count("*").alias("lines"))
    orders = _new_versions([(n, rows["orders"]) for n, rows in runs], "order_id")
    new = _new_versions([(n, rows["products"]) for n, rows in runs], "product_id")
    if state.live:
        old_products = state.now("products", new.select("product_id")).withColumn("_known", F.lit(True))
        joined = new.join(old_products.withColumnRenamed("category", "_was"), "product_id", "left")
        new = joined.where(F.col("_known").isNull() | ~F.col("category").eqNullSafe(F.col("_was")))
    fresh = {"sums": came, "orders": orders, "products": new}
    together({name: lambda n=name, rows=rows: state.write(n, rows, seq) for name, rows in fresh.items()})
    state.held |= {name for name in fresh if not _written(state, name, seq).isEmpty()}


def _written(state: State, name: str, seq: int) -> DataFrame:
    """The rows that run `seq` has just added."""
    if not storage.exists(state.spark, _part(state.root, f"{name}_state", seq)):
        return state.spark.createDataFrame([], state.schema(name))
    return state.spark.read.schema(state.schema(name)).parquet(_part(state.root, f"{name}_state", seq))


def _touched(state: State, seq: int) -> DataFrame:
    """Orders that run `seq` brought, or items of them."""
    return _written(state, "sums", seq).select("order_id").unionByName(_written(state, "orders", seq).select("order_id"))


def _resold(state: State, seq: int) -> DataFrame:
    """Orders with lines of a product that run `seq` brought under a new category."""
    products = _written(state, "products", seq).select("product_id")
    return state.rows("sums").join(products, "product_id", "left_semi").select("order_id")


def _lines(state: State, touched: DataFrame | None, seq: int) -> tuple[DataFrame, DataFrame]:
    """Of the touched orders (of all, where None): the sums by product, with `came` for those of run
    `seq`; and each order as it was (`old_`) and as it is now (`new_`). Both lie in buckets of the
    order, which are only read, and sorted by it there: what lies before the first touched order or
    behind the last is skipped."""
    sums, orders, few = state.rows("sums", seq), state.rows("orders", seq), False
    if touched is not None:
        first, last, number = touched.agg(F.min("order_id"), F.max("order_id"), F.count("*")).first()
        touched = state.dealt("orders", touched).distinct()
        few = number <= HASHED * state.buckets
        if few:
            touched = touched.hint("shuffle_hash")
        near = F.col("order_id").between(first, last)
        sums, orders = (rows.where(near).join(touched, "order_id", "left_semi") for rows in (sums, orders))
    before = F.when(F.col("seq") != seq, F.col("seq"))
    heads = orders.groupBy("order_id").agg(
        F.max(before).isNotNull().alias("old_order"),
        *[F.max_by(c, before).alias(f"old_{side}") for c, side in (("user_id", "user"), ("order_date", "date"))],
        *[F.max_by(c, "seq").alias(f"new_{side}") for c, side in (("user_id", "user"), ("order_date", "date"))],
    )
    return sums.withColumn("came", F.col("seq") == seq).drop("seq"), heads.hint("shuffle_hash") if few else heads


def _sides(rows: DataFrame, columns: dict[str, str], counted: dict[str, Column]) -> DataFrame:
    """Rows of before, to take out, and of now, to put in: `columns` renamed, sums signed, and
    `orders` -1 or 1. `counted` says which rows of a side there are."""

    def side(name: str, signed: Callable[[Column], Column]) -> Column:
        return F.struct(
            *[F.col(c.format(name)).alias(new) for new, c in columns.items()],
            *[signed(F.col(f"{name}_{c}")).alias(c) for c in ADDED],
            signed(F.lit(1).cast("bigint")).alias("orders"),
        )

    signs = {"old": F.negative, "new": lambda c: c}
    both = [F.when(test, side(name, signs[name])) for name, test in counted.items()]
    if len(both) == 1:
        return rows.select(both[0].alias("_side")).where("_side is not null").select("_side.*")
    # A side that does not count is a row of NULLs.
    return rows.select(F.inline(F.array(*both))).where("orders is not null")


def _sums(*names: str) -> list[Column]:
    return [F.sum(c).alias(c) for c in names]


def _by_day(state: State, seq: int) -> None:
    """Adds to the counts by day and buyer what the orders move that run `seq` touched."""
    if not {"sums", "orders"} <= state.held:
        # No order has both a day and lines.
        for name in ("buyers", "days"):
            state.write_none(name, seq)
        return
    lines, heads = _lines(state, _touched(state, seq) if state.live else None, seq)
    none = {c: F.lit(0).cast(lines.schema[c].dataType) for c in (*ADDED, "lines")}
    both = lines.groupBy("order_id").agg(
        *[F.sum(F.when(F.col("came"), zero).otherwise(F.col(c))).alias(f"old_{c}") for c, zero in none.items()],
        *[F.sum(c).alias(f"new_{c}") for c in none],
    )
    # One row per order, where it is not as it was.
    same = F.col("old_order")
    for c in ("user", "date", *ADDED, "lines"):
        same = same & F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}"))
    head = {"order_date": "{}_date", "user_id": "{}_user"}
    counted = {"old": F.col("old_order") & (F.col("old_lines") > 0), "new": F.col("new_lines") > 0}
    sides = _sides(both.join(heads, "order_id").where(~same), head, counted)
    moved = sides.groupBy("order_date", "user_id").agg(*_sums(*ADDED, "orders"))
    moved = land(moved, state.root, "moved", seq)
    buyers = moved.where("order_date is not null and user_id is not null and orders <> 0")
    state.write("buyers", buyers, seq)
    rows = state.rows("buyers", seq)
    if state.live:
        own = state.dealt("buyers", _written(state, "buyers", seq).select("order_date", "user_id"))
        if moved.count() <= HASHED * state.buckets:
            own = own.hint("shuffle_hash")
        rows = rows.join(own, ["order_date", "user_id"], "left_semi")
    had = F.sum(F.when(F.col("seq") != seq, F.col("orders")).otherwise(F.lit(0)))
    turn = (F.sum("orders") > 0).cast("bigint") - (had > 0).cast("bigint")
    turned = rows.groupBy("order_date", "user_id").agg(turn.alias("buyers"))
    zeros = [F.lit(0).cast(state.schema("days")[c].dataType).alias(c) for c in ("orders", *ADDED)]
    days = moved.select("order_date", "orders", *ADDED, F.lit(0).cast("bigint").alias("buyers")).unionByName(
        turned.select("order_date", *zeros, "buyers")
    )
    state.write("days", days.groupBy("order_date").agg(*_sums("orders", *ADDED, "buyers")), seq)


def _by_category(state: State, seq: int, had: set[str]) -> None:
    """Adds to the counts by category what the orders and products move that run `seq` touched. An
    order counts once in each category that it has lines of. `had`: the tables that held rows
    before the run; with its first products every order's lines get their category."""
    if not {"sums", "orders", "products"} <= state.held:
        state.write_none("categories", seq)
        return
    touched = None
    if "products" in had:
        touched = _touched(state, seq).unionByName(_resold(state, seq))
    lines, heads = _lines(state, touched, seq)
    before = F.when(F.col("seq") != seq, F.col("seq"))
    products = state.rows("products", seq).groupBy("product_id").agg(
        F.max(before).isNotNull().alias("old_product"),
        F.max_by("category", before).alias("old_category"),
        F.max_by("category", "seq").alias("new_category"),
    )
    known = lines.join(heads.select("order_id", "old_order", "old_date", "new_date"), "order_id").join(products, "product_id")
    known = known.withColumns({f"{side}_{c}": F.col(c) for side in ("old", "new") for c in ADDED})
    place = {"order_id": "order_id", "category": "{}_category", "order_date": "{}_date"}
    counted = {"old": ~F.col("came") & F.col("old_order") & F.col("old_product"), "new": F.lit(True)}
    if "products" not in had:
        del counted["old"]
    held = _sides(known, place, counted).groupBy("order_id", "category", "order_date").agg(
        *_sums(*ADDED),
        (F.max((F.col("orders") > 0).cast("int")) - F.max((F.col("orders") < 0).cast("int"))).alias("orders"),
    )
    still = F.col("orders") == 0
    for c in ADDED:
        still = still & (F.col(c) == 0)
    totals = held.where(~still).groupBy("category", "order_date").agg(*_sums("orders", *ADDED))
    state.write("categories", totals, seq)


def _figures(state: State, money: str, seq: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(days that run `seq` touched, category figures and day figures of these days)."""
    own = _written(state, "days", seq).select("order_date").unionByName(_written(state, "categories", seq).select("order_date"))
    touched = land(own.distinct().coalesce(1), state.root, "touched", seq)

    def totals(name: str) -> DataFrame:
        rows = state.rows(name).join(
            touched.select(F.col("order_date").alias("_day")), F.col("order_date").eqNullSafe(F.col("_day")), "left_semi"
        )
        values = [c for c in rows.columns if c not in (*KEYS[name], "seq")]
        return rows.groupBy(*KEYS[name]).agg(*_sums(*values)).where("orders > 0").withColumn("revenue", revenue(money))

    return touched, kpis.category_totals(totals("categories")), kpis.day_totals(totals("days"))


def recomputed(
    rows: dict[str, DataFrame], root: str, seq: int, money: str = "float32", buckets: int = BUCKETS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(days that run `seq`, or runs that were not worked in yet, may have changed; the category
    figures and the day figures of these days)."""
    spark = rows["orders"].sparkSession
    key = rows["orders"].schema["order_id"].dataType.simpleString()
    state = State(spark, root, key, MONEY[money], buckets)
    if state.done < seq:
        if len(state.live) >= COMPACT:
            state.compact()
        earlier = range(state.done + 1, seq)
        behind = [n for n in earlier if storage.has_data(spark, _part(root, "products", n))]
        runs = [*((n, landed(spark, root, n)) for n in behind), (seq, rows)]
        had = set(state.held)
        _came(state, runs, money, seq)
        together({"days": lambda: _by_day(state, seq), "categories": lambda: _by_category(state, seq, had)})
        state.commit([*state.live, seq], seq)
        for name, old in (("moved", seq), ("touched", earlier.start - 1)):
            storage.delete(spark, _part(state.root, name, old))
    return _figures(state, money, seq)
