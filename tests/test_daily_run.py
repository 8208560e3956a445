import datetime as dt
import re

import pytest

from daybook.operators import upsert
from daybook.plans import daily_run
from daybook.plans.daily_run import RunFailed, Settings
from session_confs import configured


def table(spark, root, name):
    df = upsert.read(spark, f"{root}/{name}").drop("order_month")
    return sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


def by_day(spark, root):
    return {r.order_date: r for r in upsert.read(spark, f"{root}/order_metrics_table").collect()}


DAY1, DAY2 = dt.date(2025, 1, 1), dt.date(2025, 1, 2)


@pytest.mark.parametrize("mode,late_revenue", [("replace", 1.0), ("recompute", 15.75)])
def test_whole_run_then_late_file(spark, drop, tmp_path, mode, late_revenue):
    out = str(tmp_path / "out")
    row = daily_run.run(spark, drop.good().base, out, "run-1", Settings(mode=mode)).first()
    # Two days, three (category, day) pairs.
    assert (row.status, row.recordsProcessed, row.categoryMetrics, row.orderMetrics) == ("success", 5, 3, 2)
    assert (row.failedRecords, row.archiveStatus, row.executionId) == (0, "success", "run-1")
    assert row.processedFiles.asDict() == {"orders": 1, "orderItems": 1, "products": 1}
    assert row.sourceRows.asDict() == {"orders": 2, "orderItems": 3, "products": 2}
    assert row.message.startswith("SUCCESS: Execution run-1")
    days = by_day(spark, out)
    assert (days[DAY1].total_orders, days[DAY1].total_revenue, days[DAY1].total_items_sold) == (1, 14.75, 2)
    assert (days[DAY1].return_rate, days[DAY1].unique_customers) == (1.0, 1)
    # Nothing new: nothing happens.
    assert daily_run.run(spark, drop.base, out, "run-2", Settings(mode=mode)) is None

    # In replace mode the late part needs its order and product again; the other mode knows them.
    drop.put("orders/late.csv", "order_id,user_id,created_at,status\n1,10,2025-01-01,done\n")
    drop.put("order_items/late.csv", "id,order_id,product_id,sale_price,status\n4,1,101,1.00,done\n")
    drop.put("products/late.csv", "id,sku,cost,category,retail_price\n101,B,1.0,Books,2.0\n")
    daily_run.run(spark, drop.base, out, "run-3", Settings(mode=mode))
    days = by_day(spark, out)
    assert days[DAY1].total_revenue == late_revenue
    assert days[DAY2].total_revenue == 20.0


ORDER_HEAD = "order_id,user_id,created_at,status\n"
ITEM_HEAD = "id,order_id,product_id,sale_price,status\n"
PRODUCT_HEAD = "id,sku,cost,category,retail_price\n"
RECOMPUTE = Settings(mode="recompute", require_all=False)


def test_waits_for_all_datasets(spark, drop, tmp_path):
    drop.put("orders/o.csv", ORDER_HEAD + "1,10,2025-01-01,x\n")
    drop.put("products/p.txt", PRODUCT_HEAD)
    assert daily_run.run(spark, drop.base, str(tmp_path / "out"), "r") is None
    assert not (tmp_path / "out").exists()


def test_bad_files_and_null_keys(spark, drop, tmp_path):
    out = str(tmp_path / "out")
    drop.good()
    drop.put("orders/bad.csv", "order_id,user_id,created_at\n7,70,2025-01-01\n1,10,2025-01-01\n")
    drop.put("orders/sub/empty.csv", "")
    drop.put("orders/day.csv", ORDER_HEAD + "3,12,no day,x\n")
    drop.put("order_items/more.csv", ITEM_HEAD + "8,3,100,1.00,x\n9,1,102,2.00,x\n")
    drop.put("products/gap.csv", PRODUCT_HEAD + "102,C,1,,1\n")
    row = daily_run.run(spark, drop.base, out, "r").first()
    # No category on day 1 and Toys without a day; and the day table's row without a day.
    assert (row.categoryMetrics, row.orderMetrics, row.failedRecords) == (3, 2, 3)
    assert row.recordsProcessed == 5
    assert row.processedFiles.asDict() == {"orders": 2, "orderItems": 2, "products": 2}
    assert "Total files: 8, Passed: 6, Failed: 2, Quarantined: 2" in row.message
    aside = spark.read.parquet(f"{out}/quarantine/seq=0")
    assert sorted(r.line for r in aside.collect()) == ["1,10,2025-01-01", "7,70,2025-01-01", "order_id,user_id,created_at"]
    assert {r.dataset for r in aside.collect()} == {"orders"}
    # The bad file still lies there and holds order 1 once more, but is not read.
    days = by_day(spark, out)
    assert (days[DAY1].total_orders, days[DAY1].total_revenue) == (1, 16.75)
    manifest = {r.key: (r.status, r.moved, r.target_path) for r in spark.read.parquet(f"{out}/manifest").collect()}
    assert manifest["orders/bad.csv"] == ("quarantined", True, "quarantine/seq=0/dataset=orders")
    issues = {r.key: r.issues for r in spark.read.parquet(f"{out}/manifest").collect()}
    assert issues["orders/bad.csv"] == ["Missing mandatory fields: ['status']"]
    assert manifest["orders/o.csv"][2].startswith("processed/r/")
    assert manifest["orders/o.csv"][2].endswith("/orders/o.csv")
    assert daily_run.run(spark, drop.base, out, "r2") is None


@pytest.mark.parametrize(
    "key,text,reason",
    [
        ("products/p.csv", "id,sku\n1,2\n", "No usable files"),
        ("products/p.csv", PRODUCT_HEAD, "One or more datasets are empty: products"),
        ("order_items/i.csv", "id,order_id,product_id,sale_price\n1,1,100,1.0\n", "lack status"),
    ],
)
def test_failed_run_leaves_good_files(spark, drop, tmp_path, key, text, reason):
    out = str(tmp_path / "out")
    drop.good().put(key, text)
    with pytest.raises(RunFailed, match=reason):
        daily_run.run(spark, drop.base, out, "r1")
    failure = spark.read.parquet(f"{out}/run_report/seq=0").first()
    assert (failure.status, failure.recordsProcessed, failure.executionId) == ("failure", 0, "r1")
    assert failure.message.startswith("FAILURE: Execution r1")
    assert not (tmp_path / "out" / "order_metrics_table").exists()
    # With a good file in place of the bad one everything is there.
    drop.good()
    row = daily_run.run(spark, drop.base, out, "r2").first()
    assert (row.status, row.categoryMetrics, row.orderMetrics) == ("success", 3, 2)


def test_recompute_over_runs(spark, drop, tmp_path):
    out = str(tmp_path / "out")
    # An item before its order and product.
    drop.put("order_items/early.csv", ITEM_HEAD + "1,1,100,10.00,x\n5,,100,1.00,x\n")
    row = daily_run.run(spark, drop.base, out, "r0", RECOMPUTE).first()
    assert (row.categoryMetrics, row.orderMetrics) == (0, 0)
    drop.put("orders/o.csv", ORDER_HEAD + "1,10,2025-01-01,x\n")
    daily_run.run(spark, drop.base, out, "r1", RECOMPUTE)
    assert by_day(spark, out)[DAY1].total_revenue == 10.0
    assert table(spark, out, "category_metrics_table") == []
    # Its product comes last, then the order again with one more item, then a new category.
    drop.put("products/p.csv", PRODUCT_HEAD + "100,A,1,Toys,1\n")
    daily_run.run(spark, drop.base, out, "r2", RECOMPUTE)
    assert table(spark, out, "category_metrics_table") == [(10.0, 0.0, "Toys", 10.0, DAY1)]
    drop.put("orders/again.csv", ORDER_HEAD + "1,10,2025-01-01,x\n")
    drop.put("order_items/more.csv", ITEM_HEAD + "2,1,100,5.00,returned\n")
    daily_run.run(spark, drop.base, out, "r3", RECOMPUTE)
    days = by_day(spark, out)
    assert (days[DAY1].total_orders, days[DAY1].total_revenue, days[DAY1].total_items_sold) == (1, 15.0, 2)
    drop.put("products/new.csv", PRODUCT_HEAD + "100,A,1,Games,1\n")
    daily_run.run(spark, drop.base, out, "r4", RECOMPUTE)
    assert table(spark, out, "category_metrics_table") == [(15.0, 1.0, "Games", 15.0, DAY1)]


def test_broken_run_is_finished_first(spark, drop, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    whole = daily_run.upsert.upsert

    def break_at_orders(new, target, *rest):
        if "order_metrics" in target:
            raise OSError("lost")
        return whole(new, target, *rest)

    monkeypatch.setattr(daily_run.upsert, "upsert", break_at_orders)
    with pytest.raises(OSError):
        daily_run.run(spark, drop.good().base, out, "r1", Settings(mode="recompute"))
    monkeypatch.setattr(daily_run.upsert, "upsert", whole)
    # Meanwhile more files came; they make a run of their own.
    drop.put("orders/late.csv", ORDER_HEAD + "9,19,2025-01-02,x\n")
    drop.put("order_items/late.csv", ITEM_HEAD + "4,1,101,1.00,x\n9,9,100,3.00,x\n")
    drop.put("products/late.csv", PRODUCT_HEAD + "103,D,1,Books,1\n")
    daily_run.run(spark, drop.base, out, "r2", Settings(mode="recompute"))
    assert sorted(r.seq for r in spark.read.parquet(f"{out}/manifest").select("seq").distinct().collect()) == [0, 1]
    days = by_day(spark, out)
    assert (days[DAY1].total_revenue, days[DAY2].total_revenue, days[DAY2].total_orders) == (15.75, 23.0, 2)


def test_file_written_anew_is_a_new_file(spark, drop, tmp_path):
    import os

    out = str(tmp_path / "out")
    daily_run.run(spark, drop.good().base, out, "r1")
    drop.good()
    for name in ("orders/o.csv", "order_items/i.csv", "products/p.csv"):
        os.utime(f"{drop.base}/{name}", (2_000_000_000, 2_000_000_000))
    assert daily_run.run(spark, drop.base, out, "r2").first().recordsProcessed == 5


def test_repeats_dropped_and_text_ids(spark, drop, tmp_path):
    out = str(tmp_path / "out")
    drop.put("orders/o.csv", ORDER_HEAD + "A1,u,2025-01-01,x\nA1,u,2025-01-01,x\n")
    drop.put("order_items/i.csv", ITEM_HEAD + "i1,A1,p,1.50,x\ni2,A1,p,1.50,x\n")
    drop.put("products/p.csv", PRODUCT_HEAD + "p,A,1,Toys,1\np,A,1,Toys,1\n")
    daily_run.run(spark, drop.base, out, "r", Settings(key_type="string", drop_repeats=True))
    assert table(spark, out, "category_metrics_table") == [(3.0, 0.0, "Toys", 3.0, DAY1)]
    day = by_day(spark, out)[DAY1]
    assert (day.total_orders, day.total_revenue, day.total_items_sold, day.unique_customers) == (1, 3.0, 2, 1)


def test_recompute_after_replace_counts_everything(spark, drop, tmp_path):
    out = str(tmp_path / "out")
    drop.put("orders/o.csv", ORDER_HEAD + "1,10,2025-01-01,x\n2,11,2025-01-01,x\n")
    drop.put("order_items/i.csv", ITEM_HEAD + "1,1,100,10.00,x\n2,2,100,20.00,x\n")
    drop.put("products/p.csv", PRODUCT_HEAD + "100,A,1,Toys,1\n")
    daily_run.run(spark, drop.base, out, "r0")
    assert by_day(spark, out)[DAY1].total_revenue == 30.0
    # One more late item by a replace run, which shows that part alone; then one by recompute.
    drop.put("orders/again.csv", ORDER_HEAD + "1,10,2025-01-01,x\n")
    drop.put("order_items/late.csv", ITEM_HEAD + "3,1,100,0.50,x\n")
    drop.put("products/again.csv", PRODUCT_HEAD + "100,A,1,Toys,1\n")
    daily_run.run(spark, drop.base, out, "r1")
    assert by_day(spark, out)[DAY1].total_revenue == 0.5
    drop.put("order_items/later.csv", ITEM_HEAD + "4,2,100,0.50,x\n")
    daily_run.run(spark, drop.base, out, "r2", RECOMPUTE)
    day = by_day(spark, out)[DAY1]
    assert (day.total_revenue, day.total_orders, day.total_items_sold) == (31.0, 2, 4)
    assert table(spark, out, "category_metrics_table")[0][2] == "Toys"


def test_a_corrected_order_moves_to_its_day(spark, drop, tmp_path):
    out = str(tmp_path / "out")
    drop.put("orders/o.csv", ORDER_HEAD + "1,10,no day,x\n2,10,2025-01-01,x\n")
    drop.put("order_items/i.csv", ITEM_HEAD + "1,1,100,10.00,x\n2,2,100,5.00,x\n")
    drop.put("products/p.csv", PRODUCT_HEAD + "100,A,1,Toys,1\n")
    daily_run.run(spark, drop.base, out, "r0", RECOMPUTE)
    assert {day: r.total_revenue for day, r in by_day(spark, out).items()} == {DAY1: 5.0}
    drop.put("orders/better.csv", ORDER_HEAD + "1,10,2025-01-01,x\n")
    daily_run.run(spark, drop.base, out, "r1", RECOMPUTE)
    assert by_day(spark, out)[DAY1].total_revenue == 15.0
    drop.put("orders/moved.csv", ORDER_HEAD + "1,10,2025-01-02,x\n2,12,2025-01-01,x\n")
    daily_run.run(spark, drop.base, out, "r2", RECOMPUTE)
    days = by_day(spark, out)
    assert (days[DAY1].total_revenue, days[DAY1].total_orders) == (5.0, 1)
    assert (days[DAY2].total_revenue, days[DAY2].total_orders) == (10.0, 1)
    # An item that comes after the move joins the order as it is now.
    drop.put("order_items/late.csv", ITEM_HEAD + "3,1,100,1.00,x\n")
    daily_run.run(spark, drop.base, out, "r3", RECOMPUTE)
    assert {day: r.total_revenue for day, r in by_day(spark, out).items()} == {DAY1: 5.0, DAY2: 11.0}


def test_an_order_whose_last_line_moves_away(spark, drop, tmp_path):
    out = str(tmp_path / "out")
    drop.put("orders/o.csv", ORDER_HEAD + "1,10,2025-01-01,x\n")
    drop.put("order_items/i.csv", ITEM_HEAD + "1,1,100,10.00,x\n")
    drop.put("products/p.csv", PRODUCT_HEAD + "100,A,1,Toys,1\n")
    daily_run.run(spark, drop.base, out, "r0", RECOMPUTE)
    drop.put("orders/moved.csv", ORDER_HEAD + "1,10,2025-02-03,x\n")
    daily_run.run(spark, drop.base, out, "r1", RECOMPUTE)
    days = {day: r.total_revenue for day, r in by_day(spark, out).items()}
    assert days == {dt.date(2025, 2, 3): 10.0}
    assert [r[4] for r in table(spark, out, "category_metrics_table")] == [dt.date(2025, 2, 3)]


def test_types_of_the_tables_stay(spark, drop, tmp_path):
    out = str(tmp_path / "out")
    daily_run.run(spark, drop.good().base, out, "r0", Settings(money="decimal"))
    drop.put("order_items/late.csv", ITEM_HEAD + "4,1,101,19.999,x\n")
    late = Settings(mode="recompute", require_all=False)
    with pytest.raises(daily_run.SettingsConflict, match="float32"):
        daily_run.run(spark, drop.base, out, "r1", late)
    daily_run.run(spark, drop.base, out, "r1", Settings(mode="recompute", require_all=False, money="decimal"))
    assert str(by_day(spark, out)[DAY1].total_revenue) == "34.75"


def test_settings_that_make_no_sense():
    for wrong in ({"mode": "other"}, {"money": "cents"}, {"mode": "replace", "require_all": False}):
        with pytest.raises(ValueError):
            Settings(**wrong)


def break_in(monkeypatch, where):
    """The run breaks before it writes the given table."""
    whole = daily_run.upsert.upsert

    def broken(new, target, *rest):
        if where in target:
            raise OSError("lost")
        return whole(new, target, *rest)

    monkeypatch.setattr(daily_run.upsert, "upsert", broken)
    return lambda: monkeypatch.setattr(daily_run.upsert, "upsert", whole)


def test_an_open_run_keeps_its_settings(spark, drop, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    mend = break_in(monkeypatch, "metrics")
    with pytest.raises(OSError):
        daily_run.run(spark, drop.good().base, out, "first", Settings(money="decimal"))
    mend()
    row = daily_run.run(spark, drop.base, out, "second", RECOMPUTE).first()
    assert (row.executionId, row.status) == ("first", "success")
    assert "decimal" in dict(upsert.read(spark, f"{out}/order_metrics_table").dtypes)["total_revenue"]


def test_an_open_run_outlives_a_file_that_has_gone(spark, drop, tmp_path, monkeypatch):
    import os

    out = str(tmp_path / "out")
    mend = break_in(monkeypatch, "metrics")
    drop.good().put("orders/more.csv", ORDER_HEAD + "3,12,2025-01-02,x\n")
    with pytest.raises(OSError):
        daily_run.run(spark, drop.base, out, "r1")
    mend()
    os.remove(f"{drop.base}/orders/more.csv")
    row = daily_run.run(spark, drop.base, out, "r2").first()
    assert (row.status, row.archiveStatus, row.processedFiles.orders) == ("success", "partial_failure", 1)
    gone = {r.key: (r.status, r.issues) for r in spark.read.parquet(f"{out}/manifest").collect()}["orders/more.csv"]
    assert gone == ("failed", ["The file has gone"])


def test_an_open_run_that_cannot_be_finished_is_closed(spark, drop, tmp_path, monkeypatch):
    import os

    out = str(tmp_path / "out")
    mend = break_in(monkeypatch, "metrics")
    with pytest.raises(OSError):
        daily_run.run(spark, drop.good().base, out, "r1")
    mend()
    os.remove(f"{drop.base}/orders/o.csv")
    assert daily_run.run(spark, drop.base, out, "r2").first().status == "failure"
    # With orders again, the files that stayed are worked in by a new run.
    drop.put("orders/new.csv", ORDER_HEAD + "1,10,2025-01-01,x\n2,11,2025-01-02,x\n")
    assert daily_run.run(spark, drop.base, out, "r3").first().recordsProcessed == 5


def test_one_unreadable_bad_file_leaves_the_others_set_aside(spark, drop, tmp_path, monkeypatch):
    import os

    out = str(tmp_path / "out")
    drop.good().put("orders/bad.csv", "order_id\n7\n")
    drop.put("orders/worse.csv", "order_id\n8\n")
    headers = daily_run.arrived.headers

    def then_one_goes(*args, **more):
        headers(*args, **more).write.parquet(str(tmp_path / "headers"))
        os.remove(f"{drop.base}/orders/worse.csv")
        return spark.read.parquet(str(tmp_path / "headers"))

    monkeypatch.setattr(daily_run.arrived, "headers", then_one_goes)
    row = daily_run.run(spark, drop.base, out, "r1").first()
    assert (row.status, row.archiveStatus) == ("success", "partial_failure")
    status = {r.key: r.status for r in spark.read.parquet(f"{out}/manifest").collect()}
    assert (status["orders/bad.csv"], status["orders/worse.csv"]) == ("quarantined", "failed")
    assert [r.line for r in spark.read.parquet(f"{out}/quarantine/seq=0").orderBy("position").collect()] == ["order_id", "7"]


def test_two_runs_at_once(spark, drop, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    number = daily_run.Tables.next_seq
    daily_run.run(spark, drop.good().base, out, "r0")
    monkeypatch.setattr(daily_run.Tables, "next_seq", lambda self: 0)  # as if both began before the first ended
    monkeypatch.setattr(daily_run, "finish_open_run", lambda *rest: None)
    drop.put("orders/late.csv", ORDER_HEAD + "9,19,2025-01-02,x\n")
    with pytest.raises(daily_run.RunInProgress):
        daily_run.run(spark, drop.base, out, "r1", RECOMPUTE)
    monkeypatch.setattr(daily_run.Tables, "next_seq", number)


def test_consumed_files_are_looked_up_in_their_buckets(spark, drop, tmp_path, monkeypatch):
    monkeypatch.setattr(daily_run, "FOLD", 2)
    out = str(tmp_path / "out")
    daily_run.run(spark, drop.good().base, out, "r0")
    tables = daily_run.Tables(spark, out)
    for i in range(1, 4):
        drop.put(f"orders/more{i}.csv", ORDER_HEAD + f"{50 + i},1,2025-01-01,x\n")
        daily_run.run(spark, drop.base, out, f"r{i}", RECOMPUTE) if i == 3 else None
    # Runs 0 and 1 are in the index; nothing of them is read again.
    assert tables.ledger() == {"next": 2, "base": 2}
    files = daily_run.arrived.inventory(spark, drop.base)
    assert tables.unconsumed(files).count() == 0
    drop.put("orders/new.csv", ORDER_HEAD + "99,1,2025-01-01,x\n")
    new = daily_run.arrived.inventory(spark, drop.base).where("key = 'orders/new.csv'")
    left = tables.unconsumed(new)
    assert [r.key for r in left.collect()] == ["orders/new.csv"]
    with configured(spark, {"spark.sql.maxMetadataStringLength": "2000"}):
        text = tables.unconsumed(new)._jdf.queryExecution().executedPlan().toString()
    # One file has one bucket; manifests of runs in the index are not read.
    assert re.search(r"consumed/upto=2\].*PartitionFilters: \[[^]]*\(bucket#\d+ = \d+\)", text), text
    assert "/manifest/" not in text
    # A file written anew under its old name is a new file.
    import os

    os.utime(f"{drop.base}/orders/o.csv", (2_000_000_000, 2_000_000_000))
    again = tables.unconsumed(daily_run.arrived.inventory(spark, drop.base))
    assert {r.key for r in again.collect()} == {"orders/new.csv", "orders/o.csv"}
