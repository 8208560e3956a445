"""Figures moved by deltas against the whole tables computed anew."""

import datetime as dt
import math
import random

import pytest

from daybook import settings, storage
from daybook.operators import kpis, sales
from daybook.plans import history
from session_confs import configured

ORDERS = "order_id bigint, user_id bigint, order_date date"
ITEMS = "order_id bigint, item_id bigint, product_id bigint, sale_price string, is_returned int"
PRODUCTS = "product_id bigint, category string"


def made_runs(rng, n):
    """Deliveries with late items and orders, corrections, repeats, NULLs and odd prices."""
    prices = ["1.50", "2.25", "10", "0", "-3.75", None, "abc", "NaN", "Infinity", "-Infinity"]
    weights = [9, 9, 9, 2, 2, 1, 1, 0.3, 0.3, 0.3]
    day = lambda: rng.choice([None, *[dt.date(2025, 1, d) for d in range(1, 6)], dt.date(2025, 2, 1)])
    some = lambda k: rng.choice([None, *range(k)]) if rng.random() < 0.1 else rng.randrange(k)
    for _ in range(n):
        yield (
            [(some(12), some(4), day()) for _ in range(rng.randrange(8))],
            [(some(14), some(99), some(6), rng.choices(prices, weights)[0], rng.randrange(2)) for _ in range(rng.randrange(14))],
            [(some(6), rng.choice([None, "Toys", "Books", "Games"])) for _ in range(rng.randrange(4))],
        )


def frames(spark, run):
    return {
        name: spark.createDataFrame(rows, schema)
        for name, rows, schema in zip(history.LANDED, run, (ORDERS, ITEMS, PRODUCTS))
    }


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def rows_of(frame):
    return sorted((tuple(plain(r[c]) for c in sorted(frame.columns)) for r in frame.collect()), key=str)


def latest(runs, at, key=0):
    """The greatest row of each key's latest delivery."""
    found = {}
    for run in runs:
        own = {}
        for row in run[at]:
            if row[key] is not None and (row[key] not in own or _greater(row, own[row[key]])):
                own[row[key]] = row
        found |= own
    return list(found.values())


def _greater(a, b):
    for x, y in zip(a, b):
        if x != y:
            return x is not None and (y is None or x > y)
    return False


def anew(spark, runs, money):
    orders = spark.createDataFrame(latest(runs, 0), ORDERS)
    products = spark.createDataFrame(latest(runs, 2), PRODUCTS)
    items = sales.priced(spark.createDataFrame([r for run in runs for r in run[1]], ITEMS), money)
    lines = sales.sales_lines(items, orders)
    dated = "order_date is not null"
    return [
        rows_of(kpis.category_kpis_of_lines(lines, products).where(dated)),
        rows_of(kpis.order_kpis_of_lines(lines).where(dated)),
    ]


def work(spark, root, seq, run, money, tables):
    """Lands and works in a run; puts its figures over those of its days."""
    rows = {name: history.land(frame, root, name, seq) for name, frame in frames(spark, run).items()}
    days, *figures = history.recomputed(rows, root, seq, money, buckets=2)
    days = {r[0] for r in days.collect()}
    for at, frame in enumerate(figures):
        place = sorted(frame.columns).index("order_date")
        kept = [r for r in tables[at] if r[place] not in days]
        tables[at] = sorted(kept + rows_of(frame.where("order_date is not null")), key=str)


@pytest.mark.parametrize("money, compact", [("float32", 32), ("decimal", 2)])
def test_deltas_add_up(spark, tmp_path, monkeypatch, money, compact):
    monkeypatch.setattr(history, "COMPACT", compact)
    runs = list(made_runs(random.Random(compact), 6))
    tables, root = [[], []], f"{tmp_path}/history"
    with configured(spark, settings.RUN):
        for seq, run in enumerate(runs):
            work(spark, root, seq, run, money, tables)
            assert tables == anew(spark, runs[: seq + 1], money)
    if compact == 2:
        # Rows of the runs were put into one.
        assert sum(n.startswith("seq=") for n in storage.children(spark, f"{root}/sums_state")) <= 3


def test_a_run_worked_in_twice_or_behind_counts_once(spark, tmp_path):
    runs = list(made_runs(random.Random(7), 4))
    tables, root = [[], []], f"{tmp_path}/history"
    with configured(spark, settings.RUN):
        work(spark, root, 0, runs[0], "float32", tables)
        # The second run only lands, as a replace run does.
        for name, frame in frames(spark, runs[1]).items():
            history.land(frame, root, name, 1)
        work(spark, root, 2, runs[2], "float32", tables)
        work(spark, root, 2, runs[2], "float32", tables)
        assert tables == anew(spark, runs[:3], "float32")


def test_a_run_that_broke_off_leaves_no_rows(spark, tmp_path, monkeypatch):
    runs = list(made_runs(random.Random(8), 3))
    tables, root = [[], []], f"{tmp_path}/history"
    with configured(spark, settings.RUN):
        work(spark, root, 0, runs[0], "float32", tables)
        monkeypatch.setattr(history.State, "commit", lambda *rest: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            work(spark, root, 1, runs[1], "float32", tables)
        monkeypatch.undo()
        work(spark, root, 1, runs[1], "float32", tables)
        assert tables == anew(spark, runs[:2], "float32")


def nodes_above(plan, mark):
    """For each line of a plan's text that holds `mark`: the names of the nodes above it, nearest first."""
    lines = [x for x in plan.splitlines() if x.strip()]
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    for at, line in enumerate(lines):
        if mark in line:
            above, now = [], depth[at]
            for i in range(at - 1, -1, -1):
                if depth[i] < now:
                    now = depth[i]
                    above.append(lines[i].lstrip(" :+-*").split("(")[0].split(" ")[0])
            yield above


def test_a_late_item_moves_no_stored_row(spark, tmp_path, monkeypatch):
    """Joins with stored sums and orders shuffle the run's rows alone, after any number of runs,
    and no landed row of an earlier run is read."""
    runs = list(made_runs(random.Random(9), 4))
    tables, root, plans = [[], []], f"{tmp_path}/history", []
    whole = history.land

    def watched(rows, root, name, seq, *rest):
        if name in ("changed", "moved"):
            plans.append((seq, name, rows._jdf.queryExecution().executedPlan().toString(), rows.inputFiles()))
        return whole(rows, root, name, seq, *rest)

    monkeypatch.setattr(history, "land", watched)
    # Tables this small would all be broadcast.
    confs = {**settings.RUN, "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "2"}
    with configured(spark, confs):
        for seq, run in enumerate(runs):
            work(spark, root, seq, run, "float32", tables)
    seen = 0
    for seq, name, plan, files in plans:
        assert not [f for f in files if any(f"/{n}/seq=" in f for n in history.LANDED)]
        for above in nodes_above(plan, "Bucketed: true"):
            joins = [i for i, node in enumerate(above) if "Join" in node]
            assert joins and "Exchange" not in above[: joins[0]], above
            seen += 1
    assert seen >= 6 and {s for s, *_ in plans} == set(range(4))


def test_store_calls_do_not_grow_with_runs(spark, tmp_path, monkeypatch):
    runs = list(made_runs(random.Random(10), 5))
    tables, root, calls = [[], []], f"{tmp_path}/history", []
    for name in ("exists", "children", "read_text", "delete"):
        step = getattr(storage, name)
        monkeypatch.setattr(storage, name, lambda *args, step=step: (calls.append(1), step(*args))[1])
    counts = []
    with configured(spark, settings.RUN):
        for seq, run in enumerate(runs):
            calls.clear()
            work(spark, root, seq, run, "float32", tables)
            counts.append(len(calls))
    assert counts[1] == counts[-1]


def test_pairs_of_order_and_product_are_kept_once(spark, tmp_path):
    """Orders of a product are found in the sums; a changed category moves no day."""
    root, tables = f"{tmp_path}/history", [[], []]
    day = dt.date(2025, 1, 1)
    runs = [([(1, 1, day)], [(1, 1, 5, "2.00", 0)], [(5, "Toys")]), ([], [], [(5, "Books")])]
    with configured(spark, settings.RUN):
        for seq, run in enumerate(runs):
            work(spark, root, seq, run, "float32", tables)
        assert tables == anew(spark, runs, "float32")
    assert not storage.exists(spark, f"{root}/sold_state") and storage.exists(spark, f"{root}/sums_state")
    assert spark.read.parquet(f"{root}/days_state/seq=1").isEmpty()


def test_stored_rows_stay_where_they_are_with_many_shuffle_partitions(spark, tmp_path, monkeypatch):
    """More shuffle partitions than buckets move no stored row; those outside of the touched keys are skipped."""
    day, plans, whole = dt.date(2025, 1, 1), [], history.land

    def watched(rows, root, name, seq, *rest):
        if name == "moved":
            plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return whole(rows, root, name, seq, *rest)

    monkeypatch.setattr(history, "land", watched)
    runs = [
        ([(n, n, day) for n in range(1, 9)], [(n, n, 5, "2.00", 0) for n in range(1, 9)], [(5, "Toys")]),
        ([], [(7, 9, 5, "1.00", 0)], []),
    ]
    tables, root = [[], []], f"{tmp_path}/history"
    confs = {**settings.RUN, "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    with configured(spark, confs):
        for seq, run in enumerate(runs):
            work(spark, root, seq, run, "float32", tables)
        assert tables == anew(spark, runs, "float32")
    found = list(nodes_above(plans[-1], "Bucketed: true"))
    assert len(found) == 2  # sums and orders
    for above in found:
        joins = [i for i, node in enumerate(above) if "Join" in node]
        assert joins and "Exchange" not in above[: joins[0]], above
    scans = [x for x in plans[-1].splitlines() if "Bucketed: true" in x]
    assert all("GreaterThanOrEqual(order_id,7), LessThanOrEqual(order_id,7)" in x for x in scans)


@pytest.mark.parametrize("turns", [(0, 1, 2), (2, 1, 0)])
def test_datasets_one_after_the_other(spark, tmp_path, monkeypatch, turns):
    """Runs that cannot move a figure yet compute none, and the first products give old lines their category."""
    moved, whole = [], history.land
    monkeypatch.setattr(history, "land", lambda rows, root, name, seq: (moved.append((seq, name)), whole(rows, root, name, seq))[1])
    one = next(made_runs(random.Random(11), 1))
    one = (one[0] + [(1, 1, dt.date(2025, 1, 2))], one[1] + [(1, 1, 1, "2.00", 1)], one[2] + [(1, "Toys")])
    runs = [tuple(rows if at == turn else [] for at, rows in enumerate(one)) for turn in turns]
    runs += [([], [(1, 2, 1, "1.00", 0)], [(1, "Books")])]
    tables, root = [[], []], f"{tmp_path}/history"
    with configured(spark, settings.RUN):
        for seq, run in enumerate(runs):
            work(spark, root, seq, run, "float32", tables)
            assert tables == anew(spark, runs[: seq + 1], "float32")
    assert (0, "moved") not in moved and (3, "moved") in moved
