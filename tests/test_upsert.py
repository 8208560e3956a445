import datetime as dt

import pytest

from daybook import storage
from daybook.operators import upsert as U

ROW = "category string, order_date date, v double"


def d(day, month=1):
    return dt.date(2025, month, day)


def put(spark, rows, root, step, **options):
    return U.upsert(spark.createDataFrame(rows, ROW), f"{root}/t", ["category", "order_date"], step, f"{root}/w{step}", **options)


def content(spark, root):
    return sorted((r.category, r.order_date, r.v) for r in U.read(spark, f"{root}/t").collect())


def test_upsert(spark, tmp_path):
    root = str(tmp_path)
    first = [("A", d(1), 1.0), ("B", d(1), 2.0), ("A", d(1, 2), 3.0), (None, d(1), 9.0), ("A", None, 9.0)]
    assert put(spark, first, root, 0) == {"written": 3, "rejected": 2}
    assert content(spark, root) == [("A", d(1), 1.0), ("A", d(1, 2), 3.0), ("B", d(1), 2.0)]
    february = U.pointer(spark, f"{root}/t")["months"]["2025-02"]

    # A row replaces its key; its month's other rows and other months stay.
    put(spark, [("A", d(1), 5.0), ("C", d(9), 6.0)], root, 1)
    want = [("A", d(1), 5.0), ("A", d(1, 2), 3.0), ("B", d(1), 2.0), ("C", d(9), 6.0)]
    assert content(spark, root) == want
    assert U.pointer(spark, f"{root}/t")["months"] == {"2025-01": 1, "2025-02": february}

    # The same write again, anew or resumed, changes nothing.
    put(spark, [("A", d(1), 5.0), ("C", d(9), 6.0)], root, 2)
    put(spark, [("A", d(1), 5.0), ("C", d(9), 6.0)], root, 2)
    assert content(spark, root) == want

    # By day: the day's other rows go.
    days = spark.createDataFrame([(d(1),), (d(1, 2),)], "order_date date")
    put(spark, [("A", d(1), 7.0)], root, 3, days=days)
    assert content(spark, root) == [("A", d(1), 7.0), ("C", d(9), 6.0)]


def test_readers_see_one_write_or_the_other(spark, tmp_path, monkeypatch):
    """Between any two steps of a write the table is whole, old or new; a frame read before stays."""
    root = str(tmp_path)
    put(spark, [("A", d(1), 1.0), ("B", d(2, 3), 2.0)], root, 0)
    old, before, seen = content(spark, root), U.read(spark, f"{root}/t"), []
    for where, name in ((U, "_staged"), (U, "_by_month"), (storage, "replace_text"), (storage, "delete")):

        def watched(*args, step=getattr(where, name)):
            seen.append(content(spark, root))
            result = step(*args)
            seen.append(content(spark, root))
            return result

        monkeypatch.setattr(where, name, watched)
    put(spark, [("A", d(1), 5.0), ("C", d(4, 3), 6.0), ("A", d(9), 1.0)], root, 1)
    new = [("A", d(1), 5.0), ("A", d(9), 1.0), ("B", d(2, 3), 2.0), ("C", d(4, 3), 6.0)]
    turn = seen.index(new)
    assert seen[:turn] == [old] * turn and seen[turn:] == [new] * (len(seen) - turn) and turn >= 6
    assert sorted((r.category, r.order_date, r.v) for r in before.collect()) == old
    # What was replaced goes when one more write has finished.
    assert (tmp_path / "t" / "run=0" / "order_month=2025-01").exists()
    put(spark, [("A", d(1), 6.0)], root, 2)
    assert not (tmp_path / "t" / "run=0" / "order_month=2025-01").exists()


def test_broken_write_is_repeated_whole(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    put(spark, [("A", d(1), 1.0), ("B", d(2), 2.0)], root, 0)
    whole = storage.replace_text

    def lost(spark, path, text):
        if path.endswith(U.POINTER):
            raise OSError("lost")
        whole(spark, path, text)

    monkeypatch.setattr(storage, "replace_text", lost)
    with pytest.raises(OSError):
        put(spark, [("A", d(1), 5.0), (None, d(1), 1.0)], root, 1)
    monkeypatch.undo()
    assert content(spark, root) == [("A", d(1), 1.0), ("B", d(2), 2.0)]
    # What was computed is not computed again, and counts the same.
    assert put(spark, [("never", d(3), 0.0)], root, 1) == {"written": 1, "rejected": 1}
    assert content(spark, root) == [("A", d(1), 5.0), ("B", d(2), 2.0)]


def test_counts_come_with_the_write(spark, tmp_path):
    """No job beside the writes: staging gathers the outcome."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("staging", "staging")
    try:
        outcome = U._staged(
            spark.createDataFrame([("A", d(1), 1.0), ("A", None, 1.0)], ROW), ["category", "order_date"], str(tmp_path / "w")
        )
    finally:
        jobs = len(tracker.getJobIdsForGroup("staging"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # The rebalanced shuffle and the write.
    assert outcome == {"written": 1, "rejected": 1} and jobs <= 2


def test_months_of_few_rows_are_written_side_by_side(spark, tmp_path):
    rows = [("A", d(1, month), 1.0) for month in range(1, 13)]
    put(spark, rows, str(tmp_path), 0)
    files = list((tmp_path / "t" / "run=0").glob("order_month=*/part-*.parquet"))
    assert len(files) == 12 and len({f.name.split("-")[1] for f in files}) > 1
    put(spark, [("A", d(1, 2), 5.0)], str(tmp_path), 1)
    assert content(spark, str(tmp_path)) == sorted([r for r in rows if r[1] != d(1, 2)] + [("A", d(1, 2), 5.0)])


def test_last_by_key(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 1, None)], "k int, seq int, v string")
    got = U.last_by_key(rows, ["k"], "seq")
    assert got.columns == ["k", "seq", "v"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, 3, "c"), (2, 1, None)]


def test_scratch_uses_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    a, b = storage.scratch(spark, "x"), storage.scratch(spark, "x")
    assert a.startswith(shared + "/x-") and a != b


def test_first_write_without_rows_keeps_the_columns(spark, tmp_path):
    root = str(tmp_path)
    assert put(spark, [], root, 0) == {"written": 0, "rejected": 0}
    assert content(spark, root) == []
    put(spark, [("A", d(1), 4.0)], root, 1)
    assert content(spark, root) == [("A", d(1), 4.0)]


def test_scratch_asks_for_a_shared_folder(spark, monkeypatch):
    class Conf:
        def get(self, name, default=None):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.scratch(Session(), "x")
