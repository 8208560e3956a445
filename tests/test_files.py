from pyspark.sql import functions as F

from daybook.operators import gate
from daybook.sources import files


def keys(df):
    return {r.key for r in df.collect()}


def test_inventory_finds_every_csv(spark, drop):
    for i in range(60):
        drop.put(f"orders/many/f{i}.csv", "order_id\n1\n")
    drop.put("orders/sub/deep/d.csv", "a\n")
    drop.put("orders/X.CSV", "a\n")
    drop.put("orders/y.Csv", "a\n")
    drop.put("orders/n.txt", "a\n")
    drop.put("orders/odd [1] +%41 é.csv", "a\n")
    drop.put("products/empty.csv", "")
    drop.put("elsewhere/e.csv", "a\n")
    rows = files.inventory(spark, drop.base).collect()
    got = {r.key for r in rows}
    assert len([k for k in got if k.startswith("orders/many/")]) == 60
    assert {k for k in got if "/many/" not in k} == {
        "orders/sub/deep/d.csv",
        "orders/X.CSV",
        "orders/y.Csv",
        "orders/odd [1] +%41 é.csv",
        "products/empty.csv",
    }
    empty = [r for r in rows if r.key == "products/empty.csv"][0]
    assert (empty.dataset, empty.length) == ("products", 0)
    assert all(r.length > 0 and r.modification_time for r in rows if r is not empty)


def test_names_are_listed_in_tasks(spark, drop):
    """Deep folders, hidden names; nothing but numbers of folders in the driver, and the same
    files as Hadoop's own listing finds, with the same times."""
    for i in range(40):
        drop.put(f"orders/d{i % 7}/e{i % 3}/f{i}.csv", "a\n")
    drop.put("orders/_temporary/h.csv", "a\n")
    drop.put("orders/.hidden/h.csv", "a\n")
    drop.put("orders/d1/_h.csv", "a\n")
    drop.put("products/zero.csv", "")
    found = files.inventory(spark, drop.base, folders_per_task=2)
    told = files.inventory(spark, drop.base, ranged=False)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, told.collect()))
    assert found.count() == 41
    seen = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{drop.base}/orders")
    times = {r.path.replace("file:///", "file:/"): r.modificationTime for r in seen.select("path", "modificationTime").collect()}
    assert all(times[r.path] == r.modification_time for r in found.where("length > 0").collect())
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" not in text and "ExistingRDD" not in text


def test_no_folders(spark, tmp_path):
    inventory = files.inventory(spark, str(tmp_path))
    assert inventory.count() == 0
    row = gate.completeness_gate(inventory).first()
    assert not row.triggered
    assert row.missing_folders == ["orders", "order_items", "products"]


def test_gate(spark, drop):
    drop.good()
    assert gate.completeness_gate(files.inventory(spark, drop.base)).first().triggered


def test_headers_both_ways(spark, drop):
    drop.put("orders/plain.csv", "a,b\n1,2\n3,4\n")
    drop.put("orders/crlf.csv", "a,b\r\n1,2\r\n")
    drop.put("orders/one line [x] +%41.csv", "a,b")
    drop.put("orders/blank.csv", "\n\na,b\n")
    drop.put("orders/spaces.csv", "   \na,b\n")
    drop.put("orders/empty.csv", "")
    drop.put("orders/cr.csv", "a,b\r1,2\r")
    with open(f"{drop.base}/orders/bad.csv", "wb") as out:
        out.write(b"a,\xff\xfe\n1\n")
    drop.put("orders/long.csv", ",".join(f"column_{i}" for i in range(2000)) + "\n1\n")
    inventory = files.inventory(spark, drop.base)
    want = {
        "orders/plain.csv": "a,b",
        "orders/crlf.csv": "a,b",
        "orders/one line [x] +%41.csv": "a,b",
        "orders/blank.csv": None,
        "orders/spaces.csv": None,
        "orders/empty.csv": None,
        "orders/cr.csv": "a,b\r1,2",
        "orders/bad.csv": None,
        "orders/long.csv": ",".join(f"column_{i}" for i in range(2000)),
    }
    for ranged in (True, False):
        got = {r.key: r.header_line for r in files.headers(spark, inventory, ranged).collect()}
        assert got == want


def test_unreadable_text_has_no_header(spark, drop, tmp_path):
    drop.put("orders/x.csv", "a\n")
    with open(f"{drop.base}/orders/bad.csv", "wb") as out:
        out.write(b"order_id,\xff\xfe\n1\n")
    got = {r.key: r.header_line for r in files.headers(spark, files.inventory(spark, drop.base)).collect()}
    assert got == {"orders/x.csv": "a", "orders/bad.csv": None}


def test_long_first_lines_are_read_in_linear_time(spark, drop):
    import time

    drop.put("orders/one.csv", "x" * 16_000_000)
    inventory = files.inventory(spark, drop.base)
    began = time.time()
    assert files.headers(spark, inventory).selectExpr("length(header_line) as n").first().n == 16_000_000
    assert time.time() - began < 10


def test_lines_too_long_for_a_header(spark, drop):
    drop.put("orders/one.csv", "a,b\n" + "x" * 9000)
    drop.put("orders/two.csv", "x" * 9000 + "\n1\n")
    drop.put("orders/three.csv", "x" * 9000)
    inventory = files.inventory(spark, drop.base)
    for ranged in (True, False):
        got = {r.key: r.header_line for r in files.headers(spark, inventory, ranged, longest=8000).collect()}
        assert got == {"orders/one.csv": "a,b", "orders/two.csv": None, "orders/three.csv": None}


def test_files_that_can_be_read(spark, drop):
    drop.put("orders/one.csv", "a,b\n")
    drop.put("orders/two%41 x.csv", "")
    found = files.inventory(spark, drop.base)
    gone = found.withColumn("path", F.concat("path", F.lit(".gone")))
    got = files.readable(found.unionByName(gone), 4).collect()
    assert sorted(r.path.rsplit("/", 1)[1] for r in got) == ["one.csv", "two%41 x.csv"]


def test_errors_of_the_store_are_no_verdict(spark, drop):
    import pytest

    drop.put("orders/x.csv", "a\n")
    inventory = files.inventory(spark, drop.base)
    folder = inventory.withColumn("path", F.regexp_replace("path", "/[^/]*$", ""))
    with pytest.raises(Exception, match="directory"):
        files.headers(spark, folder).collect()
    gone = inventory.withColumn("path", F.concat("path", F.lit(".gone")))
    assert files.headers(spark, gone).first().header_line is None


def test_lines_behind_the_first_are_not_sorted(spark, drop):
    """Without ranged reads too a task holds a batch of lines, not all of a file's; several files
    of one task, empty lines and equal first lines are told apart."""
    for n in range(20):
        drop.put(f"orders/o{n:02}.csv", "a,b\n" + "x\n\n" * n)
    drop.put("orders/p.csv", "\na,b\n")
    found = files.inventory(spark, drop.base)
    lines = files.headers(spark, found, ranged=False)
    text = lines._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in text and "MapInArrow" in text
    got = {r.key: r.header_line for r in lines.collect()}
    assert got == {**{f"orders/o{n:02}.csv": "a,b" for n in range(20)}, "orders/p.csv": None}
    assert got == {r.key: r.header_line for r in files.headers(spark, found).collect()}
