import random
import re

import pytest

from daybook.llm import decontamination
from daybook.llm.decontamination import find

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def want(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = {}
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (ids := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= ids
        out[doc] = (len(w), len(hit), sorted(found - {None}))
    return out


ITEMS = [
    (1, "What is the one thing that the two of them had seen, in 1999?"),
    (2, "Short ANSWER"),
    (3, None),
    (4, "... !"),
    (None, "an item without id"),
    (5, "short answer"),
    (6, "É été"),
]
TEXT = "what IS the-one thing\nthat the two of them had seen in 1999"
DOCS = [
    (1, f"Before. {TEXT}! After"),
    (2, TEXT),
    (3, TEXT.replace("two", "three")),
    (4, "a shortanswer, a short -- answer's end"),
    (5, None),
    (6, ""),
    (7, "... ,"),
    (8, "an item  without id"),
    (9, "É été, é été"),
    (10, "short " * 5000 + "answer"),
]


@pytest.mark.parametrize("size", [1 << 20, 1, 20])
def test_against_all_windows(spark, docs_of, size):
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = docs_of(DOCS)
    got = {r.doc_id: r for r in find(docs, benchmark, size=size).collect()}
    assert {k: (r.n_words, r.n_hit, r["items"]) for k, r in got.items()} == want(DOCS, ITEMS)
    assert all(r.contaminated == (r.n_hit > 0) for r in got.values())
    for k, text in DOCS:
        for a, b in zip(got[k].starts, got[k].ends):
            assert words((text or "").encode()[a:b].decode())
    start, end = got[1].starts[0], got[1].ends[0]
    assert DOCS[0][1].encode()[start:end].decode() == TEXT


def test_random_texts(spark, docs_of):
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    items = [(i, text(rng.choice([4, 9, 10, 11, 14]))) for i in range(12)]
    docs = [(i, text(rng.randrange(400))) for i in range(30)]
    got = find(docs_of(docs), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in got} == want(docs, items)


def test_empty_tables_and_clean(spark, docs_of):
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert find(docs_of([]), benchmark).count() == 0
    got = find(docs_of(DOCS), benchmark.limit(0)).collect()
    assert len(got) == len(DOCS) and not any(r.contaminated for r in got)
    kept = decontamination.clean(docs_of(DOCS), benchmark)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 5, 6, 7]
    assert kept.columns == docs_of(DOCS).columns


def test_one_automaton_in_one_pass(spark, docs_of):
    """However many blocks: one scan of the texts, and no item in the plan or the driver."""
    items = [(i, " ".join(f"w{i}x{k}" for k in range(300))) for i in range(60)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string").repartition(3)
    path, blocks = decontamination.stored_blocks(benchmark, size=5000)
    assert blocks >= 20
    found = find(docs_of([(1, "and " + items[7][1] + " end"), (2, "w7x0")]), benchmark, size=5000)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    got = {r.doc_id: (r.n_hit, r["items"]) for r in found.collect()}
    assert got == {1: (300, [7]), 2: (0, [])}


def test_long_items_are_cut_without_loss(spark, docs_of):
    """An item longer than a block, found wherever a window of it occurs."""
    rng = random.Random(6)
    item = [rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(900)]
    docs = [(i, " ".join(item[at : at + rng.randrange(8, 30)])) for i, at in enumerate(range(0, 880, 9))]
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    got = find(docs_of(docs), benchmark, size=200).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in got} == want(docs, [(1, " ".join(item))])


def test_a_large_benchmark_in_bounded_memory(spark, tmp_path):
    """30 MB of items: a worker scans them block by block and stays small."""
    import os
    import subprocess
    import sys

    items = spark.range(3000, numPartitions=4).selectExpr("id as item_id", "concat_ws(' ', transform(sequence(1, 1500), k -> hex(id * 4001 + k * 17))) as text")
    path, blocks = decontamination.stored_blocks(items)
    assert blocks > 60
    code = (
        "import sys, resource; sys.path.insert(0, sys.argv[1])\n"
        "from daybook.llm import decontamination as D\n"
        "for b in range(0, int(sys.argv[3]), 10):\n"
        "    built = None; built = D._automaton_of(sys.argv[2], b, 10)\n"
        "print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)\n"
    )
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    ran = subprocess.run([sys.executable, "-c", code, repo, path, str(blocks)], capture_output=True, text=True, timeout=600)
    assert ran.returncode == 0, ran.stderr[-1000:]
    assert int(ran.stdout) < 1000
