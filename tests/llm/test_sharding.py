import zlib
from collections import Counter, defaultdict

import pytest

from daybook.llm import sharding
from daybook.llm.queries import QUERIES


def check_law(rows, shards=8):
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(shards)) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_whole_table(spark, sf_dir, table_docs):
    rows = QUERIES["op5_balanced_shards"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(table_docs)
    for r in rows:
        data = (table_docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
    check_law(rows)
    again = QUERIES["op5_balanced_shards"](spark, sf_dir).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def shards_of_texts(rows):
    held = defaultdict(set)
    for r in rows:
        held[r.text].add(r.shard)
    return held


def test_links_come_together(docs_of):
    rows = [(i, f"group {i // 3}") for i in range(90)] + [(i, f"single {i}") for i in range(90, 400)]
    out = sharding.assigned(docs_of(rows))
    got = out.collect()
    check_law(got)
    held = shards_of_texts(got)
    assert sum(len(held[f"group {g}"]) > 1 for g in range(30)) <= 3
    assert sharding.cut_links(out).first().links == 30
    assert set(docs_of(rows).columns) <= set(out.columns)


@pytest.mark.parametrize("size", [2, 3])
def test_all_rows_are_linked(docs_of, size):
    # Nearly nothing can make room: other links must.
    rows = [(i, f"group {i // size}") for i in range(1000 * size)]
    out = sharding.assigned(docs_of(rows))
    check_law(out.collect())
    links = sharding.cut_links(out).first()
    assert links.links == 1000 and links.cut <= 30


def test_a_link_larger_than_a_shard(docs_of):
    rows = [(i, "hot") for i in range(200)] + [(i, f"t{i}") for i in range(200, 600)]
    got = sharding.assigned(docs_of(rows)).collect()
    check_law(got)
    assert sorted(c for s, c in Counter(r.shard for r in got if r.text == "hot").items()) == [50, 75, 75]


def test_a_third_of_all_rows_is_one_text(docs_of):
    rows = [(i, "hot") for i in range(200)] + [(i, f"t{i}") for i in range(200, 600)]
    got = sharding.assigned(docs_of(rows)).collect()
    check_law(got)
    # 200 rows fill two shards of 75 and part of others.
    assert Counter(r.shard for r in got if r.text == "hot").most_common(1)[0][1] == 75


@pytest.mark.parametrize("n", [0, 1, 7, 9])
def test_few_rows(docs_of, n):
    got = sharding.assigned(docs_of([(i, "same") for i in range(n)])).collect()
    assert len(got) == n
    if n:
        check_law(got)


def test_nulls_and_repeated_rows(docs_of):
    rows = [(None, None), (None, None), (1, None), (1, ""), (2, "a"), (2, "a"), (2, "b"), (None, "a")]
    got = sharding.assigned(docs_of(rows), shards=2).collect()
    check_law(got, 2)
    assert sorted(r.size for r in got) == [1, 1, 1, 1, 2, 2, 2, 2]
    assert len(sharding.assigned(docs_of(rows), shards=1).collect()) == 8
