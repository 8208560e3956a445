import random

import numpy as np

import brute
from daybook.llm import near_duplicates
from daybook.llm.components import components
from daybook.llm.queries import QUERIES


def test_whole_table(spark, sf_dir, table_docs):
    prints = {k: brute.fingerprint(t) for k, t in table_docs.items()}
    groups = brute.linked(prints)
    got = {tuple(r) for r in QUERIES["op3_simhash_groups"](spark, sf_dir).collect()}
    assert got == {(k, f"{prints[k]:016x}", groups[k]) for k in prints}


def test_edges(docs_of):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one TWO"), (6, "É é"), (None, "one two"), (5, "one TWO")]
    got = sorted(((r.doc_id, r.component_id) for r in near_duplicates.groups(docs_of(rows)).collect()), key=str)
    assert got == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (5, 4), (6, 6), (None, 4)]
    assert near_duplicates.groups(docs_of([])).count() == 0
    long = " ".join(f"w{i}" for i in range(300_000))
    assert near_duplicates.fingerprint(long) == brute.fingerprint(long)


def test_one_of_each(docs_of):
    a, b, c = "One two three four", "Quite another text of words", "Third one here"
    rows = [(None, a), (None, a), (2, b), (5, b.upper()), (None, b), (7, c), (7, a + " and much that is new here"), (7, c)]
    docs = docs_of(rows)
    kept = near_duplicates.one_of_each(docs)
    # A row for each group, also where doc_ids are NULL or shared by different texts.
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(None, a), (2, b), (7, c), (7, a + " and much that is new here")], key=str
    )
    assert kept.columns == docs.columns
    assert near_duplicates.one_of_each(docs_of([])).count() == 0


def close_prints(n, rng):
    """Chains and clusters of fingerprints at distances around the limit."""
    out = [rng.getrandbits(64) for _ in range(n // 4)]
    while len(out) < n:
        value = rng.choice(out)
        for _ in range(rng.randrange(5)):
            value ^= 1 << rng.randrange(64)
        out.append(value)
    return list(dict.fromkeys(out))


def link_roots(spark, prints):
    signed = [(int(np.uint64(p).astype(np.int64)),) for p in prints]
    nodes = spark.createDataFrame(signed, "fingerprint bigint")
    keyed = near_duplicates.signatures(nodes).repartition(3, "key").sortWithinPartitions("key", "fingerprint")
    links = keyed.mapInArrow(near_duplicates._verified, "a bigint, b bigint")
    unsigned = lambda v: v % (1 << 64)
    roots = {unsigned(r.node): unsigned(r.root) for r in components(links).collect()}
    groups = {}
    for p in prints:
        groups.setdefault(roots.get(p, p), set()).add(p)
    return sorted(map(sorted, groups.values()))


def want_groups(prints):
    groups = {}
    for k, g in brute.linked(dict(enumerate(prints))).items():
        groups.setdefault(g, set()).add(prints[k])
    return sorted(map(sorted, groups.values()))


def test_links_against_all_pairs(spark, monkeypatch):
    rng = random.Random(11)
    prints = close_prints(400, rng)
    assert link_roots(spark, prints) == want_groups(prints)
    # Large keys: many fingerprints with one half in common.
    crowded = [(0xABCD1234 << 32) | p for p in {q & 0xFFFFFFFF for q in close_prints(200, rng)}]
    assert link_roots(spark, crowded) == want_groups(crowded)
    monkeypatch.setattr(near_duplicates, "ENUMERATED", 20)
    assert link_roots(spark, crowded) == want_groups(crowded)


def test_looked_up_links_of_both_signs(spark, monkeypatch):
    # Many fingerprints with the lower half in common, with and without the top bit.
    rng = random.Random(12)
    crowded = [(p & 0xFFFFFFFF) << 32 | 0xABCD1234 for p in close_prints(200, rng)]
    crowded = list(dict.fromkeys([*crowded, *(p ^ (1 << 63) for p in crowded[:40])]))
    assert len({p >> 63 for p in crowded}) == 2
    monkeypatch.setattr(near_duplicates, "ENUMERATED", 20)
    assert link_roots(spark, crowded) == want_groups(crowded)


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 102), (102, 101), (7, 7), (101, 100)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 51)}, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
