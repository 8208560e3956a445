from collections import Counter

import pytest

from daybook.llm import mixing


def shared_out(sizes, most=3.0):
    """Targets by weight in rounds, as the rule says."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, full = float(sum(sizes.values())), {}
    while True:
        rest = total - sum(full.values())
        open_ = {s: weight[s] for s in names if s not in full}
        target = {s: rest * w / sum(open_.values()) for s, w in open_.items()}
        over = [s for s in target if target[s] > most * sizes[s]]
        if not over:
            return {**full, **target}
        full.update({s: most * sizes[s] for s in over})


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 10, "b": 1000, "c": 5, None: 50},
        {"a": 100},
        {"b": 0, "a": 7, "é": 0, "Z": 900},
        {f"s{i:02d}": (i * 37) % 50 for i in range(20)},
    ],
)
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, size bigint")
    got = {r.source: r.target for r in mixing.targets(frame).collect()}
    assert got == pytest.approx(shared_out(sizes))
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_mix(docs_of):
    rows = [(i, "w " * (i % 7 + 1), ["a", "b", "c", None][i % 16 // 4 if i % 5 else 0]) for i in range(3000)]
    docs = docs_of(rows)
    counted = mixing.copies(docs).collect()
    taken, target = Counter(), {}
    for r in counted:
        assert 0 <= r.copies <= 3 and r.size == len(r.text.split())
        taken[r.source] += r.copies * r.size
        target[r.source] = r.target
    assert all(abs(taken[s] - t) < 0.12 * t for s, t in target.items())
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({r.doc_id: r.copies for r in counted if r.copies})
    assert sorted(map(str, mixed.collect())) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))


def test_edges(docs_of):
    assert mixing.copies(docs_of([])).count() == 0 and mixing.mix(docs_of([])).count() == 0
    got = mixing.copies(docs_of([(1, None), (2, "", None), (None, " \n")])).collect()
    assert [(r.size, r.source_size, r.target) for r in got] == [(0, 0, 0.0)] * 3
    got = mixing.copies(docs_of([(None, "a b"), (None, "a b"), (1, "c" * 100_000), (1, "c" * 100_000)])).collect()
    assert {r.copies for r in got} == {1} and sorted(r.size for r in got) == [1, 1, 2, 2]
