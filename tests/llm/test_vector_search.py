import random

import numpy as np
import pytest

from brute import rows_of
from daybook.llm import vector_search
from daybook.llm.vector_search import integers, top

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute_top(vectors, queries, k):
    out = []
    for q, w in queries.items():
        width = max(map(len, [w, *vectors.values()]))
        fill = lambda v: list(v) + [0] * (width - len(v))
        scores = [(-sum(a * b for a, b in zip(fill(v), fill(w))), i) for i, v in vectors.items() if i != q]
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize("kind", ["dense", "sparse", "ties", "negative"])
def test_against_all_scores(spark, kind, monkeypatch):
    monkeypatch.setattr(vector_search, "FIRST", 8)
    rng = random.Random(kind)
    value = {
        "dense": lambda: rng.randrange(-30, 30),
        "sparse": lambda: rng.choice([0] * 9 + [rng.randrange(-9, 40)]),
        "ties": lambda: rng.randrange(2),
        "negative": lambda: -rng.randrange(1, 5),
    }[kind]
    vectors = {i: [value() for _ in range(12)] for i in range(300)}
    vectors.update({i: vectors[0] for i in range(300, 400)})  # a hot vector
    queries = {i: v if kind != "negative" else [-x for x in v] for i, v in vectors.items() if i % 20 == 0}
    frame = lambda d: spark.createDataFrame(list(d.items()), "vec_id bigint, vector array<bigint>")
    got = top(frame(vectors), frame(queries), k=7, shard=90, block=8)
    assert rows_of(got) == brute_top(vectors, queries, 7)


def test_great_numbers_and_uneven_lengths(spark):
    vectors = {1: [1 << 40, 3], 2: [1 << 40], 3: [-(1 << 40), 1, 7], 4: []}
    frame = spark.createDataFrame(list(vectors.items()), "vec_id bigint, vector array<bigint>")
    small = spark.createDataFrame([(9, [5, 1, 1])], "vec_id bigint, vector array<bigint>")
    assert rows_of(top(frame, small, k=10)) == brute_top(vectors, {9: [5, 1, 1]}, 10)


def test_vectors_that_take_no_part(spark):
    rows = [
        (1, [0.5, -0.01], 0),
        (2, None, 0),
        (3, [0.5, None], 0),
        (4, [float("nan"), 1.0], 0),
        (5, [float("inf"), 1.0], 0),
        (None, [1.0, 1.0], 0),
        (6, [0.1, 0.1], 0),
        (6, [0.1, 0.1], 1),
    ]
    got = integers(spark.createDataFrame(rows, SCHEMA))
    assert rows_of(got) == [(1, [32, -1]), (6, [6, 6])]
    assert integers(spark.createDataFrame([], SCHEMA)).count() == 0
    none = integers(spark.createDataFrame([], SCHEMA))
    assert top(none, none).count() == 0 and top(got, none).count() == 0
    alone = got.where("vec_id = 1")
    assert top(alone, alone).count() == 0
    assert np.array(rows_of(top(got, alone))).tolist() == [[1, 1, 6, 186]]
