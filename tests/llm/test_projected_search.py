"""Nearest neighbours by stable projections (op12) against all distances."""

import math

import numpy as np
import pytest

from daybook.llm import projected_search as P
from daybook.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int, region string, row string, gap int"


def brute(vectors, wanted, k=10):
    """{(query vec_id, place among equals): [(vec_id, distance)]} over all rows that take part."""
    rows = [(i, np.array(v, np.float64)) for i, v in vectors if v and None not in v and np.isfinite(v).all() and any(v)]
    width = max((len(v) for _, v in rows), default=0)
    all_ = np.array([np.pad(v, (0, width - len(v))) for _, v in rows]).reshape(-1, width)
    out = {}
    for at, (i, _) in enumerate(rows):
        if not wanted(i):
            continue
        gaps = np.sqrt(((all_ - all_[at]) ** 2).sum(axis=1))
        order = sorted((g, rows[j][0] is None, rows[j][0] or 0) for j, g in enumerate(gaps.tolist()) if j != at)
        out.setdefault(i, []).append([(None if none else j, g) for g, none, j in order[:k]])
    return out


def found(frame, wanted="vec_id % 100 = 0", k=10):
    out = {}
    for r in sorted(P.search(frame, wanted, k).collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def recall(got, want):
    """Share of true neighbours found, by distance, so that any of equally near ones counts."""
    hits = total = 0
    for q, lists in want.items():
        limit = lists[0][-1][1]
        hits += sum(score <= limit * (1 + 1e-12) for _, _, score in got[q])
        total += len(lists[0])
    return hits / total


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_recall(spark, folder):
    sf_dir = f"/root/testdata/{folder}"
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    want = brute([(r.vec_id, r.embedding) for r in rows], lambda i: i % 100 == 0)
    got = {}
    for r in QUERIES["op12_projected_neighbours"](spark, sf_dir).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    vectors = {r.vec_id: np.array(r.embedding, np.float64) for r in rows}
    assert set(got) == set(want)
    for q, lists in got.items():
        assert [x[0] for x in sorted(lists)] == list(range(1, 11))
        for _, i, score in lists:
            assert score == pytest.approx(math.dist(vectors[q], vectors[i]), rel=1e-12)
    assert recall(got, want) >= 0.95


def test_many_regions_and_blocks(spark, monkeypatch):
    """Small blocks and regions: most are ruled out, and recall stays."""
    monkeypatch.setattr(P, "BLOCK", 60)
    monkeypatch.setattr(P, "QUERIES", 7)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 24)) * 6
    points = centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 24))
    points = np.float32(points).tolist()
    rows = [(i, v, 0, "x", "y", 1) for i, v in enumerate(points)]
    got = found(spark.createDataFrame(rows, SCHEMA).repartition(4))
    want = brute(list(enumerate(points)), lambda i: i % 100 == 0)
    assert set(got) == set(want) and recall(got, want) >= 0.95
    assert all(len(v) == 10 for v in got.values())


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    plain = [[1.0, 2.0], [1.0, 2.0, 0.5], [-3.0], [0.0, 1e30]]
    vectors = [
        (0, [1.0, 2.0]), (100, [1.0, 2.0]), (100, [4.0, 4.0]), (None, [1.0, 2.1]), (None, [1.0, 2.1]), (7, None),
        (8, []), (9, [0.0, 0.0]), (10, [nan, 1.0]), (11, [inf, 1.0]), (12, [None, 1.0]),
        *[(20 + i, v) for i, v in enumerate(plain)], *[(30 + i, [5.0, 5.0]) for i in range(40)], (200, [5.0, 5.0]),
    ]
    frame = spark.createDataFrame([(i, v, 0, "x", "y", 1) for i, v in vectors], SCHEMA)
    got = found(frame)
    want = brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in vectors],
                 lambda i: i is not None and i % 100 == 0)
    assert set(got) == set(want) == {0, 100, 200}
    short = lambda pairs: sorted((f"{s:.9g}", str(i)) for i, s in pairs)
    # Two rows share the id 100: each is a query, and neither is its own neighbour.
    for q in want:
        assert short((i, s) for _, i, s in got[q]) == short(pair for lists in want[q] for pair in lists)
    assert [i for _, i, _ in got[200]] == list(range(30, 40))
    assert found(spark.createDataFrame([], SCHEMA)) == {}
    one = spark.createDataFrame([(100, [1.0, 2.0], 0, "x", "y", 1)], SCHEMA)
    assert found(one) == {}


def test_chi_square():
    assert P.chi_square(P.LIMIT) == pytest.approx(P.CERTAINTY)
    draws = np.random.default_rng(1).chisquare(P.DIMENSIONS, 200_000)
    assert np.mean(draws <= P.LIMIT) == pytest.approx(P.CERTAINTY, abs=2e-3)


def test_search_stops_early():
    """In few clusters far apart, most vectors are never verified."""
    rng = np.random.default_rng(2)
    wide = np.repeat(rng.normal(size=(20, 32)) * 50, 100, axis=0) + rng.normal(size=(2000, 32))
    points = wide @ P.directions(32)
    tree = P.Tree(points)
    seen = []

    class Counted(np.ndarray):
        def __getitem__(self, at):
            seen.append(np.size(at))
            return np.asarray(self)[at]

    members = [[{"none": False, "vec_id": i, "row": i}] for i in range(2000)]
    got = P.nearest(tree, wide.view(Counted), members, wide[0], points[0], tree.boxes(points[:1])[0], 0, 10, math.inf)
    true = np.argsort(((wide - wide[0]) ** 2).sum(axis=1))[1:11]
    assert [i for _, _, i, _ in got] == true.tolist() and sum(seen) < 300
