import zlib

import numpy as np
import pytest

from daybook.llm import quality
from daybook.llm.queries import QUERIES


def test_held_out_documents(spark, sf_dir):
    """Held-out accuracy on a table ten times as large as the smallest."""
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    rows = QUERIES["op4_quality_scores"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    assert rows.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    got = rows.join(labels, "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    held = got[got.held_out]
    good, bad = held[held.quality == 1].score.to_numpy(), held[held.quality == 0].score.to_numpy()
    assert (good[:, None] > bad).mean() + 0.5 * (good[:, None] == bad).mean() > 0.97
    assert (held.predicted == held.quality).mean() > 0.95


def test_edges(spark, docs_of):
    plain = "One line. Another."
    docs = docs_of([(1, None), (2, ""), (3, plain), (None, "x"), (4, "A!! B!!\n" * 20_000), (3, plain)])
    labels = lambda rows: spark.createDataFrame(rows, "doc_id bigint, quality int")
    for rows in ([], [(3, 1)], [(3, None), (4, 7)], [(i, i % 2) for i in range(1, 5)] * 3):
        got = quality.scores(docs, labels(rows)).collect()
        assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
        assert len({(r.score, r.predicted) for r in got if r.doc_id == 3}) == 1
    # Without labels nothing is known.
    assert {r.score for r in quality.scores(docs, labels([])).collect()} == {0.5}
    assert quality.scores(docs_of([]), labels([(1, 1)])).count() == 0
    kept = quality.accepted(docs, labels([]))
    assert kept.count() == 6 and kept.columns == docs.columns


def test_labels_of_held_out_rows_teach_nothing(spark, docs_of):
    texts = [(i, "word " * 30 if i % 2 else "### %%% " * 30) for i in range(90)]
    told = [(i, i % 2) for i in range(90) if zlib.crc32(str(i).encode()) % 3 != 1]
    lies = [(i, 1 - i % 2) for i in range(90) if zlib.crc32(str(i).encode()) % 3 == 1]
    frame = lambda rows: spark.createDataFrame(rows, "doc_id bigint, quality int")
    score = lambda rows: {r.doc_id: r.score for r in quality.scores(docs_of(texts), frame(rows)).collect()}
    assert score(told) == pytest.approx(score(told + lies))
    assert all((s > 0.5) == bool(i % 2) for i, s in score(told).items())


def test_isotonic():
    x = np.arange(6.0)
    knots, heights = quality.isotonic(x, np.ones(6), np.array([0, 1, 0, 1, 1, 0.0]))
    assert (np.diff(knots) > 0).all() and (np.diff(heights) >= 0).all()
    assert len(knots) == 3


def test_sums_of_normal_equations(spark):
    """The regression is that of all rows at once, however they are dealt."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, len(quality.STATISTICS)))
    rows = [(0, r.tolist(), int(r[0] > 0)) for r in x]
    frame = spark.createDataFrame(rows, "fold int, x array<double>, quality int")
    one, many = (quality.fit(frame.repartition(n), waves=30) for n in (1, 7))
    assert np.allclose(one.weights, many.weights)
    z = one.waves(x)
    penalty = np.eye(31) * quality.RIDGE * len(x)
    penalty[-1, -1] = 1e-9
    assert np.allclose(one.weights, np.linalg.solve(z.T @ z + penalty, z.T @ (x[:, 0] > 0)))
