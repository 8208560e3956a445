"""A quality classifier on statistics of documents.

Random Fourier features of standardised statistics approximate a Gaussian kernel. Tasks add up
their part of the normal equations, Spark adds up the parts, and a ridge regression on them
scores documents; an isotonic fit on labelled rows that the regression has not seen turns its
scores into probabilities. What reaches the driver has a size fixed by the number of features.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from daybook.llm.frames import pieces, stored

WAVES = 200  # random Fourier features
RIDGE = 1e-3  # per labelled row
SEED = 11
PIECE = 4 << 20  # bytes of text a task works on at once
BINS = 1000  # calibration bins per unit of score

STATISTICS = [
    "log_bytes",
    "log_words",
    "word_length",
    "upper_share",
    "digit_share",
    "space_share",
    "stop_share",
    "symbol_share",
    "shout_share",
    "bar_share",
    "foreign_share",
    "upper_pairs",
    "symbol_pairs",
    "mixed_pairs",
    "lone_symbols",
    "entropy",
    "distinct_words",
    "distinct_lines",
    "log_line_length",
    "short_words",
    "repeated_neighbours",
]


def _table(members: bytes) -> np.ndarray:
    made = np.zeros(256, bool)
    made[list(members)] = True
    return made


_UPPER = _table(bytes(range(65, 91)))
_LOWER = _table(bytes(range(97, 123)))
_DIGIT = _table(b"0123456789")
_SPACE = _table(b" \t\n\x0b\x0c\r")
_STOP = _table(b".,;:'\"()-?")
_SHOUT = _table(b"!")
_BAR = _table(b"|")
_FOREIGN = _table(bytes(range(128, 256)))
_SYMBOL = ~(_UPPER | _LOWER | _DIGIT | _SPACE | _STOP | _FOREIGN)
_WEIGHTY = ~(_SPACE | _STOP)


def statistics(texts: list[str | None]) -> np.ndarray:
    """One row of `STATISTICS` per text; all are finite, also for an empty or a NULL text."""
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    n = len(raw)
    sizes = np.array([len(r) for r in raw], np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    owner = np.repeat(np.arange(n), sizes)
    counts = np.bincount(owner * 256 + data, minlength=256 * n).reshape(n, 256).astype(float)

    def of(kind: np.ndarray) -> np.ndarray:
        return counts[:, kind].sum(axis=1)

    def pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
        both = first[data[:-1]] & second[data[1:]] & (owner[:-1] == owner[1:])
        return np.bincount(owner[:-1][both], minlength=n).astype(float)

    words = [r.split() for r in raw]
    n_words = np.array([len(w) for w in words], float)
    lines = [[x for x in r.split(b"\n") if x] for r in raw]
    n_lines = np.array([len(x) for x in lines], float)
    some = np.maximum(sizes, 1.0)
    held = np.maximum(n_words, 1.0)
    letters = np.maximum(of(_UPPER) + of(_LOWER), 1.0)
    solid = some - of(_SPACE)
    share = counts / some[:, None]
    entropy = -(share * np.log2(np.where(share > 0, share, 1.0))).sum(axis=1)
    return np.column_stack(
        [
            np.log1p(sizes),
            np.log1p(n_words),
            np.log1p(solid / held),
            of(_UPPER) / letters,
            of(_DIGIT) / some,
            of(_SPACE) / some,
            of(_STOP) / held,
            np.sqrt(of(_SYMBOL) / some),
            np.sqrt(of(_SHOUT) / held),
            np.sqrt(of(_BAR) / held),
            of(_FOREIGN) / some,
            pairs(_UPPER, _UPPER) / letters,
            np.sqrt(pairs(_SYMBOL, _SYMBOL) / held),
            np.sqrt(pairs(_LOWER | _DIGIT, _UPPER | _SYMBOL | _DIGIT) / held),
            np.sqrt(pairs(_SPACE, _SYMBOL) / held),
            entropy,
            np.array([len(set(w)) for w in words]) / held,
            np.array([len(set(x)) for x in lines]) / np.maximum(n_lines, 1.0),
            np.log1p(some / np.maximum(n_lines, 1.0)),
            np.array([sum(map((4).__gt__, map(len, w))) for w in words]) / held,
            np.sqrt(np.array([sum(map(eq, w, w[1:])) for w in words]) / held),
        ]
    )


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, "text", PIECE):
        made = statistics(piece.column("text").to_pylist())
        bounds = pa.array(np.arange(0, made.size + 1, made.shape[1]), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), pa.ListArray.from_arrays(bounds, pa.array(made.ravel()))], names=["doc_id", "x"]
        )


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, x) of `docs` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(_features, "doc_id bigint, x array<double>")


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; fold 1 is held out of all learning."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3).cast("int")


@dataclass
class Model:
    """Everything a task needs to score statistics."""

    mean: np.ndarray
    spread: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    heights: np.ndarray

    def waves(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features and a constant. Statistics far out are drawn in."""
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        waves = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.column_stack([waves, np.ones(len(x))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.waves(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.knots, self.heights)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _summed(rows: DataFrame, parts: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The sum of `parts`, a vector of fixed length, over all batches: one vector per task, added
    up by place in Spark. Empty where there are no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                made = parts(batch)
                total = made if total is None else total + made
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["place", "value"]
            )

    added = rows.mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    found = added.toPandas().sort_values("place")
    return found["value"].to_numpy(float)


def isotonic(x: np.ndarray, weight: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pools neighbours in the order of `x` until their means rise; gives the pools' mean places
    and heights, with one row and a half of doubt, so that no height is quite 0 or 1."""
    pools: list[list[float]] = []
    for place, w, t in zip(x.tolist(), weight.tolist(), total.tolist()):
        pools.append([place * w, w, t])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    knots = np.array([p[0] / p[1] for p in pools])
    heights = np.array([(p[2] + 0.5) / (p[1] + 1.0) for p in pools])
    return knots, np.maximum.accumulate(heights)


def fit(labelled: DataFrame, waves: int = WAVES, ridge: float = RIDGE, seed: int = SEED) -> Model:
    """Fits on rows (fold, x, quality); fold 0 for the regression, fold 2 for its calibration.

    Without labelled rows every score is one half.
    """
    random = np.random.default_rng(seed)
    size = len(STATISTICS)
    learn = labelled.where("fold = 0")

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        x = _matrix(batch)
        return np.concatenate([[len(x)], x.sum(axis=0), (x**2).sum(axis=0)])

    sums = _summed(learn, moments)
    if not len(sums):
        zero = np.zeros(1)
        return Model(np.zeros(size), np.ones(size), np.zeros((size, 1)), zero, np.zeros(2), zero, zero + 0.5)
    mean = sums[1 : size + 1] / sums[0]
    spread = np.sqrt(np.maximum(sums[size + 1 :] / sums[0] - mean**2, 1e-12))
    directions = random.standard_normal((size, waves)) / np.sqrt(size / 2)
    phases = random.uniform(0, 2 * np.pi, waves)
    model = Model(mean, spread, directions, phases, np.zeros(waves + 1), np.zeros(1), np.full(1, 0.5))
    upper = np.triu_indices(waves + 1)

    def equations(batch: pa.RecordBatch) -> np.ndarray:
        z = model.waves(_matrix(batch))
        y = batch.column("quality").to_numpy(zero_copy_only=False).astype(float)
        return np.concatenate([(z.T @ z)[upper], z.T @ y])

    sums = _summed(learn, equations)
    normal = np.zeros((waves + 1, waves + 1))
    normal[upper] = sums[: len(upper[0])]
    normal += np.triu(normal, 1).T
    rows = normal[-1, -1]
    penalty = np.eye(waves + 1) * ridge * rows
    penalty[-1, -1] = 1e-9
    model.weights = np.linalg.solve(normal + penalty, sums[len(upper[0]) :])

    low, high = -BINS, 2 * BINS

    def calibration(batch: pa.RecordBatch) -> np.ndarray:
        at = np.clip(np.rint(model.raw(_matrix(batch)) * BINS), low, high).astype(int) - low
        y = batch.column("quality").to_numpy(zero_copy_only=False).astype(float)
        return np.concatenate([np.bincount(at, minlength=high - low + 1), np.bincount(at, y, high - low + 1)])

    sums = _summed(labelled.where("fold = 2"), calibration)
    if len(sums):
        count, good = np.split(sums, 2)
        used = np.flatnonzero(count)
        model.knots, model.heights = isotonic((used + low) / BINS, count[used], good[used])
    else:
        model.knots, model.heights = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def trained(made: DataFrame, labels: DataFrame, waves: int = WAVES) -> Model:
    """The model from `features` and labels (doc_id, quality), without held-out rows.

    Rows without a label, or with one that is not 0 or 1, teach nothing.
    """
    known = labels.where("quality in (0, 1)").select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality")
    kept = fold(F.col("doc_id")) != 1
    rows = made.where(kept).join(known.where(kept), "doc_id").select(fold(F.col("doc_id")).alias("fold"), "x", "quality")
    return fit(stored(rows, "labelled"), waves)


def scores(docs: DataFrame, labels: DataFrame, waves: int = WAVES) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `docs` (doc_id, text).

    Learns `quality` (0 or 1) of `labels` (doc_id, quality) outside fold 1 from the texts alone.
    A NULL text counts as empty; a row without doc_id is scored, its id taken as empty text.
    Repeated rows get equal scores and teach as often as they occur.
    """
    made = stored(features(docs), "statistics")
    model = trained(made, labels, waves)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = pa.array(np.clip(model.score(_matrix(batch)), 0.0, 1.0))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), score], names=["doc_id", "score"])

    return made.mapInArrow(run, "doc_id bigint, score double").select(
        "doc_id",
        (fold(F.col("doc_id")) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that are predicted good, with the columns they came with.

    The texts are read twice and never shuffled: once to learn, once to score each row.
    """
    model = trained(stored(features(docs), "statistics"), labels)
    others = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", PIECE):
            yield piece.filter(pa.array(model.score(statistics(piece.column("text").to_pylist())) >= 0.5))

    rows = docs.select("text", F.struct(*others).alias("own"))
    return rows.mapInArrow(run, rows.schema).select("text", "own.*").select(*docs.columns)
