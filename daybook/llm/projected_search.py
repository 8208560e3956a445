"""Approximate nearest neighbours in a low-dimensional stable projection.

Vectors are projected onto `DIMENSIONS` random normal directions. The squared distance of two
projections is their squared distance times a chi-square variable of as many degrees of freedom.
So neighbours are taken by projected distance, nearest first, and verified on the whole vectors,
until the next projected distance is so long that a vector behind it is nearer than the k-th found
with a chance of at most 1 - `CERTAINTY` (a chi-square test).

The projections are indexed by a kd-tree in two levels. The upper one, split at the medians of a
bounded sample, deals all vectors to regions, and regions to blocks of about `BLOCK` vectors. Each
block's task builds the lower one, down to leaves of `LEAF`. A query first searches one block of
its own region; the k-th distance found there then bounds the search of all other blocks, and the
test leaves out regions that lie too far off.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from daybook.llm.frames import stored, tasks

K = 10
DIMENSIONS = 8  # an even number
CERTAINTY = 0.98
SAMPLE = 4096  # projections that place the upper splits
REGIONS = 256  # at most, so that each has 16 of the sample
BLOCK = 8192  # vectors
QUERIES = 2048  # at once against a block
LEAF = 32  # vectors
SEED = 42
AT_ONCE = 1 << 20  # components projected at once


def chi_square(x: float, degrees: int = DIMENSIONS) -> float:
    """The chance of a chi-square variable of an even number of degrees to be at most `x`."""
    half = x / 2
    return 1 - math.exp(-half) * sum(half**i / math.factorial(i) for i in range(degrees // 2))


def limit(certainty: float = CERTAINTY, degrees: int = DIMENSIONS) -> float:
    """The squared projected distance, in squared distances of the k-th found, that ends a search."""
    low, high = 0.0, 1000.0
    while high - low > 1e-9:
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, degrees) < certainty else (low, middle)
    return high


LIMIT = limit()


def directions(size: int) -> np.ndarray:
    """A row of `DIMENSIONS` normal values for each component; longer vectors begin with the same."""
    return np.random.default_rng(SEED).standard_normal((size, DIMENSIONS))


def matrix(lists: pa.Array) -> np.ndarray:
    """Lists of numbers as the rows of a matrix; shorter ones have zeros at their end."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(lists.offsets.to_numpy())
    made = np.zeros((len(sizes), int(sizes.max(initial=0))))
    made[np.arange(made.shape[1]) < sizes[:, None]] = flat
    return made


def _projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = matrix(batch.column("vector"))
        made = vectors @ directions(vectors.shape[1])
        lists = pa.ListArray.from_arrays(
            np.arange(0, made.size + 1, DIMENSIONS, dtype=np.int32), pa.array(made.ravel())
        )
        yield batch.append_column("projection", lists)


def usable(vectors: DataFrame) -> DataFrame:
    """(row, vec_id, vector) of the rows of `vectors` (vec_id, embedding) that take part: not NULL,
    not zero, all components finite. `row` is a number of their own."""
    vector = F.col("vector")
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.where(vector.isNotNull() & ~F.coalesce(odd, F.lit(True)) & F.exists(vector, lambda x: x != 0))
    return stored(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "vector"), "vectors")


def distinct(vectors: DataFrame, k: int) -> DataFrame:
    """(vector, members): the different vectors with the k + 1 first of the rows (vec_id, row) that
    have them. No search gives more of one vector, its own row aside."""
    order = Window.partitionBy("vector").orderBy(F.col("vec_id").asc_nulls_last(), "row")
    few = vectors.withColumn("__place", F.row_number().over(order)).where(F.col("__place") <= k + 1)
    member = F.struct(F.col("vec_id").isNull().alias("none"), "vec_id", "row")
    return few.groupBy("vector").agg(F.array_sort(F.collect_list(member)).alias("members"))


class Splits:
    """The upper kd-tree: medians of the sample, in the widest direction of each part."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.axis: list[np.ndarray] = []
        self.value: list[np.ndarray] = []
        region = np.zeros(len(sample), np.int64)
        for level in range(depth):
            axis, value = np.zeros(1 << level, np.int64), np.zeros(1 << level)
            for part in range(1 << level):
                own = sample[region == part]
                if len(own):
                    axis[part] = np.argmax(own.max(axis=0) - own.min(axis=0))
                    value[part] = np.median(own[:, axis[part]])
            self.axis.append(axis)
            self.value.append(value)
            region = self._down(sample, region, level)

    def _down(self, points: np.ndarray, region: np.ndarray, level: int) -> np.ndarray:
        right = points[np.arange(len(points)), self.axis[level][region]] > self.value[level][region]
        return 2 * region + right

    def regions(self, points: np.ndarray) -> np.ndarray:
        region = np.zeros(len(points), np.int64)
        for level in range(len(self.axis)):
            region = self._down(points, region, level)
        return region


def _placed(splits: Splits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            region = splits.regions(matrix(batch.column("projection"))) if batch.num_rows else np.zeros(0, int)
            yield batch.append_column("region", pa.array(region.astype(np.int32), pa.int32()))

    return run


class Tree:
    """The lower kd-tree over the projections of one block, with the box of each node."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.order = np.arange(len(points))
        self.nodes: list[tuple] = []  # (low, high, begin, end, left, right)
        self._grow(0, len(points))

    def _grow(self, begin: int, end: int) -> int:
        own = self.points[self.order[begin:end]]
        low, high = own.min(axis=0), own.max(axis=0)
        number = len(self.nodes)
        self.nodes.append(None)
        left = right = -1
        axis = int(np.argmax(high - low))
        if end - begin > LEAF and high[axis] > low[axis]:
            middle = (end - begin) // 2
            self.order[begin:end] = self.order[begin:end][np.argpartition(own[:, axis], middle)]
            left, right = self._grow(begin, begin + middle), self._grow(begin + middle, end)
        self.nodes[number] = (low, high, begin, end, left, right)
        return number

    def boxes(self, points: np.ndarray) -> np.ndarray:
        """Squared distances of the points from the boxes of all nodes."""
        return box_distances(points, np.array([n[0] for n in self.nodes]), np.array([n[1] for n in self.nodes]))


def box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each point from each box."""
    apart = np.zeros((len(points), len(low)))
    for d in range(points.shape[1]):
        x = points[:, d, None]
        apart += np.maximum(np.maximum(low[:, d] - x, x - high[:, d]), 0) ** 2
    return apart


def nearest(
    tree: Tree, vectors: np.ndarray, members: list, query: np.ndarray, point: np.ndarray, boxes: np.ndarray,
    row: int, k: int, bound: float,
) -> list[tuple[float, bool, int, int]]:
    """The k nearest rows found for a query as (squared distance, vec_id is NULL, vec_id, row).

    Leaves come by the distance of their boxes; of a leaf, vectors are verified that the test does
    not rule out. `bound` is the squared distance of the k-th found elsewhere.
    """
    found: list[tuple[float, bool, int, int]] = []
    front = [(float(boxes[0]), 0)]
    while front:
        apart, number = heapq.heappop(front)
        if apart > LIMIT * bound:
            break
        _, _, begin, end, left, right = tree.nodes[number]
        if left >= 0:
            for child in (left, right):
                heapq.heappush(front, (float(boxes[child]), child))
            continue
        own = tree.order[begin:end]
        close = own[((tree.points[own] - point) ** 2).sum(axis=1) <= LIMIT * bound]
        if not len(close):
            continue
        gaps = ((vectors[close] - query) ** 2).sum(axis=1)
        for i in np.flatnonzero(gaps <= bound).tolist():
            gap = float(gaps[i])
            found += [(gap, m["none"], m["vec_id"] or 0, m["row"]) for m in members[close[i]] if m["row"] != row]
        if len(found) >= k:
            found = heapq.nsmallest(k, found)
            bound = min(bound, found[-1][0])
    return heapq.nsmallest(k, found)


FOUND = "query_row bigint, query_id bigint, gap double, vec_id bigint, row bigint"


def _search(k: int):
    """The search of one block for a block of queries."""

    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], []]
        if vectors.num_rows and queries.num_rows:
            points, wanted = matrix(vectors.column("projection")), matrix(queries.column("projection"))
            wide, narrow = matrix(vectors.column("vector")), matrix(queries.column("vector"))
            size = max(wide.shape[1], narrow.shape[1])
            wide, narrow = (np.pad(m, ((0, 0), (0, size - m.shape[1]))) for m in (wide, narrow))
            members = vectors.column("members").to_pylist()
            tree = Tree(points)
            boxes = tree.boxes(wanted)
            told = [queries.column(n).to_pylist() for n in ("row", "vec_id", "bound")]
            for i, (row, query_id, bound) in enumerate(zip(*told)):
                bound = math.inf if bound is None else bound
                for gap, none, vec_id, other in nearest(
                    tree, wide, members, narrow[i], wanted[i], boxes[i], row, k, bound
                ):
                    for column, value in zip(out, (row, query_id, gap, None if none else vec_id, other)):
                        column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
        names = ["query_row", "query_id", "gap", "vec_id", "row"]
        return pa.table([pa.array(c, t) for c, t in zip(out, kinds)], names=names)

    return run


def _met(index: DataFrame, queries: DataFrame, parts: int, k: int) -> DataFrame:
    """What the blocks (region, block) of the index hold for the queries (region, block, bound)."""
    parted = F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int").alias("part")
    each = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    keys = ["region", "block", "part"]
    # Only blocks that some query asks for travel.
    asked = queries.select("region", "block", parted).distinct()
    left = index.select("*", each).join(asked, keys, "left_semi").groupBy(*keys)
    right = queries.select("*", parted).groupBy(*keys)
    return left.cogroup(right).applyInArrow(_search(k), FOUND)


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy("gap", F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _reach(low: np.ndarray, high: np.ndarray, regions: list[int], blocks: list[int]):
    """Every block that the test does not rule out for a query, but the one it has searched."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bound = np.array([math.inf if b is None else b for b in batch.column("bound").to_pylist()])
            apart = box_distances(matrix(batch.column("projection")), low, high)
            query, place = np.nonzero(apart <= LIMIT * bound[:, None])
            home, own = (batch.column(n).to_pylist() for n in ("region", "block"))
            rows, region, block = [], [], []
            for q, p in zip(query.tolist(), place.tolist()):
                for b in range(blocks[p]):
                    if (regions[p], b) != (home[q], own[q]):
                        rows.append(q)
                        region.append(regions[p])
                        block.append(b)
            some = batch.take(pa.array(rows, pa.int64()))
            new = {"region": pa.array(region, pa.int32()), "block": pa.array(block, pa.int32())}
            columns = [new.get(name, some.column(name)) for name in batch.schema.names]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


def search(vectors: DataFrame, wanted: str, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) of the nearest rows of `vectors` (vec_id, embedding) to those
    of its rows that the condition `wanted` holds for.

    Score is the Euclidean distance in double precision; every row but the query's own counts, so
    rows with one vec_id, or with NULL as theirs, do too. Ties go to the smaller vec_id, NULL last.
    Vectors that are NULL, zero or empty, or hold NULL or non-finite components take no part; a
    shorter one has zeros at its end. Each of the true neighbours is missed with a chance of about
    1 - `CERTAINTY`.
    """
    spark = vectors.sparkSession
    n = tasks(spark)
    rows = usable(vectors)
    groups = distinct(rows, k)
    schema = groups.withColumn("projection", F.lit(None).cast("array<double>")).schema
    projected = stored(groups.mapInArrow(_projected, schema), "projected")
    number = projected.count()
    sample = projected.orderBy(F.xxhash64("vector"), "members").limit(SAMPLE).select("projection").collect()
    depth = max(0, min(REGIONS, -(-number // BLOCK)) - 1).bit_length()
    splits = Splits(np.array([r.projection for r in sample]).reshape(-1, DIMENSIONS), depth)

    def placed(found: DataFrame) -> DataFrame:
        return found.mapInArrow(_placed(splits), found.withColumn("region", F.lit(None).cast("int")).schema)

    regions = stored(placed(projected), "regions")
    sides = [f(F.col("projection")[d]).alias(f"{name}{d}") for name, f in (("low", F.min), ("high", F.max)) for d in range(DIMENSIONS)]
    # A row for each region, `REGIONS` at most.
    held = regions.groupBy("region").agg(F.count("*").alias("size"), *sides).orderBy("region").collect()
    blocks = [-(-r["size"] // BLOCK) for r in held]
    low, high = (np.array([[r[f"{s}{d}"] for d in range(DIMENSIONS)] for r in held]).reshape(-1, DIMENSIONS) for s in ("low", "high"))
    count = F.lit(1)
    for r, b in zip(held, blocks):
        count = F.when(F.col("region") == r.region, b).otherwise(count) if b > 1 else count
    index = regions.withColumn("block", F.pmod(F.xxhash64("vector"), count).cast("int"))

    asked = rows.where(wanted)
    schema = asked.withColumn("projection", F.lit(None).cast("array<double>")).schema
    asked = placed(asked.mapInArrow(_projected, schema))
    asked = stored(asked.withColumn("block", F.pmod(F.xxhash64("row"), count).cast("int")), "queries")
    parts = max(1, -(-asked.count() // QUERIES))
    near = stored(_first(_met(index, asked.withColumn("bound", F.lit(None).cast("double")), parts, k), k), "near")
    bounds = near.where(F.col("rank") == k).select(F.col("query_row").alias("row"), F.col("gap").alias("bound"))
    bounded = asked.join(bounds, "row", "left")
    there = bounded.mapInArrow(_reach(low, high, [r.region for r in held], blocks), bounded.schema)
    far = _met(index, stored(there, "reach"), parts, k)
    return _first(near.drop("rank").unionByName(far), k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.sqrt("gap").alias("score")
    )
