"""SimHash near-duplicates by deletion-variant signatures.

Two fingerprints that differ in at most three of 64 bits agree, but for one bit at most, in one
of their two halves. So each half is indexed 32 times, with one bit at a time as a wildcard; an
equality of such a key brings the pair together, and counting the differing bits verifies it.
Equal fingerprints are one node, and a key's nodes yield a spanning forest of their links, never
all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from daybook.llm.components import components
from daybook.llm.frames import identified, stored, tasks

SHINGLE = 3  # words
SEED = 42
DISTANCE = 3  # bits
HALF = 32
AT_ONCE = 1 << 18  # shingles hashed at once
FEW = 16  # nodes of a key whose links are all given
BLOCK = 1 << 12  # nodes compared at once with as many others
ENUMERATED = 1 << 18  # from so many nodes of a key on, neighbours are looked up instead


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint of a whole text; 0 where there is no word."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, AT_ONCE):
        some = words[at : at + AT_ONCE + SHINGLE - 1]
        shingles = [b" ".join(some)] if n == 1 else map(b" ".join, zip(*[some[i:] for i in range(SHINGLE)]))
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], ">u8")
        counts += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64).view(np.int64)
        yield batch.drop_columns(["text"]).append_column("fingerprint", pa.array(made))


def fingerprints(docs: DataFrame, *marks: str) -> DataFrame:
    """(doc_id, marks, fingerprint) of `docs` (doc_id, text, marks)."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *marks, "text")
    made = T.StructType([f for f in rows.schema if f.name != "text"]).add("fingerprint", T.LongType())
    return rows.mapInArrow(_fingerprints, made)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The root, the smallest node reachable, of each of `n` nodes under the links a-b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _links(nodes: np.ndarray, half: int, bit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among the distinct nodes of one key that this key is to give, as pairs of places.

    Nodes with equal halves share all 32 keys of it; the key of bit 0 gives their links.
    """
    n = len(nodes)
    wild = np.uint64(1 << (bit + HALF * half))
    first, second = [], []
    # Rows come in the order of signed numbers; look-ups need that of unsigned ones.
    order = np.argsort(nodes, kind="stable")
    nodes = nodes[order]
    if n < ENUMERATED:
        for i in range(0, n, BLOCK):
            for j in range(i, n, BLOCK):
                apart = nodes[i : i + BLOCK, None] ^ nodes[None, j : j + BLOCK]
                close = np.bitwise_count(apart) <= DISTANCE
                if bit:
                    close &= (apart & wild) != 0
                x, y = np.nonzero(close)
                roots = forest(n, np.concatenate([*first, x + i]), np.concatenate([*second, y + j]))
                first, second = [np.arange(n)], [roots]
    else:
        # As many look-ups for each node as there are ways to change the other half.
        places = range(HALF * (1 - half), HALF * (1 - half) + HALF)
        roots = np.arange(n)
        for flipped in range(DISTANCE + 1):
            for bits in combinations(places, flipped):
                mask = np.uint64(sum(1 << p for p in bits))
                for own in (np.uint64(0), wild) if bit == 0 else (wild,):
                    if flipped + int(own != 0) <= DISTANCE and (mask | own):
                        sought = nodes ^ (mask | own)
                        at = np.minimum(np.searchsorted(nodes, sought), n - 1)
                        met = np.flatnonzero(nodes[at] == sought)
                        roots = forest(n, np.concatenate([np.arange(n), met]), np.concatenate([roots, at[met]]))
        first, second = [np.arange(n)], [roots]
    a, b = first[0], second[0]
    return order[a[a != b]], order[b[a != b]]


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Verified links from rows (key, fingerprint) in the order of both."""
    kept_key = np.zeros(0, np.int64)
    kept_node = np.zeros(0, np.uint64)

    def links(key: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
        a, b = [], []
        bounds = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
        size = np.diff(bounds)
        run = np.repeat(size, size)
        bit = np.uint64(1) << (((key >> HALF) & 31) + HALF * (key >> (HALF + 5))).astype(np.uint64)
        first_bit = ((key >> HALF) & 31) == 0
        for step in range(1, min(FEW, int(size.max(initial=1)))):
            at = np.flatnonzero((key[step:] == key[:-step]) & (run[:-step] <= FEW))
            apart = node[at] ^ node[at + step]
            close = (np.bitwise_count(apart) <= DISTANCE) & (first_bit[at] | ((apart & bit[at]) != 0))
            a.append(node[at[close]])
            b.append(node[at[close] + step])
        for at in np.flatnonzero(size > FEW):
            some = node[bounds[at] : bounds[at + 1]]
            k = int(key[bounds[at]])
            x, y = _links(some, k >> (HALF + 5), (k >> HALF) & 31)
            a.append(some[x])
            b.append(some[y])
        made = [np.concatenate([np.zeros(0, np.uint64), *v]).view(np.int64) for v in (a, b)]
        return pa.RecordBatch.from_arrays([pa.array(v) for v in made], names=["a", "b"])

    for batch in batches:
        key = np.concatenate([kept_key, batch.column("key").to_numpy()])
        node = np.concatenate([kept_node, batch.column("fingerprint").to_numpy().view(np.uint64)])
        if not len(key):
            continue
        # The last key may go on in the next batch.
        last = int(np.searchsorted(key, key[-1]))
        kept_key, kept_node = key[last:], node[last:]
        yield links(key[:last], node[:last])
    yield links(kept_key, kept_node)


def signatures(nodes: DataFrame) -> DataFrame:
    """(key, fingerprint): 64 keys per fingerprint, made of the half, the wildcard's place and
    the half without that bit."""
    place = F.explode(F.sequence(F.lit(0), F.lit(2 * HALF - 1))).alias("place")
    half = f"shiftrightunsigned(fingerprint, {HALF} * (place div {HALF})) & {(1 << HALF) - 1}L"
    key = f"(({half}) & ~shiftleft(1L, place % {HALF})) | shiftleft(cast(place as bigint), {HALF})"
    return nodes.select("fingerprint", place).select(F.expr(key).alias("key"), "fingerprint")


def _members(made: DataFrame) -> DataFrame:
    """(fingerprint, root, least) of each different fingerprint of `made`: the fingerprint that
    names its component, and the smallest doc_id that has it."""
    nodes = stored(made.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "nodes")
    spark = made.sparkSession
    keyed = signatures(nodes).repartition(tasks(spark), "key").sortWithinPartitions("key", "fingerprint")
    links = keyed.mapInArrow(_verified, "a bigint, b bigint")
    found = stored(components(links), "components")
    root = F.coalesce("root", "fingerprint").alias("root")
    return nodes.join(found, F.col("fingerprint") == F.col("node"), "left").select("fingerprint", root, "least")


def groups(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) of `docs` (doc_id, text).

    Fingerprints link at `DISTANCE` or fewer differing bits; component_id is the smallest doc_id
    reachable. Empty and NULL texts have fingerprint 0 and link like any other. A NULL doc_id
    takes part but names no component unless alone; repeated rows get equal results.
    """
    made = stored(fingerprints(docs), "fingerprints")
    member = _members(made)
    roots = member.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = member.join(roots, "root").select(F.col("fingerprint").alias("__node"), "component_id")
    return made.join(labels, F.col("fingerprint") == F.col("__node")).select("doc_id", "fingerprint", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each group of `groups`, with all columns: that of the smallest doc_id, the first
    by its place in the files where rows share it. Rows without doc_id are taken last."""
    own = identified(docs.select("doc_id", "text", F.struct(*docs.columns).alias("__own")))
    marks = ["__file", "__place"]
    made = stored(fingerprints(own, *marks), "fingerprints")
    # One row per fingerprint first, so that many copies of a text meet as one row per task.
    order = F.struct(F.col("doc_id").isNull(), "doc_id", *marks)
    first = made.groupBy("fingerprint").agg(F.min(order).alias("first"))
    root = _members(made).select(F.col("fingerprint").alias("__node"), "root")
    kept = first.join(root, F.col("fingerprint") == F.col("__node")).groupBy("root").agg(F.min("first").alias("first"))
    return own.join(kept.select("first.__file", "first.__place"), marks, "left_semi").select("__own.*")
