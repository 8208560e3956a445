"""Super-k-mers: runs of windows that share a minimiser, packed and sent to its bucket.

A window's minimiser is its gram of least hash, the leftmost one of equal hashes. It depends on
the window alone, so equal windows meet in one bucket wherever they stand. Neighbouring windows
with the minimiser in one place form a run; a run travels as one string, with where it stands.

Runs of equal strings are merged in the task first: only those that could come first anywhere
travel, the others are known to repeat. A passage in a third of all documents is thus one row
per piece of text, not one per document.

A minimiser that makes up much of a bucket is hot: counted over all texts first, it is told to all
tasks, and the runs of its windows are cut again by the next smallest gram of another hash. The
two grams again depend on the window alone, and the pair names the bucket, so a hot minimiser
is spread over all tasks. Which minimisers are hot decides where windows meet, never whether.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F

from daybook.llm.frames import pieces, stored, tasks, text_of

BUCKETS = 2  # per task, which holds one at a time
HOT = 4  # a minimiser is hot from this part (one over it) of a bucket's share of all runs
LEVEL = 6  # of compression
SPANS = "doc_id bigint, mark bigint, begins array<bigint>, ends array<bigint>"
PACKETS = "bucket int, payload binary, " + SPANS


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours, from doubled widths."""
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def runs_of(
    grams: np.ndarray, group: np.ndarray, window: int, gram: int, avoid: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, hash) of each run; `grams` are hashes of the grams at each unit,
    `group` numbers the document of each unit, and a window lies within one document. With `avoid`
    grams of the hash it has for their document count only where a window has no others."""
    units = len(group)
    none = np.zeros(0, np.int64)
    if units < window:
        return none, none, none.astype(np.uint32)
    high = grams & np.uint64(0xFFFFFFFF00000000)
    if avoid is not None:
        high[(high >> np.uint64(32)) == avoid[group[: len(high)]]] = 0xFFFFFFFF00000000
    high |= np.arange(len(grams), dtype=np.uint64)
    least = sliding_least(high, window - gram + 1)[: units - window + 1]
    inside = group[: units - window + 1] == group[window - 1 :]
    change = np.ones(len(least), bool)
    change[1:] = (least[1:] != least[:-1]) | ~inside[:-1]
    firsts = np.flatnonzero(change & inside)
    # A run ends where the next begins, or where windows would leave the document.
    ends = np.flatnonzero(np.concatenate([change[1:] | ~inside[1:], [True]]) & inside) + 1
    found = (least[firsts] >> np.uint64(32)).astype(np.uint32)
    if avoid is not None:
        found = np.where(found == 0xFFFFFFFF, avoid[group[firsts]], found)
    return firsts, ends - firsts, found


class Documents:
    """The different documents of a piece or bucket in order of (doc_id, mark). The places of rows
    in this order stand for their documents."""

    def __init__(self, ids: np.ndarray, marks: np.ndarray):
        order = np.lexsort((marks, ids))
        first = np.ones(len(order), bool)
        first[1:] = (np.diff(ids[order]) != 0) | (np.diff(marks[order]) != 0)
        self.places = np.empty(len(order), np.int64)
        self.places[order] = np.cumsum(first) - 1
        self.ids, self.marks = ids[order[first]], marks[order[first]]


@dataclass
class Runs:
    """Runs of one piece. `doc` is the document's place there, `at` that of the first window in it."""

    gram: np.ndarray
    doc: np.ndarray
    at: np.ndarray
    windows: np.ndarray
    texts: list[bytes]

    def taken(self, places: np.ndarray) -> Runs:
        parts = [getattr(self, name)[places] for name in ("gram", "doc", "at", "windows")]
        return Runs(*parts, [self.texts[i] for i in places.tolist()])

    def and_these(self, others: Runs) -> Runs:
        parts = [np.concatenate([getattr(r, name) for r in (self, others)]) for name in ("gram", "doc", "at", "windows")]
        return Runs(*parts, self.texts + others.texts)

    def pack(self, order: np.ndarray, docs: Documents) -> bytes:
        texts = [self.texts[i] for i in order]
        doc = docs.ids[self.doc[order]]
        parts = [
            struct.pack("<I", len(order)),
            self.gram[order].astype("<u4").tobytes(),
            np.diff(doc, prepend=np.int64(0)).astype("<i8").tobytes(),
            docs.marks[self.doc[order]].astype("<i8").tobytes(),
            self.at[order].astype("<u4").tobytes(),
            self.windows[order].astype("<u2").tobytes(),
            # Of bytes it is always the same, which packs to nothing.
            (np.array([len(t) for t in texts], "<u4") - self.windows[order].astype("<u4")).tobytes(),
            *texts,
        ]
        return zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(parts))


class Packet:
    """A packed bucket of one piece; texts are cut out on demand. `doc` is given by `Documents`."""

    doc: np.ndarray

    def __init__(self, payload: bytes):
        raw = zstandard.ZstdDecompressor().decompress(payload)
        (n,) = struct.unpack_from("<I", raw)
        at = 4

        def take(kind: str) -> np.ndarray:
            nonlocal at
            made = np.frombuffer(raw, kind, n, at)
            at += made.nbytes
            return made

        self.gram = take("<u4")
        self.id = np.cumsum(take("<i8"))
        self.mark = take("<i8")
        self.at = take("<u4").astype(np.int64)
        self.windows = take("<u2").astype(np.int64)
        sizes = take("<u4").astype(np.int64) + self.windows
        self.ends = at + np.cumsum(sizes)
        self.begins = self.ends - sizes
        self.raw = raw

    def text(self, i: int) -> bytes:
        return self.raw[self.begins[i] : self.ends[i]]


class Spans:
    """Ranges by document, joined where they touch, as record batches."""

    def __init__(self, docs: Documents):
        self.docs = docs
        self.found: dict[int, list[tuple[int, int]]] = {}

    def add(self, doc: int, begin: int, end: int) -> None:
        held = self.found.setdefault(doc, [])
        if held and held[-1][0] <= begin <= held[-1][1]:
            held[-1] = (held[-1][0], max(end, held[-1][1]))
        else:
            held.append((begin, end))

    def batch(self, packets: list[tuple[int, bytes]] | None = None) -> pa.RecordBatch:
        """The ranges, one row per document; with `packets` also those, one row each."""
        docs = list(self.found)
        longs = pa.list_(pa.int64())
        none = [None] * len(packets or ())
        columns = [
            pa.array(self.docs.ids[docs].tolist() + none, pa.int64()),
            pa.array(self.docs.marks[docs].tolist() + none, pa.int64()),
            pa.array([[a for a, _ in self.found[d]] for d in docs] + none, longs),
            pa.array([[b for _, b in self.found[d]] for d in docs] + none, longs),
        ]
        names = ["doc_id", "mark", "begins", "ends"]
        if packets is not None:
            own = [hash(d) % (1 << 20) for d in self.docs.ids[docs].tolist()]
            columns = [
                pa.array(own + [b for b, _ in packets], pa.int32()),
                pa.array([None] * len(docs) + [p for _, p in packets], pa.binary()),
                *columns,
            ]
            names = ["bucket", "payload", *names]
        return pa.RecordBatch.from_arrays(columns, names=names)


Cut = Callable[..., tuple[Runs, int]]
Meet = Callable[[list[Packet], np.ndarray, np.ndarray, np.ndarray, Spans], None]


def _counter(cut: Cut, piece: int, fraction: int) -> Callable:
    """Runs by minimiser in each piece, and of all (gram -1); those below a `fraction` are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", piece):
            found = cut([(t or "").encode("utf-8", "replace") for t in batch.column("text").to_pylist()], whole=False)
            grams, n = np.unique(found, return_counts=True)
            many = n * fraction > len(found)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.append(grams[many].astype(np.int64), -1), pa.int64()),
                    pa.array(np.append(n[many], len(found)), pa.int64()),
                ],
                names=["gram", "runs"],
            )

    return run


def hot_grams(texts: DataFrame, cut: Cut, piece: int, buckets: int) -> np.ndarray:
    """Hashes of the minimisers that hold more than a `HOT`-th of a bucket's share of all runs: at
    most `HOT` times the buckets."""
    part = HOT * buckets
    counted = texts.mapInArrow(_counter(cut, piece, 4 * part), "gram bigint, runs bigint").groupBy("gram")
    sums = stored(counted.agg(F.sum("runs").alias("runs")), "minimisers")
    total = sums.where("gram = -1").first()
    hot = sums.where("gram >= 0").where(F.col("runs") * part > (total.runs if total else 0))
    return np.array(sorted(r.gram for r in hot.select("gram").collect()), np.uint32)


def _mapper(cut: Cut, piece: int, buckets: int, within: bool, hot: np.ndarray) -> Callable:
    def sent(runs: Runs) -> tuple[Runs, np.ndarray]:
        """The runs, those of hot minimisers cut again, and the bucket of each."""
        is_hot = np.isin(runs.gram, hot)
        key = runs.gram.astype(np.uint64)
        if is_hot.any():
            again, plain = runs.taken(np.flatnonzero(is_hot)), np.flatnonzero(~is_hot)
            finer, _ = cut(again.texts, again.gram)
            pair = (again.gram[finer.doc].astype(np.uint64) << np.uint64(32)) | finer.gram.astype(np.uint64)
            finer.at, finer.doc = finer.at + again.at[finer.doc], again.doc[finer.doc]
            runs, key = runs.taken(plain).and_these(finer), np.concatenate([key[plain], pair])
        return runs, (mixed(key) % np.uint64(buckets)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", piece):
            batch = batch.sort_by([("doc_id", "ascending"), ("mark", "ascending")])
            docs = Documents(batch.column("doc_id").to_numpy(), batch.column("mark").to_numpy())
            ids = docs.ids.tolist()
            runs, window = cut([(t or "").encode("utf-8", "replace") for t in batch.column("text").to_pylist()])
            runs.doc = docs.places[runs.doc]
            first: dict[bytes, int] = {}
            seen: set[tuple[int, int]] = set()
            spans, kept = Spans(docs), []
            for i, (text, doc, at, n) in enumerate(
                zip(runs.texts, runs.doc.tolist(), runs.at.tolist(), runs.windows.tolist())
            ):
                before = first.setdefault(text, i)
                if before == i:
                    kept.append(i)
                    continue
                # Documents come in order, so an equal run seen before is smaller.
                first_doc = int(runs.doc[before])
                own = first_doc == doc if within else ids[first_doc] == ids[doc]
                if not own or (within and int(runs.at[before]) != at):
                    spans.add(doc, at, at + n - 1 + window)
                elif not within and (doc, at) not in seen:
                    seen.add((doc, at))
                    kept.append(i)
            runs, bucket = sent(runs.taken(np.array(kept, np.int64)))
            order = np.argsort(bucket, kind="stable")
            bounds = np.flatnonzero(np.diff(bucket[order], prepend=-1)).tolist() + [len(order)]
            packets = [
                (int(bucket[order[a]]), runs.pack(order[a:b], docs)) for a, b in zip(bounds, bounds[1:])
            ]
            yield spans.batch(packets)

    return run


def _reducer(meet: Meet, within: bool) -> Callable:
    def work(packets: list[Packet]) -> pa.RecordBatch:
        docs = Documents(*(np.concatenate([getattr(p, n) for p in packets]) for n in ("id", "mark")))
        spans = Spans(docs)
        for packet, doc in zip(packets, np.split(docs.places, np.cumsum([len(p.id) for p in packets])[:-1])):
            packet.doc = doc
        gram = np.concatenate([p.gram for p in packets])
        source = np.repeat(np.arange(len(packets)), [len(p.gram) for p in packets])
        place = np.concatenate([np.arange(len(p.gram)) for p in packets])
        doc = docs.places
        order = np.lexsort((doc, gram))
        edges = np.flatnonzero(np.diff(gram[order])) + 1
        bounds = np.concatenate([[0], edges, [len(order)]])
        several = np.diff(bounds) > 1
        if not within:  # a repeat needs another document
            several &= doc[order][bounds[1:] - 1] > doc[order][bounds[:-1]]
        groups = [order[a:b] for a, b in zip(bounds[:-1][several], bounds[1:][several])]
        if groups:
            meet(packets, source, place, groups, spans)
        return spans.batch()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            known = batch.column("payload").is_null()
            yield batch.filter(known).select(["doc_id", "mark", "begins", "ends"])
            rest = batch.filter(pc.invert(known))
            for bucket, payload in zip(rest.column("bucket").to_pylist(), rest.column("payload")):
                if bucket != now and held:
                    yield work(held)
                    held = []
                now = bucket
                held.append(Packet(payload.as_py()))
        if held:
            yield work(held)

    return run


def marked(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, text) of `docs` (doc_id, text): documents that share a doc_id but differ in
    their texts have different marks; where a doc_id has one text, the mark is 0."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    text = F.xxhash64(text_of())
    shared = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min(text).alias("low"), F.max(text).alias("high"))
    # None, in most tables: Spark then broadcasts it, and no text is shuffled.
    several = stored(shared.where("low <> high").select("doc_id", F.lit(True).alias("__several")), "shared")
    mark = F.when(F.col("__several"), text).otherwise(F.lit(0).cast("bigint")).alias("mark")
    return rows.join(several, "doc_id", "left").select("doc_id", mark, "text")


def repeated_spans(docs: DataFrame, cut: Cut, meet: Meet, piece: int, within: bool) -> DataFrame:
    """(doc_id, mark, spans): the ranges of repeated windows of `docs` (see `marked`), by document.

    `cut` makes the runs of a piece of text, with grams to avoid where they are given, or only their
    minimisers; `meet` works out which windows of a bucket repeat. With `within`, a window may repeat inside its own document.
    """
    n = tasks(docs.sparkSession)
    rows = docs.where(F.col("doc_id").isNotNull())
    hot = hot_grams(rows.select("text"), cut, piece, n * BUCKETS)
    packets = rows.mapInArrow(_mapper(cut, piece, n * BUCKETS, within, hot), PACKETS)
    # By number, so that each task has as many buckets as any other.
    dealt = packets.repartitionById(n, F.pmod("bucket", F.lit(n)))
    met = dealt.sortWithinPartitions("bucket").mapInArrow(_reducer(meet, within), SPANS)
    spans = F.flatten(F.collect_list(F.arrays_zip("begins", "ends"))).alias("spans")
    return met.groupBy("doc_id", "mark").agg(spans)


def merged(spans, size: int) -> np.ndarray:
    """Mask of the units that any of the spans covers."""
    change = np.zeros(size + 1, np.int64)
    for span in spans or ():
        change[min(span["begins"], size)] += 1
        change[min(span["ends"], size)] -= 1
    return np.cumsum(change)[:size] > 0
