"""Finds passages of test questions and answers in documents with one automaton.

The benchmark's windows are patterns of an Aho-Corasick automaton over normalised text. A text is
scanned once by it, and matches are carried back to its own bytes.

The benchmark lies in the shared folder, cut in blocks of about `BLOCK` bytes; only their number
passes the driver. A task reads `GROUP` bytes of texts, and scans them block by block, with one
automaton at a time, so what it holds has a bound whatever the benchmark's size. Where there is one
block its automaton is built once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F, types as T

from daybook import storage
from daybook.llm.frames import pieces, running
from daybook.sources.files import opener

WINDOW = 10  # words
BLOCK = 1 << 18  # bytes of benchmark text per automaton, some 100 MB of memory
GROUP = 16 << 20  # bytes of texts at once

# Fixed value: what is no word, in lower-cased UTF-8: ASCII other than digits and letters.
_GAPS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def normalised(text: str | None) -> bytes:
    """A-Z in lower case, and every run of other ASCII than digits and letters as one space."""
    return b" ".join((text or "").encode("utf-8", "replace").lower().translate(_GAPS).split())


def windows(words: list[bytes], window: int = WINDOW) -> Iterator[tuple[bytes, int]]:
    """(pattern, number of words) of each window; fewer words than `window` are one window."""
    if words:
        n = min(window, len(words))
        for at in range(len(words) - n + 1):
            yield b" " + b" ".join(words[at : at + n]) + b" ", n


def automaton(items: list[tuple[int | None, str]], window: int = WINDOW):
    """Automaton whose values are (number of words, ids of the items with that window)."""
    found: dict[bytes, tuple[int, set]] = {}
    for item, text in items:
        for pattern, n in windows(normalised(text).split(), window):
            found.setdefault(pattern, (n, set()))[1].add(item)
    built = ahocorasick.Automaton()
    for pattern, (n, ids) in found.items():
        # Bytes as characters of the same number, so that positions are byte positions.
        built.add_word(pattern.decode("latin-1"), (n, frozenset(ids)))
    if found:
        built.make_automaton()
    return built if found else None


class Scanned:
    """A text under the scan: its words, framed by spaces, which of them are hit, and by what items."""

    def __init__(self, text: str | None):
        plain = normalised(text)
        self.framed = f" {plain.decode('latin-1')} " if plain else ""
        self.n_words = plain.count(b" ") + 1 if plain else 0
        self.mask: np.ndarray | None = None
        self.items: set = set()

    def scan(self, built) -> None:
        found = list(built.iter(self.framed)) if self.framed else []
        if not found:
            return
        gaps = np.flatnonzero(np.frombuffer(self.framed.encode("latin-1"), np.uint8) == 32)
        change = np.zeros(len(gaps), np.int64)  # one more than there are words
        last = np.searchsorted(gaps, [end for end, _ in found])
        np.add.at(change, last - [n for _, (n, _) in found], 1)
        np.add.at(change, last, -1)
        hit = np.cumsum(change)[:-1] > 0
        self.mask = hit if self.mask is None else self.mask | hit
        for _, (_, ids) in found:
            self.items |= ids


def spans(text: str, hit_from: list[int], hit_to: list[int]) -> list[tuple[int, int]]:
    """Byte ranges of the original text that the given ranges of words take up."""
    words = [m.span() for m in _WORD.finditer(text.encode("utf-8", "replace").lower())]
    return [(words[a][0], words[b - 1][1]) for a, b in zip(hit_from, hit_to)]


FOUND = {
    "n_words": pa.int64(),
    "n_hit": pa.int64(),
    "items": pa.list_(pa.int64()),
    "hit_from": pa.list_(pa.int64()),
    "hit_to": pa.list_(pa.int64()),
    "starts": pa.list_(pa.int64()),
    "ends": pa.list_(pa.int64()),
}


def runs(mask: np.ndarray) -> tuple[list[int], list[int]]:
    """Where the runs of true values begin, and where they end."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edges[::2].tolist(), edges[1::2].tolist()


SEGMENTS = "item_id bigint, plain string"


def _segments(window: int, size: int) -> Callable:
    """Items as normalised text; long ones in segments that share so many words that no window is lost."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = [], []
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
                words = normalised(text).split()
                ends = np.cumsum([len(w) + 1 for w in words])
                begin = 0
                while begin < len(words):
                    before = ends[begin - 1] if begin else 0
                    end = max(int(np.searchsorted(ends, before + size, "right")), begin + window)
                    ids.append(item)
                    texts.append(b" ".join(words[begin:end]).decode("utf-8", "replace"))
                    if end >= len(words):
                        break
                    begin = end - window + 1
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], names=["item_id", "plain"])

    return run


def stored_blocks(benchmark: DataFrame, window: int = WINDOW, size: int = BLOCK) -> tuple[str, int]:
    """(folder, number) of the benchmark's blocks, numbered from 0 and stored as Parquet."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("text is not null")
    cut = items.mapInArrow(_segments(window, size), SEGMENTS).distinct()
    mixed = cut.withColumn("__mix", F.xxhash64("plain"))
    numbered = running(mixed, ["__mix", "item_id", "plain"], value=F.octet_length("plain") + 1)
    block = F.floor(F.col("before") / size).cast("int").alias("block")
    path = storage.scratch(spark, "benchmark")
    numbered.select(block, "item_id", "plain").hint("rebalance", "block").write.partitionBy("block").parquet(path)
    held = spark.read.schema(SEGMENTS + ", block int").parquet(path)
    return path, (held.agg(F.max("block")).first()[0] or 0) + 1


def _automaton_of(path: str, block: int, window: int):
    """The automaton of a stored block; None where it holds nothing."""
    system, inner = opener()(path)
    folder = f"{inner}/block={block}"
    listed = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    items = []
    for file in listed:
        if file.base_name.endswith(".parquet"):
            held = pq.read_table(file.path, filesystem=system, columns=["item_id", "plain"], partitioning=None)
            items += zip(held.column("item_id").to_pylist(), held.column("plain").to_pylist())
    return automaton(items, window)


def _scanner(path: str, blocks: int, window: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built, number = None, None

        def work(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal built, number
            texts = [[Scanned(t) for t in batch.column("text").to_pylist()] for batch in held]
            for block in range(blocks):
                if block != number:
                    built = None  # before the next one is built
                    built, number = _automaton_of(path, block, window), block
                if built is not None:
                    for some in texts:
                        for text in some:
                            text.scan(built)
            for batch, some in zip(held, texts):
                own = [n for n in batch.schema.names if n not in FOUND]
                rows = []
                for text, found in zip(batch.column("text").to_pylist(), some):
                    mask = np.zeros(found.n_words, bool) if found.mask is None else found.mask
                    hit_from, hit_to = runs(mask)
                    where = spans(text, hit_from, hit_to) if hit_from else []
                    listed = sorted(found.items - {None})
                    rows.append(
                        (found.n_words, int(mask.sum()), listed, hit_from, hit_to, [a for a, _ in where], [b for _, b in where])
                    )
                columns = list(zip(*rows)) or [()] * len(FOUND)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(n) for n in own], *[pa.array(c, k) for c, k in zip(columns, FOUND.values())]],
                    names=[*own, *FOUND],
                )

        held, size = [], 0
        for batch in pieces(batches, "text", GROUP):
            held.append(batch)
            size += batch.nbytes
            if size >= GROUP:
                yield from work(held)
                held, size = [], 0
        yield from work(held)

    return run


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, size: int = BLOCK) -> DataFrame:
    """`docs` (text and others) with n_words, n_hit, items, hit_from, hit_to, starts, ends, contaminated.

    A word is hit inside any window of an item that occurs in the document. `items` are the ids
    of items with occurring windows, sorted; `hit_from` and `hit_to` are the ranges of hit words,
    `starts` and `ends` those of UTF-8 bytes of the text. NULL has no words; an item without
    words has no window; a NULL item_id hits words but is not listed. Repeated rows get equal
    results. Columns of `docs` with the names of new ones give way.
    """
    rest = docs.select(*[c for c in docs.columns if c not in FOUND and c != "contaminated"])
    number, numbers = T.LongType(), T.ArrayType(T.LongType())
    found = [T.StructField(n, number if k == pa.int64() else numbers) for n, k in FOUND.items()]
    schema = T.StructType(rest.schema.fields + found)
    path, blocks = stored_blocks(benchmark, window, size)
    rest = rest.mapInArrow(_scanner(storage.qualified(docs.sparkSession, path), blocks, window), schema)
    return rest.withColumn("contaminated", F.col("n_hit") > 0)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` without any window of the benchmark, with the columns they came with."""
    others = [c for c in docs.columns if c != "text"]
    found = find(docs.select("text", F.struct(*others).alias("own")), benchmark)
    return found.where(~F.col("contaminated")).select("text", "own.*").select(*docs.columns)
