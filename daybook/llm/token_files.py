"""Token ids in ORC files, in order of the documents.

Ids are integer columns of ORC stripes: run-length encoded, with a row index, and with Bloom
filters on doc_id, so that a lookup skips stripes by their metadata and a scan reads stripes in
parallel. The texts are dealt to tasks by ranges of doc_id and sorted there; each task encodes
what it writes.
"""

from __future__ import annotations

import array
import json
import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from daybook.llm.frames import pieces, running, tasks

END = 2  # appended to each document
PIECE = 3 << 20  # bytes of text encoded at once
KNOWN = 800_000  # units whose ids a worker remembers
TOGETHER = 1000  # units encoded as one text

# How a tokenizer file must describe itself for `units` to give the ids of the whole.
UNIT_RULES = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
UNIT_MODEL = {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>"}

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\x0b\x0c\r")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TWICE = 0xC3  # begins U+00C0 to U+00FF, letters but for two signs
_SIGNS = (0x97, 0xB7)


def units(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends) of the units of a text: encoding them one by one gives the ids of
    the whole.

    The tokenizer joins nothing across white space. A word of ASCII and of Latin letters of two
    bytes it also parts between letters and other signs, and lower-cases; such words are cut
    there and lower-cased here, so that fewer units differ. Words with an apostrophe, which
    begins endings such as 's, with a <, which begins special tokens, and with any other
    character stay as they are.
    """
    space = _SPACE[data]
    before = np.concatenate([[True], space[:-1]])
    word = np.cumsum(before & ~space)  # from 1; the number of the word a byte is in
    odd = (data == 39) | (data == 60) | ((data >= 192) & (data != _TWICE))
    sign = np.zeros(len(data), bool)
    sign[1:] = (data[:-1] == _TWICE) & ((data[1:] == _SIGNS[0]) | (data[1:] == _SIGNS[1]))
    whole = np.zeros(int(word[-1]) + 1 if len(word) else 1, bool)
    whole[word[(odd | sign) & ~space]] = True
    whole = whole[word]
    letter = _LETTER[data]
    cut = np.zeros(len(data), bool)
    cut[1:] = (letter[1:] != letter[:-1]) & ~whole[1:]
    starts = np.flatnonzero(~space & (before | cut))
    ends = np.flatnonzero(~space & np.concatenate([space[1:] | cut[1:], [True]])) + 1
    return np.where(whole, data, _LOWER[data]), starts, ends


class Powers:
    """Powers of an odd number modulo 2**64, and of its inverse."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self):
        self.up = self.down = np.zeros(0, np.uint64)

    def grow(self, size: int) -> None:
        if len(self.up) < size:
            one, back = np.uint64(self.BASE), np.uint64(pow(self.BASE, -1, 1 << 64))
            self.up = np.multiply.accumulate(np.full(size, one, np.uint64))
            self.down = np.multiply.accumulate(np.full(size, back, np.uint64))


def _firsts(codes: np.ndarray) -> np.ndarray:
    firsts = np.empty(codes.max(initial=-1) + 1, np.int64)
    firsts[codes[::-1]] = np.arange(len(codes))[::-1]
    return firsts


def numbered(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers
) -> tuple[np.ndarray, np.ndarray]:
    """(number of each unit, place of the first unit of each number); equal units, equal numbers."""
    powers.grow(len(data))
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum((data + np.uint64(1)) * powers.up[: len(data)], out=total[1:])
    codes, _ = pd.factorize((total[ends] - total[starts]) * powers.down[starts])
    firsts = _firsts(codes)
    # Hashes may agree by chance: lengths and the outer eight bytes must too.
    padded = np.concatenate([np.zeros(8, np.uint8), data, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    length = ends - starts
    spare = np.uint64(64) - np.minimum(length, 8).astype(np.uint64) * np.uint64(8)
    outer = (eights[starts + 8] << spare) + (eights[ends] >> spare) * np.uint64(3) + length.astype(np.uint64)
    if (outer != outer[firsts[codes]]).any():
        held = data.tobytes()
        codes, _ = pd.factorize(np.array([held[a:b] for a, b in zip(starts, ends)], object))
        firsts = _firsts(codes)
    return codes, firsts


def parts_at_units(file: str) -> bool:
    """True if a tokenizer file normalises and parts texts as `units` supposes."""
    with open(file, encoding="utf-8") as held:
        rules = json.load(held)
    return (
        all(rules.get(name) == wanted for name, wanted in UNIT_RULES.items())
        and all(rules["model"].get(name) == wanted for name, wanted in UNIT_MODEL.items())
        # Words with a < are left whole, so that these are found in them.
        and all(t["content"].startswith("<") and not t["normalized"] for t in rules["added_tokens"])
        and not any(t["lstrip"] or t["rstrip"] or len(t["content"].split()) > 1 for t in rules["added_tokens"])
    )


class Encoder:
    """Ids of texts by way of their units, each of which is encoded once; whole texts are encoded
    for a tokenizer that parts them in another way."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task per core
        self.tokenizer = Tokenizer.from_file(path)
        self.by_units = parts_at_units(path)
        self.known: dict[bytes, bytes] = {}
        self.powers = Powers()
        vocabulary = self.tokenizer.get_vocab()
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closing[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.frombuffer(array.array("i", e.ids), np.int32) for e in made]

    def learn(self, some: list[bytes]) -> None:
        """Encodes units: those of ASCII letters are one piece each, whose last id closes a word,
        so many go as one text."""
        plain = [u for u in some if u.isalpha()]
        for at in range(0, len(plain), TOGETHER):
            part = plain[at : at + TOGETHER]
            (ids,) = self.ids([b" ".join(part).decode()])
            closed = (np.flatnonzero(self.closing[ids]) + 1) * 4
            if len(closed) == len(part):
                raw, bounds = ids.tobytes(), [0, *closed.tolist()]
                self.known.update((u, raw[a:b]) for u, a, b in zip(part, bounds, bounds[1:]))
        rest = [u for u in some if u not in self.known]
        self.known.update((u, ids.tobytes()) for u, ids in zip(rest, self.ids([u.decode() for u in rest])))

    def __call__(self, texts: list[str | None], end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with the end id; where each text begins, and the total)."""
        if not self.by_units:
            made = self.ids([t or "" for t in texts])
            last = np.array([end], np.int32)
            bounds = np.cumsum([0, *(len(i) + 1 for i in made)])
            return np.concatenate([np.zeros(0, np.int32), *(a for i in made for a in (i, last))]), bounds
        raw = [(t or "").encode() for t in texts]
        bytes_before = np.cumsum([len(r) + 1 for r in raw])
        data, starts, ends = units(np.frombuffer(b"\n".join(raw) + b"\n", np.uint8))
        codes, firsts = numbered(data, starts, ends, self.powers)
        held = data.tobytes()
        distinct = [held[a:b] for a, b in zip(starts[firsts].tolist(), ends[firsts].tolist())]
        if len(self.known) > KNOWN:
            self.known.clear()
        self.learn([u for u in distinct if u not in self.known])
        ids_of = [self.known[u] for u in distinct]
        lengths = np.array([len(i) // 4 for i in ids_of], np.int32)
        begins = np.cumsum(lengths, dtype=np.int32) - lengths
        store = np.frombuffer(b"".join(ids_of), np.int32)

        taken = lengths[codes]
        after = np.cumsum(taken, dtype=np.int32)
        bounds = np.concatenate([[0], np.concatenate([[0], after])[np.searchsorted(starts, bytes_before)]])
        bounds[1:] += np.arange(1, len(texts) + 1)  # the end ids
        place = np.repeat(begins[codes] - (after - taken), taken)
        place += np.arange(len(place), dtype=np.int32)
        out = np.full(bounds[-1], end, np.int32)
        inside = np.ones(len(out), bool)
        inside[bounds[1:] - 1] = False
        out[inside] = store[place]
        return out, bounds


def kept_encoder(path: str) -> Encoder:
    """One encoder per Python worker: it stays for the worker's next tasks, with what it knows."""
    import tokenizers

    held = tokenizers.__dict__.setdefault("_encoders", {})
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


def _encoder(path: str, end: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_encoder(path)
        for piece in pieces(batches, "text", PIECE):
            ids, bounds = encoder(piece.column("text").to_pylist(), end)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))],
                names=["doc_id", "ids"],
            )

    return run


def write_ids(docs: DataFrame, path: str, tokenizer: str, end: int = END, stride: int = 1000) -> None:
    """Writes (doc_id, ids) of `docs` (doc_id, text) as ORC below `path`, in ascending doc_id.

    `tokenizer` is a tokenizer file that every worker can open. NULL and empty texts have the end
    id alone. A NULL doc_id comes first; repeated rows stay repeated.
    """
    (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        .repartitionByRange(tasks(docs.sparkSession), "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(_encoder(tokenizer, end), "doc_id bigint, ids array<int>")
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.row.index.stride", stride)
        .option("orc.stripe.size", 32 << 20)
        .option("compression", "zstd")
        .orc(path)
    )


def read_ids(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, ids); with `doc_ids`, stripes and row groups without them are skipped."""
    rows = spark.read.schema("doc_id bigint, ids array<int>").orc(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(doc_ids))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        bounds = ids.offsets.to_numpy()
        raw = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<u4")).cast("B")
        sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(bounds, bounds[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(bounds), pa.int64()), pa.array(sums, pa.int64())],
            names=["doc_id", "n_tokens", "ids_crc32"],
        )


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the files below `path`."""
    measured = read_ids(spark, path).mapInArrow(_measure, "doc_id bigint, n_tokens bigint, ids_crc32 bigint")
    return running(measured, ["doc_id", "ids_crc32"], value=F.col("n_tokens"), name="start").select(
        "doc_id", "start", "n_tokens", "ids_crc32"
    )
