"""Aligns two tokenizers' tokens by merging the byte offsets where they end.

The ends of a text's A tokens and B tokens are two sorted lists; merging them is a path of
n_a + n_b steps. Diagonals of the merge grid, `WORK` steps apart, cut the path into pieces of equal
work: a binary search on each diagonal finds how many ends of either list lie before it. A piece
needs its own tokens, the offsets they begin at and the token of either side that comes next; so
pieces of a long text are rows like those of many short ones. Each emits its overlaps, and what it
holds of the groups; groups that span pieces are stitched.

Counts of overlapping ids are summed over the corpus and brought back by chunk: pieces in a row
that hold `CHUNK` tokens share one list of the id pairs they need.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from daybook.llm.frames import stored, tasks

WORK = 1 << 16  # steps of a piece
CHUNK = 1 << 21  # tokens
PAIRS = 1 << 16  # of a chunk, handed on at once
SPACE = "▁"  # fixed value: how B's pieces write a space
LEVEL = 6  # of compression


def byte_letters() -> dict[str, int]:
    """The character that a byte-level vocabulary writes for each byte, as public byte-level BPE
    has it: printable Latin-1 stands for itself, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


# Fixed value: how public byte-level BPE parts a text before it merges.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Beyond these characters, libraries may differ in what is a letter, a number or a space; and runs
# without or of spaces that are this long are slow in one of them.
UNSURE = regex.compile(r"[^\t\n\r\x20-\x7e\xa0-\u024f]|\S{400}|\s{400}")


def ranked(tokenizer, token_bytes: list[bytes]):
    """The tokenizer as ranks of its tokens, which the `tiktoken` library merges several times as
    fast to the same ids. None unless the tokenizer's file says that it parts texts like `PARTS`,
    and its ids follow the order of its merges."""
    held = json.loads(tokenizer.to_str())
    cut, model = held["pre_tokenizer"] or {}, held["model"]
    plain = held["normalizer"] is None and held["post_processor"] is None and held["truncation"] is None
    byte_level = cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")
    merged = model.get("type") == "BPE" and not any(
        model.get(n) for n in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback")
    )
    if not (plain and byte_level and merged and all(t["special"] for t in held["added_tokens"])):
        return None
    ids = [model["vocab"]["".join(pair)] for pair in model["merges"]]
    special = {t["id"] for t in held["added_tokens"]}
    ranks = {token: i for i, token in enumerate(token_bytes) if i not in special}
    if ids != sorted(set(ids)) or len(ranks) != len(token_bytes) - len(special):
        return None
    import tiktoken

    return tiktoken.Encoding("ranked", pat_str=PARTS, mergeable_ranks=ranks, special_tokens={})


class Tokenizers(NamedTuple):
    """Both tokenizers, the bytes of each id, and how many they are."""

    a: object
    b: object
    a_bytes: list[bytes]
    b_bytes: list[bytes]
    a_sizes: np.ndarray
    b_sizes: np.ndarray
    ranks: object | None

    def a_ids(self, text: str) -> list[int]:
        """A's ids of a text, by its ranks where that is known to give the same."""
        if self.ranks is not None and not UNSURE.search(text):
            return self.ranks.encode_ordinary(text)
        return self.a.encode(text, add_special_tokens=False).ids

    def spells(self, ids: np.ndarray, whole: np.ndarray, first: bool) -> bool:
        """Whether the bytes of A's (or B's) ids, one after the other, are those given."""
        flat, begins = _flat(self, first)
        sizes = (self.a_sizes if first else self.b_sizes)[ids]
        if int(sizes.sum()) != len(whole):
            return False
        places = np.arange(len(whole)) + np.repeat(begins[ids] - (np.cumsum(sizes) - sizes), sizes)
        return bool((flat[places] == whole).all())


_FLAT: dict[tuple[int, bool], tuple[np.ndarray, np.ndarray]] = {}


def _flat(both: Tokenizers, first: bool) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all ids in one array, and where each id's begin."""
    key = id(both.a), first
    if key not in _FLAT:
        tokens, sizes = (both.a_bytes, both.a_sizes) if first else (both.b_bytes, both.b_sizes)
        _FLAT[key] = np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(sizes) - sizes
    return _FLAT[key]


@cache
def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    """Loaded once per worker: A from a `tokenizers` file, B from a `sentencepiece` model."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    letters = byte_letters()
    special = {t["id"] for t in json.loads(a.to_str())["added_tokens"]}
    a_bytes = [b""] * a.get_vocab_size()
    for token, i in a.get_vocab().items():
        a_bytes[i] = token.encode() if i in special else bytes(letters[c] for c in token)
    b_bytes = [
        bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace(SPACE, " ").encode()
        for i, piece in ((i, b.id_to_piece(i)) for i in range(b.vocab_size()))
    ]
    a_sizes, b_sizes = (np.array([len(t) for t in tokens], np.int64) for tokens in (a_bytes, b_bytes))
    return Tokenizers(a, b, a_bytes, b_bytes, a_sizes, b_sizes, ranked(a, a_bytes))


def encoded(text: str | None, both: Tokenizers) -> tuple[np.ndarray, np.ndarray]:
    """Ids of A and B; none where the text is NULL or empty, or either loses a byte of it."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not text:
        return none
    a = np.array(both.a_ids(" " + text), np.int64)
    b = np.array(both.b.encode(text, num_threads=1), np.int64)
    whole = np.frombuffer((" " + text).encode(), np.uint8)
    return (a, b) if both.spells(a, whole, True) and both.spells(b, whole, False) else none


def cuts(a_ends: np.ndarray, b_ends: np.ndarray, work: int = WORK) -> np.ndarray:
    """How many A ends come before each cut of the merge path, of two ends at one place A's first.

    Cuts lie on the diagonals 0, `work`, 2 `work`, ... and the last; all are searched at once.
    """
    total = len(a_ends) + len(b_ends)
    diagonals = np.append(np.arange(0, total, work), total)
    low, high = np.maximum(0, diagonals - len(b_ends)), np.minimum(diagonals, len(a_ends))
    while (low < high).any():
        middle = (low + high) // 2
        # A's next end goes before the cut if it is not behind B's last one before the cut.
        b_at = np.minimum(np.maximum(diagonals - middle - 1, 0), max(len(b_ends) - 1, 0))
        open_ = low < high
        goes = open_ & (a_ends[np.minimum(middle, len(a_ends) - 1)] <= b_ends[b_at])
        low = np.where(goes, middle + 1, low)
        high = np.where(open_ & ~goes, middle, high)
    return low


class Piece(NamedTuple):
    """A piece of a merge path: its tokens, the offsets that they begin at (-1: no token before),
    and the next token of either side (-1: none)."""

    a: np.ndarray
    b: np.ndarray
    a_begin: int
    b_begin: int
    a_next: int
    b_next: int


def pieces_of(a: np.ndarray, b: np.ndarray, both: Tokenizers, work: int = WORK) -> list[Piece]:
    if not len(a):
        return [Piece(a, b, 0, 0, -1, -1)]
    a_ends, b_ends = np.cumsum(both.a_sizes[a]), np.cumsum(both.b_sizes[b])
    a_cut = cuts(a_ends, b_ends, work)
    b_cut = np.append(np.arange(0, len(a) + len(b), work), len(a) + len(b)) - a_cut
    end = lambda ends, at: int(ends[at - 1]) if at else 0
    after = lambda ids, at: int(ids[at]) if at < len(ids) else -1
    return [
        Piece(a[i:k], b[j:m], end(a_ends, i), end(b_ends, j), after(a, k), after(b, m))
        for i, k, j, m in zip(a_cut[:-1].tolist(), a_cut[1:].tolist(), b_cut[:-1].tolist(), b_cut[1:].tolist())
    ]


class Overlaps(NamedTuple):
    """What a piece emits: the ids of each A-B pair whose bytes overlap, and the places in its
    tokens where A and B end together (`a_cut` and `b_cut` tokens of the piece lie before)."""

    a: np.ndarray
    b: np.ndarray
    a_cut: np.ndarray
    b_cut: np.ndarray


def overlaps(piece: Piece, both: Tokenizers) -> Overlaps:
    """A pair overlaps in one stretch, which ends where one of its tokens does. So every A end
    gives a pair, and every B end that is no A end."""
    a_ends = piece.a_begin + np.cumsum(both.a_sizes[piece.a])
    b_ends = piece.b_begin + np.cumsum(both.b_sizes[piece.b])
    a_ids, b_ids = np.append(piece.a, piece.a_next), np.append(piece.b, piece.b_next)
    # Ends of the other side that lie before.
    b_before = np.searchsorted(b_ends, a_ends, "left")
    a_before = np.searchsorted(a_ends, b_ends, "right")
    last = np.where(a_before > 0, a_ends[a_before - 1] if len(a_ends) else 0, piece.a_begin)
    together = last == b_ends
    alone = ~together
    return Overlaps(
        np.concatenate([piece.a, a_ids[a_before[alone]]]),
        np.concatenate([b_ids[b_before], piece.b[alone]]),
        a_before[together],
        np.flatnonzero(together) + 1,
    )


def codes(found: Overlaps) -> np.ndarray:
    """One number for each pair of ids."""
    return found.a << 32 | found.b


# ---- tokens as pieces ----------------------------------------------------------------------

CHUNKS = "chunk bigint, payload binary"
PIECES = (
    "row bigint, doc_id bigint, piece int, pieces int, n_a bigint, n_b bigint, "
    "a_begin bigint, b_begin bigint, a_next int, b_next int, tokens binary"
)


def _kind(n: int) -> str:
    """How ids below `n` are written."""
    return "<u2" if n <= 1 << 16 else "<u4"


def _tokens(piece: Piece, both: Tokenizers) -> bytes:
    return piece.a.astype(_kind(len(both.a_bytes))).tobytes() + piece.b.astype(_kind(len(both.b_bytes))).tobytes()


def _packed(rows: list[tuple], schema: pa.Schema) -> bytes:
    """The pieces of a chunk as one compressed batch."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as out:
        out.write_batch(_batch(rows, schema))
    return zstandard.ZstdCompressor(level=LEVEL).compress(sink.getvalue())


def _unpacked(payload: bytes) -> list[dict]:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    return pa.ipc.open_stream(raw).read_all().to_pylist()


def _piece(row: dict, both: Tokenizers) -> Piece:
    n, kinds = row["n_a"], (_kind(len(both.a_bytes)), _kind(len(both.b_bytes)))
    a = np.frombuffer(row["tokens"], kinds[0], n).astype(np.int64)
    b = np.frombuffer(row["tokens"], kinds[1], row["n_b"], a.size * int(kinds[0][-1])).astype(np.int64)
    return Piece(a, b, row["a_begin"], row["b_begin"], row["a_next"], row["b_next"])


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType.fromDDL(schema))


def _encoder(a_path: str, b_path: str, work: int, chunk: int):
    schema, packets = _arrow(PIECES), _arrow(CHUNKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(a_path, b_path)
        number, held, rows = TaskContext.get().partitionId() << 32, 0, []
        for batch in batches:
            for row, doc_id, text in zip(*[batch.column(n) for n in ("row", "doc_id", "text")]):
                made = pieces_of(*encoded(text.as_py(), both), both, work)
                for at, p in enumerate(made):
                    rows.append(
                        (row.as_py(), doc_id.as_py(), at, len(made), len(p.a), len(p.b),
                         p.a_begin, p.b_begin, p.a_next, p.b_next, _tokens(p, both))
                    )
                    held += len(p.a) + len(p.b) + 8
                    if held >= chunk:
                        yield _batch([(number, _packed(rows, schema))], packets)
                        number, held, rows = number + 1, 0, []
        if rows:
            yield _batch([(number, _packed(rows, schema))], packets)

    return run


def tokenized(docs: DataFrame, a_path: str, b_path: str, work: int = WORK, chunk: int = CHUNK) -> DataFrame:
    """The merge-path pieces of `docs` (doc_id, text), at least one for each row, packed by chunk
    and stored."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text"
    )
    return stored(rows.mapInArrow(_encoder(a_path, b_path, work, chunk), CHUNKS), "chunks")


# ---- counts of pairs -----------------------------------------------------------------------


def _counter(a_path: str, b_path: str):
    schema = _arrow("chunk bigint, a int, b int, links bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(a_path, b_path)

        def counted(chunk: int, held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            code, links = np.unique(np.concatenate(held), return_counts=True)
            for at in range(0, len(code), PAIRS):
                some = code[at : at + PAIRS]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(some), chunk), pa.int64()),
                        pa.array((some >> 32).astype(np.int32)),
                        pa.array((some & 0xFFFFFFFF).astype(np.int32)),
                        pa.array(links[at : at + PAIRS], pa.int64()),
                    ],
                    schema=schema,
                )

        for batch in batches:
            for chunk, payload in zip(batch.column("chunk").to_pylist(), batch.column("payload")):
                found = (overlaps(_piece(row, both), both) for row in _unpacked(payload.as_py()))
                yield from counted(chunk, [codes(f) for f in found])

    return run


def pair_counts(packed: DataFrame, a_path: str, b_path: str) -> tuple[DataFrame, DataFrame]:
    """(chunk, a, b, links) of the pairs of each chunk, and (a, b, links, best) over the corpus:
    how many links hold a pair of ids, and whether no other A id has more with this B id."""
    counted = packed.mapInArrow(_counter(a_path, b_path), "chunk bigint, a int, b int, links bigint")
    chunks = stored(counted, "pairs")
    totals = stored(chunks.groupBy("a", "b").agg(F.sum("links").alias("links")), "totals")
    most = totals.groupBy("b").agg(F.max("links").alias("most"))
    return chunks, stored(totals.join(most, "b").select("a", "b", "links", (F.col("links") == F.col("most")).alias("best")), "counts")


# ---- documents -----------------------------------------------------------------------------


@cache
def _names(size: int) -> list[str]:
    """Decimal ids with what follows them: `,` or `|` after one of A, `,` or `;` after one of B."""
    return [f"{i}{end}" for end in ",|;" for i in range(size)]


class Stitcher:
    """Writes the groups of one text, piece by piece, as `a1,a2|b1;a3|b2,b3`."""

    def __init__(self):
        self.a = self.b = np.zeros(0, np.int64)
        self.held = ""
        self.digest = hashlib.sha256()

    def add(self, piece: Piece, found: Overlaps) -> None:
        """Takes a piece's tokens; those behind its last cut wait for the next piece."""
        a, b = np.concatenate([self.a, piece.a]), np.concatenate([self.b, piece.b])
        a_cut, b_cut = found.a_cut + len(self.a), found.b_cut + len(self.b)
        if not len(a_cut):
            self.a, self.b = a, b
            return
        n, m = int(a_cut[-1]), int(b_cut[-1])
        self.a, self.b = a[n:], b[m:]
        # A group's A tokens come behind the B tokens of the groups before, its B tokens behind its A tokens.
        a_group = np.searchsorted(a_cut, np.arange(n), "right")
        b_group = np.searchsorted(b_cut, np.arange(m), "right")
        size = 1 << int(max(a[:n].max(), b[:m].max(), 1)).bit_length()
        named = np.empty(n + m, np.int64)
        a_place = np.arange(n) + np.concatenate([[0], b_cut])[a_group]
        b_place = np.arange(m) + a_cut[b_group]
        named[a_place], named[b_place] = a[:n], b[:m]
        named[a_place[a_cut - 1]] += size
        named[b_place[b_cut - 1]] += 2 * size
        names = _names(size)
        text = self.held + "".join([names[i] for i in named.tolist()])
        self.digest.update(text[:-1].encode())
        self.held = ";"

    def hexdigest(self) -> str:
        return self.digest.hexdigest()


SCORED = (
    "row bigint, doc_id bigint, piece int, pieces int, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "n_best bigint, count_sum bigint, groups_sha256 string, a_begin bigint, b_begin bigint, a_next int, b_next int, "
    "tokens binary"
)


def _scorer(a_path: str, b_path: str):
    """Of a chunk and the counts of its pairs, a row for each piece."""
    schema = _arrow(SCORED)

    def run(pieces: pa.Table, counts: pa.Table) -> pa.Table:
        both = tokenizers(a_path, b_path)
        code = counts.column("a").to_numpy().astype(np.int64) << 32 | counts.column("b").to_numpy()
        order = np.argsort(code)
        code = code[order]
        links = counts.column("links").to_numpy()[order]
        best = counts.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
        rows = []
        for row in (row for payload in pieces.column("payload") for row in _unpacked(payload.as_py())):
            piece = _piece(row, both)
            found = overlaps(piece, both)
            at = np.searchsorted(code, codes(found))
            sha, tokens = None, row["tokens"]
            if row["pieces"] == 1:
                whole = Stitcher()
                whole.add(piece, found)
                sha, tokens = whole.hexdigest() if len(piece.a) else "", None
            rows.append(
                (row["row"], row["doc_id"], row["piece"], row["pieces"], len(piece.a), len(piece.b),
                 len(found.a_cut), len(found.a), int(best[at].sum()) if len(at) else 0,
                 int(links[at].sum()) if len(at) else 0, sha,
                 row["a_begin"], row["b_begin"], row["a_next"], row["b_next"], tokens)
            )
        return pa.Table.from_batches([_batch(rows, schema)])

    return run


SUMS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
DOCUMENT = "row bigint, doc_id bigint, " + ", ".join(f"{c} bigint" for c in SUMS) + ", groups_sha256 string"


def _stitched(a_path: str, b_path: str):
    """One row for each text from its pieces, which come in order."""
    schema = _arrow(DOCUMENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(a_path, b_path)
        now, sums, stitch = None, None, None
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if row["row"] != now:
                    now, sums, stitch = row["row"], dict.fromkeys(SUMS, 0), Stitcher()
                piece = _piece(row, both)
                stitch.add(piece, overlaps(piece, both))
                sums = {n: sums[n] + row[n] for n in SUMS}
                if row["piece"] + 1 == row["pieces"]:
                    rows.append((now, row["doc_id"], *sums.values(), stitch.hexdigest()))
            yield _batch(rows, schema)

    return run


def aligned(
    docs: DataFrame, a_path: str, b_path: str, work: int = WORK, chunk: int = CHUNK
) -> tuple[DataFrame, DataFrame]:
    """(documents, counts) of `docs` (doc_id, text) under tokenizers A and B.

    documents: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for each row.
    counts: (a, b, links, best), see `pair_counts`. A encodes the text after a space, B adds the
    space itself. Texts that are NULL or empty, or of which either loses a byte, have no tokens:
    zeros and an empty digest. Repeated rows count each time; a NULL doc_id is a row like others.
    """
    n = tasks(docs.sparkSession)
    packed = tokenized(docs, a_path, b_path, work, chunk)
    chunks, counts = pair_counts(packed, a_path, b_path)
    needed = chunks.select("chunk", "a", "b").join(counts, ["a", "b"])
    scored = stored(
        packed.groupBy("chunk").cogroup(needed.groupBy("chunk")).applyInArrow(_scorer(a_path, b_path), SCORED), "scored"
    )
    short = scored.where("pieces = 1").select("row", "doc_id", *SUMS, "groups_sha256")
    long = scored.where("pieces > 1").repartition(n, "row").sortWithinPartitions("row", "piece")
    found = short.unionByName(long.mapInArrow(_stitched(a_path, b_path), DOCUMENT))
    return found.drop("row"), counts
