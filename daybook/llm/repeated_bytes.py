"""Removes byte strings of 100 bytes that stand somewhere before, by merged suffix orders.

Documents are cut into super-k-mers of bytes, so that strings that can be equal meet in one
bucket and only those travel on whose minimiser occurs again. In a bucket the texts of the
pieces form shards. Each shard's suffixes are sorted and give its Burrows-Wheeler transform; the
transforms are merged by refining how the shards interleave, eight symbols a round: putting the
rows in order of the symbols before them sorts them by a prefix as much longer (Holt and
McMillan, 2014). The round in which two neighbours part is their common prefix; rows never
parted within 100 bytes are a repeated interval. No suffix is compared or sorted again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from daybook.llm import superkmers as S
from daybook.llm.frames import pieces

WINDOW = 100  # bytes
GRAM = 16  # bytes
PIECE = 2 << 20  # bytes of text a task works on at once
SHARD = 1 << 19  # bytes sorted at once
MERGE = 1 << 20  # bytes of shards merged at once, or one minimiser's
AT_ONCE = 1 << 23  # bytes of strings taken out of their packets at once, or one minimiser's
STOP = 255  # ends a text in a shard; no byte of UTF-8
STEP = 8  # symbols a round


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of `data`, read as a circle, as numbers in their order."""
    made = np.zeros(len(data), np.uint64)
    for i in range(8):
        made = (made << np.uint64(8)) | np.roll(data, -i)
    return made


def levels(values: np.ndarray) -> np.ndarray:
    """Values replaced by their place among the different ones."""
    order = np.argsort(values)
    ranked = values[order]
    made = np.empty(len(values), np.uint64)
    made[order] = np.cumsum(np.concatenate([[0], ranked[1:] != ranked[:-1]]))
    return made


def suffix_order(level: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of `depth` or more bytes from there, of a circle that `levels` of
    eight bytes stand for."""
    n, have = len(level), STEP
    most = np.uint64(int(level.max()) + 1)
    while True:
        rank = level * most + np.roll(level, -have)
        have *= 2
        if have >= depth:
            return np.argsort(rank)
        level, most = levels(rank), np.uint64(n)


def merge(shards: list[np.ndarray], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(places, parted): the places of all shards, one after the other, in the order of `window`
    bytes, and for each the length by which it is told from the one before (0: not within
    `window`; the common prefix is up to `STEP` shorter)."""
    raw = [eights(s) for s in shards]
    bounds = np.cumsum([0, *map(len, raw)])
    level = levels(np.concatenate(raw))
    parts = [level[a:b] for a, b in zip(bounds, bounds[1:])]
    orders = [suffix_order(part, window) for part in parts]
    # The transforms, of some symbols at once: those before each suffix, in the suffixes' order.
    short = window % STEP
    few = [r[o - short] >> np.uint64(64 - 8 * short) for r, o in zip(raw, orders)] if short else []
    full = [part[o - STEP] for part, o in zip(parts, orders)]
    total = int(bounds[-1])
    which = np.repeat(np.arange(len(shards), dtype=np.uint8), np.diff(bounds))
    parted = np.zeros(total, np.uint16)
    block = np.zeros(total, np.int32)
    symbols = np.empty(total, np.uint64)
    row = np.arange(total, dtype=np.uint64)
    depth = 0
    for transforms in [few] * bool(short) + [full] * (window // STEP):
        depth += short if transforms is few else STEP
        for s, transform in enumerate(transforms):
            symbols[which == s] = transform
        # Rows by their symbols, equal ones as they were.
        symbols <<= np.uint64(32)
        symbols |= row
        symbols.sort()
        turn = (symbols & np.uint64(0xFFFFFFFF)).astype(np.int64)
        symbols >>= np.uint64(32)
        which, came = which[turn], block[turn]
        fresh = (symbols[1:] != symbols[:-1]) | (came[1:] != came[:-1])
        fresh &= parted[1:] == 0
        parted[1:][fresh] = depth
        np.cumsum(parted > 0, out=block)
    places = np.empty(total, np.int64)
    for s, order in enumerate(orders):
        places[which == s] = bounds[s] + order
    return places, parted


def _grams(data: np.ndarray) -> np.ndarray:
    """Hashes of the `GRAM` bytes from each place on."""
    if len(data) < GRAM:
        return np.zeros(0, np.uint64)
    words = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    return S.mixed(words[:-8] * np.uint64(0x9E3779B97F4A7C15) ^ S.mixed(words[8:]))


def _cut(texts: list[bytes], avoid: np.ndarray | None = None, whole: bool = True) -> tuple[S.Runs, int] | np.ndarray:
    held = b"".join(texts)
    data = np.frombuffer(held, np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    group = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    grams = _grams(data)
    firsts, n, least = S.runs_of(grams, group, WINDOW, GRAM, avoid)
    if not whole:
        return least
    cut = [held[a:b] for a, b in zip(firsts.tolist(), (firsts + n + WINDOW - 1).tolist())]
    doc = group[firsts]
    begins = np.cumsum(sizes) - sizes
    return S.Runs(least, doc, firsts - begins[doc], n, cut), WINDOW


Where = dict[bytes, list[tuple[int, int]]]


def _remove(spans: S.Spans, doc: int, at: int, repeated: np.ndarray) -> None:
    for run in np.split(repeated, np.flatnonzero(np.diff(repeated) > 1) + 1):
        if len(run):
            spans.add(doc, at + int(run[0]), at + int(run[-1]) + WINDOW)


def _merge_groups(wheres: list[Where], spans: S.Spans) -> None:
    """Finds the repeats among the different strings of some minimisers."""
    texts = [(text, stands, min(stands)) for where in wheres for text, stands in where.items()]
    total = sum(len(t) + 1 for t, _, _ in texts)
    count = min(255, max(2, -(-total // SHARD)))
    shards: list[list[bytes]] = [[]]
    held = 0
    for text, _, _ in texts:
        if held >= total / count and len(shards) < count:
            shards.append([])
            held = 0
        shards[-1].append(text)
        held += len(text) + 1
    stop = bytes([STOP])
    places, parted = merge([np.frombuffer(stop.join(s) + stop, np.uint8) for s in shards])

    windows = np.array([len(t) - WINDOW + 1 for t, _, _ in texts], np.int64)
    size = np.array([len(t) + 1 for t, _, _ in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), size)
    offset = np.arange(total) - np.repeat(np.cumsum(size) - size, size)
    block = np.cumsum(parted > 0)
    # Only places where a window begins; the others reach into the next text.
    begins = offset[places] < windows[owner[places]]
    places, block = places[begins], block[begins]
    first_doc = np.array([f[0] for _, _, f in texts], np.int64)[owner[places]]
    first_at = np.array([f[1] for _, _, f in texts], np.int64)[owner[places]] + offset[places]
    order = np.lexsort((first_at, first_doc, block))
    new = np.concatenate([[True], np.diff(block[order]) > 0])
    lead = np.flatnonzero(new)[np.cumsum(new) - 1]
    least_doc = np.empty(total, np.int64)
    least_at = np.empty(total, np.int64)
    least_doc[places[order]] = first_doc[order][lead]
    least_at[places[order]] = first_at[order][lead]
    begin = 0
    for (text, stands, _), n in zip(texts, windows.tolist()):
        doc, at = least_doc[begin : begin + n], least_at[begin : begin + n]
        for own, place in stands:
            before = (doc < own) | ((doc == own) & (at < place + np.arange(n)))
            _remove(spans, own, place, np.flatnonzero(before))
        begin += len(text) + 1


def _first_gone(spans: S.Spans, text: bytes, stands: list[tuple[int, int]]) -> None:
    """A string that shares no window with another: all its windows came first where it did."""
    if len(stands) > 1:
        first = min(stands)
        for doc, at in stands:
            if (doc, at) != first:
                spans.add(doc, at, at + len(text))


def _minimisers(texts: list[bytes], grams: list[int]) -> list[int]:
    """The place of the minimiser in each text, the first gram with the hash."""
    data = np.frombuffer(b"".join(texts) + bytes(GRAM), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    found = (_grams(data)[: sizes.sum()] >> np.uint64(32)).astype(np.uint32) == np.repeat(
        np.array(grams, np.uint32), sizes
    )
    begins = np.cumsum(sizes) - sizes
    hits = np.flatnonzero(found)
    return (hits[np.searchsorted(hits, begins)] - begins).tolist()


def _may_share(where: Where, places: list[int]) -> set[bytes]:
    """Strings of a minimiser that may share a window with another one: they agree with it on
    half of what a window has beside the minimiser, on the left or on the right."""
    half = (WINDOW - GRAM) // 2
    sides: dict[tuple[str, bytes], list[bytes]] = {}
    for text, p in zip(where, places):
        if p >= half:
            sides.setdefault(("left", text[p - half : p]), []).append(text)
        if len(text) - p - GRAM >= half:
            sides.setdefault(("right", text[p + GRAM : p + GRAM + half]), []).append(text)
    return {text for texts in sides.values() if len(texts) > 1 for text in texts}


def _share(several: list[tuple[int, Where]], spans: S.Spans) -> None:
    """Works out what strings of a minimiser share, some minimisers at once."""
    texts = [text for _, where in several for text in where]
    places = iter(_minimisers(texts, [gram for gram, where in several for _ in where]) if texts else [])
    held: list[Where] = []
    size = 0
    for _, where in several:
        able = _may_share(where, [next(places) for _ in where])
        for text, stands in where.items():
            if text not in able:
                _first_gone(spans, text, stands)
        if able:
            held.append({text: stands for text, stands in where.items() if text in able})
            size += sum(map(len, able))
        if size >= MERGE:
            _merge_groups(held, spans)
            held, size = [], 0
    if held:
        _merge_groups(held, spans)


def _meet(packets, source, place, groups, spans: S.Spans) -> None:
    several: list[tuple[int, Where]] = []
    size = 0
    for group in groups:
        where: Where = {}
        for i in group:
            packet, p = packets[source[i]], place[i]
            where.setdefault(packet.text(p), []).append((int(packet.doc[p]), int(packet.at[p])))
        if len(where) == 1:
            ((text, stands),) = where.items()
            _first_gone(spans, text, stands)
            continue
        several.append((int(packet.gram[p]), where))
        size += sum(map(len, where))
        if size >= AT_ONCE:
            _share(several, spans)
            several, size = [], 0
    _share(several, spans)


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text", PIECE):
        rows = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            data = kept = (text or "").encode("utf-8", "replace")
            removed = runs = 0
            if spans:
                mask = S.merged(spans, len(data))
                removed = int(mask.sum())
                runs = int((np.diff(mask.astype(np.int8), prepend=0) == 1).sum())
                kept = np.frombuffer(data, np.uint8)[~mask].tobytes()
            rows.append((len(data), removed, runs, hashlib.sha256(kept).hexdigest(), kept))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        columns = [pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 5, kinds)]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=names)


def deduplicated(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of `docs` (doc_id, text).

    Bytes covered by a string of `WINDOW` bytes that also starts earlier (in a smaller doc_id, or
    before in the same document) are removed; `kept` (binary, as a cut may part a character) has
    the others. Strings are judged on the input and never cross documents. NULL is empty; rows
    without doc_id are left as they are and compared with none; rows that repeat a document get
    equal results. Different texts under one doc_id are documents of their own, in an order without
    meaning.
    """
    rows = S.marked(docs)
    spans = S.repeated_spans(rows, _cut, _meet, PIECE, within=True)
    return rows.join(spans, ["doc_id", "mark"], "left").mapInArrow(
        _keep, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    )
