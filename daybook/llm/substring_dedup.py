"""Removes passages of 50 words that also stand in an earlier document.

Super-k-mers of words: each bucket sorts the windows that meet in it, so that equal windows
stand together, and finds the smallest document of each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from daybook.llm import superkmers as S
from daybook.llm.frames import pieces

WINDOW = 50  # words
GRAM = 5  # words
PIECE = 4 << 20  # bytes of text a task works on at once
_BASE = 0x9E3779B97F4A7C15
_SPACES = bytes.maketrans(b"\t\n\x0b\x0c\r", b" " * 5)


def _cutter(window: int, gram: int):
    def cut(
        texts: list[bytes], avoid: np.ndarray | None = None, whole: bool = True
    ) -> tuple[S.Runs, int] | np.ndarray:
        # One buffer: words apart by one space, documents by one line end.
        raw = np.frombuffer(b"\n".join(t.translate(_SPACES) for t in texts) + b"\n", np.uint8)
        gap = raw <= 32
        gap &= (raw == 32) | (raw == 10)
        line = raw == 10
        # A space stays between two words only.
        before = np.concatenate([[True], gap[:-1]])
        keep = ~gap | line | ~before
        data = raw[keep]
        gap, line = gap[keep], line[keep]
        starts = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
        ends = np.flatnonzero(~gap & np.concatenate([gap[1:], [True]])) + 1
        group = np.cumsum(line)[starts] if len(starts) else np.zeros(0, np.int64)

        base = np.uint64(_BASE | 1)
        power = np.multiply.accumulate(np.full(len(data), base, np.uint64))
        total = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power)])
        back = np.multiply.accumulate(np.full(len(data), np.uint64(pow(int(base), -1, 1 << 64)), np.uint64))
        words = S.mixed((total[ends] - total[starts]) * back[starts])
        hashes = np.zeros(max(0, len(words) - gram + 1), np.uint64)
        for i in range(gram):
            hashes = hashes * base + words[i : i + len(hashes)]
        firsts, n, least = S.runs_of(S.mixed(hashes), group, window, gram, avoid)
        if not whole:
            return least

        held = data.tobytes()
        texts_of = [
            held[a:b] for a, b in zip(starts[firsts].tolist(), ends[firsts + n + window - 2].tolist())
        ]
        doc = group[firsts]
        begins = np.searchsorted(group, np.arange(len(texts) + 1))
        return S.Runs(least, doc, firsts - begins[doc], n, texts_of), window

    return cut


def _meeter(window: int):
    def meet(packets, source, place, groups, spans: S.Spans) -> None:
        for group in groups:
            # The smallest document of each different string, and where it stands everywhere.
            where: dict[bytes, list[tuple[int, int]]] = {}
            for i in group:
                packet, p = packets[source[i]], place[i]
                where.setdefault(packet.text(p), []).append((int(packet.doc[p]), int(packet.at[p])))
            least = {text: min(stands)[0] for text, stands in where.items()}
            first: dict[bytes, np.ndarray] = {}
            sorted_windows = []
            for text in where:
                gaps = [-1, *(i for i, b in enumerate(text) if b == 32), len(text)]
                n = len(gaps) - window
                first[text] = np.full(n, least[text], np.int64)
                if len(where) > 1:
                    sorted_windows += [
                        (text[gaps[i] + 1 : gaps[i + window]], least[text], text, i) for i in range(n)
                    ]
            sorted_windows.sort(key=lambda w: w[:2])
            now, smallest = None, 0
            for words, doc, text, i in sorted_windows:
                if words != now:
                    now, smallest = words, doc
                first[text][i] = smallest
            for text, stands in where.items():
                for doc, at in stands:
                    repeated = np.flatnonzero(spans.docs.ids[first[text]] < spans.docs.ids[doc])
                    for run in np.split(repeated, np.flatnonzero(np.diff(repeated) > 1) + 1):
                        if len(run):
                            spans.add(doc, at + int(run[0]), at + int(run[-1]) + window)

    return meet


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text", PIECE):
        rows = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            words = (text or "").encode("utf-8", "replace").split()
            removed = 0
            if spans:
                mask = S.merged(spans, len(words))
                removed = int(mask.sum())
                kept = b" ".join([w for w, gone in zip(words, mask.tolist()) if not gone])
            else:
                kept = b" ".join(words)
            rows.append((len(words), removed, hashlib.sha256(kept).hexdigest(), kept.decode()))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
        columns = [pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 4, kinds)]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=names)


def deduplicated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) of `docs` (doc_id, text).

    Words covered by a window that also starts in a document with a smaller doc_id are removed;
    `kept` has the others, one space apart. Windows are judged on the input. NULL has no words;
    texts shorter than a window lose none. Rows without doc_id are left as they are and compared
    with none; rows that repeat a document get equal results. Different texts under one doc_id are
    compared with those of other doc_ids only.
    """
    rows = S.marked(docs)
    spans = S.repeated_spans(rows, _cutter(window, gram), _meeter(window), PIECE, within=False)
    return rows.join(spans, ["doc_id", "mark"], "left").mapInArrow(
        _keep, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string"
    )
