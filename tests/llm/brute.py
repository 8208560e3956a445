"""Plain versions of the operators, one document or pair at a time."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import xxhash


def sha(data):
    return hashlib.sha256(data).hexdigest()


def passages(docs, window=50):
    """{doc_id: (n_words, n_removed, kept_sha256)} for op2."""
    words = {k: (t or "").encode().split() for k, t in docs.items()}
    first = {}
    for k in sorted(words):
        for i in range(len(words[k]) - window + 1):
            first.setdefault(tuple(words[k][i : i + window]), k)
    out = {}
    for k, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < k:
                gone[i : i + window] = [True] * window
        out[k] = (len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def repeated_bytes(docs, window=100):
    """{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)} for op8."""
    data = {k: (t or "").encode() for k, t in docs.items()}
    first = {}
    for k in sorted(data):
        for i in range(len(data[k]) - window + 1):
            first.setdefault(data[k][i : i + window], (k, i))
    out = {}
    for k, b in data.items():
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - window + 1):
            if first[b[i : i + window]] != (k, i):
                gone[i : i + window] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out[k] = (len(b), int(gone.sum()), spans, sha(np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return out


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints, distance=3):
    """{id: smallest id reachable} among {id: fingerprint}."""
    group = {k: k for k in prints}

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = root(a), root(b)
                group[max(x, y)] = min(x, y)
    return {k: root(k) for k in ids}


def tokens(docs, tokenizer, end=2):
    """[(doc_id, start, n_tokens, ids_crc32)] for op10."""
    out, start = [], 0
    for k in sorted(docs):
        ids = tokenizer.encode(docs[k] or "", add_special_tokens=False).ids + [end]
        out.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


def damaged_turns(rows):
    """{conv_id: [(turn, role, text)]} of op11, in order."""
    out = {}
    for conv, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        fault = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 1:
            text = ""
        if fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fault == 4:
            role = "user"
        out.setdefault(conv, []).extend([(turn, role, text)] * {0: 0, 3: 2}.get(fault, 1))
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    return {k: sorted(v, key=order) for k, v in out.items()}


def turn_faults(rows):
    """The first fault of each row: blank, duplicate, truncated or None."""
    seen, out = set(), []
    for _, role, text in rows:
        end = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        out.append("blank" if not end else "duplicate" if (role, text) in seen else None if end in ".!?" else "truncated")
        seen.add((role, text))
    return out


def _role_edits(state, role, fault):
    """(letter, cost, state after, role or None) for a row; states: '', 's', 'u', 'a'."""
    yield "D", 2, state, None
    if fault in ("blank", "duplicate"):
        return
    more = 5 if fault else 0
    want, name = ("a", "assistant") if state == "u" else ("u", "user")
    if role[:1] == want or (role[:1] == "s" and not state):
        yield "K", more, role[:1], role
    yield "R", 1 + more, want, name


def all_repairs(rows, most=4):
    """(cost, audit, repaired) of every way to repair a few rows with up to `most` inserted turns."""
    faults = turn_faults(rows)

    def walk(i, state, left):
        if i == len(rows) and state in ("", "a"):
            yield 0, "", ()
        if left:
            own = ("a", "assistant") if state == "u" else ("u", "user")
            for cost, audit, lines in walk(i, own[0], left - 1):
                yield cost + 5, "I" + audit, (f"{own[1]}:", *lines)
        if i < len(rows):
            _, role, text = rows[i]
            for letter, more, after, name in _role_edits(state, role, faults[i]):
                for cost, audit, lines in walk(i + 1, after, left):
                    yield cost + more, letter + audit, ((f"{name}:{text}",) if name is not None else ()) + lines

    return walk(0, "", most)


def repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired) of one conversation."""
    faults = turn_faults(rows)
    best = {"": (0, "", ())}

    def inserted():
        for _ in range(2):
            for state, (cost, audit, lines) in list(best.items()):
                own = ("a", "assistant") if state == "u" else ("u", "user")
                found = (cost + 5, audit + "I", (*lines, f"{own[1]}:"))
                best[own[0]] = min(best.get(own[0], found), found)

    for (_, role, text), fault in zip(rows, faults):
        inserted()
        new = {}
        for state, (cost, audit, lines) in best.items():
            for letter, more, after, name in _role_edits(state, role, fault):
                found = (cost + more, audit + letter, (*lines, f"{name}:{text}") if name is not None else lines)
                new[after] = min(new.get(after, found), found)
        best = new
    inserted()
    cost, audit, lines = min(best[s] for s in ("", "a") if s in best)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, "\n".join(lines)


def aligned(texts, a_of, b_of):
    """[(n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)] of op13, from functions
    that give the (id, bytes) of a text's tokens."""
    links, groups = [], []
    for text in texts:
        a, b = (a_of(text), b_of(text)) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            a = b = []

        def ranges(tokens):
            at, out = 0, []
            for i, piece in tokens:
                out.append((i, at, at + len(piece)))
                at += len(piece)
            return out

        a, b = ranges(a), ranges(b)
        own, first = [], 0
        for i, begin, end in a:
            while first < len(b) and b[first][2] <= begin:
                first += 1
            own += [(i, j) for j, x, y in b[first : first + end - begin + 1] if x < end and y > begin]
        links.append(own)
        both = sorted({e for _, _, e in a} & {e for _, _, e in b})
        parts = []
        sides = [iter(a), iter(b)]
        for cut in both:
            ids = []
            for side in sides:
                held = []
                for i, _, end in side:
                    held.append(str(i))
                    if end == cut:
                        break
                ids.append(",".join(held))
            parts.append("|".join(ids))
        groups.append((len(a), len(b), len(parts), sha(";".join(parts).encode()) if parts else ""))
    counts = Counter(pair for own in links for pair in own)
    most = {}
    for (_, j), n in counts.items():
        most[j] = max(most.get(j, 0), n)
    return [
        (na, nb, ng, len(own), sum(counts[p] == most[p[1]] for p in own), sum(counts[p] for p in own), digest)
        for own, (na, nb, ng, digest) in zip(links, groups)
    ]
