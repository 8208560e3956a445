"""Alignment of two tokenizers (op13) against a plain version."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import brute
from daybook.llm import token_alignment as A
from daybook.llm.queries import QUERIES

PATHS = tuple(public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
SAMPLES = [
    None, "", " ", "a", "  two  spaces ", "plain text", "\n\n\t tabs", "naïve café 漢字 😀 ​x", "<|endoftext|> <s> </s> <unk>",
    "▁", "a▁b", "\x00 zero", "<0x41> bytes <0xZZ>", "é" * 300, "a" * 1000, " " * 700, "12345678901234567890",
    "e\u0301 combining", "\ufeffmark", "ﬁ ligature ½", "\u00a0nbsp\u3000wide", "don't we'll I'm",
]


@pytest.fixture(scope="module")
def plain():
    """Tokens of a text as (id, bytes), by the libraries' own ways."""
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])

    def a_of(text):
        found = a.encode(" " + text, add_special_tokens=False)
        letters = A.byte_letters()
        return [(i, bytes(letters[c] for c in t)) for i, t in zip(found.ids, found.tokens)]

    def b_of(text):
        pieces = b.encode(text, out_type=str)
        ids = b.encode(text)
        return [
            (i, bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in zip(ids, pieces)
        ]

    return a_of, b_of


def test_whole_table(spark, sf_dir, table_docs, plain):
    got = QUERIES["op13_token_alignment"](spark, sf_dir).collect()
    want = brute.aligned(list(table_docs.values()), *plain)
    assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in got} == dict(zip(table_docs, want))
    assert sum(w[0] > 0 for w in want) > 150


@pytest.mark.parametrize("work, chunk", [(1 << 16, 1 << 21), (7, 50), (1, 1)])
def test_odd_texts_in_pieces(spark, docs_of, plain, work, chunk):
    rng = random.Random(work)
    texts = SAMPLES + ["".join(rng.choice("ab é漢.\n▁<0x>") for _ in range(rng.randrange(60))) for _ in range(40)]
    texts += texts[5:9]
    rows = [(None if i == 3 else i % 60, t) for i, t in enumerate(texts)]
    found, counts = A.aligned(docs_of(rows), *PATHS, work=work, chunk=chunk)
    got = Counter((r.doc_id, *(r[c] for c in COLUMNS)) for r in found.collect())
    assert got == Counter((k, *w) for (k, _), w in zip(rows, brute.aligned(texts, *plain)))
    assert found.schema == spark.createDataFrame([], found.schema).schema and counts.count() > 0


def test_long_text_and_empty_table(docs_of, plain):
    text = " ".join(random.Random(1).choice(["the", "cat", "naïve", "12", "xyzzy"]) for _ in range(60_000))
    found, _ = A.aligned(docs_of([(1, text), (2, "short")]), *PATHS)
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in found.collect()}
    assert got == dict(zip((1, 2), brute.aligned([text, "short"], *plain)))
    assert A.aligned(docs_of([]), *PATHS)[0].count() == 0


def test_pieces_have_equal_work():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n, m = rng.integers(1, 60, 2)
        a, b = (np.cumsum(rng.integers(1, 4, k)) for k in (n, m))
        path = sorted([(x, 0) for x in a.tolist()] + [(x, 1) for x in b.tolist()])
        work = int(rng.integers(1, 20))
        want = [sum(side == 0 for _, side in path[:d]) for d in [*range(0, n + m, work), n + m]]
        assert A.cuts(a, b, work).tolist() == want


def test_vocabularies_are_whole():
    both = A.tokenizers(*PATHS)
    assert len(both.a_bytes) == 50_257 and len(both.b_bytes) == 32_000
    assert {t for t in both.a_bytes if len(t) == 1} == {bytes([i]) for i in range(256)}


def test_ranks_give_the_same_ids(table_docs):
    """For all texts of known characters, and, by the library itself, for others."""
    both = A.tokenizers(*PATHS)
    assert both.ranks is not None
    plain = lambda text: both.a.encode(text, add_special_tokens=False).ids
    rng = random.Random(11)
    letters = [*map(chr, range(0x20, 0x7F)), *map(chr, range(0xA0, 0x250)), *"\t\n\r   \n", *"''sdtmrvel", *"0123", *"²½"]
    for _ in range(20_000):
        text = " " + "".join(rng.choices(letters, k=rng.randrange(40)))
        assert not A.UNSURE.search(text)
        assert both.a_ids(text) == plain(text), repr(text)
    # Letters as in words, where merges compete.
    for _ in range(20_000):
        text = " " + "".join(rng.choices("etaoinshrdlucmfwypvbgkéèüß' ", k=rng.randrange(60)))
        assert both.a_ids(text) == plain(text), repr(text)
    for text in [*SAMPLES[1:], *filter(None, table_docs.values()), "x" * 5000, " " * 5000]:
        assert both.a_ids(" " + text) == plain(" " + text)
    # Another kind of tokenizer is left to its library.
    other = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert A.ranked(other, []) is None
