import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
from brute import rows_of
from daybook.llm import token_files
from daybook.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_whole_table(spark, sf_dir, table_docs, tokenizer):
    assert rows_of(QUERIES["op10_token_ids"](spark, sf_dir)) == brute.tokens(table_docs, tokenizer)


PARTS = ["a", "E", "É", "é", "×", "÷", "'", "'s", "'re", " ", "\n", "\t", ".", ",", "1", "2", "W̊", "»", "İ", "ß", "Σ", "ς"]
PARTS += ["漢", "\xa0", " ", "<|endoftext|>", "<", "!", "\x01", "\x1c", "ﬁ", "Å", "̇", "½", "ª", "-", "_", "the", "of"]


def test_units_give_the_ids_of_the_whole(tokenizer):
    rng = random.Random(9)
    texts = ["", None, " ", "it's IT'S don't", "x" * 5000, "a×b", "1234.5!?"]
    texts += ["".join(rng.choice(PARTS) for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    ids, bounds = token_files.Encoder(PATH)(texts, 2)
    for i, text in enumerate(texts):
        whole = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        assert ids[bounds[i] : bounds[i + 1]].tolist() == whole, repr(text)


def test_a_tokenizer_that_parts_texts_otherwise_encodes_them_whole():
    other = public_tokenizers.path("byte_bpe_50k.json")
    assert token_files.parts_at_units(PATH) and not token_files.parts_at_units(other)
    texts = [None, "", "  two  spaces", "It's\n\nÉcole <|endoftext|> 漢字 12", "x" * 300]
    ids, bounds = token_files.Encoder(other)(texts, 7)
    library = Tokenizer.from_file(other)
    want = [library.encode(t or "", add_special_tokens=False).ids + [7] for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want
    none, edges = token_files.Encoder(other)([], 7)
    assert len(none) == 0 and edges.tolist() == [0]


def test_colliding_hashes_are_told_apart(monkeypatch, tokenizer):
    monkeypatch.setattr(token_files.Powers, "BASE", 1)  # the hash of a unit is then the sum of its bytes
    texts = ["ab ba abc bca cab", "ad bc"]
    ids, bounds = token_files.Encoder(PATH)(texts, 2)
    assert ids.tolist() == [i for t in texts for i in [*tokenizer.encode(t, add_special_tokens=False).ids, 2]]


def test_edges(spark, docs_of, tmp_path, tokenizer):
    rows = {5: None, 3: "", 9: "one two", -4: "THREE", 7: "long " * 50_000}
    path = str(tmp_path / "ids")
    token_files.write_ids(docs_of(list(rows.items())), path, PATH)
    assert rows_of(token_files.token_index(spark, path)) == brute.tokens(rows, tokenizer)
    token_files.write_ids(docs_of([]), path + "0", PATH)
    assert token_files.token_index(spark, path + "0").count() == 0
    token_files.write_ids(docs_of([(None, "a"), (1, "b"), (1, "b")]), path + "1", PATH)
    got = [(r.doc_id, r.start, r.n_tokens) for r in token_files.token_index(spark, path + "1").orderBy("start").collect()]
    assert got == [(None, 0, 2), (1, 2, 2), (1, 4, 2)]


def test_lookups_prune_by_metadata(spark, docs_of, tmp_path):
    path = str(tmp_path / "ids")
    token_files.write_ids(docs_of([(i, f"text {i}") for i in range(3000)]), path, PATH)
    one = token_files.read_ids(spark, path, [77])
    assert one.count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(doc_id, [77])]" in plan or "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,77)]" in plan
    # Files hold ascending ranges of ids.
    ranges = token_files.read_ids(spark, path).groupBy(F.input_file_name().alias("f")).agg(F.min("doc_id"), F.max("doc_id"))
    bounds = sorted(tuple(r)[1:] for r in ranges.collect())
    assert all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))
