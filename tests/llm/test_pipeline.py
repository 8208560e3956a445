"""The pipeline stage by stage against plain versions, and whole."""

from collections import Counter

import brute
import corpus_pipeline
from daybook.llm import decontamination, mixing, quality
from test_sharding import check_law


def test_stages(spark, sf_dir):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, labels = docs.columns, spark.read.parquet(f"{sf_dir}/labels.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())

    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality"](spark, docs, sf_dir)
    predicted = {r.doc_id for r in quality.scores(docs, labels.select("doc_id", "quality")).collect() if r.predicted}
    assert set(ids(good)) == predicted and good.columns == columns

    one = stages["near_duplicates"](spark, good, sf_dir)
    texts = {r.doc_id: r.text for r in good.collect()}
    groups = brute.linked({k: brute.fingerprint(t) for k, t in texts.items()})
    assert ids(one) == sorted(k for k, g in groups.items() if k == g) and one.columns == columns

    clean = stages["decontamination"](spark, one, sf_dir)
    found = {r.doc_id for r in decontamination.find(one, benchmark).collect() if r.contaminated}
    assert ids(clean) == sorted(set(ids(one)) - found) and clean.columns == columns

    mixed = stages["mixing"](spark, clean, sf_dir)
    taken = Counter({r.doc_id: r.copies for r in mixing.copies(clean).collect() if r.copies})
    assert Counter(ids(mixed)) == taken and mixed.columns == columns

    sharded = stages["sharding"](spark, mixed, sf_dir)
    rows = sharded.collect()
    check_law(rows)
    assert Counter(r.doc_id for r in rows) == taken and set(columns) <= set(sharded.columns)
    assert all(r.text == texts[r.doc_id] for r in rows)


def test_whole_run(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    check_law(rows)
    assert rows


def test_empty_documents(spark, sf_dir, docs_of):
    docs = docs_of([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0


def test_odd_rows_go_through(spark, sf_dir, docs_of):
    docs = docs_of([(None, None), (1, ""), (1, ""), (2, None), (3, "A plain line of text. And one more.", None)])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    check_law(docs.collect() or [], 8) if docs.count() else None
