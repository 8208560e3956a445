import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A frame of documents from (doc_id, text) or (doc_id, text, source) rows, with more columns
    whose names operators use for their own."""

    def make(rows, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        frame = spark.createDataFrame(full, SCHEMA).repartition(parts)
        return frame.selectExpr("*", "'x' as size", "1 as items", "2 as shard", "3 as copies", "4 as spans", "5 as score", "6 as `odd name`")

    return make


@pytest.fixture(scope="session")
def table_docs(spark, sf_dir):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
