"""One query per operator, over its whole table: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from daybook import storage
from daybook.llm import (
    conversations,
    decontamination,
    mixing,
    near_duplicates,
    projected_search,
    quality,
    repeated_bytes,
    sharding,
    substring_dedup,
    token_alignment,
    token_files,
    vector_search,
    warc,
)
from daybook.llm.frames import stored, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op5_balanced_shards(spark, sf_dir):
    rows = sharding.assigned(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    return rows.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@query
def op6_source_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    counted = mixing.copies(docs)
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return counted.select("doc_id", "size", "source_size", "target", taken)


@query
def op7_revisit_archives(spark, sf_dir):
    return warc.deduplicated(table(spark, sf_dir, "pages")).select(
        "page_id",
        "payload_bytes",
        # Recomputed digests of read payloads must agree with the headers.
        F.when(F.col("sound"), F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


@query
def op9_benchmark_passages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find(docs, table(spark, sf_dir, "benchmark"))
    listed = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        "contaminated",
    )


@query
def op10_token_ids(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = storage.scratch(spark, "token_ids")
    token_files.write_ids(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.token_index(spark, path)


@query
def op3_simhash_groups(spark, sf_dir):
    found = near_duplicates.groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


@query
def op1_maxscore_search(spark, sf_dir):
    vectors = vector_search.integers(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    vectors = stored(vectors, "vectors")
    return vector_search.top(vectors, vectors.where("vec_id % 20 = 0"))


@query
def op2_repeated_passages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.deduplicated(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op8_repeated_bytes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeated_bytes.deduplicated(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op4_quality_scores(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.scores(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))


@query
def op11_conversation_repair(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = conversations.repaired(conversations.damaged(rows))
    return found.withColumn("repaired_sha256", F.sha2("repaired", 256)).drop("repaired")


@query
def op12_projected_neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return projected_search.search(vectors, "vec_id % 100 = 0")


@query
def op13_token_alignment(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    a, b = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return token_alignment.aligned(docs, a, b)[0]
