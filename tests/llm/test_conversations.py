"""Conversation repair (op11) against plain versions."""

import random

import pytest

import brute
from daybook.llm import conversations
from daybook.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string, part int, copies string"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def made_rows(rng, n):
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \n", "Yes. ", None, "é.", "é"]
    roles = ["user", "assistant", "system", "tool", "user", "assistant", "", None, "sys"]
    turns = sorted(rng.choice([None, *range(2 * n)]) or 0 for _ in range(n))
    return [(t if rng.random() < 0.95 else None, rng.choice(roles), rng.choice(texts)) for t in turns]


def test_plain_versions_agree():
    rng = random.Random(3)
    for _ in range(400):
        rows = [("", r or " ", t or " ") for _, r, t in made_rows(rng, rng.randrange(5))]
        rows = [(None, r, t) for _, r, t in rows]
        cost, audit, lines = min(brute.all_repairs(rows))
        assert (cost, audit, "\n".join(lines)) == brute.repair(rows)[-3:]


def test_parser_against_all_ways():
    rng = random.Random(4)
    for _ in range(400):
        rows = [(i, r or " ", t or " ") for i, (_, r, t) in enumerate(made_rows(rng, rng.randrange(12)))]
        got = conversations._whole([conversations.Row(t, r, x, 1, None) for t, r, x in rows])
        assert tuple(got[c] for c in (*COUNTS, "repaired")) == brute.repair(rows)


def want(rows):
    return {k: brute.repair(v) for k, v in brute.damaged_turns(rows).items()}


def got(frame):
    found = conversations.repaired(conversations.damaged(frame)).collect()
    assert len({r.conv_id for r in found}) == len(found)
    return {r.conv_id: tuple(r[c] for c in (*COUNTS, "repaired")) for r in found}


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    found = {r.conv_id: r for r in QUERIES["op11_conversation_repair"](spark, sf_dir).collect()}
    plain = want([(r[0], r[1], r[2], r[3]) for r in rows])
    assert set(found) == set(plain)
    for k, v in plain.items():
        assert tuple(found[k][c] for c in COUNTS) == v[:-1] and found[k].repaired_sha256 == brute.sha(v[-1].encode())


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_made_conversations(spark, parts):
    """Nulls in all columns, repeated rows, one conversation that holds most rows."""
    rng = random.Random(parts)
    rows = []
    for conv in [None, *range(30)]:
        rows += [(conv, *r) for r in made_rows(rng, rng.randrange(9))]
    rows += [(1000, t, rng.choice(["user", "assistant"]), rng.choice(["Same.", f"Turn {t}.", "cut"])) for t in range(900)]
    rows += [(1000, 7, "user", "Again.")] * 200 + rows[:20]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        assert got(frame) == want(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_edges(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == {}
    # Nothing is left of a conversation whose rows are all dropped.
    gone = next((c, 0) for c in range(1000) if brute.damaged_turns([(c, 0, "user", "Hi.")])[c] == [])
    long = " ".join(["word"] * 300_000) + "."
    rows = [(*gone, "user", "Hi."), (5000, 1, "user", long), (5000, (1 << 62), "assistant", long), (5000, -(1 << 62), "user", "x.")]
    found = got(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA))
    assert found == want(rows) and found[gone[0]] == (0, 0, 0, 0, 0, 0, "", "")
