"""Sharding by balanced label propagation.

Rows start in shards of equal counts. Documents linked by an equal text then move, in rounds
until none can, towards the shard that holds most of their links. Quotas keep every move in
balance: the k-th row that wants from shard a to shard b goes only against the k-th row that can
go from b to a, so the counts never change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from daybook.llm.frames import identified, running, stored, text_of

SHARDS = 8


def _start(docs: DataFrame, shards: int) -> DataFrame:
    """Rows with a number of their own, dealt out in turn in an order without meaning."""
    text = text_of().cast("binary")
    rows = docs.select(
        "__file",
        "__place",
        F.xxhash64("doc_id", "text").alias("__mix"),
        F.md5(text).alias("__link"),
        F.crc32(text).alias("text_crc32"),
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 1).alias("size"),
    )
    return running(rows, ["__mix", "__file", "__place"], name="__row").withColumn(
        "shard", (F.col("__row") % shards).cast("int")
    )


def _wishes(rows: DataFrame, shards: int, least: int, turn: int) -> DataFrame:
    """Linked rows with the shard they wish for: (__row, shard, wish, __link, __size). `__size` is
    that of a link that is together, NULL otherwise.

    That is the shard with most rows of the link among those that it does not fill (a shard has
    `least` rows or one more). Ties go by a hash of the link, the shard and the round, so that
    about as many rows wish for either of two shards. Rows of a full shard stay.

    The counts are added up per task first: a link held by a third of all rows is one row per
    task and shard.
    """
    held = rows.groupBy("__link", "shard").agg(F.count("*").alias("__held"))
    # The shard's own size is `least` or one more; a link with `least` of its rows fills it well enough.
    full = F.col("__held") >= max(least, 1)
    order = F.struct("__held", F.xxhash64("__link", "shard", F.lit(turn)), "shard")
    aims = (
        held.groupBy("__link")
        .agg(
            F.max_by("shard", F.when(~full, order)).alias("wish"),
            F.collect_list(F.when(full, F.col("shard"))).alias("__full"),
            F.sum("__held").alias("__all"),
            F.count("*").alias("__parts"),
        )
        .where("__all > 1")
    )
    # Stored, so that nothing but the join rests on the shuffle of the rows, and Spark may split
    # the part of a hot link.
    aims = stored(aims, "aims")
    stays = F.array_contains("__full", F.col("shard")) | F.col("wish").isNull()
    wish = F.when(stays, F.col("shard")).otherwise(F.col("wish")).alias("wish")
    size = F.when((F.col("__parts") == 1) & ~stays, F.col("__all")).alias("__size")
    return rows.join(aims, "__link").select("__row", "shard", wish, "__link", size)


def _swaps(rows: DataFrame, shards: int, least: int, turn: int) -> DataFrame:
    """(__row, to) of the rows that move in a round.

    Movers want to another shard. Any row without links can make room: it is a filler, offered
    to one shard by its number. Links that are together are fillers as a whole, small ones first.
    In each pair of shards the movers of both directions go first, and fillers against what is
    left; equally many go each way.
    """
    wishes = stored(_wishes(rows, shards, least, turn), "wishes")
    none = F.lit(0).cast("bigint").alias("__size"), F.lit("").alias("__unit")
    movers = wishes.where("wish <> shard").select(
        "__row", "shard", F.col("wish").alias("to"), F.lit(0).alias("__late"), *none
    )

    def offered(unit: str):
        by = F.pmod(F.xxhash64(unit, F.lit(turn)), F.lit(shards - 1)).cast("int")
        return ((F.col("shard") + 1 + by) % shards).cast("int").alias("to")

    fillers = rows.join(wishes.select("__row"), "__row", "left_anti").select(
        "__row", "shard", offered("__row"), F.lit(1).alias("__late"), *none
    )
    together = wishes.where("wish = shard and __size is not null").select(
        "__row", "shard", offered("__link"), F.lit(2).alias("__late"), "__size", F.col("__link").alias("__unit")
    )
    rivals = movers.unionByName(fillers).unionByName(together)
    ranked = stored(running(rivals, ["__late", "__size", "__unit", "__row"], ["shard", "to"], name="__rank"), "ranked")
    counts = ranked.groupBy("shard", "to").agg(
        F.count("*").alias("__all"), F.count_if(F.col("__late") == 0).alias("__movers")
    )
    back = counts.select(
        F.col("shard").alias("to"), F.col("to").alias("shard"),
        F.col("__all").alias("__all_back"), F.col("__movers").alias("__movers_back"),
    )
    # As many as both sides have, but fillers go only against movers.
    quota = stored(
        counts.join(back, ["shard", "to"]).select(
            "shard",
            "to",
            F.least("__all", "__all_back", F.greatest("__movers", "__movers_back")).alias("__quota"),
        ),
        "quota",
    )
    # One row per pair of shards, however many documents there are.
    near = ranked.join(F.broadcast(quota), ["shard", "to"])
    # A link of which only a part would go stays, and the pair's quota ends before it. Only the
    # side with fewer movers has fillers below the quota.
    split = (
        near.where("__late = 2")
        .groupBy("shard", "to", "__unit")
        .agg(F.min("__rank").alias("__begin"), F.max("__rank").alias("__last"), F.max("__quota").alias("__quota"))
        .where("__begin < __quota and __last >= __quota")
        .select(F.array_sort(F.array("shard", "to")).alias("__pair"), "__begin")
    )
    ends = split.groupBy("__pair").agg(F.min("__begin").alias("__end"))
    exact = quota.withColumn("__pair", F.array_sort(F.array("shard", "to"))).join(ends, "__pair", "left").select(
        "shard", "to", F.least("__quota", "__end").alias("__quota")
    )
    return ranked.join(F.broadcast(exact), ["shard", "to"]).where("__rank < __quota").select("__row", "to")


def assigned(
    docs: DataFrame, shards: int = SHARDS, rounds: int | None = None, keep: list[str] | None = None
) -> DataFrame:
    """`docs` (doc_id, text and others) with size, text_crc32, law, shard, slot and grown_shard.

    Rounds end when no row moves, or after `rounds`. Each round that moves rows brings links
    closer together (the sum over links of their squared counts per shard grows), so they do end.
    `keep` names the columns of `docs` to carry along (all, if not given).

    The law is `rows`: counts differ by one at most. `slot` numbers the rows of a shard without
    gaps. Equal texts are linked; NULL counts as the empty text. A NULL doc_id and repeated rows
    are rows like others. Columns of `docs` with the names of new ones give way.
    """
    new = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in new]
    # The texts stay where they are until each row's shard is known.
    own = identified(docs.select("doc_id", "text", F.struct(*kept).alias("__own")))
    rows = stored(_start(own, shards), "start")
    placed = rows.select("__row", "__link", "shard")
    least = rows.count() // shards
    done = 0
    while shards > 1 and done != rounds:
        moves = stored(_swaps(placed, shards, least, done), "moves")
        if moves.isEmpty():
            break
        moved = placed.join(moves, "__row", "left")
        placed = stored(moved.select("__row", "__link", F.coalesce("to", "shard").alias("shard")), "shards")
        done += 1
    slots = running(placed.select("__row", "shard"), ["__row"], ["shard"], name="slot")
    found = stored(rows.drop("shard", "__link", "__mix").join(slots, "__row").drop("__row"), "slots")
    return (
        own.select("__own", "__file", "__place")
        .join(found, ["__file", "__place"])
        .select(
            "__own.*",
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            "shard",
            "slot",
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def cut_links(rows: DataFrame) -> DataFrame:
    """One row: links (equal texts) and those that are spread over more shards than one."""
    held = rows.groupBy(F.md5(text_of().cast("binary")).alias("__link")).agg(
        F.count("*").alias("__rows"), F.count_distinct("shard").alias("__shards")
    )
    return held.where("__rows > 1").agg(
        F.count("*").alias("links"), F.coalesce(F.count_if(F.col("__shards") > 1), F.lit(0)).alias("cut")
    )
