"""Mixing sources to target weights by repetition rates.

Two passes over the texts, no shuffle of them: the first adds up words per source, the second
repeats each document. Only one row per source is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from daybook.llm.frames import stored, word_count

MOST = 3.0  # a source is repeated so often at most
WEIGHTS = 3  # weights 1 to 3, by turns in the order of the sources' names


def targets(sizes: DataFrame, most: float = MOST, weights: int = WEIGHTS) -> DataFrame:
    """(source, source_size, weight, target) from rows of (source, size).

    All sizes together are shared out by weight. A target stops at `most` times its source's
    size; what is over goes to the others by weight, until none is above. Sources are taken by
    what they can hold per weight: as long as they fill up, the share per weight rises from one
    to the next, and from the first that does not fill up on it never rises again, so the
    largest share per weight is the final one. NULL is a source of its own, the last by name.
    An empty source has target 0.
    """
    summed = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = summed.withColumn("weight", (turn % weights + 1).cast("int")).withColumn(
        "__room", most * F.col("source_size") / F.col("weight")
    )
    filling = Window.orderBy("__room", F.col("source").asc_nulls_last())
    ahead = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    share = (
        F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(ahead), F.lit(0))
    ) / F.sum("weight").over(onward)
    return (
        weighed.withColumn("__share", share)
        .withColumn("__share", F.max("__share").over(everything))
        .select(
            "source",
            "source_size",
            "weight",
            F.least(most * F.col("source_size"), F.col("weight") * F.col("__share")).alias("target"),
        )
    )


def chance(key: Column, seed: int) -> Column:
    """A number from 0 to below 1 that depends on the key and the seed alone."""
    digits = F.md5(F.concat(key, F.lit(f"/{seed}")).cast("binary"))
    return F.conv(F.substring(digits, 1, 12), 16, 10).cast("double") / float(2**48)


def copies(docs: DataFrame, most: float = MOST, weights: int = WEIGHTS, seed: int = 7) -> DataFrame:
    """`docs` with size, source_size, target and copies; such columns of `docs` give way.

    A document of a source with rate r is copied floor(r) times, and once more with the chance
    r - floor(r), drawn from its doc_id (its text where that is NULL), so reruns agree and
    repeated rows fare alike. A NULL text has size 0.
    """
    sized = docs.withColumn("size", word_count(F.col("text")))
    plan = stored(targets(sized.select("source", "size"), most, weights).drop("weight"), "targets")
    plan = plan.withColumnRenamed("source", "__source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    key = F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit(""))
    extra = (chance(key, seed) < F.col("__rate") - F.floor("__rate")).cast("int")
    kept = [c for c in sized.columns if c not in ("source_size", "target", "copies")]
    return (
        sized.select(*kept)
        .join(plan, F.col("source").eqNullSafe(F.col("__source")), "left")
        .withColumn("__rate", rate)
        .withColumn("copies", (F.floor("__rate") + extra).cast("int"))
        .drop("__source", "__rate")
    )


def mix(docs: DataFrame, most: float = MOST, weights: int = WEIGHTS, seed: int = 7) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it, with the columns they came with."""
    own = docs.withColumn("__row", F.struct(*docs.columns)).select("doc_id", "text", "source", "__row")
    again = F.explode(F.array_repeat(F.lit(0), F.col("copies")))
    return copies(own, most, weights, seed).select("__row", again.alias("__copy")).select("__row.*")
