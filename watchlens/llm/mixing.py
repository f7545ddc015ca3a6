"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Every source's words are laid on lines (one per shard of the source, in seeded order) that
are cut into blocks of equal size. The whole mix is a number of blocks. They are seats: the
sources win them by the highest quotients target / 1, / 3, / 5 ..., and a source's shards
win the source's seats in the same way. A shard with more seats than blocks takes every
block as often as they fill it, and a seeded choice of its blocks once more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchlens.llm.text import word_count
from watchlens.session import materialize

#: Words in a block, words in a shard of a source (about), times that a word may be taken.
BLOCK_WORDS, SHARD_WORDS, MOST_REPEATS = 64, 2_000_000, 3
#: Multipliers of the block choice; as primes over every block number, each deals all blocks once.
MULTIPLIERS = (1610612741, 1879048201, 2013265921, 2113929217, 1811939329, 1711276033, 1224736769, 2130706433)


def weigh(sources: DataFrame, weights: Sequence[float] = (1, 2, 3)) -> DataFrame:
    """Give sources the repeating `weights` by code point order, null last; one row a source."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    repeating = F.array(*[F.lit(float(w)) for w in weights])
    return sources.withColumn("weight", F.get(repeating, F.pmod(place, F.lit(len(weights))).cast("int")))


def targets(sources: DataFrame, share: float = 1.0) -> DataFrame:
    """Add `target`: `share` of all sizes dealt by weight, no source above its cap.

    What a capped source cannot hold goes to the others by weight, until none is above.
    With sources in the order in which they reach their caps, the level of the rest rises
    up to the last capped one and falls after it, so its highest value is the level.
    One row a source runs through one task here.
    """
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    left = F.lit(share) * F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    capped = sources.withColumn("cap", F.col("source_size") * MOST_REPEATS).withColumn("__level", left / weight)
    level = F.max("__level").over(whole)
    return capped.withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight") * level)).drop("cap", "__level")


def apportion(parties: DataFrame, within: Sequence[str], party: Sequence[str], votes: str, seats: str, name: str) -> DataFrame:
    """Add `name`: the seats that a party wins by Sainte-Laguë among the parties of `within`.

    A first count rounds each party's share. It is off by at most half a seat a party, so the
    highest quotients are looked for only among the few seats next to it. Equal quotients go
    to the parties first in order. `parties` has one row a party.
    """
    group = Window.partitionBy(*[F.col(c) for c in within], F.lit(0))
    total, number = F.sum(votes).over(group), F.count(F.lit(1)).over(group)
    share = F.when(total > 0, F.col(votes) / total).otherwise(F.lit(0.0))
    counted = parties.withColumn("__share", share).withColumn("__first", F.floor(F.col("__share") * F.col(seats) + 0.5))
    counted = counted.withColumn(
        "__missing", F.when(total > 0, F.col(seats) - F.sum("__first").over(group)).otherwise(F.lit(0))
    ).withColumn("__reach", F.ceil(F.col("__share") * number / 2) + 1)
    low = F.greatest(F.col("__first") - F.col("__reach"), F.lit(0).cast("long"))
    more = F.sequence(F.col("__first"), F.col("__first") + F.col("__reach"))
    fewer = F.sequence(low, F.col("__first") - 1)
    near = F.when(F.col("__missing") > 0, more).when((F.col("__missing") < 0) & (F.col("__first") > 0), fewer)
    each = counted.withColumn("__seat", F.explode_outer(near))
    quotient = F.col(votes) / (2 * F.col("__seat") + 1)
    sign = F.signum(F.col("__missing").cast("double"))
    ties = [F.col(c).asc_nulls_last() for c in party]
    place = F.row_number().over(
        Window.partitionBy(*[F.col(c) for c in within], F.lit(0)).orderBy(
            F.col("__seat").isNull(), quotient * -sign, *ties
        )
    )
    won = F.when(F.col("__seat").isNotNull() & (place <= F.abs("__missing")), sign).otherwise(F.lit(0.0))
    return (
        each.withColumn("__won", won)
        .groupBy(*parties.columns)
        .agg((F.first("__first") + F.sum("__won")).cast("long").alias(name))
    )


def _sized(docs: DataFrame) -> DataFrame:
    """Equal (source, id, size) rows counted into one, so that no key is larger than a row."""
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return materialize(rows.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("copies")), "mix-sizes")


def _lines(sized: DataFrame, weights: Sequence[float], seed: int, share: float) -> DataFrame:
    """Every counted row with its source's figures, its place on a shard's line and the shard's seats."""
    sources = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    sources = targets(weigh(sources, weights), share)
    total = F.sum("target").over(Window.partitionBy(F.lit(0)))
    sources = sources.withColumn("__all", F.round(total / BLOCK_WORDS).cast("long"))
    sources = apportion(sources, (), ("source",), "target", "__all", "source_blocks").drop("__all")
    sources = sources.withColumn("shards", F.ceil(F.greatest(F.col("source_size"), F.lit(1)) / SHARD_WORDS))
    sources = materialize(sources, "mix-sources").withColumnRenamed("source", "__source")
    here = sized["source"].eqNullSafe(F.col("__source"))
    # Rows without words hold no place; they are kept out of the shuffles below.
    placed = sized.join(sources, here).drop("__source")
    placed = placed.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size"), F.col("shards")))
    sizes = placed.groupBy("source", "shard", "source_blocks").agg(F.sum(F.col("size") * F.col("copies")).alias("line"))
    quotas = apportion(sizes, ("source",), ("shard",), "line", "source_blocks", "quota")
    quotas = quotas.withColumn("blocks", F.ceil(F.col("line") / BLOCK_WORDS))
    quotas = quotas.withColumn("quota", F.least(F.col("quota"), F.col("blocks") * MOST_REPEATS)).drop("source_blocks")
    quotas = quotas.withColumnsRenamed({"source": "__source", "shard": "__shard"})
    order = (
        Window.partitionBy("source", "shard")
        .orderBy(F.xxhash64(F.lit(seed + 1), "doc_id", "size"), "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    taken = F.col("size") * F.col("copies")
    placed = placed.withColumn("start", F.sum(taken).over(order) - taken)
    same = placed["source"].eqNullSafe(F.col("__source")) & (placed["shard"] == F.col("__shard"))
    return placed.join(quotas, same).drop("__source", "__shard")


def _taken(seed: int) -> tuple[dict[str, Column], Column]:
    """Columns to add, and with them the words of [start, start + size) that the shard takes, repeats counted."""
    blocks = F.greatest(F.col("blocks"), F.lit(1))
    every, rest = F.floor(F.col("quota") / blocks), F.pmod(F.col("quota"), blocks)
    pick = F.xxhash64(F.lit(seed + 2), "source", "shard")
    multiplier = F.get(
        F.array(*[F.lit(m).cast("long") for m in MULTIPLIERS]), F.pmod(pick, F.lit(len(MULTIPLIERS))).cast("int")
    )
    shift = F.pmod(F.shiftrightunsigned(pick, 8), blocks)
    end = F.col("start") + F.col("size")

    def overlap(block: Column) -> Column:
        words = F.least(end, (block + 1) * BLOCK_WORDS) - F.greatest(F.col("start"), block * BLOCK_WORDS)
        chosen = F.pmod(block * F.col("__multiplier") + F.col("__shift"), F.col("__blocks")) < F.col("__rest")
        return F.when(chosen, words).otherwise(F.lit(0)).cast("long")

    of = F.sequence(F.floor(F.col("start") / BLOCK_WORDS), F.floor((end - 1) / BLOCK_WORDS))
    once_more = F.aggregate(of, F.lit(0).cast("long"), lambda sum_, block: sum_ + overlap(block))
    parts = {"__every": every, "__rest": rest, "__multiplier": multiplier, "__shift": shift, "__blocks": blocks}
    return parts, F.when(F.col("size") > 0, F.col("size") * F.col("__every") + once_more).otherwise(F.lit(0)).cast("long")


def mix(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), seed: int = 7, share: float = 1.0) -> DataFrame:
    """How many words of every document the mix takes.

    One row a document: doc_id, source, size, source_size, target, taken. Rows with a null
    source form a source, null and empty texts have size 0 and give nothing, equal rows keep
    their number, an empty table gives no rows; other columns play no part. The same rows
    give the same result, however they are partitioned.
    """
    lines = _lines(_sized(docs), weights, seed, share)
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    each = lines.withColumn("__copy", copy).withColumn("start", F.col("start") + F.col("__copy") * F.col("size"))
    parts, taken = _taken(seed)
    return each.withColumns(parts).withColumn("taken", taken).select(
        "doc_id", "source", "size", "source_size", "target", "taken"
    )


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), seed: int = 7, share: float = 1.0) -> DataFrame:
    """The mix as whole documents: every document as often (0 to 3 times) as the mix takes it.

    A source's target over its size is how often its documents are taken on average. Along a
    shard's documents in order of size, the running sum of that rate is cut at whole numbers,
    so that a shard's words differ from its part of the target by one document at most.
    Documents without words stay once. Columns and rows are otherwise those of `docs`.
    """
    lines = _lines(_sized(docs), weights, seed, share)
    rate = F.when(F.col("line") > 0, F.least(F.col("quota") * BLOCK_WORDS / F.col("line"), F.lit(float(MOST_REPEATS))))
    by_size = Window.partitionBy("source", "shard").orderBy("size", F.xxhash64(F.lit(seed + 1), "doc_id"), "doc_id")
    run = F.sum(F.col("rate") * F.col("copies")).over(by_size.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    lines = lines.where("size > 0").withColumn("rate", F.coalesce(rate, F.lit(0.0))).withColumn("run", run)
    begin = F.col("run") - F.col("rate") * F.col("copies")
    lines = lines.withColumn("begin", begin + 0.5).select(
        F.col("source").alias("__source"), F.col("doc_id").alias("__id"), F.col("size").alias("__size"), "rate", "begin"
    )
    # The n-th of equal rows takes the n-th stretch of the running sum. One hash deals out both
    # sides, so that the texts are shuffled once; the columns themselves decide the match.
    key = ("doc_id", "source", "__words")
    # The documents' columns travel as one, so that their names meet no others.
    whole = F.struct(*[F.col(name) for name in docs.columns]).alias("__row")
    counted = docs.select(whole, "doc_id", "source", word_count(F.col("text")).alias("__words")).withColumn("__key", F.xxhash64(*key))
    nth = Window.partitionBy("__key", *key).orderBy(F.lit(0))
    counted = counted.repartition("__key").withColumn("__nth", F.row_number().over(nth) - 1)
    lines = lines.withColumn("__line_key", F.xxhash64("__id", "__source", "__size"))
    same = (
        F.col("source").eqNullSafe(F.col("__source"))
        & F.col("doc_id").eqNullSafe(F.col("__id"))
        & (F.col("__words") == F.col("__size"))
    )
    matches = (F.col("__key") == F.col("__line_key")) & F.when(same, True).otherwise(False)
    joined = counted.join(lines, matches, "left")
    at = F.col("begin") + F.col("rate") * F.col("__nth")
    times = F.when(F.col("__words") == 0, F.lit(1)).otherwise(F.floor(at + F.col("rate")) - F.floor(at))
    whole = F.least(times, F.lit(MOST_REPEATS)).cast("int")
    return (
        joined.withColumn("__times", whole)
        .where("__times > 0")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times"))))
        .select(*[F.col("__row").getField(name).alias(name) for name in docs.columns])
    )
