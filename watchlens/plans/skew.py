"""Joins that stay balanced on hot keys, without losing a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A key is hot when it holds more than one part in this many of the rows, so
#: there are never more hot keys than this, whatever the data.
HOT_KEY_PARTS = 1000

_SHARD = "__shard"
_SHARDS = "__shards"


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition by keys over the session's shuffle partitions, whatever the size.

    For the input of a join that multiplies rows: judged by its input size, Spark
    would merge such partitions into a few long tasks.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, *keys)


def hot_keys(df: DataFrame, keys: list[str], parts: int = HOT_KEY_PARTS) -> DataFrame:
    """Keys holding over 1/`parts` of the rows, with the shards each should have.

    Counts combine before their shuffle. At most `parts` rows can qualify, which
    is the bound that makes the result safe to broadcast.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    total = df.agg(F.count(F.lit(1)).alias("__total")).scalar()
    share = F.col("__rows") * parts / total
    return counts.where(share > 1).select(*keys, F.ceil(share).cast("int").alias(_SHARDS))


def sharded_join(
    many: DataFrame,
    few: DataFrame,
    keys: list[str],
    spread_by: Column,
    how: str = "inner",
    parts: int = HOT_KEY_PARTS,
) -> DataFrame:
    """Equi-join whose hot keys are split over several tasks.

    Rows of `many` on a hot key are spread by the hash of `spread_by`; the rows
    of `few` on that key are repeated once per shard. Other keys have one shard,
    so nothing changes for them. `how` may be `inner`, `left`, `left_semi` or `left_anti`.
    """
    hot = hot_keys(many, keys, parts)
    shards = F.coalesce(F.col(_SHARDS), F.lit(1))
    # At most `parts` rows, see hot_keys.
    left = many.join(F.broadcast(hot), keys, "left").withColumn(
        _SHARD, F.pmod(F.xxhash64(spread_by), shards).cast("int")
    )
    right = few.join(F.broadcast(hot), keys, "left").withColumn(
        _SHARD, F.explode(F.sequence(F.lit(0), shards - 1))
    )
    place = [*keys, _SHARD]
    return spread(left.drop(_SHARDS), *place).join(spread(right.drop(_SHARDS), *place), place, how).drop(_SHARD)


def group_pairs(
    members: DataFrame,
    group: list[str],
    item: str,
    carry: list[str] | None = None,
    block: int = 1000,
) -> DataFrame:
    """Pairs (`left_item` < `right_item`) of the distinct items of each group.

    `members` holds each (group, item) once, so a group is no larger than the
    item catalogue. Groups over `block` items are cut into blocks of left items,
    each block meeting a copy of the group: no task sees more than about
    `block` left items of one group, and each pair appears once. Aggregate the
    result by pair: the counts combine before they are shuffled.
    """
    carry = carry or []
    size = F.count(F.lit(1)).over(Window.partitionBy(*group))
    sized = members.withColumn(_SHARDS, F.ceil(size / block).cast("int"))
    left = sized.select(
        *group,
        F.pmod(F.xxhash64(item), _SHARDS).cast("int").alias(_SHARD),
        F.col(item).alias(f"left_{item}"),
        *[F.col(name).alias(f"left_{name}") for name in carry],
    )
    right = sized.select(
        *group,
        F.explode(F.sequence(F.lit(0), F.col(_SHARDS) - 1)).alias(_SHARD),
        F.col(item).alias(f"right_{item}"),
        *[F.col(name).alias(f"right_{name}") for name in carry],
    )
    place = [*group, _SHARD]
    pairs = spread(left, *place).join(spread(right, *place), place).where(F.col(f"left_{item}") < F.col(f"right_{item}"))
    return pairs.drop(_SHARD)
