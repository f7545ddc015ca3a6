"""Sharding by rendezvous hashing.

Every record key scores every shard, and the shard with the best score takes it: the
score of shard s is the -ln(u) / weight of a number u in (0, 1) hashed from key and
shard, and the smallest wins. A shard's chance is its weight's share, and adding a
shard moves only the keys that it wins itself.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchlens.llm.text import pieces_of
from watchlens.session import materialize

#: Rows that one task numbers, about.
ROWS_PER_TASK = 50_000


def equal_weights(count: int) -> dict[int, float]:
    return {shard: 1.0 for shard in range(count)}


def rendezvous(key: Sequence[Column], weights: Mapping[int, float]) -> Column:
    """The shard of a key. Null parts of a key count as one value of their own."""
    heavy = {shard: weight for shard, weight in weights.items() if weight > 0}
    if not heavy:
        raise ValueError("no shard has a weight above zero")
    shards = F.array(*[F.struct(F.lit(s).alias("id"), F.lit(float(w)).alias("weight")) for s, w in sorted(heavy.items())])
    known = F.xxhash64(*[part for column in key for part in (column.isNull(), column)])

    def score(shard: Column) -> Column:
        unit = (F.shiftrightunsigned(F.xxhash64(known, shard["id"]), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
        return F.struct((-F.log(unit) / shard["weight"]).alias("score"), shard["id"].alias("id"))

    return F.array_min(F.transform(shards, score))["id"]


def numbered(rows: DataFrame, shard: str, columns: Sequence[str], name: str, count: int) -> DataFrame:
    """Number the rows of each shard from 0 without a gap, in an order that only the rows decide.

    Equal rows are counted before they are shuffled, so one key with many rows is one row
    here. Each shard is cut into buckets by a hash of the row; a bucket's numbers start
    where the buckets before it end. `count` is the number of rows, about.
    """
    buckets = pieces_of(count, ROWS_PER_TASK)
    equal = rows.groupBy(shard, *columns).agg(F.count(F.lit(1)).alias("__copies"))
    equal = equal.withColumn("__bucket", F.pmod(F.xxhash64(*columns), F.lit(buckets)))
    so_far = (Window.unboundedPreceding, Window.currentRow)
    within = Window.partitionBy(shard, "__bucket").orderBy(*columns).rowsBetween(*so_far)
    before = Window.partitionBy(shard).orderBy("__bucket").rowsBetween(*so_far)
    starts = (
        equal.groupBy(shard, "__bucket")
        .agg(F.sum("__copies").alias("__rows"))
        .select(shard, "__bucket", (F.sum("__rows").over(before) - F.col("__rows")).alias("__start"))
    )
    return (
        equal.withColumn("__place", F.sum("__copies").over(within) - F.col("__copies"))
        .join(starts, [shard, "__bucket"])
        .withColumn("__copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__copies") - 1)))
        .withColumn(name, F.col("__start") + F.col("__place") + F.col("__copy"))
        .drop("__bucket", "__copies", "__place", "__start", "__copy")
    )


def shard_rows(docs: DataFrame, weights: Mapping[int, float], grown: Mapping[int, float] | None = None) -> DataFrame:
    """Every document's size, checksum, shard and slot; with `grown`, also its shard under those weights.

    Rows with a null id are one key. A null text has no bytes; its checksum is that of the
    empty text. An empty table gives no rows. Other columns are ignored, whatever their names.
    """
    data = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    key = [F.col("doc_id")]
    small = materialize(
        docs.select(
            "doc_id",
            (F.length(data) + 8).cast("long").alias("size"),
            F.crc32(data).alias("text_crc32"),
            rendezvous(key, weights).cast("int").alias("shard"),
            (rendezvous(key, grown) if grown else F.lit(None)).cast("int").alias("grown_shard"),
        ),
        "shards",
    )
    return numbered(small, "shard", ("doc_id", "size", "text_crc32", "grown_shard"), "slot", small.count())
