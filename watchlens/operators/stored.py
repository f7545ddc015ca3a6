"""Stored tables in versions, with atomic upsert, append and delete.

A table is a folder of entries. An entry holds the rows that one write put into one hash bucket of the key, and is never
changed. Every version lists the entries that make it up, with their row counts and key ranges; beside each
entry lie Bloom filters of its keys. A write adds entries and a new list, and counts from when the number of
the list is added to `versions`, in one small file: readers see all of a write or nothing of it, and a write that broke
off is overwritten by the next. Only entries that may hold a key of the write, by range and filter, are read; upsert and
delete write those anew, all others are taken over as they are.

One writer at a time; any number of readers. Plain Parquet, on any file system that Spark writes to.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watchlens.operators import tables
from watchlens.session import materialize, remove_folder, sub_folders

#: A filter is cut into chunks of so many bits, each for so many keys of an entry; a key sets `HASHES` bits of one chunk.
CHUNK_BITS, CHUNK_KEYS, HASHES = 32768, 2000, 6
BUCKETS = 64
_ENTRY, _BUCKET = "__entry", "__bucket"


class Version(NamedTuple):
    number: int
    key: list[str]
    buckets: int
    schema: T.StructType


def current(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """The newest version of a stored table, or the one with this number."""
    versions = spark.read.parquet(f"{path}/versions")
    if number is not None:
        versions = versions.where(F.col("number") == number)
    last = versions.orderBy(F.desc("number")).first()
    if last is None:
        raise ValueError(f"{path} has no version {number}")
    return Version(last["number"], list(last["key"]), last["buckets"], T._parse_datatype_json_string(last["schema"]))


def entries(spark: SparkSession, path: str, version: Version) -> DataFrame:
    """The entries of a version: `__entry`, `__bucket`, `rows`, key range `low` to `high`, filter `chunks`."""
    return spark.read.parquet(f"{path}/lists/{version.number}")


def create(df: DataFrame, path: str, key: list[str], buckets: int = BUCKETS) -> None:
    """Store a table whose keys are unique. `buckets` is kept with the table; `split_buckets` raises it later."""
    version = Version(0, key, buckets, T.StructType([T.StructField(f.name, f.dataType) for f in df.schema]))
    _write(df.sparkSession, path, version, df, None)


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The rows of the newest version, or of an earlier one that `vacuum` has left."""
    version = current(spark, path, number)
    return _rows_of(spark, path, version, entries(spark, path, version))


def upsert(spark: SparkSession, path: str, source: DataFrame, order: list[str] | None = None, keep: tuple[str, ...] = ()) -> None:
    """Put rows in, or over those of their key. With `order` the last source row of a key wins; NULL is a key like others.

    Columns in `keep` stay as they are in rows that exist already. Repeating it changes no row.
    """
    version = current(spark, path)
    latest = tables.last_per_key(source, version.key, order) if order else source
    incoming = materialize(latest.select(version.schema.names), "incoming")
    _rewrite(spark, path, version, incoming, lambda old: tables.upsert(old, incoming, version.key, keep=keep))


def delete(spark: SparkSession, path: str, keys: DataFrame) -> None:
    """Take out the rows with these keys; keys that are not there do no harm."""
    version = current(spark, path)
    gone = materialize(keys.select(version.key).distinct(), "deleted-keys")
    _rewrite(spark, path, version, gone, lambda old: _without(old, gone, version.key))


def append_new(spark: SparkSession, path: str, source: DataFrame, order: list[str] | None = None) -> int:
    """Add the source rows whose key is not stored yet, each key once, the first in `order`; gives the rows added.

    Stored keys are read exactly, but only in entries that may hold one of the source's.
    """
    version = current(spark, path)
    first = source.dropDuplicates(version.key)
    if order:
        first = source.groupBy(version.key).agg(F.min_by(F.struct(source.columns), F.struct(order)).alias("r")).select("r.*")
    incoming = materialize(first.select(version.schema.names), "incoming")
    hit = may_hold(spark, path, version, incoming)
    fresh = _without(incoming, _rows_of(spark, path, version, hit).select(version.key), version.key)
    return _write(spark, path, version._replace(number=version.number + 1), fresh, entries(spark, path, version))


def split_buckets(spark: SparkSession, path: str, factor: int = 2) -> None:
    """Cut every bucket into `factor` ones, for a table that has outgrown its buckets."""
    version = current(spark, path)
    _write(spark, path, version._replace(number=version.number + 1, buckets=version.buckets * factor), read(spark, path), None)


def compact(spark: SparkSession, path: str, most: int = 4) -> None:
    """Bring buckets of more than `most` entries back to one entry each; rows stay the same."""
    version = current(spark, path)
    listed = entries(spark, path, version)
    crowded = listed.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select(_BUCKET)
    many = materialize(listed.join(crowded, _BUCKET, "left_semi"), "crowded")
    if many.isEmpty():
        return
    rest = listed.join(many.select(_ENTRY, _BUCKET), [_ENTRY, _BUCKET], "left_anti")
    _write(spark, path, version._replace(number=version.number + 1), _rows_of(spark, path, version, many), rest)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete the entries that none of the newest `keep` versions lists; gives their number. Older versions are gone then."""
    numbers = [r.number for r in spark.read.parquet(f"{path}/versions").select("number").orderBy("number").collect()]
    stay, old = numbers[-keep:], numbers[:-keep]
    live = {(r[_ENTRY], r[_BUCKET]) for n in stay for r in spark.read.parquet(f"{path}/lists/{n}").select(_ENTRY, _BUCKET).collect()}
    gone = 0
    for number in sub_folders(spark, f"{path}/rows", _ENTRY):
        for bucket in sub_folders(spark, f"{path}/rows/{_ENTRY}={number}", _BUCKET):
            if number <= numbers[-1] and (number, bucket) not in live:
                for kind in ("rows", "filters"):
                    remove_folder(spark, f"{path}/{kind}/{_ENTRY}={number}/{_BUCKET}={bucket}")
                gone += 1
    for number in old:
        remove_folder(spark, f"{path}/lists/{number}")
    return gone


def may_hold(spark: SparkSession, path: str, version: Version, keys: DataFrame) -> DataFrame:
    """The entries that may hold one of these keys: those whose range and filter do not exclude it.

    No key that is stored is missed. Of an entry's filter only the chunks that keys fall into meet them.
    """
    listed = entries(spark, path, version)
    wanted = keys.select(F.struct(version.key).alias("k"), *_hashes(version)).distinct()
    in_range = (F.col("k") >= F.col("low")) & (F.col("k") <= F.col("high"))
    near = wanted.join(listed, _BUCKET).where(in_range)
    near = near.select(_ENTRY, _BUCKET, F.pmod("h", F.col("chunks")).alias("chunk"), "bits").distinct()
    near = materialize(near, "keys-and-entries")
    folders = _folders(near.select(_ENTRY, _BUCKET).distinct(), f"{path}/filters")
    if not folders:
        return listed.where(F.lit(False))
    filters = spark.read.option("basePath", f"{path}/filters").parquet(*folders)

    def is_set(bit: Column) -> Column:
        byte = F.substring(F.col("filter"), (bit / 8).cast("int") + 1, F.lit(1))
        number = F.conv(F.hex(byte), 16, 10).cast("int")
        return F.call_function("shiftright", number, (bit % 8).cast("int")).bitwiseAND(1) == 1

    hit = near.join(filters, [_ENTRY, _BUCKET, "chunk"]).where(F.forall("bits", is_set)).select(_ENTRY, _BUCKET).distinct()
    return materialize(listed.join(hit, [_ENTRY, _BUCKET], "left_semi"), "entries-hit")


def _hashes(version: Version) -> list[Column]:
    key = [F.col(name) for name in version.key]
    bits = [F.pmod(F.xxhash64(*key, F.lit(k)), F.lit(CHUNK_BITS)).cast("int") for k in range(HASHES)]
    return [
        F.pmod(F.xxhash64(*key), F.lit(version.buckets)).cast("int").alias(_BUCKET),
        F.xxhash64(*key, F.lit(-1)).alias("h"),
        F.array(*bits).alias("bits"),
    ]


def _without(rows: DataFrame, keys: DataFrame, key: list[str]) -> DataFrame:
    there = keys.select([F.col(name).alias(f"__gone_{name}") for name in key])
    same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"__gone_{name}")) for name in key])
    return rows.join(there, same, "left_anti")


def _folders(listed: DataFrame, root: str) -> list[str]:
    """Folders of entries: as many as entries, which are a few for each bucket (see `compact`)."""
    return [f"{root}/{_ENTRY}={r[_ENTRY]}/{_BUCKET}={r[_BUCKET]}" for r in listed.select(_ENTRY, _BUCKET).collect()]


def _rows_of(spark: SparkSession, path: str, version: Version, listed: DataFrame) -> DataFrame:
    folders = _folders(listed, f"{path}/rows")
    if not folders:
        return spark.createDataFrame([], version.schema)
    return spark.read.schema(version.schema).option("basePath", f"{path}/rows").parquet(*folders).select(version.schema.names)


def _rewrite(spark: SparkSession, path: str, version: Version, keys: DataFrame, change: Callable[[DataFrame], DataFrame]) -> None:
    hit = may_hold(spark, path, version, keys)
    rest = entries(spark, path, version).join(hit.select(_ENTRY, _BUCKET), [_ENTRY, _BUCKET], "left_anti")
    _write(spark, path, version._replace(number=version.number + 1), change(_rows_of(spark, path, version, hit)), rest)


def _write(spark: SparkSession, path: str, version: Version, rows: DataFrame, rest: DataFrame | None) -> int:
    """Write rows as new entries, list them with the entries of `rest`, and make that the current version."""
    number, written = version.number, f"{path}/rows/{_ENTRY}={version.number}"
    bucketed = rows.select(version.schema.names).withColumn(_BUCKET, _hashes(version)[0])
    bucketed.hint("rebalance", _BUCKET).write.mode("overwrite").partitionBy(_BUCKET).parquet(written)
    stored = spark.read.schema(T.StructType([*version.schema, T.StructField(_BUCKET, T.IntegerType())])).parquet(written)
    new = stored.groupBy(_BUCKET).agg(
        F.count(F.lit(1)).alias("rows"), F.min(F.struct(version.key)).alias("low"), F.max(F.struct(version.key)).alias("high")
    )
    chunks = F.ceil(F.col("rows") / CHUNK_KEYS).cast("long").alias("chunks")
    new = materialize(new.select(F.lit(number).cast("long").alias(_ENTRY), _BUCKET, "rows", "low", "high", chunks), "new-entries")
    keyed = stored.select(*_hashes(version)).join(new.select(_BUCKET, "chunks"), _BUCKET)
    bits = keyed.select(_BUCKET, F.pmod("h", F.col("chunks")).alias("chunk"), F.explode("bits").alias("bit"))
    # Positions in a bitmap count from 0, as those of bits here.
    filters = bits.groupBy(_BUCKET, "chunk").agg(F.bitmap_construct_agg(F.col("bit").cast("long")).alias("filter"))
    filters.hint("rebalance", _BUCKET).write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{path}/filters/{_ENTRY}={number}")
    listed = new if rest is None else rest.select(new.columns).unionByName(new)
    listed.coalesce(1).write.mode("overwrite").parquet(f"{path}/lists/{number}")
    _point(spark, path, version)
    return new.agg(F.sum("rows")).first()[0] or 0


def _point(spark: SparkSession, path: str, version: Version) -> None:
    row = [(version.number, version.key, version.buckets, version.schema.json())]
    pointer = spark.createDataFrame(row, "number long, key array<string>, buckets int, schema string")
    pointer.coalesce(1).write.mode("append").parquet(f"{path}/versions")
