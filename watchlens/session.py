"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

_WORKING: list[str] = []

#: Streams' state lies on executors' disks, in an amount of memory that does not grow with it. Rows are not counted
#: on the way, which would look each one up before it is put.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "1000",
    # All of a join's state in one store a partition, not four that share the memory.
    "spark.sql.streaming.join.stateFormatVersion": "3",
}

#: Settings every deployment wants; sizes and parallelism stay with the cluster.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    **STATE_CONF,
}


def build_session(
    app_name: str = "watchlens",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session with the engine settings; `conf` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started in here keep their state by `STATE_CONF`, whoever made the session; what it sets itself holds.

    Spark's own default keeps all state in the executors' heaps. A session that names another store is left as it is.
    """
    other = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) not in (None, ROCKSDB_PROVIDER)
    left_open = [key for key in STATE_CONF if not other and spark.conf.get(key, None) is None]
    for key in left_open:
        spark.conf.set(key, STATE_CONF[key])
    try:
        yield
    finally:
        for key in left_open:
            spark.conf.unset(key)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the cluster's shared folder, `spark.checkpoint.dir`.

    Only a local master may fall back to a temporary folder: on a cluster the
    executors would each see their own.
    """
    base = _WORKING[-1] if _WORKING else spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="watchlens-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def working_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for all that is written along the way; it is removed at the end.

    Results read from it on demand, so write or collect them before it closes.
    """
    folder = shared_folder(spark, "work")
    _WORKING.append(folder)
    try:
        yield folder
    finally:
        _WORKING.remove(folder)
        remove_folder(spark, folder)


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder of any file system that Spark writes to; tells whether it was there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def sub_folders(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers n of the folders `name=n` in a folder."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in files.listStatus(place)] if files.exists(place) else []
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{name}="))


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder once and read it from there.

    For intermediate tables that a query reads several times and that are much
    smaller than what they come from. Lost executors cost no recomputation.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
