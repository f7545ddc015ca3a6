"""Stored tables: creating, checking, evolving, upserting, deleting."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from watchlens.operators.ingest import accepted, first_per_event, not_yet_stored, stored_event
from watchlens.schemas import TABLES, TableSpec

#: Upsert tables are stored in this many hash buckets of their key; an upsert
#: rewrites only the buckets it touches. Fixed for a table once it is written.
BUCKETS = 256
BUCKET = "key_bucket"


def create_tables(spark: SparkSession, names: list[str] | None = None, provider: str = "parquet") -> dict[str, bool]:
    """Create the missing tables in order; tells for each whether it exists now."""
    outcome = {}
    for name in names or TABLES:
        spec = TABLES[name]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.columns)
        layout = f" PARTITIONED BY ({', '.join(spec.partition_by)})" if spec.partition_by else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {provider}{layout}")
        outcome[name] = spark.catalog.tableExists(name)
    return outcome


def verify_tables(spark: SparkSession, names: list[str] | None = None) -> dict[str, dict]:
    """Per table: whether it exists and which columns are missing, extra or of another type.

    `all_tables_exist` sums it up.
    """
    report: dict[str, dict] = {}
    for name in names or TABLES:
        expected = {f.name: f.dataType.simpleString() for f in TABLES[name].columns}
        if not spark.catalog.tableExists(name):
            report[name] = {"exists": False, "missing": list(expected), "extra": [], "type": []}
            continue
        found = dict(spark.table(name).dtypes)
        report[name] = {
            "exists": True,
            "missing": [n for n in expected if n not in found],
            "extra": [n for n in found if n not in expected],
            "type": [n for n in expected if n in found and found[n] != expected[n]],
        }
    report["all_tables_exist"] = all(entry["exists"] for entry in report.values())  # type: ignore[assignment]
    return report


def add_missing_columns(spark: SparkSession, name: str) -> list[str]:
    """Bring a stored table up to its definition by adding columns; safe to repeat."""
    found = spark.table(name).columns
    missing = [f for f in TABLES[name].columns if f.name not in found]
    if missing:
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({added})")
    return [f.name for f in missing]


def with_event_id(events: DataFrame) -> DataFrame:
    """Give rows of a table from before event ids an id made of their content; existing ids stay."""
    content = F.sha2(F.to_json(F.struct(*sorted(c for c in events.columns if c != "event_id"))), 256)
    if "event_id" not in events.columns:
        return events.withColumn("event_id", content)
    return events.withColumn("event_id", F.coalesce("event_id", content))


def fill_defaults(df: DataFrame, spec: TableSpec, now: Column | None = None) -> DataFrame:
    """Rows as the table stores them: defaults for NULLs, time stamps, all columns, cast and in order."""
    now = F.current_timestamp() if now is None else now
    columns = []
    for f in spec.columns:
        value = F.col(f.name) if f.name in df.columns else F.lit(None)
        if f.name in spec.defaults:
            value = F.coalesce(value, F.lit(spec.defaults[f.name]))
        elif f.name in spec.stamped:
            value = F.coalesce(value, now)
        columns.append(value.cast(f.dataType).alias(f.name))
    return df.select(*columns)


def read_table(spark: SparkSession, name: str, **equals: object) -> DataFrame:
    """Rows of a table whose columns equal the given values."""
    df = spark.table(name)
    for column, value in equals.items():
        df = df.where(F.col(column) == F.lit(value))
    return df


def append_events(spark: SparkSession, parsed: DataFrame, name: str = "user_events") -> int:
    """Store the accepted events of a batch that the table does not hold yet; gives the rows written.

    The number comes with the write itself, without a job of its own.
    """
    fresh = not_yet_stored(stored_event(first_per_event(accepted(parsed), ["timestamp_ts", "partition", "offset"])), spark.table(name))
    written = Observation("append_events")
    counted = fresh.observe(written, F.count(F.lit(1)).alias("rows"))
    fill_defaults(counted, TABLES[name]).write.insertInto(name)
    return written.get["rows"]


def last_per_key(source: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key, the last in `order`; also filtered before the shuffle."""
    newest = Window.partitionBy(*key).orderBy(*[F.desc(name) for name in order])
    return source.withColumn("__rank", F.row_number().over(newest)).where(F.col("__rank") == 1).drop("__rank")


def upsert(
    target: DataFrame, source: DataFrame, key: list[str], order: list[str] | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Target rows with those of the source put in or put over them by key.

    With `order`, the last source row of a key wins; without, source keys must be
    unique. NULL in a key is a value like others, so that repeating an upsert adds nothing. Columns in `keep`, such as `created_at`, stay as they are in rows
    that exist already.
    """
    latest = last_per_key(source, key, order) if order else source
    latest = latest.select(*target.columns)
    if keep:
        held = target.select(*key, *[F.col(name).alias(f"__kept_{name}") for name in keep])
        held = held.withColumnsRenamed({name: f"__held_{name}" for name in key})
        same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"__held_{name}")) for name in key])
        latest = latest.join(held, same, "left").select(
            *[F.coalesce(f"__kept_{name}", name).alias(name) if name in keep else F.col(name) for name in target.columns]
        )
    there = latest.select(*[F.col(name).alias(f"__new_{name}") for name in key])
    same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"__new_{name}")) for name in key])
    return target.join(there, same, "left_anti").select(*target.columns).unionByName(latest)


def delete_keys(target: DataFrame, keys: DataFrame, key: list[str]) -> DataFrame:
    """Target rows whose key is not listed."""
    return target.join(keys.select(*key), key, "left_anti").select(*target.columns)


def _bucketed(df: DataFrame, key: list[str]) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int"))


def store_for_upsert(df: DataFrame, path: str, key: list[str]) -> None:
    """Write a table in the layout `upsert_into` keeps up."""
    bucketed = _bucketed(df, key)
    bucketed.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def upsert_into(
    spark: SparkSession, path: str, source: DataFrame, key: list[str], order: list[str] | None = None,
    keep: tuple[str, ...] = (),
) -> None:
    """Upsert into a table written by `store_for_upsert`, reading and rewriting only the buckets it touches.

    Repeating it changes nothing. Plain parquet swaps bucket folders one by one
    when the job commits; where readers or crashes must never see that, keep the
    table in a format with `MERGE` and use `merge_into`.
    """
    stored = spark.read.parquet(path)
    incoming = _bucketed(source, key)
    # No more rows than buckets.
    touched = incoming.select(BUCKET).distinct()
    affected = stored.join(F.broadcast(touched), BUCKET, "left_semi")
    merged = upsert(affected.select(*stored.columns), incoming, key, order, keep)
    (
        merged.hint("rebalance", BUCKET)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET)
        .parquet(path)
    )


def merge_statement(
    table: str, source_view: str, columns: list[str], key: list[str], keep: tuple[str, ...] = ()
) -> str:
    """`MERGE INTO` text of the same upsert, for table formats that support it."""
    match = " AND ".join(f"t.`{c}` = s.`{c}`" for c in key)
    sets = ", ".join(f"t.`{c}` = s.`{c}`" for c in columns if c not in key and c not in keep)
    names = ", ".join(f"`{c}`" for c in columns)
    values = ", ".join(f"s.`{c}`" for c in columns)
    return (
        f"MERGE INTO {table} AS t USING {source_view} AS s ON {match} "
        f"WHEN MATCHED THEN UPDATE SET {sets} WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


def merge_into(
    spark: SparkSession, table: str, source: DataFrame, key: list[str], order: list[str] | None = None,
    keep: tuple[str, ...] = (),
) -> None:
    """Upsert through the table format's own atomic merge."""
    latest = last_per_key(source, key, order) if order else source
    view = f"merge_source_{table.replace('.', '_')}"
    latest = latest.select(*spark.table(table).columns)
    latest.createOrReplaceTempView(view)
    spark.sql(merge_statement(table, view, latest.columns, key, keep))
