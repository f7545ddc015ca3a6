"""Ordered calculations per key as a distributed prefix scan.

A plain window over `partitionBy(user).orderBy(time)` puts each user into one
task. Here rows are dealt by ranges of (key, order), so that a key of any size is cut wherever
its share ends, within an hour or a second too. Every task scans its own
stretch once; what a stretch hands on to the next one is one small row for each border.
Results equal those of the plain window.

The input is read once and shuffled once (apart from the sample that Spark takes to choose the ranges),
and the scanned rows are written to the shared folder, from where the borders and the result are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watchlens.functions.times import micros_between
from watchlens.session import materialize

_PLACED, _PART, _HEAD, _TAIL, _NUMBER = "__placed", "__part", "__head", "__tail", "__number"
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _all_equal(left: Column, right: Column, names: list[str]) -> Column:
    return reduce(and_, [left[name].eqNullSafe(right[name]) for name in names])


def scanned(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    previous: dict[str, Column],
    running: dict[str, Column],
    gap_micros: int | None = None,
) -> DataFrame:
    """Rows with what can be said inside their own range: the scan's one exchange and one pass.

    `__head` is 2 in the first row of a range, 1 in further rows of the range's first key, else 0. `__tail`,
    in the last row only, holds that row's `previous` values for the range after it.
    """
    placed = reduce(and_, [F.col(name).isNotNull() for name in (*keys, order[0])])
    values = {f"__own_{name}": value for name, value in previous.items()}
    sums = {}
    for name, value in running.items():
        kind = "bigint" if isinstance(df.select(value.alias("v")).schema["v"].dataType, _INTEGRAL) else "double"
        sums[f"__in_{name}"] = F.coalesce(value.cast(kind), F.lit(0).cast(kind))
    wide = df.withColumns({_PLACED: placed, **values, **sums})
    place = [_PLACED, *keys, *order]
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = wide.repartitionByRange(ranges, *place).sortWithinPartitions(*place)

    columns, tails, totals, group = df.columns, list(values), list(sums), [_PLACED, *keys]
    lagged = [f"__previous_{name}" for name in previous]
    time = order[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last: dict | None = None  # the row before, with its totals
        head, held = True, None

        def finish(held: tuple, end: bool) -> pa.RecordBatch:
            names, arrays, own = held
            count = len(arrays[0])
            at_end = np.zeros(count, bool)
            at_end[-1] = end
            fields = [pa.nulls(1, pa.bool_()).take(pa.array(np.zeros(count, np.int64))), *own]
            tail = pa.StructArray.from_arrays(fields, names=["__", *tails], mask=pa.array(~at_end))
            return pa.RecordBatch.from_arrays([*arrays, tail], names=[*names, _TAIL])

        for batch in batches:
            count = batch.num_rows
            if not count:
                continue
            if held is not None:
                yield finish(held, False)
            column = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            fresh = np.zeros(count, bool)
            for name in group:
                codes = column[name].dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
                fresh[1:] |= codes[1:] != codes[:-1]
                fresh[0] |= last is None or column[name][0].as_py() != last[name]
            opens = fresh.copy()
            if last is None:
                opens[0] = False
            heads = np.zeros(count, np.int8)
            if head:
                until = int(np.argmax(opens)) if opens.any() else count
                heads[:until] = 1
                head = until == count
                if last is None:
                    heads[0] = 2
            rows = np.arange(count)
            begin = np.maximum.accumulate(np.where(fresh, rows, -1))  # where the row's key begins; -1: before this batch

            def add_up(value: np.ndarray, so_far: float) -> np.ndarray:
                upto = np.cumsum(value)
                return upto - np.where(begin >= 0, upto[begin] - value[begin], -so_far)

            added = {name: add_up(column[name].to_numpy(zero_copy_only=False), last[name] if last else 0) for name in totals}
            before = {}
            indexes = pa.array(rows, mask=fresh)
            for name, value in zip(lagged, tails, strict=True):
                first = pa.array([last[value]], column[value].type) if last else pa.nulls(1, column[value].type)
                before[name] = pa.concat_arrays([first, column[value]]).take(indexes)
            if gap_micros is not None:
                moment = column[time].cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
                pause = np.diff(moment, prepend=last["__moment"] if last else 0)
                added[_NUMBER] = add_up((fresh | (pause >= gap_micros)).astype(np.int64), last[_NUMBER] if last else 0)
            names = [*columns, _PLACED, *lagged, *added, _PART, _HEAD]
            arrays = [column[name] for name in (*columns, _PLACED)] + [*before.values()] + [pa.array(v) for v in added.values()]
            held = names, [*arrays, pa.array(np.full(count, part, np.int32)), pa.array(heads)], [column[name] for name in tails]
            last = {name: column[name][-1].as_py() for name in (*group, *tails)} | {name: v[-1].item() for name, v in added.items()}
            if gap_micros is not None:
                last["__moment"] = int(moment[-1])
        if held is not None:
            yield finish(held, True)

    schema = T.StructType(
        [T.StructField(f.name, f.dataType) for f in df.schema]
        + [T.StructField(_PLACED, T.BooleanType())]
        + [T.StructField(name, wide.schema[value].dataType) for name, value in zip(lagged, tails, strict=True)]
        + [T.StructField(name, wide.schema[name].dataType) for name in totals]
        + ([T.StructField(_NUMBER, T.LongType())] if gap_micros is not None else [])
        + [T.StructField(_PART, T.IntegerType()), T.StructField(_HEAD, T.ByteType())]
        + [T.StructField(_TAIL, T.StructType([T.StructField("__", T.BooleanType())] + [T.StructField(v, wide.schema[v].dataType) for v in tails]))]
    )
    return ranged.mapInArrow(run, schema)


def _carries(table: DataFrame, keys: list[str], time: str, totals: list[str], gap_micros: int | None) -> DataFrame:
    """What each range takes over from those before it, where its first key goes on from there.

    At most two rows a range come into this, and there are as many ranges as shuffle partitions.
    """
    numbered = [_NUMBER] if gap_micros is not None else []
    group = [_PLACED, *keys]
    border = F.struct(*group, F.col(time).alias("__moment"), *totals, *numbered, _TAIL)
    ends = table.where((F.col(_HEAD) == 2) | F.col(_TAIL).isNotNull()).groupBy(_PART).agg(
        F.first(F.when(F.col(_HEAD) == 2, border), ignorenulls=True).alias("first"),
        F.first(F.when(F.col(_TAIL).isNotNull(), border), ignorenulls=True).alias("last"),
    )
    row = Window.orderBy(_PART)
    ends = ends.withColumn("before", F.lag("last").over(row))
    goes_on = F.coalesce(_all_equal(F.col("before"), F.col("first"), group), F.lit(False))
    ends = ends.withColumn("goes_on", goes_on)
    if numbered:
        pause = micros_between(F.col("before.__moment"), F.col("first.__moment"))
        merges = F.when(F.col("goes_on") & (pause < gap_micros), 1).otherwise(0)
        ends = ends.withColumn("merges", merges)
    # All ranges that end with one key follow each other.
    chain = Window.partitionBy(*[F.col(f"last.{name}") for name in group]).orderBy(_PART)
    ends = ends.withColumns({f"__out_{name}": F.sum(F.col(f"last.{name}")).over(chain) for name in totals})
    if numbered:
        whole = _all_equal(F.col("first"), F.col("last"), group)
        own = F.col(f"last.{_NUMBER}") - F.when(whole, F.col("merges")).otherwise(0)
        ends = ends.withColumn("__out", F.sum(own).over(chain))
    taken = [F.lag(f"__out_{name}").over(row).alias(f"__before_{name}") for name in totals]
    if numbered:
        taken.append((F.lag("__out").over(row) - F.col("merges")).alias("__before"))
    carried = ends.select(_PART, "goes_on", F.col(f"before.{_TAIL}").alias("__carried"), *taken)
    return carried.where("goes_on").drop("goes_on")


def along_time(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    previous: dict[str, Column] | None = None,
    running: dict[str, Column] | None = None,
    gap: tuple[str, int] | None = None,
) -> DataFrame:
    """Add, per key and in `order`, values of the row before, running totals and a numbering by pauses.

    `order` starts with a timestamp and must order the rows of a key totally.
    `previous` maps a new column to the expression whose value in the row before
    is wanted (NULL in the first row of a key); `running` maps a new column to
    the expression to add up, the current row included (whole numbers as bigint, others as double). `gap` names
    a new column that counts from 1 and goes up wherever the pause since the row before reaches so many
    microseconds. Rows with a NULL key or time have no place in an order: they stay, with NULL in the
    new columns. Select the columns you need first: the rows are written once.
    """
    previous, running = previous or {}, running or {}
    gap_micros = gap[1] if gap else None
    table = materialize(scanned(df, keys, order, previous, running, gap_micros), "ordered")
    totals = [f"__in_{name}" for name in running]
    carries = _carries(table, keys, order[0], totals, gap_micros)
    # One row a range at most.
    joined = table.join(F.broadcast(carries), _PART, "left")
    in_head, first = F.col(_HEAD) >= 1, F.col(_HEAD) == 2

    def known(value: Column) -> Column:
        return F.when(F.col(_PLACED), value)

    def carried_on(own: str, before: str) -> Column:
        return F.col(own) + F.when(in_head, F.coalesce(F.col(before), F.lit(0))).otherwise(F.lit(0))

    return joined.select(
        *[F.col(name) for name in df.columns],
        *[
            known(F.when(first, F.col(f"__carried.__own_{name}")).otherwise(F.col(f"__previous_{name}"))).alias(name)
            for name in previous
        ],
        *[known(carried_on(f"__in_{name}", f"__before___in_{name}")).alias(name) for name in running],
        *([known(carried_on(_NUMBER, "__before")).alias(gap[0])] if gap else []),
    )
