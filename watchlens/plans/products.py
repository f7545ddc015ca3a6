"""Scores as products of sparse rows with a square matrix over a catalogue, best few a row.

For scores of the form "sum over the items of a row of weight times matrix[item, candidate]". The join form
shuffles every row times every candidate to keep ten of them. Here rows stay where they are: the matrix is added
up in blocks, checked to be small, and sent to the rows, and each task multiplies a block of rows at a time and
keeps the best of each. Numpy works on Arrow batches inside the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Largest catalogue whose square matrix is sent to all tasks: 2048 x 2048 doubles are 32 MB.
LARGEST_CATALOGUE = 2048
#: Rows that a task multiplies together.
BLOCK_ROWS = 1024


def catalogue(df: DataFrame, item: str, largest: int | None = None) -> list | None:
    """The distinct items in order, or None where there are more than `largest`."""
    largest = LARGEST_CATALOGUE if largest is None else largest
    found = [r[0] for r in df.select(item).where(F.col(item).isNotNull()).distinct().limit(largest + 1).collect()]
    return sorted(found) if len(found) <= largest else None


def rows_of(df: DataFrame, row: str | list[str], item: str, weight: str | None = None) -> DataFrame:
    """One line a row: `items` and `weights` (1 each without a weight). A row is bounded by the catalogue."""
    keys = [row] if isinstance(row, str) else row
    value = F.col(weight).cast("double") if weight else F.lit(1.0)
    listed = df.where(F.col(item).isNotNull()).groupBy(*keys).agg(F.collect_list(F.struct(F.col(item).alias("i"), value.alias("w"))).alias("l"))
    return listed.select(*keys, F.col("l")["i"].alias("items"), F.col("l")["w"].alias("weights"))


def _helpers() -> tuple:
    """Functions that tasks use; defined in here, they travel with what is sent to them."""

    def dense(items: pa.ListArray, weights: pa.ListArray, place: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """A block of rows as a dense matrix over the catalogue, and which items they hold."""
        import pyarrow.compute as pc

        rows = np.repeat(np.arange(len(items)), pc.list_value_length(items).to_numpy(zero_copy_only=False))
        flat = pc.index_in(items.flatten(), place).to_numpy(zero_copy_only=False).astype(np.int64)
        block, held = np.zeros((len(items), len(place))), np.zeros((len(items), len(place)), bool)
        block[rows, flat] = weights.flatten().to_numpy(zero_copy_only=False)
        held[rows, flat] = True
        return block, held

    def blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                yield batch.slice(start, size)

    def unit(block: np.ndarray) -> np.ndarray:
        return block / np.sqrt(np.maximum((block * block).sum(axis=1, keepdims=True), 1e-300))

    return dense, blocks, unit


def gram(rows: DataFrame, items: list, by_norm: bool = False) -> np.ndarray:
    """The sum over rows of the outer product of a row with itself (divided by its norm), with a zero diagonal.

    Every task adds up its own rows; partial matrices meet by matrix row, so that no task holds more than a few rows of each.
    """
    size, block_rows = len(items), BLOCK_ROWS
    dense, blocks, unit = _helpers()

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, total = pa.array(items), np.zeros((size, size))
        for batch in blocks(batches, block_rows):
            block, _ = dense(batch.column(0), batch.column(1), place)
            total += block.T @ (unit(block) if by_norm else block)
        filled = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(filled, pa.int32()), pa.array(list(total[filled]), pa.list_(pa.float64()))], names=["row", "line"]
        )

    def add(table: pa.Table) -> pa.Table:
        lines = np.array(table.column("line").to_pylist())
        return pa.table({"row": table.column("row")[:1], "line": pa.array([lines.sum(axis=0)], pa.list_(pa.float64()))})

    kinds = "row int, line array<double>"
    total = np.zeros((size, size))
    for r in rows.select("items", "weights").mapInArrow(part, kinds).groupBy("row").applyInArrow(add, kinds).collect():
        total[r.row] = r.line
    np.fill_diagonal(total, 0.0)
    return total


def best_products(
    rows: DataFrame, row: str, matrix: np.ndarray, items: list, k: int, digits: int, by_norm: bool = False, spread: bool = False
) -> DataFrame:
    """The `k` items of highest score of every row that are not in it: (row, item, score, rank).

    Scores above 0 count. With `by_norm` a row is divided by its norm first, with `spread` its scores are
    stretched to 0..1 over all its candidates. Equal scores, at `digits` decimals, go by item.
    """
    if matrix.shape[0] > LARGEST_CATALOGUE:
        raise ValueError("the catalogue is too large to be sent to every task")
    kind, item_kind = rows.schema[row].dataType.simpleString(), rows.schema["items"].dataType.elementType.simpleString()
    sent, block_rows = rows.sparkSession.sparkContext.broadcast((matrix, items)), BLOCK_ROWS
    dense, blocks, unit = _helpers()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square, names = sent.value
        place = pa.array(names)
        for batch in blocks(batches, block_rows):
            block, known = dense(batch.column(1), batch.column(2), place)
            scores = (unit(block) if by_norm else block) @ square
            open_ = (scores > 0) & ~known
            if spread:
                low = np.where(open_, scores, np.inf).min(axis=1, keepdims=True, initial=np.inf)
                high = np.where(open_, scores, -np.inf).max(axis=1, keepdims=True, initial=-np.inf)
                width = high - low
                with np.errstate(invalid="ignore", divide="ignore"):
                    scores = np.where(width > 0, (scores - low) / width, 1.0)
            order = np.argsort(np.where(open_, -np.round(scores, digits), np.inf), axis=1, kind="stable")[:, :k]
            at = np.arange(len(block))[:, None]
            chosen = open_[at, order]
            which, rank = np.nonzero(chosen)
            found = order[chosen]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(which)), place.take(pa.array(found)), pa.array(scores[which, found]), pa.array(rank + 1, pa.int32())],
                names=[row, "item", "score", "rank"],
            )

    return rows.select(row, "items", "weights").mapInArrow(run, f"{row} {kind}, item {item_kind}, score double, rank int")


def best_by_factors(rows: DataFrame, row: str, factors: np.ndarray, items: list, k: int) -> DataFrame:
    """The `k` items whose factors give the highest product with a row's, of those that it does not hold: (row, item, score, rank).

    `rows` have `features` and `items`; line n of `factors` is item n's. Equal scores go by the order of `items`.
    """
    if len(items) > LARGEST_CATALOGUE:
        raise ValueError("the catalogue is too large to be sent to every task")
    kind, item_kind = rows.schema[row].dataType.simpleString(), rows.schema["items"].dataType.elementType.simpleString()
    sent, block_rows = rows.sparkSession.sparkContext.broadcast((factors, items)), BLOCK_ROWS
    _, blocks, _ = _helpers()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        lines, names = sent.value
        place = pa.array(names)
        for batch in blocks(batches, block_rows):
            features = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            scores = features @ lines.T
            held = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False))
            open_ = np.ones(scores.shape, bool)
            open_[held, pc.index_in(batch.column(2).flatten(), place).to_numpy(zero_copy_only=False).astype(np.int64)] = False
            order = np.argsort(np.where(open_, -scores, np.inf), axis=1, kind="stable")[:, :k]
            chosen = open_[np.arange(batch.num_rows)[:, None], order]
            which, rank = np.nonzero(chosen)
            found = order[chosen]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(which)), place.take(pa.array(found)), pa.array(scores[which, found].astype(float)), pa.array(rank + 1, pa.int32())],
                names=[row, "item", "score", "rank"],
            )

    return rows.select(row, "features", "items").mapInArrow(run, f"{row} {kind}, item {item_kind}, score double, rank int")
