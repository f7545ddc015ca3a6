"""The nearest users of every user, without a list of pairs.

Users whose sets of contents are alike have alike minimum hashes. In each of several bands, with a hash function
each, users are sorted by their few smallest hashes, so that alike users stand near each other however many share a hash; every user is
then compared, exactly, with those in the same and the next cell of that order. A cell has a fixed size, so that the work grows
with the users and not with their pairs, and no popular content makes a large group. What this may miss is a near user who stands
far off in every band; the tests and the README say how often that is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from watchlens.plans.products import rows_of
from watchlens.session import materialize

BANDS, CELL_ROWS = 12, 256
#: Hashes that a band's order goes by, and rows of a band's order that a task compares.
ORDER_HASHES, TASK_ROWS = 4, 50_000
#: Cells of a dense block of two cells of users by their contents: 2^23 doubles are 64 MB.
BLOCK_CELLS = 1 << 23


def nearest_users(matrix: DataFrame, n: int = 10, bands: int = BANDS, cell: int = CELL_ROWS) -> DataFrame:
    """(user_id, neighbour, similarity, rank): up to `n` users of highest cosine similarity of interaction weights.

    Users who share no content are no neighbours; equal similarities, at nine decimals, go by the neighbour's id. Exact where all users
    fit a cell. `matrix` has one row for each user and content.
    """
    users = materialize(rows_of(matrix.where(F.col("user_id").isNotNull()), "user_id", "content_id", "weight"), "profiles")
    hashes = F.transform("items", lambda item: F.xxhash64(item, F.col("band")))
    placed = users.withColumn("band", F.explode(F.sequence(F.lit(1), F.lit(bands))))
    placed = placed.withColumn("near", F.slice(F.sort_array(hashes), 1, ORDER_HASHES))
    parts = max(1, -(-users.count() * bands // TASK_ROWS))
    ordered = placed.repartitionByRange(parts, "band", "near", "user_id").sortWithinPartitions("band", "near", "user_id")
    kind, most, block_cells = matrix.schema["user_id"].dataType.simpleString(), n, BLOCK_CELLS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        def products(block: pa.RecordBatch) -> np.ndarray:
            """Cosines of all users of a block."""
            items, weights = block.column(2), block.column(3).flatten().to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(len(items)), pc.list_value_length(items).to_numpy(zero_copy_only=False))
            codes = items.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False)
            norm = np.sqrt(np.bincount(rows, weights * weights, len(items)))
            total, width = np.zeros((len(items), len(items))), max(1, block_cells // len(items))
            for start in range(0, int(codes.max(initial=-1)) + 1, width):
                here = (codes >= start) & (codes < start + width)
                dense = np.zeros((len(items), min(width, int(codes.max()) + 1 - start)))
                dense[rows[here], codes[here] - start] = weights[here]
                total += dense @ dense.T
            total /= np.maximum(norm[:, None] * norm[None, :], 1e-300)
            np.fill_diagonal(total, 0.0)
            return total

        def best(block: pa.RecordBatch) -> pa.RecordBatch:
            found = products(block)
            ids = block.column(1)
            place = np.empty(len(ids), np.int64)
            place[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))  # ranks of the ids, for ties
            order = np.argsort(place)
            chosen = order[np.argsort(-np.round(found[:, order], 9), axis=1, kind="stable")[:, :most]]
            which, column = np.nonzero(np.take_along_axis(found, chosen, axis=1) > 0)
            there = chosen[which, column]
            return pa.RecordBatch.from_arrays(
                [ids.take(pa.array(which)), ids.take(pa.array(there)), pa.array(found[which, there])], names=["user_id", "neighbour", "similarity"]
            )

        def cells() -> Iterator[pa.RecordBatch]:
            """Stretches of one band, of `cell` rows, the last one shorter."""
            held: list[pa.RecordBatch] = []

            def cut(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                table = pa.Table.from_batches(rows).combine_chunks()
                for start in range(0, table.num_rows, cell):
                    yield table.slice(start, cell).combine_chunks().to_batches()[0]

            for batch in batches:
                band = batch.column(0).to_numpy()
                borders = [0, *(np.flatnonzero(band[1:] != band[:-1]) + 1).tolist(), batch.num_rows]
                for begin, end in zip(borders[:-1], borders[1:], strict=True):
                    part = batch.slice(begin, end - begin)
                    if held and held[-1].column(0)[0] != part.column(0)[0]:
                        yield from cut(held)
                        held = []
                    held.append(part)
                    if sum(rows.num_rows for rows in held) >= 64 * cell:
                        *whole, last = cut(held)
                        yield from whole
                        held = [last]
            if held:
                yield from cut(held)

        before = None
        for one in cells():
            if before is not None and before.column(0)[0] == one.column(0)[0]:
                both = pa.Table.from_batches([before, one]).combine_chunks().to_batches()[0]
                yield best(both)
            else:
                yield best(one)
            before = one

    near = ordered.select("band", "user_id", "items", "weights").mapInArrow(
        run, f"user_id {kind}, neighbour {kind}, similarity double"
    )
    # At most as many rows a user as bands times twice n.
    found = near.groupBy("user_id", "neighbour").agg(F.max("similarity").alias("similarity"))
    order = Window.partitionBy("user_id").orderBy(F.desc(F.round("similarity", 9)), "neighbour")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
