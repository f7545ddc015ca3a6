"""Fill-in-the-middle texts, cut by an indexable skip list.

A text's units are runs of ASCII letters and single other characters. Cuts are given as unit
ranks; an indexable skip list finds where they are. Its lowest lane is the text itself, and every
express lane above has a node for each `STRIDE` nodes of the lane below, with the units,
code points and bytes that it spans. A search walks a lane while the rank is not passed, adds up
the widths, and descends; it ends at the exact code point and byte after a few units of text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchlens.llm.text import bound_batches, texts

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Nodes of a lane that one node of the lane above spans.
STRIDE = 32
#: Bytes of a text that are looked at together while the lowest express lane is built.
STEP_BYTES = 1 << 20
_UNIT = re.compile(rb"[A-Za-z]+|[\x00-\x7f]|[\xc0-\xff][\x80-\xbf]*")


class SkipList:
    """Units of a UTF-8 text by rank. `lanes[0]` is the lowest express lane; rows are units, points, bytes."""

    def __init__(self, data: bytes):
        self.data = data
        nodes, units, points, letter = [], 0, 0, False
        for begin in range(0, len(data), STEP_BYTES):
            part = np.frombuffer(data, np.uint8, min(STEP_BYTES, len(data) - begin), begin)
            is_point = (part & 0xC0) != 0x80
            is_letter = ((part | 32) - 97).astype(np.uint8) < 26
            inside = is_letter.copy()
            inside[1:] &= is_letter[:-1]
            inside[0] &= letter
            letter = bool(is_letter[-1])
            starts = np.flatnonzero(is_point & ~inside)
            chosen = starts[-units % STRIDE :: STRIDE]
            so_far = np.cumsum(is_point)
            ranks = units + np.arange(-units % STRIDE, len(starts), STRIDE)
            nodes.append(np.stack([ranks, points + so_far[chosen] - 1, begin + chosen]))
            units += len(starts)
            points += int(so_far[-1])
        self.total = (units, points, len(data))
        self.lanes: list[np.ndarray] = []
        if units:
            ends = np.array(self.total).reshape(3, 1)
            self.lanes.append(np.diff(np.concatenate([*nodes, ends], axis=1), axis=1))
            while self.lanes[-1].shape[1] > STRIDE:
                below = self.lanes[-1]
                self.lanes.append(np.add.reduceat(below, np.arange(0, below.shape[1], STRIDE), axis=1))

    def __len__(self) -> int:
        return self.total[0]

    def find(self, rank: int) -> tuple[int, int]:
        """Code points and bytes before the unit of this rank; those of the whole text for the number of units."""
        if rank >= self.total[0]:
            return self.total[1:]
        units = points = place = node = 0
        for lane in reversed(self.lanes):
            widths = lane[0]
            while units + widths[node] <= rank:
                units += int(widths[node])
                points += int(lane[1, node])
                place += int(lane[2, node])
                node += 1
            node *= STRIDE
        for _ in range(rank - units):
            unit = _UNIT.match(self.data, place).group()
            points += len(unit) if unit[0] < 0x80 else 1
            place += len(unit)
        return points, place


def draws(doc_id: Column, seed: str = "1") -> Mapping[str, Column]:
    """Four numbers hashed from a document's id: both cuts, and what decides the form. A null id is empty text."""
    digest = F.sha2(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return {f"h{k + 1}": F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)}


def transform(docs: DataFrame, seed: str = "1", fim_percent: int = 90, spm_percent: int = 20) -> DataFrame:
    """doc_id, `n` units, `form` (plain, psm, spm), `prefix_chars`, `middle_chars` and `output` of every document.

    A null text is empty; empty texts and those that hold a marker stay plain, and so have
    no cut. Equal rows stay equal rows, rows with a null id are cut alike, an empty table
    gives no rows, other columns are not read. Bytes that are no UTF-8 count as U+FFFD.
    """
    bound_batches(docs.sparkSession)
    marks = tuple(mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE))

    def one(data: bytes, first: int, second: int, form: str) -> tuple:
        units = SkipList(data)
        n = len(units)
        if not data or form == "plain" or any(mark in data for mark in marks):
            return n, "plain", None, None, data
        low, high = sorted((first % (n + 1), second % (n + 1)))
        (points, a), (more, b) = units.find(low), units.find(high)
        prefix, middle, suffix = data[:a], data[a:b], data[b:]
        head = (marks[0], prefix, marks[1], suffix) if form == "psm" else (marks[1], suffix, marks[0], prefix)
        return n, form, points, more - points, b"".join((*head, marks[2], middle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drawn = [batch.column(name).to_pylist() for name in ("h1", "h2", "form")]
            rows = [one(_valid(data), *draw) for data, *draw in zip(texts(batch), *drawn, strict=True)]
            n, form, prefix, middle, output = zip(*rows, strict=True) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(form, pa.string()),
                    pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()),
                    pa.array(output, pa.binary()),
                ],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    h = draws(F.col("doc_id"), seed)
    form = F.when(h["h3"] % 100 >= fim_percent, "plain").when(h["h4"] % 100 < spm_percent, "spm").otherwise("psm")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), h["h1"].alias("h1"), h["h2"].alias("h2"), form.alias("form"))
    rows = rows.mapInArrow(run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output binary")
    return rows.withColumn("output", F.col("output").cast("string"))


def _valid(data: bytes) -> bytes:
    try:
        if not data.isascii():
            data.decode()
        return data
    except UnicodeDecodeError:
        return data.decode("utf-8", "replace").encode()


def restore(output: Column, form: Column) -> Column:
    """The text that an output of this form was made of."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (
        F.when(form == "psm", F.concat(part[1], part[3], part[2]))
        .when(form == "spm", F.concat(part[2], part[3], part[1]))
        .otherwise(output)
    )
