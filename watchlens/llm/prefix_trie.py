"""Trie of conversation prefixes, from ternary search trees over range shards.

A turn (role, text) is known by a digest of 16 bytes; texts are read once and never shuffled.
Equal conversations are counted first; distinct ones are dealt to shards in the order of their turns, so
that a trie node's members stand together and only the nodes on a shard's first and last path can go
on in a neighbour. Each shard numbers its turns, fills a ternary search tree by median insertion, so that every
level is balanced, and walks it without recursion. Its inner nodes are final; the nodes on its
two border paths are merged with those of the same prefix elsewhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchlens.llm.text import bound_batches, pieces_of, word_count
from watchlens.session import materialize

#: Turns that one shard's tree holds, about.
SHARD_TURNS = 50_000
#: Conversation ids, in a row of their own range, that are listed in one row.
LISTED_IDS = 1024
#: Merged border nodes that may be broadcast to look up parents in.
BROADCAST_NODES = 100_000
_INNER, _UNDER_BORDER, _BORDER = 0, 1, 2
NO_IDS = hashlib.sha256(b"").hexdigest()
_NODE = "depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
_SHARD = f"kind int, key binary, parent binary, top binary, {_NODE}, words long, ends string"


def turn_digest(role: Column, text: Column) -> Column:
    """16 bytes that stand for a turn; a null role or text is empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(whole, 256), 1, 32))


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id and `path`, its turns as (digest, words) in order.

    Ordered by `turn`, null first; equal turn numbers by the digest. Rows without conv_id belong
    to no conversation. A conversation is one row of 20 bytes a turn.
    """
    slim = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct("turn", turn_digest(F.col("role"), F.col("text")).alias("digest"), word_count(F.col("text")).cast("int").alias("words")).alias("t"),
    )
    listed = slim.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return listed.select("conv_id", F.transform("t", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("path"))


def shared_heads(convs: DataFrame, every: int = 20, heads: int = 4) -> DataFrame:
    """Conversations whose first turns are those of the last conversation before them divisible by `every`.

    How many, 0 to `heads` - 1, is drawn from the id. Some may have no turn left.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    starts = convs.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("start_id"), F.slice("path", 1, heads - 1).alias("start")
    )
    own = convs.withColumns({"start_id": F.col("conv_id") - F.col("conv_id") % every, "h": h})
    none = F.slice(F.col("path"), 1, 0)
    begun = F.slice(F.coalesce(F.col("start"), none), F.lit(1), F.col("h"))
    rest = F.slice("path", F.col("h") + 1, F.greatest(F.size("path") - F.col("h"), F.lit(0)))
    return own.join(starts, "start_id", "left").select("conv_id", F.concat(begun, rest).alias("path"))


def prefix_trie(convs: DataFrame) -> DataFrame:
    """One row for every distinct prefix of the conversations' paths, the textless root included.

    `convs` has conv_id (long, distinct) and path. Without conversations there is no node.
    A group of equal conversations is one path with lists of `LISTED_IDS` ids at most, which its shard hashes one after
    the other; no task keeps the ids of a group.
    """
    spark = convs.sparkSession
    bound_batches(spark)
    convs = materialize(convs, "conversations")
    turns = convs.agg(F.sum(F.size("path"))).first()[0] or 0
    listed = convs.groupBy("path", F.floor(F.col("conv_id") / LISTED_IDS).alias("range")).agg(
        F.sort_array(F.collect_list("conv_id")).alias("ids")
    )
    rows = listed.select("path", "range", F.col("ids")[0].alias("first"), F.size("ids").cast("long").alias("n"), F.array_join("ids", ",").alias("ids"))
    order = F.col("path")["digest"]
    sharded = (
        rows.withColumn("digests", order)
        .repartitionByRange(pieces_of(turns, SHARD_TURNS), "digests")
        .sortWithinPartitions("digests", "range")
        .select("digests", F.col("path")["words"].alias("words"), "first", "n", "ids")
    )
    parts = materialize(sharded.mapInArrow(_shard_nodes, _SHARD), "trie-parts")
    border = materialize(_merged(parts.where(F.col("kind") == _BORDER)), "trie-border")
    small = border.count() <= BROADCAST_NODES
    parents = border.select(F.col("key").alias("parent"), F.col("conv_id").alias("known_parent"))
    names = [column.split()[0] for column in _NODE.split(", ")] + ["ends"]
    under = parts.where(F.col("kind") == _UNDER_BORDER).join(F.broadcast(parents) if small else parents, "parent")
    under = under.withColumn("parent_conv_id", F.col("known_parent"))
    nodes = parts.where(F.col("kind") == _INNER).select(names).unionByName(under.select(names)).unionByName(border.select(names))
    return nodes.withColumn("ends_sha256", F.coalesce("ends", F.lit(NO_IDS))).drop("ends")


class TernaryTree:
    """Paths of whole numbers. Node k has a number, its lower and higher neighbours on a level, and what follows it (`equal`)."""

    def __init__(self) -> None:
        self.number, self.low, self.high, self.equal, self.words = [], [], [], [], []
        self.root = -1

    def _add(self, number: int, words: int) -> int:
        self.number.append(number)
        self.words.append(words)
        for link in (self.low, self.high, self.equal):
            link.append(-1)
        return len(self.number) - 1

    def insert(self, path: list[int], words: list[int]) -> int:
        """The node of the path's last number; -1 for an empty path."""
        number, low, high, equal = self.number, self.low, self.high, self.equal
        above = -1
        for step, wanted in enumerate(path):
            node = equal[above] if above >= 0 else self.root
            if node < 0:
                node = self._add(wanted, words[step])
                if above >= 0:
                    equal[above] = node
                else:
                    self.root = node
            while number[node] != wanted:
                link = low if wanted < number[node] else high
                if link[node] < 0:
                    link[node] = self._add(wanted, words[step])
                node = link[node]
            above = node
        return above

    def walk(self) -> Iterator[tuple[int, int, int]]:
        """(node, node above or -1, depth), nodes above first."""
        stack = [(self.root, -1, 1)] if self.root >= 0 else []
        while stack:
            node, above, depth = stack.pop()
            yield node, above, depth
            for link, over, level in ((self.low, above, depth), (self.high, above, depth), (self.equal, node, depth + 1)):
                if link[node] >= 0:
                    stack.append((link[node], over, level))


def medians(count: int) -> Iterator[int]:
    """0 to count - 1, middles first."""
    stack = [(0, count)]
    while stack:
        begin, end = stack.pop()
        if begin < end:
            middle = (begin + end) // 2
            yield middle
            stack += [(begin, middle), (middle + 1, end)]


def _read(batches: Iterator[pa.RecordBatch]) -> tuple[list, list, list[int], list[int], list[str]]:
    """A shard's distinct paths in order: digests, words, count, smallest id, hash of the ids."""
    paths, words, counts, firsts, hashes = [], [], [], [], []
    for batch in batches:
        for path, size, first, n, ids in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if paths and path == paths[-1]:
                counts[-1] += n
                firsts[-1] = min(firsts[-1], first)
                hashes[-1].update(b"," + ids.encode())
            else:
                paths.append(path)
                words.append(size)
                counts.append(n)
                firsts.append(first)
                hashes.append(hashlib.sha256(ids.encode()))
    return paths, words, counts, firsts, [h.hexdigest() for h in hashes]


def _shard_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of a shard. Of a border node, children, leaves and savings are those under its inner children."""
    paths, words, counts, firsts, hashes = _read(batches)
    if not paths:
        return
    flat = [digest for path in paths for digest in path]
    numbers = np.unique(np.frombuffer(b"".join(flat), ">u8").reshape(-1, 2), axis=0, return_inverse=True)[1].ravel().tolist()
    cuts = np.cumsum([0, *map(len, paths)]).tolist()
    tree, end_of = TernaryTree(), [0] * len(paths)
    for k in medians(len(paths)):
        end_of[k] = tree.insert(numbers[cuts[k] : cuts[k + 1]], words[k])
    count = len(tree.number)
    # The root is the node after the last, so that index -1 is its place too.
    members, first, ends = [0] * (count + 1), [None] * (count + 1), [None] * (count + 1)
    children, leaves, saved = [0] * (count + 1), [0] * (count + 1), [0] * (count + 1)
    for k, node in enumerate(end_of):
        members[node], first[node], ends[node] = counts[k], firsts[k], hashes[k]
    border = {-1: (b"", None, None)}
    for k in (0, len(paths) - 1):
        key, level = b"", tree.root
        for step, number in enumerate(numbers[cuts[k] : cuts[k + 1]]):
            node = level
            while tree.number[node] != number:
                node = tree.low[node] if number < tree.number[node] else tree.high[node]
            parent, key = key, hashlib.sha256(key + paths[k][step]).digest()[:16]
            border[node] = (key, parent, paths[k][0])
            level = tree.equal[node]
    order = list(tree.walk())
    for node, above, _ in reversed(order):
        if node not in border:
            leaves[node] = leaves[node] or 1
            saved[node] += (members[node] - 1) * tree.words[node]
            children[above] += 1
            leaves[above] += leaves[node]
            saved[above] += saved[node]
        members[above] += members[node]
        first[above] = first[node] if first[above] is None else min(first[above], first[node])
    rows = []
    for node, above, depth in [(-1, None, 0), *order]:
        mine = border.get(node)
        kind = _BORDER if mine else _UNDER_BORDER if above in border else _INNER
        key, parent, top = mine or (None, border[above][0] if kind == _UNDER_BORDER else None, None)
        rows.append(
            (kind, key, parent, top, depth, first[node], first[above] if kind == _INNER else None, members[node])
            + (children[node], leaves[node], saved[node], tree.words[node] if node >= 0 else 0, ends[node])
        )
        if len(rows) >= 10_000:
            yield _batch(rows)
            rows = []
    if rows:
        yield _batch(rows)


_KINDS = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), *[pa.int64()] * 8, pa.string()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [column.split()[0] for column in _SHARD.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), _KINDS, strict=True)], names=names)


def _accumulate(table: pa.Table) -> pa.Table:
    """Border nodes under one first turn: what lies under border children is added from the deepest up."""
    rows = {row["key"]: row for row in table.to_pylist()}
    for row in sorted(rows.values(), key=lambda row: -row["depth"]):
        row["n_leaves"] = row["n_leaves"] if row["n_children"] else 1
        row["saved_tokens"] += (row["n_convs"] - 1) * row["words"]
        above = rows.get(row["parent"])
        if above:
            above["n_children"] += 1
            above["n_leaves"] += row["n_leaves"]
            above["saved_tokens"] += row["saved_tokens"]
            row["parent_conv_id"] = above["conv_id"]
    return pa.Table.from_pylist(list(rows.values()), schema=table.schema)


def _merged(parts: DataFrame) -> DataFrame:
    """Border nodes, each once: at most a path's length for each border of a shard."""
    sums = [F.sum(name).cast("long").alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    alike = [F.max(name).alias(name) for name in ("parent", "top", "depth", "parent_conv_id", "words", "ends")]
    nodes = parts.groupBy("key").agg(F.min("conv_id").alias("conv_id"), *sums, *alike)
    fields = ["key", "parent", *(column.split()[0] for column in _NODE.split(", ")), "words", "ends"]
    kinds = f"key binary, parent binary, top binary, {_NODE}, words long, ends string"
    under = nodes.where(F.col("depth") > 0).select("key", "parent", "top", *fields[2:])
    under = materialize(under.groupBy("top").applyInArrow(_accumulate, kinds), "trie-under-root")
    first_turns = under.where(F.col("depth") == 1).agg(
        F.count(F.lit(1)).alias("more"), F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved")
    )
    root = nodes.where(F.col("depth") == 0).crossJoin(first_turns)
    children = F.col("n_children") + F.col("more")
    root = root.withColumns(
        {
            "n_children": children,
            "n_leaves": F.when(children > 0, F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).otherwise(F.lit(1)),
            "saved_tokens": F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0)),
        }
    ).select(fields)
    root_id = root.select(F.col("conv_id").alias("root_id"))
    tops = under.select(fields).crossJoin(F.broadcast(root_id))
    parent = F.when(F.col("depth") == 1, F.col("root_id")).otherwise(F.col("parent_conv_id"))
    return tops.withColumn("parent_conv_id", parent).select(fields).unionByName(root)
