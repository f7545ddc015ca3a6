"""Near copies by SimHash fingerprints and BK-trees.

A BK-tree keeps a node's children under their Hamming distance to it; a search within a radius
follows only edges whose distance lies within the radius of the node's own. Trees over all
fingerprints would be searched by all fingerprints, which grows with the square of the input,
so the trees are sharded: if two fingerprints differ in at most r bits and are cut into m > r
blocks, some m - r blocks agree. Each fingerprint goes to one shard for every such choice of
blocks, and only a shard's own fingerprints search its tree. No pair within the radius is lost.
m grows with the number of fingerprints, so that shards stay a few rows wide.

A shard with more than TREE_ROWS fingerprints is dealt out over several trees, and each tree
is sent the fingerprints of the shard's later trees.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate, combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchlens.llm.components import components
from watchlens.llm.text import bound_batches, texts
from watchlens.session import materialize

BITS, SEED = 64, 42
TREE_ROWS = 4000


def shingle_hashes(data: bytes, width: int) -> np.ndarray:
    """Hashes of a text's `width`-word shingles, A-Z lower-cased, repeats included; none without words."""
    words = data.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate([len(w) + 1 for w in words]))  # a word's end, with the blank
    if len(words) <= width:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a : b - 1], SEED) for a, b in zip([0, *ends], ends[width - 1 :], strict=False)]
    return np.array(hashes, np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """The SimHash of shingle hashes: the bits set in over half of them; 0 of none."""
    rows = hashes.view(np.uint8).reshape(-1, 8)
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(rows), 1 << 15):
        ones += np.unpackbits(rows[start : start + (1 << 15)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(rows), bitorder="little").tobytes(), "little")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, text_hash, fingerprint as signed long) of every document."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [signed(fingerprint(shingle_hashes(data, width))) for data in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints, pa.int64())], names=["doc_id", "text_hash", "fingerprint"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, fingerprint long")


class BKTree:
    """A BK-tree that also joins what lies within its radius into components.

    A subtree that lies in one component is not searched for members of that component, so that
    a thick cluster of near copies costs each newcomer one comparison, not one with each.
    """

    def __init__(self, radius: int) -> None:
        self.radius = radius
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []
        self.parent: list[int] = []
        self.uniform: list[bool] = []

    def root(self, node: int) -> int:
        parent = self.parent
        while parent[node] != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    def near(self, value: int, check: Callable[[int], bool] | None = None) -> list[int]:
        """One node within the radius of every component that has any; `check` may refuse a node."""
        if not self.values:
            return []
        radius, values, found = self.radius, self.values, {}
        stack = [0]
        while stack:
            node = stack.pop()
            distance = (values[node] ^ value).bit_count()
            root = self.root(node)
            if distance <= radius and root not in found and (check is None or check(node)):
                found[root] = node
            if self.uniform[node] and root in found:
                continue
            low, high = distance - radius, distance + radius
            stack.extend(child for edge, child in self.children[node].items() if low <= edge <= high)
        return list(found.values())

    def add(self, value: int, check: Callable[[int], bool] | None = None) -> list[int]:
        """Insert a value; gives the nodes it is joined to. Equal values are nodes of their own."""
        linked = self.near(value, check)
        new = len(self.values)
        self.values.append(value)
        self.children.append({})
        self.parent.append(new)
        self.uniform.append(True)
        for node in linked:
            self.parent[self.root(node)] = new
        node = 0
        while node != new:
            self.uniform[node] = self.uniform[node] and self.root(node) == self.root(new)
            edge = (self.values[node] ^ value).bit_count()
            node = self.children[node].setdefault(edge, new)
        return linked


def _masks(count: int, radius: int) -> list[int]:
    """Bit masks of the block choices for about `count` fingerprints."""
    blocks = radius + 1
    while BITS * (blocks - radius) / blocks < np.log2(max(count, 1)) + 2 and comb(blocks + 1, radius) <= 500:
        blocks += 1
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [signed(sum(chosen)) for chosen in combinations(parts, blocks - radius)]


def links(prints: DataFrame, radius: int, count: int) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints within the radius that join the same components as all such pairs."""
    value = F.col("fingerprint")
    choices = F.array(*[F.struct(F.lit(k).alias("choice"), value.bitwiseAND(F.lit(m)).alias("block")) for k, m in enumerate(_masks(count, radius))])
    keys = prints.select("fingerprint", F.inline(choices))
    sizes = keys.groupBy("choice", "block").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    trees: Column = F.ceil(F.col("rows") / TREE_ROWS)
    own = F.pmod(F.xxhash64("fingerprint"), trees).cast("int")
    dealt = keys.join(sizes, ["choice", "block"]).withColumn("own", own)
    dealt = dealt.select("choice", "block", "own", "fingerprint", F.explode(F.sequence(F.lit(0), F.col("own"))).alias("tree"))
    shard = ["choice", "block", "tree"]
    dealt = dealt.repartition(*shard).sortWithinPartitions(*shard, "own", "fingerprint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tree, last = None, BKTree(radius), None
        for batch in batches:
            left, right = [], []
            for choice, block, own_tree, value, at in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if (choice, block, at) != now:
                    now, tree, last = (choice, block, at), BKTree(radius), None
                unsigned = value & ((1 << 64) - 1)
                for node in tree.add(unsigned) if own_tree == at else tree.near(unsigned):
                    left.append(value)
                    right.append(signed(tree.values[node]))
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def near_copies(docs: DataFrame, width: int = 4, radius: int = 4) -> DataFrame:
    """(doc_id, text_hash, fingerprint as 16 hex digits, component, component_id) of every document.

    Documents whose fingerprints differ in at most `radius` bits are linked; `component` is a
    component's smallest fingerprint, `component_id` its smallest doc_id (null if it has none). Texts without words, null ones too, have
    fingerprint zero and are linked like others. Equal rows stay equal rows, an empty table
    gives no rows, other columns are not read.
    """
    rows = materialize(fingerprints(docs, width), "simhash")
    prints = materialize(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    found = components(links(prints.select("fingerprint"), radius, prints.count()))
    owned = prints.join(found, prints["fingerprint"] == found["node"])
    firsts = owned.groupBy("root").agg(F.min("first").alias("component_id"))
    linked = owned.join(firsts, "root").select("fingerprint", "root", "component_id")
    alone = F.col("root").isNull()
    known = prints.join(linked, "fingerprint", "left").select(
        "fingerprint",
        F.coalesce("root", "fingerprint").alias("component"),
        F.when(alone, F.col("first")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return rows.join(known, "fingerprint").select(
        "doc_id",
        "text_hash",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component",
        "component_id",
    )
