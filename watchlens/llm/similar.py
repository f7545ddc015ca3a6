"""Near copies of a given similarity: BK-trees of SimHash fingerprints, verified on the shingles.

Texts that share four fifths of their shingles differ in some ten fingerprint bits, too many to
shard the trees by equal bits as `simhash` does. Here a tree holds the texts that agree in a
minimum of their hashed shingles; of CHOICES minima, texts of similarity s miss each other in all
with probability (1 - s) ** CHOICES, 0.16 % at 0.8. The trees are searched within a wide radius,
and what they find is held against the similarity of the shingle sets: exact for texts of under
SKETCH shingles. Beyond, their SKETCH smallest hashes are a filter with a margin only: components in
which such a pair turns up are searched again, each by itself, on the whole shingle sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchlens.llm.components import components
from watchlens.llm.simhash import BKTree, fingerprint, shingle_hashes, signed
from watchlens.llm.text import bound_batches, texts
from watchlens.session import materialize

CHOICES, SKETCH, TREE_ROWS = 4, 512, 1000
#: How far under the asked similarity sketches may lie: 4.5 standard deviations of one at 0.8.
MARGIN = 0.08
#: Shingles of whole sets in a tree.
TREE_SHINGLES = 4_000_000
#: Odd factors that order the hashes anew for each minimum.
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def signature(data: bytes, width: int) -> tuple[int, list[int], bytes]:
    """Fingerprint, minima and sketch (sorted 32-bit hashes) of a text; zeros and nothing without words."""
    # Similarity is one of sets, so repeats count once in the fingerprint as well.
    own = np.unique(shingle_hashes(data, width))
    print_ = fingerprint(own)
    if not len(own):
        return print_, [0] * CHOICES, b""
    mixed = [(own * factor) ^ ((own * factor) >> np.uint64(29)) for factor in FACTORS]
    # The sketch takes other bits than the fingerprint's order, so that it is a fair sample.
    low = np.unique((mixed[0] >> np.uint64(32)).astype(np.uint32))[:SKETCH]
    return print_, [signed(int(m.min())) for m in mixed], low.tobytes()


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sketches; of two empty ones 1."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.union1d(a, b)
    if len(a) == SKETCH or len(b) == SKETCH:
        both = both[:SKETCH]
    shared = np.intersect1d(a, b, assume_unique=True)
    return float((shared <= both[-1]).sum() / len(both))


def _signatures(docs: DataFrame, width: int) -> DataFrame:
    """Signatures of the distinct texts, with the smallest id of each: copies are folded here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [signature(data, width) for data in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([signed(f[0]) for f in found], pa.int64()),
                    pa.array([f[1] for f in found], pa.list_(pa.int64())),
                    pa.array([f[2] for f in found], pa.binary()),
                ],
                names=["doc_id", "text_hash", "fingerprint", "minima", "sketch"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, fingerprint long, minima array<long>, sketch binary")


def exact_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two whole sets of distinct hashes; of two empty ones 1."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared) if len(a) or len(b) else 1.0


def _search(rows: DataFrame, shard: list[str], radius: int, kind: type, alike: Callable) -> DataFrame:
    """Pairs (a, b, sure) that the trees of each shard join; `rows` have their own tree's number and hashes."""
    dealt = rows.select(*shard, "own", "text_hash", "fingerprint", "hashes", F.explode(F.sequence(F.lit(0), F.col("own"))).alias("tree"))
    shard = [*shard, "tree"]
    dealt = dealt.repartition(*shard).sortWithinPartitions(*shard, "own", "text_hash")
    dealt = dealt.select(*shard, "own", "text_hash", "fingerprint", "hashes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tree, nodes, sets = None, BKTree(radius), [], []
        for batch in batches:
            left, right, sure = [], [], []
            for *key, own_tree, node, value, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != now:
                    now, tree, nodes, sets = key, BKTree(radius), [], []
                mine = np.frombuffer(data, kind)

                def check(other: int, mine: np.ndarray = mine, sets: list = sets) -> bool:
                    return alike(mine, sets[other])

                unsigned = value & ((1 << 64) - 1)
                found = tree.add(unsigned, check) if own_tree == key[-1] else tree.near(unsigned, check)
                left += [node] * len(found)
                right += [nodes[k] for k in found]
                sure += [len(mine) < SKETCH and len(sets[k]) < SKETCH for k in found]
                if own_tree == key[-1]:
                    nodes.append(node)
                    sets.append(mine)
            if left:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(left, pa.int64()), pa.array(right, pa.int64()), pa.array(sure, pa.bool_())], names=["a", "b", "sure"]
                )

    return dealt.mapInArrow(run, "a long, b long, sure boolean")


def links(nodes: DataFrame, radius: int, least: float) -> DataFrame:
    """Pairs (a, b, sure) of text hashes that join the same components as all pairs of that similarity.

    Pairs that are not sure rest on a sketch, and count from MARGIN under `least`.
    """
    keys = nodes.select("text_hash", F.posexplode("minima").alias("choice", "block"))
    sizes = keys.groupBy("choice", "block").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    own = F.pmod(F.xxhash64("text_hash", "choice"), F.ceil(F.col("rows") / TREE_ROWS)).cast("int")
    shared = keys.join(sizes, ["choice", "block"]).withColumn("own", own)
    full = shared.join(nodes.select("text_hash", "fingerprint", F.col("sketch").alias("hashes")), "text_hash")

    def alike(a: np.ndarray, b: np.ndarray) -> bool:
        return similarity(a, b) >= (least if len(a) < SKETCH and len(b) < SKETCH else least - MARGIN)

    return _search(full, ["choice", "block"], radius, np.uint32, alike)


def _whole_links(docs: DataFrame, members: DataFrame, width: int, radius: int, least: float) -> DataFrame:
    """Pairs (a, b) within the components of `members` (text_hash, first, root), verified on whole shingle sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.unique(shingle_hashes(data, width)) for data in texts(batch)]
            prints = pa.array([signed(fingerprint(o)) for o in own], pa.int64())
            sets = pa.array([o.tobytes() for o in own], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), prints, sets], names=["text_hash", "root", "fingerprint", "hashes"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").alias("__id"), F.xxhash64(text).alias("__own"), text.alias("text"))
    # One row of each text, so that the copies of one text do not meet in one task.
    one = rows.join(members, (F.col("__own") == F.col("text_hash")) & F.col("__id").eqNullSafe(F.col("first")))
    sets = one.select("text_hash", "root", "text").mapInArrow(run, "text_hash long, root long, fingerprint long, hashes binary")
    each = sets.groupBy("text_hash").agg(*[F.first(c).alias(c) for c in ("root", "fingerprint", "hashes")])
    each = materialize(each, "similar-sets")
    trees = F.ceil(F.greatest(F.count(F.lit(1)) / TREE_ROWS, F.sum(F.octet_length("hashes")) / (8 * TREE_SHINGLES)))
    sizes = each.groupBy("root").agg(trees.alias("trees"))
    dealt = each.join(sizes, "root").withColumn("own", F.pmod(F.xxhash64("text_hash"), F.greatest("trees", F.lit(1))).cast("int"))

    def alike(a: np.ndarray, b: np.ndarray) -> bool:
        return exact_similarity(a, b) >= least

    return _search(dealt, ["root"], radius, np.uint64, alike).select("a", "b")


def _components(docs: DataFrame, nodes: DataFrame, width: int, radius: int, least: float) -> DataFrame:
    """(node, root) of all texts that are linked."""
    pairs = materialize(links(nodes, radius, least), "similar-links")
    found = materialize(components(pairs), "similar-components")
    unsure = pairs.where(~F.col("sure"))
    if unsure.isEmpty():
        return found
    again = unsure.select(F.col("a").alias("node")).join(found, "node").select("root").distinct()
    members = found.join(again, "root", "left_semi").join(nodes.select("text_hash", "first"), F.col("node") == F.col("text_hash"))
    whole = components(_whole_links(docs, members.select("text_hash", "first", "root"), width, radius, least))
    return found.join(again, "root", "left_anti").select("node", "root").unionByName(whole)


def similar_documents(docs: DataFrame, width: int = 5, least: float = 0.8, radius: int = 18) -> DataFrame:
    """(doc_id, text_hash, component, component_id) of every document.

    Texts whose `width`-word shingles are alike by `least` or more are linked; `component` is a
    component's smallest text hash, `component_id` its smallest doc_id (null if it has none).
    Texts without words, null ones too, are copies of one another. Equal rows stay equal rows, an
    empty table gives no rows, other columns are not read.
    """
    bound_batches(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"))
    each = _signatures(docs, width).groupBy("text_hash")
    nodes = materialize(
        each.agg(
            F.min("doc_id").alias("first"), F.first("fingerprint").alias("fingerprint"),
            F.first("minima").alias("minima"), F.first("sketch").alias("sketch"),
        ),
        "similar",
    )
    found = _components(docs, nodes, width, radius, least)
    owned = nodes.select("text_hash", "first").join(found, F.col("text_hash") == F.col("node"))
    firsts = owned.groupBy("root").agg(F.min("first").alias("component_id"))
    linked = owned.join(firsts, "root").select("text_hash", "root", "component_id")
    known = nodes.select("text_hash", "first").join(linked, "text_hash", "left").select(
        "text_hash",
        F.coalesce("root", "text_hash").alias("component"),
        F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return rows.join(known, "text_hash").select("doc_id", "text_hash", "component", "component_id")


def one_of_each(docs: DataFrame, width: int = 5, least: float = 0.8) -> DataFrame:
    """The documents without near copies: of every component the one with the smallest doc_id.

    Equal rows count as copies too. Documents with a null id stay only if no copy has an id.
    Columns are those of `docs`, whatever their names.
    """
    rows = materialize(similar_documents(docs, width, least), "similar-kept")
    keeper = F.col("doc_id").eqNullSafe(F.col("component_id"))
    keepers = rows.where(keeper).groupBy("component", "doc_id").agg(F.min("text_hash").alias("__hash"))
    keepers = keepers.select(F.col("doc_id").alias("__id"), "__hash")
    # The documents' columns travel as one, so that their names meet no others.
    whole = F.struct(*[F.col(name) for name in docs.columns]).alias("__row")
    own = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("__own")
    marked = docs.select(whole, "doc_id", own)
    columns = [F.col("__row").getField(name).alias(name) for name in docs.columns]
    same = marked["doc_id"].eqNullSafe(F.col("__id")) & (marked["__own"] == F.col("__hash"))
    kept = marked.join(keepers, same, "left_semi")
    # Rows that are equal all through were kept together; they are rare, so only they are sorted out.
    again = rows.where(keeper).groupBy("doc_id", "text_hash").count().where("count > 1")
    again = again.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    same = kept["doc_id"].eqNullSafe(F.col("__id")) & (kept["__own"] == F.col("__hash"))
    if again.isEmpty():
        return kept.select(*columns)
    single = kept.join(again, same, "left_anti")
    folded = kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "__own"])
    return single.unionByName(folded).select(*columns)
