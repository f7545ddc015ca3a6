import heapq
from collections import Counter, defaultdict
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from watchlens.llm import mixing, queries, shards


def seats_by_heap(votes, seats):
    won = Counter()
    heap = [(-v, k) for k, v in sorted(votes.items())]
    heapq.heapify(heap)
    for _ in range(seats):
        _, k = heapq.heappop(heap)
        won[k] += 1
        heapq.heappush(heap, (-votes[k] / (2 * won[k] + 1), k))
    return won


@pytest.mark.parametrize("seats", [0, 1, 7, 100, 12345])
@pytest.mark.parametrize("votes", [{"a": 5.0, "b": 3.0, "c": 1.0}, {f"p{k:02d}": float(k * k % 37 + 1) for k in range(30)}, {"x": 1.0}])
def test_apportioned_seats_are_those_of_the_highest_quotients(spark, votes, seats):
    parties = spark.createDataFrame([("g", k, v, seats) for k, v in votes.items()], "g string, party string, votes double, seats long")
    got = {r.party: r.won for r in mixing.apportion(parties, ("g",), ("party",), "votes", "seats", "won").collect()}
    assert sum(got.values()) == seats
    want = seats_by_heap(votes, seats)
    # Parties with equal votes may swap a last seat.
    assert sorted(got.values()) == sorted(want[k] for k in votes)


def water_fill(sizes, weights):
    left, open_, target = float(sum(sizes.values())), set(sizes), {}
    while open_:
        level = left / sum(weights[k] for k in open_)
        full = {k for k in open_ if weights[k] * level > 3 * sizes[k]}
        if not full:
            return target | {k: weights[k] * level for k in open_}
        for k in full:
            target[k] = 3.0 * sizes[k]
            left -= target[k]
        open_ -= full
    return target


def test_targets_stop_at_three_times_a_size(spark):
    sizes = {"a": 10, "b": 1000, "c": 2, "d": 40, "e": 0, "f": 500}
    sources = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    rows = mixing.targets(mixing.weigh(sources)).collect()
    want = water_fill(sizes, {k: float(n % 3 + 1) for n, k in enumerate(sorted(sizes))})
    assert {r.source: pytest.approx(r.target) for r in rows} == want


def mixed(df):
    return [(r.doc_id, r.size, r.source_size, r.target, r.taken) for r in df.collect()]


def test_mix_takes_about_the_target_of_each_source(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.op1_mix_sources(spark, folder).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
        assert 0 <= r.taken <= 3 * r["size"]
    assert len(rows) == 1000
    for source_rows in by.values():
        assert sum(r["size"] for r in source_rows) == source_rows[0].source_size
        assert sum(r.taken for r in source_rows) == pytest.approx(source_rows[0].target, rel=0.01)
    again = queries.op1_mix_sources(spark, folder).repartition(3)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again.collect()))


def test_mix_does_not_depend_on_partitions_and_bears_odd_rows(spark, odd_docs):
    one, many = mixed(mixing.mix(odd_docs.coalesce(1))), mixed(mixing.mix(odd_docs.repartition(7)))
    assert sorted(map(str, one)) == sorted(map(str, many))
    assert len(one) == odd_docs.count()
    assert all(row[4] == 0 for row in one if row[1] == 0)
    assert mixing.mix(odd_docs.limit(0)).count() == 0


def test_whole_documents_follow_the_targets(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 50 + 1).cast("int")).alias("text"),
        F.when(F.col("id") % 10 < 8, "big").otherwise("small").alias("source"),
    )
    size = {r.source: r.n for r in docs.groupBy("source").agg(F.sum(F.col("doc_id") % 50 + 1).alias("n")).collect()}
    want = water_fill(size, {"big": 1.0, "small": 2.0})
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    got = {r.source: r.n for r in out.groupBy("source").agg(F.sum(F.col("doc_id") % 50 + 1).alias("n")).collect()}
    assert {k: pytest.approx(v, rel=0.01) for k, v in got.items()} == want
    assert out.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3


def test_whole_documents_of_odd_rows(spark, odd_docs):
    out = mixing.mixed_documents(odd_docs)
    assert out.columns == odd_docs.columns
    blank = [r for r in out.collect() if not (r.text or "").strip()]
    assert len(blank) == 4
    assert mixing.mixed_documents(odd_docs.limit(0)).count() == 0


def test_sharding_is_gapless_and_moves_rows_only_into_the_new_shard(spark):
    rows = queries.op9_shard_records(spark, "/root/testdata/sf0.01").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(texts)
    slots = defaultdict(list)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law) == (len(data) + 8, crc32(data), "key")
        assert r.grown_shard in (r.shard, 24)
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    moved = sum(r.grown_shard == 24 for r in rows)
    assert 0.5 < moved / (len(rows) / 25) < 1.6


def test_shards_bear_odd_rows_and_follow_weights(spark, odd_docs):
    rows = shards.shard_rows(odd_docs, {0: 1.0, 7: 3.0, 9: 0.0}).collect()
    assert len(rows) == odd_docs.count() and {r.shard for r in rows} <= {0, 7}
    assert all(sorted(x.slot for x in rows if x.shard == s) == list(range(sum(x.shard == s for x in rows))) for s in (0, 7))
    assert len({r.shard for r in rows if r.doc_id == 3}) == 1 and len({r.shard for r in rows if r.doc_id is None}) == 1
    assert shards.shard_rows(odd_docs.limit(0), {0: 1.0}).count() == 0
    many = spark.range(20000).select(shards.rendezvous([F.col("id")], {0: 1.0, 1: 3.0}).alias("s"))
    assert many.where("s = 1").count() / 20000 == pytest.approx(0.75, abs=0.02)
    with pytest.raises(ValueError):
        shards.rendezvous([F.col("id")], {0: 0.0})
