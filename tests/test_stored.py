"""Stored tables against plain dictionaries, over many random writes."""

import random

import pytest
from pyspark.sql import functions as F

from watchlens.operators import stored, tables

SCHEMA = "k string, part int, v int, created string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def held(df):
    return {(r.k, r.part): (r.v, r.created) for r in df.collect()}


def test_random_writes_equal_a_dictionary(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stored, "CHUNK_KEYS", 20)
    path, rng = str(tmp_path / "t"), random.Random(3)
    key = lambda: (rng.choice([None, *(f"k{i}" for i in range(60))]), rng.choice([None, 1, 2]))
    start = {key(): (i, "old") for i in range(80)}
    stored.create(frame(spark, [(*k, *v) for k, v in start.items()]), path, ["k", "part"], buckets=5)
    model, history = dict(start), [dict(start)]
    for step in range(7):
        some = {key(): (1000 * step + i, f"s{step}") for i in range(12)}
        rows = frame(spark, [(*k, *v) for k, v in some.items()])
        if step % 3 == 0:
            stored.upsert(spark, path, rows, keep=("created",))
            model |= {k: (v[0], model[k][1] if k in model else v[1]) for k, v in some.items()}
        elif step % 3 == 1:
            added = stored.append_new(spark, path, rows)
            fresh = {k: v for k, v in some.items() if k not in model}
            assert added == len(fresh)
            model |= fresh
        else:
            stored.delete(spark, path, rows.select("k", "part"))
            model = {k: v for k, v in model.items() if k not in some}
        if step == 3:
            stored.split_buckets(spark, path)
            history.append(dict(model))
        if step == 5:
            stored.compact(spark, path, 1)
            history.append(dict(model))
            listed = stored.entries(spark, path, stored.current(spark, path))
            assert listed.count() == listed.select("__bucket").distinct().count()
        history.append(dict(model))
        assert held(stored.read(spark, path)) == model
    assert stored.current(spark, path).buckets == 10
    for number, then in enumerate(history):
        assert held(stored.read(spark, path, number)) == then
    assert stored.vacuum(spark, path, keep=2) > 0
    assert held(stored.read(spark, path)) == model
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        stored.read(spark, path, 0)


def test_a_broken_write_is_never_seen_and_can_be_repeated(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    stored.create(frame(spark, [("a", 1, 1, "x"), ("b", 1, 1, "x")]), path, ["k"], 2)
    before = held(stored.read(spark, path))
    update = frame(spark, [("a", 1, 2, "y"), ("c", 1, 2, "y")])
    point = stored._point

    def broken(*_):
        raise RuntimeError("lost")

    reader = stored.read(spark, path)
    monkeypatch.setattr(stored, "_point", broken)
    for write in (lambda: stored.upsert(spark, path, update), lambda: stored.delete(spark, path, update.select("k"))):
        with pytest.raises(RuntimeError):
            write()
        assert held(stored.read(spark, path)) == before
    monkeypatch.setattr(stored, "_point", point)
    for _ in range(2):
        stored.upsert(spark, path, update)
        assert held(stored.read(spark, path)) == {("a", 1): (2, "y"), ("b", 1): (1, "x"), ("c", 1): (2, "y")}
    # A reader from before the writes still reads its own version.
    assert held(reader) == before


def test_entries_that_cannot_hold_a_key_are_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    stored.create(spark.range(20000).select(F.format_string("k%06d", "id").alias("k"), F.col("id").alias("v")), path, ["k"], 8)
    version = stored.current(spark, path)
    new = spark.createDataFrame([(f"k{i:06d}x",) for i in range(100, 130)], "k string")
    outside = spark.createDataFrame([("z",), ("a",)], "k string")
    there = spark.createDataFrame([("k000500",)], "k string")
    assert stored.may_hold(spark, path, version, outside).count() == 0
    # Of 30 strange keys within all ranges, the filters let through one in a thousand.
    assert stored.may_hold(spark, path, version, new).count() <= 1
    assert stored.may_hold(spark, path, version, there).count() == 1
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "rows").rglob("*.parquet")}
    rows = spark.createDataFrame([("k000500", 1), ("new", 2), ("new", 2)], "k string, v long")
    assert stored.append_new(spark, path, rows) == 1 and stored.append_new(spark, path, rows) == 0
    assert stored.read(spark, path).count() == 20001
    assert all(p.stat().st_mtime_ns == at for p, at in files.items())


def test_no_stored_key_is_missed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stored, "CHUNK_KEYS", 50)
    path = str(tmp_path / "t")
    keys = spark.range(3000).select((F.col("id") * 7).alias("k"), F.lit(1).alias("v"))
    stored.create(keys, path, ["k"], 3)
    assert stored.append_new(spark, path, keys) == 0
    stored.delete(spark, path, keys.where("k % 2 = 0"))
    assert stored.read(spark, path).count() == 1500


def test_empty_tables_and_writes(spark, tmp_path):
    path, nothing = str(tmp_path / "t"), frame(spark, [])
    stored.create(nothing, path, ["k"])
    assert stored.read(spark, path).collect() == [] and stored.append_new(spark, path, nothing) == 0
    stored.upsert(spark, path, frame(spark, [("a", None, 1, None)]))
    stored.delete(spark, path, nothing.select("k"))
    assert held(stored.read(spark, path)) == {("a", None): (1, None)}
    stored.delete(spark, path, frame(spark, [("a", 1, 1, "")]).select("k"))
    assert stored.read(spark, path).collect() == []


def test_first_row_in_order_is_added(spark, tmp_path):
    path = str(tmp_path / "t")
    stored.create(frame(spark, []), path, ["k"])
    rows = frame(spark, [("a", 2, 20, "late"), ("a", 1, 10, "early"), (None, 1, 5, "n")])
    assert stored.append_new(spark, path, rows, ["part"]) == 2
    assert held(stored.read(spark, path)) == {("a", 1): (10, "early"), (None, 1): (5, "n")}
