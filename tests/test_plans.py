"""The skew-proof plans give what the plain ones give, with one key holding most rows."""

import datetime
import random
from itertools import combinations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from watchlens.plans.ordered import along_time, scanned
from watchlens.plans.skew import group_pairs, hot_keys, sharded_join


def random_events(spark, seed, n=600):
    rng = random.Random(seed)
    start = datetime.datetime(2026, 1, 1)
    rows = []
    for i in range(n):
        user = "hot" if rng.random() < 0.5 else f"u{rng.randrange(20)}"
        # Coarse times, so that many rows tie and the id decides.
        ts = start + datetime.timedelta(minutes=rng.randrange(0, 3000, 7))
        rows.append((f"e{i:04d}", user, ts, rng.choice([None, 1, 5, 9])))
    return spark.createDataFrame(rows, "event_id string, user_id string, ts timestamp_ntz, v int")


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize(("ranges", "batch"), [(1, 10000), (4, 7), (23, 10000), (200, 10)])
def test_along_time_equals_plain_window(spark, seed, ranges, batch):
    """Also with one user's rows over many ranges, and with many more ranges than keys."""
    events = random_events(spark, seed)
    plain = Window.partitionBy("user_id").orderBy("ts", "event_id")
    running = plain.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pause = F.timestamp_diff("MINUTE", F.lag("ts").over(plain), F.col("ts"))
    marked = events.withColumn("opens", F.when(F.coalesce(pause >= 40, F.lit(True)), 1).otherwise(0))
    expected = marked.select(
        "event_id", F.lag("v").over(plain), F.lag("ts").over(plain),
        F.coalesce(F.sum("v").over(running), F.lit(0)), F.row_number().over(plain), F.sum("opens").over(running),
    )
    before = {name: spark.conf.get(name) for name in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    try:
        for name, value in zip(before, (ranges, batch), strict=True):
            spark.conf.set(name, str(value))
        got = along_time(
            events, ["user_id"], ["ts", "event_id"], previous={"pv": F.col("v"), "pt": F.col("ts")},
            running={"sum": F.col("v"), "n": F.lit(1)}, gap=("no", 40 * 60 * 1000000),
        ).select("event_id", "pv", "pt", "sum", "n", "no")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_a_user_with_half_the_rows_in_one_second_is_cut(spark):
    start = datetime.datetime(2026, 1, 1)
    rows = [(f"e{i:05d}", "hot" if i % 2 else f"u{i % 50}", start if i % 2 else start + datetime.timedelta(seconds=i), i % 7) for i in range(4000)]
    events = spark.createDataFrame(rows, "event_id string, user_id string, ts timestamp_ntz, v int")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        scan = scanned(events, ["user_id"], ["ts", "event_id"], {"p": F.col("v")}, {"n": F.lit(1)})
        sizes = sorted(r["count"] for r in scan.groupBy("__part").count().collect())
        numbered = along_time(events, ["user_id"], ["ts", "event_id"], {"p": F.col("v")}, {"n": F.lit(1)})
        assert len(sizes) == 16 and sizes[-1] < 2 * 4000 / 16
        hot = numbered.where("user_id = 'hot'").orderBy("n").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert [r.n for r in hot] == list(range(1, 2001))
    mine = sorted(r for r in rows if r[1] == "hot")
    assert [r.p for r in hot] == [None, *[r[3] for r in mine[:-1]]]


def test_ordered_values_of_other_kinds(spark):
    events = random_events(spark, 5, 80).withColumns(
        {"m": F.create_map(F.lit("k"), F.col("v")), "d": F.col("v") / 4, "a": F.array("event_id")}
    )
    got = along_time(
        events, ["user_id"], ["ts", "event_id"], previous={"pm": F.col("m"), "pa": F.col("a")}, running={"s": F.col("d")}
    )
    plain = Window.partitionBy("user_id").orderBy("ts", "event_id")
    want = events.select("event_id", F.lag("a").over(plain).alias("pa"), F.coalesce(F.sum("d").over(plain), F.lit(0.0)).alias("s"))
    assert sorted(map(str, got.select("event_id", "pa", "s").collect())) == sorted(map(str, want.collect()))
    assert got.schema["m"].dataType == events.schema["m"].dataType and got.schema["s"].dataType.simpleString() == "double"


def test_nothing_to_order(spark):
    empty = random_events(spark, 5, 3).where("false")
    got = along_time(empty, ["user_id"], ["ts", "event_id"], {"p": F.col("v")}, {"n": F.lit(1)}, ("no", 1))
    assert got.collect() == [] and got.columns[-3:] == ["p", "n", "no"]


def test_rows_without_key_or_time_stay_without_results(spark):
    events = random_events(spark, 9, 50)
    stray = spark.createDataFrame([("x1", None, datetime.datetime(2026, 1, 1), 7), ("x2", "hot", None, 7)], events.schema)
    wanted = dict(previous={"p": F.col("v")}, running={"n": F.lit(1), "s": F.col("v")}, gap=("no", 10))
    clean = along_time(events, ["user_id"], ["ts", "event_id"], **wanted)
    mixed = along_time(events.unionByName(stray), ["user_id"], ["ts", "event_id"], **wanted)
    rows = mixed.collect()
    assert sorted(map(str, (r for r in rows if r.event_id not in ("x1", "x2")))) == sorted(map(str, clean.collect()))
    assert sorted((r.event_id, r.p, r.n, r.s, r.no) for r in rows if r.event_id in ("x1", "x2")) == [
        ("x1", None, None, None, None), ("x2", None, None, None, None),
    ]


def test_hot_keys_are_few_and_right(spark):
    df = random_events(spark, 3)
    rows = {r.user_id: r["__shards"] for r in hot_keys(df, ["user_id"], parts=4).collect()}
    assert set(rows) == {"hot"} and 2 <= rows["hot"] <= 4
    # A key of one row in 600 is under a 500th of the rows: nothing is hot.
    assert hot_keys(df, ["event_id"], parts=500).count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_sharded_join_equals_join(spark, how):
    many = random_events(spark, 4).select("event_id", "user_id")
    few = spark.createDataFrame(
        [("hot", 1), ("hot", 2), ("hot", 3), ("u1", 1), ("u2", 2), ("nobody", 9)], "user_id string, x int"
    )
    expected = many.join(few, "user_id", how).select("event_id", *(["x"] if how in ("inner", "left") else []))
    got = sharded_join(many, few, ["user_id"], F.col("event_id"), how, parts=8).select(*expected.columns)
    key = lambda row: tuple(str(v) for v in row)
    assert sorted(got.collect(), key=key) == sorted(expected.collect(), key=key)


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_group_pairs_gives_each_pair_once(spark, block):
    rng = random.Random(5)
    groups = {f"g{i}": sorted(rng.sample([f"c{j:02d}" for j in range(30)], rng.randrange(1, 8))) for i in range(10)}
    groups["big"] = [f"c{j:02d}" for j in range(30)]
    rows = [(g, c, len(c) + ord(c[-1])) for g, items in groups.items() for c in items]
    members = spark.createDataFrame(rows, "g string, c string, w int")
    got = sorted(
        (r.g, r.left_c, r.right_c, r.left_w, r.right_w)
        for r in group_pairs(members, ["g"], "c", ["w"], block=block).collect()
    )
    weight = {(g, c): w for g, c, w in rows}
    expected = sorted(
        (g, a, b, weight[g, a], weight[g, b]) for g, items in groups.items() for a, b in combinations(items, 2)
    )
    assert got == expected


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ordered_work_reads_and_shuffles_its_rows_once(spark, tmp_path):
    path = str(tmp_path / "events")
    random_events(spark, 6).write.parquet(path)
    rows = spark.read.parquet(path)
    plan = plan_of(scanned(rows, ["user_id"], ["ts", "event_id"], {"p": F.col("v")}, {"n": F.lit(1)}))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "Exchange rangepartitioning(" in plan
    # What follows reads the written rows; of them, only borders are shuffled.
    rest = plan_of(along_time(rows, ["user_id"], ["ts", "event_id"], {"p": F.col("v")}, {"n": F.lit(1)}))
    assert path not in rest and "SortMergeJoin" not in rest
    assert all("__head" not in line for line in rest.splitlines() if "Exchange hashpartitioning(user_id" in line)


def test_rank_filters_run_before_the_shuffle(spark):
    from watchlens.operators.sessions import latest_per_user

    events = random_events(spark, 7).withColumnRenamed("ts", "timestamp_ts")
    plan = plan_of(latest_per_user(events, 5))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_lookups_reach_the_scan(spark, tmp_path):
    from watchlens.operators.sessions import user_events

    path = str(tmp_path / "events")
    random_events(spark, 8).withColumnRenamed("ts", "timestamp_ts").write.parquet(path)
    plan = plan_of(user_events(spark.read.parquet(path), "hot", 5).select("event_id"))
    assert "EqualTo(user_id,hot)" in plan and "v:int" not in plan and "TakeOrderedAndProject" in plan


def test_no_query_crosses_tables(spark):
    """No cross or nested-loop joins, and no Python in any batch query's plan but for block products and nearest users.

    Ordered scans, too, work on Arrow batches; they are written before the plan seen here.
    """
    in_blocks = {"user_cf_topk", "recommendation_rows", "session_recs", "blended_recs", "nearest_users"}
    from catalog import ingest, recommend, sessions, stats, tables

    for name, query in {k: q for group in (sessions, ingest, stats, tables, recommend) for k, q in group.QUERIES.items()}.items():
        plan = plan_of(query(spark, "/root/testdata/sf0.001"))
        banned = ["CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "CoGroupsInArrow"]
        if name not in in_blocks:
            banned.append("MapInArrow")
        for bad in banned:
            assert bad not in plan, (name, bad)
