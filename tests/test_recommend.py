import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from watchlens.operators import experiment, recommend

NOW = datetime.datetime(2026, 1, 10)


@pytest.fixture(scope="module")
def weights():
    rng = random.Random(7)
    users = [f"u{i}" for i in range(12)]
    contents = [f"c{i:02d}" for i in range(15)]
    found = {}
    for user in users:
        for content in contents:
            # c00 is known to nearly everyone.
            if rng.random() < (0.9 if content == "c00" else 0.3):
                found[user, content] = rng.randrange(1, 9)
    return found


@pytest.fixture(scope="module")
def matrix(spark, weights):
    return spark.createDataFrame([(u, c, w) for (u, c), w in weights.items()], "user_id string, content_id string, weight bigint")


def cosine(weights, u, v):
    dot = sum(w * weights.get((v, c), 0) for (x, c), w in weights.items() if x == u)
    norm = lambda x: math.sqrt(sum(w * w for (y, _), w in weights.items() if y == x))
    return dot / (norm(u) * norm(v))


def test_user_cf_equals_users_against_users(weights, matrix):
    users = sorted({u for u, _ in weights})
    expected = {}
    for u in users:
        raw = {}
        for v in users:
            if v == u:
                continue
            sim = cosine(weights, u, v)
            for (x, c), w in weights.items():
                if x == v and sim > 0 and (u, c) not in weights:
                    raw[c] = raw.get(c, 0.0) + sim * w
        low, high = min(raw.values(), default=0), max(raw.values(), default=0)
        scaled = {c: (s - low) / (high - low) if high > low else 1.0 for c, s in raw.items()}
        best = sorted(scaled.items(), key=lambda item: (-round(item[1], 9), item[0]))[:3]
        expected.update({(u, c): (i + 1, pytest.approx(s, abs=1e-9)) for i, (c, s) in enumerate(best)})
    got = {(r.user_id, r.content_id): (r["rank"], r.score) for r in recommend.user_cf(matrix, 3).collect()}
    assert got == expected


def test_similar_users_equal_brute_force(weights, matrix):
    others = sorted({u for u, _ in weights} - {"u3"})
    expected = sorted(((-round(cosine(weights, "u3", v), 9), v) for v in others))[:4]
    got = [(-r.similarity, r.user_id) for r in recommend.similar_users(matrix, "u3", 4).collect()]
    assert [(pytest.approx(s, abs=1e-9), v) for s, v in expected] == got


def test_dense_ids_are_unique_and_stable(spark):
    df = spark.createDataFrame([(f"u{i % 50}",) for i in range(200)], "user_id string")
    first = {r.user_id: r.user_id_no for r in recommend.dense_ids(df, "user_id", 8).collect()}
    again = {r.user_id: r.user_id_no for r in recommend.dense_ids(df.repartition(3), "user_id", 8).collect()}
    assert first == again and len(set(first.values())) == 50


def test_preference_falls_back_to_all_contents(spark):
    users = spark.createDataFrame(
        [("a", ["drama"]), ("b", ["opera"]), ("c", []), ("d", ["drama", "sf", "drama"])],
        "user_id string, favorite_categories array<string>",
    )
    contents = spark.createDataFrame([("c1", "drama"), ("c2", "drama"), ("c3", "sf")], "content_id string, genre string")
    scores = spark.createDataFrame([("c1", 1), ("c3", 5)], "content_id string, score bigint")
    got = {}
    for r in recommend.preference_match(users, contents, scores, 2).collect():
        got.setdefault((r.user_id, r.eligible), []).append((r["rank"], r.content_id))
    assert {k: [c for _, c in sorted(v)] for k, v in got.items()} == {
        ("a", 2): ["c1", "c2"], ("b", 3): ["c3", "c1"], ("c", 3): ["c3", "c1"], ("d", 3): ["c3", "c1"],
    }


def ranked(spark, rows):
    return spark.createDataFrame(rows, "user_id string, content_id string, score double, rank int")


def test_blend_fills_up_in_order_of_sources(spark):
    cf = ranked(spark, [("u", "c1", 0.9, 1), ("u", "c2", 0.5, 2)])
    pop = ranked(spark, [("u", "c2", 50.0, 1), ("u", "c3", 40.0, 2), ("u", "c4", 30.0, 3), ("v", "c2", 50.0, 1)])
    lists = recommend.blend({recommend.COLLABORATIVE: cf, recommend.POPULAR: pop}, 3).collect()
    got = sorted((r.user_id, r["rank"], r.content_id, r.algorithm) for r in lists)
    assert got == [
        ("u", 1, "c1", "collaborative_filtering"), ("u", 2, "c2", "collaborative_filtering"),
        ("u", 3, "c3", "popularity"), ("v", 1, "c2", "popularity"),
    ]
    assert all(r.reason for r in lists)


def recs(spark, rows):
    return spark.createDataFrame(
        rows, "user_id string, content_id string, created_at timestamp_ntz, recommendation_score double, ab_test_group string"
    )


def test_fresh_cache_wins_else_the_store(spark):
    at = lambda s: NOW - datetime.timedelta(seconds=s)
    cached = recs(spark, [("u", "c1", at(599), 0.5, "A"), ("v", "c1", at(600), 0.5, "A"), ("w", "c1", at(-5), 0.5, "A")])
    stored = recs(spark, [(x, "c9", at(9999), 0.5, "A") for x in "uvw"])
    served = recommend.cached_or_stored(cached, stored, F.lit(NOW).cast("timestamp_ntz"))
    assert {(r.user_id, r.content_id, r.served_from) for r in served.collect()} == {
        ("u", "c1", "cache"), ("v", "c9", "store"), ("w", "c9", "store"),
    }


@pytest.mark.parametrize("horizon", [60, 3600, 86400])
def test_attribution_equals_brute_force(spark, horizon):
    rng = random.Random(horizon)
    at = lambda: NOW + datetime.timedelta(seconds=rng.randrange(0, 4 * horizon))
    given = [(f"u{rng.randrange(3)}", f"c{rng.randrange(2)}", at(), 0.5, "A") for _ in range(60)]
    acts = [
        (f"u{rng.randrange(3)}", f"c{rng.randrange(2)}", rng.choice(["click", "watch", "watch_complete", "rating"]), at())
        for _ in range(40)
    ]
    # Right at both ends of the horizon.
    given.append(("x", "c", NOW, 0.5, "A"))
    given.append(("y", "c", NOW, 0.5, "A"))
    acts.append(("x", "c", "click", NOW))
    acts.append(("x", "c", "watch", NOW + datetime.timedelta(seconds=horizon)))
    acts.append(("y", "c", "watch", NOW + datetime.timedelta(seconds=horizon, microseconds=1)))
    events = spark.createDataFrame(acts, "user_id string, content_id string, event_type string, timestamp_ts timestamp_ntz")

    def followed(r, kinds):
        return any(
            a[:2] == r[:2] and a[2] in kinds and r[2] <= a[3] <= r[2] + datetime.timedelta(seconds=horizon) for a in acts
        )

    expected = sorted((*r[:3], followed(r, {"click"}), followed(r, {"watch", "watch_complete"})) for r in given)
    out = experiment.attribute(recs(spark, given), events, horizon)
    got = sorted((r.user_id, r.content_id, r.created_at, r.is_clicked, r.is_watched) for r in out.collect())
    assert got == expected


def test_assignment_leaves_inactive_groups_without_algorithm(spark):
    groups = spark.createDataFrame(
        [("algorithm_v1", "x", True), ("algorithm_v2", "y", False)], "group_name string, algorithm string, is_active boolean"
    )
    users = spark.createDataFrame([("user-00001",), ("user-00002",)], "user_id string")
    got = {r.user_id: (r.ab_test_group, r.group_name, r.group_algorithm) for r in experiment.assign(users, groups).collect()}
    assert got == {"user-00001": ("B", "algorithm_v2", None), "user-00002": ("A", "algorithm_v1", "x")}


def test_comparison_of_known_rates(spark):
    metrics = spark.createDataFrame(
        [("A", "click_rate", 0.10, 1000), ("B", "click_rate", 0.13, 1000), ("A", "precision@10", 0.2, 50), ("B", "precision@10", 0.3, 50)],
        "test_group string, metric_name string, metric_value double, sample_size bigint",
    )
    rows = {r.metric_name: r for r in experiment.compare(metrics).collect()}
    click = rows["click_rate"]
    pooled = 0.115
    z = 0.03 / math.sqrt(pooled * (1 - pooled) * (2 / 1000))
    assert click.z == pytest.approx(z) and click.lift == pytest.approx(0.3) and click.enough
    assert click.p_value == pytest.approx(math.erfc(z / math.sqrt(2)), abs=1e-6)
    assert rows["precision@10"].z is None and rows["precision@10"].p_value is None and not rows["precision@10"].enough


def test_diversity_of_known_lists(spark):
    lists = spark.createDataFrame([("u", "a"), ("u", "b"), ("u", "c"), ("v", "a")], "user_id string, content_id string")
    contents = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "content_id string, genre string")
    got = {r.user_id: (r.list_size, r.diversity) for r in experiment.diversity(lists, contents).collect()}
    assert got == {"u": (3, pytest.approx(2 / 3)), "v": (1, None)}


def test_blending_aggregates_without_sorting(spark):
    lists = {
        name: spark.createDataFrame(rows, "user_id string, content_id string, score double, rank int")
        for name, rows in {
            recommend.SESSION: [("u", "a", 3.0, 1), ("u", "b", 2.0, 2)],
            recommend.POPULAR: [("u", "b", 9.0, 1), ("u", "c", 8.0, 2), ("v", "b", 9.0, 1)],
            "own": [("u", "d", None, 1)],
        }.items()
    }
    blended = recommend.blend(lists, 4)
    rows = [(r.user_id, r.content_id, r.score, r.algorithm, r["rank"]) for r in blended.orderBy("user_id", "rank").collect()]
    assert rows == [
        ("u", "a", 3.0, recommend.SESSION, 1), ("u", "b", 2.0, recommend.SESSION, 2), ("u", "c", 8.0, recommend.POPULAR, 3),
        ("u", "d", None, "own", 4), ("v", "b", 9.0, recommend.POPULAR, 1),
    ]
    assert blended.where("content_id = 'd'").first().reason == "own"
    assert "SortAggregate" not in blended._jdf.queryExecution().executedPlan().toString()
