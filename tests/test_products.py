"""Block products and neighbours against their plain forms."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest

from watchlens.operators import neighbours, recommend
from watchlens.plans import products


def random_matrix(spark, seed, users=90, contents=25):
    rng = random.Random(seed)
    rows = [(f"u{u:03d}", f"c{c:02d}", rng.choice([1, 2, 5])) for u in range(users) for c in rng.sample(range(contents), rng.randint(1, 8))]
    return spark.createDataFrame(rows, "user_id string, content_id string, weight int")


def lists(df):
    return sorted((r.user_id, r["rank"], r.content_id, round(r.score, 6)) for r in df.collect())


@pytest.mark.parametrize("block", [7, 1024])
def test_user_scores_in_blocks_equal_the_joined_form(spark, monkeypatch, block):
    monkeypatch.setattr(products, "BLOCK_ROWS", block)
    matrix = random_matrix(spark, block)
    assert lists(recommend.user_cf(matrix, 5)) == lists(recommend.user_cf_joined(matrix, 5))


def test_session_scores_in_blocks_equal_the_joined_form(spark):
    rng = random.Random(2)
    visits = {(f"s{s}", f"u{s % 13}", f"c{rng.randrange(15):02d}"): s * 100 + rng.randrange(100) for s in range(60) for _ in range(rng.randint(1, 5))}
    df = spark.createDataFrame([(*k, v) for k, v in visits.items()], "session_id string, user_id string, content_id string, last_ts long")
    assert lists(recommend.session_based(df, 4)) == lists(recommend.session_based_joined(df, 4))


def test_larger_catalogues_are_joined(spark, monkeypatch):
    matrix = random_matrix(spark, 5)
    wanted = lists(recommend.user_cf(matrix, 3))
    monkeypatch.setattr(products, "LARGEST_CATALOGUE", 24)
    assert products.catalogue(matrix, "content_id") is None
    assert lists(recommend.user_cf(matrix, 3)) == wanted
    with pytest.raises(ValueError):
        products.best_products(matrix, "user_id", np.zeros((25, 25)), [], 1, 9)


@pytest.mark.parametrize("block", [7, 1024])
def test_model_scores_in_blocks_equal_those_of_crossed_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(products, "BLOCK_ROWS", block)
    matrix = random_matrix(spark, 8 + block).unionByName(spark.createDataFrame([("all", f"c{c:02d}", 1) for c in range(24)], "user_id string, content_id string, weight int"))
    in_blocks = recommend.als_recommendations(matrix, 5)
    assert "Cartesian" not in (plan := in_blocks._jdf.queryExecution().executedPlan().toString()) and "NestedLoop" not in plan
    monkeypatch.setattr(products, "LARGEST_CATALOGUE", 24)
    crossed = recommend.als_recommendations(matrix, 5)
    assert in_blocks.columns == crossed.columns and in_blocks.dtypes == crossed.dtypes
    got, want = lists(in_blocks), lists(crossed)
    assert [row[:2] for row in got] == [row[:2] for row in want] and len(got) == 90 * 5 + 1
    assert [row[3] for row in got] == pytest.approx([row[3] for row in want], abs=1e-4)
    known = {(r.user_id, r.content_id) for r in matrix.collect()}
    assert not known & {(user, content) for user, _, content, _ in got}
    # Contents may change places only where their scores are as good as equal.
    assert sum(one[2] != other[2] for one, other in zip(got, want, strict=True)) <= 4
    with pytest.raises(ValueError):
        products.best_by_factors(matrix, "user_id", np.zeros((25, 2)), list(range(25)), 1)


def test_scoring_shuffles_no_scores(spark):
    plan = recommend.user_cf(random_matrix(spark, 6))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_empty_matrix(spark):
    empty = random_matrix(spark, 1).where("false")
    assert recommend.user_cf(empty).collect() == [] and neighbours.nearest_users(empty).collect() == []


def exact(matrix, n):
    weights = defaultdict(dict)
    for r in matrix.collect():
        weights[r.user_id][r.content_id] = r.weight
    norm = {u: math.sqrt(sum(w * w for w in own.values())) for u, own in weights.items()}
    found = {}
    for a, own in weights.items():
        cosines = [(-round(sum(w * other.get(c, 0) for c, w in own.items()) / norm[a] / norm[b], 9), b) for b, other in weights.items() if b != a]
        found[a] = [(b, -minus) for minus, b in sorted(cosines)[:n] if minus < 0]
    return found


def test_neighbours_within_a_cell_are_exact(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_CELLS", 500)
    matrix = random_matrix(spark, 8)
    got = defaultdict(list)
    for r in sorted(neighbours.nearest_users(matrix, 6, bands=2, cell=90).collect(), key=lambda r: r["rank"]):
        got[r.user_id].append((r.neighbour, pytest.approx(r.similarity, abs=1e-8)))
    assert got == exact(matrix, 6)


def test_recall_of_alike_users_over_many_cells(spark, monkeypatch):
    """Groups of alike users among many others, all of whom share one popular content."""
    monkeypatch.setattr(neighbours, "TASK_ROWS", 3000)
    rng = random.Random(4)
    rows = []
    for user in range(900):
        taste = user // 6
        own = {c for c in random.Random(taste).sample(range(400), 12) if rng.random() < 0.85} | {400} | set(rng.sample(range(400), 2))
        rows += [(f"u{user:04d}", f"c{c:03d}", rng.choice([2, 3])) for c in own]
    matrix = spark.createDataFrame(rows, "user_id string, content_id string, weight int")
    wanted = {(u, v) for u, found in exact(matrix, 5).items() for v, _ in found}
    got = {(r.user_id, r.neighbour) for r in neighbours.nearest_users(matrix, 5, cell=40).collect()}
    assert len(got & wanted) / len(wanted) >= 0.95
