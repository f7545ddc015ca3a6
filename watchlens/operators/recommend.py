"""Recommendation candidates: collaborative, session-based, by preference and by popularity.

Scores are exact: no list of users, contents or neighbours is cut short on the
way, only the final top-k per user is a limit. `k` lists are ranked by score,
then content id.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watchlens.functions.identity import ab_group
from watchlens.functions.weights import interaction_weight
from watchlens.plans.products import best_by_factors, best_products, catalogue, gram, rows_of
from watchlens.plans.skew import group_pairs, sharded_join
from watchlens.schemas import RECOMMENDATION_TTL_SECONDS, RECOMMENDATIONS_PER_USER
from watchlens.session import materialize

COLLABORATIVE, SESSION, PREFERENCE, POPULAR = (
    "collaborative_filtering", "session_based", "preference", "popularity",
)

#: Scores are compared at this many decimals, so that the order in which a sum
#: was added up cannot decide a rank.
SCORE_DECIMALS = 9
#: More than any rank in a list.
RANKS = 2**32


def interactions(events: DataFrame) -> DataFrame:
    """Weight of each (user, content) pair: the sum of its events' weights."""
    weight = interaction_weight(F.col("event_type"))
    return events.groupBy("user_id", "content_id").agg(F.sum(weight).alias("weight"))


def _ranked(scores: DataFrame, k: int, by: str = "user_id") -> DataFrame:
    order = Window.partitionBy(by).orderBy(F.desc(F.round("score", SCORE_DECIMALS)), "content_id")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _unknown(parts: DataFrame, known: DataFrame) -> DataFrame:
    """Sum the partial scores of each (user, content), leaving out known pairs.

    Known pairs are marked in the same aggregation instead of an anti-join of their own.
    """
    marked = parts.withColumn("known", F.lit(0)).unionByName(
        known.select("user_id", "content_id", F.lit(0.0).alias("score"), F.lit(1).alias("known"))
    )
    sums = marked.groupBy("user_id", "content_id").agg(F.sum("score").alias("score"), F.max("known").alias("known"))
    return sums.where(F.col("known") == 0).drop("known")


def _both_ways(pairs: DataFrame, value: str) -> DataFrame:
    """Unordered pairs as (content, candidate) in both directions, without a second pass."""
    def way(a: str, b: str) -> Column:
        return F.struct(F.col(a).alias("content_id"), F.col(b).alias("candidate"), F.col(value).alias(value))

    ways = F.array(way("left_content_id", "right_content_id"), way("right_content_id", "left_content_id"))
    return pairs.select(F.inline(ways))


def content_affinity(matrix: DataFrame) -> DataFrame:
    """Sum over users of both weights divided by the user's norm, per pair of contents."""
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy("user_id")))
    members = matrix.select("user_id", "content_id", "weight", norm.alias("norm"))
    pairs = group_pairs(members, ["user_id"], "content_id", ["weight", "norm"])
    product = F.col("left_weight") * F.col("right_weight") / F.col("left_norm")
    return pairs.groupBy("left_content_id", "right_content_id").agg(F.sum(product).alias("affinity"))


def user_cf(matrix: DataFrame, k: int = RECOMMENDATIONS_PER_USER) -> DataFrame:
    """User-based collaborative filtering over all neighbours.

    The score of a content is the sum, over all other users, of their cosine
    similarity times their weight on it. Taken literally that joins users with
    users, where one popular content pairs up everyone who saw it. The same sum
    is added up contents-first instead: user x content x content, bounded by the
    catalogue however many users there are. Contents the user knows are left
    out; scores are scaled to 0..1 per user. `matrix` is read several times;
    keep it as a table. Users and contents are not null, weights above 0.

    Where the pairs of the catalogue's contents fit every task (see `plans.products`), users are scored where they are
    and only their lists leave a task. Larger catalogues are joined.
    """
    items = catalogue(matrix, "content_id")
    if items is not None:
        users = materialize(rows_of(matrix, "user_id", "content_id", "weight"), "profiles")
        best = best_products(users, "user_id", gram(users, items, by_norm=True), items, k, SCORE_DECIMALS, by_norm=True, spread=True)
        return best.withColumnRenamed("item", "content_id")
    return user_cf_joined(matrix, k)


def user_cf_joined(matrix: DataFrame, k: int = RECOMMENDATIONS_PER_USER) -> DataFrame:
    """`user_cf` for catalogues of any size: every user meets every content that shares a user with theirs."""
    affinity = _both_ways(content_affinity(matrix), "affinity")
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy("user_id")))
    unit = matrix.select("user_id", "content_id", (F.col("weight") / norm).alias("unit"))
    parts = sharded_join(unit, affinity, ["content_id"], F.col("user_id")).select(
        "user_id", F.col("candidate").alias("content_id"), (F.col("unit") * F.col("affinity")).alias("score")
    )
    scores = _unknown(parts, matrix)
    mine = Window.partitionBy("user_id")
    low, high = F.min("score").over(mine), F.max("score").over(mine)
    spread = F.try_divide(F.col("score") - low, high - low)
    scaled = scores.select("user_id", "content_id", F.coalesce(spread, F.lit(1.0)).alias("score"))
    return _ranked(scaled, k)


def similar_users(matrix: DataFrame, user_id: str, n: int = 10) -> DataFrame:
    """The `n` users most similar to one user, by cosine of their interaction weights."""
    mine = matrix.where(F.col("user_id") == user_id).select("content_id", F.col("weight").alias("mine"))
    per_user = matrix.join(mine, "content_id", "left").groupBy("user_id").agg(
        F.sum(F.col("weight") * F.col("mine")).alias("dot"),
        F.sum(F.col("weight") * F.col("weight")).alias("norm"),
    )
    own = matrix.where(F.col("user_id") == user_id).agg(F.sum(F.col("weight") * F.col("weight"))).scalar()
    cosine = F.col("dot") / F.sqrt(F.col("norm").cast("double") * own)
    return (
        per_user.where((F.col("user_id") != user_id) & F.col("dot").isNotNull())
        .select("user_id", F.round(cosine, SCORE_DECIMALS).alias("similarity"))
        .orderBy(F.desc("similarity"), "user_id")
        .limit(n)
    )


def dense_ids(df: DataFrame, column: str, buckets: int = 4096) -> DataFrame:
    """A unique `int` for each value of a column, the same on every run.

    Values are numbered inside hash buckets, each by its own task; nothing is
    collected to number them.
    """
    bucket = F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")
    values = df.select(column).distinct().withColumn("__bucket", bucket)
    number = F.row_number().over(Window.partitionBy("__bucket").orderBy(column)) - 1
    return values.select(column, (number * buckets + F.col("__bucket")).alias(f"{column}_no"))


def als_recommendations(
    matrix: DataFrame, k: int = RECOMMENDATIONS_PER_USER, rank: int = 10, iterations: int = 5, seed: int = 42
) -> DataFrame:
    """Model-based collaborative filtering for user counts where exact scoring costs too much.

    Runs the model at once. Contents that the user knows are left out. Where the catalogue's factors fit every task (see
    `plans.products`), users are scored in blocks, all at once too, and only their lists are written. Larger catalogues meet the users
    block by block, as Spark's model has it.
    """
    from pyspark.ml.recommendation import ALS

    users, contents = dense_ids(matrix, "user_id"), dense_ids(matrix, "content_id")
    numbered = matrix.join(users, "user_id").join(contents, "content_id")
    als = ALS(
        rank=rank, maxIter=iterations, implicitPrefs=True, seed=seed, coldStartStrategy="drop",
        userCol="user_id_no", itemCol="content_id_no", ratingCol="weight",
    )
    if matrix.isEmpty():
        return matrix.select("user_id", "content_id", F.lit(0.0).alias("score"), F.lit(1).alias("rank")).where(F.lit(False))
    model = als.fit(numbered.select("user_id_no", "content_id_no", F.col("weight").cast("float").alias("weight")))
    items = catalogue(matrix, "content_id")
    if items is None:
        return als_crossed(model, numbered, users, contents, k)
    found = model.itemFactors.join(contents, F.col("id") == F.col("content_id_no")).select("content_id", "features").collect()
    lines = {r.content_id: r.features for r in found}
    factors = np.array([lines[item] for item in items], np.float32)
    profiles = rows_of(matrix, "user_id", "content_id").join(users, "user_id").join(model.userFactors, F.col("user_id_no") == F.col("id"))
    best = materialize(best_by_factors(profiles, "user_id", factors, items, k), "als-lists")
    return best.withColumnRenamed("item", "content_id")


def als_crossed(model, numbered: DataFrame, users: DataFrame, contents: DataFrame, k: int) -> DataFrame:
    """`als_recommendations` for catalogues of any size.

    Users are scored in groups by how many contents they know, in powers of two, so that each is asked for `k` and at most twice
    as many more as it knows itself, and the best `k` of the others stay.
    """
    grouped = numbered.groupBy("user_id_no").agg(F.ceil(F.log2(F.count(F.lit(1)))).cast("int").alias("level"))
    grouped = materialize(grouped, "als-users")
    # As many levels as a count of contents has binary digits.
    levels = [r.level for r in grouped.select("level").distinct().orderBy("level").collect()]
    offers = [model.recommendForUserSubset(grouped.where(F.col("level") == level).select("user_id_no"), k + 2**level) for level in levels]
    lists = reduce(DataFrame.unionByName, offers).select("user_id_no", F.posexplode("recommendations").alias("position", "item"))
    flat = lists.select(
        "user_id_no", F.col("item.content_id_no").alias("content_id_no"),
        F.col("item.rating").cast("double").alias("score"), (F.col("position") + 1).alias("rank"),
    )
    named = flat.join(users, "user_id_no").join(contents, "content_id_no")
    unknown = named.join(numbered.select("user_id", "content_id"), ["user_id", "content_id"], "left_anti")
    order = Window.partitionBy("user_id").orderBy("rank", "content_id")
    ranked = unknown.select("user_id", "content_id", "score", F.row_number().over(order).alias("rank"))
    return ranked.where(F.col("rank") <= k)


def session_visits(events: DataFrame) -> DataFrame:
    """Which session of which user touched which content, and when last."""
    return events.groupBy("session_id", "user_id", "content_id").agg(F.max("timestamp_ts").alias("last_ts"))


def cooccurrence(visits: DataFrame) -> DataFrame:
    """In how many sessions two contents appear together, per pair (left < right)."""
    pairs = group_pairs(visits.select("session_id", "user_id", "content_id"), ["session_id", "user_id"], "content_id")
    return pairs.groupBy("left_content_id", "right_content_id").agg(F.count(F.lit(1)).alias("sessions"))


def session_based(visits: DataFrame, k: int = RECOMMENDATIONS_PER_USER) -> DataFrame:
    """Contents that share sessions with those of the user's latest session.

    A content's score is the sum, over the contents of that session, of the
    sessions both share divided by the sessions the latter has. `visits` is read
    several times; keep it as a table. As in `user_cf`, users are scored where they are if the catalogue allows it.
    """
    items = catalogue(visits, "content_id")
    if items is None:
        return session_based_joined(visits, k)
    sessions = materialize(
        rows_of(visits, ["session_id", "user_id"], "content_id").join(
            visits.groupBy("session_id", "user_id").agg(F.max("last_ts").alias("last_ts")), ["session_id", "user_id"]
        ),
        "session-rows",
    )
    together = gram(sessions, items)
    support = {r.content_id: r.support for r in visits.groupBy("content_id").agg(F.count(F.lit(1)).alias("support")).collect()}
    part = together / np.array([support[item] for item in items])[:, None] if items else together
    newest = sessions.groupBy("user_id").agg(F.max_by(F.struct("items", "weights"), F.struct("last_ts", "session_id")).alias("last"))
    best = best_products(newest.select("user_id", "last.*"), "user_id", part, items, k, SCORE_DECIMALS)
    return best.withColumnRenamed("item", "content_id")


def session_based_joined(visits: DataFrame, k: int = RECOMMENDATIONS_PER_USER) -> DataFrame:
    """`session_based` for catalogues of any size."""
    support = visits.groupBy("content_id").agg(F.count(F.lit(1)).alias("support"))
    together = _both_ways(cooccurrence(visits), "sessions").join(support, "content_id").select(
        "content_id", "candidate", (F.col("sessions") / F.col("support")).alias("part")
    )
    latest = visits.groupBy("user_id").agg(F.max(F.struct("last_ts", "session_id")).alias("last")).select(
        "user_id", F.col("last.session_id").alias("session_id")
    )
    current = visits.join(latest, ["user_id", "session_id"]).select("user_id", "content_id")
    parts = sharded_join(current, together, ["content_id"], F.col("user_id")).select(
        "user_id", F.col("candidate").alias("content_id"), F.col("part").alias("score")
    )
    return _ranked(_unknown(parts, current), k)


def popularity(matrix: DataFrame) -> DataFrame:
    """Total interaction weight per content."""
    return matrix.groupBy("content_id").agg(F.sum("weight").alias("score"))


def popular(popular_scores: DataFrame, k: int = RECOMMENDATIONS_PER_USER) -> DataFrame:
    """The `k` contents of most weight."""
    return popular_scores.orderBy(F.desc("score"), "content_id").limit(k)


def popular_by_genre(popular_scores: DataFrame, contents: DataFrame, k: int = RECOMMENDATIONS_PER_USER) -> DataFrame:
    """The `k` contents of most weight in each genre; contents nobody touched weigh 0."""
    return _ranked(_all_scored(contents.select("content_id", "genre"), popular_scores), k, by="genre")


def _top_list(scored: DataFrame, k: int) -> Column:
    """The `k` best contents as one array value for the whole query, best first."""
    best = popular(scored, k).agg(
        F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "content_id"))).alias("items")
    )
    plain = F.transform(
        "items", lambda item: F.struct(item["content_id"].alias("content_id"), (-item["minus"]).alias("score"))
    )
    return best.select(plain).scalar()


def popular_for_all(users: DataFrame, popular_scores: DataFrame, k: int = RECOMMENDATIONS_PER_USER) -> DataFrame:
    """The most popular contents for every user."""
    listed = users.select("user_id", F.posexplode(_top_list(popular_scores, k)).alias("position", "item"))
    return listed.select("user_id", "item.*", (F.col("position") + 1).alias("rank"))


def _all_scored(contents: DataFrame, popular_scores: DataFrame) -> DataFrame:
    """All contents with their popularity; contents nobody touched weigh 0."""
    return contents.join(popular_scores, "content_id", "left").withColumn("score", F.coalesce("score", F.lit(0)))


def preference_match(
    users: DataFrame, contents: DataFrame, popular_scores: DataFrame, k: int = RECOMMENDATIONS_PER_USER
) -> DataFrame:
    """Contents of the user's favourite genres, the most popular first.

    Where no content matches, all contents are eligible. `eligible` counts the
    contents that were to choose from. Only the best `k` of each genre meet the
    users: the best of several genres are among the best of each.
    """
    best = popular_by_genre(popular_scores, contents, k).select("genre", "content_id", "score")
    sizes = contents.groupBy("genre").agg(F.count(F.lit(1)).alias("genre_size"))
    listed = best.groupBy("genre").agg(F.collect_list(F.struct("content_id", "score")).alias("best")).join(sizes, "genre")
    wanted = users.select("user_id", F.explode(F.array_distinct("favorite_categories")).alias("genre"))
    matched = wanted.join(listed, "genre").groupBy("user_id").agg(
        F.sum("genre_size").alias("eligible"), F.flatten(F.collect_list("best")).alias("items")
    )
    everything = _top_list(_all_scored(contents.select("content_id"), popular_scores), k)
    total = contents.agg(F.count(F.lit(1))).scalar()
    chosen = users.select("user_id").join(matched, "user_id", "left").select(
        "user_id",
        F.coalesce("eligible", total).alias("eligible"),
        F.coalesce("items", everything).alias("items"),
    )
    scored = chosen.select("user_id", "eligible", F.inline("items"))
    return _ranked(scored, k)


def blend(sources: dict[str, DataFrame], k: int = RECOMMENDATIONS_PER_USER) -> DataFrame:
    """Fill each user's list from the sources in their order, each by its own rank.

    A content several sources offer counts for the first. Adds `algorithm` and a
    `reason` in words.
    """
    reasons = {
        COLLABORATIVE: "people with a similar history watched this",
        SESSION: "goes with what you watched last",
        PREFERENCE: "in a genre you like",
        POPULAR: "popular now",
    }
    # Place and rank as one number; names and reasons follow from the place, so they are put in at the end.
    offers = [
        df.select(
            "user_id", "content_id", F.col("score").cast("double").alias("score"),
            (F.lit(place).cast("long") * RANKS + F.col("rank").cast("long")).alias("standing"),
        )
        for place, (name, df) in enumerate(sources.items())
    ]
    # By user at once: a content's offers come from different sources, so nothing combines before the shuffle.
    all_offers = reduce(DataFrame.unionByName, offers).repartition("user_id")
    first = all_offers.groupBy("user_id", "content_id").agg(
        F.min_by("score", "standing").alias("score"), F.min("standing").alias("standing")
    )
    order = Window.partitionBy("user_id").orderBy("standing", "content_id")
    best = first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    def named(texts: list[str]) -> Column:
        return F.get(F.array(*[F.lit(text) for text in texts]), F.floor(F.col("standing") / RANKS).cast("int"))

    return best.select(
        "user_id", "content_id", "score", named(list(sources)).alias("algorithm"),
        named([reasons.get(name, name) for name in sources]).alias("reason"), "rank",
    )


def latest_recommendations(recommendations: DataFrame, n: int = RECOMMENDATIONS_PER_USER) -> DataFrame:
    """The latest `n` recommended contents of every user, ranked from 1, each by its latest recommendation."""
    again = Window.partitionBy("user_id", "content_id").orderBy(F.desc("created_at"), F.desc("recommendation_score"))
    recommendations = recommendations.withColumn("rank", F.row_number().over(again)).where(F.col("rank") == 1)
    order = Window.partitionBy("user_id").orderBy(
        F.desc("created_at"), F.desc("recommendation_score"), "content_id"
    )
    return recommendations.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def cached_or_stored(
    cached: DataFrame, stored: DataFrame, now: Column, ttl_seconds: int = RECOMMENDATION_TTL_SECONDS
) -> DataFrame:
    """Each user's cached recommendations that are still fresh, or the stored ones where there are none."""
    oldest = now - F.make_dt_interval(secs=F.lit(ttl_seconds))
    fresh = cached.where((F.col("created_at") > oldest) & (F.col("created_at") <= now))
    rest = stored.join(fresh.select("user_id").distinct(), "user_id", "left_anti")
    columns = stored.columns
    return fresh.select(*columns, F.lit("cache").alias("served_from")).unionByName(
        rest.select(*columns, F.lit("store").alias("served_from"))
    )


def as_recommendations(lists: DataFrame, algorithm: str, now: Column) -> DataFrame:
    """Scored lists as rows of the recommendations table."""
    return lists.select(
        "user_id", "content_id", F.col("score").cast(T.DoubleType()).alias("recommendation_score"),
        F.lit(algorithm).alias("algorithm"), ab_group(F.col("user_id")).alias("ab_test_group"), now.alias("created_at"),
    )
