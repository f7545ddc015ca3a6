"""Recommendation and A/B-test queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalog.sqltext import CONTENTS, EV, RECS, USERS, ab, with_
from watchlens.operators import experiment, neighbours, recommend as ops
from watchlens.operators.tables import fill_defaults
from watchlens.schemas import TABLES
from watchlens.session import materialize
from watchlens.sources import testbed
from watchlens.sources.testbed import without_some

NOW = "2024-01-20 00:05:00"
HORIZON_DAYS = 7


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return testbed.user_events(spark, folder)


def _matrix(spark: SparkSession, folder: str) -> DataFrame:
    return materialize(ops.interactions(_events(spark, folder)), "interactions")


def _visits(spark: SparkSession, folder: str) -> DataFrame:
    return materialize(ops.session_visits(_events(spark, folder)), "visits")


def _popularity(spark: SparkSession, folder: str) -> DataFrame:
    return materialize(ops.popularity(ops.interactions(_events(spark, folder))), "popularity")


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in columns})


def _now() -> Column:
    return F.expr(f"TIMESTAMP_NTZ'{NOW}'")


def user_cf_topk(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(ops.user_cf(_matrix(spark, folder)), "score")


def recommendation_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Collaborative lists as the recommendations table stores them."""
    lists = ops.as_recommendations(ops.user_cf(_matrix(spark, folder)), ops.COLLABORATIVE, _now())
    return _rounded(fill_defaults(lists, TABLES["recommendations"]), "recommendation_score")


def similar_users(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(ops.similar_users(_matrix(spark, folder), "user-00007"), "similarity")


def als_topk(spark: SparkSession, folder: str) -> DataFrame:
    return ops.als_recommendations(_matrix(spark, folder))


def als_check(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold of every user's model-based list, whatever the model found."""
    matrix = _matrix(spark, folder)
    lists = materialize(ops.als_recommendations(matrix), "als")
    known = matrix.select("user_id", "content_id", F.lit(1).alias("known"))
    before = F.lag("score").over(Window.partitionBy("user_id").orderBy("rank"))
    judged = lists.withColumn("falling", F.coalesce(F.col("score") <= before, F.lit(True)))
    judged = judged.join(known, ["user_id", "content_id"], "left")
    return judged.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("list_size"),
        (F.count_distinct("content_id") == F.count(F.lit(1))).alias("all_different"),
        ((F.min("rank") == 1) & (F.max("rank") == F.count(F.lit(1)))).alias("ranks_whole"),
        F.sum(F.coalesce("known", F.lit(0))).alias("known"),
        F.min("falling").alias("falling"),
    )


def session_recs(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(ops.session_based(_visits(spark, folder)), "score")


def popular_by_genre(spark: SparkSession, folder: str) -> DataFrame:
    return ops.popular_by_genre(ops.popularity(ops.interactions(_events(spark, folder))), testbed.contents(spark, folder))


def _preference(spark: SparkSession, folder: str, scores: DataFrame) -> DataFrame:
    users = testbed.user_profiles(spark, folder)
    # Every seventh user likes a genre that no content has.
    odd = F.substring_index("user_id", "-", -1).cast("int") % 7 == 0
    users = users.withColumn("favorite_categories", F.when(odd, F.array(F.lit("OPERA"))).otherwise(F.col("favorite_categories")))
    return ops.preference_match(users, testbed.contents(spark, folder), scores)


def blended_recs(spark: SparkSession, folder: str) -> DataFrame:
    matrix = _matrix(spark, folder)
    scores = materialize(ops.popularity(matrix), "popularity")
    sources = {
        ops.COLLABORATIVE: ops.user_cf(matrix),
        ops.SESSION: ops.session_based(_visits(spark, folder)),
        ops.PREFERENCE: _preference(spark, folder, scores),
        ops.POPULAR: ops.popular_for_all(testbed.user_profiles(spark, folder), scores),
    }
    return _rounded(ops.blend(sources), "score")


def latest_recs(spark: SparkSession, folder: str) -> DataFrame:
    latest = ops.latest_recommendations(testbed.recommendations(spark, folder))
    return latest.select("user_id", "content_id", "created_at", "recommendation_score", "rank")


def recs_ttl_fallback(spark: SparkSession, folder: str) -> DataFrame:
    stored = materialize(testbed.recommendations(spark, folder), "recommendations")
    cached = stored.where(F.col("algorithm") == ops.COLLABORATIVE)
    served = ops.cached_or_stored(cached, stored, _now())
    return served.select("user_id", "content_id", "created_at", "served_from")


def _attributed(spark: SparkSession, folder: str) -> DataFrame:
    return experiment.attribute(testbed.recommendations(spark, folder), _events(spark, folder), HORIZON_DAYS * 86400)


def rec_attribution(spark: SparkSession, folder: str) -> DataFrame:
    return _attributed(spark, folder).select("user_id", "content_id", "created_at", "is_clicked", "is_watched")


def _metrics(spark: SparkSession, folder: str) -> DataFrame:
    outcomes = materialize(_attributed(spark, folder), "outcomes")
    return experiment.group_metrics(outcomes, _now())


def ab_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_metrics(spark, folder), "metric_value")


def ab_compare(spark: SparkSession, folder: str) -> DataFrame:
    compared = experiment.compare(_metrics(spark, folder))
    return _rounded(compared, "value_a", "value_b", "difference", "lift", "z", "p_value")


def ab_assignment(spark: SparkSession, folder: str) -> DataFrame:
    groups = spark.createDataFrame(
        [("algorithm_v1", "collaborative_filtering", True), ("algorithm_v2", "session_based", False)],
        "group_name string, algorithm string, is_active boolean",
    )
    users = testbed.user_profiles(spark, folder).select("user_id")
    return experiment.assign(users, groups)


def precision_at_10(spark: SparkSession, folder: str) -> DataFrame:
    return experiment.precision_at(_attributed(spark, folder))


def nearest_users(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(neighbours.nearest_users(_matrix(spark, folder), 5), "similarity")


def _diversity(spark: SparkSession, folder: str, contents: DataFrame) -> DataFrame:
    lists = ops.latest_recommendations(testbed.recommendations(spark, folder))
    return _rounded(experiment.diversity(lists, contents), "diversity")


def rec_diversity(spark: SparkSession, folder: str) -> DataFrame:
    return _diversity(spark, folder, testbed.contents(spark, folder))


def rec_diversity_some(spark: SparkSession, folder: str) -> DataFrame:
    """With a catalogue in which contents are missing."""
    return _diversity(spark, folder, without_some(testbed.contents(spark, folder)))


QUERIES = {
    "interactions": lambda spark, folder: ops.interactions(_events(spark, folder)),
    "user_cf_topk": user_cf_topk,
    "recommendation_rows": recommendation_rows,
    "similar_users": similar_users,
    "als_topk": als_topk,
    "als_check": als_check,
    "session_cooccurrence": lambda spark, folder: ops.cooccurrence(_visits(spark, folder)),
    "session_recs": session_recs,
    "popular_contents": lambda spark, folder: ops.popular(ops.popularity(ops.interactions(_events(spark, folder)))),
    "popular_by_genre": popular_by_genre,
    "preference_match": lambda spark, folder: _preference(spark, folder, _popularity(spark, folder)),
    "blended_recs": blended_recs,
    "latest_recs": latest_recs,
    "recs_ttl_fallback": recs_ttl_fallback,
    "ab_assignment": ab_assignment,
    "rec_attribution": rec_attribution,
    "ab_metrics": ab_metrics,
    "ab_compare": ab_compare,
    "rec_diversity": rec_diversity,
    "rec_diversity_some": rec_diversity_some,
    "nearest_users": nearest_users,
    "precision_at_10": precision_at_10,
}

WEIGHT = """CASE event_type WHEN 'click' THEN 1 WHEN 'watchlist' THEN 2 WHEN 'watch' THEN 3
  WHEN 'rating' THEN 3 WHEN 'watch_complete' THEN 5 ELSE 0 END"""
MATRIX = f"matrix AS (SELECT user_id, content_id, CAST(sum({WEIGHT}) AS BIGINT) AS weight FROM ev GROUP BY ALL)"
POP = f"pop AS (SELECT content_id, CAST(sum({WEIGHT}) AS BIGINT) AS score FROM ev GROUP BY 1)"
# Written as users with users, the way the definition reads.
CF = """norms AS (SELECT user_id, sqrt(sum(weight * weight)) AS norm FROM matrix GROUP BY 1),
sims AS (SELECT a.user_id AS u, b.user_id AS v, sum(a.weight * b.weight) / (min(n.norm) * min(m.norm)) AS sim
  FROM matrix a JOIN matrix b ON a.content_id = b.content_id AND a.user_id <> b.user_id
  JOIN norms n ON n.user_id = a.user_id JOIN norms m ON m.user_id = b.user_id GROUP BY ALL),
cf_raw AS (SELECT u AS user_id, content_id, sum(sim * weight) AS raw FROM sims JOIN matrix ON v = user_id
  WHERE NOT EXISTS (SELECT 1 FROM matrix k WHERE k.user_id = u AND k.content_id = matrix.content_id) GROUP BY ALL),
cf AS (SELECT user_id, content_id, score, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, content_id) AS rank
  FROM (SELECT user_id, content_id, CASE WHEN max(raw) OVER w = min(raw) OVER w THEN 1.0::DOUBLE
        ELSE (raw - min(raw) OVER w) / (max(raw) OVER w - min(raw) OVER w) END AS score
        FROM cf_raw WINDOW w AS (PARTITION BY user_id)))"""
COOC = """sc AS (SELECT DISTINCT session_id, content_id FROM ev),
cooc AS (SELECT a.content_id AS left_content_id, b.content_id AS right_content_id, count(*) AS sessions
  FROM sc a JOIN sc b ON a.session_id = b.session_id AND a.content_id < b.content_id GROUP BY ALL)"""
SB = """support AS (SELECT content_id, count(*) AS support FROM sc GROUP BY 1),
latest AS (SELECT user_id, arg_max(session_id, ts) AS session_id FROM ev GROUP BY 1),
cur AS (SELECT DISTINCT user_id, content_id FROM latest JOIN ev USING (user_id, session_id)),
both_ways AS (SELECT left_content_id AS c, right_content_id AS x, sessions FROM cooc
  UNION ALL SELECT right_content_id, left_content_id, sessions FROM cooc),
sb AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, content_id) AS rank FROM (
  SELECT user_id, x AS content_id, sum(sessions / support) AS score
  FROM cur JOIN both_ways ON c = content_id JOIN support ON support.content_id = c
  WHERE NOT EXISTS (SELECT 1 FROM cur k WHERE k.user_id = cur.user_id AND k.content_id = x) GROUP BY ALL))"""
PREF = """fav AS (SELECT DISTINCT user_id, CASE WHEN CAST(split_part(user_id, '-', 2) AS INTEGER) % 7 = 0 THEN 'OPERA' ELSE genre END AS genre
  FROM (SELECT user_id, unnest(favorites) AS genre FROM users)),
scored AS (SELECT content_id, genre, coalesce(score, 0) AS score FROM contents LEFT JOIN pop USING (content_id)),
matched AS (SELECT user_id, content_id, score FROM fav JOIN scored USING (genre)),
eligible AS (SELECT * FROM matched UNION ALL
  SELECT user_id, content_id, score FROM users, scored WHERE user_id NOT IN (SELECT user_id FROM matched)),
pref AS (SELECT * FROM (SELECT user_id, content_id, score, count(*) OVER (PARTITION BY user_id) AS eligible,
  row_number() OVER (PARTITION BY user_id ORDER BY score DESC, content_id) AS rank FROM eligible) WHERE rank <= 10)"""
ATTR = f"""attr AS (SELECT recs.*,
  EXISTS (SELECT 1 FROM ev WHERE ev.user_id = recs.user_id AND ev.content_id = recs.content_id AND event_type = 'click'
          AND ev.ts BETWEEN recs.created_at AND recs.created_at + INTERVAL '{HORIZON_DAYS} days') AS is_clicked,
  EXISTS (SELECT 1 FROM ev WHERE ev.user_id = recs.user_id AND ev.content_id = recs.content_id
          AND event_type IN ('watch', 'watch_complete')
          AND ev.ts BETWEEN recs.created_at AND recs.created_at + INTERVAL '{HORIZON_DAYS} days') AS is_watched
  FROM recs),
one AS (SELECT user_id, ab_test_group, content_id, max(is_watched) AS is_watched, max(recommendation_score) AS recommendation_score,
  arg_max(created_at, (recommendation_score, created_at)) AS created_at FROM attr GROUP BY ALL),
best AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY recommendation_score DESC, created_at DESC, content_id) AS rank FROM one),
prec AS (SELECT user_id, ab_test_group, count(*) FILTER (is_watched) / 10 AS precision FROM best WHERE rank <= 10 GROUP BY ALL)"""
METRICS = f"""metrics AS (
  SELECT ab_test_group AS test_group, 'click_rate' AS metric_name, avg(CAST(is_clicked AS INTEGER)) AS metric_value, count(*) AS sample_size FROM attr GROUP BY 1
  UNION ALL SELECT ab_test_group, 'watch_rate', avg(CAST(is_watched AS INTEGER)), count(*) FROM attr GROUP BY 1
  UNION ALL SELECT ab_test_group, 'precision@10', avg(precision), count(*) FROM prec GROUP BY 1)"""
_TTL = f"TIMESTAMP '{NOW}' - INTERVAL '600 seconds'"

ORACLE = {
    "interactions": with_(EV, MATRIX) + "SELECT * FROM matrix",
    "user_cf_topk": with_(EV, MATRIX, CF) + """SELECT user_id, content_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank
FROM cf WHERE rank <= 10""",
    "recommendation_rows": with_(EV, MATRIX, CF) + f"""SELECT user_id, content_id, round(score, 6) AS recommendation_score,
  'collaborative_filtering' AS algorithm, {ab('user_id')} AS ab_test_group, false AS is_clicked, false AS is_watched,
  TIMESTAMP '{NOW}' AS created_at FROM cf WHERE rank <= 10""",
    "similar_users": with_(EV, MATRIX) + """SELECT b.user_id, round(sum(a.weight * b.weight) / sqrt(
    (SELECT sum(weight * weight)::DOUBLE FROM matrix WHERE user_id = 'user-00007') *
    (SELECT sum(weight * weight)::DOUBLE FROM matrix n WHERE n.user_id = b.user_id)), 6) AS similarity
FROM matrix a JOIN matrix b ON a.content_id = b.content_id AND a.user_id = 'user-00007' AND b.user_id <> 'user-00007'
GROUP BY b.user_id ORDER BY similarity DESC, b.user_id LIMIT 10""",
    "als_check": with_(EV) + """SELECT user_id, CAST(least(10, (SELECT count(DISTINCT content_id) FROM ev) - count(DISTINCT content_id)) AS BIGINT) AS list_size,
  true AS all_different, true AS ranks_whole, CAST(0 AS BIGINT) AS known, true AS falling
FROM ev GROUP BY 1 HAVING count(DISTINCT content_id) < (SELECT count(DISTINCT content_id) FROM ev)""",
    "session_cooccurrence": with_(EV, COOC) + "SELECT * FROM cooc",
    "session_recs": with_(EV, COOC, SB) + """SELECT user_id, content_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank
FROM sb WHERE rank <= 10""",
    "popular_contents": with_(EV, POP) + "SELECT content_id, score FROM pop ORDER BY score DESC, content_id LIMIT 10",
    "popular_by_genre": with_(EV, CONTENTS, POP) + """SELECT content_id, genre, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT content_id, genre, coalesce(score, 0) AS score,
    row_number() OVER (PARTITION BY genre ORDER BY coalesce(score, 0) DESC, content_id) AS rank
  FROM contents LEFT JOIN pop USING (content_id)) WHERE rank <= 10""",
    "preference_match": with_(EV, USERS, CONTENTS, POP, PREF) + """SELECT user_id, content_id, score, eligible,
  CAST(rank AS INTEGER) AS rank FROM pref""",
    "blended_recs": with_(EV, USERS, CONTENTS, MATRIX, CF, COOC, SB, POP, PREF, """offers AS (
  SELECT user_id, content_id, score::DOUBLE AS score, 0 AS place, rank, 'collaborative_filtering' AS algorithm,
    'people with a similar history watched this' AS reason FROM cf WHERE rank <= 10
  UNION ALL SELECT user_id, content_id, score, 1, rank, 'session_based', 'goes with what you watched last' FROM sb WHERE rank <= 10
  UNION ALL SELECT user_id, content_id, score, 2, rank, 'preference', 'in a genre you like' FROM pref
  UNION ALL SELECT user_id, content_id, score, 3, rank, 'popularity', 'popular now' FROM users, (
    SELECT *, row_number() OVER (ORDER BY score DESC, content_id) AS rank FROM pop) WHERE rank <= 10),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, content_id ORDER BY place, rank) AS first FROM offers) WHERE first = 1)""")
    + """SELECT user_id, content_id, round(score, 6) AS score, algorithm, reason, CAST(r AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY place, rank, content_id) AS r FROM one) WHERE r <= 10""",
    "latest_recs": with_(RECS) + """SELECT user_id, content_id, created_at, recommendation_score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY created_at DESC, recommendation_score DESC, content_id) AS rank
  FROM (SELECT * FROM recs QUALIFY row_number() OVER (PARTITION BY user_id, content_id ORDER BY created_at DESC, recommendation_score DESC) = 1))
WHERE rank <= 10""",
    "recs_ttl_fallback": with_(RECS, f"""fresh AS (SELECT * FROM recs WHERE algorithm = 'collaborative_filtering'
  AND created_at > {_TTL} AND created_at <= TIMESTAMP '{NOW}')""") + """SELECT user_id, content_id, created_at, 'cache' AS served_from FROM fresh
UNION ALL SELECT user_id, content_id, created_at, 'store' FROM recs WHERE user_id NOT IN (SELECT user_id FROM fresh)""",
    "ab_assignment": with_(USERS, f"l AS (SELECT user_id, {ab('user_id')} AS ab_test_group FROM users)") + """SELECT user_id, ab_test_group,
  CASE ab_test_group WHEN 'A' THEN 'algorithm_v1' ELSE 'algorithm_v2' END AS group_name,
  CASE ab_test_group WHEN 'A' THEN 'collaborative_filtering' END AS group_algorithm FROM l""",
    "rec_attribution": with_(EV, RECS, ATTR) + "SELECT user_id, content_id, created_at, is_clicked, is_watched FROM attr",
    "ab_metrics": with_(EV, RECS, ATTR, METRICS) + f"""SELECT test_group, metric_name, round(metric_value, 6) AS metric_value, sample_size,
  TIMESTAMP '{NOW}' AS timestamp FROM metrics""",
    "ab_compare": with_(EV, RECS, ATTR, METRICS, """wide AS (SELECT a.metric_name, a.metric_value AS value_a, a.sample_size AS sample_a,
    b.metric_value AS value_b, b.sample_size AS sample_b
  FROM metrics a JOIN metrics b ON a.metric_name = b.metric_name AND a.test_group = 'A' AND b.test_group = 'B'),
pooled AS (SELECT *, (value_a * sample_a + value_b * sample_b) / (sample_a + sample_b) AS p FROM wide),
scored AS (SELECT *, CASE WHEN metric_name LIKE '%_rate' THEN
    (value_b - value_a) / sqrt(p * (1 - p) * (1.0::DOUBLE / sample_a + 1.0::DOUBLE / sample_b)) END AS z FROM pooled),
cdf AS (SELECT *, 1.0::DOUBLE / (1.0 + 0.2316419::DOUBLE * abs(z)) AS t FROM scored)""") + """SELECT metric_name, round(value_a, 6) AS value_a, sample_a,
  round(value_b, 6) AS value_b, sample_b, round(value_b - value_a, 6) AS difference,
  round((value_b - value_a) / value_a, 6) AS lift, round(z, 6) AS z,
  round(2 * exp(-z * z / 2) / sqrt(2 * pi()) * (0.319381530::DOUBLE * t - 0.356563782::DOUBLE * t ** 2 + 1.781477937::DOUBLE * t ** 3
    - 1.821255978::DOUBLE * t ** 4 + 1.330274429::DOUBLE * t ** 5), 6) AS p_value,
  least(sample_a, sample_b) >= 100 AS enough FROM cdf""",
    "rec_diversity": with_(CONTENTS, RECS, """l AS (SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY user_id ORDER BY created_at DESC, recommendation_score DESC, content_id) AS rank FROM (
    SELECT * FROM recs QUALIFY row_number() OVER (PARTITION BY user_id, content_id ORDER BY created_at DESC, recommendation_score DESC) = 1))
  WHERE rank <= 10),
c AS (SELECT user_id, coalesce(genre, 'Unknown') AS genre, count(*) AS n FROM l
  LEFT JOIN contents USING (content_id) GROUP BY ALL)""") + """SELECT user_id,
  CAST(sum(n) AS BIGINT) AS list_size,
  round(1 - CASE WHEN sum(n) > 1 THEN sum(n * (n - 1)) / (sum(n) * (sum(n) - 1)) END, 6) AS diversity FROM c GROUP BY 1""",
    "rec_diversity_some": with_(CONTENTS, RECS, """l AS (SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY user_id ORDER BY created_at DESC, recommendation_score DESC, content_id) AS rank FROM (
    SELECT * FROM recs QUALIFY row_number() OVER (PARTITION BY user_id, content_id ORDER BY created_at DESC, recommendation_score DESC) = 1))
  WHERE rank <= 10),
c AS (SELECT user_id, coalesce(genre, 'Unknown') AS genre, count(*) AS n FROM l
  LEFT JOIN (SELECT * FROM contents WHERE CAST(split_part(content_id, '-', 2) AS INTEGER) % 7 <> 0) USING (content_id) GROUP BY ALL)""") + """SELECT user_id,
  CAST(sum(n) AS BIGINT) AS list_size,
  round(1 - CASE WHEN sum(n) > 1 THEN sum(n * (n - 1)) / (sum(n) * (sum(n) - 1)) END, 6) AS diversity FROM c GROUP BY 1""",
    "nearest_users": with_(EV, MATRIX, CF.split(",\ncf_raw")[0]) + """SELECT u AS user_id, v AS neighbour, round(sim, 6) AS similarity, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY round(sim, 9) DESC, v) AS rank FROM sims) WHERE rank <= 5""",
    "precision_at_10": with_(EV, RECS, ATTR) + "SELECT * FROM prec",
}
