"""A/B tests of recommendation algorithms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchlens.functions.identity import ab_group
from watchlens.functions.weights import normal_cdf
from watchlens.schemas import GROUP_ALGORITHMS

METRICS = ("click_rate", "watch_rate", "precision@10")


def assign(users: DataFrame, groups: DataFrame) -> DataFrame:
    """Users with their A/B label and the active algorithm group it stands for; NULL where inactive."""
    name = F.lit(None)
    for label, group in GROUP_ALGORITHMS.items():
        name = F.when(F.col("ab_test_group") == label, group).otherwise(name)
    labelled = users.withColumn("ab_test_group", ab_group(F.col("user_id"))).withColumn("group_name", name)
    active = groups.where(F.col("is_active")).select("group_name", F.col("algorithm").alias("group_algorithm"))
    return labelled.join(active, "group_name", "left")


def attribute(recommendations: DataFrame, events: DataFrame, horizon_seconds: int = 7 * 86400) -> DataFrame:
    """Mark recommendations the same user clicked or watched within the horizon.

    Needs no range join: events shrink to the earliest and latest click and
    watch per (user, content, stretch of time as long as the horizon). A
    recommendation looks at its own stretch, where an event counts if the latest
    is not before it, and at the next, where one counts if the earliest is not
    past the horizon. Each side matches at most one row per stretch.
    """
    def stretch(ts: str) -> Column:
        epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
        return F.floor(F.timestamp_diff("MICROSECOND", epoch, F.col(ts).cast("timestamp_ntz")) / (horizon_seconds * 1000000))

    clicked = F.col("event_type") == "click"
    watched = F.col("event_type").isin("watch", "watch_complete")
    ts = F.col("timestamp_ts")
    summary = (
        events.where(clicked | watched)
        .groupBy("user_id", "content_id", stretch("timestamp_ts").alias("__stretch"))
        .agg(
            F.min(F.when(clicked, ts)).alias("__first_click"),
            F.max(F.when(clicked, ts)).alias("__last_click"),
            F.min(F.when(watched, ts)).alias("__first_watch"),
            F.max(F.when(watched, ts)).alias("__last_watch"),
        )
    )
    # A recommendation sees its stretch and the next one, so each summary row is
    # offered to both; a recommendation's row is never repeated.
    keys = ["user_id", "content_id", "__stretch"]
    own, ahead = ("__last_click", "__last_watch"), ("__first_click", "__first_watch")
    none = F.lit(None).cast(summary.schema["__first_click"].dataType)
    here = F.struct("__stretch", *own, *[none.alias(name) for name in ahead])
    nearby = F.struct((F.col("__stretch") - 1).alias("__stretch"), *[none.alias(name) for name in own], *ahead)
    offered = summary.select("user_id", "content_id", F.inline(F.array(here, nearby)))
    merged = offered.groupBy(*keys).agg(*[F.max(name).alias(name) for name in (*own, *ahead)])
    created = F.col("created_at")
    until = created + F.make_dt_interval(secs=F.lit(horizon_seconds))

    def outcome(kind: str) -> Column:
        same = F.col(f"__last_{kind}") >= created
        after = F.col(f"__first_{kind}") <= until
        return F.coalesce(same, F.lit(False)) | F.coalesce(after, F.lit(False))

    joined = recommendations.withColumn("__stretch", stretch("created_at")).join(merged, keys, "left")
    return joined.select(
        *[F.col(c) for c in recommendations.columns],
        outcome("click").alias("is_clicked"),
        outcome("watch").alias("is_watched"),
    )


def precision_at(attributed: DataFrame, k: int = 10) -> DataFrame:
    """Per user: watched contents among the `k` best recommended contents, divided by `k`.

    A content recommended several times is one content: its best recommendation ranks it, and it
    is watched if any of them was followed.
    """
    contents = attributed.groupBy("user_id", "ab_test_group", "content_id").agg(
        F.max(F.struct("recommendation_score", "created_at")).alias("best"), F.max("is_watched").alias("is_watched")
    )
    order = Window.partitionBy("user_id").orderBy(
        F.desc("best.recommendation_score"), F.desc("best.created_at"), "content_id"
    )
    best = contents.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    hits = F.count_if(F.col("is_watched"))
    return best.groupBy("user_id", "ab_test_group").agg((hits / k).alias("precision"))


def group_metrics(attributed: DataFrame, now: Column, k: int = 10) -> DataFrame:
    """Click rate, watch rate and precision of each group, one row per metric."""
    rates = attributed.groupBy("ab_test_group").agg(
        F.count(F.lit(1)).alias("sample_size"),
        F.avg(F.col("is_clicked").cast("int")).alias("click_rate"),
        F.avg(F.col("is_watched").cast("int")).alias("watch_rate"),
    )
    rows = rates.unpivot(["ab_test_group", "sample_size"], ["click_rate", "watch_rate"], "metric_name", "metric_value")
    precision = precision_at(attributed, k).groupBy("ab_test_group").agg(
        F.count(F.lit(1)).alias("sample_size"), F.avg("precision").alias("metric_value")
    ).withColumn("metric_name", F.lit(f"precision@{k}"))
    return rows.unionByName(precision).select(
        F.col("ab_test_group").alias("test_group"), "metric_name", "metric_value", "sample_size", now.alias("timestamp")
    )


def compare(metrics: DataFrame, minimum_sample: int = 100) -> DataFrame:
    """Groups A and B side by side per metric: difference, lift, and for rates the two-proportion z test.

    One row per metric; `enough` tells whether both samples reach the minimum.
    `z` and `p_value` are NULL where the metric is no proportion of its sample.
    """
    def side(group: str, column: str) -> Column:
        return F.max(F.when(F.col("test_group") == group, F.col(column)))

    wide = metrics.groupBy("metric_name").agg(
        side("A", "metric_value").alias("value_a"), side("A", "sample_size").alias("sample_a"),
        side("B", "metric_value").alias("value_b"), side("B", "sample_size").alias("sample_b"),
    )
    a, b, n, m = F.col("value_a"), F.col("value_b"), F.col("sample_a"), F.col("sample_b")
    pooled = (a * n + b * m) / (n + m)
    error = F.sqrt(pooled * (1 - pooled) * (1 / n + 1 / m))
    z = F.when(F.col("metric_name").endswith("_rate"), F.try_divide(b - a, error))
    return (
        wide.withColumn("difference", b - a)
        .withColumn("lift", F.try_divide(b - a, a))
        .withColumn("z", z)
        .withColumn("p_value", 2 * (1 - normal_cdf(F.abs("z"))))
        .withColumn("enough", F.least(n, m) >= minimum_sample)
    )


def diversity(lists: DataFrame, contents: DataFrame) -> DataFrame:
    """Per user: one minus the share of pairs in the list that are of one genre; NULL for lists of one.

    Contents that the catalogue does not have count as of genre `Unknown`; a content counts once.
    """
    listed = lists.select("user_id", "content_id").distinct()
    genres = listed.join(contents.select("content_id", "genre"), "content_id", "left")
    genres = genres.withColumn("genre", F.coalesce("genre", F.lit("Unknown")))
    counts = genres.groupBy("user_id", "genre").agg(F.count(F.lit(1)).alias("n"))
    size = F.sum("n")
    same = F.sum(F.col("n") * (F.col("n") - 1))
    return counts.groupBy("user_id").agg(
        size.alias("list_size"), (1 - F.try_divide(same, size * (size - 1))).alias("diversity")
    )
