"""Engagement reports over the entity view with its rates."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.operators.enrich import with_category_name

ID = "categoryId"
NAME = "category_name"


def bands(entity: DataFrame, rate: str = "engagement_rate", low=5, high=10) -> DataFrame:
    """Videos above, within and below the band, with their % of all videos.

    A NULL rate is in no band but stays in the total.
    """
    r = F.col(rate)
    tests = {"high": r > high, "medium": r.between(low, high), "low": r < low}
    wide = entity.agg(
        F.count("*").alias("total"), *[F.count_if(t).alias(b) for b, t in tests.items()]
    )
    rows = [
        F.struct(
            F.lit(b).alias("band"),
            F.col(b).alias("count"),
            (F.try_divide(F.col(b), F.col("total")) * 100).alias("percentage"),
        )
        for b in tests
    ]
    return wide.select(F.inline(F.array(*rows)))


def rates_per_category(entity: DataFrame) -> DataFrame:
    rates = ("engagement_rate", "like_rate", "comment_rate", "dislike_rate")
    per_id = entity.groupBy(ID).agg(
        *[F.avg(r).alias("avg_" + r) for r in rates],
        F.count("video_id").alias("video_count"),
    )
    return (
        with_category_name(per_id)
        .select(ID, NAME, *["avg_" + r for r in rates], "video_count")
        .orderBy(F.col("avg_engagement_rate").desc_nulls_last(), ID)
    )


def totals(entity: DataFrame) -> DataFrame:
    return entity.agg(
        F.count("*").alias("total_videos"),
        F.sum("view_count_num").alias("total_views"),
        F.sum("likes_num").alias("total_likes"),
        F.sum("comment_count_num").alias("total_comments"),
        F.avg("engagement_rate").alias("avg_engagement_rate"),
    )


LEADERS = {
    "most_viewed": "view_count_num",
    "most_engaging": "engagement_rate",
    "most_liked": "likes_num",
}


def interaction_summary(
    entity: DataFrame,
    count_of: str = "Music",
    rate_of: str = "Comedy",
    key: str = "video_id",
) -> DataFrame:
    """One row: totals, leading videos, leading category and two named categories.

    The entity view, costly to make, is read once: it is reduced to one row per
    category, and those few rows give everything else. The smaller key wins a tie.
    """

    def best(metric: str) -> Column:
        m = F.col(metric)
        entry = F.struct((-m).alias("order"), F.col(key), "title", m.alias("value"))
        return F.min(F.when(m.isNotNull(), entry))

    per_id = entity.groupBy(ID).agg(
        F.count("*").alias("videos"),
        *[F.sum(c).alias(c) for c in ("view_count_num", "likes_num", "comment_count_num")],
        F.sum("engagement_rate").alias("rates"),
        F.count("engagement_rate").alias("rated"),
        *[best(metric).alias(name) for name, metric in LEADERS.items()],
    )
    rate = F.try_divide("rates", "rated")
    named = with_category_name(per_id).withColumn("rate", rate)
    name = F.col(NAME)
    row = named.agg(
        F.sum("videos").alias("total_videos"),
        F.sum("view_count_num").alias("total_views"),
        F.sum("likes_num").alias("total_likes"),
        F.sum("comment_count_num").alias("total_comments"),
        F.try_divide(F.sum("rates"), F.sum("rated")).alias("avg_engagement_rate"),
        *[F.min(leader).alias(leader) for leader in LEADERS],
        F.max_by(name, F.struct("rate", -F.col(ID))).alias("top_category"),
        F.max("rate").alias("top_category_rate"),
        F.max(F.when(name == count_of, F.col("videos"))).alias("named_count"),
        F.max(F.when(name == rate_of, F.col("rate"))).alias("named_rate"),
    )
    leaders = [
        c
        for leader, metric in LEADERS.items()
        for c in (
            F.col(leader)["title"].alias(leader),
            F.col(leader)["value"].alias(f"{leader}_{metric}"),
        )
    ]
    others = [c for c in row.columns if c not in LEADERS]
    return row.select(*others, *leaders)
