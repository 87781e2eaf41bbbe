"""Reports per category.

The name follows from the id, so reports keyed by id aggregate the ids alone and
name the few result rows. Reports keyed by name join first: several ids share
"Unknown". Counts run over observations, sums of views over the entity view.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlens.functions.rates import ratio_plus_one
from trendlens.operators.dedup import distinct_values, top_k_per_group
from trendlens.operators.enrich import with_category_name
from trendlens.operators.topn import one_row, top_n

ID = "categoryId"
NAME = "category_name"
BEST_VIDEO = (NAME, "title", "channelTitle", "view_count_num", "likes_num")


def _named(per_id: DataFrame, *measures: str) -> DataFrame:
    return with_category_name(per_id).select(ID, NAME, *measures)


def categories(obs: DataFrame) -> DataFrame:
    """The (id, name) pairs in use, by id."""
    return _named(distinct_values(obs, [ID])).orderBy(ID)


def _values(c: str) -> Column:
    return F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))


def distinct_counts(obs: DataFrame) -> DataFrame:
    """How many categories and channels there are; NULL counts as one value."""
    return obs.agg(
        _values(ID).alias("total_categories"), _values("channelTitle").alias("total_channels")
    )


def counts(obs: DataFrame) -> DataFrame:
    per_id = obs.groupBy(ID).agg(F.count("*").alias("count"))
    return _named(per_id, "count").orderBy(F.desc("count"), ID)


def shares(obs: DataFrame) -> DataFrame:
    """Counts with their percentage of all rows.

    The total is a window over the counted categories, a handful of rows, so the
    observations are read once.
    """
    total = F.sum("count").over(Window.partitionBy())
    share = F.try_divide(F.col("count"), total) * 100
    per_id = obs.groupBy(ID).agg(F.count("*").alias("count"))
    return _named(per_id.withColumn("percentage", share), "count", "percentage").orderBy(
        F.desc("count"), ID
    )


def top_shares(obs: DataFrame, n: int = 5) -> DataFrame:
    return top_n(shares(obs), "count", n, tie=(ID,))


def total_views(entity: DataFrame, views: str = "view_count_num") -> DataFrame:
    per_id = entity.groupBy(ID).agg(F.sum(views).alias("total_views"))
    return _named(per_id, "total_views").orderBy(F.col("total_views").desc_nulls_last(), ID)


def unique_channels(obs: DataFrame, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    per_id = obs.groupBy(ID).agg(count("channelTitle").alias("unique_channels"))
    return _named(per_id, "unique_channels").orderBy(F.desc("unique_channels"), ID)


def average_metrics(obs: DataFrame) -> DataFrame:
    means = {
        "avg_likes": "likes_num",
        "avg_dislikes": "dislikes_num",
        "avg_comments": "comment_count_num",
        "avg_views": "view_count_num",
    }
    per_id = obs.groupBy(ID).agg(*[F.avg(c).alias(name) for name, c in means.items()])
    return _named(per_id, *means).orderBy(F.col("avg_likes").desc_nulls_last(), ID)


def channel_concentration(obs: DataFrame) -> DataFrame:
    """Rows per distinct channel: high where few channels hold a category."""
    return (
        with_category_name(obs)
        .groupBy(NAME)
        .agg(
            F.count("video_id").alias("total_videos"),
            F.count_distinct("channelTitle").alias("unique_channels"),
        )
        .withColumn("videos_per_channel", F.try_divide("total_videos", "unique_channels"))
        .orderBy(F.col("videos_per_channel").desc_nulls_last(), NAME)
    )


def like_dislike_ratio(obs: DataFrame) -> DataFrame:
    per_id = obs.groupBy(ID).agg(F.sum("likes_num").alias("l"), F.sum("dislikes_num").alias("d"))
    likes, dislikes = F.col("total_likes"), F.col("total_dislikes")
    return (
        with_category_name(per_id)
        .groupBy(NAME)
        .agg(F.sum("l").alias("total_likes"), F.sum("d").alias("total_dislikes"))
        .withColumn("like_dislike_ratio", ratio_plus_one(likes, dislikes))
        .orderBy(F.col("like_dislike_ratio").desc_nulls_last(), NAME)
    )


def best_videos(entity: DataFrame, k: int = 1, tie=("video_id",)) -> DataFrame:
    """The ``k`` most viewed videos of each category."""
    order = [F.col("view_count_num").desc_nulls_last(), *[F.col(t).asc() for t in tie]]
    best = top_k_per_group(with_category_name(entity), [NAME], order, k)
    return best.orderBy(F.col("view_count_num").desc_nulls_last(), NAME).select(*BEST_VIDEO)


def summary(obs: DataFrame, entity: DataFrame) -> DataFrame:
    """One row: the leading category by each measure, and the totals.

    The observations are aggregated per category once for all of their measures;
    leaders and totals come from those few rows. Only the channels in total need a
    distinct count of their own.
    """

    def leader(measure: str) -> list[Column]:
        m = F.col(measure)
        return [
            F.max_by(NAME, F.struct(m, -F.col(ID))).alias("top_by_" + measure),
            F.max(m).alias(measure),
        ]

    per_id = obs.groupBy(ID).agg(
        F.count("*").alias("count"),
        F.count_distinct("channelTitle").alias("unique_channels"),
        F.avg("likes_num").alias("avg_likes"),
    )
    rows = with_category_name(per_id).agg(
        *leader("count"),
        (F.try_divide(F.max("count"), F.sum("count")) * 100).alias("percentage"),
        *leader("unique_channels"),
        *leader("avg_likes"),
        F.sum("count").alias("total_rows"),
        F.count("*").alias("total_categories"),
    )
    views = total_views(entity).agg(*leader("total_views"))
    channels = obs.agg(_values("channelTitle").alias("total_channels"))
    return one_row(rows, views, channels)


def date_range(obs: DataFrame, ts: str = "trending_date") -> DataFrame:
    return obs.agg(F.max(ts).alias("newest"), F.min(ts).alias("oldest"))
