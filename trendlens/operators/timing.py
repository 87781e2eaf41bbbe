"""Reports on publish times, trending days and time to trend.

Weekdays are grouped as numbers and named on the few result rows. Medians are the
lower middle element and exact: days are small whole numbers, so the state of
``percentile_disc`` is one counter per distinct day count, however many rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.functions import times
from trendlens.operators.enrich import with_category_name
from trendlens.operators.topn import order_weekday
from trendlens.schema import WEEKDAYS

NAME = "category_name"


def lower_median(col: str) -> Column:
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {col})").cast("int")


def per_publish_hour(obs: DataFrame, published: str = "publishedAt") -> DataFrame:
    return (
        obs.groupBy(F.hour(published).alias("publish_hour"))
        .agg(F.count("*").alias("count"))
        .orderBy("publish_hour")
    )


def per_weekday(
    obs: DataFrame, ts: str, name: str, calendar_order: bool = False
) -> DataFrame:
    """Rows per weekday of ``ts``, largest first or Monday to Sunday."""
    per_day = (
        obs.groupBy(times.weekday_index(F.col(ts)).alias("_day"))
        .agg(F.count("*").alias("count"))
        .select(times.weekday_label(F.col("_day")).alias(name), "count")
    )
    if calendar_order:
        return order_weekday(per_day, name)
    return per_day.orderBy(F.desc("count"), times.weekday_position(F.col(name)))


def extremes(report: DataFrame, key: str, rank: str | None = None) -> DataFrame:
    """Peak and low group of a counted report; the first in key order wins a tie.

    ``rank`` names a numeric column to order by where the key itself is text.
    """
    place = F.col(rank or key)
    n = F.col("count")
    return report.agg(
        F.max_by(key, F.struct(n, -place)).alias("peak_" + key),
        F.max("count").alias("peak_count"),
        F.min_by(key, F.struct(n, place)).alias("low_" + key),
        F.min("count").alias("low_count"),
    )


def weekday_extremes(report: DataFrame, day: str) -> DataFrame:
    ranked = report.withColumn("_place", times.weekday_position(F.col(day)))
    return extremes(ranked, day, "_place")


def time_to_trend(first: DataFrame, days: str = "days_to_trend") -> DataFrame:
    return first.agg(
        F.avg(days).alias("avg_days"),
        lower_median(days).alias("median_days"),
        F.min(days).alias("min_days"),
        F.max(days).alias("max_days"),
    )


def days_distribution(first: DataFrame, n: int = 30, days: str = "days_to_trend") -> DataFrame:
    return first.groupBy(days).agg(F.count("*").alias("count")).orderBy(days).limit(n)


def same_day(first: DataFrame, days: str = "days_to_trend") -> DataFrame:
    hits = F.count_if(F.col(days) == 0)
    return first.agg(
        hits.alias("same_day"),
        F.count("*").alias("total"),
        (F.try_divide(hits, F.count("*")) * 100).alias("pct"),
    )


def hour_by_weekday(obs: DataFrame, published: str = "publishedAt") -> DataFrame:
    """Hours down, Mon..Sun across, 0 where nothing was published."""
    return (
        obs.select(
            F.hour(published).alias("publish_hour"),
            times.weekday_index(F.col(published)).alias("_day"),
        )
        .groupBy("publish_hour")
        .pivot("_day", list(range(7)))
        .agg(F.count(F.lit(1)))
        .na.fill(0, [str(i) for i in range(7)])
        .select(
            "publish_hour", *[F.col(str(i)).alias(d) for i, d in enumerate(WEEKDAYS)]
        )
        .orderBy("publish_hour")
    )


def busiest_cell(obs: DataFrame, published: str = "publishedAt") -> DataFrame:
    """The hour and weekday with most rows; ties go to the earlier hour, then day."""
    cells = obs.groupBy(
        F.hour(published).alias("h"), times.weekday_index(F.col(published)).alias("d")
    ).agg(F.count("*").alias("n"))
    place = F.struct("n", -F.col("h"), -F.col("d"))
    return cells.agg(
        F.max_by("h", place).alias("publish_hour"),
        F.max_by("d", place).alias("_day"),
        F.max("n").alias("count"),
    ).select(
        "publish_hour", times.weekday_label(F.col("_day")).alias("publish_day"), "count"
    )


def time_to_trend_per_category(first: DataFrame, days: str = "days_to_trend") -> DataFrame:
    return (
        with_category_name(first)
        .groupBy(NAME)
        .agg(
            F.avg(days).alias("avg_days_to_trend"),
            lower_median(days).alias("median_days_to_trend"),
        )
        .orderBy("avg_days_to_trend", NAME)
    )


def metrics_per_publish_hour(entity: DataFrame, published: str = "publishedAt") -> DataFrame:
    return (
        entity.groupBy(F.hour(published).alias("publish_hour"))
        .agg(
            F.avg("view_count_num").alias("avg_views"),
            F.avg("likes_num").alias("avg_likes"),
            F.avg("comment_count_num").alias("avg_comments"),
        )
        .orderBy("publish_hour")
    )


def lifespan(obs: DataFrame, seen: str = "trending_date") -> DataFrame:
    """Mean and median days between a video's first and last sighting, inclusive.

    A video counts once per category name it was seen under.
    """
    per_video = (
        with_category_name(obs)
        .groupBy("video_id", NAME)
        .agg((F.datediff(F.max(seen), F.min(seen)) + 1).alias("days_on_trending"))
    )
    return (
        per_video.groupBy(NAME)
        .agg(
            F.avg("days_on_trending").alias("avg_trending_lifespan"),
            lower_median("days_on_trending").alias("median_trending_lifespan"),
        )
        .orderBy(F.col("avg_trending_lifespan").desc_nulls_last(), NAME)
    )
