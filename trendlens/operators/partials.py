"""Reports from partial states of each month.

A load replaces the states of the months it touches, in the commit that replaces their
rows; so what an upsert replaces or removes leaves every sum, count, histogram and
ranking. A report unites the states of all months and reads no observation. Counts,
sums, best and first rows unite exactly; distinct channels do so exactly from the
cells, or from small sketches with an error of about ``1.04 / sqrt(2 ** LOG_K)``.
"""

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.functions import times
from trendlens.functions.rates import ratio_plus_one
from trendlens.operators import engagement, timing
from trendlens.operators.category import ID, NAME, total_views
from trendlens.operators.clean import cast_metrics
from trendlens.operators.dedup import keep_best, keep_first
from trendlens.operators.enrich import with_category_name, with_days_to_trend, with_engagement
from trendlens.schema import WEEKDAYS

METRICS = {"views": "view_count_num", "likes": "likes_num", "dislikes": "dislikes_num", "comments": "comment_count_num"}
LOG_K = 12
VIDEO = ("video_id", "title", "channelTitle", ID, "publishedAt", "trending_date", *METRICS.values())

State = Callable[[DataFrame, str], DataFrame]


def cells(obs: DataFrame, part: str) -> DataFrame:
    """Rows, videos, sums and known values of each category and channel."""
    sums = {f"sum_{n}": F.sum(c) for n, c in METRICS.items()} | {f"n_{n}": F.count(c) for n, c in METRICS.items()}
    return cast_metrics(obs).groupBy(part, ID, "channelTitle").agg(
        F.count("*").alias("rows"), F.count("video_id").alias("videos"), *[c.alias(n) for n, c in sums.items()]
    )


def hours(obs: DataFrame, part: str) -> DataFrame:
    """Rows of each publish hour, publish weekday and trending weekday."""
    day = lambda c: times.weekday_index(F.col(c))
    keys = {"publish_hour": F.hour("publishedAt"), "publish_day": day("publishedAt"), "trending_day": day("trending_date")}
    return obs.groupBy(part, *[c.alias(n) for n, c in keys.items()]).agg(F.count("*").alias("rows"))


def spans(obs: DataFrame, part: str) -> DataFrame:
    """First and last sighting of each video under each category."""
    return obs.groupBy(part, "video_id", ID).agg(F.min("trending_date").alias("first_seen"), F.max("trending_date").alias("last_seen"))


def sketches(obs: DataFrame, part: str) -> DataFrame:
    """A sketch of the channels of each category."""
    return obs.groupBy(part, ID).agg(F.hll_sketch_agg("channelTitle", LOG_K).alias("channels"))


def best(tie: tuple[str, ...]) -> State:
    """The most viewed row of each video."""

    def state(obs: DataFrame, part: str) -> DataFrame:
        rows = cast_metrics(obs).select(part, *dict.fromkeys((*VIDEO, *tie)))
        return keep_best(rows, (part, "video_id"), "view_count_num", tie)

    return state


def first(tie: tuple[str, ...]) -> State:
    """The first row of each video."""

    def state(obs: DataFrame, part: str) -> DataFrame:
        rows = cast_metrics(obs).select(part, *dict.fromkeys((*VIDEO, *tie)))
        return keep_first(rows, (part, "video_id"), tie=[t for t in tie if t != "trending_date"])

    return state


def states(tie: tuple[str, ...] = ("trending_date",)) -> dict[str, State]:
    """What a load derives from the rows of a month, by table; ``tie`` orders a video's equal rows."""
    return {"cells": cells, "hours": hours, "spans": spans, "sketches": sketches, "best": best(tie), "first": first(tie)}


# --- reports ----------------------------------------------------------------------


def _named(per_id: DataFrame, *measures: str) -> DataFrame:
    return with_category_name(per_id).select(ID, NAME, *measures)


def counts(cells: DataFrame) -> DataFrame:
    return _named(cells.groupBy(ID).agg(F.sum("rows").alias("count")), "count")


def shares(cells: DataFrame) -> DataFrame:
    rows = counts(cells)
    total = rows.agg(F.sum("count").alias("_total"))
    return rows.join(F.broadcast(total)).withColumn("percentage", F.try_divide("count", "_total") * 100).drop("_total")


def unique_channels(cells: DataFrame) -> DataFrame:
    return _named(cells.groupBy(ID).agg(F.count_distinct("channelTitle").alias("unique_channels")), "unique_channels")


def estimated_channels(sketches: DataFrame) -> DataFrame:
    per_id = sketches.groupBy(ID).agg(F.hll_sketch_estimate(F.hll_union_agg("channels")).alias("unique_channels"))
    return _named(per_id, "unique_channels")


def estimated_total_channels(sketches: DataFrame) -> DataFrame:
    return sketches.agg(F.hll_sketch_estimate(F.hll_union_agg("channels")).alias("total_channels"))


def _mean(name: str) -> Column:
    return F.try_divide(F.sum(f"sum_{name}"), F.sum(f"n_{name}"))


def average_metrics(cells: DataFrame) -> DataFrame:
    means = [f"avg_{n}" for n in ("likes", "dislikes", "comments", "views")]
    return _named(cells.groupBy(ID).agg(*[_mean(m.removeprefix("avg_")).alias(m) for m in means]), *means)


def channel_concentration(cells: DataFrame) -> DataFrame:
    per_name = with_category_name(cells).groupBy(NAME).agg(F.sum("videos").alias("total_videos"), F.count_distinct("channelTitle").alias("unique_channels"))
    return per_name.withColumn("videos_per_channel", F.try_divide("total_videos", "unique_channels"))


def like_dislike_ratio(cells: DataFrame) -> DataFrame:
    per_name = with_category_name(cells).groupBy(NAME).agg(F.sum("sum_likes").alias("total_likes"), F.sum("sum_dislikes").alias("total_dislikes"))
    return per_name.withColumn("like_dislike_ratio", ratio_plus_one(F.col("total_likes"), F.col("total_dislikes")))


def per_publish_hour(hours: DataFrame) -> DataFrame:
    return hours.groupBy("publish_hour").agg(F.sum("rows").alias("count"))


def per_weekday(hours: DataFrame, day: str) -> DataFrame:
    return hours.groupBy(F.col(day).alias("_day")).agg(F.sum("rows").alias("count")).select(times.weekday_label(F.col("_day")).alias(day), "count")


def hour_by_weekday(hours: DataFrame) -> DataFrame:
    days = {d: F.coalesce(F.sum(F.when(F.col("publish_day") == i, F.col("rows"))), F.lit(0)) for i, d in enumerate(WEEKDAYS)}
    return hours.groupBy("publish_hour").agg(*[c.alias(d) for d, c in days.items()])


def lifespan(spans: DataFrame) -> DataFrame:
    days = F.datediff(F.max("last_seen"), F.min("first_seen")) + 1
    per_video = with_category_name(spans).groupBy("video_id", NAME).agg(days.alias("days"))
    return per_video.groupBy(NAME).agg(F.avg("days").alias("avg_trending_lifespan"), timing.lower_median("days").alias("median_trending_lifespan"))


def reports(held: Mapping[str, DataFrame], tie: tuple[str, ...] = ("trending_date",)) -> dict[str, DataFrame]:
    """The reports, lazily, out of the state tables of all months."""
    entity = keep_best(held["best"], ("video_id",), "view_count_num", tie)
    rated = with_engagement(entity)
    first = with_days_to_trend(keep_first(held["first"], ("video_id",), tie=[t for t in tie if t != "trending_date"]))
    return {
        "category_counts": counts(held["cells"]),
        "category_shares": shares(held["cells"]),
        "total_views": total_views(entity),
        "unique_channels": unique_channels(held["cells"]),
        "average_metrics": average_metrics(held["cells"]),
        "channel_concentration": channel_concentration(held["cells"]),
        "like_dislike_ratio": like_dislike_ratio(held["cells"]),
        "publish_hours": per_publish_hour(held["hours"]),
        "publish_days": per_weekday(held["hours"], "publish_day"),
        "trending_days": per_weekday(held["hours"], "trending_day"),
        "time_to_trend": timing.time_to_trend(first),
        "days_distribution": timing.days_distribution(first),
        "same_day": timing.same_day(first),
        "hour_by_weekday": hour_by_weekday(held["hours"]),
        "engagement_bands": engagement.bands(rated),
        "time_to_trend_per_category": timing.time_to_trend_per_category(first),
        "metrics_per_publish_hour": timing.metrics_per_publish_hour(entity),
        "lifespan": lifespan(held["spans"]),
        "rates_per_category": engagement.rates_per_category(rated),
        "engagement_totals": engagement.totals(rated),
    }
