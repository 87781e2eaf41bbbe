"""Nested listing payloads to flat observations."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.functions.text import join_tags
from trendlens.functions.times import format_time
from trendlens.schema import ISO_FORMAT, LISTING_SCHEMA


def flatten_listing(df: DataFrame, json_col: str, snapshot: Column) -> DataFrame:
    """One row per listed item, stamped with the snapshot time.

    A missing counter counts as 0; comments are disabled where theirs is missing.
    """
    payload = F.from_json(F.col(json_col), LISTING_SCHEMA)
    items = df.select(
        snapshot.alias("snapshot"), F.explode(payload["items"]).alias("item")
    )
    snippet, stats = F.col("item.snippet"), F.col("item.statistics")

    def counter(name: str) -> Column:
        return F.coalesce(stats[name].try_cast("bigint"), F.lit(0).cast("bigint"))

    return items.select(
        F.col("item.id").alias("video_id"),
        snippet["title"].alias("title"),
        snippet["publishedAt"].alias("publishedAt"),
        snippet["channelId"].alias("channelId"),
        snippet["channelTitle"].alias("channelTitle"),
        snippet["categoryId"].alias("categoryId"),
        format_time(F.col("snapshot"), ISO_FORMAT).alias("trending_date"),
        join_tags(snippet["tags"]).alias("tags"),
        counter("viewCount").alias("view_count"),
        counter("likeCount").alias("likes"),
        F.lit(0).cast("bigint").alias("dislikes"),
        counter("commentCount").alias("comment_count"),
        snippet["thumbnails"]["default"]["url"].alias("thumbnail_link"),
        stats["commentCount"].isNull().alias("comments_disabled"),
        F.lit(False).alias("ratings_disabled"),
        snippet["description"].alias("description"),
    )
