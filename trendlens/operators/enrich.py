"""Derived columns."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.functions import times
from trendlens.functions.rates import percent_of
from trendlens.schema import CATEGORY_NAMES, UNKNOWN_CATEGORY


def category_dimension(spark: SparkSession) -> DataFrame:
    """The fixed category table as literal rows."""
    rows = ", ".join(f"({i}, '{name}')" for i, name in CATEGORY_NAMES.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(_category, category_name)")


def with_category_name(
    df: DataFrame, dim: DataFrame | None = None, key: str = "categoryId"
) -> DataFrame:
    """Adds ``category_name``, "Unknown" for ids outside the dimension.

    The built-in dimension has 14 fixed rows, so it is broadcast. A dimension passed
    in (columns ``key``, ``category_name``, unique ids) can have any size: no hint,
    Spark picks the join by what it measures.
    """
    if dim is None:
        right = F.broadcast(category_dimension(df.sparkSession))
    else:
        right = dim.select(F.col(key).alias("_category"), "category_name")
    joined = df.join(right, F.col(key) == F.col("_category"), "left").drop("_category")
    return joined.withColumn(
        "category_name", F.coalesce("category_name", F.lit(UNKNOWN_CATEGORY))
    )


def with_time_parts(
    df: DataFrame, published: str = "publishedAt", seen: str = "trending_date"
) -> DataFrame:
    p, s = F.col(published), F.col(seen)
    return df.withColumns(
        {
            "publish_hour": F.hour(p),
            "publish_day": times.weekday_name(p),
            "publish_date": F.to_date(p),
            "trending_day": times.weekday_name(s),
            "trending_month": F.month(s),
            "trending_year": F.year(s),
        }
    )


def with_days_to_trend(
    df: DataFrame, published: str = "publishedAt", seen: str = "trending_date"
) -> DataFrame:
    return df.withColumn(
        "days_to_trend", times.days_between(F.col(seen), F.col(published))
    )


def with_engagement(
    df: DataFrame,
    views: str = "view_count_num",
    likes: str = "likes_num",
    dislikes: str = "dislikes_num",
    comments: str = "comment_count_num",
) -> DataFrame:
    """Total engagement and the four rates in % of views, NULL at zero views."""
    v = F.col(views)
    total = F.col(likes) + F.col(dislikes) + F.col(comments)
    return df.withColumns(
        {
            "total_engagement": total,
            "like_rate": percent_of(F.col(likes), v),
            "dislike_rate": percent_of(F.col(dislikes), v),
            "comment_rate": percent_of(F.col(comments), v),
            "engagement_rate": percent_of(total, v),
        }
    )
