"""Data-quality profiles, each in one pass over its input."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.functions.text import present
from trendlens.functions.times import is_iso


def invalid_dates(df: DataFrame, col: str = "trending_date") -> DataFrame:
    return df.filter(F.col(col).isNotNull() & ~is_iso(F.col(col))).select(col).distinct()


def known_values(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull()).select(col).distinct()


def validity(df: DataFrame, key: str = "video_id", date: str = "trending_date") -> DataFrame:
    """Rows with a key and rows with a well-formed date, against all of them."""
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_if(present(F.col(key))).alias("keyed_rows"),
        F.count(date).alias("dated_rows"),
        F.count_if(is_iso(F.col(date))).alias("valid_dates"),
    )


def profile(df: DataFrame) -> DataFrame:
    """One row: row and column count, then the NULLs of each column."""
    nulls = [F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    return df.agg(
        F.count("*").alias("row_count"), *nulls
    ).withColumn("column_count", F.lit(len(df.columns)))


def profile_columns(df: DataFrame) -> DataFrame:
    """The profile with one row per column: name, type, NULLs, rows."""
    types = dict(df.dtypes)
    wide = profile(df)
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(types[c]).alias("data_type"),
            F.col(c).alias("null_count"),
            F.col("row_count"),
        )
        for c in df.columns
    ]
    return wide.select(F.inline(F.array(*entries)))


def quality_band(
    df: DataFrame,
    min_views: int = 1_000,
    max_views: int = 50_000_000,
    views: str = "view_count",
    likes: str = "likes",
    comments: str = "comment_count",
) -> DataFrame:
    """Rows fit for training; both view bounds belong to the band."""
    return df.filter(
        F.col(views).between(min_views, max_views)
        & (F.col(likes) > 0)
        & (F.col(comments) >= 0)
    )


def drop_incomplete(df: DataFrame, cols) -> DataFrame:
    return df.na.drop(subset=list(cols))


def exclude_value(df: DataFrame, col: str, value) -> DataFrame:
    """Rows whose ``col`` is another value; unlike ``<>`` a NULL is kept."""
    return df.filter(~F.col(col).eqNullSafe(F.lit(value)))
