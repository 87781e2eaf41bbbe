"""Cleaning of raw observations."""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.functions.text import present, tag_list
from trendlens.functions.times import format_time, is_iso, parse_iso
from trendlens.schema import COUNTERS, NO_DESCRIPTION, UNUSED_COLUMNS


def drop_columns(df: DataFrame, names: Iterable[str] = UNUSED_COLUMNS) -> DataFrame:
    return df.drop(*names)


def keep_keyed(df: DataFrame, key: str = "video_id") -> DataFrame:
    return df.filter(present(F.col(key)))


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.na.drop(how="all")


def keep_valid_dates(df: DataFrame, col: str = "trending_date") -> DataFrame:
    return df.filter(is_iso(F.col(col)))


def fill_missing(df: DataFrame, values: dict) -> DataFrame:
    return df.fillna(values)


def parse_dates(df: DataFrame, cols=("trending_date", "publishedAt")) -> DataFrame:
    return df.withColumns({c: parse_iso(F.col(c)) for c in cols})


def cast_metrics(df: DataFrame, cols=COUNTERS, to: str = "bigint", suffix="_num") -> DataFrame:
    """Counters as numbers in ``<name>_num``; text that is no number gives NULL."""
    return df.withColumns({c + suffix: F.col(c).try_cast(to) for c in cols})


def cast_counters(df: DataFrame) -> DataFrame:
    """Counters and category id in place, as the clean table stores them."""
    numbers = {c: F.col(c).try_cast("bigint") for c in COUNTERS}
    return df.withColumns({**numbers, "categoryId": F.col("categoryId").try_cast("int")})


def clean(df: DataFrame) -> DataFrame:
    """Raw observations to the clean table, in one pass without a shuffle."""
    kept = keep_valid_dates(drop_empty_rows(drop_columns(df)))
    filled = fill_missing(kept, {"description": NO_DESCRIPTION})
    return cast_counters(parse_dates(filled))


def with_tag_list(df: DataFrame, col: str = "tags") -> DataFrame:
    """The copy for model building: tags as an array."""
    return df.withColumn(col, tag_list(F.col(col)))


def times_as_text(df: DataFrame, cols=("trending_date", "publishedAt")) -> DataFrame:
    return df.withColumns({c: format_time(F.col(c)) for c in cols})
