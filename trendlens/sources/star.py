"""Observations derived from the star-schema tables, as FIXTURES.md maps them.

One row per line item; its part plays the video.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.schema import ISO_FORMAT, NO_DESCRIPTION

# Declared, so that no job has to read file footers before a query is planned.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
}

# Category of a video by its number modulo 16; 29 and 43 are outside the dimension.
CATEGORY_CYCLE = (1, 2, 10, 15, 17, 19, 20, 22, 23, 24, 25, 26, 27, 28, 29, 43)

# Unique together within one video: the total order behind every "row kept".
TIE = ("trending_date", "l_orderkey", "l_linenumber", "l_suppkey")

# The videos are broadcast up to this many rows, about 100 bytes each; beyond it the
# join shuffles. Their number is counted from the file footers.
BROADCAST_VIDEOS = 500_000

_BAD_DATE = "l_linenumber = 7 AND l_orderkey % 10 = 0"
_VIEWS = """CASE WHEN l_orderkey % 97 = 0 THEN 0L
  WHEN l_partkey % 50 = 0 THEN CAST(round(l_extendedprice * 100) AS BIGINT) * 100
  ELSE CAST(round(l_extendedprice * 100) AS BIGINT) END"""
_PUBLISHED = "timestampadd(HOUR, -CAST(l_partkey % 240 AS INT), first_ship)"
_CYCLE = ", ".join(str(c) for c in CATEGORY_CYCLE)
_COLUMNS = {
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "l_suppkey": "l_suppkey",
    "video_id": "video_id",
    "title": "concat(p_name, ' ', l_partkey)",
    "channelTitle": "p_brand",
    "publishedAt": _PUBLISHED,
    "trending_date": "l_shipdate",
    "categoryId": f"get(array({_CYCLE}), CAST(l_partkey % 16 AS INT))",
    "tags": """CASE WHEN l_partkey % 7 = 0 THEN '[none]'
      ELSE concat('"', p_brand, '"|"', p_type, '"') END""",
    "view_count": "views",
    "likes": "views * CAST(round(l_discount * 100) AS BIGINT) div 100",
    "dislikes": "views * CAST(round(l_tax * 100) AS BIGINT) div 1000",
    "comment_count": "views * CAST(l_quantity AS BIGINT) div 1000",
    "description": "CASE WHEN l_linenumber <> 1 THEN concat('about ', p_name) END",
}

_VIDEO_COUNTS: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _video_count(spark: SparkSession, sf_dir: str) -> int:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _VIDEO_COUNTS:
        _VIDEO_COUNTS[key] = table(spark, sf_dir, "part").count()
    return _VIDEO_COUNTS[key]


def _videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per video, with the first day it was seen.

    The first sighting is a partial aggregate joined back, not a window, so a video
    holding a third of all rows never meets in one task. Queries that do not use
    ``publishedAt`` lose this join and the second scan, as it is unique on its key.
    """
    first_seen = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.expr("concat('v', l_partkey)").alias("seen_video"))
        .agg(F.min("l_shipdate").alias("first_ship"))
    )
    parts = table(spark, sf_dir, "part").selectExpr("*", "concat('v', p_partkey) AS video_id")
    return parts.join(first_seen, F.expr("video_id = seen_video"), "left")


def _mapped(
    spark: SparkSession,
    sf_dir: str,
    rows: DataFrame,
    broadcast_up_to: int,
    deal: int | None = None,
    **changes: str,
) -> DataFrame:
    """Line items with their video, mapped to observation columns.

    Few videos are broadcast. Many are shuffled: they come out of :func:`_videos`
    keyed by the text id while this join is on the number, so both of its sides sit
    directly on a shuffle of their own, the shape in which adaptive execution can
    split the line items of a hot video over many tasks. ``deal`` is into how many tasks
    line items go that the join does not shuffle.
    """
    videos = _videos(spark, sf_dir)
    if _video_count(spark, sf_dir) <= broadcast_up_to:
        videos = F.broadcast(videos)
        rows = rows.repartition(deal) if deal else rows
    joined = rows.join(videos, F.expr("l_partkey = p_partkey"))
    columns = {**_COLUMNS, **changes}
    return joined.selectExpr("*", f"{_VIEWS} AS views").selectExpr(
        *[f"{expression} AS {name}" for name, expression in columns.items()]
    )


def raw_observations(
    spark: SparkSession,
    sf_dir: str,
    broadcast_up_to: int = BROADCAST_VIDEOS,
    deal: int | None = None,
) -> DataFrame:
    """Uncleaned rows: times as text, some of them broken; over ``deal`` tasks if given, or
    as many as the join with the videos makes."""
    iso = ISO_FORMAT.replace("'", "\\'")
    return _mapped(
        spark,
        sf_dir,
        table(spark, sf_dir, "lineitem"),
        broadcast_up_to,
        deal,
        publishedAt=f"date_format({_PUBLISHED}, '{iso}')",
        trending_date=f"""CASE WHEN {_BAD_DATE} THEN 'bad-date'
          ELSE date_format(l_shipdate, '{iso}') END""",
    )


def observations(
    spark: SparkSession, sf_dir: str, broadcast_up_to: int = BROADCAST_VIDEOS
) -> DataFrame:
    """The cleaned table in its stored, typed form.

    Equal to cleaning :func:`raw_observations` (a test holds them together), without
    printing and parsing every time: what a report reads once cleaning has run.
    """
    rows = table(spark, sf_dir, "lineitem").filter(f"NOT ({_BAD_DATE})")
    filled = f"coalesce({_COLUMNS['description']}, '{NO_DESCRIPTION}')"
    return _mapped(spark, sf_dir, rows, broadcast_up_to, description=filled)
