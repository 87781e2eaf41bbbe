"""Reads over the output tables; each is a top-k without a full sort.

Those that take a root read one version, and of it the newest folders that can hold the
answer, as the manifest tells.
"""

from pyspark.sql import DataFrame, SparkSession

from trendlens.operators.topn import top_n
from trendlens.streaming import sinks, versions
from trendlens.streaming.sinks import latest_batch


def latest_observations(df: DataFrame, n: int = 100) -> DataFrame:
    return top_n(df, "processing_timestamp", n, tie=("video_id", "trending_date"))


def top_predictions(df: DataFrame, n: int = 10) -> DataFrame:
    return top_n(latest_batch(df), "predicted_views", n)


def latest_category_stats(df: DataFrame, n: int = 20) -> DataFrame:
    return top_n(df, "timestamp", n, tie=("categoryId",))


def newest_parts(parts: list[dict], n: int) -> list[dict]:
    """The fewest folders that are sure to hold the ``n`` newest rows, newest first.

    Rows count as certain once no folder left out can hold a row as new as they are.
    """
    queue = sorted(parts, key=lambda p: p["newest"], reverse=True)
    taken: list[dict] = []
    for p in queue:
        if sum(q["rows"] for q in taken if q["oldest"] > p["newest"]) >= n:
            break
        taken.append(p)
    return taken


def newest(spark: SparkSession, root: str, table: str, n: int, state: dict | None = None) -> DataFrame:
    """Rows of a table among which its ``n`` newest are."""
    state = state or versions.current(spark, root)
    return versions.frame(spark, root, table, state, newest_parts(state["tables"][table]["parts"], n))


def read_observations(spark: SparkSession, root: str, n: int = 100) -> DataFrame:
    return latest_observations(newest(spark, root, sinks.REALTIME, n), n)


def read_category_stats(spark: SparkSession, root: str, n: int = 20) -> DataFrame:
    return latest_category_stats(newest(spark, root, sinks.CATEGORY_STATS, n), n)


def read_predictions(spark: SparkSession, root: str, n: int = 10) -> DataFrame:
    """The table holds the newest batch alone."""
    return top_n(versions.frame(spark, root, sinks.PREDICTIONS), "predicted_views", n)
