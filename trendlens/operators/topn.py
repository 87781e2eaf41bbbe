"""Sorted reports. With a total order the n rows are the same on every run."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.functions.times import weekday_position


def top_n(
    df: DataFrame,
    metric: str,
    n: int,
    cols: Sequence[str] = (),
    tie: Sequence[str] = ("video_id",),
) -> DataFrame:
    """The ``n`` rows with the largest ``metric``.

    Sort and limit together need no full sort: each task keeps ``n`` rows.
    """
    order = [F.col(metric).desc_nulls_last(), *[F.col(t).asc() for t in tie]]
    top = df.orderBy(*order).limit(n)
    return top.select(*cols) if cols else top


def newest(
    df: DataFrame,
    ts: str = "trending_date",
    n: int = 5,
    cols: Sequence[str] = (),
    tie: Sequence[str] = ("video_id",),
) -> DataFrame:
    return top_n(df, ts, n, cols, tie)


def order_weekday(df: DataFrame, day: str) -> DataFrame:
    """Monday to Sunday."""
    return df.orderBy(weekday_position(F.col(day)))


def preview(df: DataFrame, n: int = 5, order=None) -> DataFrame:
    """Any ``n`` rows, or the first ``n`` under ``order``."""
    return (df if order is None else df.orderBy(*order)).limit(n)


def one_row(*frames: DataFrame) -> DataFrame:
    """One-row frames with columns of their own, side by side in one row.

    Stacks them with the missing columns NULL and takes the known value of each, so
    no join is needed.
    """
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in stacked.columns]
    )
