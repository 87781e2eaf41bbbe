"""Ranking within groups, upsert and set operations.

Every ranking takes a tie-break that makes the order total, so reruns keep the same
rows. ``row_number() <= k`` is what lets Spark cut each group to ``k`` rows before
the shuffle; a hot group then moves ``k`` rows per task, not all of its rows.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank"
_SALT = "_salt"
# Above this the optimizer stops limiting groups ahead of the shuffle (its own
# spark.sql.optimizer.windowGroupLimitThreshold).
GROUP_LIMIT = 1000
SALTS = 256


def _ranked(df: DataFrame, keys, order: Sequence[Column], k: int) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn(_RANK, F.row_number().over(window))
        .filter(F.col(_RANK) <= k)
        .drop(_RANK)
    )


def top_k_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1
) -> DataFrame:
    """First ``k`` rows of each group under a total ``order``.

    A large ``k`` is first cut within salted parts of each group, so no task sorts a
    whole hot group.
    """
    if k > GROUP_LIMIT:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(SALTS))
        salted = df.withColumn(_SALT, salt)
        df = _ranked(salted, [*keys, _SALT], order, k).drop(_SALT)
    return _ranked(df, keys, order, k)


def keep_best(
    df: DataFrame,
    keys: Sequence[str] = ("video_id",),
    by: str = "view_count",
    tie: Sequence[str] = ("trending_date",),
) -> DataFrame:
    """The row with the largest ``by`` per key: the entity view."""
    order = [F.col(by).desc_nulls_last(), *[F.col(t).asc() for t in tie]]
    return top_k_per_group(df, keys, order)


def keep_first(
    df: DataFrame,
    keys: Sequence[str] = ("video_id",),
    by: str = "trending_date",
    tie: Sequence[str] = (),
) -> DataFrame:
    """The row with the smallest ``by`` per key: the first-trend view."""
    return top_k_per_group(df, keys, [F.col(c).asc() for c in (by, *tie)])


def append(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new, allowMissingColumns=True)


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def upsert_keep_last(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str] = ("video_id", "trending_date"),
    latest: Sequence[Column] = (),
    old_is_unique: bool = False,
    near: Sequence[str] = (),
) -> DataFrame:
    """History plus new rows, one row per key; new beats old.

    ``latest`` orders rows of equal age, the one to keep first. NULL keys count as
    equal. When the history already holds one row per key (it came from this
    function), only the new rows are ranked and the history is filtered by an anti
    join, which needs no shuffle of it while the new keys are small.

    ``near`` are columns among the keys, or that follow from them: rows equal in these go to
    one task and come out side by side, so what they share is compressed in a shuffle or a
    file that follows.
    """
    order = list(latest) or [F.col(c).desc_nulls_last() for c in new.columns]
    if old_is_unique:
        fresh = top_k_per_group(new, keys, order)
        right = fresh.select(*[F.col(k).alias("_new_" + k) for k in keys])
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col("_new_" + k))
        return append(old.join(right, same, "left_anti"), fresh)
    both = append(
        old.withColumn("_age", F.lit(1)), new.withColumn("_age", F.lit(0))
    )
    if near:
        both = both.repartition(*near)
    return top_k_per_group(both, list(dict.fromkeys((*near, *keys))), [F.col("_age").asc(), *order]).drop("_age")
