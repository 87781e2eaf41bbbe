"""The growth model: sampling, features, split, training, scoring, metrics.

The label is a function of two of the features (views and engagement), so hold-out
figures look better than any forecast would; it is kept for parity. Nothing here
looks a day ahead, hence ``predicted_views`` and not "tomorrow".
"""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlens.functions.rates import (
    log_scale,
    power_of_ten,
    ratio_plus_one,
    smoothed_percent,
)
from trendlens.functions.times import epoch_seconds, weekday_number
from trendlens.operators.quality import drop_incomplete, quality_band
from trendlens.schema import FEATURES, LABEL
from trendlens.session import ensure_checkpoint_dir, scratch_path

HEX_DIGITS = 32
BEFORE_ALL = -(2**63)  # where rows without publish time sort
STEP_DIGITS = 4  # 65,536 groups at most per refinement
SMALL_BUCKET = 10_000


def row_hash(keys: Sequence[str]) -> Column:
    """Hex digest of the key columns: a repeatable, well mixed order of rows."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))


def hash_sample(df: DataFrame, keys: Sequence[str], fraction: float = 0.15) -> DataFrame:
    """A ``fraction`` of the rows, the same ones however the data is partitioned.

    Digests compare as text, so the cut is a prefix and costs no conversion.
    """
    cut = f"{min(int(fraction * 16**8), 16**8 - 1):08x}"
    return df if fraction >= 1 else df.filter(row_hash(keys) < cut)


def with_features(df: DataFrame) -> DataFrame:
    """The ten engineered features; the id is the eleventh. Training and serving
    both use this function."""
    views, likes, comments = (
        F.col(c).cast("double") for c in ("view_count", "likes", "comment_count")
    )
    hour = F.hour("publishedAt")
    day = weekday_number(F.col("publishedAt"))

    def flag(test: Column) -> Column:
        return F.when(test, 1.0).otherwise(0.0)

    return df.withColumns(
        {
            "engagement_rate": smoothed_percent(likes + comments, views),
            "like_rate": smoothed_percent(likes, views),
            "comment_rate": smoothed_percent(comments, views),
            "like_comment_ratio": ratio_plus_one(likes, comments),
            "view_scale": log_scale(views),
            "engagement_scale": log_scale(likes + comments),
            "publish_hour": hour,
            "day_of_week": day,
            "is_weekend": flag(day.isin(1, 7)),
            "is_prime_time": flag(hour.between(18, 23)),
        }
    )


def with_label(df: DataFrame) -> DataFrame:
    """log10(views + 1) * (1 + engagement rate / 100), from the features."""
    return df.withColumn(
        LABEL, F.col("view_scale") * (F.col("engagement_rate") / 100 + 1)
    )


def training_rows(df: DataFrame, keys: Sequence[str], fraction: float = 0.15) -> DataFrame:
    sample = hash_sample(df, keys, fraction)
    return with_label(with_features(quality_band(sample)))


# --- split by time ----------------------------------------------------------------


class Cut(NamedTuple):
    """Last training row: its publish second and, within that second, its digest."""

    second: int
    digest: str


def _publish_second(ts: str) -> Column:
    return F.coalesce(epoch_seconds(F.col(ts)), F.lit(BEFORE_ALL).cast("bigint"))


def _bucket_of_rank(rows: DataFrame, bucket: Column, rank: Column):
    """The bucket (b, n) that holds ``rank``, with the rows before it and the rank.

    Buckets are counted first; the window runs over their counts only.
    """
    hist = rows.groupBy(bucket.alias("b")).agg(F.count("*").alias("n"))
    running = F.sum("n").over(Window.orderBy("b"))
    ranked = hist.select("b", "n", (running - F.col("n")).alias("before")).withColumn(
        "total", F.sum("n").over(Window.partitionBy())
    )
    hit = ranked.withColumn("rank", rank).filter(
        (F.col("before") < F.col("rank")) & (F.col("rank") <= F.col("before") + F.col("n"))
    )
    return hit.first()


def find_cut(
    df: DataFrame, ts: str, keys: Sequence[str], fraction: float = 0.8
) -> Cut | None:
    """Where the first ``fraction`` of the rows by publish time ends.

    Runs a few counting jobs, each returning one row: days, then if need be the
    seconds of the day the boundary falls in, then digest prefixes within that
    second. A day, a second or a video may hold any share of the rows; every step
    counts with map-side aggregation, and only buckets of a few rows are ever sorted.
    ``keys`` must be unique. None means that no row is before the cut.
    """
    rows = df.select(_publish_second(ts).alias("s"), row_hash(keys).alias("h"))
    day = F.floor(F.col("s") / 86400)
    found = _bucket_of_rank(rows, day, F.floor(F.col("total") * fraction))
    if found is None:
        return None
    rows = rows.filter(day == found["b"])
    offset, size = int(found["rank"]) - found["before"], found["n"]

    if size > SMALL_BUCKET:
        found = _bucket_of_rank(rows, F.col("s"), F.lit(offset))
        rows = rows.filter(F.col("s") == found["b"])
        offset, size = offset - found["before"], found["n"]
    digits = 0
    while size > SMALL_BUCKET and digits < HEX_DIGITS:
        digits += STEP_DIGITS
        found = _bucket_of_rank(rows, F.substring("h", 1, digits), F.lit(offset))
        rows = rows.filter(F.col("h").startswith(found["b"]))
        offset, size = offset - found["before"], found["n"]
    if size > SMALL_BUCKET:  # rows of one digest, which no key parts: they stay together
        return Cut(rows.first()["s"], found["b"])
    last = rows.orderBy("s", "h").limit(offset).agg(F.max(F.struct("s", "h")).alias("m"))
    return Cut(*last.first()["m"])


def split_at(
    df: DataFrame, cut: Cut | None, ts: str, keys: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Rows up to the cut and rows after it: two filters, no sort and no shuffle."""
    if cut is None:
        return df.filter(F.lit(False)), df
    s = _publish_second(ts)
    at = F.when(s == cut.second, row_hash(keys) <= cut.digest).otherwise(s < cut.second)
    return df.filter(at), df.filter(~at)


def time_split(
    df: DataFrame, ts: str, keys: Sequence[str], fraction: float = 0.8
) -> tuple[DataFrame, DataFrame]:
    return split_at(df, find_cut(df, ts, keys, fraction), ts, keys)


# --- model ------------------------------------------------------------------------


def growth_pipeline(
    iterations: int = 50, depth: int = 6, step: float = 0.1, seed: int = 42
) -> Pipeline:
    # "keep" turns a missing feature into NaN instead of failing the whole batch;
    # training rows are complete, and scoring replaces what came from a NaN
    assembler = VectorAssembler(
        inputCols=list(FEATURES), outputCol="raw_features", handleInvalid="keep"
    )
    scaler = StandardScaler(
        inputCol="raw_features", outputCol="features", withStd=True, withMean=True
    )
    trees = GBTRegressor(
        featuresCol="features",
        labelCol=LABEL,
        predictionCol="prediction",
        maxIter=iterations,
        maxDepth=depth,
        stepSize=step,
        seed=seed,
    )
    return Pipeline(stages=[assembler, scaler, trees])


def train(
    rows: DataFrame, keys: Sequence[str], ts: str = "publishedAt", **settings
) -> tuple[PipelineModel, DataFrame]:
    """Fits on the first 80 % of :func:`training_rows`, and scores the rest, keys beside them.

    Finding the cut and growing trees read the rows many times, so the few columns are
    stored first, in a folder that stays while the scored rows are read. Read back, they come
    in partitions by their size; those of a join before would each be a task in the hundreds
    of stages of the training, and each task has a result for the driver.
    """
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, "training-rows")
    needed = rows.select(*FEATURES, LABEL, ts, *keys)
    needed.write.parquet(path)
    needed = spark.read.schema(needed.schema).parquet(path)
    early, late = time_split(needed, ts, keys)
    columns = [*FEATURES, LABEL]
    fitted = growth_pipeline(**settings).fit(drop_incomplete(early.select(*columns), columns))
    return fitted, fitted.transform(drop_incomplete(late.select(*columns, *keys), columns))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def _complete() -> Column:
    known = F.lit(True)
    for c in FEATURES:
        known = known & F.col(c).isNotNull()
    return known


def to_views(prediction: Column, rate: Column) -> Column:
    """Predicted views from predicted growth: 10^(growth / (1 + rate / 100)).

    An approximation on purpose: the exact inverse of the label would subtract 1.
    """
    return power_of_ten(F.try_divide(prediction, rate / 100 + 1))


def score(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Features and ``predicted_views``; 0 where a feature is missing."""
    scored = model.transform(with_features(df)).drop("raw_features", "features")
    views = to_views(F.col("prediction"), F.col("engagement_rate"))
    return scored.withColumn(
        "predicted_views", F.when(_complete(), views).otherwise(0.0)
    ).drop("prediction")


# --- metrics ----------------------------------------------------------------------


def verdict(mape: Column) -> Column:
    return (
        F.when(mape < 20, "EXCELLENT")
        .when(mape < 35, "GOOD")
        .when(mape < 50, "ACCEPTABLE")
        .otherwise("NEEDS IMPROVEMENT")
    )


def regression_metrics(
    df: DataFrame, label: str = LABEL, prediction: str = "prediction"
) -> DataFrame:
    """RMSE, MAE, R2, MAPE in % and its verdict, from one pass."""
    actual = F.col(label)
    error = actual - F.col(prediction)
    known = df.filter(actual.isNotNull() & F.col(prediction).isNotNull())
    sums = known.agg(
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(actual).alias("variance"),
        (F.avg(F.abs(error) / (F.abs(actual) + 1e-10)) * 100).alias("mape"),
    )
    return sums.select(
        F.sqrt("mse").alias("rmse"),
        "mae",
        (1 - F.try_divide("mse", "variance")).alias("r2"),
        "mape",
        verdict(F.col("mape")).alias("verdict"),
    )
