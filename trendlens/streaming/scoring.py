"""The micro-batch job: decode, score, summarise, store."""

import json
from datetime import UTC, datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trendlens.functions.rates import display, growth_percent
from trendlens.functions.text import ellipsize, nan_to_null
from trendlens.operators.model import score
from trendlens.operators.topn import top_n
from trendlens.schema import DEFAULT_CATEGORY, DEFAULT_TITLE
from trendlens.sources.messages import decode
from trendlens.streaming import sinks

TOP_PREDICTIONS = 10


def batch_totals(batch: DataFrame) -> DataFrame:
    return batch.agg(
        F.count("*").alias("videos"),
        F.sum("view_count").alias("total_views"),
        F.avg("engagement_rate").alias("avg_engagement_rate"),
    )


def batch_category_stats(batch: DataFrame, digits: int | None = 2) -> DataFrame:
    """Views and engagement per known category, rounded for display."""
    stats = (
        batch.filter(F.col("categoryId").isNotNull())
        .groupBy("categoryId")
        .agg(
            F.count("view_count").alias("view_count_count"),
            F.sum("view_count").alias("view_count_sum"),
            F.avg("view_count").alias("view_count_mean"),
            F.avg("engagement_rate").alias("engagement_rate_mean"),
        )
    )
    if digits is None:
        return stats
    means = ("view_count_mean", "engagement_rate_mean")
    return stats.withColumns({c: display(F.col(c), digits) for c in means})


def top_viewed(batch: DataFrame, n: int = 3) -> DataFrame:
    top = top_n(batch, "view_count", n, ("title", "view_count", "channelTitle"))
    return top.withColumn("title", ellipsize(F.col("title"), 50, always=True))


def top_predicted(scored: DataFrame, n: int = 3) -> DataFrame:
    cols = ("title", "view_count", "predicted_views")
    growth = growth_percent(F.col("predicted_views"), F.col("view_count"))
    return (
        top_n(scored, "predicted_views", n, cols)
        .withColumn("title", ellipsize(F.col("title"), 40, always=True))
        .withColumn("growth_pct", growth)
    )


def prediction_rows(scored: DataFrame, n: int = TOP_PREDICTIONS) -> DataFrame:
    cols = ("video_id", "title", "categoryId", "predicted_views", "view_count")
    top = top_n(scored, "predicted_views", n, cols, tie=("video_id", "view_count"))
    return top.withColumns(
        {
            "title": F.coalesce("title", F.lit(DEFAULT_TITLE)),
            "categoryId": F.coalesce("categoryId", F.lit(DEFAULT_CATEGORY)),
        }
    )


def without_nan(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {c: nan_to_null(F.col(c)) for c, t in df.dtypes if t in ("double", "float")}
    )


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint keeps for its stream, the same after every restart."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


#: The lists of a batch: by which column, and the length a title is cut to.
LISTS = {"viewed": ("view_count", 50), "predicted": ("predicted_views", 40)}


def top_videos(scored: DataFrame, n: int = 3) -> DataFrame:
    """Both top lists of a batch in one table: ``list``, ``rank`` and what the lists show."""
    best = None
    for name, (metric, width) in LISTS.items():
        rows = top_n(scored, metric, n, tie=("video_id", "view_count")).select(
            F.lit(name).alias("list"),
            F.col(metric).cast("double").alias("_by"),
            "video_id",
            ellipsize(F.col("title"), width, always=True).alias("title"),
            "channelTitle",
            "view_count",
            "predicted_views",
            growth_percent(F.col("predicted_views"), F.col("view_count")).alias("growth_pct"),
        )
        best = rows if best is None else best.unionByName(rows)
    place = F.row_number().over(Window.partitionBy("list").orderBy(F.col("_by").desc_nulls_last(), "video_id", "view_count"))
    return best.withColumn("rank", place).drop("_by")


#: What a scored batch adds to each table besides its rows; the time column of a table goes by ``sinks.STAMPS``.
DERIVED = {
    sinks.CATEGORY_STATS: batch_category_stats,
    sinks.PREDICTIONS: prediction_rows,
    sinks.TOTALS: batch_totals,
    sinks.TOP_VIDEOS: top_videos,
}


def process_batch(
    batch: DataFrame,
    batch_id: int,
    model: PipelineModel,
    root: str,
    checkpoint: str | None = None,
    now: datetime | None = None,
) -> bool:
    """Scores one micro-batch of decoded messages and adds it to the output tables, see
    :data:`DERIVED`, in one commit. False where this batch was committed before.

    Rows carry one time (``now``, else the clock) and the run that ``checkpoint`` belongs
    to. Until the commit nobody sees a row; a batch that failed half-way leaves
    folders that no version names, and runs again under a time of its own. A batch
    that is replayed after its commit has its rows and time already.

    The batch is scored once, into the table of its rows; what the others get is made from
    the columns they need of these files, so nothing is held in memory.
    """
    spark = batch.sparkSession
    run = run_id(spark, checkpoint) if checkpoint else "run"
    if sinks.committed(spark, root, run) >= batch_id:
        return False
    scored = without_nan(score(batch, model))
    return sinks.commit_batch(spark, {sinks.REALTIME: scored, **DERIVED}, root, run, batch_id, now or datetime.now(UTC))


def start(
    messages: DataFrame,
    model: PipelineModel,
    root: str,
    checkpoint: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Runs the job over a stream of JSON messages; offsets live in ``checkpoint``."""

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch, batch_id, model, root, checkpoint)

    writer = (
        decode(messages)
        .writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
