"""Inputs the registered queries share."""

from datetime import datetime, timedelta

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.operators import partials
from trendlens.operators.clean import cast_metrics
from trendlens.operators.dedup import keep_best, keep_first
from trendlens.operators.enrich import with_days_to_trend, with_engagement
from trendlens.operators.model import train, training_rows
from trendlens.schema import RAW_SCHEMA
from trendlens.session import scratch_path
from trendlens.sources import messages, star
from trendlens.streaming import scoring, sinks

# Unique per observation, also across videos.
ROW_KEY = ("l_orderkey", "l_linenumber", "l_suppkey", "video_id")

_MODELS: dict = {}
_ROOTS: dict = {}


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.raw_observations(spark, sf_dir)


def raw_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows in the shape of a raw file: sixteen text columns."""
    df = raw(spark, sf_dir)
    return df.select(
        *[
            (F.col(c) if c in df.columns else F.lit(None)).cast("string").alias(c)
            for c in RAW_SCHEMA.fieldNames()
        ]
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.observations(spark, sf_dir)


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_metrics(observations(spark, sf_dir))


def entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_best(metrics(spark, sf_dir), by="view_count_num", tie=star.TIE)


def rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_engagement(entity(spark, sf_dir))


def first_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_first(with_days_to_trend(observations(spark, sf_dir)), tie=star.TIE[1:])


def model_rows(spark: SparkSession, sf_dir: str, fraction: float = 1.0) -> DataFrame:
    """Featured and labelled rows of the quality band."""
    return training_rows(observations(spark, sf_dir), ROW_KEY, fraction)


def model(spark: SparkSession, sf_dir: str):
    """The fitted model and its scored hold-out rows, trained once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODELS:
        _MODELS[key] = train(model_rows(spark, sf_dir, 0.15), ROW_KEY)
    return _MODELS[key]


def message_rows(spark: SparkSession, sf_dir: str, where: str = "true", deal: int | None = None) -> DataFrame:
    """Raw rows as they are published, each with the time of that."""
    df = star.raw_observations(spark, sf_dir, deal=deal).filter(where)
    columns = [(F.col(c) if c in df.columns else F.lit(None)).cast("string").alias(c) for c in RAW_SCHEMA.fieldNames()]
    return df.select(*columns, F.lit("2024-05-01T10:20:30.250000").alias("kafka_timestamp"))


def message_files(spark: SparkSession, sf_dir: str, least: int) -> int:
    """Into how many files the messages are dealt: ``least``, more for a large table."""
    return max(least, -(-star.table(spark, sf_dir, "lineitem").count() // sinks.MESSAGES_PER_FILE))


def publish_messages(spark: SparkSession, sf_dir: str, path: str, least: int, where: str = "true") -> int:
    """Adds the messages to the files in ``path``, as ``least`` or more; how many files are there.

    Line items are dealt out before they get their texts, or stay where the join with the
    videos has shuffled them: a shuffle of whole messages would move several times as much.
    """
    n = message_files(spark, sf_dir, least)
    rows = star.table(spark, sf_dir, "lineitem").filter(where).count()
    sinks.publish_files(message_rows(spark, sf_dir, where, deal=n), path, max(1, -(-rows // n)))
    return len(spark.read.text(path).inputFiles())


def known_model() -> PipelineModel:
    """A model that predicts the label itself, so ``predicted_views`` is the views plus one."""
    return PipelineModel([SQLTransformer(statement="SELECT *, view_scale * (1 + engagement_rate / 100) AS prediction FROM __THIS__")])


BATCHES = 4
FIRST_BATCH, BETWEEN_BATCHES = datetime(2024, 5, 1, 10), timedelta(hours=11, minutes=30)


def scored_tables(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the output tables after four micro-batches over two days, by line number;
    the last but one was replayed. Made once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _ROOTS:
        root = scratch_path(spark, "outputs")
        for k in (*range(BATCHES - 1), BATCHES - 2, BATCHES - 1):
            batch = messages.decode(sinks.as_messages(message_rows(spark, sf_dir, f"l_linenumber % {BATCHES} = {k}")))
            scoring.process_batch(batch, k, known_model(), root, now=FIRST_BATCH + k * BETWEEN_BATCHES)
        _ROOTS[key] = root
    return _ROOTS[key]


HISTORY_COLUMNS = (*ROW_KEY, "title", "channelTitle", "categoryId", "publishedAt", "trending_date", "view_count", "likes", "dislikes", "comment_count")
YEAR = "snapshot_year"


def loads(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three loads: most rows, a correction of early years with rows of its own, and one
    that moves rows of another year to a different category and channel."""
    rows = observations(spark, sf_dir).select(*HISTORY_COLUMNS, F.date_format("trending_date", "yyyy").alias(YEAR))
    raised = {"view_count": F.col("view_count") + 7, "likes": F.col("likes") * 2}
    moved = {"view_count": F.expr("view_count div 2"), "categoryId": F.lit(10), "channelTitle": F.lit("moved")}
    return [
        rows.filter("l_linenumber <> 3"),
        rows.filter(f"{YEAR} <= '1994' AND l_linenumber IN (2, 3)").withColumns(raised),
        rows.filter(f"{YEAR} = '1996' AND l_linenumber = 5").withColumns(moved),
    ]


def latest_row() -> list[Column]:
    return [F.desc(c) for c in ("view_count", "l_orderkey", "l_linenumber", "l_suppkey")]


def loaded_history(spark: SparkSession, sf_dir: str) -> str:
    """The folder of a history after the three loads, with its monthly states. Made once per
    application."""
    key = (spark.sparkContext.applicationId, sf_dir, "history")
    if key not in _ROOTS:
        path = scratch_path(spark, "history")
        for load in loads(spark, sf_dir):
            sinks.merge_history(spark, load, path, partition=YEAR, latest=latest_row(), derived=partials.states(star.TIE))
        _ROOTS[key] = path
    return _ROOTS[key]


def incremental(spark: SparkSession, sf_dir: str, report: str) -> DataFrame:
    path = loaded_history(spark, sf_dir)
    held = {name: sinks.read_history(spark, path, name) for name in partials.states()}
    return partials.reports(held, star.TIE)[report]


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    """Sums of fractions depend on their order in the last digits; counts do not."""
    return df.withColumns({c: F.round(c, digits) for c in cols})
