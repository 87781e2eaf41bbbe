"""The jobs end to end: load, clean, report, train, stream.

Each one joins operators to a source and a sink; every decision is in the operators.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trendlens.operators import (
    category,
    clean,
    correlation,
    dedup,
    engagement,
    enrich,
    model,
    partials,
    quality,
    timing,
    topn,
)
from trendlens.session import scratch_path
from trendlens.sources.files import read_clean, read_observations
from trendlens.sources.listing import flatten_listing
from trendlens.sources.records import good_and_bad, read_records
from trendlens.streaming import scoring, sinks

KEYS = ("video_id", "trending_date")


def run_cleaning(
    spark: SparkSession, raw_path, clean_path: str, tags_path: str, bad_path: str | None = None
) -> None:
    """Raw CSV to the clean table, by snapshot month, and its copy with tag arrays.

    With ``bad_path``, records with more or fewer fields than the layout do not enter
    the table: their texts are stored there.
    """
    if bad_path is None:
        raw = read_observations(spark, raw_path)
    else:
        raw, bad = good_and_bad(read_records(spark, raw_path))
        bad.write.mode("overwrite").parquet(bad_path)
    rows = clean.clean(raw)
    month = F.date_format("trending_date", "yyyy-MM")
    sinks.write_clean(rows.withColumn("snapshot_month", month), clean_path, ["snapshot_month"])
    sinks.write_clean(clean.with_tag_list(read_clean(spark, clean_path)), tags_path)


def run_load(spark: SparkSession, payloads: DataFrame, json_col: str, snapshot: Column, path: str) -> int:
    """A day's listing payloads into the history and its monthly states, in one version.

    Flattened and cleaned like raw files; a video seen twice at one time is kept once, the
    load's row before a stored one. Running a load again changes nothing but the
    version. The cleaned rows are stored while it runs, so payloads are read once.
    """
    rows = clean.clean(flatten_listing(payloads, json_col, snapshot))
    rows = rows.withColumn("snapshot_month", F.date_format("trending_date", "yyyy-MM"))
    at = scratch_path(spark, "load")
    try:
        rows.write.parquet(at)
        cleaned = spark.read.schema(rows.schema).parquet(at)
        return sinks.merge_history(spark, cleaned, path, KEYS, derived=partials.states())
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(at)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def history_reports(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The reports over all that :func:`run_load` has stored, from the monthly states."""
    return partials.reports({name: sinks.read_history(spark, path, name) for name in partials.states()})


def reports(obs: DataFrame, tie: Sequence[str] = ("trending_date",)) -> dict[str, DataFrame]:
    """Every report over a clean table, lazily; persist the views to run many."""
    rows = clean.cast_metrics(obs)
    entity = dedup.keep_best(rows, by="view_count_num", tie=tie)
    rated = enrich.with_engagement(entity)
    first = dedup.keep_first(
        enrich.with_days_to_trend(rows), tie=[t for t in tie if t != "trending_date"]
    )
    top20 = {
        f"top20_{metric}": topn.top_n(rated, metric, 20, ("title", "channelTitle", metric))
        for metric in (
            "view_count_num",
            "total_engagement",
            "likes_num",
            "comment_count_num",
            "engagement_rate",
        )
    }
    return {
        "date_range": category.date_range(rows),
        "profile": quality.profile(rows),
        "categories": category.categories(rows),
        "category_shares": category.shares(rows),
        "total_views": category.total_views(entity),
        "unique_channels": category.unique_channels(rows),
        "average_metrics": category.average_metrics(rows),
        "channel_concentration": category.channel_concentration(rows),
        "like_dislike_ratio": category.like_dislike_ratio(rows),
        "best_videos": category.best_videos(entity),
        "category_summary": category.summary(rows, entity),
        "publish_hours": timing.per_publish_hour(rows),
        "peak_hour": timing.extremes(timing.per_publish_hour(rows), "publish_hour"),
        "publish_days": timing.per_weekday(rows, "publishedAt", "publish_day"),
        "peak_day": timing.weekday_extremes(timing.per_weekday(rows, "publishedAt", "publish_day"), "publish_day"),
        "busiest_cell": timing.busiest_cell(rows),
        "top10_views": topn.top_n(enrich.with_category_name(entity), "view_count_num", 10, ("title", "category_name", "channelTitle", "view_count_num")),
        "trending_days": timing.per_weekday(rows, "trending_date", "trending_day"),
        "time_to_trend": timing.time_to_trend(first),
        "days_distribution": timing.days_distribution(first),
        "same_day": timing.same_day(first),
        "hour_by_weekday": timing.hour_by_weekday(rows),
        "time_to_trend_per_category": timing.time_to_trend_per_category(first),
        "metrics_per_publish_hour": timing.metrics_per_publish_hour(entity),
        "lifespan": timing.lifespan(rows),
        "rates_per_category": engagement.rates_per_category(rated),
        "correlation": correlation.correlation_matrix(rated),
        "density": correlation.log_density(rated),
        "engagement_bands": engagement.bands(rated),
        "interaction_summary": engagement.interaction_summary(rated),
        **top20,
    }


def run_training(
    spark: SparkSession, clean_path: str, model_path: str, fraction: float = 0.15, **settings
) -> DataFrame:
    """Trains on a sample of the clean table, saves the model, returns its metrics."""
    rows = model.training_rows(read_clean(spark, clean_path), KEYS, fraction)
    fitted, held_out = model.train(rows, KEYS, **settings)
    model.save_model(fitted, model_path)
    return model.regression_metrics(held_out)


def run_stream(
    messages: DataFrame, model_path: str, root: str, checkpoint: str, **options
) -> StreamingQuery:
    """Scores a message stream with the saved model into the three output tables."""
    return scoring.start(messages, model.load_model(model_path), root, checkpoint, **options)
