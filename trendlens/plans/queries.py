
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trendlens.functions import rates, text, times
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
from trendlens.plans import frames, jobs
from trendlens.plans.frames import ROW_KEY, rounded
from trendlens.schema import FEATURES, ISO_FORMAT, LABEL
from trendlens.session import scratch_path
from trendlens.sources import files, messages, records, star
from trendlens.sources.listing import flatten_listing
from trendlens.streaming import scoring, serving, sinks, versions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def over(source: Query, name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    """Registers a report that is one operator over one shared input."""
    QUERIES[name] = lambda spark, d: fn(source(spark, d))


RATES = ("like_rate", "dislike_rate", "comment_rate", "engagement_rate")
VIDEO_RATES = ("video_id", "total_engagement", *RATES)

# --- sources ----------------------------------------------------------------------


def _written_csv(spark, d, **options) -> DataFrame:
    path = scratch_path(spark, "raw-csv")
    writer = frames.raw_file_rows(spark, d).write.option("header", True)
    writer.option("escape", '"').options(**options).csv(path)
    return files.read_observations(spark, path)


@query("s01_csv_scan")
def s01(spark, d):
    return _written_csv(spark, d)


@query("s01_split_scan")
def s01_split(spark, d):
    path = scratch_path(spark, "raw-csv")
    frames.raw_file_rows(spark, d).write.csv(path, header=True, escape='"')
    good, _ = records.good_and_bad(records.read_records(spark, path))
    return good


@query("s01_bad_records")
def s01_bad(spark, d):
    """Every broken record of a file, with the counts of all records and of broken ones."""
    rows = frames.raw_file_rows(spark, d)
    record = (
        F.when(F.col("view_count").endswith("7"), F.concat_ws(",", "video_id", "view_count"))
        .when(F.col("view_count").endswith("3"), F.concat("video_id", F.repeat(F.lit(",x"), 16)))
        .otherwise(F.to_csv(F.struct(*rows.columns), {"escape": '"'}))
    )
    path = scratch_path(spark, "broken-csv")
    # one column named like the header and never quoted: the lines as they are
    lines = rows.select(record.alias(",".join(rows.columns)))
    lines.write.csv(path, header=True, sep="\u0001", quote="", escape="\u0002")
    told = Observation()  # counts the records in the pass that stores the broken ones
    read = records.read_records(spark, path).observe(told, F.count(F.lit(1)).alias("n_rows"), F.count(records.BAD).alias("n_bad"))
    bad = scratch_path(spark, "broken")
    records.good_and_bad(read)[1].write.parquet(bad)
    counts = [F.lit(told.get[c]).cast("bigint").alias(c) for c in ("n_rows", "n_bad")]
    return files.read_clean(spark, bad).select(records.BAD, *counts)


@query("s02_clean_scan")
def s02(spark, d):
    path = scratch_path(spark, "clean")
    month = F.date_format("trending_date", "yyyy-MM")
    obs = frames.observations(spark, d).withColumn("snapshot_month", month)
    sinks.write_clean(obs, path, ["snapshot_month"])
    return files.read_clean(spark, path).drop("snapshot_month")


@query("s03_gzip_scan")
def s03(spark, d):
    return _written_csv(spark, d, compression="gzip")


def _payloads(obs: DataFrame) -> DataFrame:
    """Each observation as the listing it would come from."""
    item = F.struct(
        F.col("video_id").alias("id"),
        F.struct(
            "title",
            F.date_format("publishedAt", ISO_FORMAT).alias("publishedAt"),
            "channelTitle",
            F.col("categoryId").cast("string").alias("categoryId"),
            F.when(F.col("tags") != "[none]", text.tag_list(F.col("tags"))).alias("tags"),
            "description",
        ).alias("snippet"),
        F.struct(
            F.col("view_count").cast("string").alias("viewCount"),
            F.when(F.col("likes") > 0, F.col("likes").cast("string")).alias("likeCount"),
            F.when(
                F.col("l_linenumber") != 2, F.col("comment_count").cast("string")
            ).alias("commentCount"),
        ).alias("statistics"),
    )
    payload = F.to_json(F.struct(F.array(item).alias("items"))).alias("payload")
    return obs.select("trending_date", payload)


@query("s04_flatten_listing")
def s04(spark, d):
    payloads = _payloads(frames.observations(spark, d))
    return flatten_listing(payloads, "payload", F.col("trending_date")).drop("channelId", "thumbnail_link")


@query("s04_daily_load")
def s04_load(spark, d):
    """Two loads of listings into the history: the days before 1995, then the others with
    the days of 1994 once more. Which of a video's equal times is kept is fixed by all
    columns, so the counts of rows, videos and known times tell all loads apart."""
    path = scratch_path(spark, "history")
    obs = frames.observations(spark, d)
    for part in ("year(trending_date) < 1995", "year(trending_date) >= 1994"):
        jobs.run_load(spark, _payloads(obs.filter(part)), "payload", F.col("trending_date"), path)
    rows = sinks.read_history(spark, path)
    return rows.groupBy("snapshot_month").agg(
        F.count("*").alias("rows"), F.count_distinct("video_id").alias("videos"), F.max("trending_date").alias("newest"), F.max("view_count").alias("most_views")
    )


MESSAGE_COLUMNS = (
    "video_id",
    "title",
    "publishedAt",
    "trending_date",
    "categoryId",
    "view_count",
    "likes",
    "dislikes",
    "comment_count",
    "kafka_timestamp",
)


@query("s05_decode_messages")
def s05(spark, d):
    decoded = messages.decode(sinks.as_messages(frames.message_rows(spark, d)))
    return decoded.select(*MESSAGE_COLUMNS)


# --- sinks ------------------------------------------------------------------------


@query("k01_text_export")
def k01(spark, d):
    path = scratch_path(spark, "text")
    cols = ("video_id", "title", "publishedAt", "trending_date", "tags", "view_count")
    obs = frames.observations(spark, d).select(*cols)
    sinks.export_text(obs, path)
    schema = "video_id string, title string, publishedAt string, trending_date string, "
    return files.read_clean(spark, path, "csv", schema + "tags string, view_count bigint")


@query("k02_tag_copy")
def k02(spark, d):
    path = scratch_path(spark, "tags")
    sinks.write_clean(clean.with_tag_list(frames.observations(spark, d)), path)
    tags = files.read_clean(spark, path)
    return tags.select(
        "video_id", F.array_join("tags", "~").alias("tags"), F.size("tags").alias("n_tags")
    )


def _history(spark, d) -> tuple[DataFrame, DataFrame]:
    """A history and a load that replaces part of it and adds to it."""
    cols = (*ROW_KEY, "trending_date", "view_count")
    old = frames.observations(spark, d).select(*cols)
    later = F.col("trending_date") + F.expr("INTERVAL 1 DAY")
    seen = F.when(F.col("l_linenumber") < 4, later).otherwise(F.col("trending_date"))
    new = old.withColumns({"trending_date": seen, "view_count": F.col("view_count") + 1})
    return old, new


@query("k03_upsert_keep_last")
def k03(spark, d):
    old, new = _history(spark, d)
    return dedup.upsert_keep_last(old, new, latest=frames.latest_row())


@query("k04_publish_messages")
def k04(spark, d):
    path = scratch_path(spark, "messages")
    sinks.publish_files(frames.message_rows(spark, d), path)
    return messages.decode(spark.read.text(path)).select(*MESSAGE_COLUMNS)


@query("k03_merge_history")
def k03_merge(spark, d):
    """A stored history after the load of :func:`_history`; months neither reads nor touches stay."""
    path = scratch_path(spark, "history")
    old, new = _history(spark, d)
    month = F.date_format("trending_date", "yyyy-MM")
    sinks.write_history(old.withColumn("snapshot_month", month), path)
    sinks.merge_history(spark, new.withColumn("snapshot_month", month), path, latest=frames.latest_row())
    return sinks.read_history(spark, path)


@query("k05_append_scored_batch")
def k05(spark, d):
    stored = versions.frame(spark, frames.scored_tables(spark, d), sinks.REALTIME)
    sums = stored.groupBy("batch_id", "processing_timestamp", "categoryId").agg(
        F.count("*").alias("rows"),
        F.count("trending_date").alias("dated"),
        F.sum("view_count").alias("views"),
        F.avg("engagement_rate").alias("rate"),
        F.sum(F.round("predicted_views").cast("bigint")).alias("predicted"),
    )
    return rounded(sums, "rate")


def _stats(spark, d) -> DataFrame:
    batch = model.with_features(frames.observations(spark, d))
    return scoring.batch_category_stats(batch, digits=None)


@query("k06_append_category_stats")
def k06(spark, d):
    return versions.frame(spark, frames.scored_tables(spark, d), sinks.CATEGORY_STATS).drop("run_id")


def _known(df: DataFrame) -> DataFrame:
    return df.withColumn("predicted_views", F.round("predicted_views").cast("bigint"))


@query("k07_replace_predictions")
def k07(spark, d):
    return _known(versions.frame(spark, frames.scored_tables(spark, d), sinks.PREDICTIONS)).drop("run_id")


@query("k08_reset_outputs")
def k08(spark, d):
    root = scratch_path(spark, "outputs")
    scoring.process_batch(frames.observations(spark, d), 0, frames.known_model(), root)
    sinks.reset_outputs(spark, root)

    def left(name: str) -> DataFrame:
        rows = versions.frame(spark, root, name).agg(F.count("*").alias("rows"))
        return rows.select(F.lit(name).alias("output"), "rows")

    return left(sinks.REALTIME).union(left(sinks.CATEGORY_STATS)).union(left(sinks.PREDICTIONS))


# --- projections and cleaning -----------------------------------------------------

over(frames.raw, "p01_drop_columns", lambda df: clean.drop_columns(df, ["tags", "likes", "no"]))
over(
    frames.raw,
    "p02_select_columns",
    lambda df: df.select("title", "video_id", "view_count", "categoryId"),
)


@query("p03_cast_metrics")
def p03(spark, d):
    df = frames.raw(spark, d)
    odd = F.when(F.col("l_linenumber") == 2, "n/a").otherwise(F.col("likes").cast("string"))
    as_text = df.withColumns({"likes": odd, "view_count": F.col("view_count").cast("string")})
    return clean.cast_metrics(as_text).select(
        *ROW_KEY,
        "view_count_num",
        F.coalesce("likes_num", F.lit(-1)).alias("likes_num"),
        "dislikes_num",
        "comment_count_num",
    )


over(
    frames.raw,
    "p04_fill_missing",
    lambda df: clean.fill_missing(df, {"description": "No description"}).select(
        *ROW_KEY, "description"
    ),
)
over(
    frames.raw,
    "p05_parse_iso_times",
    lambda df: clean.parse_dates(df).select(*ROW_KEY, "trending_date", "publishedAt"),
)


@query("p06_parse_default_times")
def p06(spark, d):
    stored = clean.times_as_text(frames.observations(spark, d))
    return stored.select(
        *ROW_KEY, times.parse_default(F.col("trending_date")).alias("trending_date")
    )


@query("p07_parse_mixed_times")
def p07(spark, d):
    df = frames.raw(spark, d)
    iso, line = F.col("publishedAt"), F.col("l_linenumber")
    day = F.substring(iso, 1, 10)
    mixed = (
        F.when(line == 1, iso)
        .when(line == 2, F.replace(day, F.lit("-"), F.lit("/")))
        .when(line == 3, F.replace(iso, F.lit("Z"), F.lit("+02:00")))
        .when(line == 4, F.concat(day, F.lit(" 10:11:12")))
        .when(line == 5, F.lit("no date"))
        .otherwise(day)
    )
    return df.select(*ROW_KEY, times.parse_mixed(mixed).alias("published"))


over(
    frames.observations,
    "p08_format_times",
    lambda df: clean.times_as_text(df).select(*ROW_KEY, "trending_date", "publishedAt"),
)
over(
    frames.observations,
    "p09_category_name",
    lambda df: enrich.with_category_name(df).select(*ROW_KEY, "categoryId", "category_name"),
)
over(
    frames.raw,
    "p10_tag_list",
    lambda df: clean.with_tag_list(df).select(
        *ROW_KEY,
        F.array_join("tags", "~").alias("tags"),
        F.size("tags").alias("n_tags"),
        F.element_at("tags", 1).alias("first_tag"),
    ),
)

# --- filters and quality ----------------------------------------------------------


@query("q01_keep_keyed")
def q01(spark, d):
    line = F.col("l_linenumber")
    key = F.when(line == 1, F.lit(None)).when(line == 2, "").otherwise(F.col("video_id"))
    return clean.keep_keyed(
        frames.raw(spark, d).select("l_orderkey", "l_linenumber", "l_suppkey", key.alias("video_id"))
    )


@query("q02_drop_empty_rows")
def q02(spark, d):
    known = F.col("description").isNotNull()
    some = frames.raw(spark, d).select(
        "description", F.when(known, F.col("trending_date")).alias("trending_date")
    )
    return clean.drop_empty_rows(some)


over(
    frames.raw,
    "q03_keep_valid_dates",
    lambda df: clean.keep_valid_dates(df).select(*ROW_KEY, "trending_date"),
)
over(frames.raw, "q04_invalid_dates", quality.invalid_dates)
over(frames.raw, "q05_validity_counts", quality.validity)
over(frames.raw, "q06_known_values", lambda df: quality.known_values(df, "trending_date"))
over(frames.raw, "q07_profile", quality.profile)
over(frames.raw, "q07_profile_columns", quality.profile_columns)
over(
    frames.observations,
    "q08_quality_band",
    lambda df: quality.quality_band(df).select(*ROW_KEY, "view_count", "likes"),
)
over(
    frames.raw,
    "q09_drop_incomplete",
    lambda df: quality.drop_incomplete(df, ["description", "tags"]).select(
        *ROW_KEY, "description"
    ),
)
over(
    frames.entity,
    "q10_exclude_category",
    lambda df: quality.exclude_value(category.total_views(df), "category_name", "Music"),
)
over(
    frames.first_trend,
    "q11_same_day_rows",
    lambda df: df.filter(F.col("days_to_trend") == 0).select("video_id", "trending_date"),
)
over(frames.rated, "q12_band_counts", lambda df: engagement.bands(df).select("band", "count"))

# --- join -------------------------------------------------------------------------


@query("j01_category_join")
def j01(spark, d):
    """The join with a dimension of the caller's own: here, part types."""
    dim = star.table(spark, d, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("category_name")
    )
    lines = star.table(spark, d, "lineitem")
    named = enrich.with_category_name(lines, dim, key="l_partkey")
    return named.groupBy("category_name").agg(F.count("*").alias("count"))


# --- category reports -------------------------------------------------------------

over(frames.metrics, "a01_categories", category.categories)
over(frames.metrics, "a01_distinct_counts", category.distinct_counts)
over(frames.metrics, "a02_category_counts", category.counts)
over(frames.metrics, "a03_category_shares", category.shares)
over(frames.metrics, "a03_top_shares", category.top_shares)
over(frames.entity, "a04_total_views_by_category", category.total_views)
over(frames.metrics, "a05_unique_channels", category.unique_channels)
over(
    frames.metrics,
    "a06_average_metrics",
    lambda df: rounded(
        category.average_metrics(df), "avg_likes", "avg_dislikes", "avg_comments", "avg_views"
    ),
)
over(frames.metrics, "a07_channel_concentration", category.channel_concentration)
over(frames.metrics, "a08_like_dislike_ratio", category.like_dislike_ratio)


@query("a24_category_summary")
def a24(spark, d):
    df = category.summary(frames.metrics(spark, d), frames.entity(spark, d))
    return rounded(df, "avg_likes")


over(frames.metrics, "a26_date_range", category.date_range)

# --- time reports -----------------------------------------------------------------

over(frames.metrics, "a09_publish_hours", timing.per_publish_hour)
over(
    frames.metrics,
    "a10_publish_days",
    lambda df: timing.per_weekday(df, "publishedAt", "publish_day"),
)
over(
    frames.metrics,
    "a10_trending_days",
    lambda df: timing.per_weekday(df, "trending_date", "trending_day"),
)
over(
    frames.metrics,
    "a11_peak_hour",
    lambda df: timing.extremes(timing.per_publish_hour(df), "publish_hour"),
)
over(
    frames.metrics,
    "a11_peak_day",
    lambda df: timing.weekday_extremes(
        timing.per_weekday(df, "publishedAt", "publish_day"), "publish_day"
    ),
)
over(
    frames.first_trend,
    "a12_time_to_trend",
    lambda df: rounded(timing.time_to_trend(df), "avg_days"),
)
over(frames.first_trend, "a13_days_distribution", timing.days_distribution)
over(frames.first_trend, "a14_same_day", timing.same_day)
over(frames.metrics, "a15_hour_by_weekday", timing.hour_by_weekday)
over(frames.metrics, "a15_busiest_cell", timing.busiest_cell)
over(
    frames.first_trend,
    "a17_time_to_trend_by_category",
    lambda df: rounded(timing.time_to_trend_per_category(df), "avg_days_to_trend"),
)
over(
    frames.entity,
    "a18_metrics_by_publish_hour",
    lambda df: rounded(
        timing.metrics_per_publish_hour(df), "avg_views", "avg_likes", "avg_comments"
    ),
)
over(
    frames.metrics,
    "a19_trending_lifespan",
    lambda df: rounded(timing.lifespan(df), "avg_trending_lifespan"),
)

# --- the same reports from the states of a history after three loads ---------------

#: Name of the query over all observations, and what is rounded in it.
INCREMENTAL = {
    "category_counts": ("a02_category_counts",),
    "category_shares": ("a03_category_shares",),
    "total_views": ("a04_total_views_by_category",),
    "unique_channels": ("a05_unique_channels",),
    "average_metrics": ("a06_average_metrics", "avg_likes", "avg_dislikes", "avg_comments", "avg_views"),
    "channel_concentration": ("a07_channel_concentration",),
    "like_dislike_ratio": ("a08_like_dislike_ratio",),
    "publish_hours": ("a09_publish_hours",),
    "publish_days": ("a10_publish_days",),
    "trending_days": ("a10_trending_days",),
    "time_to_trend": ("a12_time_to_trend", "avg_days"),
    "days_distribution": ("a13_days_distribution",),
    "same_day": ("a14_same_day",),
    "hour_by_weekday": ("a15_hour_by_weekday",),
    "engagement_bands": ("a16_engagement_bands",),
    "time_to_trend_per_category": ("a17_time_to_trend_by_category", "avg_days_to_trend"),
    "metrics_per_publish_hour": ("a18_metrics_by_publish_hour", "avg_views", "avg_likes", "avg_comments"),
    "lifespan": ("a19_trending_lifespan", "avg_trending_lifespan"),
    "rates_per_category": ("a20_rates_by_category", *["avg_" + r for r in RATES]),
    "engagement_totals": ("a21_engagement_totals", "avg_engagement_rate"),
}
for _report, (_name, *_means) in INCREMENTAL.items():
    QUERIES[f"{_name}_incremental"] = lambda spark, d, r=_report, m=_means: rounded(frames.incremental(spark, d, r), *m)


@query("a05_estimated_channels")
def a05_estimated(spark, d):
    """Channels of each category from the stored sketches: within 5 % (three standard errors) of
    the count, which stands beside."""
    path = frames.loaded_history(spark, d)
    exact = frames.incremental(spark, d, "unique_channels")
    estimate = partials.estimated_channels(sinks.read_history(spark, path, "sketches")).select("categoryId", F.col("unique_channels").alias("estimate"))
    near = F.abs(F.col("estimate") - F.col("unique_channels")) <= F.greatest(F.lit(1), 0.05 * F.col("unique_channels"))
    return exact.join(estimate, exact["categoryId"].eqNullSafe(estimate["categoryId"])).select(exact["categoryId"], "category_name", "unique_channels", near.alias("near"))


# --- engagement reports -----------------------------------------------------------

over(frames.rated, "a16_engagement_bands", engagement.bands)
over(
    frames.rated,
    "a20_rates_by_category",
    lambda df: rounded(engagement.rates_per_category(df), *["avg_" + r for r in RATES]),
)
over(
    frames.rated,
    "a21_engagement_totals",
    lambda df: rounded(engagement.totals(df), "avg_engagement_rate"),
)
over(
    frames.rated,
    "a25_interaction_summary",
    lambda df: rounded(
        engagement.interaction_summary(df),
        "avg_engagement_rate",
        "most_engaging_engagement_rate",
        "top_category_rate",
        "named_rate",
    ),
)
over(
    frames.observations,
    "a22_batch_totals",
    lambda df: rounded(scoring.batch_totals(model.with_features(df)), "avg_engagement_rate"),
)


@query("a23_batch_category_stats")
def a23(spark, d):
    return rounded(_stats(spark, d), "view_count_mean", "engagement_rate_mean")


# --- correlation ------------------------------------------------------------------

over(
    frames.rated,
    "c01_correlation_matrix",
    lambda df: rounded(correlation.correlation_matrix(df), "r"),
)
over(
    frames.rated,
    "c02_pair_value",
    lambda df: rounded(
        correlation.pair_value(
            correlation.correlation_matrix(df), "view_count_num", "engagement_rate"
        ),
        "r",
    ),
)
over(frames.rated, "c03_log_density", correlation.log_density)

# --- windows ----------------------------------------------------------------------

over(
    frames.entity,
    "w01_keep_best",
    lambda df: df.select("video_id", "view_count_num", "trending_date", "l_orderkey"),
)
over(
    frames.first_trend,
    "w02_keep_first",
    lambda df: df.select("video_id", "trending_date", "days_to_trend", "l_orderkey"),
)
over(frames.entity, "w03_best_video_by_category", category.best_videos)
over(frames.entity, "w03_top3_by_category", lambda df: category.best_videos(df, 3))

# --- sorts and limits -------------------------------------------------------------

over(
    frames.entity,
    "t01_top10_views",
    lambda df: topn.top_n(
        enrich.with_category_name(df),
        "view_count_num",
        10,
        ("title", "category_name", "channelTitle", "view_count_num"),
    ),
)
TOP20 = {
    "t02_top20_views": ("view_count_num", ("likes_num", "engagement_rate")),
    "t02_top20_engagement": ("total_engagement", ("view_count_num", "engagement_rate")),
    "t02_top20_likes": ("likes_num", ("view_count_num", "like_rate")),
    "t02_top20_comments": ("comment_count_num", ("view_count_num", "comment_rate")),
    "t02_top20_engagement_rate": ("engagement_rate", ("view_count_num", "total_engagement")),
}


def _top20(metric: str, more: tuple) -> Callable[[DataFrame], DataFrame]:
    cols = ("title", "channelTitle", metric, *more)
    return lambda df: topn.top_n(df, metric, 20, cols)


for _name, (_metric, _more) in TOP20.items():
    over(frames.rated, _name, _top20(_metric, _more))

over(
    frames.rated,
    "t03_rate_preview",
    lambda df: topn.top_n(
        df,
        "engagement_rate",
        10,
        ("title", "view_count_num", "likes_num", "total_engagement", "engagement_rate"),
    ),
)
over(
    frames.rated,
    "t04_most_viewed",
    lambda df: topn.top_n(df, "view_count_num", 1, ("title", "view_count_num")),
)
over(frames.entity, "t05_batch_top3", scoring.top_viewed)
over(
    frames.entity,
    "t05_predicted_top3",
    lambda df: rounded(
        scoring.top_predicted(df.withColumn("predicted_views", F.col("likes") * 12.5)),
        "growth_pct",
    ),
)
over(
    frames.observations,
    "t06_newest",
    lambda df: topn.newest(
        df,
        cols=("trending_date", "title", "channelTitle", "view_count"),
        tie=("video_id", *star.TIE[1:]),
    ),
)
over(
    frames.metrics,
    "t07_weekday_order",
    lambda df: timing.per_weekday(df, "publishedAt", "publish_day", calendar_order=True).select(
        "publish_day",
        "count",
        times.weekday_position(F.col("publish_day")).cast("int").alias("position"),
    ),
)
over(
    frames.observations,
    "t08_preview",
    lambda df: topn.preview(
        df, 5, [F.asc(c) for c in ("l_orderkey", "l_linenumber", "l_suppkey", "video_id")]
    ).select(*ROW_KEY, "title"),
)

# --- set operations ---------------------------------------------------------------


@query("u01_append")
def u01(spark, d):
    old, new = _history(spark, d)
    both = dedup.append(old.drop("view_count"), new)
    return both.groupBy("video_id").agg(
        F.count("*").alias("rows"), F.count("view_count").alias("known_views")
    )


@query("u02_upsert_unique_history")
def u02(spark, d):
    old, new = _history(spark, d)
    keys = ("video_id", "trending_date")
    history = dedup.top_k_per_group(old, keys, frames.latest_row())
    return dedup.upsert_keep_last(history, new, keys, frames.latest_row(), old_is_unique=True)


over(
    frames.observations,
    "u03_distinct",
    lambda df: dedup.distinct_values(df, ["categoryId", "channelTitle"]),
)

# --- scalar functions -------------------------------------------------------------

over(
    frames.observations,
    "x01_x04_time_parts",
    lambda df: enrich.with_time_parts(df).select(
        *ROW_KEY,
        "publish_hour",
        "publish_day",
        F.col("publish_date").cast("string").alias("publish_date"),
        "trending_day",
        "trending_month",
        "trending_year",
        times.weekday_number(F.col("publishedAt")).alias("day_of_week"),
    ),
)
over(
    frames.observations,
    "x05_x06_epoch_and_days",
    lambda df: df.select(
        *ROW_KEY,
        times.epoch_seconds(F.col("publishedAt")).alias("pub_timestamp"),
        times.days_between(F.col("trending_date"), F.col("publishedAt")).alias("days"),
    ),
)
over(
    frames.observations,
    "x07_stamp_rows",
    lambda df: df.withColumn("processing_timestamp", F.current_timestamp())
    .groupBy(F.col("processing_timestamp").isNotNull().alias("stamped"))
    .agg(F.count("*").alias("rows")),
)
over(
    frames.raw,
    "x08_x10_text",
    lambda df: df.select(
        *ROW_KEY,
        times.is_iso(F.col("trending_date")).alias("iso"),
        F.regexp_replace("tags", '"', "").alias("bare"),
        text.join_tags(text.tag_list(F.col("tags"))).alias("joined"),
        text.ellipsize(F.col("title"), 12).alias("short"),
        text.ellipsize(F.col("title"), 10, always=True).alias("dotted"),
    ),
)
over(
    frames.observations,
    "x11_x13_math",
    lambda df: rounded(
        df.select(
            *ROW_KEY,
            rates.log_scale(F.col("view_count")).alias("scale"),
            rates.power_of_ten(rates.log_scale(F.col("likes")) / 4).alias("power"),
            F.abs(F.col("likes") - F.col("comment_count")).alias("gap"),
        ),
        "scale",
        "power",
    ),
)
over(
    frames.observations,
    "x14_x15_conditions",
    lambda df: df.select(
        *ROW_KEY,
        model.verdict(F.col("l_linenumber") * 9.0).alias("verdict"),
        text.nan_to_null(
            F.when(F.col("likes") == 0, F.lit(float("nan"))).otherwise(
                F.col("likes").cast("double")
            )
        ).alias("likes_or_null"),
        text.present(F.col("tags")).alias("has_tags"),
    ),
)
over(
    frames.observations,
    "x16_json",
    lambda df: df.select(
        F.from_json(
            text.to_message("video_id", "view_count"), "video_id string, view_count bigint"
        ).alias("m")
    ).select("m.*"),
)
over(
    frames.rated,
    "x17_x18_engagement",
    lambda df: rounded(df.select(*VIDEO_RATES), *RATES),
)
over(
    frames.observations,
    "x19_growth",
    lambda df: rounded(
        df.select(
            *ROW_KEY,
            rates.growth_percent(F.col("likes") * 12.5, F.col("view_count")).alias("growth"),
        ),
        "growth",
    ),
)
over(
    frames.observations,
    "x20_days_to_trend",
    lambda df: enrich.with_days_to_trend(df).select(*ROW_KEY, "days_to_trend"),
)

# --- model ------------------------------------------------------------------------

over(
    frames.observations,
    "m01_hash_sample",
    lambda df: model.hash_sample(df, ROW_KEY, 0.15).select(*ROW_KEY),
)
over(
    frames.observations,
    "m02_features",
    lambda df: rounded(
        model.with_features(df).select(*ROW_KEY, *FEATURES),
        "engagement_rate",
        "like_rate",
        "comment_rate",
        "like_comment_ratio",
        "view_scale",
        "engagement_scale",
    ),
)
over(
    frames.model_rows,
    "m03_label",
    lambda df: rounded(df.select(*ROW_KEY, LABEL), LABEL),
)


def _parts(df: DataFrame) -> DataFrame:
    early, late = model.time_split(df, "publishedAt", ROW_KEY)
    cols = (*ROW_KEY, "publishedAt")
    return (
        early.select(*cols, F.lit("train").alias("part"))
        .union(late.select(*cols, F.lit("valid").alias("part")))
    )


over(frames.observations, "m04_time_split", _parts)


@query("m05_standardise")
def m05(spark, d):
    """Mean and deviation the fitted scaler learnt, one row per feature."""
    rows = frames.model_rows(spark, d).select(*FEATURES, LABEL)
    stages = model.growth_pipeline().getStages()[:2]
    scaler = stages[1].fit(stages[0].transform(model.drop_incomplete(rows, FEATURES)))
    learnt = [
        (f, float(m), float(s)) for f, m, s in zip(FEATURES, scaler.mean, scaler.std)
    ]
    df = spark.createDataFrame(learnt, "feature string, mean double, std double")
    return rounded(df, "mean", "std", digits=5)


@query("m06_train")
def m06(spark, d):
    return frames.model(spark, d)[1].select(LABEL, "prediction")


@query("m06_held_out")
def m06_held_out(spark, d):
    """Which rows the model was not trained on, their labels, and that each has a prediction."""
    growth = F.col("prediction")
    rows = frames.model(spark, d)[1].withColumn("bounded", growth.between(0, 100) & ~F.isnan(growth))
    return rounded(rows.select(*ROW_KEY, LABEL, "bounded"), LABEL)


def _with_guess(df: DataFrame) -> DataFrame:
    return df.withColumn("prediction", F.col("view_scale") * 1.25)


over(
    frames.model_rows,
    "m07_m08_metrics",
    lambda df: rounded(
        model.regression_metrics(_with_guess(df)), "rmse", "mae", "r2", "mape"
    ),
)


@query("m07_model_quality")
def m07(spark, d):
    return model.regression_metrics(frames.model(spark, d)[1])


@query("m09_score")
def m09(spark, d):
    scored = model.score(frames.observations(spark, d), frames.model(spark, d)[0])
    return scored.select(*ROW_KEY, "view_count", "predicted_views")


@query("m09_scored_rows")
def m09_scored_rows(spark, d):
    """Which rows get predicted views, and that all of them are finite and not negative."""
    views = F.col("predicted_views")
    return m09(spark, d).select(
        *ROW_KEY, "view_count", (views > 0).alias("predicted"), views.between(0, 1e100).alias("bounded")
    )


over(
    frames.model_rows,
    "m10_back_transform",
    lambda df: rounded(
        df.select(
            *ROW_KEY, model.to_views(F.col(LABEL), F.col("engagement_rate")).alias("views")
        ),
        "views",
        digits=3,
    ),
)


@query("m11_fallback")
def m11(spark, d):
    """Rows without a publish time get 0, the others a prediction."""
    obs = frames.observations(spark, d)
    known = F.when(F.col("l_linenumber") != 1, F.col("publishedAt"))
    scored = model.score(obs.withColumn("publishedAt", known), frames.model(spark, d)[0])
    return scored.groupBy(F.col("publishedAt").isNull().alias("incomplete")).agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("predicted_views") > 0).alias("predicted"),
    )


# --- stream and serving -----------------------------------------------------------


def _stream(spark, d) -> str:
    """The whole table as a message stream through the scoring job, in two or more
    micro-batches; output folder."""
    root = scratch_path(spark, "stream")
    n = frames.publish_messages(spark, d, f"{root}/in", 8)
    stream = messages.read_message_files(spark, f"{root}/in", per_trigger=-(-n // 2))
    job = scoring.start(
        stream, frames.model(spark, d)[0], root, f"{root}/offsets", available_now=True
    )
    job.awaitTermination()
    return root


@query("st01_st04_scored_stream")
def st01(spark, d):
    """Every message is stored once, whatever the micro-batches were."""
    stored = versions.frame(spark, _stream(spark, d), sinks.REALTIME)
    return rounded(
        stored.groupBy("categoryId").agg(
            F.count("*").alias("rows"),
            F.sum("view_count").alias("views"),
            F.avg("engagement_rate").alias("rate"),
            F.count("publish_hour").alias("hours"),
        ),
        "rate",
    )


@query("st03_stream_category_stats")
def st03(spark, d):
    stored = versions.frame(spark, _stream(spark, d), sinks.CATEGORY_STATS)
    return stored.groupBy("categoryId").agg(
        F.sum("view_count_count").alias("rows"), F.sum("view_count_sum").alias("views")
    )


@query("st03_batch_totals")
def st03_totals(spark, d):
    totals = versions.frame(spark, frames.scored_tables(spark, d), sinks.TOTALS)
    return rounded(totals.drop("run_id"), "avg_engagement_rate")


@query("st03_top_videos")
def st03_top(spark, d):
    top = _known(versions.frame(spark, frames.scored_tables(spark, d), sinks.TOP_VIDEOS))
    named = top.drop("run_id").withColumnRenamed("list", "best_by").withColumn("rank", F.col("rank").cast("bigint"))
    return rounded(named, "growth_pct")


@query("st04_restart")
def st04(spark, d):
    """A stream that stops after its first messages and goes on from its checkpoint: each
    message is there once, and a batch of an earlier run that comes again adds nothing."""
    root = scratch_path(spark, "stream")
    done = 0
    for part in (0, 1):
        n = frames.publish_messages(spark, d, f"{root}/in", 4, f"l_linenumber % 2 = {part}")
        stream = messages.read_message_files(spark, f"{root}/in", per_trigger=max(1, (n - done) * 3 // 4))
        done = n
        scoring.start(stream, frames.known_model(), root, f"{root}/offsets", available_now=True).awaitTermination()
    again = messages.decode(sinks.as_messages(frames.message_rows(spark, d)))
    scoring.process_batch(again, 0, frames.known_model(), root, f"{root}/offsets")
    stored = versions.frame(spark, root, sinks.REALTIME)
    return stored.groupBy("categoryId").agg(F.count("*").alias("rows"), F.sum("view_count").alias("views"), F.sum(F.round("predicted_views").cast("bigint")).alias("predicted"))


@query("r01_latest_observations")
def r01(spark, d):
    latest = serving.read_observations(spark, frames.scored_tables(spark, d))
    return latest.select("processing_timestamp", "video_id", "trending_date")


@query("r02_top_predictions")
def r02(spark, d):
    return _known(serving.read_predictions(spark, frames.scored_tables(spark, d), 5)).drop("run_id", "batch_id", "timestamp")


@query("r03_latest_category_stats")
def r03(spark, d):
    latest = serving.read_category_stats(spark, frames.scored_tables(spark, d))
    return latest.select("timestamp", "categoryId", "view_count_count", "view_count_sum")
