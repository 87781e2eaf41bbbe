"""Monthly states: what a load rereads, and that reports equal those over all rows."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from trendlens.operators import category, dedup, engagement, enrich, partials, timing
from trendlens.operators.clean import cast_metrics
from trendlens.plans import jobs
from trendlens.streaming import sinks, versions

SCHEMA = """video_id string, title string, channelTitle string, categoryId int, publishedAt timestamp_ntz,
trending_date timestamp_ntz, view_count long, likes long, dislikes long, comment_count long, snapshot_month string"""


def load(draw, months, n):
    rows = {}
    for _ in range(n):
        seen = datetime(2024, draw.choice(months), draw.randrange(1, 29), draw.randrange(3))
        video = f"v{draw.randrange(25)}"
        number = lambda m: draw.choice([None, 0, *range(1, m)])
        published = draw.choice([None, seen - timedelta(hours=draw.randrange(500))])
        rows[video, seen] = (video, f"t {video}", draw.choice(["a", "b", "c", None]), draw.choice([1, 10, 29, 43, None]), published, seen, number(900), number(90), number(9), number(9), f"{seen:%Y-%m}")
    return list(rows.values())


def rows_of(df):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def test_reports_follow_three_loads(spark, tmp_path):
    path, draw, tie = str(tmp_path / "h"), random.Random(4), ("trending_date",)
    before = {}
    for months in ([1, 2, 3, 4], [2], [4, 5]):
        data = spark.createDataFrame(load(draw, months, 90), SCHEMA)
        sinks.merge_history(spark, data, path, derived=partials.states(tie))
        tables = versions.current(spark, path)["tables"]
        for table in (sinks.HISTORY, *partials.states()):
            after = {p["values"]["snapshot_month"]: p["folder"] for p in tables[table]["parts"]}
            kept = {m for m, f in before.get(table, {}).items() if after[m] == f}
            assert kept == set(before.get(table, {})) - {f"2024-{m:02}" for m in months}
            before[table] = after
    obs = cast_metrics(sinks.read_history(spark, path).drop("snapshot_month"))
    entity = dedup.keep_best(obs, by="view_count_num", tie=tie)
    first = enrich.with_days_to_trend(dedup.keep_first(obs))
    rated = enrich.with_engagement(entity)
    whole = {
        "category_counts": category.counts(obs),
        "category_shares": category.shares(obs),
        "total_views": category.total_views(entity),
        "unique_channels": category.unique_channels(obs),
        "average_metrics": category.average_metrics(obs),
        "channel_concentration": category.channel_concentration(obs),
        "like_dislike_ratio": category.like_dislike_ratio(obs),
        "publish_hours": timing.per_publish_hour(obs),
        "publish_days": timing.per_weekday(obs, "publishedAt", "publish_day"),
        "trending_days": timing.per_weekday(obs, "trending_date", "trending_day"),
        "time_to_trend": timing.time_to_trend(first),
        "days_distribution": timing.days_distribution(first),
        "same_day": timing.same_day(first),
        "hour_by_weekday": timing.hour_by_weekday(obs),
        "engagement_bands": engagement.bands(rated),
        "time_to_trend_per_category": timing.time_to_trend_per_category(first),
        "metrics_per_publish_hour": timing.metrics_per_publish_hour(entity),
        "lifespan": timing.lifespan(obs),
        "rates_per_category": engagement.rates_per_category(rated),
        "engagement_totals": engagement.totals(rated),
    }
    found = jobs.history_reports(spark, path)
    assert set(found) == set(whole)
    for name, df in whole.items():
        assert rows_of(found[name]) == rows_of(df), name


def test_states_read_the_touched_months_only(spark, tmp_path):
    path, draw, read = str(tmp_path / "h"), random.Random(5), []

    def spied(obs, part):
        read.extend(obs.inputFiles())
        return partials.cells(obs, part)

    sinks.merge_history(spark, spark.createDataFrame(load(draw, [1, 2, 3], 60), SCHEMA), path, derived={"cells": partials.cells})
    sinks.merge_history(spark, spark.createDataFrame(load(draw, [2], 10), SCHEMA), path, derived={"cells": spied})
    assert read and all("snapshot_month=2024-02" in f for f in read)


def test_sketches_unite_within_their_error(spark):
    obs = spark.range(60_000).select(
        F.concat(F.lit("m"), F.col("id") % 5).alias("m"), (F.col("id") % 3).cast("int").alias("categoryId"), F.concat(F.lit("c"), F.col("id") % 20_000).alias("channelTitle")
    )
    held = partials.sketches(obs, "m")
    assert held.agg(F.max(F.length("channels"))).first()[0] < 10_000
    exact = {r[0]: r[1] for r in obs.groupBy("categoryId").agg(F.count_distinct("channelTitle")).collect()}
    for r in partials.estimated_channels(held).collect():
        assert abs(r["unique_channels"] - exact[r["categoryId"]]) <= 0.05 * exact[r["categoryId"]]
    assert abs(partials.estimated_total_channels(held).first()[0] - 20_000) <= 1_000


def test_a_load_runs_twice(spark, tmp_path):
    payload = """{"items": [{"id": "v1", "snippet": {"title": "t", "publishedAt": "2024-01-01T00:00:00Z", "channelTitle": "c", "categoryId": "10"},
      "statistics": {"viewCount": "5", "likeCount": "1"}}, {"id": "v2", "snippet": {"title": "u"}, "statistics": {}}]}"""
    day = spark.createDataFrame([(payload, datetime(2024, 1, 3))], "payload string, at timestamp_ntz")
    path = str(tmp_path / "h")
    for _ in range(2):
        jobs.run_load(spark, day, "payload", F.col("at"), path)
    assert sorted(tuple(r) for r in sinks.read_history(spark, path).select("video_id", "view_count", "snapshot_month").collect()) == [("v1", 5, "2024-01"), ("v2", 0, "2024-01")]
    assert {r["category_name"]: r["count"] for r in jobs.history_reports(spark, path)["category_counts"].collect()} == {"Music": 1, "Unknown": 1}


def test_a_load_reads_its_payloads_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def payload(k):
        read.add(1)
        return '{"items": [{"id": "v%d", "snippet": {"publishedAt": "2024-01-01T00:00:00Z"}, "statistics": {"viewCount": "5"}}]}' % k

    payloads = spark.range(20).select(payload("id").alias("payload"))
    jobs.run_load(spark, payloads, "payload", F.lit("2024-02-03 00:00:00").cast("timestamp_ntz"), str(tmp_path / "h"))
    assert sinks.read_history(spark, str(tmp_path / "h")).count() == 20
    assert read.value == 20
