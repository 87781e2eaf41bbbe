"""The physical plans that make the operators hold at scale."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from trendlens.operators import category, clean, correlation, dedup, model, timing, topn
from trendlens.plans import frames, jobs, queries
from trendlens.plans.queries import QUERIES
from trendlens.sources import star


def test_entity_view_limits_groups_before_the_shuffle(spark, small):
    plan = plan_of(frames.entity(spark, small))
    assert "Partial" in plan.split("Exchange hashpartitioning(video_id")[1]
    assert plan.count("WindowGroupLimit") == 2
    assert "SinglePartition" not in plan


def test_unused_publish_time_costs_nothing(spark, small):
    plan = plan_of(category.counts(frames.metrics(spark, small)))
    assert plan.count("FileScan") == 2  # line items and parts, no second pass
    assert "l_shipdate" not in plan and "l_quantity" not in plan
    assert plan_of(timing.per_publish_hour(frames.metrics(spark, small))).count("FileScan") == 3


def test_top_n_is_not_a_full_sort(spark, small):
    plan = plan_of(topn.top_n(frames.metrics(spark, small), "view_count_num", 10))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_aggregates_combine_before_the_shuffle(spark, small):
    obs = frames.metrics(spark, small)
    for df in (category.counts(obs), timing.hour_by_weekday(obs), timing.lifespan(obs)):
        assert "partial_count" in plan_of(df) or "partial_min" in plan_of(df)
    assert "Expand" not in plan_of(category.channel_concentration(obs))


def test_correlation_reads_its_input_once(spark, small):
    plan = plan_of(correlation.correlation_matrix(frames.rated(spark, small)))
    assert plan.count("FileScan") == 2


def test_split_is_two_filters(spark, small):
    obs = frames.observations(spark, small)
    cut = model.find_cut(obs, "publishedAt", frames.ROW_KEY)
    for part in model.split_at(obs, cut, "publishedAt", frames.ROW_KEY):
        plan = plan_of(part)
        assert "Window" not in plan and "SinglePartition" not in plan


def test_unique_history_is_not_shuffled_by_an_upsert(spark):
    old = spark.range(1000).selectExpr("id AS video_id", "id AS trending_date", "1 AS n")
    new = old.limit(10)
    df = dedup.upsert_keep_last(old, new, latest=[F.desc("n")], old_is_unique=True)
    old_side = plan_of(df).split("Union")[1].split("BroadcastExchange")[0]
    assert "LeftAnti" in old_side and "Exchange hashpartitioning" not in old_side


@pytest.fixture
def skewed(spark, small, tmp_path):
    """The star tables with a third of all line items on one part."""
    hot = F.when(F.col("l_orderkey") % 3 == 0, F.lit(1).cast("bigint"))
    lines = star.table(spark, small, "lineitem")
    lines = lines.withColumn("l_partkey", F.coalesce(hot, F.col("l_partkey")))
    lines.repartition(12).write.parquet(str(tmp_path / "lineitem.parquet"))
    star.table(spark, small, "part").write.parquet(str(tmp_path / "part.parquet"))
    return str(tmp_path)


def test_hot_video_is_split_over_tasks(spark, skewed):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "30k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        obs = star.observations(spark, skewed, broadcast_up_to=0)
        best = dedup.keep_best(clean.cast_metrics(obs), by="view_count_num", tie=star.TIE)
        shuffled = best.select("video_id", "view_count_num", "publishedAt")
        rows = {tuple(r) for r in shuffled.collect()}
        plan = plan_of(shuffled)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in plan
    assert rows == {
        tuple(r)
        for r in dedup.keep_best(
            clean.cast_metrics(star.observations(spark, skewed)), by="view_count_num", tie=star.TIE
        )
        .select("video_id", "view_count_num", "publishedAt")
        .collect()
    }


def test_queries_do_not_pass_rows_through_one_task(spark, small):
    """Row-level inputs are never gathered; a single partition only holds aggregates."""
    for name in ("w02_keep_first", "p09_category_name", "m02_features", "k03_upsert_keep_last"):
        assert "SinglePartition" not in plan_of(QUERIES[name](spark, small)), name


def test_jobs_end_to_end(spark, small, tmp_path):
    raw, cleaned, tags = (str(tmp_path / n) for n in ("raw", "clean", "tags"))
    frames.raw_file_rows(spark, small).write.option("header", True).option("escape", '"').csv(raw)
    jobs.run_cleaning(spark, raw, cleaned, tags)
    obs = spark.read.parquet(cleaned)
    assert obs.count() == frames.observations(spark, small).count() == spark.read.parquet(tags).count()

    reports = jobs.reports(obs)
    for name, df in reports.items():
        assert len(df.take(1)) == 1, name
    total = reports["interaction_summary"].first()["total_videos"]
    assert total == obs.select("video_id").distinct().count()

    metrics = jobs.run_training(
        spark, cleaned, str(tmp_path / "model"), fraction=1.0, iterations=3, depth=3
    ).first()
    assert metrics["rmse"] > 0

    stream_in = str(tmp_path / "in")
    from trendlens.sources.messages import read_message_files
    from trendlens.streaming import sinks

    sinks.publish_files(frames.raw_file_rows(spark, small), stream_in)
    job = jobs.run_stream(
        read_message_files(spark, stream_in),
        str(tmp_path / "model"),
        str(tmp_path / "out"),
        str(tmp_path / "offsets"),
        available_now=True,
    )
    job.awaitTermination()
    stored = spark.read.parquet(str(tmp_path / "out" / sinks.REALTIME))
    assert stored.count() == frames.raw(spark, small).count()


def test_history_of_one_row_a_key_takes_new_rows(spark, monkeypatch):
    schema = "video_id string, trending_date string, view_count long, l_orderkey long, l_linenumber int, l_suppkey long"
    old = [("a", "1", 1, 1, 1, 1), ("a", "1", 2, 2, 1, 1), (None, "1", 3, 3, 1, 1), ("b", None, 4, 4, 1, 1)]
    new = [("a", "1", 0, 5, 1, 1), (None, "1", 9, 6, 1, 1), (None, "1", 8, 7, 1, 1), ("c", "2", 5, 8, 1, 1)]
    frames_of = tuple(spark.createDataFrame(rows, schema) for rows in (old, new))
    monkeypatch.setattr(queries, "_history", lambda spark, d: frames_of)
    got = QUERIES["u02_upsert_unique_history"](spark, "").select("l_orderkey").collect()
    assert sorted(r[0] for r in got) == [4, 5, 6, 8]
