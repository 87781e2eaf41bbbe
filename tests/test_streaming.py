import json
import os
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from trendlens.operators import model
from trendlens.plans import frames
from trendlens.plans.queries import QUERIES
from trendlens.sources import messages, star
from trendlens.streaming import scoring, serving, sinks, versions


@pytest.fixture(scope="module")
def fitted(spark):
    rows = frames.model_rows(spark, "/root/testdata/sf0.001")
    return model.train(rows, frames.ROW_KEY, iterations=3, depth=3)[0]


def message(i, **changes):
    return {
        "video_id": f"v{i}",
        "title": f"title {i}",
        "publishedAt": "2024-01-06T20:00:00Z",
        "channelTitle": "c",
        "categoryId": 10 if i % 2 else "20",  # a number or text, both occur
        "trending_date": "2024-01-08T00:00:00Z",
        "view_count": 1000 * i,
        "likes": 10 * i,
        "dislikes": 0,
        "comment_count": i,
        "kafka_timestamp": "2024-01-08T00:00:01.5",
        **changes,
    }


def write_files(folder, batches):
    folder.mkdir()
    for n, batch in enumerate(batches):
        lines = "\n".join(json.dumps(m) for m in batch)
        file = folder / f"{n:03}.json"
        file.write_text(lines + "\n")
        os.utime(file, (1_700_000_000 + n, 1_700_000_000 + n))  # the source reads in this order


def test_decode(spark):
    rows = [json.dumps(message(1)), json.dumps(message(2)), "not json"]
    df = messages.decode(spark.createDataFrame([(r,) for r in rows], "value string"))
    got = df.select("video_id", "categoryId", "view_count", "kafka_timestamp").collect()
    assert [r["categoryId"] for r in got] == [10, 20, None]
    assert got[0]["view_count"] == 1000 and got[0]["kafka_timestamp"].microsecond == 500000


def test_stream_equals_batch_and_survives_replay(spark, fitted, tmp_path):
    batches = [[message(10 * b + i) for i in range(10)] for b in range(3)]
    batches[1][0]["publishedAt"] = "unknown"  # incomplete: predicted as 0
    batches[2][9].update(title=None, categoryId=None, view_count=10**7)
    write_files(tmp_path / "in", batches)
    root = str(tmp_path / "out")

    def run():
        stream = messages.read_message_files(spark, str(tmp_path / "in"), per_trigger=1)
        job = scoring.start(stream, fitted, root, str(tmp_path / "offsets"), available_now=True)
        job.awaitTermination()

    run()
    stored = versions.frame(spark, root, sinks.REALTIME)
    every = [f"v{i}" for i in range(30)]
    assert sorted(r[0] for r in stored.select("video_id").collect()) == sorted(every)
    assert stored.select("batch_id").distinct().count() == 3
    assert stored.select("batch_id", "processing_timestamp").distinct().count() == 3

    text = spark.read.text(str(tmp_path / "in"))
    batch = model.score(messages.decode(text), fitted)
    cols = ["video_id", "categoryId", "view_count", "engagement_rate", "predicted_views"]
    assert stored.select(*cols).exceptAll(batch.select(*cols)).isEmpty()
    assert stored.filter("video_id = 'v10'").first()["predicted_views"] == 0

    run()  # nothing new: the checkpoint remembers
    assert versions.frame(spark, root, sinks.REALTIME).count() == 30

    # the same batch once more, as after a lost commit
    again = messages.decode(text).filter("int(substring(video_id, 2)) >= 20")
    scoring.process_batch(again, 2, fitted, root, str(tmp_path / "offsets"))
    stored = versions.frame(spark, root, sinks.REALTIME)
    assert sorted(r[0] for r in stored.select("video_id").collect()) == sorted(every)

    stats = versions.frame(spark, root, sinks.CATEGORY_STATS)
    assert stats.filter("categoryId IS NULL").isEmpty()
    assert stats.agg(F.sum("view_count_count")).first()[0] == 29

    top = serving.top_predictions(versions.frame(spark, root, sinks.PREDICTIONS)).collect()
    assert len(top) == 10 and {r["batch_id"] for r in top} == {2}
    fallback = [r for r in top if r["title"] == "Unknown"]
    assert len(fallback) == 1 and fallback[0]["categoryId"] == 24
    assert serving.latest_observations(stored, 5).count() == 5
    assert serving.latest_category_stats(stats).count() == stats.count()

    sinks.reset_outputs(spark, root)
    assert versions.frame(spark, root, sinks.REALTIME).count() == 0
    assert versions.frame(spark, root, sinks.PREDICTIONS).columns[0] == "video_id"
    assert versions.frame(spark, root, sinks.CATEGORY_STATS).count() == stats.count()


def test_batch_reports(spark):
    rows = [(json.dumps(message(i)),) for i in range(1, 6)]
    df = model.with_features(messages.decode(spark.createDataFrame(rows, "value string")))
    assert tuple(scoring.batch_totals(df).first())[:2] == (5, 15000)
    top = scoring.top_viewed(df).collect()
    assert [r["title"] for r in top] == ["title 5...", "title 4...", "title 3..."]
    predicted = df.withColumn("predicted_views", F.col("view_count") * 1.5)
    assert scoring.top_predicted(predicted).first()["growth_pct"] == 50.0
    nan = spark.sql("SELECT CAST('NaN' AS DOUBLE) AS d, 1 AS i")
    assert tuple(scoring.without_nan(nan).first()) == (None, 1)


def test_messages_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 'q"|"z', "đã lưu")], "video_id string, tags string, title string")
    sinks.publish_files(df, str(tmp_path / "out"))
    back = messages.decode(spark.read.text(str(tmp_path / "out"))).first()
    assert (back["video_id"], back["tags"], back["title"]) == ("a", 'q"|"z', "đã lưu")


def test_partitioned_write_makes_few_files(spark, small, tmp_path):
    obs = frames.observations(spark, small).repartition(8)
    year = F.year("trending_date").alias("y")
    sinks.write_clean(obs.select("*", year), str(tmp_path / "t"), ["y"])
    folders = list((tmp_path / "t").glob("y=*"))
    assert len(folders) > 3
    assert all(len(list(f.glob("*.parquet"))) == 1 for f in folders)
    assert spark.read.parquet(str(tmp_path / "t")).count() == obs.count()


def test_new_checkpoint_keeps_stored_batches(spark, fitted, tmp_path):
    root = str(tmp_path / "out")
    for k, name in enumerate(("first", "second")):
        write_files(tmp_path / name, [[message(100 * k + 10 * b + i) for i in range(10)] for b in range(2 - k)])
        stream = messages.read_message_files(spark, str(tmp_path / name), per_trigger=1)
        scoring.start(stream, fitted, root, str(tmp_path / f"offsets-{name}"), available_now=True).awaitTermination()
    stored = versions.frame(spark, root, sinks.REALTIME)
    assert sorted(int(r[0][1:]) for r in stored.select("video_id").collect()) == [*range(20), *range(100, 110)]
    top = serving.top_predictions(versions.frame(spark, root, sinks.PREDICTIONS), 100).collect()
    assert {(r["run_id"], r["batch_id"]) for r in top} == {(top[0]["run_id"], 0)}
    runs = dict(stored.select("video_id", "run_id").collect())
    assert top[0]["run_id"] == runs["v100"] != runs["v0"]


def test_published_files_are_small_and_all_read(spark, tmp_path):
    df = spark.range(1000).selectExpr("concat('v', id) AS video_id", "repeat('title ', 20) AS title").coalesce(1)
    sinks.publish_files(df, str(tmp_path / "out"), most=300)
    files = list((tmp_path / "out").glob("part-*"))
    assert len(files) == 4 and sum(f.stat().st_size for f in files) < 50_000
    assert messages.decode(spark.read.text(str(tmp_path / "out"))).select("video_id").distinct().count() == 1000


def test_messages_are_dealt_by_their_number(spark, small, monkeypatch):
    rows = spark.read.parquet(f"{small}/lineitem.parquet").count()
    assert frames.message_files(spark, small, 4) == 4
    monkeypatch.setattr(sinks, "MESSAGES_PER_FILE", rows // 10)
    assert frames.message_files(spark, small, 4) >= 10


@pytest.mark.parametrize("videos", [30, 10**9])  # few, which are broadcast, and many, which are shuffled
def test_messages_are_not_shuffled_whole(spark, tmp_path, monkeypatch, videos):
    parts = [(k, f"part {k}", "Brand#1", "STEEL", 1, 1.0) for k in range(1, 31)]
    day = datetime(1996, 1, 1)
    # a third of the rows on one video, some twice, some of a video that is not there
    lines = [(1 + i % 90, 7 if i % 3 == 0 else i % 33, 1, 1 + i % 7, 2.0, 10.0 + i % 90, 0.1, 0.1, "N", "O", day) for i in range(400)]
    lines += [(500, None, 1, 1, 2.0, 10.0, 0.1, 0.1, "N", "O", day)]
    for name, rows in (("part", parts), ("lineitem", lines)):
        spark.createDataFrame(rows, star.SCHEMAS[name]).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    known = [x for x in lines if x[1] in range(1, 31)]
    count, views = Counter(), Counter()
    for x in known:
        category = star.CATEGORY_CYCLE[x[1] % 16]
        count[category] += 1
        views[category] += round(x[5] * 100)

    published, publish = [], sinks.publish_files
    monkeypatch.setattr(sinks, "publish_files", lambda df, path, *most: (published.append((df, path)), publish(df, path, *most)))
    monkeypatch.setattr(frames, "model", lambda spark, d: (frames.known_model(), None))
    monkeypatch.setattr(star, "_video_count", lambda spark, d: videos)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = QUERIES["st03_stream_category_stats"](spark, str(tmp_path)).collect()
        assert {tuple(r) for r in got} == {(c, count[c], views[c]) for c in count}
        restart = QUERIES["st04_restart"](spark, str(tmp_path)).collect()
        assert {tuple(r)[:3] for r in restart} == {(c, count[c], views[c]) for c in count}
        assert len(published) == 3
        for df, path in published:
            plan = plan_of(df)
            assert "Exchange" in plan and "Exchange" not in plan.split("Join")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for path, least, batches in ((published[0][1], 8, 2), (published[1][1], 4, 4)):
        root = path.removesuffix("/in")
        files = spark.read.text(path).inputFiles()
        assert len(files) >= least
        stored = versions.frame(spark, root, sinks.REALTIME)
        assert stored.count() == len(known) and stored.select("batch_id").distinct().count() == batches
