"""Event-time operators over file streams: late and repeated messages, restarts."""

import json
import os
import random
from datetime import datetime, timedelta

import pytest

from trendlens.operators.dedup import keep_best, keep_first
from trendlens.sources import messages
from trendlens.streaming import events

START = datetime(2024, 5, 1, 10)
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def message(video, minute, views=1, category=10, day=1):
    at = START + timedelta(minutes=minute)
    return {"video_id": video, "categoryId": category, "view_count": views, "likes": 1, "trending_date": f"2024-01-{day:02}T00:00:00Z", "kafka_timestamp": f"{at:%Y-%m-%dT%H:%M:%S}"}


def feed(folder, n, batch):
    os.makedirs(folder, exist_ok=True)
    file = f"{folder}/{n:03}.json"
    with open(file, "w") as out:
        out.writelines(json.dumps(m) + "\n" for m in batch)
    os.utime(file, (1_700_000_000 + n, 1_700_000_000 + n))


def run(spark, tmp_path, make, mode="append"):
    stream = messages.decode(messages.read_message_files(spark, str(tmp_path / "in"), per_trigger=1))

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={batch_id}")

    writer = make(stream).writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "offsets")).outputMode(mode)
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{tmp_path}/out")


def test_repeats_within_the_watermark_go(spark, tmp_path):
    repeated = [message("a", 0), message("a", 0), message("b", 1)]
    feed(tmp_path / "in", 0, repeated)
    feed(tmp_path / "in", 1, [message("a", 0), message("c", 5), {**message("d", 5), "kafka_timestamp": None}])
    feed(tmp_path / "in", 2, [message("e", 60)])
    feed(tmp_path / "in", 3, [message("e", 60)])  # a batch drops what the one before found too late
    feed(tmp_path / "in", 4, [message("a", 0), message("f", 2), message("g", 55), message("g", 55)])  # two of them too late
    out = run(spark, tmp_path, events.deduplicated)
    assert sorted(r.video_id for r in out.collect()) == ["a", "b", "c", "e", "g"]
    in_time = messages.decode(spark.read.text(str(tmp_path / "in"))).filter("video_id IN ('a', 'b', 'c', 'e', 'g')")
    assert out.select("video_id", "kafka_timestamp").exceptAll(in_time.dropDuplicates(["video_id", "kafka_timestamp"]).select("video_id", "kafka_timestamp")).isEmpty()


def test_ten_minutes_with_late_data(spark, tmp_path):
    feed(tmp_path / "in", 0, [message("a", 1, 5), message("b", 9, 7), message("a", 11, 1), message("c", 3, 2, category=20)])
    feed(tmp_path / "in", 1, [message("d", 2, 100), message("e", 19, 3)])  # ten minutes late at most
    feed(tmp_path / "in", 2, [message("f", 45)])
    feed(tmp_path / "in", 3, [message("f", 46)])
    feed(tmp_path / "in", 4, [message("g", 4, 1000)])  # too late
    feed(tmp_path / "in", 5, [message("h", 90)])
    out = run(spark, tmp_path, events.windowed_stats)
    got = {(r.start.minute, r.categoryId): (r.messages, r.views, r.videos) for r in out.collect()}
    assert got == {(0, 10): (3, 112, 3), (0, 20): (1, 2, 1), (10, 10): (2, 4, 2), (40, 10): (2, 2, 1)}


def test_entity_views_equal_the_batch_views_after_a_restart(spark, tmp_path):
    draw = random.Random(7)
    columns = ["video_id", "categoryId", "view_count", "trending_date"]
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    try:
        for n in range(4):
            batch = [message(f"v{draw.randrange(6)}", n, draw.choice([None, 5, 5, draw.randrange(9)]), draw.randrange(30), draw.randrange(1, 9)) for _ in range(25)]
            feed(tmp_path / "in", n, batch)
            if n % 2:  # a new query on the same checkpoint each time
                out = run(spark, tmp_path, lambda s: events.entity_views(s, columns, ("view_count", "trending_date", "categoryId"), ("trending_date", "categoryId", "view_count")), "update")
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    rows = messages.decode(spark.read.text(str(tmp_path / "in"))).select(*columns)
    newest = {}
    for r in sorted(out.collect(), key=lambda r: r.batch):
        newest[r.view, r.video_id] = tuple(r[c] for c in columns)
    best = {("best", r.video_id): tuple(r) for r in keep_best(rows, tie=("trending_date", "categoryId")).collect()}
    first = {("first", r.video_id): tuple(r) for r in keep_first(rows, tie=("categoryId", "view_count")).collect()}
    assert newest == best | first


@pytest.mark.parametrize("make", [events.deduplicated, events.windowed_stats])
def test_state_is_bounded_by_the_watermark(spark, tmp_path, make):
    stream = messages.decode(messages.read_message_files(spark, str(tmp_path)))
    plan = make(stream)._jdf.queryExecution().analyzed().toString()
    assert "EventTimeWatermark" in plan
    assert make(stream).isStreaming
