"""Versioned tables: what readers see while jobs fail, run side by side or tidy up."""

import random
import threading
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trendlens.operators.dedup import upsert_keep_last
from trendlens.plans import frames
from trendlens.sources import messages
from trendlens.streaming import scoring, serving, sinks, versions

SCHEMA = "video_id string, trending_date string, n int, snapshot_month string"
OLD = [("a", "2024-01-01", 1, "2024-01"), ("a", "2024-02-01", 2, "2024-02"), ("x", None, 5, None)]
NEW = [("a", "2024-02-01", 9, "2024-02"), ("b", "2024-02-01", 3, "2024-02"), ("b", "2024-03-01", 4, "2024-03"), ("y", None, 6, None)]
MERGED = {("a", "2024-01-01", 1), ("a", "2024-02-01", 9), ("b", "2024-02-01", 3), ("b", "2024-03-01", 4), ("x", None, 5), ("y", None, 6)}
DAY = datetime(2024, 5, 1, 10)


def rows(df):
    return {(r["video_id"], r["trending_date"], r["n"]) for r in df.collect()}


@pytest.fixture
def history(spark, tmp_path):
    path = str(tmp_path / "history")
    sinks.write_history(spark.createDataFrame(OLD, SCHEMA), path)
    return path


def folders(spark, path):
    return {p["values"]["snapshot_month"]: p["folder"] for p in versions.current(spark, path)["tables"][sinks.HISTORY]["parts"]}


def test_merge_rewrites_touched_months_only(spark, history):
    before = folders(spark, history)
    assert sinks.merge_history(spark, spark.createDataFrame(NEW, SCHEMA), history) == 2
    after = folders(spark, history)
    assert rows(sinks.read_history(spark, history)) == MERGED
    assert after["2024-01"] == before["2024-01"] and after["2024-02"] != before["2024-02"]
    assert set(after) == {"2024-01", "2024-02", "2024-03", None}


def test_merge_reads_touched_months_only(spark, history, monkeypatch):
    read = []

    def spied(old, new, *rest):
        read.extend(old.inputFiles())
        return upsert_keep_last(old, new, *rest)

    monkeypatch.setattr(sinks, "upsert_keep_last", spied)
    sinks.merge_history(spark, spark.createDataFrame(NEW[:2], SCHEMA), history)
    assert read and all("snapshot_month=2024-02" in f for f in read)


def test_first_load_into_no_history(spark, tmp_path):
    path = str(tmp_path / "none")
    sinks.merge_history(spark, spark.createDataFrame(NEW, SCHEMA), path)
    assert rows(sinks.read_history(spark, path)) == {r[:3] for r in NEW}


def test_empty_load_changes_nothing(spark, history):
    sinks.merge_history(spark, spark.createDataFrame([], SCHEMA), history)
    assert rows(sinks.read_history(spark, history)) == {r[:3] for r in OLD}


def test_job_lost_before_the_switch_leaves_the_old_rows(spark, history, monkeypatch):
    def lost(*_):
        raise ConnectionError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "_publish", lost)
        with pytest.raises(ConnectionError):
            sinks.merge_history(spark, spark.createDataFrame(NEW, SCHEMA), history)
    assert rows(sinks.read_history(spark, history)) == {r[:3] for r in OLD}
    sinks.merge_history(spark, spark.createDataFrame(NEW, SCHEMA), history)
    assert rows(sinks.read_history(spark, history)) == MERGED


def test_a_reader_keeps_its_version(spark, history):
    held = sinks.read_history(spark, history)
    sinks.merge_history(spark, spark.createDataFrame(NEW, SCHEMA), history)
    assert rows(held) == {r[:3] for r in OLD}


@pytest.mark.parametrize("month", ["2024-02", "2024-07"])
def test_loads_side_by_side(spark, history, monkeypatch, month):
    """Another load commits between this one's writing and its switch."""
    other = [("c", f"{month}-03", 8, month)]
    publish, calls = versions._publish, []

    def slow(*state):
        calls.append(1)
        if len(calls) == 1:
            with monkeypatch.context() as patch:
                patch.setattr(versions, "_publish", publish)
                sinks.merge_history(spark, spark.createDataFrame(other, SCHEMA), history)
        publish(*state)

    monkeypatch.setattr(versions, "_publish", slow)
    sinks.merge_history(spark, spark.createDataFrame(NEW, SCHEMA), history)
    assert rows(sinks.read_history(spark, history)) == MERGED | {other[0][:3]}


def test_tidy_deletes_what_no_late_version_names(spark, history):
    for k in range(3):
        sinks.merge_history(spark, spark.createDataFrame([("a", "2024-02-01", 20 + k, "2024-02")], SCHEMA), history)
    assert versions.tidy(spark, history, older_than=3600) == []
    gone = versions.tidy(spark, history, older_than=-3600, keep=1)
    # the first folder still holds the other months
    assert len(gone) == 2
    assert rows(sinks.read_history(spark, history)) == {("a", "2024-01-01", 1), ("x", None, 5), ("a", "2024-02-01", 22)}


# --- the stream's tables ----------------------------------------------------------


def batch_of(spark, small, k):
    return messages.decode(sinks.as_messages(frames.message_rows(spark, small, f"l_linenumber = {k + 1}"))).limit(50)


def test_failed_batch_is_in_no_table(spark, small, tmp_path, monkeypatch):
    root, model = str(tmp_path), frames.known_model()
    assert scoring.process_batch(batch_of(spark, small, 0), 0, model, root, now=DAY)
    before = {t: versions.frame(spark, root, t).count() for t in sinks.STAMPS}
    assert before[sinks.REALTIME] == 50 and before[sinks.PREDICTIONS] == 10
    write, calls = versions.write, []

    def failing(*args, **kwargs):
        calls.append(1)
        if len(calls) == 3:
            raise OSError("no space")
        return write(*args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(versions, "write", failing)
        with pytest.raises(OSError, match="no space"):
            scoring.process_batch(batch_of(spark, small, 1), 1, model, root, now=DAY)
    assert {t: versions.frame(spark, root, t).count() for t in sinks.STAMPS} == before
    for late in (1, 2):  # the replay, and one more
        assert scoring.process_batch(batch_of(spark, small, 1), 1, model, root, now=DAY + timedelta(days=late)) == (late == 1)
    assert versions.frame(spark, root, sinks.REALTIME).count() == 100
    assert versions.frame(spark, root, sinks.PREDICTIONS).select("batch_id").distinct().collect() == [(1,)]
    # the second replay moved no time
    assert versions.frame(spark, root, sinks.TOTALS).agg(F.max("timestamp")).first()[0] == DAY + timedelta(days=1)


def small_batch(spark, k):
    return {sinks.REALTIME: spark.range(3 * k, 3 * k + 3, numPartitions=1).select(F.concat(F.lit("v"), "id").alias("video_id"), F.lit(None).cast("string").alias("trending_date"))}


def commit(spark, root, k):
    return sinks.commit_batch(spark, small_batch(spark, k), root, "run", k, DAY + timedelta(minutes=20 * k))


def test_compaction_beside_a_stream(spark, tmp_path):
    root, n = str(tmp_path), 200
    stop, done = threading.Event(), []

    def keep_compacting():
        while not stop.is_set():
            done.append(versions.compact(spark, root, sinks.REALTIME))

    worker = threading.Thread(target=keep_compacting)
    commit(spark, root, 0)
    worker.start()
    try:
        for k in range(1, n):
            assert commit(spark, root, k)
    finally:
        stop.set()
        worker.join()
    versions.compact(spark, root, sinks.REALTIME)
    parts = versions.current(spark, root)["tables"][sinks.REALTIME]["parts"]
    days = {p["values"]["day"] for p in parts}
    assert len(days) == 4 and len(parts) <= 3 * 3 * len(days) and sum(done) > 0
    assert sum(p["rows"] for p in parts) == 3 * n
    assert not commit(spark, root, 17)  # an old batch again
    stored = versions.frame(spark, root, sinks.REALTIME)
    assert sorted(int(r[0][1:]) for r in stored.select("video_id").collect()) == list(range(3 * n))
    assert stored.select("batch_id").distinct().count() == n
    # the newest rows come from the last day's few folders
    latest = serving.read_observations(spark, root, 6)
    assert [r.batch_id for r in latest.collect()] == [199] * 3 + [198] * 3
    newest = serving.newest(spark, root, sinks.REALTIME, 6)
    assert newest.inputFiles() and all(f"day={max(days)}" in f for f in newest.inputFiles())


def test_newest_parts_hold_the_newest_rows():
    draw = random.Random(5)
    for _ in range(300):
        parts = []
        for _ in range(draw.randrange(1, 9)):
            times = sorted(draw.randrange(30) for _ in range(draw.randrange(1, 6)))
            parts.append({"times": times, "newest": f"{times[-1]:02}", "oldest": f"{times[0]:02}", "rows": len(times)})
        n = draw.randrange(1, 12)
        taken = serving.newest_parts(parts, n)
        every = sorted((t for p in parts for t in p["times"]), reverse=True)
        held = sorted((t for p in taken for t in p["times"]), reverse=True)
        # all rows as new as the n-th are there, so ties are too
        cut = every[min(n, len(every)) - 1]
        assert [t for t in held if t >= cut] == [t for t in every if t >= cut]


def test_writers_try_again_on_each_other(spark, tmp_path):
    root, schema = str(tmp_path), spark.range(1).schema.json()
    threads = [threading.Thread(target=versions.change, args=(spark, root, lambda s, k=k: versions.add(s, "t", schema, [{"folder": f"t/load={k}"}]))) for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    state = versions.current(spark, root)
    assert state["version"] == 8 and sorted(p["folder"] for p in state["tables"]["t"]["parts"]) == [f"t/load={k}" for k in range(8)]


def test_empty_batch(spark, small, tmp_path):
    root = str(tmp_path)
    empty = batch_of(spark, small, 0).filter("false")
    assert scoring.process_batch(empty, 0, frames.known_model(), root, now=DAY)
    assert versions.frame(spark, root, sinks.REALTIME).count() == 0
    assert serving.read_observations(spark, root).count() == 0


def test_tables_of_a_batch_are_made_from_its_rows_as_written(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = spark.range(50).select("id", F.rand().alias("x"))  # other values each time it is computed
    outputs = {sinks.REALTIME: rows, sinks.TOTALS: lambda stored: stored.agg(F.sum("x").alias("total"))}
    assert sinks.commit_batch(spark, outputs, root, "run", 0, DAY)
    stored = versions.frame(spark, root, sinks.REALTIME).agg(F.sum("x")).first()[0]
    assert versions.frame(spark, root, sinks.TOTALS).first()["total"] == pytest.approx(stored)


def test_rows_of_a_video_lie_side_by_side(spark, tmp_path):
    new = spark.range(4000).selectExpr(
        "concat('v', id % 40) AS video_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, id) AS trending_date", "id AS view_count"
    ).repartition(8)
    month = F.date_format("trending_date", "yyyy-MM")
    sinks.merge_history(spark, new.withColumn("snapshot_month", month), str(tmp_path / "h"))
    stored = sinks.read_history(spark, str(tmp_path / "h"))
    assert stored.count() == 4000
    spread = stored.withColumn("file", F.input_file_name()).groupBy("snapshot_month", "video_id").agg(F.count_distinct("file").alias("n"))
    assert spread.agg(F.max("n")).first()[0] == 1
    rows = [r[0] for r in stored.select("video_id").collect()]
    assert sum(a != b for a, b in zip(rows, rows[1:], strict=False)) < 400


def test_no_commit_of_writers_side_by_side_is_lost(spark, tmp_path):
    root, errors = str(tmp_path), []

    def writer(name):
        def count(state):
            state["notes"][name] = state["notes"].get(name, 0) + 1
            return state

        try:
            for _ in range(25):
                versions.change(spark, root, count, attempts=500)
        except Exception as error:
            errors.append(error)

    workers = [threading.Thread(target=writer, args=(name,)) for name in "abcd"]
    for w in workers:
        w.start()
    for w in workers:
        w.join()
    assert not errors
    state = versions.current(spark, root)
    assert state["version"] == 100 and state["notes"] == dict.fromkeys("abcd", 25)
    assert len(list((tmp_path / versions.MANIFESTS).iterdir())) == 100  # nothing unfinished is left
