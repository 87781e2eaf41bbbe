"""CSV records over many tasks, against the one-task reader."""

import csv
import random

import pytest

from tests.conftest import plan_of
from trendlens.operators import clean
from trendlens.plans import jobs
from trendlens.schema import OLD_RAW_SCHEMA, RAW_SCHEMA
from trendlens.sources.files import read_observations
from trendlens.sources.records import BAD, good_and_bad, read_records, record_texts

NAMES = RAW_SCHEMA.fieldNames()


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for key, value in old.items():
        spark.conf.set(key, value)


def write(path, ending, seed):
    draw = random.Random(seed)
    texts = ["x", 'say "hi"', "two\nlines", '"\n"', "a,b", '""', "\n\nend", "é" * 20, "long\n" * 300]
    with open(path, "w", newline="", encoding="utf-8") as out:
        rows = csv.writer(out, lineterminator=ending)
        rows.writerow(NAMES)
        for k in range(80):
            rows.writerow([f"v{k}", *(draw.choice(texts[: 8 + (k % 20 == 0)]) for _ in range(15))])


def cells(df):
    return sorted(tuple(r) for r in df.select(*NAMES).collect())


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
@pytest.mark.parametrize("most", [10**6, 0])
def test_equals_the_one_task_reader(spark, tmp_path, small_splits, ending, most):
    for k in range(2):
        write(tmp_path / f"{k}.csv", ending, k)
    (tmp_path / "none.csv").write_text(",".join(NAMES) + "\n")
    got = read_records(spark, str(tmp_path), most=most)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    assert got.filter(got[BAD].isNotNull()).isEmpty()
    assert cells(got) == cells(read_observations(spark, str(tmp_path)))
    assert len(cells(got)) == 160


def test_lines_are_not_shuffled(spark, tmp_path, small_splits):
    write(tmp_path / "0.csv", "\n", 0)
    plan = plan_of(record_texts(spark, str(tmp_path), NAMES))
    walked = plan[plan.index("MapInArrow") : plan.index("MapInArrow", plan.index("MapInArrow") + 1)]
    assert "BroadcastHashJoin" in walked and "SortMergeJoin" not in plan


def test_broken_records_are_kept(spark, tmp_path, small_splits):
    good = ",".join(f"c{k}" for k in range(16))
    broken = ["a,b", good + ",more", '"x\ny",b']
    lines = [",".join(NAMES), good, broken[0], "", good, broken[1], broken[2], good]
    (tmp_path / "raw.csv").write_text("\n".join(lines) + "\n")
    rows, bad = good_and_bad(read_records(spark, str(tmp_path / "raw.csv")))
    assert cells(rows) == [tuple(f"c{k}" for k in range(16))] * 3
    assert sorted(r[BAD] for r in bad.collect()) == sorted(broken)


def test_open_quote_takes_the_rest(spark, tmp_path, small_splits):
    (tmp_path / "raw.csv").write_text(",".join(NAMES) + '\na,"' + "tail\n" * 500)
    rows, bad = good_and_bad(read_records(spark, str(tmp_path / "raw.csv")))
    assert rows.isEmpty() and bad.count() == 1


def test_other_header_is_an_error(spark, tmp_path):
    (tmp_path / "raw.csv").write_text(",".join(NAMES[::-1]) + "\n" + ",".join("x" * 16) + "\n")
    with pytest.raises(Exception, match="expected"):
        read_records(spark, str(tmp_path / "raw.csv")).collect()


def test_layout_with_seventeen_columns(spark, tmp_path):
    names = OLD_RAW_SCHEMA.fieldNames()
    assert len(names) == 17 and [n for n in names if n in NAMES] == NAMES
    row = dict.fromkeys(names, "1") | {"video_id": "v", "trending_date": "2024-02-03T04:05:06Z"}
    (tmp_path / "raw.csv").write_text(",".join(names) + "\n" + ",".join(row.values()) + "\n")
    for df in (
        read_observations(spark, str(tmp_path / "raw.csv"), schema=OLD_RAW_SCHEMA),
        read_records(spark, str(tmp_path / "raw.csv"), OLD_RAW_SCHEMA).drop(BAD),
    ):
        cleaned = clean.clean(df)
        assert cleaned.count() == 1 and "video_error_or_removed" not in cleaned.columns


def test_cleaning_stores_broken_records(spark, tmp_path):
    row = dict.fromkeys(NAMES, "1") | {"video_id": "v", "trending_date": "2024-02-03T04:05:06Z"}
    good = ",".join(row.values())
    (tmp_path / "raw.csv").write_text("\n".join([",".join(NAMES), good, good + ",more", "v,w"]) + "\n")
    paths = [str(tmp_path / n) for n in ("raw.csv", "clean", "tags", "bad")]
    jobs.run_cleaning(spark, *paths)
    assert spark.read.parquet(paths[1]).count() == spark.read.parquet(paths[2]).count() == 1
    assert sorted(r[BAD] for r in spark.read.parquet(paths[3]).collect()) == sorted([good + ",more", "v,w"])


def test_a_record_is_walked_once_in_each_role(spark, tmp_path, small_splits):
    """Lines without quotes go on as whole batches; where splits start is read, not counted again."""
    row = ",".join(f"c{k}" for k in range(16))
    lines = [",".join(NAMES), *[row] * 300, '"two\nlines"' + row[2:], *[row] * 300]
    (tmp_path / "raw.csv").write_text("\n".join(lines) + "\n")
    texts = record_texts(spark, str(tmp_path / "raw.csv"), NAMES)
    plan = plan_of(texts)
    assert plan.count("Scan text") == 2 and plan.count("split-starts") == 2
    got = sorted(r[0] for r in texts.collect())
    assert got == sorted([row] * 600 + ['"two\nlines"' + row[2:]])
