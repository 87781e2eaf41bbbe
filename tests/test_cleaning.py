from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from trendlens.functions import rates, text, times
from trendlens.operators import clean, quality
from trendlens.schema import RAW_SCHEMA
from trendlens.sources.files import read_observations
from trendlens.sources.listing import flatten_listing
from trendlens.sources.star import observations, raw_observations
from trendlens.streaming import sinks


def raw_row(**known):
    return tuple(known.get(f) for f in RAW_SCHEMA.fieldNames())


def test_clean_drops_and_fixes(spark):
    good = {
        "video_id": "a",
        "trending_date": "2024-02-03T04:05:06Z",
        "publishedAt": "not a date",
        "categoryId": "10",
        "view_count": "12x",
        "likes": "7",
        "thumbnail_link": "x",
    }
    df = spark.createDataFrame(
        [
            raw_row(**good),
            raw_row(),
            raw_row(thumbnail_link="only dropped columns"),
            raw_row(**{**good, "trending_date": "2024-02-03"}),
            raw_row(**{**good, "trending_date": "2024-02-30T04:05:06Z", "video_id": "b"}),
        ],
        RAW_SCHEMA,
    )
    rows = {r["video_id"]: r for r in clean.clean(df).collect()}
    assert set(rows) == {"a", "b"}
    a = rows["a"]
    assert a["trending_date"] == datetime(2024, 2, 3, 4, 5, 6)
    assert a["publishedAt"] is None and a["view_count"] is None
    assert (a["categoryId"], a["likes"]) == (10, 7)
    assert a["description"] == "No description"
    assert "thumbnail_link" not in clean.clean(df).columns
    # well formed, but no such day: kept without a date
    assert rows["b"]["trending_date"] is None


def test_typed_table_equals_cleaned_rows(spark, small):
    cleaned, typed = clean.clean(raw_observations(spark, small)), observations(spark, small)
    assert cleaned.dtypes == typed.dtypes
    assert cleaned.exceptAll(typed).isEmpty() and typed.exceptAll(cleaned).isEmpty()


def test_quoted_line_breaks_survive(spark, tmp_path):
    names = RAW_SCHEMA.fieldNames()
    values = ["v1", 'say ""hi""'] + ["x"] * 13 + ["line one\nline two, still"]
    body = ",".join(f'"{v}"' for v in values)
    (tmp_path / "raw.csv").write_text(",".join(names) + "\n" + body + "\n")
    row = read_observations(spark, str(tmp_path / "raw.csv")).collect()
    assert len(row) == 1
    assert row[0]["title"] == 'say "hi"'
    assert row[0]["description"] == "line one\nline two, still"


def test_moved_columns_are_an_error(spark, tmp_path):
    names = RAW_SCHEMA.fieldNames()[::-1]
    (tmp_path / "raw.csv").write_text(",".join(names) + "\n" + ",".join("x" * 16) + "\n")
    with pytest.raises(Exception, match="header does not conform"):
        read_observations(spark, str(tmp_path / "raw.csv")).collect()


def test_parsers(spark):
    def one(value, fn):
        df = spark.createDataFrame([(value,)], "v string")
        return df.select(fn(F.col("v"))).first()[0]

    assert one("2024-01-02T03:04:05Z", times.parse_iso) == datetime(2024, 1, 2, 3, 4, 5)
    assert one("2024-01-02T03:04:05Z\n", times.parse_iso) is None
    assert one("2024-01-02T25:04:05Z", times.parse_iso) is None
    assert one("2024-01-02 03:04:05", times.parse_iso) is None
    mixed = {
        "2024-01-02T03:04:05+05:30": datetime(2024, 1, 1, 21, 34, 5),
        "2024-01-02T03:04:05Z": datetime(2024, 1, 2, 3, 4, 5),
        "2024-01-02 03:04:05.5": datetime(2024, 1, 2, 3, 4, 5, 500000),
        "2024/01/02": datetime(2024, 1, 2),
        "01/02/2024": datetime(2024, 1, 2),
        "soon": None,
        None: None,
    }
    for value, expected in mixed.items():
        assert one(value, times.parse_mixed) == expected, value


def test_times_do_not_depend_on_the_session_zone(spark):
    df = spark.sql("SELECT '2024-03-10T02:30:00Z' AS t, '2024-03-10T02:30:00-04:00' AS o")
    cols = [
        times.epoch_seconds(times.parse_iso(F.col("t"))),
        F.hour(times.parse_iso(F.col("t"))),
        times.parse_mixed(F.col("t")),
        F.to_date(times.parse_iso(F.col("t"))),
    ]
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        row = df.select(*cols, times.parse_mixed(F.col("o"))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == (
        1710037800,
        2,
        datetime(2024, 3, 10, 2, 30),
        date(2024, 3, 10),
        datetime(2024, 3, 10, 6, 30),
    )


def test_tags_and_titles(spark):
    df = spark.createDataFrame([('"a"|b',), ("[none]",), (None,)], "t string")
    got = [r[0] for r in df.select(text.tag_list(F.col("t"))).collect()]
    assert got == [["a", "b"], [""], None]
    df = spark.createDataFrame([("abcdef",), ("abc",), (None,)], "t string")
    cut = [r[0] for r in df.select(text.ellipsize(F.col("t"), 3)).collect()]
    assert cut == ["abc...", "abc", None]


def test_rates_at_zero_and_null(spark):
    df = spark.createDataFrame([(0, 5), (100, 5), (None, 5), (100, None)], "v long, p long")
    got = [r[0] for r in df.select(rates.percent_of(F.col("p"), F.col("v"))).collect()]
    assert got == [None, 5.0, None, None]
    got = [r[0] for r in df.select(rates.smoothed_percent(F.col("p"), F.col("v"))).collect()]
    assert got[0] == 500.0 and got[2] is None


def test_profile_and_validity(spark):
    df = spark.createDataFrame(
        [("a", "2024-01-01T00:00:00Z"), ("", "junk"), (None, None), (None, None)],
        "video_id string, trending_date string",
    )
    row = quality.validity(df).first()
    assert tuple(row) == (4, 1, 2, 1)
    assert tuple(quality.profile(df).first()) == (4, 2, 2, 2)
    assert clean.drop_empty_rows(df).count() == 2
    assert [r[0] for r in quality.invalid_dates(df).collect()] == ["junk"]


def test_exclude_keeps_null(spark):
    df = spark.createDataFrame([("x",), ("y",), (None,)], "c string")
    assert {r[0] for r in quality.exclude_value(df, "c", "x").collect()} == {"y", None}


def test_listing_with_missing_parts(spark):
    payload = """{"items": [
      {"id": "1", "snippet": {"title": "t", "tags": ["a", "b"], "categoryId": "10",
        "thumbnails": {"default": {"url": "u"}}},
       "statistics": {"viewCount": "5", "commentCount": "2"}},
      {"id": "2", "snippet": {"title": "s"}, "statistics": {"likeCount": "3"}}]}"""
    df = spark.createDataFrame([(payload,), ('{"items": []}',), ("broken",)], "p string")
    stamp = F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")
    a, b = flatten_listing(df, "p", stamp).orderBy("video_id").collect()
    assert (a["view_count"], a["likes"], a["comment_count"]) == (5, 0, 2)
    assert (a["tags"], a["thumbnail_link"], a["comments_disabled"]) == ("a|b", "u", False)
    assert (b["tags"], b["comments_disabled"], b["likes"]) == ("", True, 3)
    assert a["trending_date"] == "2024-01-01T10:00:00Z"


def test_text_export(spark, tmp_path):
    df = spark.sql(
        "SELECT 'a' AS video_id, TIMESTAMP_NTZ'2024-01-01 02:03:04' AS trending_date, "
        "TIMESTAMP_NTZ'2023-01-01 00:00:00' AS publishedAt"
    )
    sinks.export_text(df, str(tmp_path / "out"))
    row = spark.read.option("header", True).csv(str(tmp_path / "out")).first()
    assert tuple(row) == ("a", "2024-01-01 02:03:04", "2023-01-01 00:00:00")
