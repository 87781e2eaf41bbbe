"""Edge cases the star tables do not contain, and brute-force comparisons."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from trendlens.operators import category, correlation, dedup, engagement, enrich, timing, topn


def day(n, hour=0):
    return datetime(2024, 1, 1) + timedelta(days=n, hours=hour)


def test_keep_best_and_first_break_ties(spark):
    df = spark.createDataFrame(
        [("a", 5, day(2)), ("a", 5, day(1)), ("a", None, day(0)), ("b", None, day(3))],
        "video_id string, view_count long, trending_date timestamp_ntz",
    )
    best = {r["video_id"]: r["trending_date"] for r in dedup.keep_best(df).collect()}
    assert best == {"a": day(1), "b": day(3)}
    first = {r["video_id"]: r["trending_date"] for r in dedup.keep_first(df).collect()}
    assert first == {"a": day(0), "b": day(3)}


@pytest.mark.parametrize("k", [1, 7, 1500])
def test_top_k_with_a_hot_group(spark, k):
    """Half of the rows share one key; the salted path (large k) agrees with the other."""
    rng = random.Random(3)
    rows = [("hot" if i % 2 else f"g{i % 50}", rng.randrange(100), i) for i in range(8000)]
    df = spark.createDataFrame(rows, "g string, v int, i int").repartition(6)
    order = [F.desc("v"), F.asc("i")]
    got = sorted(tuple(r) for r in dedup.top_k_per_group(df, ["g"], order, k).collect())
    frame = pd.DataFrame(rows, columns=["g", "v", "i"]).sort_values(
        ["v", "i"], ascending=[False, True]
    )
    expected = sorted(map(tuple, frame.groupby("g").head(k).itertuples(index=False)))
    assert got == expected


def test_upsert(spark):
    schema = "video_id string, trending_date string, n int"
    old = spark.createDataFrame([("a", "1", 1), ("a", "1", 2), ("b", "1", 3), (None, "1", 4)], schema)
    new = spark.createDataFrame(
        [("a", "1", 9, "x"), ("c", "1", 5, "y"), (None, "1", 6, "z")], schema + ", extra string"
    )
    latest = [F.desc("n")]
    got = dedup.upsert_keep_last(old, new, latest=latest)
    rows = {(r["video_id"], r["n"], r["extra"]) for r in got.collect()}
    assert rows == {("a", 9, "x"), ("b", 3, None), ("c", 5, "y"), (None, 6, "z")}
    unique = old.filter("n <> 1")
    fast = dedup.upsert_keep_last(unique, new, latest=latest, old_is_unique=True)
    assert {(r["video_id"], r["n"], r["extra"]) for r in fast.collect()} == rows


def test_unknown_category_and_own_dimension(spark):
    df = spark.createDataFrame([(10,), (999,), (None,)], "categoryId int")
    names = [r["category_name"] for r in enrich.with_category_name(df).collect()]
    assert names == ["Music", "Unknown", "Unknown"]
    dim = spark.createDataFrame([(999, "Mine")], "categoryId int, category_name string")
    names = [r["category_name"] for r in enrich.with_category_name(df, dim).collect()]
    assert sorted(names) == ["Mine", "Unknown", "Unknown"]


def test_null_category_counts_as_a_value(spark):
    df = spark.createDataFrame(
        [(1, "a"), (None, "a"), (1, None)], "categoryId int, channelTitle string"
    )
    assert tuple(category.distinct_counts(df).first()) == (2, 2)
    rows = {r["categoryId"]: r["percentage"] for r in category.shares(df).collect()}
    assert math.isclose(rows[1], 200 / 3) and math.isclose(rows[None], 100 / 3)


def test_missing_weekday_is_zero(spark):
    monday = day(0, 5)
    df = spark.createDataFrame([(monday,), (monday,)], "publishedAt timestamp_ntz")
    row = timing.hour_by_weekday(df).collect()
    assert [tuple(r) for r in row] == [(5, 2, 0, 0, 0, 0, 0, 0)]
    assert tuple(timing.busiest_cell(df).first()) == (5, "Mon", 2)


def test_extremes_take_the_first_on_ties(spark):
    df = spark.createDataFrame([(3, 9), (1, 9), (2, 4), (0, 4)], "h int, count long")
    assert tuple(timing.extremes(df, "h").first()) == (1, 9, 0, 4)
    df = spark.createDataFrame([("Sun", 9), ("Mon", 9)], "d string, count long")
    row = timing.weekday_extremes(df, "d").first()
    assert row["peak_d"] == "Mon" and row["low_d"] == "Mon"


def test_days_are_calendar_days_and_median_is_the_lower_middle(spark):
    df = spark.createDataFrame(
        [(day(0, 23), day(1, 1)), (day(0, 1), day(0, 23))],
        "publishedAt timestamp_ntz, trending_date timestamp_ntz",
    )
    days = sorted(r["days_to_trend"] for r in enrich.with_days_to_trend(df).collect())
    assert days == [0, 1]
    numbers = spark.range(1, 11).selectExpr("CAST(id AS INT) AS days_to_trend")
    assert tuple(timing.time_to_trend(numbers).first()) == (5.5, 5, 1, 10)


def test_lifespan_counts_a_video_once_per_category(spark):
    df = spark.createDataFrame(
        [("a", 10, day(0)), ("a", 10, day(4)), ("a", 20, day(1)), ("b", 10, day(0))],
        "video_id string, categoryId int, trending_date timestamp_ntz",
    )
    rows = {r["category_name"]: tuple(r)[1:] for r in timing.lifespan(df).collect()}
    assert rows == {"Music": (3.0, 1), "Gaming": (1.0, 1)}


def test_bands_keep_null_rates_in_the_total(spark):
    df = spark.createDataFrame([(10.5,), (10.0,), (5.0,), (4.9,), (None,)], "engagement_rate double")
    rows = {r["band"]: (r["count"], r["percentage"]) for r in engagement.bands(df).collect()}
    assert rows == {"high": (1, 20.0), "medium": (2, 40.0), "low": (1, 20.0)}


def test_correlation_matches_pandas(spark):
    rng = np.random.default_rng(5)
    frame = pd.DataFrame(
        {
            "a": rng.normal(1e6, 1.0, 400),  # hardly any spread
            "b": rng.lognormal(10, 3, 400),
            "c": rng.normal(size=400),
            "const": 5.3,
            "none": np.nan,
        }
    )
    frame["d"] = frame["a"] * 2 + frame["c"]
    frame.loc[::3, "b"] = np.nan
    frame.loc[::5, "c"] = np.nan
    cols = list(frame.columns)
    spec = ", ".join(f"{c} double" for c in cols)
    values = frame.astype(object).where(frame.notna(), None).values.tolist()
    df = spark.createDataFrame(values, spec).repartition(5)
    got = {(r["a"], r["b"]): r["r"] for r in correlation.correlation_matrix(df, cols).collect()}
    expected = frame.corr()
    assert len(got) == len(cols) ** 2
    for (a, b), r in got.items():
        # pandas leaves rounding noise where it divides by a constant's spread
        if "const" in (a, b) or "none" in (a, b):
            assert r is None, (a, b, r)
        else:
            assert math.isclose(r, expected.loc[a, b], abs_tol=1e-9), (a, b)


def test_log_density_uses_positive_pairs(spark):
    df = spark.createDataFrame([(10, 100), (0, 5), (5, 0), (None, 3)], "x long, y long")
    rows = correlation.log_density(df, [("x", "y", True)]).collect()
    assert [tuple(r) for r in rows] == [("x", "y", 4, 8, 1)]


def test_one_row_joins_without_a_join(spark):
    a = spark.sql("SELECT 1 AS x, CAST(NULL AS STRING) AS y")
    b = spark.sql("SELECT 2.5D AS z")
    df = topn.one_row(a, b)
    assert [tuple(r) for r in df.collect()] == [(1, None, 2.5)]


def test_summary_leaders_break_ties_by_key(spark):
    df = spark.createDataFrame(
        [("b", "B", 10, 7, 1), ("a", "A", 10, 7, 1), ("c", "C", 23, None, 3)],
        "video_id string, title string, categoryId int, view_count_num long, likes_num long",
    ).withColumns({"dislikes_num": F.lit(0), "comment_count_num": F.lit(0)})
    row = engagement.interaction_summary(enrich.with_engagement(df)).first()
    assert row["most_viewed"] == "A" and row["most_liked"] == "C"
    assert row["named_count"] == 2 and row["named_rate"] is None
