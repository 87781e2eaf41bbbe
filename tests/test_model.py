import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trendlens.operators import model
from trendlens.plans import frames
from trendlens.schema import FEATURES, LABEL

KEYS = ["k"]


def observed(spark, stamps):
    rows = [(i, s) for i, s in enumerate(stamps)]
    return spark.createDataFrame(rows, "k int, publishedAt timestamp_ntz").repartition(5)


def brute_force(df, fraction):
    """The split by sorting everything in one place."""
    rows = [
        (r["publishedAt"] or datetime.min, r["h"], r["k"])
        for r in df.withColumn("h", model.row_hash(KEYS)).collect()
    ]
    rows.sort()
    return {k for _, _, k in rows[: int(fraction * len(rows))]}


START = datetime(2024, 1, 1)
CASES = {
    "spread": [START + timedelta(seconds=97 * i) for i in range(3000)],
    "one hot second": [START + timedelta(hours=i if i % 3 else 40) for i in range(3000)],
    "all in one second": [START] * 900,
    "many without time": [None if i % 10 else START + timedelta(days=i) for i in range(900)],
    "before 1970": [datetime(1960, 5, 1) + timedelta(hours=7 * i) for i in range(900)],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("fraction", [0.8, 0.33])
def test_split_equals_a_global_sort(spark, monkeypatch, name, fraction):
    monkeypatch.setattr(model, "SMALL_BUCKET", 50)
    monkeypatch.setattr(model, "STEP_DIGITS", 1)
    df = observed(spark, CASES[name])
    early, late = model.time_split(df, "publishedAt", KEYS, fraction)
    train = {r["k"] for r in early.collect()}
    assert train == brute_force(df, fraction)
    assert {r["k"] for r in late.collect()} == set(range(len(CASES[name]))) - train


def test_split_of_nothing(spark):
    df = observed(spark, [START])
    early, late = model.time_split(df, "publishedAt", KEYS, 0.5)
    assert (early.count(), late.count()) == (0, 1)


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    a = {r["k"] for r in model.hash_sample(df.repartition(2), KEYS).collect()}
    b = {r["k"] for r in model.hash_sample(df.repartition(9), KEYS).collect()}
    assert a == b and 600 < len(a) < 900
    assert model.hash_sample(df, KEYS, 1.0).count() == 5000


def test_features_and_label(spark):
    df = spark.sql(
        "SELECT 10 AS categoryId, 999L AS view_count, 50L AS likes, 49L AS comment_count, "
        "TIMESTAMP_NTZ'2024-01-07 18:30:00' AS publishedAt"  # a Sunday
    )
    row = model.with_label(model.with_features(df)).first()
    assert math.isclose(row["engagement_rate"], 9.9)
    assert math.isclose(row["like_comment_ratio"], 1.0)
    assert math.isclose(row["view_scale"], 3.0) and math.isclose(row["engagement_scale"], 2.0)
    assert (row["publish_hour"], row["day_of_week"]) == (18, 1)
    assert (row["is_weekend"], row["is_prime_time"]) == (1.0, 1.0)
    assert math.isclose(row[LABEL], 3.0 * 1.099)
    back = model.to_views(F.lit(row[LABEL]), F.lit(row["engagement_rate"]))
    assert math.isclose(df.select(back).first()[0], 1000.0, rel_tol=1e-9)


def test_metrics_by_hand(spark):
    rng = random.Random(1)
    pairs = [(y, y + rng.uniform(-1, 1)) for y in (rng.uniform(1, 9) for _ in range(200))]
    df = spark.createDataFrame([*pairs, (1.0, None)], "growth_potential double, prediction double")
    row = model.regression_metrics(df).first()
    errors = [y - p for y, p in pairs]
    mean = sum(y for y, _ in pairs) / 200
    ss = sum(e * e for e in errors)
    assert math.isclose(row["rmse"], math.sqrt(ss / 200))
    assert math.isclose(row["mae"], sum(map(abs, errors)) / 200)
    assert math.isclose(row["r2"], 1 - ss / sum((y - mean) ** 2 for y, _ in pairs))
    mape = sum(abs(e) / (abs(y) + 1e-10) for e, (y, _) in zip(errors, pairs)) / 2
    assert math.isclose(row["mape"], mape)


def test_train_save_load_score(spark, small, tmp_path):
    rows = frames.model_rows(spark, small)
    fitted, held_out = model.train(rows, frames.ROW_KEY, iterations=5, depth=4)
    quality = model.regression_metrics(held_out).first()
    assert quality["r2"] > 0.5 and quality["verdict"] == "EXCELLENT"
    assert held_out.count() == rows.count() - int(0.8 * rows.count())

    model.save_model(fitted, str(tmp_path / "model"))
    loaded = model.load_model(str(tmp_path / "model"))
    obs = frames.observations(spark, small)
    cols = [*frames.ROW_KEY, "predicted_views"]
    a, b = (model.score(obs, m).select(*cols) for m in (fitted, loaded))
    assert a.exceptAll(b).isEmpty()

    broken = obs.withColumn("likes", F.when(F.col("l_linenumber") > 1, F.col("likes")))
    scored = model.score(broken, fitted)
    assert scored.filter("likes IS NULL").agg(F.max("predicted_views")).first()[0] == 0
    whole = scored.filter("likes IS NOT NULL").select(*cols)
    assert whole.exceptAll(a).isEmpty()


def test_every_feature_is_produced(spark, small):
    assert set(FEATURES) <= set(model.with_features(frames.observations(spark, small)).columns)


def test_training_has_tasks_by_size_not_by_earlier_partitions(spark, small):
    rows = frames.model_rows(spark, small).repartition(64, "video_id")
    fitted, held_out = model.train(rows, frames.ROW_KEY, iterations=1, depth=2)
    assert held_out.rdd.getNumPartitions() <= 16
    assert len(fitted.stages[-1].trees) == 1
