"""JSON messages: the streaming source and its decoding."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.functions.times import parse_iso, parse_mixed
from trendlens.schema import COUNTERS, MESSAGE_SCHEMA


def read_topic(
    spark: SparkSession, servers: str, topic: str, per_trigger: int | None = None, **extra
) -> DataFrame:
    """Kafka messages, newest first reading. Needs the Kafka connector on the cluster.

    Offsets live in the query's checkpoint, which takes the place of a consumer
    group's auto-commit.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .options(**extra)
    )
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def read_message_files(
    spark: SparkSession, path: str, per_trigger: int | None = None
) -> DataFrame:
    """The same messages from a folder of text files, one JSON object per line."""
    reader = spark.readStream.format("text")
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.load(path)


def decode(df: DataFrame, value: str = "value", keep=()) -> DataFrame:
    """Message text to typed observation columns; ``keep`` passes columns along."""
    raw = df.select(
        *keep, F.from_json(F.col(value), MESSAGE_SCHEMA).alias("m")
    ).select(*keep, "m.*")
    return raw.withColumns(
        {
            "publishedAt": parse_iso(F.col("publishedAt")),
            "trending_date": parse_iso(F.col("trending_date")),
            "kafka_timestamp": parse_mixed(F.col("kafka_timestamp")),
            "categoryId": F.col("categoryId").try_cast("int"),
            **{c: F.col(c).try_cast("bigint") for c in COUNTERS},
        }
    )
