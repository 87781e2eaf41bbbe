"""Observation files."""

from pyspark.sql import DataFrame, SparkSession

from trendlens.schema import RAW_SCHEMA


def read_observations(
    spark: SparkSession, path, multi_line: bool = True, schema=RAW_SCHEMA
) -> DataFrame:
    """Raw CSV with header, every field as text; ``.gz`` is unpacked by the reader.

    ``multi_line`` keeps a description with line breaks in one record. Such a file
    is read by one task, so store large history as many files; files known to hold
    one record per line can be split with ``multi_line=False``.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)  # a renamed or moved column is an error
        .option("multiLine", multi_line)
        .option("escape", '"')
        .csv(path)
    )


def read_clean(spark: SparkSession, path, fmt: str = "parquet", schema=None) -> DataFrame:
    """The cleaned table: Parquet as written here, or a CSV text export."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    if schema is None:
        raise ValueError("a text export needs its schema")
    return read_observations(spark, path, schema=schema)
