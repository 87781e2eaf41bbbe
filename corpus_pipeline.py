"""The corpus pipeline: toxic documents go, poor ones go, one of each group of near
duplicates stays, and what is left is packed.

Every stage works on all that its predecessor kept; each result is written to the shared
folder and read again. All but the last return the columns of documents. A verdict holds
for the row it was made on: rows without id are judged like others, rows that share an id
one by one, and of equal rows one stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.llm import minhash, packing, quality, toxicity
from trendlens.llm.common import read, released, stored

#: Texts at a likeness of 0.8 or more are near copies here; the query of op2 links at 0.85 by its own contract.
#: 36 bands of 5 values miss a pair at 0.8 about 6 times in 10 million.
NEAR = minhash.Linking(percent=80, permutations=90)


def _judged(operator, spark: SparkSession, docs: DataFrame, sf_dir: str, wanted: str) -> DataFrame:
    """The rows whose own verdict is ``wanted``; the columns travel with the text, so nothing is joined."""
    names = {c: f"_doc_{k}" for k, c in enumerate(docs.columns)}
    carried = docs.select("*", *[F.col(c).alias(n) for c, n in names.items()])
    rows = operator.scored(carried, read(spark, sf_dir, "labels"), keep=list(names.values()))
    return rows.filter(wanted).select(*[F.col(n).alias(c) for c, n in names.items()])


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _judged(toxicity, spark, docs, sf_dir, "predicted = 0")


def without_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _judged(quality, spark, docs, sf_dir, "predicted = 1")


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row is a document of its own here, by its place in the stored table; of rows without
    any word, which are like nothing, all stay."""
    placed = docs.withColumn("_place", F.monotonically_increasing_id())
    found = minhash.components_of(placed.select(F.col("_place").alias("doc_id"), "text"), NEAR)
    gone = found.filter("NOT kept").select(F.col("doc_id").alias("_place"))
    return placed.join(gone, "_place", "left_anti").drop("_place")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, packing.Packing(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("toxicity", without_toxic), ("quality", without_poor), ("near_duplicates", without_near_duplicates), ("packing", packed)]
#: Learned models and windows cannot be told in SQL; the tests cover the stages and the operators they call.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces. Tables of earlier stages are deleted once the next one is written."""
    docs, last = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with released(spark) as paths:
            docs = stored(stage(spark, docs, sf_dir), name)
            result = paths.pop()  # the last one written
            if last:
                paths.append(last)
            last = result
    return docs
