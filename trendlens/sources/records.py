"""CSV whose records hold line breaks, read by many tasks, with broken records kept.

Files are read as lines, which Spark splits anywhere. A line ends a record when the
quotes up to it are even in number, so the quotes of each split are counted first; then
every split knows whether it starts inside a quoted field. Records inside a split are put
together there. Only a record that runs over a split's border is shuffled, in pieces.
"""

import csv
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlens.schema import RAW_SCHEMA
from trendlens.session import scratch_path

BAD = "bad_record"
MOST_BROADCAST = 500_000  # splits, of about 100 bytes each
PIECES = "file string, block long, part long, head boolean, whole boolean, text string"
PIECE_NAMES = [f.split(" ")[0] for f in PIECES.split(", ")]


def _lines(spark: SparkSession, path) -> DataFrame:
    # with the separator given, a carriage return stays on its line
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        F.col("value"),
        (F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
    )


def split_starts(lines: DataFrame) -> DataFrame:
    """(file, block, inside): whether a split starts inside a quoted field. One row per split."""
    counted = lines.groupBy("file", "block").agg(F.sum("quotes").alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n").over(before), F.lit(0)) % 2 == 1
    return counted.select("file", "block", inside.alias("inside"))


def _pieces(names: list[str], wanted: bool):
    """Whole records, or else the pieces of those that cross a border, in order."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        part = 0
        first = head = inside = False
        held: list[str] = []
        out: list[tuple] = []

        def put(whole: bool) -> None:
            nonlocal part
            text = "\n".join(held)
            held.clear()
            if first:
                found = next(csv.reader([text]), [])
                if found != names:
                    raise ValueError(f"{at[0]}: header {found}, expected {names}")
            elif whole == wanted:
                out.append((*at, part, head, whole, text))
            part += 1

        def flush() -> pa.RecordBatch:
            types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
            columns = zip(*out, strict=True) if out else [[]] * len(types)
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=PIECE_NAMES
            )
            out.clear()
            return batch

        def plain(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            """The batch's lines as records, if it goes on in one split and none has an open quote."""
            nonlocal part
            n = batch.num_rows
            if not n or held or inside or first or at is None:
                return None
            for c, value in zip(batch.columns, at, strict=False):
                if pc.any(pc.not_equal(c, value)).as_py():
                    return None
            if not head or pc.any(pc.equal(pc.bit_wise_and(batch.column(4).cast(pa.int64()), 1), 1)).as_py():
                return None
            part += n
            # whose place in the file does not matter any more
            place = [pa.nulls(n, t) for t in (pa.string(), pa.int64(), pa.int64())]
            found = pa.RecordBatch.from_arrays([*place, yes := pa.repeat(True, n), yes, batch.column(3)], names=PIECE_NAMES)
            return found if wanted else found.slice(0, 0)

        for batch in batches:
            done = plain(batch)
            if done is not None:
                yield done
                continue
            columns = (c.to_pylist() for c in batch.columns)
            for file, block, starts_inside, value, quotes in zip(*columns, strict=True):
                if (file, block) != at:
                    if held:
                        put(False)
                    at, part = (file, block), 0
                    inside, head, first = starts_inside, not starts_inside, block == 0
                held.append(value)
                inside ^= quotes % 2 == 1
                if not inside:
                    # the first record of a split may have begun in an earlier one
                    put(head)
                    head, first = True, False
            yield flush()
        if held:
            put(False)
        yield flush()

    return walk


def record_texts(spark: SparkSession, path, names: list[str], most: int = MOST_BROADCAST) -> DataFrame:
    """One row ``text`` per record, headers and empty lines left out.

    Up to ``most`` splits, where they start is broadcast; beyond, the lines are
    shuffled by split and sorted again. A quote that is never closed makes the rest of
    its file one record. A header other than ``names`` is an error.
    """
    lines = _lines(spark, path)
    # stored, as every read of the records needs it and it takes a pass over all lines
    at = scratch_path(spark, "split-starts")
    starts = split_starts(lines)
    starts.write.parquet(at)
    starts = spark.read.schema(starts.schema).parquet(at)
    if starts.count() <= most:
        lines = lines.join(F.broadcast(starts), ["file", "block"])  # keeps the order of lines
    else:
        lines = lines.join(starts.hint("merge"), ["file", "block"])
        lines = lines.repartition("file", "block").sortWithinPartitions("file", "block", "line")
    walked = lines.select("file", "block", "inside", "value", "quotes")
    whole, pieces = (walked.mapInArrow(_pieces(names, wanted), PIECES) for wanted in (True, False))
    # at most two pieces a split; a record is its head and what follows up to the next head
    number = F.sum(F.col("head").cast("int")).over(Window.partitionBy("file").orderBy("block", "part"))
    parts = F.sort_array(F.collect_list(F.struct("block", "part", "text")))
    joined = (
        pieces.withColumn("record", number)
        .groupBy("file", "record")
        .agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"))
    )
    texts = whole.select("text").unionByName(joined.select("text"))
    return texts.select(F.regexp_replace("text", "\r$", "").alias("text")).filter("text <> ''")


def read_records(
    spark: SparkSession, path, schema: T.StructType = RAW_SCHEMA, most: int = MOST_BROADCAST
) -> DataFrame:
    """The columns of ``schema`` and BAD.

    BAD holds the whole text of a record with more or fewer fields than the schema, whose
    columns hold what could be read; it is NULL in a good record. Rows come in no order.
    """
    rescue = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": BAD,
        "escape": '"',
        "multiLine": "true",
        "columnPruning": "false",
    }
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rescue)
    texts = record_texts(spark, path, schema.fieldNames(), most)
    return texts.select(F.from_csv("text", fields, options).alias("r")).select("r.*")


def good_and_bad(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of good records, and the texts of the others."""
    return rows.filter(F.col(BAD).isNull()).drop(BAD), rows.filter(F.col(BAD).isNotNull()).select(BAD)
