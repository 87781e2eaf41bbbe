"""SpotSigs fingerprints: chains of content words that follow common-word anchors.

A text's fingerprint is the set of its spot signatures. Two fingerprints are compared
by the Jaccard likeness of their sets. :func:`alike` finds all near duplicates: sets are
parted by :func:`length_class`, and only those in the same or neighbouring classes that
share a rare signature are compared. :func:`fingerprinted` compares each text with its
edited text and its successor alone.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trendlens.llm.common import distinct, mix, raw, stored, word_hashes

# Common words of the languages that the corpus holds.
ANCHORS = (
    "the of and to a in is that for it on as with was by at be this are from or an "
    "der die und das in zu den von mit ist des sich ein eine nicht auf im dem für als "
    "de la le et les des en un une que est pour dans qui par sur au du pas avec "
    "el los y las se por con para una su al lo como del no es"
)
_anchors = distinct(np.concatenate([word_hashes(w.encode()) for w in ANCHORS.split()]))
#: Ids held by one block of neighbours, and blocks by one group of blocks.
BLOCK, GROUP = 64, 4096
COLUMNS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


@dataclass(frozen=True)
class Spots:
    """Chains of ``chain`` content words, each ``distance`` content words after the last."""

    distance: int = 1
    chain: int = 3


def spot_signatures(text: str | None, spots: Spots) -> np.ndarray:
    """Sorted distinct 32-bit hashes of the spots; the start of a text is an anchor too.

    Near the end of a text a chain is shorter. Without words there is no spot.
    """
    words = word_hashes(raw(text))
    if not len(words):
        return np.empty(0, np.uint32)
    anchor = np.isin(words, _anchors, kind="sort") if len(words) < 64 else _anchors[np.minimum(np.searchsorted(_anchors, words), len(_anchors) - 1)] == words
    content = words[~anchor]
    before = np.cumsum(~anchor)
    at = np.flatnonzero(anchor)
    first = np.concatenate([[0], before[at]])
    total = np.concatenate([[np.uint64(1)], words[at]])
    for k in range(spots.chain):
        place = first + k * spots.distance
        there = place < len(content)
        if len(content):
            total = mix(total * np.uint64(0x9E3779B97F4A7C15) + np.where(there, content[np.minimum(place, len(content) - 1)], np.uint64(0)))
    return distinct((total >> np.uint64(32)).astype(np.uint32))


def fingerprint(signatures: np.ndarray) -> str:
    """Size of the set, then the set: little-endian 32-bit values in base 64."""
    return f"{len(signatures)}:{base64.b64encode(signatures.astype('<u4').tobytes()).decode()}"


def parse(print_: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(print_.partition(":")[2]), "<u4")


def length_class(size: int, threshold: float) -> int:
    """Sets of a likeness of ``threshold`` or more lie in the same or neighbouring classes."""
    # classes a little wider than the threshold, so that rounding parts no pair
    return -1 if size == 0 else int(math.log(size) / (-math.log(threshold) * (1 + 1e-9)))


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard likeness of two sets; 0 as soon as lengths rule out ``least``. Empty sets: 1."""
    if len(a) == 0 and len(b) == 0:
        return 1.0
    short, long = sorted((len(a), len(b)))
    if short / long < least:
        return 0.0
    same = len(np.intersect1d(a, b, assume_unique=True))
    return same / (short + long - same)


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def neighbours(docs: DataFrame) -> DataFrame:
    """(block, rank, doc_id, text): in a block, sorted by these columns, each row of rank 0
    is followed by the next document; a row of rank 1 closes the block.

    Texts move once: a block of BLOCK ids also gets the first row of the next block that
    has rows, found on one row for each block. After the last block comes the first.
    """
    rows = docs.select(F.floor(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**62))) / BLOCK).alias("block"), F.lit(0).alias("rank"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    firsts = rows.groupBy("block").agg(F.min(F.struct("doc_id", "text")).alias("first"))
    blocks = rows.select("block").distinct().withColumn("group", F.floor(F.col("block") / GROUP))
    groups = blocks.groupBy("group").agg(F.max("block").alias("last"))
    order = Window.orderBy("group")  # a row for each BLOCK * GROUP ids
    whole = Window.partitionBy(F.lit(0))
    groups = groups.select("group", F.coalesce(F.lag("last").over(order), F.max("last").over(whole)).alias("before"))
    inside = F.lag("block").over(Window.partitionBy("group").orderBy("block"))
    ahead = blocks.withColumn("inside", inside).join(groups, "group").select("block", F.coalesce("inside", "before").alias("target"))
    closing = firsts.join(ahead, "block").select(F.col("target").alias("block"), F.lit(1).alias("rank"), "first.doc_id", "first.text")
    return rows.union(closing)


def fingerprinted(docs: DataFrame, spots: Spots = Spots()) -> DataFrame:
    """Per document, ascending by doc_id, the columns COLUMNS.

    The edited text of a document takes its second half from the next one. A NULL text
    is empty; rows of one id follow each other by text, a row without id comes first. A
    single row is its own next. Columns other than doc_id and text are ignored.
    """
    dealt = neighbours(docs).repartition("block").sortWithinPartitions("block", "rank", "doc_id", "text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(k) for k in range(4)), strict=True)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, last = [], None
        for block, rank, doc_id, cell in rows(batches):
            text = cell.as_py() or ""
            block = block.as_py()
            mine = spot_signatures(text, spots)
            if last and last[0] == block:
                _, before, old, its = last
                changed = edited(old, text)
                theirs = spot_signatures(changed, spots)
                out.append((before, len(old), hashlib.sha256(raw(changed)).hexdigest(), fingerprint(its), fingerprint(theirs), likeness(its, theirs), likeness(its, mine)))
            last = (block, doc_id.as_py(), text, mine) if rank.as_py() == 0 else None
            if len(out) >= 512:
                yield packed(out)
                out = []
        yield packed(out)

    return dealt.mapInArrow(walk, COLUMNS)


def spot_sets(docs: DataFrame, threshold: float, spots: Spots) -> DataFrame:
    """(doc_id, set_key, n, length, spots) of the rows with an id."""
    schema = pa.schema([("doc_id", pa.int64()), ("set_key", pa.binary()), ("n", pa.int64()), ("length", pa.int64()), ("spots", pa.list_(pa.int64()))])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [spot_signatures(cell.as_py(), spots) for cell in batch.column(1)]
            keys = [hashlib.sha256(s.tobytes()).digest() for s in sets]
            lengths = [length_class(len(s), threshold) for s in sets]
            columns = [batch.column(0), keys, [len(s) for s in sets], lengths, [s.astype(np.int64) for s in sets]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long"), "text").filter("doc_id IS NOT NULL")
    return rows.mapInArrow(sign, "doc_id long, set_key binary, n long, length long, spots array<long>")


def alike(docs: DataFrame, threshold: float = 0.8, spots: Spots = Spots()) -> DataFrame:
    """(a, b, likeness), a > b: the near duplicates at ``threshold`` or more, below 1.

    Equal sets are one class, which its smallest id stands for: its other members are
    paired with that id at likeness 1, and the classes' ids are paired with each other.
    No other pair is left out: sets that are alike share one of their rarest signatures,
    n - ceil(threshold * n) + 1 of n, and lie in the same or neighbouring length classes.
    Texts without a spot form one class. Rows of one id are compared with other ids only;
    a pair of ids has its largest likeness. Rows without id are left out.
    """
    if not 0 < threshold < 1:
        raise ValueError("threshold must lie between 0 and 1")
    sets = stored(spot_sets(docs, threshold, spots), "spots")
    classes = sets.groupBy("set_key").agg(F.min("doc_id").alias("class_id"), F.first("n").alias("n"), F.first("length").alias("length"), F.first("spots").alias("spots"))
    classes = stored(classes, "classes")
    equal = sets.join(classes.select("set_key", "class_id"), "set_key").filter("doc_id <> class_id").select(F.col("doc_id").alias("a"), F.col("class_id").alias("b"), F.lit(1.0).alias("likeness"))

    cells = classes.select("set_key", "n", "length", F.explode("spots").alias("spot"))
    rare = cells.groupBy("spot").agg(F.count("*").alias("sets")).filter("sets > 1")
    # a signature of one set only is rarer than all shared ones: it takes up prefix, but meets nothing
    shared = cells.join(rare, "spot")
    alone = F.col("n") - F.count("*").over(Window.partitionBy("set_key"))
    place = alone + F.row_number().over(Window.partitionBy("set_key").orderBy("sets", "spot"))
    least = F.ceil(F.lit(float(threshold)) * F.col("n") - F.lit(1e-6))
    heads = stored(shared.withColumn("place", place).filter(F.col("place") <= F.col("n") - least + 1).select("spot", "set_key", "n", "length"), "heads")
    x = heads.select("spot", "length", F.col("set_key").alias("x"), F.col("n").alias("x_n"))
    y = heads.select("spot", F.col("length").alias("own"), F.col("set_key").alias("y"), F.col("n").alias("y_n"), F.explode(F.array("length", F.col("length") - 1)).alias("length"))
    near = (F.col("own") > F.col("length")) | (F.col("x") < F.col("y"))
    sizes = F.least("x_n", "y_n") >= F.lit(float(threshold)) * F.greatest("x_n", "y_n") - F.lit(1e-6)
    pairs = x.join(y, ["spot", "length"]).filter(near & sizes).select("x", "y").distinct()
    both = pairs.join(classes.select(F.col("set_key").alias("x"), F.col("class_id").alias("x_id"), F.col("spots").alias("x_spots")), "x").join(
        classes.select(F.col("set_key").alias("y"), F.col("class_id").alias("y_id"), F.col("spots").alias("y_spots")), "y"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [likeness(one.values.to_numpy(), other.values.to_numpy(), threshold) for one, other in zip(batch.column(2), batch.column(3), strict=True)]
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64())], names=["a", "b", "likeness"])
            yield out.filter(pa.array([f >= threshold for f in found], pa.bool_()))

    both = both.filter("x_id <> y_id").select(F.greatest("x_id", "y_id").alias("a"), F.least("x_id", "y_id").alias("b"), "x_spots", "y_spots")
    return both.mapInArrow(compare, "a long, b long, likeness double").union(equal).groupBy("a", "b").agg(F.max("likeness").alias("likeness"))


def packed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [x.split()[0] for x in COLUMNS.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
