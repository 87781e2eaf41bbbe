"""Near duplicates by min-max hashing.

Each permutation of the shingle hashes gives two signature values, its smallest and its
largest, so a signature costs half the hash evaluations. Bands of them put documents in
buckets. A bucket never yields all its pairs: its members are compared with its most
central one, and then only members of different components that share a rare shingle go
on, see :func:`components_of`.

Every link is confirmed on the full shingle sets of both texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlens.llm.common import distinct, mix, raw, stored, word_hashes

#: Shingles hashed against all permutations at once.
CHUNK = 4096
#: Most bits of the map that picks texts before they are shuffled; beyond 4 million wanted ids it lets more of the others pass.
MARKS = 1 << 26
SIGNATURE = "doc_id long, n_shingles long, set_key binary, bands array<long>"


@dataclass(frozen=True)
class Linking:
    """Link at ``100 * intersection >= percent * union`` of ``shingle``-word sets.

    ``permutations`` gives twice as many values, cut in bands of ``rows``. At the
    defaults a pair at 0.85 shares no band once in a million times, one at 0.9 once in
    ten thousand millions.
    """

    shingle: int = 5
    percent: int = 85
    permutations: int = 60
    rows: int = 5
    seed: int = 17


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles; fewer words are one shingle."""
    words = word_hashes(raw(text))
    if not len(words):
        return words
    width = min(size, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        total += words[k : len(words) - width + 1 + k] * _places(size)[k]
    return distinct(mix(total))


@cache
def _places(size: int) -> np.ndarray:
    return np.random.default_rng(size).integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@cache
def _permutations(how: Linking) -> np.ndarray:
    factors = np.random.default_rng(how.seed).integers(0, 2**63, how.permutations, dtype=np.uint64)
    return (factors * np.uint64(2) + np.uint64(1))[:, None]


def bands(values: np.ndarray, how: Linking) -> np.ndarray:
    """A 64-bit key for each band of the min-max signature of a set."""
    low = np.full(how.permutations, 2**64 - 1, np.uint64)
    high = np.zeros(how.permutations, np.uint64)
    for at in range(0, len(values), CHUNK):
        moved = values[at : at + CHUNK] * _permutations(how)
        np.minimum(low, moved.min(axis=1), out=low)
        np.maximum(high, moved.max(axis=1), out=high)
    both = np.stack([low, high], axis=1).ravel()
    both = both[: len(both) // how.rows * how.rows].reshape(-1, how.rows)
    key = np.arange(len(both), dtype=np.uint64)
    for k in range(how.rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + both[:, k])
    return key


def signatures(docs: DataFrame, how: Linking) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, found = [], [], []
            for text in batch.column(1):
                values = shingles(text.as_py(), how.shingle)
                sizes.append(len(values))
                keys.append(xxhash.xxh3_128_digest(values.tobytes()) if len(values) else None)
                found.append(bands(values, how).view(np.int64) if len(values) else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(found, pa.list_(pa.int64()))], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(sign, SIGNATURE)


def marked(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows (doc_id, text) of docs whose doc_id is among the distinct ``ids``, and some
    6 percent of the others: every task has a map of the hashes of the ids."""
    size = min(MARKS, max(64, 16 * ids.count()))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(size)).alias("place")
    word, bit = F.expr("place div 64").alias("word"), F.expr("shiftleft(1L, int(place % 64))")
    marks = ids.select(place).groupBy(word).agg(F.bit_or(bit).alias("marks"))
    placed = docs.select(F.col("doc_id").cast("long"), "text").select("doc_id", "text", place).select("*", word)
    return placed.join(F.broadcast(marks), "word").filter(F.col("marks").bitwiseAND(bit) != 0).select("doc_id", "text")


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows (doc_id, text) of docs whose doc_id is among the distinct ``ids``. Most texts
    are like no other; few of these are shuffled."""
    return marked(docs, ids).join(ids, "doc_id")


def fits(a: str, b: str, how: Linking):
    """Whether two set sizes can reach the wanted similarity at all."""
    return 100 * F.least(a, b) >= how.percent * F.greatest(a, b)


def confirmed(pairs: DataFrame, texts: DataFrame, how: Linking) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.

    The text of ``b``, which may stand in many pairs, is joined first; Spark can split
    that join. ``a`` is then spread evenly.
    """
    both = (
        pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("b_text")), "b")
        .join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("a_text")), "a")
        .select("a", "b", "a_text", "b_text")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, None
        for batch in batches:
            keep = []
            for one, other in zip(batch.column(2), batch.column(3), strict=True):
                text = other.as_py()
                if text != last or known is None:
                    last, known = text, shingles(text, how.shingle)
                mine = shingles(one.as_py(), how.shingle)
                same = len(np.intersect1d(mine, known, assume_unique=True))
                keep.append(100 * same >= how.percent * (len(mine) + len(known) - same))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(compare, "a long, b long")


def roots(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is its component's smallest.

    Large-star and small-star rounds: each ties nodes to the smallest neighbour, until
    nothing changes. A node with many links costs a row for each of them, no pairs.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    state = None
    while True:
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if found == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
        state = found
        sides = edges.union(edges.select("v", "u")).toDF("n", "m")
        least = sides.groupBy("n").agg(F.min("m").alias("least"))
        # merged whatever their size: three dozen small broadcasts would add up in the driver
        large = sides.join(least.hint("merge"), "n").filter("m > n").select(F.col("m").alias("u"), F.least("n", "least").alias("v")).distinct()
        small = large.groupBy("u").agg(F.min("v").alias("least"))
        tied = large.join(small.hint("merge"), "u").select(F.explode(F.array(F.struct("u", F.col("least").alias("v")), F.struct(F.col("v").alias("u"), F.col("least").alias("v")))).alias("e"))
        edges = stored(tied.select("e.u", "e.v").filter("u <> v").distinct(), "links")


def parted(pairs: DataFrame, tied: DataFrame) -> DataFrame:
    """The pairs (a, b) whose ends are not in one component."""
    for end in ("a", "b"):
        root = tied.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root"))
        pairs = pairs.join(root.hint("merge"), end, "left")
    apart = F.coalesce("a_root", "a") != F.coalesce("b_root", "b")
    return pairs.filter(apart).select("a", "b")


def rare_shingles(sets: DataFrame, texts: DataFrame, how: Linking) -> DataFrame:
    """Shingles by which a set (class_id, set_id, n, least) can meet those it may be linked with:
    value and left, how many of its shingles are that one or come later, rarest first.

    Two sets have no more in common than either has left at the first shingle that they
    share, so one with too few left for a link with ``least`` shingles cannot be that first one.
    """
    schema = pa.schema([("class_id", pa.int64()), ("set_key", pa.binary()), ("shingles", pa.list_(pa.int64()))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                values = shingles(text.as_py(), how.shingle)
                key = xxhash.xxh3_128_digest(values.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([doc_id]), pa.array([key]), pa.array([values.view(np.int64)], pa.list_(pa.int64()))], schema=schema)

    ids = sets.select(F.col("class_id").alias("doc_id")).distinct()
    cuts = texts.join(ids, "doc_id", "left_semi").select("doc_id", "text").distinct().mapInArrow(cut, "class_id long, set_key binary, shingles array<long>")
    cuts = cuts.withColumn("set_id", F.xxhash64("set_key")).dropDuplicates(["class_id", "set_id"]).join(sets, ["class_id", "set_id"])
    values = cuts.select("class_id", "set_id", "n", "least", F.explode("shingles").alias("value"))
    known = values.groupBy("value").agg(F.count("*").alias("sets")).filter("sets > 1")
    later = Window.partitionBy("class_id", "set_id").orderBy(F.desc("sets"), F.desc("value"))
    wanted = how.percent * (F.col("n") + F.greatest("least", F.ceil(F.col("n") * how.percent / 100)))
    # a shingle of no other set comes before all of these
    ranked = values.join(known, "value").withColumn("left", F.row_number().over(later))
    return ranked.filter((100 + how.percent) * F.col("left") >= wanted).select("class_id", "set_id", "value", "left")


def components_of(docs: DataFrame, how: Linking) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Equal sets form one class, which its smallest id stands for. Each bucket's head is
    the member that meets the most others in all its buckets. First, each member is
    compared with the weightiest of its heads, then with those of them that are not in
    its component yet. Then members of buckets that still hold several components are
    compared with those of other components whom they meet in a bucket and in a shingle
    rare enough, see :func:`rare_shingles`: at 85 percent, a link needs 185 * shared >=
    85 * (both sizes), and no more can be shared than is left from the first shared one on.

    A NULL or empty text has no shingle and links with nothing. Rows of one id count as
    one document, which links as each of its texts does. A row without id links with nothing, has no component_id and is kept.
    Columns other than doc_id and text are ignored.
    """
    signed = stored(signatures(docs, how), "signed")
    full = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    firsts = full.groupBy("set_key").agg(F.min("doc_id").alias("class_id"))
    # an id may have several texts, and so sets: each has bands of its own
    classes = full.join(firsts, "set_key").filter("doc_id = class_id").select("class_id", F.xxhash64("set_key").alias("set_id"), F.col("n_shingles").alias("n"), "bands")
    classes = stored(classes.dropDuplicates(["class_id", "set_id"]), "classes")

    rows = classes.select("class_id", "set_id", "n", F.explode("bands").alias("key"))
    rows = stored(rows.join(rows.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), "key"), "buckets")
    # who shares the most bands with others is likest to them all
    weight = rows.groupBy("class_id").agg(F.sum("size").alias("weight"))
    heads = rows.join(weight, "class_id").groupBy("key").agg(F.max(F.struct("weight", (-F.col("class_id")).alias("minus_id"), "n")).alias("head"))
    rows = rows.join(heads, "key").select("key", "class_id", "set_id", "n", "size", (-F.col("head.minus_id")).alias("head"), F.col("head.n").alias("head_n"), F.col("head.weight").alias("head_weight"))
    rows = stored(rows, "buckets")
    wanted = stored(rows.select(F.col("class_id").alias("doc_id")).distinct(), "wanted")
    texts = stored(texts_of(docs, wanted), "texts")

    first = rows.filter((F.col("class_id") != F.col("head")) & fits("n", "head_n", how))
    first = stored(first.select(F.col("class_id").alias("a"), F.col("head").alias("b"), F.col("head_weight").alias("weight")).distinct(), "pairs")
    # the weightiest head of all its buckets ties most members of a large group, so few of
    # their other pairs still lie between two components
    nearest = first.groupBy("a").agg(F.max(F.struct("weight", (-F.col("b")).alias("minus_id"))).alias("head")).select("a", (-F.col("head.minus_id")).alias("b"))
    links = stored(confirmed(nearest, texts, how), "links")
    others = first.select("a", "b").join(nearest, ["a", "b"], "left_anti")
    links = stored(links.union(confirmed(parted(others, roots(links)), texts, how)), "links")

    tied = roots(links)
    several = rows.filter("size > 2").join(tied, F.col("class_id") == F.col("node"), "left")
    several = stored(several.select("key", "class_id", "set_id", "n", F.coalesce("root", "class_id").alias("root")), "buckets")
    spread = several.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min("n").alias("least")).filter("low <> high")
    open_sets = stored(several.join(spread, "key").groupBy("class_id", "set_id", "n", "root").agg(F.min("least").alias("least")), "open")
    open_rows = rare_shingles(open_sets.drop("root"), texts, how).join(open_sets, ["class_id", "set_id"]).join(classes.select("class_id", "set_id", "bands"), ["class_id", "set_id"])
    open_rows = stored(open_rows.select("value", "class_id", "n", "root", "left", "bands"), "rare")
    # each shingle's most frequent component meets only the members of the others
    main = open_rows.groupBy("value", "root").count().groupBy("value").agg(F.max(F.struct("count", "root")).alias("main"), F.count("*").alias("roots")).filter("roots > 1")
    x = open_rows.join(main, "value").filter("root <> main.root").select("value", *[F.col(c).alias(f"x_{c}") for c in ("class_id", "n", "root", "left", "bands")])
    y = open_rows.select("value", *[F.col(c).alias(f"y_{c}") for c in ("class_id", "n", "root", "left", "bands")])
    possible = (
        (F.col("x_root") != F.col("y_root"))
        & fits("x_n", "y_n", how)
        & ((100 + how.percent) * F.least("x_left", "y_left") >= how.percent * (F.col("x_n") + F.col("y_n")))
        & F.arrays_overlap("x_bands", "y_bands")
    )
    second = x.join(y, "value").filter(possible).select(F.greatest("x_class_id", "y_class_id").alias("a"), F.least("x_class_id", "y_class_id").alias("b")).distinct()
    compared = first.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stored(links.union(confirmed(second.join(compared, ["a", "b"], "left_anti"), texts, how)), "links")

    tied = roots(links)
    member = signed.join(firsts, "set_key", "left").join(tied, F.col("class_id") == F.col("node"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "class_id", "doc_id"))
    return member.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
