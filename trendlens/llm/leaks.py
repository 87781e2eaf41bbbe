"""Benchmark decontamination with an Aho-Corasick automaton.

Every window of consecutive words of an item is a pattern over normalised text: words
parted by one space, a space at both ends. A document is normalised once and scanned
once; the ends of the matches lead back to words and to code points of the original.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import batched, stored

#: Bytes as they are compared: a-z for A-Z, a space for what parts words. All bytes of a
#: code point above 0x7F belong to a word.
FOLD = bytes(c if c >= 0x80 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 32 for c in range(256))

SEGMENTS = "item string, words binary"
FOUND = "doc_id long, n_words long, n_hit long, items array<string>, span_starts array<long>, span_ends array<long>"


@dataclass(frozen=True)
class Leaks:
    """Windows of ``window`` words. Items go into one automaton up to ``block`` bytes of
    normalised text, which is about 300 times as much memory (300 MB); beyond that into
    several of this size. ``segment`` words of an item stay together."""

    window: int = 10
    block: int = 1 << 20
    segment: int = 1024


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split() if text else []


def _joined(words: list[bytes]) -> str:
    """Words as the automaton reads them, a character for each byte."""
    return f" {b' '.join(words).decode('latin-1')} "


def segments(items: DataFrame, how: Leaks = Leaks()) -> DataFrame:
    """Stretches of the items' words that together hold each window once, see SEGMENTS."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for item, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    words = words_of(text.as_py())
                    last = max(len(words) - how.window + 1, 1) if words else 0
                    for at in range(0, last, how.segment):
                        part = b" ".join(words[at : at + min(how.segment, last - at) + how.window - 1])
                        yield ("" if item is None else item, part), len(part)

        return batched(rows(), SEGMENTS)

    return items.select(F.col("item_id").cast("string"), "text").mapInArrow(walk, SEGMENTS)


def automaton(parts: list[tuple[str, bytes]], how: Leaks) -> tuple[ahocorasick.Automaton, list[list[str]]]:
    """The automaton over all windows; a match gives the number of words and that of a set of items."""
    owners: dict[str, set[str]] = {}
    for item, part in parts:
        words = part.split()
        for at in range(max(len(words) - how.window + 1, 1)):
            owners.setdefault(_joined(words[at : at + how.window]), set()).add(item)
    found = ahocorasick.Automaton()
    numbers: dict[frozenset[str], int] = {}
    for pattern, items in owners.items():
        found.add_word(pattern, (pattern.count(" ") - 1, numbers.setdefault(frozenset(items), len(numbers))))
    if owners:
        found.make_automaton()
    return found, [sorted(x) for x in numbers]


def matches(words: list[bytes], found: ahocorasick.Automaton) -> tuple[list[int], list[int], set[int]]:
    """Runs of hit words as first words and ends, and the numbers of the sets of items that occur."""
    ends, sizes, sets = [], [], set()
    for end, (n, items) in found.iter(_joined(words)):
        ends.append(end)
        sizes.append(n)
        sets.add(items)
    if not ends:
        return [], [], sets
    # a match ends on the space after its last word
    spaces = np.cumsum([len(w) + 1 for w in words])
    last = np.searchsorted(spaces, ends)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, last + 1 - np.array(sizes), 1)
    np.add.at(edge, last + 1, -1)
    return *runs(np.cumsum(edge[:-1]) > 0), sets


def runs(hit: np.ndarray) -> tuple[list[int], list[int]]:
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()


def spans(text: str, firsts: list[int], ends: list[int]) -> tuple[list[int], list[int]]:
    """Code points of the original text where runs of words begin and end."""
    if not firsts:
        return [], []
    data = text.encode("utf-8", "surrogatepass")
    codes = np.frombuffer(data, np.uint8)
    word = np.concatenate([[0], np.frombuffer(data.translate(FOLD), np.uint8) != 32, [0]]).astype(np.int8)
    edge = np.diff(word)
    begin, end = np.flatnonzero(edge == 1)[firsts], np.flatnonzero(edge == -1)[np.array(ends) - 1]
    before = np.concatenate([[0], np.cumsum((codes & 0xC0) != 0x80)])
    return before[begin].tolist(), before[end].tolist()


def _blocks(items: DataFrame, how: Leaks) -> Iterator[list[tuple[str, bytes]]]:
    """The segments, dealt to as many blocks as their counted size asks for, one at a time.

    A block that goes through the driver is not much above the size in ``how``: a segment
    is a bounded stretch, and the hash deals them evenly, copies of an item too.
    """
    parts = segments(items, how).distinct()
    size = parts.agg(F.sum(F.length("words") + F.length("item") + 16)).first()[0] or 0
    n = -(-size // how.block) or 1
    if n == 1:
        yield [tuple(r) for r in parts.collect()]
        return
    held = stored(parts.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(n))), "leak_segments")
    for k in range(n):
        yield [(r.item, r.words) for r in held.filter(F.col("block") == k).collect()]


def _scanned(docs: DataFrame, parts: list[tuple[str, bytes]], how: Leaks) -> DataFrame:
    """The rows of ``docs`` (an id and a text first) with what one block finds, in words."""
    sent = docs.sparkSession.sparkContext.broadcast(parts)
    kinds = f"row long, {FOUND}"

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, sets = automaton(sent.value, how)

        def rows():
            for batch in batches:
                for row, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                    whole = text.as_py()
                    words = words_of(whole)
                    firsts, ends, which = matches(words, found) if words and len(found) else ([], [], set())
                    items = sorted({i for k in which for i in sets[k]})
                    a, b = spans(whole, firsts, ends) if firsts else ([], [])
                    n_hit = sum(ends) - sum(firsts)
                    yield (row, doc_id, len(words), n_hit, items, a, b), 40 + 16 * len(a) + sum(map(len, items))

        return batched(rows(), kinds)

    return docs.mapInArrow(walk, kinds)


def found(docs: DataFrame, items: DataFrame, how: Leaks = Leaks()) -> DataFrame:
    """One row for each document, see FOUND: how many of its words lie in an occurrence of a
    window of an item, the items that occur (sorted as strings), and the stretches of hit
    words as code points of the original text.

    NULL and empty texts have no word and match nothing; an item without words has no
    window. Rows of one item id are one item with the windows of all; an item without id
    is the item named "". Repeated rows and ids of documents are kept one by one. Columns
    other than these are ignored; an empty table of documents gives no row, an empty
    benchmark hits nothing. A text is read whole; memory follows the longest one.
    """
    plain = docs.select(F.col("doc_id").cast("long"), "text")
    blocks = _blocks(items, how)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return _scanned(plain.select(F.lit(0).cast("long").alias("row"), "doc_id", "text"), first, how).drop("row")
    numbered = stored(plain.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "leak_texts")
    each = _scanned(numbered, first, how)
    for block in chain([second], blocks):
        each = each.unionByName(_scanned(numbered, block, how).filter("n_hit > 0"))
    once = each.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.flatten(F.collect_list("span_starts")).alias("span_starts"),
        F.flatten(F.collect_list("span_ends")).alias("span_ends"),
    )
    return _united(once, numbered)


def _united(once: DataFrame, numbered: DataFrame) -> DataFrame:
    """The spans of all blocks as one set of words: counted again where more than one block hit."""
    kinds = f"row long, {FOUND}"

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for row, doc_id, n_words, items, starts, ends, text in zip(*[batch.column(k).to_pylist() for k in range(7)], strict=True):
                    if not starts:
                        yield (row, doc_id, n_words, 0, items, [], []), 0
                        continue
                    data = text.encode("utf-8", "surrogatepass")
                    edge = np.diff(np.concatenate([[0], np.frombuffer(data.translate(FOLD), np.uint8) != 32, [0]]).astype(np.int8))
                    before = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
                    begin = before[np.flatnonzero(edge == 1)]
                    mark = np.zeros(len(begin) + 1, np.int64)
                    np.add.at(mark, np.searchsorted(begin, starts), 1)
                    np.add.at(mark, np.searchsorted(begin, ends), -1)
                    firsts, stops = runs(np.cumsum(mark[:-1]) > 0)
                    a, b = spans(text, firsts, stops)
                    yield (row, doc_id, n_words, sum(stops) - sum(firsts), items, a, b), 40 + 16 * len(a)

        return batched(rows(), kinds)

    hit = once.join(numbered.select("row", "text"), "row").select("row", "doc_id", "n_words", "items", "span_starts", "span_ends", "text")
    return hit.mapInArrow(walk, kinds).drop("row")


def digests(rows: DataFrame) -> DataFrame:
    """The contract's columns out of rows of :func:`found`."""
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
