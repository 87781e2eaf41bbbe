"""Helpers shared by the operators: words, their 64-bit hashes, stored steps."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.session import scratch_path

SPACES = b" \t\n\x0b\x0c\r"
#: The same characters as a Java pattern: a run of them parts two words.
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
#: Longest stretch of bytes hashed at once, which bounds a task's memory on very long texts.
SLAB = 1 << 20

_space = re.compile(rb"[ \t-\r]")
_is_space = np.zeros(256, bool)
_is_space[list(SPACES)] = True
_letter = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_letter[ord("A") : ord("Z") + 1] = _letter[ord("a") : ord("z") + 1]
_BASE = 0x9E3779B97F4A7C15
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_written: list[list[str]] = []


@contextmanager
def released(spark: SparkSession) -> Iterator[list[str]]:
    """Deletes the tables that :func:`stored` writes inside, at the end; a path taken out of the
    list stays. For work whose results are written by then."""
    _written.append(paths := [])
    try:
        yield paths
    finally:
        _written.remove(paths)
        for path in paths:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again, which cuts its lineage."""
    path = scratch_path(df.sparkSession, name)
    if _written:
        _written[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(column: str, parts: int):
    """crc32 of the id as text, modulo ``parts``; 0 for a row without id."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % parts, F.lit(0))


def raw(text: str | None) -> bytes:
    """UTF-8 of a text; a NULL is empty."""
    return text.encode("utf-8", "surrogatepass") if text else b""


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all output bits; a bijection on 64-bit integers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def distinct(values: np.ndarray) -> np.ndarray:
    """The sorted distinct values."""
    values = np.sort(values)
    new = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return values[new]


def _grown(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers


def _spans(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    codes = np.frombuffer(data, np.uint8)
    word = np.zeros(len(codes) + 2, np.int8)
    word[1:-1] = ~_is_space[codes]
    edge = np.diff(word)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    power, inverse = _grown(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_letter[codes] * power[: len(codes)], out=sums[1:])
    return sums, inverse, starts, ends


def _slab(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sums, inverse, starts, ends = _spans(data)
    return mix((sums[ends] - sums[starts]) * inverse[starts]), starts, ends


def slabs(data: bytes) -> Iterator[tuple[int, bytes]]:
    """Places and stretches of about SLAB bytes that part no word."""
    at = 0
    while at < len(data):
        found = _space.search(data, at + SLAB) if len(data) - at > SLAB else None
        end = found.start() if found else len(data)
        yield at, data[at:end]
        at = end


def word_prefixes(data: bytes, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """Hashes of a text's words, then of the first bytes of the words longer than each size."""
    found: list[list[np.ndarray]] = [[np.empty(0, np.uint64)] for _ in range(len(sizes) + 1)]
    for _, part in slabs(data):
        sums, inverse, starts, ends = _spans(part)
        found[0].append(mix((sums[ends] - sums[starts]) * inverse[starts]))
        for k, size in enumerate(sizes):
            at = starts[ends - starts > size]
            found[k + 1].append(mix((sums[at + size] - sums[at]) * inverse[at]))
    return [np.concatenate(f) for f in found]


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of each word of a text, A-Z read as a-z."""
    if len(data) <= SLAB:
        return _slab(data)
    parts = []
    for at, part in slabs(data):
        h, s, e = _slab(part)
        parts.append((h, s + at, e + at))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def word_hashes(data: bytes) -> np.ndarray:
    return word_spans(data)[0]


_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


def arrow_schema(columns: str) -> pa.Schema:
    """The Arrow schema of columns given as "name type, name type"."""
    return pa.schema([(name, _ARROW[kind]) for name, kind in (c.split(" ", 1) for c in columns.split(", "))])


def batched(rows: Iterator[tuple[tuple, int]], columns: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows, each with its size in bytes, as batches of about ``most`` bytes or 2048 rows."""
    schema = arrow_schema(columns)
    held: list[tuple] = []
    size = 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)

    for row, n in rows:
        held.append(row)
        size += n
        if size >= most or len(held) == 2048:
            yield batch()
            held.clear()
            size = 0
    if held:
        yield batch()


def crc_fold(doc_id: int | None, parts: int) -> int:
    """:func:`fold` for one id."""
    return 0 if doc_id is None else zlib.crc32(str(doc_id).encode()) % parts
