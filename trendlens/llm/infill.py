"""Fill-in-middle over texts kept as seekable compressed frames.

A text is a row of independent zstandard frames with the cumulative counts of code
points and bytes after each. A cut decompresses the frame it falls in and no other:
whole frames go into the output as they are. Digests stream the frames in order.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import batched

PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Places of the three parts in an output, by form.
ORDERS = {PSM: (PREFIX, SUFFIX, MIDDLE), SPM: (SUFFIX, PREFIX, MIDDLE)}

FRAMED = "doc_id long, frames binary, unit_ends array<long>, byte_ends array<long>, marked boolean"
FILLED = "doc_id long, n long, form string, prefix_chars long, middle_chars long, frames binary, unit_ends array<long>, byte_ends array<long>"
DIGESTS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


@dataclass(frozen=True)
class Framing:
    """``units`` code points are in a frame at most; of 100 rows about ``plain`` stay as
    they are, and of 100 others ``spm`` have the suffix first."""

    units: int = 1 << 16
    level: int = 1
    plain: int = 10
    spm: int = 20


@lru_cache(maxsize=4)
def _packer(level: int) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=level, write_checksum=False)


_unpacker = zstandard.ZstdDecompressor()


class Frames:
    """Frames end to end in ``data``, with the counts after each."""

    __slots__ = ("byte_ends", "data", "unit_ends")

    def __init__(self, data: bytes, unit_ends: list[int], byte_ends: list[int]):
        self.data, self.unit_ends, self.byte_ends = data, unit_ends, byte_ends

    def __len__(self) -> int:
        return self.unit_ends[-1] if self.unit_ends else 0

    def packed(self, k: int) -> bytes:
        return self.data[self.byte_ends[k - 1] if k else 0 : self.byte_ends[k]]

    def text(self, k: int) -> str:
        return _unpacker.decompress(self.packed(k)).decode("utf-8", "surrogatepass")

    def touched(self, start: int, stop: int) -> Iterator[tuple[int, int, int, int]]:
        """Frames that hold units from ``start`` to ``stop``: number, size, and the part's place in it."""
        k = bisect_right(self.unit_ends, start)
        while start < stop:
            begin, end = self.unit_ends[k - 1] if k else 0, self.unit_ends[k]
            yield k, end - begin, start - begin, min(stop, end) - begin
            start, k = end, k + 1

    def read(self, start: int, stop: int) -> Iterator[str]:
        for k, _, a, b in self.touched(start, stop):
            yield self.text(k)[a:b]


class Writer:
    """Gathers texts and whole frames into new frames."""

    def __init__(self, how: Framing):
        self.how, self.parts, self.unit_ends, self.byte_ends = how, [], [], []
        self.held: list[str] = []
        self.units = 0

    def _add(self, packed: bytes, units: int) -> None:
        self.parts.append(packed)
        self.unit_ends.append((self.unit_ends[-1] if self.unit_ends else 0) + units)
        self.byte_ends.append((self.byte_ends[-1] if self.byte_ends else 0) + len(packed))

    def _flush(self, least: int) -> None:
        if self.units < least:
            return
        text, size, at = "".join(self.held), self.how.units, 0
        while len(text) - at >= least:
            part = text[at : at + size]
            self._add(_packer(self.how.level).compress(part.encode("utf-8", "surrogatepass")), len(part))
            at += len(part)
        self.held, self.units = [text[at:]] if at < len(text) else [], len(text) - at

    def write(self, text: str) -> None:
        if text:
            self.held.append(text)
            self.units += len(text)
            self._flush(self.how.units)

    def copy(self, frames: Frames, start: int, stop: int) -> None:
        """The units from ``start`` to ``stop``; whole large frames are not decompressed."""
        for k, size, a, b in frames.touched(start, stop):
            if b - a == size and size >= self.how.units // 2:
                self._flush(1)
                self._add(frames.packed(k), size)
            else:
                self.write(frames.text(k)[a:b])

    def done(self) -> Frames:
        self._flush(1)
        return Frames(b"".join(self.parts), self.unit_ends, self.byte_ends)


def frames_of(text: str, how: Framing) -> Frames:
    writer = Writer(how)
    for at in range(0, len(text), how.units):
        writer.write(text[at : at + how.units])
    return writer.done()


def _draws(doc_id: int | None) -> list[int]:
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def plan(doc_id: int | None, n: int, marked: bool, how: Framing) -> tuple[str, int | None, int | None]:
    """Form, end of the prefix and end of the middle."""
    h1, h2, h3, h4 = _draws(doc_id)
    if not n or marked or h3 % 100 >= 100 - how.plain:
        return PLAIN, None, None
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    return SPM if h4 % 100 < how.spm else PSM, a, b


def fill(source: Frames, form: str, a: int | None, b: int | None, how: Framing) -> Frames:
    """The output of a text: its parts in the order of the form, each after its mark."""
    if form == PLAIN:
        return source
    places = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, len(source))}
    writer = Writer(how)
    for mark in ORDERS[form]:
        writer.write(mark)
        writer.copy(source, *places[mark])
    return writer.done()


def restore(output: Frames, form: str) -> Iterator[str]:
    """The text that an output was made from, in pieces, out of the output and its form alone."""
    if form == PLAIN:
        yield from output.read(0, len(output))
        return
    # a text with a mark stays plain, so each mark of the form is there once
    at: dict[str, int] = {}
    tail, seen = "", 0
    for k in range(len(output.unit_ends)):
        part = tail + output.text(k)
        for mark in MARKS:
            if mark not in at and (found := part.find(mark)) >= 0:
                at[mark] = seen + found
        tail = part[-2:]
        seen += len(part) - len(tail)
    starts = [at[m] for m in ORDERS[form]]
    ends = dict(zip(ORDERS[form], [*starts[1:], len(output)], strict=True))
    for mark in (PREFIX, MIDDLE, SUFFIX):
        yield from output.read(at[mark] + len(mark), ends[mark])


def _sha256(pieces: Iterator[str]) -> str:
    digest = hashlib.sha256()
    for piece in pieces:
        digest.update(piece.encode("utf-8", "surrogatepass"))
    return digest.hexdigest()


def framed(docs: DataFrame, how: Framing = Framing()) -> DataFrame:
    """One row of frames for each document, see FRAMED; ``marked`` where the text has a mark.

    A NULL text is empty and has no frame. Repeated rows and ids are kept one by one;
    columns other than doc_id and text are ignored; an empty table gives no row.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                    whole = text.as_py() or ""
                    kept = frames_of(whole, how)
                    yield (doc_id.as_py(), kept.data, kept.unit_ends, kept.byte_ends, any(m in whole for m in MARKS)), len(kept.data)

        return batched(rows(), FRAMED)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(walk, FRAMED)


def _frames(batch: pa.RecordBatch, at: int) -> Iterator[Frames]:
    for data, units, ends in zip(*[batch.column(at + k) for k in range(3)], strict=True):
        yield Frames(data.as_py(), units.as_py(), ends.as_py())


def filled(frames: DataFrame, how: Framing = Framing()) -> DataFrame:
    """The outputs as frames, see FILLED, for rows of :func:`framed`.

    The parts of a plain output are NULL. A row without id draws as if its id were the
    empty text.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for doc_id, source, marked in zip(batch.column(0).to_pylist(), _frames(batch, 1), batch.column(4).to_pylist(), strict=True):
                    form, a, b = plan(doc_id, len(source), marked, how)
                    output = fill(source, form, a, b, how)
                    middle = None if a is None else b - a
                    yield (doc_id, len(source), form, a, middle, output.data, output.unit_ends, output.byte_ends), len(output.data)

        return batched(rows(), FILLED)

    return frames.select(*[c.split()[0] for c in FRAMED.split(", ")]).mapInArrow(walk, FILLED)


def digests(outputs: DataFrame) -> DataFrame:
    """Digests of the outputs and of the texts rebuilt from them, see DIGESTS, one frame in memory at a time."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for head, output in zip(zip(*[batch.column(k).to_pylist() for k in range(5)], strict=True), _frames(batch, 5), strict=True):
                    yield (*head, _sha256(output.read(0, len(output))), _sha256(restore(output, head[2]))), 0

        return batched(rows(), DIGESTS)

    return outputs.select(*[c.split()[0] for c in FILLED.split(", ")]).mapInArrow(walk, DIGESTS)


def texts(outputs: DataFrame) -> DataFrame:
    """The outputs as text: doc_id, form, output."""
    kinds = "doc_id long, form string, output string"

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for doc_id, form, output in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), _frames(batch, 5), strict=True):
                    whole = "".join(output.read(0, len(output)))
                    yield (doc_id, form, whole), len(whole)

        return batched(rows(), kinds)

    return outputs.select(*[c.split()[0] for c in FILLED.split(", ")]).mapInArrow(walk, kinds)
