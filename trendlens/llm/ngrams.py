"""Language-model scoring with Elias-Fano n-gram tries.

Words are counted exactly; pairs of words live in tries of two levels, dealt over shards
by the hash of the pair so that no context, however common, makes a shard large. A
trie's contexts and, within each context, its successors ascend; both levels and the
pointers between them are Elias-Fano sequences, and each pair has a quantised probability.
A pair is searched in the compact sequences: its context by a select over the high bits
and a bisection of the low ones, then its word between the context's two pointers.

Documents are packed into compressed slabs where they are read, and stored once. A slab
asks each shard once for its distinct pairs, and the joined answers score the slab's
documents. A shard and a slab hold about a set number of bytes of text however large the
corpus is: their number grows. There is one row for each slab and each shard that it has
pairs in, so never more rows than distinct pairs asked for.

A pair is told apart by its shard, 40 bits of its context and 32 of its word; two pairs
that agree in all of these count as one. Words are told apart by 64 bits.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import arrow_schema, crc_fold, mix, raw, stored, word_spans

END = np.uint64(0x5851F42D4C957F2D)
START = np.uint64(0x14057B7EF767814F)
COLUMNS = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
REPLIES = "slab long, kind int, shard int, body binary"

_ones = np.array([bin(b).count("1") for b in range(256)], np.uint8)
#: Place of the k-th one of a byte, read from its highest bit.
_place = np.zeros((256, 8), np.int64)
for _b in range(256):
    _at = [k for k in range(8) if _b >> (7 - k) & 1]
    _place[_b, : len(_at)] = _at


@dataclass(frozen=True)
class Model:
    """A token's probability is ``mixture`` of its share among the followers of the word
    before it, the rest of the smoothed share of the word; only the latter after an
    unseen word. Documents whose crc32 modulo ``parts`` is ``held`` are not learned from.
    A slab has ``slab_chars`` bytes of text, or one longer document; a shard answers for
    ``shard_slabs`` times as much.
    """

    mixture: float = 0.5
    parts: int = 5
    held: int = 1
    slab_chars: int = 8_000_000
    shard_slabs: int = 3


class EliasFano:
    """A non-decreasing sequence below ``bound``: low bits in whole bytes, high bits in unary.

    The count of ones before each 64 unary bits is kept beside them, for select.
    """

    def __init__(self, values: np.ndarray, bound: int):
        n = len(values)
        self.n = n
        low = max(int(bound // max(n, 1)).bit_length() - 1, 0)
        # up to two bits more in unary cost less than a further byte
        self.bytes = low // 8 + (low % 8 > 2)
        low = np.uint64(8 * self.bytes)
        values = values.astype("<u8")
        unary = np.zeros((int(bound >> int(low)) + n + 64) // 64 * 64, np.uint8)
        unary[(values >> low).astype(np.int64) + np.arange(n)] = 1
        cells = values.view(np.uint8).reshape(n, 8)[:, : self.bytes]
        self.parts = [np.ascontiguousarray(cells).ravel(), np.packbits(unary)]
        self.before = np.concatenate([[0], np.cumsum(unary.reshape(-1, 64).sum(axis=1, dtype=np.int64))])

    def values(self) -> np.ndarray:
        """The whole sequence, decoded."""
        high = np.flatnonzero(np.unpackbits(self.parts[1])) - np.arange(self.n)
        return (high.astype(np.uint64) << np.uint64(8 * self.bytes)) | self.lows(np.arange(self.n))

    def lows(self, at: np.ndarray) -> np.ndarray:
        if self.bytes == 4:
            return self.parts[0].view("<u4")[at].astype(np.uint64)
        out = np.zeros((len(at), 8), np.uint8)
        out[:, : self.bytes] = self.parts[0].reshape(self.n, self.bytes)[at]
        return out.view("<u8").ravel()

    def select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Place in the unary bits of the k-th one, or zero."""
        before = self.before if one else np.arange(len(self.before)) * 64 - self.before
        block = np.searchsorted(before, k, "right") - 1
        rest = k - before[block]
        cells = self.parts[1].reshape(-1, 8)[block]
        cells = cells if one else ~cells
        sums = np.cumsum(_ones[cells], axis=1, dtype=np.int64)
        byte = (sums <= rest[:, None]).sum(axis=1)
        row = np.arange(len(k))
        rest -= np.where(byte > 0, sums[row, byte - 1], 0)
        return 64 * block + 8 * byte + _place[cells[row, byte], rest]

    def get(self, at: np.ndarray) -> np.ndarray:
        high = (self.select(at, True) - at).astype(np.uint64)
        return (high << np.uint64(8 * self.bytes)) | self.lows(at)

    def find(self, values: np.ndarray, first: np.ndarray | int = 0, end: np.ndarray | None = None) -> np.ndarray:
        """Index of each value within [first, end), or -1. No value is above the bound."""
        low = np.uint64(8 * self.bytes)
        high = (values >> low).astype(np.int64)
        # neighbours with equal high bits share their stretch
        runs = np.flatnonzero(np.append(True, high[1:] != high[:-1]))[: len(high)]
        each, times = high[runs], np.diff(np.append(runs, len(high)))
        lo = np.repeat(np.where(each > 0, self.select(np.maximum(each - 1, 0), False) - each + 1, 0), times)
        hi = np.repeat(self.select(each, False) - each, times)
        lo = np.maximum(lo, first)
        stop = hi = hi if end is None else np.minimum(hi, end)
        hi = np.maximum(hi, lo)
        wanted = values & np.uint64((1 << int(low)) - 1)
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) >> 1
            less = self.lows(mid) < wanted[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
            open_ = open_[lo[open_] < hi[open_]]
        out = np.full(len(values), -1)
        there = np.flatnonzero(lo < stop)
        there = there[self.lows(lo[there]) == wanted[there]]
        out[there] = lo[there]
        return out


class Trie:
    """Contexts, pointers to their successors, successors, and quantised probabilities.

    The levels lie in an anonymous memory map. Successors are kept relative to their
    context: the sequence holds (rank of the context, 32 bits of the successor).
    """

    #: Probabilities are kept to a 3000th of a decade.
    STEP = 3000.0
    ABSENT = 65535

    def __init__(self, contexts: np.ndarray, words: np.ndarray, logs: np.ndarray):
        """Rows sorted by (context, word); ``logs`` are log10 values from 0 down."""
        heads, first = np.unique(contexts >> np.uint64(24), return_index=True)
        rank = np.repeat(np.arange(len(heads)), np.diff(np.append(first, len(contexts))))
        self.heads = EliasFano(heads, 1 << 40)
        self.pointers = EliasFano(np.append(first, len(contexts)), len(contexts) + 1)
        self.words = EliasFano((rank.astype(np.uint64) << np.uint64(32)) | words.astype(np.uint64), max(len(heads), 1) << 32)
        quantised = np.minimum(np.round(-logs * self.STEP), self.ABSENT - 1).astype(np.uint16)
        levels = [*self.heads.parts, *self.pointers.parts, *self.words.parts, quantised.view(np.uint8)]
        starts = np.cumsum([0, *(-(-len(x) // 8) * 8 for x in levels)]).tolist()
        self.map = mmap.mmap(-1, max(starts[-1], 1))
        views = []
        for at, level in zip(starts, levels, strict=False):
            self.map[at : at + len(level)] = level.tobytes()
            views.append(np.frombuffer(self.map, np.uint8, len(level), at) if len(level) else level)
        for k, level in enumerate((self.heads, self.pointers, self.words)):
            level.parts = views[2 * k : 2 * k + 2]
        self.quantised = views[6].view(np.uint16) if len(quantised) else quantised

    def codes(self, heads: np.ndarray, followers: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Quantised probabilities of the words after each head, ``followers`` of them in turn;
        ABSENT where a pair is not in the trie. Heads are the upper 40 bits of contexts."""
        rank = self.heads.find(heads)
        known = np.flatnonzero(rank >= 0)
        first, end = np.zeros(len(heads), np.int64), np.zeros(len(heads), np.int64)
        first[known] = self.pointers.get(rank[known]).astype(np.int64)
        end[known] = self.pointers.get(rank[known] + 1).astype(np.int64)
        out = np.full(len(words), self.ABSENT, np.uint16)
        ask = np.flatnonzero(np.repeat(rank >= 0, followers))
        rank, first, end = (np.repeat(x, followers)[ask] for x in (rank, first, end))
        at = self.words.find((rank.astype(np.uint64) << np.uint64(32)) | words[ask].astype(np.uint64), first, end)
        out[ask[at >= 0]] = self.quantised[at[at >= 0]]
        return out

    def lookup(self, contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Log10 probabilities of the pairs; NaN where a pair is not in the trie."""
        codes = self.codes(contexts >> np.uint64(24), np.ones(len(contexts), np.int64), words)
        return np.where(codes == self.ABSENT, np.nan, codes / -self.STEP)


#: Counts enter a trie as shares of ten to this power, so that all shards have one scale.
DECADES = 21


class Slab:
    """The tokens of a slab's documents, its distinct words, and its distinct pairs of a
    token and the one before, in the order in which shards are asked."""

    def __init__(self, body: bytes, shards: int, how: Model):
        table = pa.ipc.open_stream(body).read_all()
        self.ids = table.column("doc_id").to_pylist()
        texts = [raw(t) for t in table.column("text").to_pylist()]
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
        hashes, at, _ = word_spans(b"\n".join(texts))
        self.sizes = np.diff(np.append(np.searchsorted(at, begins), len(at))) + 1
        self.starts = np.cumsum(self.sizes) - self.sizes
        # the marker of a start is among the words too, last for the moment
        tokens = np.full(len(hashes) + len(texts) + 1, END)
        inside = np.ones(len(tokens), bool)
        inside[np.append(self.starts[1:] - 1, [len(tokens) - 2, len(tokens) - 1])] = False
        tokens[inside] = hashes
        tokens[-1] = START
        self.words, place = np.unique(tokens, return_inverse=True)
        self.place, start = place[:-1], place[-1]
        self.lead = np.empty_like(self.place)
        self.lead[1:] = self.place[:-1]
        self.lead[self.starts] = start
        size = len(self.words)
        pairs, self.pair = np.unique(self.lead * size + self.place, return_inverse=True)
        context, word = self.words[pairs // size], self.words[pairs % size]
        shard = _shard(mix(context * np.uint64(0x9E3779B97F4A7C15) + word), shards)
        self.order = np.argsort(shard.astype(np.min_scalar_type(shards)), kind="stable")
        self.shard = shard[self.order]
        self.heads = (context >> np.uint64(24))[self.order]
        self.followers = (word >> np.uint64(32)).astype("<u4")[self.order]
        self.held = np.array([crc_fold(i, how.parts) == how.held for i in self.ids])

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """How often each word and each pair is learned from."""
        learned = np.repeat(~self.held, self.sizes)
        pairs = np.bincount(self.pair[learned], minlength=len(self.order))
        return np.bincount(self.place[learned], minlength=len(self.words)), pairs[self.order]


def packed(docs: DataFrame, how: Model) -> DataFrame:
    """Slabs of documents: (slab, chars, body), the body a compressed Arrow stream."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        chars = 0

        def slab() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                for part in held:
                    out.write_batch(part)
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([chars], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["slab", "chars", "body"])

        for batch in batches:
            batch = pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("text").cast(pa.string())], names=["doc_id", "text"])
            ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
            at = done = 0
            while at < len(ends):
                # as many rows as fit, and one at least into an empty slab
                to = int(np.searchsorted(ends, done + how.slab_chars - chars, "right"))
                to = max(to, at + (not held))
                if to > at:
                    held.append(batch.slice(at, to - at))
                    chars += int(ends[to - 1]) - done
                    at, done = to, int(ends[to - 1])
                if at < len(ends):
                    yield slab()
                    held.clear()
                    number, chars = number + 1, 0
        if held:
            yield slab()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(walk, "slab long, chars long, body binary")


def _reply(slab: int, kind: int, shard: int, body: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((slab, kind, shard, body), arrow_schema(REPLIES), strict=True)], schema=arrow_schema(REPLIES))


def _planes(values: np.ndarray, width: int) -> bytes:
    """The lower bytes of the values, plane by plane, which compresses better."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _from_planes(cells: bytes, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(cells, np.uint8, n * width).reshape(width, n).T
    return out.view("<u8").ravel()


def _small(counts: np.ndarray) -> bytes:
    """A byte for each count; those from 255 on follow in full."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype("<i8").tobytes()


def _from_small(cells: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(cells, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(cells[n:], "<i8")
    return counts


def _shard(key: np.ndarray, shards: int) -> np.ndarray:
    return ((key >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _cells(shard: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The stretches of equal shards."""
    if len(shard):
        cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield int(shard[a]), slice(a, b)


def asked(slabs: DataFrame, shards: int, how: Model) -> DataFrame:
    """Per slab and shard, the slab's distinct words (kind 0) or pairs (kind 1), with how often
    each is learned from. Pairs come as distinct contexts, a mark where a context begins, words."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, body in zip(batch.column("slab"), batch.column("body"), strict=True):
                slab = Slab(body.as_py(), shards, how)
                words, pairs = slab.counts()
                for shard, at in _cells(_shard(slab.words, shards)):
                    n = at.stop - at.start
                    yield _reply(number.as_py(), 0, shard, np.array([n, n], "<u4").tobytes() + _planes(slab.words[at], 8) + _small(words[at]))
                for shard, at in _cells(slab.shard):
                    heads = slab.heads[at]
                    new = np.append(True, heads[1:] != heads[:-1])
                    sizes = np.array([len(heads), new.sum()], "<u4").tobytes()
                    yield _reply(number.as_py(), 1, shard, b"".join([sizes, _planes(heads[new], 5), np.packbits(new).tobytes(), slab.followers[at].tobytes(), _small(pairs[at])]))

    return slabs.mapInArrow(walk, REPLIES)


def _opened(kind: int, body: bytes) -> tuple[np.ndarray, ...]:
    """A cell of :func:`asked`: words and counts, or heads, their followers, words and counts."""
    n, m = np.frombuffer(body, "<u4", 2).tolist()
    at = 8
    if not kind:
        return _from_planes(body[at : at + 8 * n], n, 8), _from_small(body[at + 8 * n :], n)
    heads = _from_planes(body[at : at + 5 * m], m, 5)
    at += 5 * m
    marks = np.unpackbits(np.frombuffer(body, np.uint8, (n + 7) // 8, at), count=n)
    at += (n + 7) // 8
    followers = np.diff(np.append(np.flatnonzero(marks), n))
    return heads, followers, np.frombuffer(body, "<u4", n, at), _from_small(body[at + 4 * n :], n)


def _trie(cells: list[tuple[np.ndarray, ...]]) -> Trie:
    """The pairs of all cells that are learned from."""
    parts = []
    for heads, followers, words, counts in cells:
        seen = counts > 0
        parts.append((np.repeat(heads, followers)[seen], words[seen], counts[seen]))
    heads, words, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    del parts
    order = np.lexsort((words, heads))
    heads, words, counts = heads[order], words[order], counts[order]
    if len(heads):
        new = np.flatnonzero(np.append(True, (heads[1:] != heads[:-1]) | (words[1:] != words[:-1])))
        heads, words, counts = heads[new], words[new], np.add.reduceat(counts, new)
    return Trie(heads << np.uint64(24), words, np.log10(counts) - DECADES)


def answered(asks: DataFrame, shards: int) -> DataFrame:
    """(slab, kind, shard, body): for words their counts, for pairs what the shard's trie holds,
    in the order asked. A row of slab -1 holds how many tokens of a shard's words are learned
    from, and how many distinct ones."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for (kind, shard), group in groupby(rows, key=lambda r: r[1:3]):
            slabs, cells = [], []
            for slab, _, _, body in group:
                slabs.append(slab)
                cells.append(_opened(kind, body))
            if kind:
                trie = _trie(cells)
                for slab, (heads, followers, words, _) in zip(slabs, cells, strict=True):
                    yield _reply(slab, 1, shard, trie.codes(heads, followers, words).astype("<u2").tobytes())
                continue
            known, place = np.unique(np.concatenate([c[0] for c in cells]), return_inverse=True)
            counts = np.concatenate([c[1] for c in cells])
            # whole numbers, as a sum in floating point would round large counts
            totals = np.zeros(len(known), np.int64)
            np.add.at(totals, place, counts)
            yield _reply(-1, 0, shard, np.array([totals.sum(), (totals > 0).sum()], "<i8").tobytes())
            for slab, (words, _) in zip(slabs, cells, strict=True):
                yield _reply(slab, 0, shard, _planes(totals[np.searchsorted(known, words)], 8))

    dealt_out = asks.repartition(2 * shards, "kind", "shard").sortWithinPartitions("kind", "shard", "slab")
    return dealt_out.mapInArrow(walk, REPLIES)


def _whole(column: str, byte: int):
    """The number in eight bytes of a binary column, the lowest first."""
    each = [F.conv(F.hex(F.substring(column, byte + k, 1)), 16, 10).cast("long") * F.lit(1 << 8 * k) for k in range(8)]
    return sum(each[1:], each[0])


def scored(docs: DataFrame, how: Model = Model()) -> DataFrame:
    """Per document the columns COLUMNS.

    A NULL or empty text is its end alone. Rows of one id are scored one by one, equal
    texts alike; a row without id is learned from. An empty table gives no row; if
    nothing is learned from, every word has the same probability. Other columns are
    ignored.
    """
    slabs = stored(packed(docs, how), "slabs")
    chars, count = slabs.agg(F.coalesce(F.sum("chars"), F.lit(0)), F.count("*")).first()
    shards = chars // (how.slab_chars * how.shard_slabs) + 1
    answers = stored(answered(asked(slabs.select("slab", "body"), shards, how), shards), "answers")
    n, v = answers.filter("slab = -1").agg(F.coalesce(F.sum(_whole("body", 1)), F.lit(0)), F.coalesce(F.sum(_whole("body", 9)), F.lit(0))).first()

    both = slabs.select("slab", F.lit(2).alias("kind"), F.lit(0).alias("shard"), "body").unionByName(answers.filter("slab >= 0"))
    both = both.repartition(max(count, 1), "slab").sortWithinPartitions("slab", "kind", "shard")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*batch.columns, strict=True))
        for _, group in groupby(rows, key=lambda r: r[0].as_py()):
            replies: dict[int, list[bytes]] = {0: [], 1: []}
            for _, kind, _, body in group:
                if kind.as_py() < 2:
                    replies[kind.as_py()].append(body.as_py())
                else:
                    yield _judged(Slab(body.as_py(), shards, how), replies, n, v, how)

    return both.mapInArrow(walk, COLUMNS)


def _judged(slab: Slab, replies: dict[int, list[bytes]], n: int, v: int, how: Model) -> pa.RecordBatch:
    count = np.concatenate([_from_planes(b, len(b) // 8, 8) for b in replies[0]]).astype(float)
    codes = np.empty(len(slab.order), np.uint16)
    codes[slab.order] = np.frombuffer(b"".join(replies[1]), "<u2")
    follows = np.where(codes == Trie.ABSENT, 0.0, 10.0 ** (DECADES - codes / Trie.STEP))[slab.pair]
    c = count[slab.place]
    base = (c + 0.5) / (n + 0.5 * (v + 1))
    # a word's followers are as many as it; a text's start is followed once in each
    # document, as its end is preceded
    lead = count[slab.lead]
    lead[slab.starts] = count[np.searchsorted(slab.words, END)]
    share = np.minimum(follows / np.maximum(lead, 1), 1.0)
    p = np.where(lead > 0, (1 - how.mixture) * base + how.mixture * share, base)
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array(slab.ids, pa.int64()),
            "held_out": slab.held,
            "n_tokens": slab.sizes.astype(np.int64),
            "n_known": np.add.reduceat((c > 0).astype(np.int64), slab.starts),
            "train_tokens": np.full(len(slab.ids), n, np.int64),
            "base_score": np.add.reduceat(np.log10(base), slab.starts),
            "score": np.add.reduceat(np.log10(p), slab.starts),
        }
    )
