"""Order-preserving packing of documents into fixed windows by dynamic programming.

The documents of a partition form one stream of ids. A window may end after a document
(free), after a sentence or inside one (at a penalty). The cuts that minimise padding
plus penalties over the whole partition are found with a monotone queue over the last
``size`` ids; a cut is written once no later id can change it.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import batched, slabs

COLUMNS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
SENTENCE_ENDS = (".</w>", "!</w>", "?</w>", "...</w>", ".\"</w>", "!!</w>")


@dataclass(frozen=True)
class Packing:
    """Windows of ``size`` ids; a cut after a sentence costs as much as ``sentence`` ids of
    padding, one elsewhere as ``inside``, and is looked for every ``step`` ids (1: at
    every id).

    Every ``buffer`` ids the cuts that are sure are written and their ids let go.
    """

    tokenizer: str
    end: int = 2
    size: int = 4096
    sentence: int = 16
    inside: int = 48
    step: int = 64
    buffer: int = 1 << 19


#: The tokenizer reads A-Z as a-z; doing so first makes fewer different words.
_lower = bytes(c + 32 if 65 <= c < 91 else c for c in range(256))
#: The marks of ASCII.
MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
WORD_END = "</w>"
#: Small letters of ASCII and Latin-1, which have one code point each, and words of them in UTF-8.
LETTERS = "".join(map(chr, [*range(97, 123), *range(0xDF, 0xF7), *range(0xF8, 0x100)]))
_latin = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+").fullmatch


def _plain(word: bytes) -> bool:
    """Whether a word ends with a letter that stays one when read as a small one."""
    if word[-1] < 0x80:
        return 97 <= word[-1] <= 122
    end = word[-4:].decode("utf-8", "ignore")[-1:]
    return end.isalpha() and len(end.lower()) == 1


class Words:
    """Ids of texts by a tokenizer that takes the stretches between white space one by one.

    The tokenizer's pattern matches no white space and its normaliser changes nothing
    across it, so a text's ids are those of its stretches. Ids of ``most`` to twice as many
    stretches of at most ``longest`` bytes are remembered, those in use of late.
    """

    def __init__(self, path: str, most: int = 1 << 18, longest: int = 64):
        # a thread pool in every worker would take more cores than Spark gave it
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokens = Tokenizer.from_file(path)
        self.most, self.longest = most, longest
        self.known: dict[bytes, bytes] = {}
        self.aged: dict[bytes, bytes] = {}
        vocabulary = self.tokens.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for w, i in vocabulary.items() if w.endswith(WORD_END)]] = True
        # words of these letters need neither normaliser nor pattern, unless their pairs show otherwise
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = normalizers.Sequence([])
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        pairs = " ".join([LETTERS, *(a + b for a in LETTERS for b in LETTERS)])
        if self.letters.encode(pairs, add_special_tokens=False).ids != self.tokens.encode(pairs, add_special_tokens=False).ids:
            self.letters = self.tokens

    def _encode(self, words: list[bytes]) -> list[bytes]:
        found = self.tokens.encode_batch_fast([w.decode("utf-8", "surrogatepass") for w in words], add_special_tokens=False)
        return [array("I", f.ids).tobytes() for f in found]

    def _spelled(self, words: list[bytes], tokens) -> list[bytes]:
        """Words of letters alone, as one text: each ends with the id of a word's end."""
        found = tokens.encode_batch_fast([b" ".join(words).decode("utf-8", "surrogatepass")], add_special_tokens=False)
        ids = np.array(found[0].ids, "<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            return self._encode(words)
        data, at = ids.tobytes(), [0, *(4 * ends).tolist()]
        return [data[i:j] for i, j in zip(at, at[1:], strict=False)]

    def _learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of new stretches. Marks after a letter are tokens of their own, so what is
        before them and they are looked up one by one."""
        known, aged = self.known.get, self.aged.get
        # what was met before the last change of generations keeps its ids
        new = {w: ids for w in words if (ids := aged(w)) is not None} if self.aged else {}
        parted, need = {}, set()
        for w in words.difference(new):
            bare = w.rstrip(MARKS)
            if 0 < len(bare) < len(w) and b"<|" not in w and _plain(bare):
                parted[w] = parts = bare, w[len(bare) :]
                for x in parts:
                    if x not in new and x not in need:  # or is met alone already
                        if (ids := known(x) or aged(x)) is None:
                            need.add(x)
                        else:
                            new[x] = ids
            else:
                need.add(w)
        simple = [w for w in need if w.isalpha() or _latin(w)]
        need = list(need.difference(simple))
        alone = [x.isalpha() for x in b" ".join(need).decode("utf-8", "surrogatepass").split(" ")] if need else []
        spelled, other = [w for w, a in zip(need, alone, strict=True) if a], [w for w, a in zip(need, alone, strict=True) if not a]
        for found, tokens in ((simple, self.letters), (spelled, self.tokens)):
            if found:
                new.update(zip(found, self._spelled(found, tokens), strict=True))
        if other:
            new.update(zip(other, self._encode(other), strict=True))
        for w, (bare, marks) in parted.items():
            new[w] = new[bare] + new[marks]
        return new

    def _ids(self, pieces: list[bytes]) -> list[bytes]:
        words = [p.split() for p in pieces]
        missing = set(chain.from_iterable(words)).difference(self.known)
        if missing:
            new = self._learn(missing)
            self.known.update(new)
        found = [b"".join(map(self.known.__getitem__, w)) for w in words]
        if missing and max(map(len, new)) > self.longest:
            for w in new:
                if len(w) > self.longest:
                    del self.known[w]
        if len(self.known) > self.most:
            self.aged, self.known = self.known, {}
        return found

    def __call__(self, texts: Iterable[str | None], group: int = 1 << 18) -> Iterator[np.ndarray]:
        """Ids of each text in turn; about ``group`` bytes are worked on at once."""
        pieces: list[bytes] = []
        held = 0
        for text in texts:
            data = (text or "").encode("utf-8", "surrogatepass").translate(_lower)
            if len(data) > group:
                yield from (np.frombuffer(ids, "<u4") for ids in self._ids(pieces))
                pieces, held = [], 0
                yield np.frombuffer(b"".join(self._ids([slab])[0] for _, slab in slabs(data)), "<u4")
                continue
            pieces.append(data)
            held += len(data)
            if held >= group:
                yield from (np.frombuffer(ids, "<u4") for ids in self._ids(pieces))
                pieces, held = [], 0
        yield from (np.frombuffer(ids, "<u4") for ids in self._ids(pieces))


@lru_cache(maxsize=2)
def encoder(path: str) -> Words:
    return Words(path)


class Cutter:
    """The cheapest windows over a stream of places where one may end."""

    def __init__(self, size: int):
        self.size = size
        # ``sums`` are costs plus places, in which a window's padding cancels out
        self.at, self.sums, self.back = [0], [0], [0]
        self.queue = deque([0])
        self.root = 0  # the latest place whose window's start is settled
        self.last: tuple[int, int] | None = None

    def add(self, places: list[int], fees: list[int]) -> None:
        """Ascending places above 0, at most ``size`` apart, and what a cut there costs."""
        if not places:
            return
        if self.last:
            places, fees = [self.last[0], *places], [self.last[1], *fees]
        # the last place may be the stream's end, which is charged otherwise
        self.last = places[-1], fees[-1]
        at, sums, back, queue, size = self.at, self.sums, self.back, self.queue, self.size
        first = queue[0]
        last, least = at[first] + size, sums[first] + size  # of windows from the best start on
        for n, (place, fee) in enumerate(zip(places[:-1], fees[:-1], strict=True), len(at)):
            if place > last:
                while place - at[queue[0]] > size:
                    queue.popleft()
                first = queue[0]
                last, least = at[first] + size, sums[first] + size
            total = least + fee
            # the best start stays, as its own sum is less than the total
            while sums[queue[-1]] > total:
                queue.pop()
            queue.append(n)
            at.append(place)
            sums.append(total)
            back.append(first)

    def _path(self, j: int) -> list[int]:
        ends = []
        while j != self.root:
            ends.append(self.at[j])
            j = self.back[j]
        return ends[::-1]

    def settled(self) -> list[int]:
        """New ends that every open choice shares."""
        alive = set(self.queue)
        while len(alive) > 1:
            j = max(alive)
            alive.remove(j)
            alive.add(self.back[j])
        root = alive.pop()
        ends = self._path(root)
        self.root = root
        # open choices may go back far: what is held is moved only when half of it is settled
        if 2 * root > len(self.at):
            self.at, self.sums = self.at[root:], self.sums[root:]
            self.back = [max(b - root, 0) for b in self.back[root:]]
            self.queue = deque(j - root for j in self.queue)
            self.root = 0
        return ends

    def finish(self) -> list[int]:
        """The ends that are left. The last window is not charged for padding; among equal costs
        the earlier start wins."""
        if not self.last:
            return []
        place = self.last[0]
        i = min((k for k in self.queue if place - self.at[k] <= self.size), key=lambda k: self.sums[k] - self.at[k])
        return [*self._path(i), place]


def cuts(places: np.ndarray, penalties: np.ndarray, size: int) -> list[int]:
    """Ends of the windows over a stream that ends at the last place, see :class:`Cutter`."""
    cutter = Cutter(size)
    cutter.add(places.tolist(), penalties.tolist())
    return cutter.finish()


def candidates(docs: list[np.ndarray], how: Packing, stops: np.ndarray, begin: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Places in the stream, whose ids from ``begin`` on are ``docs``, where a window may end, and
    what that costs."""
    stream = np.concatenate(docs)
    fee = np.full(len(stream) + 1, -1, np.int64)
    fee[np.arange(how.step - begin % how.step, len(stream) + 1, how.step)] = how.inside
    fee[np.flatnonzero(np.isin(stream, stops)) + 1] = how.sentence
    fee[np.cumsum([len(d) for d in docs])] = 0
    fee[0] = -1
    places = np.flatnonzero(fee >= 0)
    return places + begin, fee[places]


def packed(docs: DataFrame, how: Packing) -> DataFrame:
    """One row for each piece of a document, see COLUMNS.

    Every id lies in one piece; each document ends with the id ``end``, so a NULL or
    empty text is that id alone. Documents keep the order of their partition, and a
    partition's last window may be short. Rows of one id are packed one by one. Columns
    other than doc_id and text are ignored; an empty table gives no row. A document's ids
    are held at once, so memory follows the longest text.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(how.tokenizer)
        vocabulary = encode.tokens.get_vocab()
        stops = np.array([vocabulary[w] for w in SENTENCE_ENDS if w in vocabulary], np.uint32)
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 40
        cutter = Cutter(how.size)
        # (doc_id, ids, ids of the document before these, ids of the document)
        waiting: deque[tuple[int | None, np.ndarray, int, int]] = deque()
        begin = opened = 0  # stream places of the first waiting id and of the open window

        def pieces(ends: list[int]) -> Iterator[tuple[tuple, int]]:
            nonlocal begin, opened, number
            for end in ends:
                while begin < end:
                    doc_id, ids, before, whole = waiting.popleft()
                    n = min(end - begin, len(ids))
                    yield (doc_id, before, n, zlib.crc32(ids[:n].tobytes()), whole, number, begin - opened), 56
                    if n < len(ids):
                        waiting.appendleft((doc_id, ids[n:], before + n, whole))
                    begin += n
                opened = end
                number += 1

        def rows() -> Iterator[tuple[tuple, int]]:
            fresh: list[np.ndarray] = []
            seen = held = 0
            for batch in batches:
                for doc_id, ids in zip(batch.column(0).to_pylist(), encode(text.as_py() for text in batch.column(1)), strict=True):
                    ids = np.append(ids, np.uint32(how.end))
                    waiting.append((doc_id, ids, 0, len(ids)))
                    fresh.append(ids)
                    held += len(ids)
                    if held >= how.buffer:
                        places, fees = candidates(fresh, how, stops, seen)
                        cutter.add(places.tolist(), fees.tolist())
                        seen, held, fresh = seen + held, 0, []
                        yield from pieces(cutter.settled())
            if fresh:
                places, fees = candidates(fresh, how, stops, seen)
                cutter.add(places.tolist(), fees.tolist())
            yield from pieces(cutter.finish())

        return batched(rows(), COLUMNS)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(walk, COLUMNS)
