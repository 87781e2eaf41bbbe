"""Toxicity behind disguises: a noisy channel is undone before a text is scored.

Words with a stretch that looks disguised (digits and signs between letters, letters
repeated), and letters set apart, become lattices of possible letters; between letters
set apart, a path keeps the gap or drops it. The most likely path under a character
trigram model of the corpus, found by Viterbi, replaces each. The restored text is scored by a sparse logistic regression on its words and their beginnings.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import crc_fold, distinct, fold, mix, raw, word_prefixes
from trendlens.llm.learning import Ftrl, labelled_sample, prior_shift, train

# Letters that a sign may stand for.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e"}
MASK = "*"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
ALPHABET = LETTERS + "àáâäçèéêëíîïñóôöúùûüß"
SIGNS = "0134578@$!|+€*"

#: Codes of the trigram model: 0 is everything that is no letter.
_code = {c: i + 1 for i, c in enumerate(ALPHABET)}
N = len(ALPHABET) + 1
_table = np.zeros(1 << 16, np.uint8)
for _c, _i in _code.items():
    _table[ord(_c)] = _i
_signs = re.escape(SIGNS)
_disguise = re.compile(
    rf"(?<![^\W_])[^\W_](?:[ .\-_*][^\W_]){{3,}}(?![^\W_])"
    rf"|[^\W\d_][{_signs}]+[^\W_][^\W_{_signs}]*(?:[{_signs}]+[^\W\d_]+)*"
    rf"|(?<![\w{_signs}])(?:[{_signs}]{{1,2}}|(?=\d*[@$!|+€]\d*[@$!|+€])[{_signs.replace(re.escape(MASK), '')}]{{3,4}})(?:[^\W\d_]{{2,}}|[^\W\d_][{_signs}]+[^\W\d_]+)(?:[{_signs}]+[^\W\d_]+)*"
    r"|([^\W\d_])\1{2,}"
)
_apart = re.compile(r"[^\W_](?:[ .\-_*][^\W_]){3,}")
#: In letters set apart: three or more equal ones, a letter, or a separator.
_single = re.compile(r"([^\W_])(?:[ .\-_*]\1){2,}|[^\W_]|[ .\-_*]")
_same = re.compile(r"(.)\1*", re.S)
_letters = re.compile(r"[^\W\d_]*")
_letter = re.compile(r"[^\W\d_]")
_punctuation = bytes.maketrans(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", b" " * 32)

BITS = 22
PREFIXES = (4, 5, 6)
CUT = 0.7
COLUMNS = "doc_id long, held_out boolean, score double, predicted int"


@dataclass(frozen=True)
class Channel:
    """At most ``per_class`` documents of each label are learned from, and the bias is then
    moved to the odds of all training labels; the character model counts every document whose crc32 modulo ``parts`` is not ``held``."""

    per_class: int = 3000
    parts: int = 3
    held: int = 1
    ftrl: Ftrl = field(default_factory=lambda: Ftrl(alpha=0.3, l1=3.0, l2=0.05, epochs=4))


def trigrams(text: str | None) -> np.ndarray:
    """Counts of the trigrams of codes of a text, which begins after a gap."""
    total = np.zeros(N**3, np.int64)
    text = text or ""
    for at in range(0, len(text), 1 << 20):
        points = np.frombuffer(text[max(at - 2, 0) : at + (1 << 20)].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(points < 1 << 16, _table[np.minimum(points, 0xFFFF)], 0).astype(np.int64)
        codes = np.concatenate([[0, 0], codes]) if at == 0 else codes
        total += np.bincount((codes[:-2] * N + codes[1:-1]) * N + codes[2:], minlength=N**3)
    return total


def character_model(docs: DataFrame, how: Channel) -> np.ndarray:
    """Log probabilities (N, N, N) of a code after two others, from all training documents.

    At most N ** 3 counts come to the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(N**3, np.int64)
        for batch in batches:
            for cell in batch.column(0):
                total += trigrams(cell.as_py())
        where = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"gram": where, "n": total[where]})

    rows = docs.filter(fold("doc_id", how.parts) != how.held).select("text").mapInArrow(count, "gram long, n long")
    found = rows.groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(N**3)
    total[found["gram"].to_numpy()] = found["n"].to_numpy()
    total = total.reshape(N, N, N)
    pairs = total.sum(axis=0) + 0.5
    pairs = pairs / pairs.sum(axis=1, keepdims=True)
    mixed = (total + 5 * pairs[None]) / (total.sum(axis=2, keepdims=True) + 5)
    return np.log(mixed).astype(np.float32)


def _options(sign: str, run: int) -> list[tuple[str, float]]:
    """What a run of one sign may stand for, each with the channel's log probability."""
    if sign == MASK:
        return [(c * run if run <= 2 else c, -3.0) for c in LETTERS]
    letters = LEET.get(sign, sign)
    out = []
    for c in letters:
        out.append((c, -0.1 if run != 2 else -1.0))
        if run >= 2:
            out.append((c + c, -1.0 if run > 2 else -0.1))
    return out


def lattice(stretch: str) -> Iterator[list[tuple[str, float]]]:
    """The options of each step. A separator between single letters is a gap or nothing:
    a channel that sets all letters apart puts one there in either case."""
    if _apart.fullmatch(stretch):
        for part in _single.finditer(stretch):
            if part.group(1):
                yield _options(part.group(1), (len(part.group()) + 1) // 2)
            elif part.start() % 2:
                yield [("", 0.0), (part.group(), 0.0)]
            else:
                yield _options(part.group(), 1)
    else:
        for run in _same.finditer(stretch):
            yield _options(run.group(1), len(run.group()))


def decode(stretch: str, model: np.ndarray) -> str:
    """The most likely letters behind a word or letters set apart, by Viterbi over its lattice.

    A state is the last two letters; it begins after a gap and ends before one. Ties fall
    to the option first in natural order.
    """
    # a path is a chain of its last letters and the path before them
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for options in lattice(stretch):
        after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (cost, path) in states.items():
            for letters, channel in options:
                x, y, gained = a, b, cost + channel
                for c in letters:
                    z = _code.get(c, 0)
                    gained += float(model[x, y, z])
                    x, y = y, z
                old = after.get((x, y))
                if old is None or gained > old[0]:
                    after[(x, y)] = (gained, (letters, path))
        states = after
    path = max(((cost + float(model[a, b, 0]), path) for (a, b), (cost, path) in states.items()), key=lambda s: s[0])[1]
    found = []
    while path:
        letters, path = path
        found.append(letters)
    return "".join(reversed(found))


def disguised(text: str) -> list[tuple[int, int]]:
    """Spans that look disguised, widened to the letters on both sides; none overlap."""
    spans: list[tuple[int, int]] = []
    for m in _disguise.finditer(text):
        start, end = m.span()
        least = spans[-1][1] if spans else 0
        while start > least and _letter.match(text, start - 1):
            start -= 1
        end = _letters.match(text, end).end()
        if spans and start <= least:
            spans[-1] = (spans[-1][0], max(least, end))
        else:
            spans.append((start, end))
    return spans


class Restorer:
    """Undoes disguises in whole texts; remembers stretches decoded before."""

    def __init__(self, model: np.ndarray):
        self.decode = lru_cache(1 << 16)(lambda stretch: decode(stretch, model))

    def __call__(self, text: str | None) -> str:
        text, parts, at = (text or "").lower(), [], 0
        for start, end in disguised(text):
            parts += [text[at:start], self.decode(text[start:end])]
            at = end
        return "".join([*parts, text[at:]])


def features(restored: str) -> np.ndarray:
    """Sorted distinct buckets of a restored text's words and word beginnings."""
    hashes = word_prefixes(raw(restored).translate(_punctuation), PREFIXES)
    salted = [mix(h + np.uint64(k)) >> np.uint64(64 - BITS) for k, h in enumerate(hashes)]
    return distinct(np.concatenate(salted)).astype(np.int64)


def fitted(docs: DataFrame, labels: DataFrame, how: Channel) -> dict:
    """The character model, and weights of the buckets that have any."""
    model = character_model(docs, how)
    ids = F.broadcast(labelled_sample(labels, "toxic", how.parts, how.held, how.per_class))
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(ids, "doc_id").select("doc_id", "label", "text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(model)
        for batch in batches:
            for doc_id, label, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield pa.RecordBatch.from_pydict({"doc_id": [doc_id], "label": pa.array([label], pa.int32()), "cells": [features(restore(text)).astype("<u4").tobytes()]})

    found = rows.mapInArrow(measure, "doc_id long, label int, cells binary").groupBy("doc_id", "label").agg(F.min("cells").alias("cells")).toArrow().sort_by("doc_id")
    classes = found["label"].to_numpy().astype(np.int64)
    if len(set(classes.tolist())) < 2:
        return {"characters": model, "at": None}
    # buckets of a single document tell nothing about others
    sets = [np.frombuffer(cell.as_buffer(), "<u4") for cell in found["cells"]]
    frequency = np.zeros(1 << BITS, np.uint32)
    for s in sets:
        frequency[s] += 1  # a document's buckets are distinct
    known = np.flatnonzero(frequency > 1)
    place = np.full(1 << BITS, -1, np.int32)
    place[known] = np.arange(len(known))
    # all values are ones: rows share them
    ones = np.ones(max(map(len, sets)))
    inputs = [(at, ones[: len(at)]) for at in (at[at >= 0] for at in map(place.__getitem__, sets))]
    del found, sets, frequency, place
    weights, bias = train(inputs, classes, len(known), 2, how.ftrl)
    margin = weights[:, 1] - weights[:, 0]
    kept = margin != 0
    shift = prior_shift(labels, "toxic", how.parts, how.held, how.per_class)
    return {"characters": model, "at": known[kept], "weights": margin[kept], "bias": float(bias[1] - bias[0]) + shift}


def scored(docs: DataFrame, labels: DataFrame, how: Channel = Channel(), keep: Sequence[str] = ()) -> DataFrame:
    """Per document the columns COLUMNS.

    A NULL text is empty; an empty one is scored like any other. If the labels hold only
    one class or none, every score is 0. Rows of one id are scored one by one, equal
    texts alike. Columns other than doc_id and text are ignored, but those in ``keep``
    come along.
    """
    model = fitted(docs, labels, how)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(model["characters"])
        weights = np.zeros(1 << BITS, np.float32)
        if model["at"] is not None:
            weights[model["at"]] = model["weights"]

        def score(text: str | None) -> float:
            if model["at"] is None:
                return 0.0
            margin = float(weights[features(restore(text))].sum()) + model["bias"]
            return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))

        for batch in batches:
            ids = batch.column(0).to_pylist()
            scores = [score(cell.as_py()) for cell in batch.column(1)]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(ids, pa.int64()),
                    "held_out": [crc_fold(i, how.parts) == how.held for i in ids],
                    "score": scores,
                    "predicted": pa.array([int(s >= CUT) for s in scores], pa.int32()),
                }
                | {c: batch.column(2 + k) for k, c in enumerate(keep)}
            )

    kept = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").alias("_text"), *keep).mapInArrow(judge, COLUMNS + kept)
