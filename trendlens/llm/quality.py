"""Quality by Bradley-Terry ranking: a linear score learned from pairs of a better and a
worse document by logistic loss on the difference of their features, then cut at a
quantile of the scores."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import crc_fold, distinct, raw, word_hashes
from trendlens.llm.learning import labelled_sample

SHAPES = 1 << 12
BINS = 16
STATISTICS = 8
SIZE = SHAPES + STATISTICS * BINS
SLAB = 1 << 20
CUT = 0.3
COLUMNS = "doc_id long, held_out boolean, score double, predicted int"

_shape = np.arange(256, dtype=np.uint32)
_shape[ord("a") : ord("z") + 1] = 1
_shape[128:] = 1
_shape[ord("A") : ord("Z") + 1] = 2
_shape[ord("0") : ord("9") + 1] = 3


@dataclass(frozen=True)
class Ranking:
    """At most ``per_class`` documents of each label are learned from, in ``pairs`` pairs."""

    per_class: int = 2500
    pairs: int = 60_000
    batch: int = 200
    rate: float = 0.1
    decay: float = 1e-4
    parts: int = 5
    held: int = 0
    seed: int = 11


def features(text: str | None) -> np.ndarray:
    """Frequencies of 1- to 4-grams of character kinds, and binned figures of the words."""
    data = raw(text)
    shapes = np.zeros(SHAPES, np.int64)
    for at in range(0, len(data), SLAB):
        kinds = _shape[np.frombuffer(data, np.uint8, min(SLAB, len(data) - at), at)]
        # a run of lower case is one sign, so that spelling does not matter
        kinds = kinds[np.append(True, (kinds[1:] != 1) | (kinds[:-1] != 1))]
        h = kinds * np.uint32(0x9E3779B1)
        for n in range(4):
            if n:
                h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + kinds[n:]
            mixed = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
            shapes += np.bincount(mixed >> np.uint32(20), minlength=SHAPES)
    words = word_hashes(data)
    n = len(words)
    most = int(np.unique(words, return_counts=True)[1].max()) if n else 0
    lines = Counter(line for line in data.split(b"\n") if line.strip())
    threes = words[:-2] * np.uint64(3) + words[1:-1] * np.uint64(5) + words[2:] * np.uint64(7) if n > 2 else words[:0]
    figures = (
        np.log1p(n) / 12,
        np.log1p(len(data)) / 16,
        len(distinct(words)) / n if n else 0.0,
        float((words[1:] == words[:-1]).mean()) if n > 1 else 0.0,
        most / n if n else 0.0,
        len(distinct(threes)) / len(threes) if len(threes) else 1.0,
        1 - len(lines) / sum(lines.values()) if lines else 0.0,
        min(len(data) / n / 24, 1.0) if n else 0.0,
    )
    out = np.zeros(SIZE, np.float32)
    out[:SHAPES] = np.sqrt(shapes / max(shapes.sum(), 1))
    for k, figure in enumerate(figures):
        out[SHAPES + k * BINS + min(int(figure * BINS), BINS - 1)] = 0.5
    return out


def _matrix(cells: pa.ChunkedArray) -> np.ndarray:
    out = np.empty((len(cells), SIZE), "<f2")
    for k, cell in enumerate(cells):
        out[k] = np.frombuffer(cell.as_buffer(), "<f2")
    return out


def fitted(docs: DataFrame, labels: DataFrame, how: Ranking) -> dict | None:
    """Weights and the raw score at the cut; None unless both labels occur."""
    ids = F.broadcast(labelled_sample(labels, "quality", how.parts, how.held, how.per_class))
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(ids, "doc_id").select("doc_id", "label", "text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, label, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield pa.RecordBatch.from_pydict({"doc_id": [doc_id], "label": pa.array([label], pa.int32()), "cells": [features(text).astype("<f2").tobytes()]})

    found = rows.mapInArrow(measure, "doc_id long, label int, cells binary").groupBy("doc_id", "label").agg(F.min("cells").alias("cells")).toArrow().sort_by("doc_id")
    # the driver holds the features as they come, half as wide, and widens a batch at a time
    sides = [_matrix(found.filter(pc.equal(found["label"], k))["cells"]) for k in (0, 1)]
    del found
    if not len(sides[0]) or not len(sides[1]):
        return None
    random = np.random.default_rng(how.seed)
    w, square = np.zeros(SIZE, np.float32), np.full(SIZE, 1e-6, np.float32)
    for _ in range(how.pairs // how.batch):
        worse, better = (side[random.integers(0, len(side), how.batch)].astype(np.float32) for side in sides)
        difference = better - worse
        miss = 1 / (1 + np.exp(np.clip(difference @ w, -50, 50)))
        g = how.decay * w - miss @ difference / how.batch
        square += g * g
        w -= how.rate * g / np.sqrt(square)
    scores = [side.astype(np.float32) @ w for side in sides]
    quantiles = np.unique(np.quantile(np.concatenate(scores), np.linspace(0, 1, 201)))
    right = [(scores[0] < q).mean() + (scores[1] >= q).mean() for q in quantiles]
    # the middle of the best quantiles
    best = np.flatnonzero(np.array(right) >= max(right) - 1e-9)
    cut = (quantiles[best[0]] + quantiles[best[-1]]) / 2
    spread = (scores[1].mean() - scores[0].mean()) / 4
    return {"weights": w, "cut": float(cut), "spread": float(max(spread, 1e-6))}


def scored(docs: DataFrame, labels: DataFrame, how: Ranking = Ranking(), keep: Sequence[str] = ()) -> DataFrame:
    """Per document the columns COLUMNS; a raw score at the chosen quantile becomes CUT.

    A NULL text is empty; an empty one is scored like any other. If the labels hold only
    one class or none, every score is 0.5. Rows of one id are scored one by one, equal
    texts alike. Columns other than doc_id and text are ignored, but those in ``keep``
    come along.
    """
    model = fitted(docs, labels, how)

    def score(text: str | None) -> float:
        if model is None:
            return 0.5
        x = (float(features(text) @ model["weights"]) - model["cut"]) / model["spread"]
        return float(1 / (1 + np.exp(-np.clip(x + np.log(CUT / (1 - CUT)), -30, 30))))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
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
