"""Language identification: sparse multinomial logistic regression on TF-IDF character
n-grams, trained by follow-the-regularised-leader and calibrated by temperature."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import crc_fold, fold
from trendlens.llm.learning import Ftrl, first_of_each, softmax, temperature, train

BITS = 16
SLAB = 1 << 20
COLUMNS = "doc_id long, held_out boolean, lang_pred string, score double"
UNKNOWN = "und"

_letter = regex.compile(r"\p{L}")
_is_letter = np.array([chr(i).isalpha() for i in range(1 << 16)])
_factors = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], np.uint32)


@dataclass(frozen=True)
class Languages:
    """At most ``per_class`` documents of each language are learned from; a tenth of them
    sets the temperature. All training documents count for the document frequencies.
    Documents whose crc32 modulo ``parts`` is ``held`` are not."""

    per_class: int = 900
    parts: int = 5
    held: int = 0
    ftrl: Ftrl = field(default_factory=lambda: Ftrl(alpha=0.5, l1=0.05, l2=0.05, epochs=2))


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the 1- to 3-grams of letters of a text, word ends included, and counts."""
    total = np.zeros(1 << BITS, np.int64)
    text = text or ""
    for at in range(0, len(text), SLAB):
        codes = np.frombuffer(text[at : at + SLAB].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _is_letter[np.minimum(codes, 0xFFFF)] | (codes > 0xFFFF)
        codes = np.where(letter, codes, np.uint32(32))
        codes = np.concatenate([np.array([32], np.uint32), codes[letter | np.append(True, letter[:-1])], np.array([32], np.uint32)])
        h = codes * _factors[0]
        for n in range(3):
            if n:
                h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * _factors[n] + codes[n:]
            mixed = (h ^ (h >> np.uint32(13))) * np.uint32(0x27D4EB2F)
            total += np.bincount(mixed >> np.uint32(32 - BITS), minlength=1 << BITS)
    where = np.flatnonzero(total)
    return where, total[where]


def weighed(where: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = np.log1p(counts) * idf[where]
    return values / (np.sqrt(values @ values) or 1.0)


def frequencies(rows: DataFrame) -> tuple[int, np.ndarray]:
    """How many rows there are, and in how many of them each bucket occurs.

    Each task sends one row a bucket; the sums of all are what reaches the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 << BITS) + 1, np.int64)
        for batch in batches:
            total[-1] += batch.num_rows
            for cell in batch.column(0):
                total[ngrams(cell.as_py())[0]] += 1
        where = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": where, "n": total[where]})

    total = np.zeros((1 << BITS) + 1, np.int64)
    for r in rows.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[r.bucket] = r.n
    return int(total[-1]), total[:-1]


def fitted(docs: DataFrame, how: Languages) -> dict:
    """Names, weights and temperature; the sample's counts and a sum for each bucket are
    all that reaches the driver."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.filter((F.length("text") > 0) & F.col("lang").isNotNull() & (fold("doc_id", how.parts) != how.held))
    ids = F.broadcast(first_of_each(rows.select("doc_id", "lang"), "lang", how.per_class).distinct())
    chosen = rows.join(ids, ["doc_id", "lang"], "left_semi")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                where, counts = ngrams(text)
                cells = where.astype("<u2").tobytes() + np.minimum(counts, 65535).astype("<u2").tobytes()
                yield pa.RecordBatch.from_pydict({"doc_id": [doc_id], "lang": [lang], "cells": [cells]})

    found = chosen.select("doc_id", "lang", "text").mapInArrow(count, "doc_id long, lang string, cells binary")
    found = sorted(found.groupBy("doc_id", "lang").agg(F.min("cells").alias("cells")).collect(), key=lambda r: (r.lang, r.doc_id))
    names = sorted({r.lang for r in found})
    sparse = [tuple(np.frombuffer(r.cells, "<u2").reshape(2, -1).astype(np.int64)) for r in found]
    n, frequency = frequencies(rows)
    idf = np.log((1 + n) / (1 + frequency)) + 1
    inputs = [(where, weighed(where, counts, idf)) for where, counts in sparse]
    classes = np.array([names.index(r.lang) for r in found], np.int64)
    check = np.arange(len(inputs)) % 10 == 9
    weights, bias = train([x for x, c in zip(inputs, check, strict=True) if not c], classes[~check], 1 << BITS, max(len(names), 1), how.ftrl)
    logits = np.array([x[1] @ weights[x[0]] + bias for x, c in zip(inputs, check, strict=True) if c])
    return {"names": names, "idf": idf, "weights": weights, "bias": bias, "temperature": temperature(logits, classes[check])}


def identified(docs: DataFrame, how: Languages = Languages()) -> DataFrame:
    """Per document the columns COLUMNS.

    A NULL text, one without letters, and every text if nothing could be learned, gets
    UNKNOWN with score 0. Rows of one id are judged one by one; among equal scores the
    first name wins. Columns other than doc_id, text and (for learning) lang are ignored.
    """
    model = fitted(docs, how)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, names, scores = batch.column(0).to_pylist(), [], []
            for cell in batch.column(1):
                text = cell.as_py()
                if not text or not model["names"] or not _letter.search(text):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                where, counts = ngrams(text)
                p = softmax((weighed(where, counts, model["idf"]) @ model["weights"][where] + model["bias"]) / model["temperature"])
                names.append(model["names"][int(p.argmax())])
                scores.append(float(p.max()))
            yield pa.RecordBatch.from_pydict(
                {"doc_id": pa.array(ids, pa.int64()), "held_out": [crc_fold(i, how.parts) == how.held for i in ids], "lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64())}
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(predict, COLUMNS)
