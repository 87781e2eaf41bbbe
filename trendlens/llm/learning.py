"""What the text classifiers share: bounded labelled samples and sparse online learning."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trendlens.llm.common import fold


def _training(labels: DataFrame, column: str, parts: int, held: int) -> DataFrame:
    rows = labels.filter(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), F.col(column).cast("int").alias("label"))
    return rows.filter(fold("doc_id", parts) != held).groupBy("doc_id").agg(F.max("label").alias("label"))


def labelled_sample(labels: DataFrame, column: str, parts: int, held: int, per_class: int) -> DataFrame:
    """(doc_id, label): at most ``per_class`` labelled ids of each class 0 and 1, by hash.

    Ids whose crc32 modulo ``parts`` is ``held`` are left out, and so are NULLs. An id
    labelled more than once counts with its largest label.
    """
    rows = _training(labels, column, parts, held)
    some = [rows.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for k in (0, 1)]
    return some[0].union(some[1])


def prior_shift(labels: DataFrame, column: str, parts: int, held: int, per_class: int) -> float:
    """The log odds of class 1 among all labelled ids, less those in :func:`labelled_sample`.

    0 while the sample holds both classes whole. One aggregate of two numbers.
    """
    counts = dict(_training(labels, column, parts, held).groupBy("label").count().collect())
    return sum(sign * math.log(counts[k] / min(counts[k], per_class)) for k, sign in ((1, 1), (0, -1)) if k in counts)


def first_of_each(rows: DataFrame, column: str, per_class: int) -> DataFrame:
    """At most ``per_class`` rows for each value, by hash of the id; Spark cuts before it shuffles."""
    order = Window.partitionBy(column).orderBy(F.xxhash64("doc_id"), "doc_id")
    return rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= per_class).drop("place")


@dataclass(frozen=True)
class Ftrl:
    """Follow the regularised leader, per coordinate, with elastic-net penalties."""

    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.5
    l2: float = 0.5
    epochs: int = 3
    seed: int = 5


def train(rows: list[tuple[np.ndarray, np.ndarray]], classes: np.ndarray, size: int, n_classes: int, how: Ftrl) -> tuple[np.ndarray, np.ndarray]:
    """Weights (size, n_classes) and biases of a multinomial logistic regression.

    ``rows`` are (indices, values) without repeated indices.
    """
    z, n = np.zeros((size + 1, n_classes)), np.zeros((size + 1, n_classes))

    def weights(z: np.ndarray, n: np.ndarray, l1: float) -> np.ndarray:
        shrunk = np.sign(z) * l1 - z
        return np.where(np.abs(z) <= l1, 0.0, shrunk / ((how.beta + np.sqrt(n)) / how.alpha + how.l2))

    random = np.random.default_rng(how.seed)
    for _ in range(how.epochs):
        for k in random.permutation(len(rows)):
            at, values = rows[k]
            at, values = np.append(at, size), np.append(values, 1.0)
            old_z, old_n = z[at], n[at]
            w = weights(old_z, old_n, how.l1)
            p = softmax(values @ w)
            p[classes[k]] -= 1
            g = values[:, None] * p
            new_n = old_n + g * g
            z[at] = old_z + g - (np.sqrt(new_n) - np.sqrt(old_n)) / how.alpha * w
            n[at] = new_n
    w = weights(z, n, how.l1)
    return w[:size].astype(np.float32), w[size]


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(logits: np.ndarray, classes: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, by golden-section search."""
    if not len(logits):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))[np.arange(len(classes)), classes]
        return -np.log(np.maximum(p, 1e-12)).mean()

    low, high, ratio = -4.0, 4.0, (5**0.5 - 1) / 2
    while high - low > 1e-3:
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))
