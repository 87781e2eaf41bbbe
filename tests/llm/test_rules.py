"""Certified cutoffs against plain Python, and what they promise on rows not used."""

import math
import random

import pytest
from pyspark.sql import functions as F

from trendlens.llm import rules

LARGE = "/root/testdata/sf0.1"
NAMES = list(rules.RULES)


def tail(n, k, p):
    return 1.0 if k > n * p else sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def plain_cutoffs(rows, tuning, risk):
    """rows: (doc_id, stratum, values) of good documents; tuning: the ids of that fold."""
    found = {}
    cell = lambda v: None if v is None else min(math.ceil(v * risk.steps), risk.steps)
    for stratum in {r[1] for r in rows}:
        first = [[cell(v) for v in r[2]] for r in rows if r[1] == stratum and r[0] in tuning]
        held = [[cell(v) for v in r[2]] for r in rows if r[1] == stratum and r[0] not in tuning]
        if not first or not held:
            continue
        allowed = math.floor(len(first) * (risk.share * risk.spared / len(NAMES)))
        to = [min(s for s in range(risk.steps + 1) if sum(b[k] > s for b in first) <= allowed) for k in range(len(NAMES))]
        setting, at = 0, None
        for j in range(1, risk.steps + 1):
            steps = [risk.steps - math.floor((risk.steps - t) * j / risk.steps) for t in to]
            k = sum(any(b > s for b, s in zip(r, steps, strict=True)) for r in held)
            if tail(len(held), k, risk.share) > (1 - risk.confidence) / (len(risk.edges) + 1):
                break
            setting, at = j, (steps, k)
        if setting:
            for name, step in zip(NAMES, at[0], strict=True):
                found[stratum, name] = (step / risk.steps, len(held), at[1])
    return found


@pytest.mark.parametrize("seed", range(3))
def test_cutoffs_equal_plain_python(spark, seed):
    draw = random.Random(seed)
    risk = rules.Risk(share=0.05, steps=20)
    rows = []
    for i in range(2500):
        values = [min(1.0, abs(draw.gauss(0, 0.1 + 0.05 * k))) if draw.random() < 0.97 else draw.random() for k in range(len(NAMES))]
        rows.append((i, draw.choice([0, 1, 1, 2, 2, 2]) if i > 30 else 3, *values, draw.random() < 0.05))
    kinds = "doc_id long, stratum int, " + ", ".join(f"{n} double" for n in NAMES) + ", base_failed boolean"
    valued = spark.createDataFrame(rows, kinds)
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(2600)] + [(7, 1), (None, 1)], "doc_id long, quality int")
    ids = spark.range(2600).withColumn("t", F.pmod(F.xxhash64("id"), F.lit(risk.tuning)) == 0)
    tuning = {r.id for r in ids.filter("t").collect()}
    got = {(r.stratum, r.rule): (r.cutoff, r.n, r.k) for r in rules.cutoffs(valued, labels, risk).collect()}
    good = [(r[0], r[1], r[2:-1]) for r in rows if not r[-1] and (r[0] % 5 > 0 or r[0] == 7)]
    want = plain_cutoffs(good, tuning, risk)
    assert got == want and len({s for s, _ in got}) >= 2


def test_certified_cutoffs_hold_on_other_rows(spark):
    """On the 0.1 tables, with one label in five held back: cutoffs in at least two strata, which
    reject poor documents and, of good ones not used, no more than promised."""
    docs, labels = (spark.read.parquet(f"{LARGE}/{t}.parquet") for t in ("documents", "labels"))
    unused = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    risk = rules.Risk()
    out = rules.judged(docs, labels.filter(~unused), risk).cache()
    stratum = sum(((F.col("n_words") >= edge).cast("int") for edge in risk.edges), F.lit(0))
    seen = out.join(labels.filter(unused).select("doc_id", "quality"), "doc_id").filter("NOT base_failed").groupBy(stratum.alias("s"), "quality")
    seen = {(r.s, r.quality): (r.n, r.gone) for r in seen.agg(F.count("*").alias("n"), F.count_if(~F.col("kept")).alias("gone")).collect()}
    good, gone = (sum(seen[k][at] for k in seen if k[1] == 1) for at in (0, 1))
    assert gone <= risk.share * good, seen
    poor, caught = (sum(seen[k][at] for k in seen if k[1] == 0) for at in (0, 1))
    assert caught > 0, seen
    used = out.filter("rejected_by <> '' AND NOT base_failed")
    assert used.select(stratum).distinct().count() >= 2
    assert out.filter("kept <> (rejected_by = '')").isEmpty() and out.filter("base_failed AND NOT startswith(rejected_by, 'base')").isEmpty()


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, "x"), (1, "a " * 40, "y"), (None, "b c " * 30, "z")], "doc_id long, text string, n_words string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert sorted((r.doc_id or 0, r.kept, r.rejected_by) for r in rules.judged(docs, labels).collect()) == [(0, False, "base"), (1, False, "base"), (1, False, "base")]
    assert rules.judged(docs.limit(0), labels).count() == 0
