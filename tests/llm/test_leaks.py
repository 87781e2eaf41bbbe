"""Decontamination against plain search, in one block and in several."""

import random
import re

import pytest

from trendlens.llm import leaks

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, n_words long, items string"
ITEMS = "item_id long, text string, doc_id long"
VOCABULARY = ["one", "Two", "3", "é", "漢字", "x9", "été", "Ab", "o", "wo", "on"]


def words(text):
    return [m.group() for m in WORD.finditer((text or "").translate({c: c + 32 for c in range(65, 91)}))]


def expected(docs, items, window):
    patterns = {}
    for item, text in items:
        w = words(text)
        for s in range(max(len(w) - window + 1, 1) if w else 0):
            patterns.setdefault(tuple(w[s : s + window]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(p) for p in patterns}:
            for p in range(len(w) - size + 1):
                if tuple(w[p : p + size]) in patterns:
                    hit |= set(range(p, p + size))
                    found |= patterns[tuple(w[p : p + size])]
        covered = [WORD.pattern and m.span() for k, m in enumerate(WORD.finditer((text or "").translate({c: c + 32 for c in range(65, 91)}))) if k in hit]
        out.append((doc_id, len(w), len(hit), sorted(found), covered))
    return out


def sample(seed):
    draw = random.Random(seed)
    text = lambda n: "".join(draw.choice(VOCABULARY) + draw.choice([" ", ", ", "\n", "--", " \x00 ", "`"]) for _ in range(n))
    items = [(i, text(draw.choice([0, 1, 2, 3, 5, 12, 30]))) for i in range(12)]
    items += [(3, text(9)), (None, text(4)), (None, None), (20, ""), (21, "... --"), (4, items[4][1]), (99, items[4][1]), (100, items[5][1].upper())]
    docs = [(i, text(draw.choice([0, 1, 4, 40, 200]))) for i in range(30)]
    docs += [(1000 + k, text(5) + (t or "") + " " + text(5)) for k, (_, t) in enumerate(items)]
    docs += [(None, items[6][1]), (None, None), (5, docs[5][1]), (5, docs[5][1]), (6, items[5][1])]
    docs += [(7000, text(8_000) + (items[5][1] or ""))]
    return docs, items


@pytest.mark.parametrize("how", [leaks.Leaks(window=4), leaks.Leaks(window=4, segment=3), leaks.Leaks(window=4, block=900, segment=2)])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_search(spark, how, seed):
    docs, items = sample(seed)
    left = spark.createDataFrame([(i, t, 0, "x") for i, t in docs], DOCS).repartition(4)
    right = spark.createDataFrame([(i, t, 0) for i, t in items], ITEMS)
    assert how.block > 1000 or len(list(leaks._blocks(right, how))) > 1
    got = [r.asDict() for r in leaks.found(left, right, how).collect()]
    spans = [[(a, b) for a, b in zip(r["span_starts"], r["span_ends"], strict=True)] for r in got]
    want = expected(docs, items, how.window)
    key = lambda r: (str(r[0]), r[1:4])
    rows = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"], s) for r, s in zip(got, spans, strict=True)), key=key)
    assert [r[:4] for r in rows] == [r[:4] for r in sorted(want, key=key)]
    # the spans hold the hit words and nothing else that is a word
    for row, plain in zip(rows, sorted(want, key=key), strict=True):
        assert all(any(a <= x and y <= b for a, b in row[4]) for x, y in plain[4])
        assert sum(1 for x, y in plain[4]) == row[2]


def test_spans_map_to_the_original(spark):
    docs = spark.createDataFrame([(1, "Été -- The QUICK,\tbrown  fox; jumps"), (2, "the quick red fox")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "the quick brown FOX")], "item_id long, text string")
    hit, clean = sorted(leaks.found(docs, items, leaks.Leaks(window=3)).collect(), key=lambda r: r.doc_id)
    assert "Été -- The QUICK,\tbrown  fox; jumps"[hit.span_starts[0] : hit.span_ends[0]] == "The QUICK,\tbrown  fox"
    assert (hit.n_hit, hit.items, clean.n_hit, clean.items) == (4, ["7"], 0, [])


@pytest.mark.parametrize("empty", ["docs", "items"])
def test_empty_tables(spark, empty):
    docs = spark.createDataFrame([] if empty == "docs" else [(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([] if empty == "items" else [(1, "a b c")], "item_id long, text string")
    got = leaks.digests(leaks.found(docs, items)).collect()
    assert [r.contaminated for r in got] == ([] if empty == "docs" else [False])
