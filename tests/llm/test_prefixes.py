"""The prefix trie against rebuilt texts on small tables."""

import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from trendlens.llm import prefixes

SCHEMA = "conv_id long, turn long, role string, text string, depth long, words string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def digest(turn):
    return hashlib.sha256(f"{len(turn[0])}:{turn[0]}{turn[1]}".encode()).hexdigest()


def expected(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn, (role or "", text or "")))
    for conv, own in convs.items():
        own.sort(key=lambda t: (t[0] is not None, t[0] or 0, digest(t[1])))
        convs[conv] = [t for _, t in own]
    nodes = {}
    for conv, own in convs.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = convs.get(conv - int(math.fmod(conv, 20)), [])
        path = tuple(base[:h] + own[h:])
        for d in range(len(path) + 1):
            node = nodes.setdefault(path[:d], [[], []])
            node[0].append(conv)
            if d == len(path):
                node[1].append(conv)
    children = {}
    for path in nodes:
        if path:
            children[path[:-1]] = children.get(path[:-1], 0) + 1
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for path, (members, _) in nodes.items():
        own = (len(members) - 1) * len(WORD.findall(path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += own
            leaves[path[:d]] += path not in children
    return sorted(
        (
            min(members), len(path), min(nodes[path[:-1]][0]) if path else None, len(members), children.get(path, 0), leaves[path], saved[path],
            hashlib.sha256(",".join(map(str, sorted(ends))).encode()).hexdigest(),
        )
        for path, (members, ends) in nodes.items()
    )


def table(spark, rows):
    return spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA)


def got(df):
    rows = df.drop("last_conv_id", "last_place").collect()
    return sorted(tuple(r[c] for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")) for r in rows)


def sample(seed):
    draw = random.Random(seed)
    turn = lambda: (draw.choice(["user", "assistant", "", None]), draw.choice(["a b c", "hi", "", None, "one\ttwo  three", "é ü", "x" * 5000]))
    rows = []
    for conv in [*range(90), -1, -3, -20, -25, 10**12, 10**12 + 7]:
        if conv % 11 == 5:
            continue  # some bases are absent
        n = draw.choice([1, 1, 2, 3, 4, 6])
        turns = [turn() for _ in range(n)] if draw.random() < 0.4 else [("user", "hi"), ("assistant", "a b c"), ("user", "hi"), ("assistant", "hi"), ("user", "q q"), ("user", "hi")][:n]
        rows += [(conv, draw.choice([k, k, k, None, 0]), *t) for k, t in enumerate(turns)]
    # a conversation with a third of all rows, and one equal to it for most of its turns
    rows += [(43, k, "user", f"turn {k}") for k in range(150)] + [(44, k, "user", f"turn {k}") for k in range(140)]
    rows += [(None, 0, "user", "no conversation"), (7, 0, "user", "hi"), (7, 0, "user", "hi")]
    # copies in number
    rows += [(200 + 20 * k, t, "user", f"same {t}") for k in range(60) for t in range(3)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_rebuilt_texts(spark, seed):
    rows = sample(seed)
    df = table(spark, rows).repartition(5).cache()
    assert got(prefixes.trie(df, prefixes.Lanes(chunk=7))) == expected(rows)


def test_equal_products_of_different_turns_are_told_apart(spark):
    rows = sample(3)
    lanes = prefixes.Lanes(attempts=((5,), *prefixes.Lanes().attempts))
    assert got(prefixes.trie(table(spark, rows), lanes)) == expected(rows)
    with pytest.raises(ValueError, match="equal products"):
        prefixes.trie(table(spark, rows), prefixes.Lanes(attempts=((5,),)))


def test_references_lead_to_the_last_turn(spark):
    rows = sample(4)
    df = prefixes.trie(table(spark, rows))
    assert df.filter("depth > 0 AND last_conv_id IS NULL").isEmpty() and df.filter("depth = 0").count() == 1


def test_empty_table(spark):
    assert prefixes.trie(table(spark, [])).count() == 0
    assert prefixes.trie(table(spark, [(None, 1, "user", "x")])).count() == 0


def test_running_sums_of_a_hot_key(spark):
    df = spark.range(5000).select((F.col("id") >= 1000).cast("long").alias("k"), "id", F.col("id").alias("v0"), (F.col("id") % 7).alias("v1"))
    out = prefixes.running(df.repartition(6), "k", ["id"], [(1, None), (3, 101)], "t").orderBy("id").collect()
    at, total, state = {}, {}, {}
    for r in out:
        at[r.k] = at.get(r.k, 0) + 1
        total[r.k] = total.get(r.k, 0) + r.id
        state[r.k] = (state.get(r.k, 0) * 3 + r.id % 7) % 101
        assert (r.pos, r.s0, r.s1, r.m1) == (at[r.k], total[r.k], state[r.k], pow(3, at[r.k], 101))
