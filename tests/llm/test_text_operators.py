"""The other operators against plain recomputation on small tables with odd rows."""

import hashlib
import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trendlens.llm import language, learning, minhash, ngrams, quality, rules, spotsigs, toxicity

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, n_shingles long, score double"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i}" for i in range(60))
TEXTS = ["", None, "a b", "A b", LONG, LONG + " tail", LONG.upper(), "one two three four five six", "\n\n", "spam " * 40, "x#y $z\nx#y $z\nother", "é ü ñ"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", 0, 0.0) for i, t in enumerate(TEXTS)] + [(None, "no id here", None, 0, 0.0), (2, "a b", "en", 0, 0.0)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def shingle_set(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def components(rows):
    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = sorted((top(i), top(j)))
                root[y] = x
    return {i: (len(s), top(i)) for i, s in sets}


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_minhash(table, request):
    df = request.getfixturevalue(table)
    want = components([tuple(r) for r in df.select("doc_id", "text").collect()])
    got = minhash.components_of(df, minhash.Linking()).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_spotsigs(documents):
    rows = sorted((r.doc_id, r.text or "") for r in documents.select("doc_id", "text").collect())
    got = {r.doc_id: r for r in spotsigs.fingerprinted(documents).collect()}
    assert len(got) == len(rows)
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        a, b, c = (spotsigs.spot_signatures(t, spotsigs.Spots()) for t in (text, changed, following))
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert spotsigs.parse(got[i].fingerprint).tolist() == a.tolist()
        assert (got[i].near_edited, got[i].near_next) == (spotsigs.likeness(a, b), spotsigs.likeness(a, c))


@pytest.mark.parametrize("threshold", [0.4, 0.8])
def test_spotsigs_join(spark, threshold):
    random = np.random.default_rng(8)
    bare = [" ".join(random.choice(["the", "of", "a", *(f"w{i}" for i in range(400))], 60, p=[0.1] * 3 + [0.7 / 400] * 400)) for _ in range(25)]
    texts = [*TEXTS, *bare]
    for k, text in enumerate(bare):
        words = text.split()
        texts += [" ".join([*words[: 60 - k], "end"]), " ".join([*words, *words[:k]]), text]
    rows = list(enumerate(texts))
    sets = {i: spotsigs.spot_signatures(t, spotsigs.Spots()) for i, t in rows}
    first = {}
    for i, s in sets.items():
        first.setdefault(s.tobytes(), i)
    want = {(i, first[s.tobytes()]): 1.0 for i, s in sets.items() if first[s.tobytes()] != i}
    heads = sorted(first.values())
    for k, i in enumerate(heads):
        for j in heads[:k]:
            found = spotsigs.likeness(sets[i], sets[j])
            if found >= threshold:
                want[(i, j)] = found
    assert sum(x < 1 for x in want.values()) > 10
    docs = spark.createDataFrame([*rows, (None, bare[0])], "doc_id long, text string")
    assert {(r.a, r.b): r.likeness for r in spotsigs.alike(docs, threshold).collect()} == want
    assert spotsigs.alike(docs.limit(0), threshold).count() == 0


def test_spotsigs_bounds_lose_no_pair():
    for threshold in (0.5, 0.55, 0.7, 0.8, 0.9):
        for size in range(1, 2000):
            most = max(n for n in (int(size / threshold), int(size / threshold) + 1) if size / n >= threshold)
            assert spotsigs.length_class(most, threshold) - spotsigs.length_class(size, threshold) <= 1
            assert spotsigs.likeness(np.arange(size), np.arange(most), threshold) == size / most


def measures(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {i + k for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for k in range(8)}
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in rules.SYMBOLS), len(lines) - len(set(lines)), len(covered)


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_rules(table, request, labels):
    df = request.getfixturevalue(table)
    texts = Counter((r.doc_id, measures(r.text)) for r in df.collect())
    rows = rules.judged(df, labels).collect()
    assert Counter((r.doc_id, tuple(r[m] for m in rules.MEASURES)) for r in rows) == texts
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_binomial_tail(spark):
    from pyspark.sql import functions as F

    for n, k, p in ((50, 0, 0.05), (400, 3, 0.02), (2000, 10, 0.01)):
        exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        got = spark.range(1).select(rules.tail(F.lit(n), F.lit(k), p)).first()[0]
        assert math.isclose(got, exact, rel_tol=1e-9)


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_ngrams(table, request):
    df = request.getfixturevalue(table)
    how = ngrams.Model(slab_chars=100_000)
    rows = [(r.doc_id, [*words(r.text), None]) for r in df.collect()]
    count, pairs = Counter(), Counter()
    for i, t in rows:
        if i is None or zlib.crc32(str(i).encode()) % 5 != 1:
            count.update(t)
            pairs.update(zip(["\n", *t], t, strict=False))
    n, v = sum(count.values()), len(count)
    want = []
    for i, t in rows:
        base = [(count[w] + 0.5) / (n + 0.5 * (v + 1)) for w in t]
        score = 0.0
        for a, w, q in zip(["\n", *t], t, base, strict=False):
            lead = count[None] if a == "\n" else count[a]
            score += math.log10(0.5 * q + 0.5 * pairs[(a, w)] / lead if lead else q)
        want.append((-1 if i is None else i, len(t), sum(count[w] > 0 for w in t), sum(map(math.log10, base)), score))
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, r.base_score, r.score) for r in ngrams.scored(df, how).collect())
    assert len(got) == len(want)
    for a, b in zip(got, sorted(want), strict=True):
        assert a[:3] == b[:3] and math.isclose(a[3], b[3], rel_tol=1e-9)
        assert abs(a[4] - b[4]) < 1e-3 * a[1]


@pytest.mark.parametrize("size, times", [(1, 100_000), (50_000, 1), (10**9, 1)])
def test_ngrams_do_not_depend_on_slabs(spark, size, times):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("doc_id < 60").repartition(2, "doc_id")
    want = {r.doc_id: r for r in ngrams.scored(table, ngrams.Model(slab_chars=200_000)).collect()}
    got = ngrams.scored(table, ngrams.Model(slab_chars=size, shard_slabs=times)).collect()
    assert len(got) == len(want)
    for r in got:
        w = want[r.doc_id]
        assert r[:5] == w[:5] and math.isclose(r.score, w.score, rel_tol=1e-9)


def test_trie_and_monotone_sequences():
    random = np.random.default_rng(2)
    for n, bound in ((0, 5), (1, 1), (500, 40), (300, 1 << 40)):
        values = np.sort(random.integers(0, bound, n)).astype(np.uint64)
        assert ngrams.EliasFano(values, bound).values().tolist() == values.tolist()
    for n, bound in ((1, 1), (500, 40), (3000, 1 << 20), (300, 1 << 40)):
        values = np.sort(random.integers(0, bound, n)).astype(np.uint64)
        levels = ngrams.EliasFano(values, bound)
        assert levels.get(np.arange(n)).tolist() == values.tolist()
        asks = np.concatenate([values, random.integers(0, bound, 200).astype(np.uint64), np.uint64([0, bound - 1])])
        at = levels.find(asks)
        assert [x in set(values.tolist()) for x in asks.tolist()] == (at >= 0).tolist()
        assert (values[at[at >= 0]] == asks[at >= 0]).all()
        # only within the stretch asked for
        assert ((levels.find(asks, n // 2, np.full(len(asks), n)) >= n // 2) == (np.searchsorted(values[n // 2 :], asks, "right") > np.searchsorted(values[n // 2 :], asks))).all()
    contexts = np.repeat(np.sort(random.integers(0, 2**63, 90, dtype=np.uint64)), 5)
    following = np.concatenate([np.sort(random.choice(2**32, 5, replace=False)) for _ in range(90)]).astype(np.uint32)
    logs = -3 * random.random(450)
    trie = ngrams.Trie(contexts, following, logs)
    assert np.abs(trie.lookup(contexts, following) - logs).max() < 1 / trie.STEP
    assert np.isnan(trie.lookup(contexts, following ^ np.uint32(1))).sum() > 440


def test_classifiers_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    marks = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    truth = {r.doc_id: r for r in marks.collect()}
    rows = [r for r in quality.scored(docs, marks).collect() if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id].quality for r in rows]) > 0.9
    rows = [r for r in toxicity.scored(docs, marks).collect() if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id].toxic for r in rows]) > 0.85
    langs = dict(docs.select("doc_id", "lang").collect())
    rows = [r for r in language.identified(docs).collect() if r.held_out]
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in rows]) > 0.95


def test_classifiers_on_odd_rows(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(4, 1, 0), (9, 0, 1), (9, 0, 1), (None, 1, 1), (7, None, None), (5, 1, 0), (10, 0, 1)], none.schema)
    for operator in (quality.scored, toxicity.scored):
        for marks in (none, some):
            rows = operator(odd, marks).collect()
            assert len(rows) == len(TEXTS) + 2 and all(0 <= r.score <= 1 for r in rows)
        assert operator(odd.limit(0), some).count() == 0
    got = {r.doc_id: r for r in language.identified(odd).collect()}
    assert got[0].lang_pred == got[1].lang_pred == got[8].lang_pred == "und" and got[4].lang_pred == "en"
    assert language.identified(odd.limit(0)).count() == 0


def test_class_prior_of_a_cut_sample(spark, documents):
    marks = spark.createDataFrame([(i, int(i % 9 == 0)) for i in range(180)], "doc_id long, toxic int")
    marks = marks.union(marks).union(spark.createDataFrame([(None, 1), (7, None)], marks.schema))
    train = [i % 9 == 0 for i in range(180) if zlib.crc32(str(i).encode()) % 3 != 1]
    odds = sum(train) / (len(train) - sum(train))
    assert learning.prior_shift(marks, "toxic", 3, 1, 1000) == 0
    assert math.isclose(learning.prior_shift(marks, "toxic", 3, 1, 5), math.log(odds))
    assert math.isclose(learning.prior_shift(marks, "toxic", 3, 1, sum(train) + 2), math.log(odds * (sum(train) + 2) / sum(train)))
    # two equal texts of both labels tell nothing, so that the score is the share of toxic labels
    same = documents.withColumn("text", F.lit("the same text"))
    score = toxicity.scored(same, marks, toxicity.Channel(per_class=5)).first().score
    assert abs(math.log(score / (1 - score)) - math.log(odds)) < 0.7


def test_document_frequencies_of_all_training_rows(documents):
    how = language.Languages(per_class=3)
    texts = [r.text for r in documents.collect() if r.text and r.lang and (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % how.parts != how.held)]
    frequency = Counter(b for t in texts for b in language.ngrams(t)[0].tolist())
    want = [math.log((1 + len(texts)) / (1 + frequency[b])) + 1 for b in range(1 << language.BITS)]
    assert np.allclose(language.fitted(documents, how)["idf"], want)


def test_empty_tables(odd, labels):
    none = odd.limit(0)
    assert minhash.components_of(none, minhash.Linking()).count() == 0
    assert ngrams.scored(none).count() == spotsigs.fingerprinted(none).count() == rules.judged(none, labels).count() == 0


def test_temperature_and_sparse_weights():
    logits = np.array([[3.0, 0.0], [0.0, 3.0], [3.0, 0.0], [3.0, 0.0]])
    t = learning.temperature(logits, np.array([0, 1, 1, 0]))
    assert math.isclose(learning.softmax(logits / t)[0, 0], 0.75, abs_tol=1e-2)
    rows = [(np.array([k % 2, 2]), np.ones(2)) for k in range(200)]
    weights, _ = learning.train(rows, np.arange(200) % 2, 4, 2, learning.Ftrl())
    assert weights[0, 0] > 0 > weights[0, 1] and not weights[3].any()


def test_disguises_are_undone():
    text = "you are a stupid loser and an idiot. the bad pathetic clown. trash is disgusting. " * 20
    total = toxicity.trigrams(text).reshape((toxicity.N,) * 3) + 1e-3
    model = np.log(total / total.sum(axis=2, keepdims=True)).astype(np.float32)
    restore = toxicity.Restorer(model)
    for disguised, plain in (("l0ser", "loser"), ("s t u p i d", "stupid"), ("looooser", "loser"), ("1d10t", "idiot"), ("clean words, 20 of them!", "clean words, 20 of them!"), (None, "")):
        assert restore(disguised) == plain


def test_whole_words_are_decoded():
    text = "you are a stupid loser and a fool. you are stupid and pathetic. sit down, asshole, says the fool to a loser. the shot met the hut. as a tool. " * 20
    total = toxicity.trigrams(text).reshape((toxicity.N,) * 3) + 1e-3
    model = np.log(total / total.sum(axis=2, keepdims=True)).astype(np.float32)
    restore = toxicity.Restorer(model)
    for disguised, plain in (
        ("you are a s t u p i d person", "you are a stupid person"),
        ("y o u a r e s t u p i d", "you are stupid"),
        ("s t u u u u p i d", "stupid"),
        ("looooser", "loser"),
        ("a fooool", "a fool"),
        ("looooos3r", "loser"),
        ("pathet1c", "pathetic"),
        ("stup*d", "stupid"),
        ("h*t", "hut"),
        ("sh*t", "shot"),
        ("@$$hole", "asshole"),
        ("costs 100 or $20 a day", "costs 100 or $20 a day"),
    ):
        assert restore(disguised) == plain
    assert len(restore("s t u p i d " * 500)) < 4200
    assert toxicity.disguised("looooos3r, no; stup*d") == [(0, 9), (15, 21)]


def test_an_id_links_as_each_of_its_texts(spark):
    """Two texts of one id and one size; copies of either are linked with it, and so with each other."""
    draw = np.random.default_rng(4)
    texts = [" ".join(f"w{x}" for x in draw.integers(0, 10**6, 100)) for _ in range(6)]
    rows = []
    for k in range(3):
        a, b = texts[2 * k : 2 * k + 2]
        rows += [(10 * k + 1, a), (10 * k + 1, b), (10 * k + 2, b.rsplit(" ", 1)[0] + " changed"), (10 * k + 3, a.rsplit(" ", 1)[0] + " other"), (10 * k + 4, a)]
    rows += [(100, "alone " * 3), (101, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.components_of(df, minhash.Linking()).collect()}
    assert got == {i: i if i >= 100 else i // 10 * 10 + 1 for i, _ in rows}


@pytest.mark.parametrize("operator, column, most", [(quality, "quality", 45), (toxicity, "toxic", 55)])
def test_training_keeps_little_in_the_driver(spark, operator, column, most):
    docs = spark.range(2400).selectExpr("id AS doc_id", "concat('word', id % 7, ' and ', id % 11, '. more text') AS text")
    labels = docs.selectExpr("doc_id", f"CAST(doc_id % 2 AS INT) AS {column}")
    how = quality.Ranking() if operator is quality else toxicity.Channel()
    tracemalloc.start()
    try:
        assert operator.fitted(docs, labels, how)
        assert tracemalloc.get_traced_memory()[1] < most << 20
    finally:
        tracemalloc.stop()


def test_a_large_group_of_near_copies_makes_few_pairs(spark, monkeypatch):
    """Copies of one text with few or many changes, of which many are alike by 0.5 to 0.85."""
    draw = np.random.default_rng(11)
    base = [f"w{x}" for x in draw.integers(0, 10**6, 150)]
    rows = []
    for i in range(400):
        text = list(base)
        for at in draw.integers(0, 150, draw.integers(0, 8)):
            text[at] = ["", "the", f"n{draw.integers(0, 10**6)}"][draw.integers(0, 3)]
        rows.append((i, " ".join(text)))
    compared = []
    confirmed = minhash.confirmed

    def counted(pairs, texts, how):
        compared.append(pairs.count())
        return confirmed(pairs, texts, how)

    monkeypatch.setattr(minhash, "confirmed", counted)
    got = minhash.components_of(spark.createDataFrame(rows, "doc_id long, text string"), minhash.Linking()).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == components(rows)
    assert sum(compared) < 4 * len(rows)


def test_texts_like_no_other_are_not_shuffled(spark, monkeypatch):
    """Few of them reach the join, whose result is exact whatever the size of the map."""
    docs = spark.range(5000).selectExpr("int(id * 7 - 100) AS doc_id", "concat('text ', id) AS text")
    docs = docs.union(spark.createDataFrame([(None, "no id"), (-100, "another text"), (-93, None)], "doc_id int, text string"))
    ids = spark.range(300).selectExpr("id * 70 - 100 AS doc_id").union(spark.createDataFrame([(-93,), (10**12,)], "doc_id long"))
    wanted = {r.doc_id for r in ids.collect()}
    exact = Counter((r.doc_id, r.text) for r in docs.collect() if r.doc_id in wanted)
    assert sum(exact.values()) == 303
    assert minhash.marked(docs, ids).count() < 303 + 0.12 * 4700
    assert Counter(minhash.texts_of(docs, ids).collect()) == exact
    monkeypatch.setattr(minhash, "MARKS", 64)
    assert Counter(minhash.texts_of(docs, ids).collect()) == exact
    assert minhash.texts_of(docs, ids.limit(0)).count() == 0
