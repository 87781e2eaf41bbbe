"""The stages of the corpus pipeline against plain recomputation."""

import random

import corpus_pipeline
from trendlens import session
from trendlens.llm import minhash


def shingle_set(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_near_duplicates_from_four_fifths_on(spark):
    draw = random.Random(4)
    texts = []
    for k in range(40):
        words = [f"w{draw.randrange(10**6)}" for _ in range(120)]
        copy = words.copy()
        # each word replaced changes up to five shingles
        for at in draw.sample(range(len(words)), 1 + k % 4):
            copy[at] = f"x{k}"
        texts += [" ".join(words), " ".join(copy)]
    rows = list(enumerate(texts))
    sets = [shingle_set(t) for t in texts]
    alike = [len(a & b) / len(a | b) for a, b in zip(sets[::2], sets[1::2], strict=True)]
    assert sum(0.8 <= x < 0.85 for x in alike) > 2 and sum(x < 0.8 for x in alike) > 2
    want = {i for i, _ in rows if i % 2 == 0 or alike[i // 2] < 0.8}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.without_near_duplicates(spark, docs, "").collect()} == want


def test_bands_of_the_stage_miss_few_pairs():
    how = corpus_pipeline.NEAR
    bands = len(minhash.bands(minhash.shingles("a b c d e f", how.shingle), how))
    assert (1 - (how.percent / 100) ** how.rows) ** bands < 1e-6


WORDS = "plain words that say nothing odd about any thing at all here and there".split()


def small_corpus(spark, folder, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], schema).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(t is not None and "#" not in t), int("idiot" in (t or ""))) for i, t in rows if i is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_run_on_odd_rows(spark, tmp_path, monkeypatch):
    """Repeated rows, rows that share an id and rows without id, by their own verdicts."""
    draw = random.Random(6)
    clean = [" ".join(draw.choice(WORDS) + f"{draw.randrange(50)}x" for _ in range(60)) for _ in range(120)]
    toxic = [f"you idiot {' '.join(draw.choice(WORDS) for _ in range(12))} idiot" for _ in range(40)]
    poor = ["# $ # % " * draw.randrange(5, 40) for _ in range(40)]
    rows = list(enumerate([*clean, *toxic, *poor]))
    rows += [(3, clean[3]), (3, clean[3])]  # equal rows
    rows += [(5, toxic[0] + " more"), (5, poor[0] + " more")]  # the id of a clean one
    rows += [(None, t) for t in (clean[7], "a text without id " + clean[8], toxic[1], poor[1], None, "")]
    small_corpus(spark, str(tmp_path), rows)

    def kept(text):
        return "idiot" not in (text or "") and "#" not in (text or "")

    after = {}

    def spied(name, stage):
        def run(*args):
            after[name] = stage(*args).cache()
            return after[name]

        return name, run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [spied(*s) for s in corpus_pipeline.STAGES])
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path / "shared"))
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # no other table is left
    assert [p.name.rpartition("-")[0] for p in (tmp_path / "shared").iterdir()] == ["packing"]
    texts = [r.text for r in after["quality"].collect()]
    assert all(kept(t) for t in texts)
    assert sum(t in clean for t in texts) == 120 + 2 + 1
    near = after["near_duplicates"]
    assert near.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    once = [r.text for r in near.collect()]
    assert sorted(t for t in once if t in clean) == sorted(clean)
    assert sum(r.doc_tokens for r in packed if r.start == 0) > 0 and len({(r.sequence_id, r.offset) for r in packed}) == len(packed)
    assert sum(r.start == 0 for r in packed) == len(once)


def test_run_on_empty_tables(spark, tmp_path):
    small_corpus(spark, str(tmp_path), [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
