"""Fill-in-middle over compressed frames against plain slicing."""

import hashlib

import pytest

from trendlens.llm import infill

SCHEMA = "doc_id long, text string, n long, form string, frames binary"
WIDE = "aé𝄞漢 \n"
TEXTS = ["", None, "x", "ab", "é𝄞", "has <P> inside", "<S>", "<M", "<P" * 9, WIDE * 50, WIDE * 40_000, "plain words " * 30_000]
SMALL_FRAMES = infill.Framing(units=7)


def expected(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (doc_id, n, "plain", None, None, text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if h4 % 100 < 20:
        return (doc_id, n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}")
    return (doc_id, n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}")


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    many = [(100 * k + i, t) for k in range(6) for i, t in enumerate(TEXTS)]
    return [*many, (None, "no id"), (None, "no id"), (3, "ab"), (3, "another text of the id")]


@pytest.mark.parametrize("how", [infill.Framing(units=1000), infill.Framing()])
def test_digests_equal_plain_slicing(spark, rows, how):
    docs = spark.createDataFrame([(i, t, 0, "x", b"") for i, t in rows], SCHEMA).repartition(3)
    got = infill.digests(infill.filled(infill.framed(docs, how), how)).collect()
    want = [(*e[:5], sha(e[5]), sha(t)) for (i, t), e in ((r, expected(*r)) for r in rows)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert {"plain", "psm", "spm"} == {r.form for r in got}


def test_texts_are_the_outputs(spark, rows):
    docs = spark.createDataFrame([(i, t) for i, t in rows[:9]], "doc_id long, text string")
    got = infill.texts(infill.filled(infill.framed(docs))).collect()
    assert sorted((r.doc_id, r.form, r.output) for r in got) == sorted((e[0], e[2], e[5]) for e in (expected(*r) for r in rows[:9]))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert infill.digests(infill.filled(infill.framed(docs))).count() == 0


@pytest.mark.parametrize("text", [WIDE * 5, "a", "ab<Q>" * 4, "<P" + "é" * 20 + "S>"])
def test_every_cut_is_restored(text):
    source = infill.frames_of(text, SMALL_FRAMES)
    assert "".join(source.read(0, len(source))) == text and len(source) == len(text)
    for form in ("psm", "spm"):
        for a in range(len(text) + 1):
            for b in range(a, len(text) + 1):
                output = infill.fill(source, form, a, b, SMALL_FRAMES)
                assert "".join(infill.restore(output, form)) == text


def test_only_cut_frames_are_decompressed(monkeypatch):
    text = WIDE * 500
    how = infill.Framing(units=100)
    source = infill.frames_of(text, how)
    opened = []
    whole = infill.Frames.text
    monkeypatch.setattr(infill.Frames, "text", lambda self, k: (opened.append(k), whole(self, k))[1])
    output = infill.fill(source, "psm", 1234, 2345, how)
    assert sorted(set(opened)) == [12, 23]
    monkeypatch.undo()
    assert "".join(output.read(0, len(output))) == f"<P>{text[:1234]}<S>{text[2345:]}<M>{text[1234:2345]}"
