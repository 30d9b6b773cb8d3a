"""Long repeats of words and bytes against brute force."""

from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import frame, sha, texts, words
from tidemark.llm import debruijn, rolling, suffix_dedup


def repeated_words(rows, window):
    count = Counter(tuple(w[i : i + window]) for w in (words(t) for _, t in rows) for i in range(len(w) - window + 1))
    out = []
    for doc, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((doc, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return sorted(out)


def earlier_bytes(rows, size):
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: r[0]):
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - size + 1):
            if b[i : i + size] in seen:
                gone[i : i + size] = True
            seen.add(b[i : i + size])
        runs = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(b) else 0
        out.append((doc, len(b), int(gone.sum()), runs, sha(np.frombuffer(b, np.uint8)[~gone].tobytes())))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_debruijn(spark, seed):
    rows = texts(seed)
    out = debruijn.repeated_words(frame(spark, rows)).select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    assert sorted(map(tuple, out.collect())) == repeated_words(rows, 35)


@pytest.mark.parametrize("window", [1, 4])
def test_debruijn_short_windows(spark, window):
    rows = texts(3, 40)[:40]
    out = debruijn.repeated_words(frame(spark, rows), window).select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    assert sorted(map(tuple, out.collect())) == repeated_words(rows, window)


@pytest.mark.parametrize("seed", [1, 2])
def test_suffixes(spark, seed):
    rows = texts(seed)
    out = suffix_dedup.suffix_dedup(frame(spark, rows)).select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert sorted(map(tuple, out.collect())) == earlier_bytes(rows, 100)


def test_suffixes_short(spark):
    rows = texts(5, 60)[:60]
    out = suffix_dedup.suffix_dedup(frame(spark, rows), 7).select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert sorted(map(tuple, out.collect())) == earlier_bytes(rows, 7)


def test_small_blocks(spark, monkeypatch):
    """Texts cut into many blocks, as very long ones are."""
    whole = rolling.pieces(np.array([0, 5000, 5100]), 100, 10**6)
    cut = rolling.pieces(np.array([0, 5000, 5100]), 100, 300)
    starts = lambda blocks: sorted(s + i for b in blocks for _, _, s, e in b for i in range(e - s - 99))
    assert starts(whole) == starts(cut) == list(range(4901)) + [5000]


def test_identical_rows_are_one_document(spark):
    text = " ".join(f"t{i}" for i in range(60))
    df = spark.createDataFrame([(7, text), (7, text), (None, "n" * 150)], "doc_id long, text string")
    a = debruijn.repeated_words(df).collect()
    b = suffix_dedup.suffix_dedup(df).where("row.doc_id = 7").collect()
    assert [r.n_removed for r in a] == [0, 0, 0] and [r.n_removed for r in b] == [0, 0]
    again = df.unionAll(spark.createDataFrame([(9, text)], "doc_id long, text string"))
    assert {(r.row.doc_id, r.n_removed) for r in debruijn.repeated_words(again).collect()} == {(7, 60), (9, 60), (None, 0)}
    late = suffix_dedup.suffix_dedup(again).collect()
    assert {(r.row.doc_id, r.n_removed) for r in late} == {(7, 0), (9, len(text)), (None, 149)}


def test_equal_ids_and_equal_checksums_are_two_documents(spark):
    """Two texts under one id, or under none, whose CRCs agree."""
    passage = " ".join(f"t{i}" for i in range(60))
    for doc in (None, 4):
        df = spark.createDataFrame([(doc, f"plumless {passage}"), (doc, f"buckeroo {passage}")], "doc_id long, text string")
        assert [r.n_removed for r in debruijn.repeated_words(df).collect()] == [60, 60]
        assert sorted(r.n_removed for r in suffix_dedup.suffix_dedup(df).collect()) == [0, len(passage) + 1]


@pytest.mark.parametrize("letters", [1024, 2048])
def test_long_words_that_polynomials_cannot_tell_apart(spark, letters):
    """A sequence of two letters and its complement."""
    bits = [i.bit_count() & 1 for i in range(letters)]
    one, two = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    same = " ".join(f"t{i}" for i in range(34))
    df = spark.createDataFrame([(1, f"{same} {one}"), (2, f"{same} {two}")], "doc_id long, text string")
    assert [r.n_removed for r in debruijn.repeated_words(df).collect()] == [0, 0]
    again = df.unionAll(df.selectExpr("doc_id + 2", "text"))
    assert [r.n_removed for r in debruijn.repeated_words(again).collect()] == [35] * 4


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert debruijn.repeated_words(df).count() == 0
    assert suffix_dedup.suffix_dedup(df).count() == 0
    assert suffix_dedup.without_repeats(df).columns == ["doc_id", "text"]


def test_texts_that_stay(spark):
    rows = texts(2)
    df = frame(spark, rows).withColumn("n_chars", F.length("text").cast("long"))
    out = suffix_dedup.without_repeats(df)
    assert out.columns == df.columns
    kept = {r.doc_id: r.text for r in out.collect()}
    expected = {d: n for d, _, n, _, _ in earlier_bytes(rows, 100)}
    for doc, text in rows:
        if not expected[doc]:
            assert kept[doc] == text
        else:
            assert len(kept[doc]) < len(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=0, max_size=80), st.integers(1, 9), st.integers(1, 9))
def test_spans_cover_every_window_once(values, k, extra):
    length = k + extra - 1
    units = np.array(values, np.uint64) * np.uint64(2654435761)
    found = rolling.spans(units, np.array([0, len(units)]), length, k)
    starts = [lo + i for lo, n in zip(found["lo"], found["n"]) for i in range(n)]
    assert starts == list(range(max(len(values) - length + 1, 0)))
    anchor = {}
    for lo, n, a in zip(found["lo"], found["n"], found["anchor"]):
        inside = [tuple(values[lo + i : lo + i + length]) for i in range(n)]
        assert len(set(inside)) == len(inside), "equal windows never share a span"
        for w in inside:
            assert anchor.setdefault(w, a) == a, "equal windows have equal anchors"
