"""Packing and the token store against the tokenizer itself."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.helpers import frame, texts
from tidemark.llm import packing, token_store
from tidemark.llm.shared import folder
from tidemark.llm.tokens import Encoder

FILES = {"word_bpe_49k.json": True, "byte_bpe_50k.json": False}
ALPHABET = list("abcXYZ019.,!?'’éßñ \n\t\r\x1c\x85\xa0　 ́日😀") + ["  ", "\n\n", "'s", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endof", "Σ", "İ", "H̱", ". A"]


def plain(name: str, texts_: list, end: int) -> list[list[int]]:
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))  # as the library has it, special tokens included
    return [e.ids + [end] for e in tokenizer.encode_batch([t or "" for t in texts_], add_special_tokens=False)]


@pytest.mark.parametrize("name", FILES)
def test_pieces_give_the_ids_of_whole_texts(name):
    rng = random.Random(5)
    odd = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(4000)] + [None, "", " "]
    encoder = Encoder(public_tokenizers.path(name), FILES[name])
    for part in (odd[:2000], odd[2000:]):
        ids, at = encoder.encode(pa.array(["before", *part]).slice(1), 7)
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == plain(name, part, 7)


@pytest.mark.parametrize("name", FILES)
@pytest.mark.parametrize("letters", [512, 1024, 4096])
def test_equal_hashes_are_not_equal_pieces(name, letters):
    """A sequence of two letters and its complement, which polynomials modulo a power of two can't tell apart."""
    bits = [i.bit_count() & 1 for i in range(letters)]
    one, two = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    rows = [f"x {one} {two}", two, one, f"{two} y {one}", "x y"]
    encoder = Encoder(public_tokenizers.path(name), FILES[name])
    for part in (rows, rows[::-1], [two], [one]):
        ids, at = encoder.encode(pa.array(part), 7)
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == plain(name, part, 7)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60), st.integers(4, 40), st.integers(0, 3))
def test_plan_places_every_id_once(sizes, capacity, slack):
    sequences = packing.plan(np.array(sizes, np.int64), capacity, slack)
    seen = sorted((d, i) for pieces in sequences for d, s, n in pieces for i in range(s, s + n))
    assert seen == [(d, i) for d, n in enumerate(sizes) for i in range(n)]
    for pieces in sequences:
        total = sum(n for _, _, n in pieces)
        assert total <= capacity and (total & (total - 1) == 0 or capacity - total <= slack)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=50))
def test_best_fit_is_the_textbook_one(lengths):
    bins, free = packing.best_fit(np.array(lengths, np.int64), 20)
    rooms: list[int] = []
    for need in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= need]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - need)
        else:
            rooms.append(20 - need)
    assert sorted(free) == sorted(rooms)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))


def test_packing(spark):
    rows = [*texts(4), (3, "repeated id"), (3, "repeated id"), (None, "no id")]
    path = public_tokenizers.path("word_bpe_49k.json")
    out = packing.pack(frame(spark, rows, 3), path).toPandas()
    expected = sorted(plain("word_bpe_49k.json", [t for _, t in rows], 1))
    full = out.sort_values(["sequence_id", "offset"])
    for _, pieces in full.groupby("sequence_id"):
        assert (pieces.length.cumsum() - pieces.length).tolist() == pieces.offset.tolist() and pieces.length.sum() <= 2048
    assert (full.ids.map(lambda x: zlib.crc32(np.array(x, "<u4").tobytes())) == full.ids_crc32).all()
    unique = out[~out.doc_id.isin([3]) & out.doc_id.notna()]
    by_doc = {d: sum(p.sort_values("start").ids.map(list).tolist(), []) for d, p in unique.groupby("doc_id")}
    for (doc, _), ids in zip(rows[:-3], plain("word_bpe_49k.json", [t for _, t in rows[:-3]], 1)):
        assert doc == 3 or by_doc[doc] == ids
    assert out.length.sum() == sum(map(len, expected))
    lengths = full.groupby("sequence_id").length.sum()
    assert sum(0 if n & (n - 1) == 0 else 2048 - n for n in lengths) <= packing.SLACK * len(lengths)


def test_token_store(spark):
    rows = [*texts(6), (3, "repeated id"), (None, "no id")]
    path = folder(spark)
    token_store.write_tokens(frame(spark, rows), path, public_tokenizers.path("byte_bpe_50k.json"))
    out = token_store.read_tokens(spark, path).withColumn("crc", F.arrow_udf(token_store.ids_crc32, "long")("ids")).collect()
    out.sort(key=lambda r: r.start)
    assert [r.doc_id for r in out] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d))
    at = 0
    ids = dict(zip([(d, t) for d, t in rows], plain("byte_bpe_50k.json", [t for _, t in rows], 0)))
    left = {}
    for (doc, _), own in ids.items():
        left.setdefault(doc, []).append(own)
    for r in out:
        assert r.start == at and r.ids in left[r.doc_id] and r.crc == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        left[r.doc_id].remove(r.ids)
        at += r.n_tokens


def test_store_has_blooms_and_pruning(spark):
    path = folder(spark)
    rows = [(i, f"text {i}") for i in range(3000)]
    token_store.write_tokens(frame(spark, rows), path, public_tokenizers.path("byte_bpe_50k.json"))
    stored = spark.read.schema(token_store.STORED).orc(path)
    plan = stored.where("doc_id = 77").select("n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,77)]" in plan and "ids" not in plan.split("ReadSchema")[1]
    raw = b"".join(r.content for r in spark.read.format("binaryFile").load(path).select("content").collect())
    assert raw.count(b"ORC") >= 1


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(df, public_tokenizers.path("word_bpe_49k.json")).count() == 0
    path = folder(spark)
    token_store.write_tokens(df, path, public_tokenizers.path("byte_bpe_50k.json"))
    assert token_store.read_tokens(spark, path).count() == 0
