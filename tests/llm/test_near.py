"""SimHash groups, top-k search and components against brute force."""

import random

import duckdb
import numpy as np
import pytest
import xxhash

from tests.llm.helpers import frame, texts, words
from tidemark.llm import ball_tree, components, simhash


def fingerprint(text: str | None) -> int:
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(rows):
    prints = {doc: fingerprint(text) for doc, text in rows}
    root = {doc: doc for doc in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    docs = sorted(prints)
    for i, a in enumerate(docs):
        for b in docs[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted((d, f"{prints[d]:016x}", find(d)) for d in docs)


@pytest.mark.parametrize("hot", [2048, 2])
def test_simhash(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT", hot)
    rows = [(d, t) for d, t in texts(8, 150)]
    out = simhash.simhash_components(frame(spark, rows)).selectExpr("doc_id", "lower(hex(fp)) AS f", "component_id")
    assert sorted(map(tuple, out.collect())) == grouped(rows)


def test_nulls_and_repeats(spark):
    df = spark.createDataFrame([(None, "a b c d"), (4, "a b c d"), (4, "a b c d"), (9, None), (2, ""), (None, "q r s t u v w")], "doc_id long, text string")
    out = {(r.doc_id, r.component_id) for r in simhash.simhash_components(df).collect()}
    assert out == {(None, 4), (4, 4), (9, 2), (2, 2), (None, None)}
    kept = simhash.one_of_each(df).collect()
    assert sorted((r.doc_id or -1, r.text) for r in kept) == [(-1, "q r s t u v w"), (2, ""), (4, "a b c d")]
    assert simhash.simhash_components(df.limit(0)).count() == 0


@pytest.mark.parametrize("hot", [2048, 2])
def test_one_of_each_group_stays(spark, monkeypatch, hot):
    """Every linked group keeps its smallest id, whatever else happens; texts without links stay."""
    monkeypatch.setattr(simhash, "HOT", hot)
    rng = random.Random(4)
    rows = texts(12, 80)
    base = " ".join(f"w{rng.randrange(5000)}" for _ in range(900))
    rows += [(1000 + i, base + " tail" * (i % 3)) for i in range(60)]
    df = frame(spark, rows)
    kept = sorted(r.doc_id for r in simhash.one_of_each(df).collect())
    roots = {root for _, _, root in grouped(rows)}
    assert kept == sorted(roots) and len(kept) < len(rows) - 50
    assert simhash.one_of_each(df).columns == df.columns
    assert simhash.one_of_each(df.limit(0)).count() == 0


def test_groups_of_one_id_and_of_null_ids(spark):
    """Unrelated texts under one id are two groups; near copies with null ids only are one."""
    one, two, three = (" ".join(f"{c}{i}" for i in range(60)) for c in "abc")
    rows = [(1, one), (1, two), (7, two.upper()), (None, three), (None, three.upper()), (2, "plumless " + one), (2, "buckeroo " + one)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r.doc_id or 0, r.text.split()[0]) for r in simhash.one_of_each(df).collect())
    # digests decide which of the equal fingerprints with null ids stays; the two texts with equal CRCs are two documents
    assert [(d, w.lower()) for d, w in kept if d != 2] == [(0, "c0"), (1, "a0"), (1, "b0")]
    assert len([d for d, _ in kept if d == 2]) == len({fingerprint(t) for d, t in rows if d == 2})


def test_crowded_keys_compare_all_pairs(spark, monkeypatch):
    """One key of 3 000 fingerprints, most of them close to others than the first ones only."""
    monkeypatch.setattr(simhash, "HOT", 500)
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2, 128).astype(bool)
    base[:8] = False
    flips = rng.random((3000, 128)) < 0.16
    flips[:, :8] = False
    prints = np.unique(np.packbits(base ^ flips, axis=1), axis=0)
    wide = prints.view(">u8").astype(np.uint64)
    near = [np.flatnonzero(np.bitwise_count(wide ^ w).sum(axis=1) <= 20) for w in wide]
    a, b = np.repeat(np.arange(len(near)), [len(n) for n in near]), np.concatenate(near)
    expected = simhash._roots(a, b, len(prints))
    # one block of 8 bits that all share, under one key
    crowd = spark.createDataFrame([(1, bytearray(p.tobytes()), len(prints)) for p in prints], "key long, fp binary, count long")
    found = simhash._met(simhash._in_parts(crowd), 128, 20).collect()
    number = {p.tobytes(): i for i, p in enumerate(prints)}
    pairs = [(number[bytes(r.a)], number[bytes(r.b)]) for r in found]
    got = simhash._roots(np.array([x for x, _ in pairs]), np.array([y for _, y in pairs]), len(prints))
    assert (got == expected).all() and 1 < len(set(got.tolist())) < len(prints)


def test_components(spark):
    rng = random.Random(9)
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000 + 2 * i, 5001 + 2 * i) for i in range(50)]
    rng.shuffle(links)
    df = spark.createDataFrame([(b, a) if rng.random() < 0.5 else (a, b) for a, b in links], "a long, b long")
    out = dict(map(tuple, components.components(df).collect()))
    assert out == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 300)} | {5001 + 2 * i: 5000 + 2 * i for i in range(50)}
    assert components.components(df.limit(0)).count() == 0


def vectors(n: int, dim: int, seed: int):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(0, 0.3, dim).astype(np.float32).tolist()) for i in range(n)]
    rows[5] = (5, None)
    rows[6] = (6, [None, *rows[6][1][1:]])
    rows[7] = (7, [float("nan"), *rows[7][1][1:]])
    rows[8] = (8, [float("inf"), *rows[8][1][1:]])
    for i in range(20, 60):  # ties
        rows[i] = (i, rows[20][1])
    return rows


@pytest.mark.parametrize("size", [10_000, 70])
def test_top_k(spark, monkeypatch, size):
    monkeypatch.setattr(ball_tree, "SHARD_ROWS", size)
    monkeypatch.setattr(ball_tree, "LEAF", 16)
    rows = vectors(600, 9, 1)
    df = spark.createDataFrame([*rows, rows[20], (None, rows[1][1])], "vec_id long, embedding array<float>")
    out = ball_tree.top_k(df, df.vec_id % 100 == 0).collect()
    valid = {i: np.floor(1024 * np.array(v, np.float32).astype(float)) for i, v in rows if i not in (5, 6, 7, 8)}
    expected = []
    for q in range(0, 600, 100):
        scored = sorted((-int(valid[q] @ v), i) for i, v in valid.items() if i != q)[:10]
        expected += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    assert sorted(map(tuple, out)) == expected


def test_top_k_of_few_huge_and_mixed(spark):
    df = spark.createDataFrame([(0, [1e12, 1.0]), (1, [1e12, 2.0]), (2, [-1e12, 0.0]), (100, [1.0]), (3, [])], "vec_id long, embedding array<double>")
    out = ball_tree.top_k(df, df.vec_id % 100 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in out) == [(0, 1, 1), (0, 2, 2)]
    assert out[0].score in ((1 << 63) - 1, -(1 << 63))
    assert ball_tree.top_k(df.limit(0), df.vec_id % 100 == 0).count() == 0


def test_top_k_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    assert sorted(map(tuple, ball_tree.op5_top_k(spark, sf).collect())) == sorted(con.sql(ball_tree.OP5_SQL).fetchall())
