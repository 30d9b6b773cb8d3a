"""Hard negatives and whitening against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import hard_negatives, qd, whitening

# --- residue numbers ---------------------------------------------------------------------------------------


@given(st.integers(1, 200), st.integers(0, 2**32), st.sampled_from([3, 300, 2**20, 2**40, 10**30]))
@settings(deadline=None, max_examples=60)
def test_products_are_exact(dim, seed, size):
    rng = random.Random(seed)
    left, right = (np.array([[float(rng.randint(-size, size)) for _ in range(dim)] for _ in range(n)]) for n in (3, 5))
    for at, got in hard_negatives.scores(left, right):
        for i, row in enumerate(got):
            for j, score in enumerate(row):
                exact = sum(int(a) * int(b) for a, b in zip(left[at + i], right[j], strict=True))
                assert score == max(min(exact, hard_negatives.LONG), -hard_negatives.LONG - 1)


def test_sums_stay_exact_in_float32():
    moduli = hard_negatives.primes(20)
    assert len(set(moduli)) == 20 and all(p % q for p in moduli for q in range(2, int(p**0.5) + 1))
    assert all(hard_negatives.INNER * (p // 2) ** 2 < 2**24 for p in moduli)
    p = moduli[0]
    most = np.full((1, 64), float(p // 2))
    assert hard_negatives.product(hard_negatives.centred(most, p), hard_negatives.centred(most, p), p)[0, 0] % p == 64 * (p // 2) ** 2 % p


@given(st.lists(st.integers(-5, 5), max_size=30), st.integers(1, 6))
def test_best_takes_ties_in_order(values, k):
    expected = sorted(range(len(values)), key=lambda i: (-values[i], i))[:k]
    assert hard_negatives.best(np.array(values, np.int64), k).tolist() == expected


# --- hard negatives ----------------------------------------------------------------------------------------


def mined(rows, anchors, scale=256):
    """Brute force over rows of (id, label, vector)."""
    good = {(i, y, tuple(v)) for i, y, v in rows if None not in (i, y, v) and all(x is not None and np.isfinite(x) for x in v)}
    good = sorted((i, y, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, y, v in good)
    out = set()
    for a, y, v in (r for r in good if anchors(r[0])):
        scored = [(-sum(p * q for p, q in zip(v, w, strict=True)), i, z == y) for i, z, w in good if i != a and len(w) == len(v)]
        for s, p, _ in sorted(x for x in scored if x[2])[:5]:
            far = sorted(x for x in scored if not x[2] and 80 * -s <= 100 * -x[0] <= 100 * -s)[:5]
            out |= {(a, p, rank, i, -s, -t) for rank, (t, i, _) in enumerate(far, 1)}
    return out


@pytest.mark.parametrize("size", [8192, 7])
def test_hard_negatives(spark, monkeypatch, size):
    monkeypatch.setattr(hard_negatives, "SHARD_ROWS", size)
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", size)
    monkeypatch.setattr(hard_negatives, "STEP_ANCHORS", 3)
    rng = random.Random(7)
    rows = [(i, rng.choice([0, 0, 0, 1, 2, 9]), [rng.choice([-0.5, 0.0, 0.25, 0.3, 1.0]) for _ in range(6)]) for i in range(150)]
    rows += [rows[3], rows[10], (200, None, [0.1] * 6), (201, 1, None), (202, 1, [0.1, None] + [0.0] * 4), (203, 2, [float("nan")] + [0.0] * 5)]
    rows += [(210, 3, [0.1] * 6), (220, 1, [0.5, 0.5]), (221, 1, [0.5, 0.4]), (222, 2, [0.45, 0.5]), (None, 1, [0.5] * 6), (230, 1, [])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    for name in ("part", "v", "dim", "caps", "asks", "score"):
        df = df.selectExpr("*", f"'x' AS {name}")
    from pyspark.sql import functions as F

    got = [tuple(r) for r in hard_negatives.mine(df.repartition(3), F.col("vec_id") % 10 == 0).collect()]
    assert len(got) == len(set(got)) and set(got) == mined(rows, lambda i: i % 10 == 0) and len(got) > 50
    assert hard_negatives.mine(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0


# --- whitening ---------------------------------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["random", "clusters", "equal", "graded", "rank", "zero", "integers"])
@pytest.mark.parametrize("n", [1, 2, 7, 40])
def test_singular_vectors(kind, n):
    rng = np.random.default_rng(n)
    u, w = (np.linalg.qr(rng.normal(size=(n, n)))[0] for _ in range(2))
    values = {
        "random": rng.random(n),
        "clusters": np.resize([5, 4.9999999, 1, 1e-3], n),
        "equal": 1 + 1e-13 * np.arange(n),
        "graded": 0.2 ** np.arange(n),
        "rank": np.where(np.arange(n) < 3, 1.0, 0.0),
        "zero": np.zeros(n),
        "integers": np.ones(n),
    }[kind]
    m = np.round(3 * rng.normal(size=(n, n))) if kind == "integers" else u @ np.diag(values) @ w.T
    squares, z = qd.right_vectors(m, 32)
    exact = np.linalg.svd(m, compute_uv=False) ** 2
    assert np.abs(squares - exact).max() <= 1e-12 * exact[0]
    k = z.shape[1]
    least, most = (min(32, int((np.sqrt(exact) > limit * np.sqrt(exact[0])).sum())) for limit in (1e-13, 1e-15))
    assert least <= k <= most or kind in ("rank", "zero")
    assert kind != "rank" or k == min(n, 3)
    assert np.abs(z.T @ z - np.eye(k)).max(initial=0) < 1e-10
    assert np.abs(m.T @ (m @ z) - z * squares[:k]).max(initial=0) <= 1e-11 * exact[0]


def whitened_brute(vectors):
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(object) + 1_000_000
    t = len(x) * x - x.sum(axis=0)
    c = (t / len(x)).astype(float)
    e, v = np.linalg.eigh(c.T @ c / len(x))
    e, v = e[::-1], v[:, ::-1]
    return [int(d) for d in (t * t).sum(axis=1)], c @ v / np.sqrt(e), e / e.sum()


@pytest.mark.parametrize("block", [2048, 3])
def test_whitening(spark, monkeypatch, block):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", block)
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(60, 9)) * np.arange(1, 10)).astype(np.float32).tolist()
    rows = [(i, v) for i, v in enumerate(vectors)] + [(7, vectors[7]), (None, vectors[8])]
    kept = [v for _, v in rows]
    rows += [(100, None), (101, [None] + [0.0] * 8), (102, [float("inf")] + [0.0] * 8), (103, [float("nan")] * 9), (104, [1.0]), (105, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS v", "2 AS whitened", "3 AS part").repartition(7)
    model = whitening.fit(df)
    deviations, white, shares = whitened_brute(kept)
    assert model.rows == len(kept) and np.abs(model.explained - shares).max() < 1e-12
    got = sorted((r.vec_id if r.vec_id is not None else 99, r.deviation, r.whitened) for r in whitening.whiten(df, model).collect())
    expected = sorted(zip([i if i is not None else 99 for i, _ in rows[: len(kept)]], deviations, white.tolist(), strict=True))
    assert [x[:2] for x in got] == [x[:2] for x in expected]
    assert np.abs(np.abs([x[2] for x in got]) - np.abs([x[2] for x in expected])).max() < 1e-9
    signs = np.sign(np.array([x[2] for x in got])) * np.sign(np.array([x[2] for x in expected]))
    assert (signs == signs[0]).all() and whitening.identity_error(df, model) < 1e-12


def test_whitening_of_few_equal_and_huge(spark):
    def fitted(rows):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        model = whitening.fit(df)
        return model, (whitening.whiten(df, model).collect() if model else [])

    assert fitted([(1, None)])[0] is None and whitening.fit(spark.createDataFrame([], "vec_id long, embedding array<float>")) is None
    for rows in ([(1, [0.5, 1.0])], [(1, [0.5, 1.0])] * 4):
        model, out = fitted(rows)
        assert len(model.variances) == 0 and all(r.deviation == 0 and r.whitened == [] for r in out)
    # one dimension that doesn't vary, one that copies another
    model, out = fitted([(i, [0.25 * (i % 5), 3.0, 0.25 * (i % 5)]) for i in range(10)])
    assert len(model.variances) == 1 and abs(sum(r.whitened[0] ** 2 for r in out) / 10 - 1) < 1e-12
    model, out = fitted([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 0.0])])
    assert model.sums[0] == 1_000_000 - 1 and all(0 < r.deviation <= whitening.LONG for r in out)


def test_whitening_query(spark):
    sf = "/root/testdata/sf0.01"
    out = whitening.op11_whitening(spark, sf).toPandas()
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").toPandas()
    deviations, white, shares = whitened_brute(vectors["embedding"].tolist())
    assert len(out) == 32 * len(vectors) and (out["n"] == len(vectors)).all() and (out["identity_error"] < 1e-10).all()
    wide = out.pivot(index="vec_id", columns="component", values="whitened")
    assert np.abs(np.abs(wide.to_numpy()) - np.abs(white[:, :32])).max() < 1e-8
    assert out.groupby("vec_id")["deviation"].first().tolist() == deviations
    assert np.abs(out.groupby("component")["explained"].first().to_numpy() / shares[:32] - 1).max() < 1e-10
