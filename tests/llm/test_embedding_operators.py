"""Hard negatives and whitening against brute force and a dense eigensolver."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from tenderlens.llm import hard_negatives, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, label int"
CLASH = ("id", "key", "g", "kind", "x", "y", "tops", "top", "rank", "at", "score", "n", "deviation", "whitened")


def crowded(df):
    for c in CLASH:
        df = df.withColumn(c, F.lit("clash"))
    return df


def usable(rows):
    return [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]


# hard negatives

def brute_negatives(rows, step=100):
    seen = {(i, (k + 1) % 10 if i % 7 == 0 else k, tuple(math.floor(256 * float(np.float32(c))) for c in v))
            for i, v, k in usable(rows) if i is not None and k is not None}
    seen = sorted(seen)
    score = lambda a, b: sum(p * q for p, q in zip(a, b))
    out = []
    for a in seen:
        if a[0] % step:
            continue
        scored = sorted((-score(a[2], r[2]), r[0], r[1]) for r in seen if r is not a)
        for p, pid, label in [s for s in scored if s[2] == a[1]][:5]:
            near = [s for s in scored if s[2] != a[1] and 80 * -p <= 100 * -s[0] <= 100 * -p][:5]
            out += [(a[0], pid, i, s[1], -p, -s[0]) for i, s in enumerate(near, 1)]
    return sorted(out)


@given(st.integers(1, 8), st.integers(1, 60), st.sampled_from([1, 100, 10**4, 10**7, 10**11]), st.data())
@settings(max_examples=120, deadline=None)
def test_packed_scores_are_exact(d, n, size, data):
    rng = np.random.default_rng(data.draw(st.integers(0, 10**6)))
    rows = rng.integers(-size, size + 1, (n, d))
    rows = -np.abs(rows) if data.draw(st.booleans()) else rows
    anchors = rng.integers(-min(size, 10**4), min(size, 10**4) + 1, (3, d))
    lo = data.draw(st.integers(0, n))
    hi = data.draw(st.integers(lo, n))
    got = hard_negatives.PackedRows(rows).scores(anchors, lo, hi)
    want = [[sum(int(p) * int(q) for p, q in zip(a, x)) for x in rows[lo:hi]] for a in anchors]
    assert got.tolist() == want


def rows_of(n, d, seed=3, labels=4):
    rng = np.random.default_rng(seed)
    return [(i, (rng.integers(-3, 4, d) / 4).tolist(), int(rng.integers(0, labels))) for i in range(n)]


@pytest.mark.parametrize("size", [1, 10**6])
def test_negatives_are_brute_force(spark, size):
    """Few different scores, so that ties are common; large components take the wide integers."""
    rows = [(i, [c * size for c in v], k) for i, v, k in rows_of(450, 3)]
    rows += rows[:5] + [(100, [0.5 * size, 0.25, 0.0], 1), (200, [0.5 * size], 1), (201, [], 1), (-100, [0.5, 0.5, 0.5], 2)]
    rows += [(None, [0.5] * 3, 1), (300, None, 1), (700, [0.5, None, 0.1], 1), (800, [0.5, float("nan"), 0.1], 1),
             (900, [float("inf"), 0.0, 0.0], 1), (901, [0.5] * 3, None)]
    df = crowded(spark.createDataFrame(rows, SCHEMA))
    got = sorted(tuple(r) for r in hard_negatives.hard_negatives(df).collect())
    assert got == brute_negatives(rows) and len(got) > 50
    assert hard_negatives.hard_negatives(df.limit(0)).collect() == []
    few = hard_negatives.integer_rows(df, "vec_id", "embedding", "label", F.lit(1))
    assert few.count() and hard_negatives.mine(few).collect() == []  # one label: positives, no negatives


def test_negatives_query(spark):
    p = pd.read_parquet(f"{SF}/embeddings.parquet")
    got = E.queries()["op11_hard_negatives"](spark, SF)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    rows = [(int(i), v.tolist(), int(k)) for i, v, k in zip(p.vec_id, p.embedding, p.label)]
    assert sorted(tuple(r) for r in got.collect()) == brute_negatives(rows)


# whitening

@pytest.mark.parametrize("d,k,spectrum", [(64, 32, "noise"), (1, 32, "noise"), (33, 32, "decay"), (200, 8, "decay"),
                                          (150, 12, "noise"), (64, 32, "ties")])
def test_leading_pairs(d, k, spectrum):
    rng = np.random.default_rng(d)
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    a = {"decay": np.logspace(0, -9, d), "ties": np.repeat([5.0, 1.0], [d // 2, d - d // 2]),
         "noise": rng.random(d) + 1}[spectrum]
    a = (q * a) @ q.T
    values, vectors, residual = whitening.leading_pairs(lambda b: a @ b, d, k)
    want = np.linalg.eigvalsh(a)[::-1][: min(k, d)]
    assert np.abs(values - want).max() <= 1e-14 * want[0] * max(1, d**0.5)
    assert np.linalg.norm(a @ vectors - vectors * values, axis=0).max() <= 1e-12 * want[0] and residual <= 1e-12 * want[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12


def test_minres_solves_columns_apart():
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.standard_normal((12, 12)))[0]
    a = (q * np.linspace(-3, 9, 12)) @ q.T
    b = rng.standard_normal((12, 4))
    b[:, 2] = 0
    assert np.allclose(whitening.minres(lambda t: a @ t, b, 40, 1e-13), np.linalg.solve(a, b), atol=1e-9)


def check_whitening(got, rows, components=32):
    kept = usable(rows)
    d = max(len(v) for _, v, _ in kept)
    x = np.array([[math.floor(64 * float(np.float32(c))) + 10**6 for c in v] + [10**6] * (d - len(v)) for _, v, _ in kept],
                 dtype=object)
    n, s = len(x), x.sum(axis=0)
    centred = ((x * n - s) / n).astype(float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = int((values > d * 2.3e-16 * values[0]).sum()) if d and values[0] > 0 else 0
    k = min(k, components)
    assert len(got) == n * k
    if not k:
        return
    assert set(got.n) == {n} and got.identity_error.nunique() == 1 and got.identity_error.iloc[0] <= 1e-4  # what the contract allows
    assert np.allclose(got.groupby("component").explained.first(), values[:k] / values.sum(), rtol=1e-4)
    if any(i is None for i, _, _ in kept) or len({i for i, _, _ in kept}) < n:
        return
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[[i for i, _, _ in kept]].to_numpy()
    mine = centred @ vectors[:, :k] / np.sqrt(values[:k])
    apart = np.min(np.abs(values[:k, None] - values[None]) + np.eye(k, len(values)) * 1e9, axis=1) > 1e-6 * values[0]
    signs = np.sign((wide * mine).sum(axis=0))
    assert np.abs(wide * signs - mine)[:, apart].max() < 1e-7
    exact = ((x * n - s) ** 2).sum(axis=1)
    assert got.groupby("vec_id").deviation.first().loc[[i for i, _, _ in kept]].tolist() == exact.tolist()


def test_whitening_is_dense_result(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.standard_normal(40) * np.linspace(1, 0.2, 40)).astype(np.float32).tolist(), 0) for i in range(300)]
    rows += [(300, None, 1), (301, [0.5, None], 1), (302, [float("nan")] * 40, 1), (303, [float("-inf")] * 40, 1)]
    df = crowded(spark.createDataFrame(rows, SCHEMA))
    got = whitening.whiten_embeddings(df).toPandas()
    check_whitening(got, rows)
    assert got.identity_error.iloc[0] < 1e-12
    assert got.dtypes.astype(str).loc[["n", "deviation", "whitened", "component"]].tolist() == ["int64", "int64", "float64", "int32"]


def test_whitening_edges(spark):
    odd = rows_of(40, 6) + rows_of(10, 6) + [(None, [0.5] * 6, 1), (None, [0.25] * 3, 1), (7, [], 2), (50, [3e5] * 6, 0)]
    long = [(i, [*v, 3e5 if i == 9 else 0.0], k) for i, v, k in rows_of(40, 6)]  # deviations beyond the fast path
    for rows in (odd, long, rows_of(1, 4), [(1, [0.5, 0.5], 0)] * 5, [(1, [], 0)], [(1, [0.1], 0), (2, [0.9], 0)]):
        check_whitening(whitening.whiten_embeddings(crowded(spark.createDataFrame(rows, SCHEMA))).toPandas(), rows)
    empty = spark.createDataFrame([(1, None, 0)], SCHEMA)
    out = whitening.whiten_embeddings(empty)
    assert out.collect() == [] and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_whitening_query(spark):
    p = pd.read_parquet(f"{SF}/embeddings.parquet")
    rows = [(int(i), v.tolist(), 0) for i, v in zip(p.vec_id, p.embedding)]
    check_whitening(E.queries()["op12_whitening"](spark, SF).toPandas(), rows)
