"""The one-bit search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspan.llm import onebit


def brute(rows, k, asks):
    good = sorted({(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)})
    out = []
    for i, v in good:
        if asks(i):
            s = sorted((-float(np.dot(np.array(v), np.array(w))), j) for j, w in good if j != i and len(w) == len(v))[:k]
            out += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s)]
    return out


def check(got, want, least=1.0):
    assert len(got) == len(want)
    pairs = {(q, j): s for q, _, j, s in want}
    hits = [(r.query_id, r.vec_id) in pairs for r in got]
    assert np.mean(hits) >= least
    for r in got:
        if (r.query_id, r.vec_id) in pairs:
            assert r.score == pytest.approx(pairs[r.query_id, r.vec_id], rel=1e-12)


def test_bounds_hold():
    rng = np.random.default_rng(1)
    v, q = rng.standard_normal((800, 64)) + 0.3, rng.standard_normal((50, 64))
    c = v.mean(axis=0)
    bits, far, own = onebit.encode(v, c)
    guess, bound = onebit.estimate(q, bits, far, own, c)
    assert bits.shape == (800, 8)
    assert np.mean(np.abs(guess - q @ v.T) <= bound) > 0.995
    assert np.mean(guess + bound < np.quantile(q @ v.T, 0.98)) > 0.2  # and they pass over many vectors


@pytest.mark.parametrize("block,parts", [(64, 3), (2048, 8)])
def test_equals_brute_force(spark, monkeypatch, block, parts):
    monkeypatch.setattr(onebit, "BLOCK", block)
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((6, 16))
    v = (centres[rng.integers(0, 6, 700)] + 0.5 * rng.standard_normal((700, 16))).round(3)
    rows = [(int(i) * 5, x.tolist()) for i, x in enumerate(v)]
    rows += [(10_000 + 10 * i, [1.0] * 16) for i in range(120)]  # copies
    rows += [(7, None), (20, [0.0] * 16), (40, [float("nan")] + [1.0] * 15), (60, [None] + [1.0] * 15), (80, [float("inf")] * 16), (3, [1.0, 2.0, 3.0]), (100_000, [2.0, 1.0, 0.0]), (None, [1.0] * 16), rows[4], rows[4]]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<double>, score string")
    got = onebit.search(df, F.col("vec_id") % 20 == 0, k=10, parts=parts).collect()
    want = brute(rows, 10, lambda i: i % 20 == 0)
    check(got, want)
    at = {(q, r): j for q, r, j, _ in want}
    assert np.mean([at[r.query_id, r.rank] == r.vec_id for r in got]) > 0.99


def test_small_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5])], "vec_id bigint, embedding array<float>")
    got = [tuple(r) for r in onebit.search(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 0.5), (0, 2, 2, 0.5)]
    assert onebit.search(df.limit(0), F.col("vec_id") == 0).count() == 0
