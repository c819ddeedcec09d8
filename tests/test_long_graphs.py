"""Long rows and hubs: rounds grow with the logarithm of a row's length."""

import random

import pytest
from pyspark.sql import functions as F

from larkspan.operators import graphs


@pytest.fixture
def rounds(monkeypatch):
    calls = []
    monkeypatch.setattr(graphs, "cut", lambda df, f=graphs.cut: calls.append(1) or f(df))
    return calls


def row(spark, n):
    return spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))


def test_a_row_of_ten_thousand_hops(spark, rounds):
    seeds = spark.createDataFrame([(7,)], "node long")
    assert graphs.reachable(row(spark, 10_000), seeds).count() == 10_001 - 7
    assert len(rounds) < 3 * 20  # three written tables a round
    rounds.clear()
    assert graphs.peel(row(spark, 10_000)) == (10_001, 0)
    assert len(rounds) < 20


def test_rings_and_what_hangs_below_them(spark):
    ring = [(i, (i + 1) % 50) for i in range(50)]
    assert graphs.peel(spark.createDataFrame(ring, "a long, b long")) == (0, 50)
    below = ring + [(3, 100), (100, 101), (101, 102), (200, 3), (300, 301)]
    assert graphs.peel(spark.createDataFrame(below, "a long, b long")) == (3, 53)


def plain(edges, seeds):
    seen, todo = set(seeds), list(seeds)
    while todo:
        x = todo.pop()
        for a, b in edges:
            if a == x and b not in seen:
                seen.add(b)
                todo.append(b)
    return seen


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_plain_walk_with_a_hub(spark, seed):
    rnd = random.Random(seed)
    edges = {(rnd.randrange(60), rnd.randrange(60)) for _ in range(60)} | {(0, i) for i in range(60, 110)} | {(i, i + 1) for i in range(110, 130)} | {(70, 110)}
    df = spark.createDataFrame(sorted(edges), "a long, b long")
    for start in ([0], [5, 9], [115]):
        got = {r.node for r in graphs.reachable(df, spark.createDataFrame([(s,) for s in start], "node long")).collect()}
        assert got == plain(edges, start)
    left, nodes = set(edges), {x for e in edges for x in e}
    while True:
        targets = {b for _, b in left}
        kept = {(a, b) for a, b in left if a in targets}
        if kept == left:
            break
        left = kept
    stuck = {x for e in left for x in e}
    assert graphs.peel(df) == (len(nodes) - len(stuck), len(stuck))
