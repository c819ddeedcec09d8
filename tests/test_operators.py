"""Operators against brute force, hot keys and replays."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspan.operators import graphs, skew
from larkspan.operators.enrich import enrich_cached, stub_provider
from larkspan.operators.similarity import near_duplicates
from larkspan.operators.vectors import best_per_query, best_per_row
from larkspan.registry import load_all
from larkspan.storage import scratch
from larkspan.tables import Tables, values

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows share one key; turns have gaps."""
    rng = random.Random(7)
    rows = [(1 if i % 3 == 0 else rng.randint(2, 40), i * 3 + rng.randint(0, 2), round(rng.random() * 100, 2)) for i in range(3000)]
    return rows, values(spark, "k INT, o BIGINT, v DOUBLE", rows).persist()


def groups(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return {k: sorted(v, key=lambda r: r[1]) for k, v in out.items()}


def test_last_k_across_buckets(hot):
    rows, df = hot
    got = {(r["k"], r["o"]): r["history"] for r in skew.last_k_before(df, "k", "o", F.col("v"), 4, 50).collect()}
    for k, g in groups(rows).items():
        for i, r in enumerate(g):
            assert got[(k, r[1])] == [x[2] for x in g[max(0, i - 4) : i]]


def test_prefix_sums(hot):
    rows, df = hot
    out = skew.prefix_sums(df, ["k"], F.floor(F.col("o") / 100), [F.col("o")], {"s": F.col("v")}).collect()
    got = {(r["k"], r["o"]): r["s"] for r in out}
    for k, g in groups(rows).items():
        total = 0.0
        for r in g:
            total += r[2]
            assert got[(k, r[1])] == pytest.approx(total)


def test_exact_quantiles(spark, hot):
    rows, df = hot
    big = df.unionByName(spark.range(60_000).select(F.lit(1).alias("k"), F.col("id").alias("o"), (F.pmod(F.xxhash64("id"), F.lit(9999)) / 7).alias("v"))).persist()
    got = {r["k"]: (r["p50"], r["p90"], r["p100"]) for r in skew.exact_quantiles(big, ["k"], "v", {"p50": 0.5, "p90": 0.9, "p100": 1.0}).collect()}
    want = big.toPandas().groupby("k")["v"]
    for k, v in want:
        assert got[k] == pytest.approx(tuple(np.percentile(v, [50, 90, 100])))


def test_bounded_text(hot):
    rows, df = hot
    got = {r["k"]: r["t"] for r in skew.bounded_text_agg(df, ["k"], [F.col("o")], F.col("v").cast("string"), ",", 100, "t").collect()}
    for k, g in groups(rows).items():
        assert got[k] == ",".join(str(r[2]) for r in g)[:100]


def test_salted_join(spark, hot):
    _, df = hot
    small = values(spark, "k INT, n STRING", [(k, f"n{k}") for k in range(1, 41)])
    a = skew.salted_join(df, small, ["k"], 5, ["o"]).select("k", "o", "n")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, df.join(small, "k").select("k", "o", "n").collect()))


def test_vector_search_is_exact(spark, monkeypatch):
    import larkspan.operators.vectors as vec

    monkeypatch.setattr(vec, "BLOCK_ROWS", 7)  # several query blocks
    t = Tables(spark, SF)
    pdf = t.embeddings.orderBy("vec_id").toPandas()
    m = np.array(pdf["embedding"].tolist(), dtype=float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    queries = t.embeddings.where("vec_id < 20").select(F.col("vec_id").alias("qid"), "embedding")
    sims = np.round(m[:20] @ m.T, 6)
    want = {(i, j + 1): int(x) for i in range(20) for j, x in enumerate(np.lexsort((np.arange(len(m)), -sims[i]))[:5])}
    got = {(r["qid"], r["rank"]): r["vec_id"] for r in best_per_query(t.embeddings, "vec_id", queries, "qid", 5).collect()}
    assert got == want
    rows = best_per_row(t.embeddings, "vec_id", queries, "qid", 2).collect()
    best = {(r["vec_id"], r["rank"]): r["qid"] for r in rows}
    assert best == {(i, j + 1): int(x) for i in range(len(m)) for j, x in enumerate(np.lexsort((np.arange(20), -sims[:, i]))[:2])}


def test_lsh_recall(spark):
    rows = load_all()["search_lsh_ann"](spark, SF).collect()
    assert sum(r["in_exact"] for r in rows) / len(rows) >= 0.9


@pytest.fixture(scope="module")
def small_graph(spark):
    rng = random.Random(3)
    edges = sorted({tuple(sorted(rng.sample(range(60), 2))) for _ in range(45)})
    both = [(f"n{a:02d}", f"n{b:02d}", 1) for a, b in edges] + [(f"n{b:02d}", f"n{a:02d}", 1) for a, b in edges]
    return edges, values(spark, "a STRING, b STRING, weight BIGINT", both).persist()


def brute_components(edges):
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {f"n{x:02d}": f"n{find(x):02d}" for x in parent}


def test_components(small_graph):
    edges, pairs = small_graph
    got = {r["node"]: r["component"] for r in graphs.components(pairs.select("a", "b")).collect()}
    assert got == brute_components(edges)


def test_communities_invariants(small_graph):
    edges, pairs = small_graph
    lab = graphs.communities(pairs).collect()
    got = {r["node"]: r["community"] for r in lab}
    assert len(lab) == len(got) == len(brute_components(edges))  # exclusive and exhaustive
    inside = [(a, b) for a, b in edges if got[f"n{a:02d}"] == got[f"n{b:02d}"]]
    for node, comp in brute_components(inside).items():  # connected
        assert got[node] == comp


def test_peel(spark):
    dag = values(spark, "a STRING, b STRING", [("a", "b"), ("b", "c"), ("a", "c")])
    assert graphs.peel(dag)[1] == 0
    loop = values(spark, "a STRING, b STRING", [("a", "b"), ("b", "c"), ("c", "b")])
    assert graphs.peel(loop)[1] > 0


def test_alias_split_breaks_path(spark):
    pair = lambda x, y: [(x, y, 1), (y, x, 1)]
    seeds = values(spark, "node STRING", [("part",)])
    split = values(spark, "a STRING, b STRING, weight BIGINT", pair("part", "press 4") + pair("press-4", "delay"))
    joined = values(spark, "a STRING, b STRING, weight BIGINT", pair("part", "press 4") + pair("press 4", "delay"))
    nodes = lambda g: {r["node"] for r in graphs.khop(g, seeds, 4).collect()}
    assert "delay" not in nodes(split) and "delay" in nodes(joined)


def test_near_duplicates_of_hot_copies(spark):
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"
    rows = [(i, base) for i in range(40)] + [(100, base + " rho"), (200, "something else entirely with other words here")]
    got = {r["k"]: (r["anchor"], r["kind"]) for r in near_duplicates(values(spark, "k INT, t STRING", rows), "k", "t").collect()}
    assert all(got[i] == (0, "copy") for i in range(1, 40))
    assert got[100] == (0, "near") and 200 not in got


def test_enrich_asks_once(spark):
    cache = scratch(spark, "cache")
    df = values(spark, "k INT, t STRING", [(1, "hello there"), (2, "hello there"), (3, "")])
    first = {r["k"]: r for r in enrich_cached(df, "t", stub_provider, ["small"], cache).collect()}
    assert first[1]["value"] == first[2]["value"] == "2 words from hello"
    assert "empty input" in first[3]["error"]
    before = spark.read.parquet(cache).where("error IS NULL").count()
    enrich_cached(df, "t", stub_provider, ["small"], cache).collect()
    assert spark.read.parquet(cache).where("error IS NULL").count() == before == 1


def test_replay_changes_nothing(spark):
    from larkspan.plans.udfs import refresh_chunks
    from larkspan.storage import written

    docs = values(spark, "doc_id BIGINT, text STRING", [(1, "one two"), (2, "three"), (3, "four")])
    empty = spark.createDataFrame([], "doc_id BIGINT, chunk_index INT, chunk STRING, category STRING")
    gone = docs.where("doc_id = 2").select("doc_id")
    stored = written(refresh_chunks(empty, gone, docs.where("doc_id < 3")), "v1")
    once = written(refresh_chunks(stored, gone, docs.where("doc_id = 3")), "v2")
    twice = refresh_chunks(once, gone, docs.where("doc_id = 3"))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


@pytest.mark.parametrize("name", ["st_windowed_counts", "st_cdc_insert_delete", "st_audit_log", "chunk_recursive", "enrich_cached", "udf_python_file"])
def test_runs(spark, name):
    assert load_all()[name](spark, SF).count() > 0


@pytest.mark.parametrize(
    "edges,free,stuck",
    [
        ([("x", "x"), ("y", "y"), ("p", "q")], 2, 2),
        ([("b", "c"), ("c", "b"), ("x", "x")], 0, 3),
        ([("a", "b"), ("b", "b"), ("b", "d")], 1, 2),
        ([("a", "b"), ("b", "c")], 3, 0),
    ],
)
def test_peel_keeps_loops(spark, edges, free, stuck):
    from larkspan.operators.graphs import peel

    assert peel(spark.createDataFrame(edges, "a string, b string")) == (free, stuck)


def test_short_words_find_a_text(spark):
    from larkspan.operators.textindex import TextIndex, add_batch, search
    from larkspan.storage import scratch

    docs = spark.createDataFrame([(1, "the AI API and SQL of it"), (2, "a long text about something else")], "doc_id bigint, text string")
    asked = spark.createDataFrame([(7, "AI API SQL")], "item_id bigint, text string")
    index = TextIndex(spark, scratch(spark, "index"), "doc_id BIGINT")
    add_batch(index, docs, 0)
    assert [r.doc_id for r in search(index, asked, "item_id", 5).collect()] == [1]


def test_listing_keeps_the_path_below_the_root(spark, tmp_path):
    from larkspan.sources.files import listing

    for d in ("a", "b"):
        (tmp_path / d).mkdir()
        (tmp_path / d / "same.txt").write_text(d)
    assert sorted(r.relative_path for r in listing(spark, str(tmp_path)).collect()) == ["a/same.txt", "b/same.txt"]


def test_quoted_line_feeds_are_read(spark, tmp_path):
    from larkspan.sources.files import read_csv, split_rejects

    (tmp_path / "t.csv").write_text('id,text\n1,"two\nlines"\nx,bad\n2,one\n')
    good, bad = split_rejects(read_csv(spark, str(tmp_path / "t.csv"), "id INT, text STRING").cache())
    assert sorted((r.id, r.text) for r in good.collect()) == [(1, "two\nlines"), (2, "one")]
    assert bad.count() == 1
