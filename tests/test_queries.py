"""Queries without SQL, held against plain versions on the smallest tables."""

import hashlib
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from larkspan.plans import graph as g
from larkspan.plans.semantic_model import SALES
from larkspan.registry import load_all
from larkspan.tables import Tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, SF)


def run(spark, name):
    return load_all()[name](spark, SF).collect()


def test_every_model_entry_resolves(spark, t):
    rows = run(spark, "sem_model_load")
    assert {(r.kind, r.name) for r in rows} == {(k, n) for k in ("facts", "dimensions", "metrics") for n in SALES[k]}
    sizes = {n: getattr(t, s["source"]).count() for n, s in SALES["tables"].items()}
    assert all(r.table_rows == sizes[r.table_name] and r.data_type for r in rows)


def bag(texts):
    out = Counter()
    for text in texts:
        for w in re.findall(r"[^\W_]+", text.lower()):
            out[int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % g.DIMS] += 1
    return out


def cosine(a, b):
    dot = sum(n * b[d] for d, n in a.items())
    return dot / math.sqrt(sum(n * n for n in a.values()) * sum(n * n for n in b.values())) if dot else 0.0


def test_three_stores_score_whole_bodies(spark, t):
    rows = [r for r in run(spark, "stores_three")]
    questions = {r.item_id: bag([r.text]) for r in t.benchmark.collect()}
    bodies = {"chunks": {r.doc_id: bag([r.text]) for r in t.documents.collect()}}
    facts, entities = {}, {}
    for r in g.facts_of(t).collect():
        facts.setdefault(r.community, []).append(r.fact)
    named = g.found_relations(t).select("source", "relation", "target", g.name_id(F.col("source")).alias("s"), g.name_id(F.col("target")).alias("d")).distinct().collect()
    for r in named:
        for i in {r.s, r.d}:
            entities.setdefault(i, set()).add(f"{r.source} {r.relation} {r.target}")
    bodies |= {"reports": {i: bag(x) for i, x in facts.items()}, "entities": {i: bag(x) for i, x in entities.items()}}
    assert {r.store for r in rows} == {s for s, b in bodies.items() if b}
    for r in rows:
        assert abs(cosine(questions[r.item_id], bodies[r.store][r.id]) - r.similarity) < 2e-6
    for store, body in bodies.items():
        for q in list(questions)[:5]:
            best = sorted((round(cosine(questions[q], b), 6) for b in body.values()), reverse=True)[:3]
            got = [r.similarity for r in sorted((r for r in rows if r.store == store and r.item_id == q), key=lambda r: r["rank"])]
            assert all(abs(x - y) < 2e-6 for x, y in zip(got, best))


def test_rollup_reports_hold_whole_facts_within_the_budget(spark, t):
    rows = run(spark, "community_rollup")
    tree = g.tree_of(t).collect()
    assert {r.community for r in rows} <= {r.community for r in tree} and rows
    facts = {r.fact for r in g.community_facts(g.found_relations(t), g.tree_of(t).select("node", "community")).collect()}
    for r in rows:
        if r.method != "parent: child reports" and r.report:
            parts = r.report.split(". ")
            assert set(parts) <= facts
            assert len(r.report.split()) <= 100 or len(parts) == 1


def test_detected_communities_carry_the_graph_jobs(spark, t):
    members = g.members_of(t)
    summary = [r for r in run(spark, "job_graph_rag") if r.mode == "summary"]
    assert summary[0].result == str(members.select("community").distinct().count())
    assert {r.stage for r in run(spark, "drift_hybrid")} <= {"primer", "refine", "follow_up"}


def test_graph_rag_routes_its_questions_and_searches_reports(spark, tmp_path):
    texts = {i: "alphaline came from betaworks." for i in range(1, 7)} | {i: "gammaplant was by deltaforge." for i in range(7, 13)}
    asked = {1: "why alphaline", 2: "betaworks delayed than", 3: "what was caused by it"}
    spark.createDataFrame([(i, x, "en", "s", len(x)) for i, x in texts.items()], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(asked.items()), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = {tuple(r) for r in load_all()["job_graph_rag"](spark, str(tmp_path)).collect()}
    of = lambda mode: {r[1:] for r in rows if r[0] == mode}
    assert of("route") == {("1", "local", 1), ("2", "hybrid", 1), ("3", "global", 1)}
    assert of("global") == {("2", "alphaline delayed by betaworks", 1), ("3", "gammaplant caused by deltaforge", 1)}
    first = {(str(i), i) for i in range(1, 6)}
    assert {r for r in of("local") if r[0] != "seed"} == {(q, d, n) for q in "12" for d, n in first}
    assert of("follow_up") == {("2", "alphaline", 1)}
    store = g.report_store(Tables(spark, str(tmp_path))).collect()
    assert {r.body for r in store} == {"alphaline delayed by betaworks", "gammaplant caused by deltaforge"}


def test_a_parent_whose_facts_do_not_fit_is_searched_by_its_children(spark, t):
    """Every part of a report is searched, beyond the budget of a printed report too."""
    base = g.rolled_up(t)[0].collect()
    parts, facts = {}, {}
    for r in g.report_store(t, 0).collect():
        parts.setdefault(r.community, set()).add(r.body)
    for r in g.tree_facts(t).select(g.name_id(F.col("community")).alias("id"), "fact").collect():
        facts.setdefault(r.id, set()).add(r.fact)
    ids = {r.community: r.id for r in spark.createDataFrame([(r.community,) for r in base], "community string").select("community", g.name_id(F.col("community")).alias("id")).collect()}
    for r in base:
        want = facts.get(ids[r.community], set()) if r.is_leaf or not r.raw_words else {f"{k.community}: {k.headline}" for k in base if k.parent == r.community}
        assert parts.get(ids[r.community], set()) == want


def test_procedure_run_twice_changes_nothing(spark, t):
    rows = run(spark, "proc_pipeline")
    toxic = {r.doc_id for r in t.labels.where("toxic = 1").collect()}
    new = {r.doc_id for r in t.documents.join(t.labels, "doc_id", "left_anti").collect()}
    got = {r.doc_id for r in rows}
    assert new <= got and not (toxic - new) & got
    assert len(rows) == len({(r.doc_id, r.chunk_index) for r in rows})
