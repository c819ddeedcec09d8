"""The stored index against scoring every document, over batches, replacements, removals and a running stream."""

import math
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from larkspan.operators import textindex as ti
from larkspan.plans.streams import keeps
from larkspan.storage import scratch
from larkspan.streaming.runs import file_stream, run_refreshing

SCHEMA = "id string, text string, lang string"


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def plain(docs, asked, k, lang=None):
    """{(q, id): score} of the k best by BM25 over all documents."""
    bags = [(i, Counter(words(text)), g) for i, text, g in docs]
    n, avg = len(bags), sum(sum(b.values()) for _, b, _ in bags) / max(len(bags), 1)
    df = Counter(w for _, b, _ in bags for w in b)
    out = []
    for q, text in asked:
        rows = []
        for i, b, g in bags:
            hit = set(words(text)) & set(b)
            if hit and (lang is None or g == lang):
                size = sum(b.values())
                s = sum(math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * b[w] * 2.2 / (b[w] + 1.2 * (0.25 + 0.75 * size / avg)) for w in hit)
                rows.append((-round(s, 6), i))
        out += [(q, i, -s, r + 1) for r, (s, i) in enumerate(sorted(rows)[:k])]
    return sorted(out)


def made(n, seed, start=0):
    rnd = random.Random(seed)
    bank = [f"w{int(rnd.paretovariate(0.6))}" for _ in range(400)]
    return [(f"d{start + i}", None if i % 50 == 7 else " ".join(rnd.choice(bank) for _ in range(int(rnd.paretovariate(0.8)) % 300)), rnd.choice("ab")) for i in range(n)]


def index(spark):
    return ti.TextIndex(spark, scratch(spark, "index"), "id STRING, lang STRING")


def asked(spark, docs, n=12):
    rows = [(i, " ".join(words(docs[i * 7 % len(docs)][1])[:9]) + " w1 nowhere") for i in range(n)] + [(99, ""), (98, None)]
    return rows, spark.createDataFrame(rows, "q long, text string")


def close(got, want):
    assert [r[:2] + r[3:] for r in got] == [r[:2] + r[3:] for r in want]
    assert all(abs(a[2] - b[2]) < 2e-6 for a, b in zip(got, want))


def found(x, qs, k, where=None):
    return sorted((r.q, r.id, r.score, r["rank"]) for r in ti.search(x, qs, "q", k, where).collect())


def test_equals_scoring_everything_and_skips_blocks(spark, monkeypatch):
    monkeypatch.setattr(ti, "BLOCK", 8)
    docs = made(900, 1)
    x = index(spark)
    ti.add_batch(x, spark.createDataFrame(docs, SCHEMA), 0)
    rows, qs = asked(spark, docs)
    close(found(x, qs, 5), plain(docs, rows, 5))
    close(found(x, qs, 4, F.col("lang") == "a"), plain(docs, rows, 4, "a"))
    shown = ti.search(x, qs, "q", 3, show=("lang",)).collect()
    assert {(r.id, r.lang) for r in shown} <= {(i, g) for i, _, g in docs}


def test_batches_add_files_and_replace_and_remove_documents(spark):
    docs, more = made(120, 2), made(60, 3, 120)
    changed = [(i, "w1 brand new words w3", "b") for i, _, _ in docs[:20]]
    x = index(spark)
    ti.add_batch(x, spark.createDataFrame(docs, SCHEMA), 0)
    before = {f for f in spark.read.parquet(f"{x.path}/postings").inputFiles()}
    ti.add_batch(x, spark.createDataFrame(more + changed, SCHEMA), 1)
    ti.add_batch(x, spark.createDataFrame(more + changed, SCHEMA), 1)  # replayed
    assert before < {f for f in spark.read.parquet(f"{x.path}/postings").inputFiles()}
    now = changed + docs[20:] + more
    rows, qs = asked(spark, docs + [("z", "brand new", "a")] * 90)
    close(found(x, qs, 6), plain(now, rows, 6))
    ti.remove_batch(x, spark.createDataFrame([(i,) for i, _, _ in now[:50]] + [("absent",)], "id string"), 2)
    close(found(x, qs, 6), plain(now[50:], rows, 6))
    assert x.docs().count() == len(now) - 50


def test_a_batch_without_its_commit_is_not_seen(spark):
    x = index(spark)
    ti.add_batch(x, spark.createDataFrame([("a", "one two", "a")], SCHEMA), 0)
    spark.createDataFrame([("one", 5)], "term string, df long").write.parquet(f"{x.path}/terms/batch_id=1")
    _, qs = [], spark.createDataFrame([(1, "one")], "q long, text string")
    close(found(x, qs, 3), plain([("a", "one two", "a")], [(1, "one")], 3))


def test_no_document_is_tokenised_by_a_search(spark):
    docs = made(40, 5)
    x = index(spark)
    ti.add_batch(x, spark.createDataFrame(docs, SCHEMA), 0)
    rows, qs = asked(spark, docs)
    plan = ti.search(x, qs, "q", 3)._jdf.queryExecution().toString()
    assert "regexp_extract_all" not in plan


def test_repeats_nulls_and_empty_batches(spark):
    x = index(spark)
    ti.add_batch(x, spark.createDataFrame([], SCHEMA), 0)
    qs = spark.createDataFrame([(1, "one")], "q long, text string")
    assert found(x, qs, 3) == []
    rows = [("a", "one two", "a"), ("a", "one two", "a"), (None, "one", None), ("b", None, "a"), ("c", "", "a")]
    ti.add_batch(x, spark.createDataFrame(rows, SCHEMA), 1)
    assert sorted((r.id or "", r["rank"]) for r in ti.search(x, qs, "q", 9).collect()) == [("", 1), ("a", 2), ("a", 3)]
    with pytest.raises(ValueError):
        ti.search(index(spark), qs, "q", 3)


def test_passages_are_found_by_their_rarest_inner_word(spark):
    docs = [("a", "xx the cat sat on the mat yy", "a"), ("b", "the dog sat on the mat", "a"), ("c", "prethe cat sat on the matter", "a")]
    x = index(spark)
    ti.add_batch(x, spark.createDataFrame(docs, SCHEMA), 0)
    qs = spark.createDataFrame([(1, "the cat sat on the mat"), (2, "cat sat"), (3, "no such words here")], "q long, text string")
    assert {(r.q, r.id) for r in ti.holding(x, qs, "q").collect()} == {(1, "a"), (1, "c")}


def test_a_running_stream_keeps_the_index_within_its_lag(spark):
    feed, x = scratch(spark, "feed"), index(spark)
    docs = made(60, 8)
    spark.createDataFrame(docs[:30], SCHEMA).coalesce(1).write.parquet(feed)
    q = run_refreshing(file_stream(spark, feed, SCHEMA), keeps(x), scratch(spark, "ck"), "1 second")
    try:
        for upto, part in ((0, None), (1, docs[30:])):
            if part:
                spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(feed)
            end = time.time() + 90
            while x.upto() < upto and time.time() < end and q.isActive:
                time.sleep(0.5)
            assert x.upto() == upto
    finally:
        q.stop()
    rows, qs = asked(spark, docs, 5)
    close(found(x, qs, 4), plain(docs, rows, 4))


def test_scores_add_up_where_the_block_lies(spark, monkeypatch):
    """Postings are dealt by block before they meet questions, which come in one group or in several."""
    docs = made(300, 11)
    asked = [(i, d[1]) for i, d in enumerate(docs[:9]) if d[1]] + [(90, "nothingofthis")]
    at = index(spark)
    ti.add_batch(at, spark.createDataFrame(docs, SCHEMA), 0)
    questions = spark.createDataFrame(asked, "q long, text string")
    for size in (1024, 2):
        monkeypatch.setattr(ti, "QUESTIONS", size, raising=False)
        found = ti.search(at, questions, "q", 5)
        assert sorted((r.q, r.id, r.score, r["rank"]) for r in found.collect()) == plain(docs, asked, 5)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"hashpartitioning\(batch_id#\d+L?, block#\d+L?, \d+\), REPARTITION_BY_COL", plan)


def test_postings_are_packed_and_move_once(spark, monkeypatch):
    """Postings name a document by its place in the block; its key, row and length are stored once, beside them."""
    docs = made(200, 4)
    x = index(spark)
    ti.add_batch(x, spark.createDataFrame(docs, SCHEMA), 0)
    p = x.table("postings", 0)
    assert dict(p.dtypes)["places"] == dict(p.dtypes)["tfs"] == "array<int>" and "docs" not in p.columns
    held = {(r.term, r.id): r.tf for r in p.selectExpr("term", "batch_id", "block", "explode(arrays_zip(places, tfs)) p").join(ti._members(x, 0), ["batch_id", "block"]).selectExpr("term", "members[p.places].doc id", "p.tfs tf").collect()}
    assert held == {(w, i): n for i, text, _ in docs for w, n in Counter(words(text)).items()}
    dropped = [m["ok"] for r in ti._members(x, 0, F.col("lang") == "a").collect() for m in r.members]
    assert dropped.count(True) == sum(g == "a" for *_, g in docs) and len(dropped) == len(docs)


def test_hits_fetch_documents_without_moving_them(spark, tmp_path):
    from larkspan.plans.retrieval import with_documents
    from larkspan.tables import Tables

    spark.createDataFrame([(i, f"text {i}", "en", "s", 6) for i in range(50)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    hits = spark.createDataFrame([(1, 7), (2, 7), (3, 99)], "item_id long, doc_id long").repartition(2)
    got = with_documents(Tables(spark, str(tmp_path)), hits, "text")
    assert "hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.item_id, r.text) for r in got.collect()) == [(1, "text 7"), (2, "text 7")]
