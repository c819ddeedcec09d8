"""Formats of chunks, keyed first arrivals over runs, filters and NULL groups of the semantic layer."""

import random

from pyspark.sql import functions as F

from larkspan.operators import chunking as c
from larkspan.plans.semantic_model import SALES
from larkspan.plans.semantics import semantic_query, tables_of
from larkspan.registry import load_all
from larkspan.storage import scratch
from larkspan.streaming.runs import file_stream, first_arrivals, run_batches
from larkspan.tables import Tables

SF = "/root/testdata/sf0.001"


def test_chunks_follow_the_format_of_their_row(spark):
    md = "# A\n" + "intro word " * 9 + "\n## B\n" + "text in b " * 12 + "\n### C\ndeep\n## D\n" + "last " * 30 + "\n# E\nend"
    rows = [("m", "markdown", md), ("p", "plain", md), ("n", None, "x y"), ("e", "markdown", None), ("o", "odd", "")]
    got = c.chunk_by_format(spark.createDataFrame(rows, "id string, format string, text string"), "id", "text", "format", 80, 20).collect()
    for i, kind, text in rows:
        mine = sorted((r.chunk_index, r.start_index, r.chunk) for r in got if r.id == i)
        assert mine == [(n, a, text[a:b]) for n, (a, b) in enumerate(c.spans(text or "", 80, 20, c.FORMATS.get(kind, c.PLAIN)))]
    paths = {}
    for line_at, path in ((md.index("# A"), "A"), (md.index("## B"), "A > B"), (md.index("### C"), "A > B > C"), (md.index("## D"), "A > D"), (md.index("# E"), "E")):
        paths[line_at] = path
    for r in got:
        want = [p for at, p in sorted(paths.items()) if at <= r.start_index] if r.id == "m" else [""]
        assert r.heading == want[-1]
    assert any(r.chunk.startswith("## D") for r in got if r.id == "m")


def test_table_function_equals_the_chunker(spark):
    docs = Tables(spark, SF).documents.select("doc_id", "text").collect()
    got = load_all()["chunk_line_udtf"](spark, SF)
    assert got.rdd.getNumPartitions() > 1
    want = {(r.doc_id, r.text[a:b], a) for r in docs for a, b in c.spans(r.text or "", 500, 100, c.LINES)}
    assert {(r.doc_id, r.chunk, r.start_index) for r in got.collect()} == want


def test_chunk_formats_reads_all_rows(spark):
    rows = load_all()["chunk_formats"](spark, SF).groupBy("format").agg(F.count_distinct("source_id").alias("n"), F.max(F.length("chunk")).alias("m")).collect()
    t = Tables(spark, SF)
    n = {r.format: r.n for r in rows}
    assert n["plain"] == t.documents.where("length(text) > 0").count() and 0 < n["markdown"] <= t.pages.count()
    assert all(r.m <= 1000 for r in rows)


def test_first_arrivals_over_three_runs(spark):
    feed, out, ck = scratch(spark, "feed"), scratch(spark, "out"), scratch(spark, "ck")
    schema = "id long, ts long, run int"
    rnd = random.Random(1)
    seen, runs = set(), []
    for run in range(3):
        ids = [rnd.randrange(60) for _ in range(40)] + [None]
        rows = [(i, 100 - run * 50 if i is None or i % 2 else 100 + run, run) for i in ids]  # many are late by their time
        runs.append(rows)
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(feed)
        run_batches(file_stream(spark, feed, schema), first_arrivals(out, "id"), ck)
    got = [(r.id, r.run) for r in spark.read.schema(schema).parquet(f"{out}/rows/batch_id=*").collect()]
    want = {}
    for run, rows in enumerate(runs):
        for i, _, _ in rows:
            want.setdefault(i, run) if i is not None else seen.add(run)
    assert sorted((i, r) for i, r in got if i is not None) == sorted(want.items())
    assert sorted(r for i, r in got if i is None) == [0, 1, 2]


def test_first_arrivals_replay_and_expiry(spark):
    out = scratch(spark, "out")
    sink = first_arrivals(out, "id", keep_batches=1)
    df = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id long")
    for batch, ids in ((0, (1, 2)), (1, (2, 3)), (1, (2, 3)), (2, (1, 3))):
        sink(df(*ids), batch)
    rows = spark.read.schema("id long, batch_id int").parquet(f"{out}/rows").collect()
    assert sorted((r.batch_id, r.id) for r in rows) == [(0, 1), (0, 2), (1, 3), (2, 1)]  # 1 had expired


def test_a_filter_brings_its_own_tables(spark):
    t = Tables(spark, SF)
    assert tables_of(SALES, "c_mktsegment = 'o_orderdate'") == [n for n, s in SALES["tables"].items() if s["source"] == "customer"]
    got = semantic_query(t, SALES, ["m_order_count"], ["d_quarter"], "c_mktsegment = 'MACHINERY'").agg(F.sum("m_order_count")).first()[0]
    assert got == t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).where("c_mktsegment = 'MACHINERY'").count()


def test_null_groups_meet(spark, tmp_path):
    for name in ("region", "nation", "customer", "orders", "lineitem"):
        df = getattr(Tables(spark, SF), name)
        if name == "orders":
            df = df.withColumn("o_orderdate", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderdate")))
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    t = Tables(spark, str(tmp_path))
    rows = semantic_query(t, SALES, ["m_gross_revenue", "m_order_count"], ["d_quarter"]).collect()
    assert len(rows) == len({r.d_quarter for r in rows})
    assert all(r.m_gross_revenue is not None and r.m_order_count is not None for r in rows)


def test_transcript_rows_of_a_long_conversation(spark, tmp_path):
    rows = [(1, i, ["user", "assistant"][i % 2], " ".join(["w"] * (i % 5))) for i in range(700)] + [(2, 0, "user", None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {(r.conv_id, r.turn): (r.start_word, r.end_word) for r in load_all()["conv_turn_rows"](spark, str(tmp_path)).collect()}
    at = 0
    for i in range(700):
        assert got[1, i] == (at, at + i % 5)
        at += i % 5
    words = load_all()["conv_word_rows"](spark, str(tmp_path)).where("conv_id = 1").agg(F.count("*"), F.count_distinct("position"), F.max("position")).first()
    assert tuple(words) == (at, at, at - 1)
