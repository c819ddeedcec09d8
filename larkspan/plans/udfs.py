"""SQL functions, table functions, Python functions and procedures."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from larkspan import lexicons as lx
from larkspan.functions import scoring
from larkspan.functions.text import tokens
from larkspan.operators.chunking import PLAIN, chunk_recursive
from larkspan.operators.extractive import distinctive_terms
from larkspan.plans import sqltext as q
from larkspan.registry import query
from larkspan.storage import scratch, written


@query(
    """
SELECT o_orderkey, CASE WHEN o_totalprice >= 300000 THEN 3 WHEN o_totalprice >= 150000 THEN 2 ELSE 1 END + CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS severity,
  o_orderpriority || ' / ' || o_orderstatus AS headline FROM orders"""
)
def udf_sql_scalar(t):
    """SQL functions are inlined by the optimiser, so they cost what their body costs."""
    t.spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION order_severity(price DOUBLE, priority STRING) RETURNS INT
           RETURN CASE WHEN price >= 300000 THEN 3 WHEN price >= 150000 THEN 2 ELSE 1 END + CASE WHEN priority = '1-URGENT' THEN 1 ELSE 0 END"""
    )
    t.spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION order_headline(a STRING, b STRING) RETURNS STRING RETURN a || ' / ' || b")
    t.orders.createOrReplaceTempView("udf_orders")
    return t.spark.sql(
        "SELECT o_orderkey, order_severity(o_totalprice, o_orderpriority) AS severity, order_headline(o_orderpriority, o_orderstatus) AS headline FROM udf_orders"
    )


@query(
    """
SELECT o_orderkey, c_custkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE (o_totalprice > 250000 AND o_orderstatus <> 'P') AND c_acctbal < 5000"""
)
def udf_sql_boolean(t):
    """One boolean function in WHERE and another in ON."""
    t.spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION is_big(price DOUBLE, status STRING) RETURNS BOOLEAN RETURN price > 250000 AND status <> 'P'")
    t.spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION low_balance(b DOUBLE) RETURNS BOOLEAN RETURN b < 5000")
    t.orders.createOrReplaceTempView("udf_orders")
    t.customer.createOrReplaceTempView("udf_customer")
    return t.spark.sql("SELECT o_orderkey, c_custkey FROM udf_orders JOIN udf_customer ON o_custkey = c_custkey AND low_balance(c_acctbal) WHERE is_big(o_totalprice, o_orderstatus)")


@query(
    """
SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, ls[i] AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))"""
)
def udtf_sql_table(t):
    t.spark.sql(
        r"""CREATE OR REPLACE TEMPORARY FUNCTION text_lines(body STRING) RETURNS TABLE (line_no INT, line STRING)
            RETURN SELECT pos, col FROM posexplode(split(body, '\n'))"""
    )
    t.documents.createOrReplaceTempView("udtf_documents")
    return t.spark.sql("SELECT d.doc_id, l.line_no, l.line FROM udtf_documents d, LATERAL text_lines(d.text) AS l")


@query(
    """
SELECT conv_id, turn, CAST(i AS INTEGER) AS start_word, array_to_string(w[i + 1:i + 8], ' ') AS run FROM (SELECT conv_id, turn, w, unnest(range(0, len(w), 8)) AS i FROM (
  SELECT conv_id, turn, regexp_extract_all(text, '[^\\s]+') AS w FROM conversations))"""
)
def udtf_python(t):
    """Runs of eight words with their place, by an Arrow table function over whole batches."""

    @F.arrow_udtf(returnType="conv_id BIGINT, turn BIGINT, start_word INT, run STRING")
    class WordRuns:
        def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
            at, starts, runs = [], [], []
            for row, body in enumerate(batch.column("text").to_pylist()):
                words = (body or "").split()
                for i in range(0, len(words), 8):
                    at.append(row)
                    starts.append(i)
                    runs.append(" ".join(words[i : i + 8]))
            keys = batch.select(["conv_id", "turn"]).take(pa.array(at, pa.int64()))
            yield pa.table({"conv_id": keys.column(0), "turn": keys.column(1), "start_word": pa.array(starts, pa.int32()), "run": pa.array(runs, pa.string())})

    return WordRuns(t.conversations.select("conv_id", "turn", "text").asTable())


@query()
def udf_python_file(t):
    """Python over file bytes: the pages as text files, size, digest and tag count per file."""
    folder = scratch(t.spark, "html")
    t.pages.select(F.regexp_replace("html", r"[\r\n]+", " ").alias("value")).write.text(folder)
    files = t.spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder).select("path", "content")

    def inspect(batches):
        for pdf in batches:
            yield pd.DataFrame({
                "file": [p.rsplit("/", 1)[1] for p in pdf["path"]],
                "bytes": [len(c) for c in pdf["content"]],
                "digest": [hashlib.md5(c).hexdigest() for c in pdf["content"]],
                "pages": [c.count(b"<html") for c in pdf["content"]],
            })

    return files.mapInPandas(inspect, "file STRING, bytes BIGINT, digest STRING, pages BIGINT")


def refresh_chunks(stored, removed, added, size: int = 1000, overlap: int = 200):
    """Delete the chunks of removed texts, then chunk, classify and append the added ones.

    A text is removed before it is added again, so a replay changes nothing."""
    gone = removed.select("doc_id").unionByName(added.select("doc_id")).distinct()
    kept = stored.join(gone, "doc_id", "left_anti")
    fresh = chunk_recursive(added, "doc_id", "text", size, overlap, PLAIN)
    first = fresh.where("chunk_index = 0").select("doc_id", F.coalesce(scoring.best_label(tokens(F.col("chunk")), lx.TOPIC_TERMS), F.lit("other")).alias("category"))
    return kept.unionByName(fresh.join(first, "doc_id").select("doc_id", "chunk_index", "chunk", "category"))


@query()
def proc_pipeline(t):
    """Labelled texts are stored, toxic ones removed, unlabelled ones added: in one call, twice."""
    empty = t.spark.createDataFrame([], "doc_id BIGINT, chunk_index INT, chunk STRING, category STRING")
    docs = t.documents.select("doc_id", "text")
    labelled = docs.join(t.labels.select("doc_id"), "doc_id", "left_semi")
    new = docs.join(t.labels.select("doc_id"), "doc_id", "left_anti")
    toxic = t.labels.where("toxic = 1").select("doc_id")
    stored = written(refresh_chunks(empty, toxic, labelled), "chunks_v1")
    once = written(refresh_chunks(stored, toxic, new), "chunks_v2")
    return refresh_chunks(once, toxic, new)


@query(
    f"""
WITH w AS (SELECT lang, doc_id, unnest(list_distinct({q.toks('text')})) AS term FROM documents),
g AS (SELECT lang, term, count(*) AS docs FROM w GROUP BY 1, 2), h AS (SELECT term, count(*) AS held_by FROM g GROUP BY 1), n AS (SELECT count(DISTINCT lang) AS groups FROM documents),
s AS (SELECT lang, term, docs, round(docs * ln(groups / held_by), 9) AS score FROM g JOIN h USING (term), n WHERE docs >= 2),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, term) AS rank FROM s WHERE score > 0)
SELECT lang, string_agg(term || ' (' || docs || ')', ', ' ORDER BY rank) AS themes FROM r WHERE rank <= 8 GROUP BY 1"""
)
def udaf_extractive(t):
    """An aggregate over texts from native aggregates: only the chosen terms are gathered."""
    best = distinctive_terms(t.documents, "lang", F.array_distinct(tokens(F.col("text"))), 8)
    item = F.concat("term", F.lit(" ("), F.col("docs").cast("string"), F.lit(")"))
    ordered = F.array_sort(F.collect_list(F.struct("rank", item.alias("i"))))
    return best.groupBy("lang").agg(F.array_join(F.transform(ordered, lambda r: r["i"]), ", ").alias("themes"))
