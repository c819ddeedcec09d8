"""Chunking queries."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspan.functions.html import html_to_markdown
from larkspan.operators.chunking import LINES, PLAIN, chunk_by_format, chunk_fixed, packed_lines, spans
from larkspan.operators.chunking import chunk_recursive as split_recursive
from larkspan.registry import query


@query()
def chunk_recursive(t):
    """1512/256 with plain separators; Markdown separators for parsed pages are the same call."""
    return split_recursive(t.texts, "doc_id", "text", 1512, 256, PLAIN)


@query()
def chunk_formats(t):
    """Pages as Markdown and documents as plain text in one table, each row split by its own format."""
    pages = t.pages.select(F.concat(F.lit("page/"), "page_id").alias("source_id"), F.lit("markdown").alias("format"), html_to_markdown(F.col("html")).alias("text"))
    docs = t.texts.select(F.concat(F.lit("doc/"), "doc_id").alias("source_id"), F.lit("plain").alias("format"), "text")
    return chunk_by_format(pages.unionByName(docs), "source_id", "text", "format", 1000, 200)


_FIXED = """
SELECT doc_id, CAST(i AS INTEGER) AS chunk_index, CAST(i * 900 AS INTEGER) AS start_index, substring(text, CAST(i * 900 + 1 AS BIGINT), 1000) AS chunk
FROM (SELECT doc_id, text, unnest(range(0, greatest(CAST(ceil((length(text) - 100) / 900.0) AS BIGINT), 1))) AS i FROM documents WHERE length(text) > 0)"""


@query(_FIXED)
def chunk_fixed_overlap(t):
    return chunk_fixed(t.texts, "doc_id", "text", 1000, 100)


def chunk_text(rows):
    """CHUNK_TEXT over a table of (doc_id, text): (doc_id, chunk, start_index), line separators, 500 / 100.

    An Arrow table function: it takes and gives whole batches."""

    @F.arrow_udtf(returnType="doc_id BIGINT, chunk STRING, start_index INT")
    class ChunkText:
        def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
            keys, parts, starts = [], [], []
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                for a, b in spans(text or "", 500, 100, LINES):
                    keys.append(key)
                    parts.append(text[a:b])
                    starts.append(a)
            yield pa.table({"doc_id": pa.array(keys, pa.int64()), "chunk": pa.array(parts, pa.string()), "start_index": pa.array(starts, pa.int32())})

    return ChunkText(rows.select("doc_id", "text").asTable())


@query()
def chunk_line_udtf(t):
    return chunk_text(t.texts)


_LINES = """
l AS MATERIALIZED (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda s: len(regexp_extract_all(s, '[^\\s]+'))) AS w FROM documents),
f(doc_id, budget, w, i, chunk, used) AS (
  SELECT doc_id, b, w, 1, 0, w[1] FROM l, (VALUES {budgets}) AS v(b)
  UNION ALL
  SELECT doc_id, budget, w, i + 1, CASE WHEN used + w[i + 1] > budget THEN chunk + 1 ELSE chunk END, CASE WHEN used + w[i + 1] > budget THEN w[i + 1] ELSE used + w[i + 1] END
  FROM f WHERE i < len(w))"""


@query(
    "WITH RECURSIVE" + _LINES.replace("{budgets}", "(60)") + """
SELECT doc_id, CAST(chunk AS INTEGER) AS chunk_index, count(*) AS lines, CAST(sum(w[i]) AS BIGINT) AS words FROM f GROUP BY 1, 2"""
)
def chunk_word_budget(t):
    rows = packed_lines(t.texts, "doc_id", "text", [60])
    return rows.groupBy("doc_id", "chunk_index").agg(F.count("*").alias("lines"), F.sum("n_words").alias("words"))


@query(
    f"""
SELECT doc_id, count(*) AS chunks, max(chunk_index) + 1 AS by_index, CAST(min(length(chunk)) AS INTEGER) AS shortest, CAST(max(length(chunk)) AS INTEGER) AS longest,
       round(avg(length(chunk)), 4) AS mean_length FROM ({_FIXED}) GROUP BY 1"""
)
def chunk_inventory(t):
    c = chunk_fixed(t.texts, "doc_id", "text", 1000, 100).withColumn("n", F.length("chunk"))
    return c.groupBy("doc_id").agg(
        F.count("*").alias("chunks"), (F.max("chunk_index") + 1).alias("by_index"), F.min("n").alias("shortest"), F.max("n").alias("longest"), F.round(F.avg("n"), 4).alias("mean_length")
    )


@query(
    "WITH RECURSIVE" + _LINES.replace("{budgets}", "(25), (50), (100), (200), (400)") + """,
r AS (SELECT budget, doc_id, chunk, w[i] AS n, sum(w[i]) OVER (PARTITION BY budget, doc_id, chunk ORDER BY i DESC ROWS UNBOUNDED PRECEDING) - w[i] AS after FROM f),
c AS (SELECT budget, count(*) AS chunks FROM (SELECT DISTINCT budget, doc_id, chunk FROM f) GROUP BY 1)
SELECT CAST(budget AS INTEGER) AS budget, c.chunks, count(*) AS facts, round(sum(greatest(0.3, 1 - 0.004::DOUBLE * after)), 3) AS expected_recalled
FROM r JOIN c USING (budget) GROUP BY 1, 2"""
)
def chunk_size_tradeoff(t):
    """Chunks and expected recall per word budget. The window stays inside one chunk."""
    rows = packed_lines(t.texts, "doc_id", "text", [25, 50, 100, 200, 400])
    later = Window.partitionBy("doc_id", "budget", "chunk_index").orderBy("line").rowsBetween(1, Window.unboundedFollowing)
    after = F.coalesce(F.sum("n_words").over(later), F.lit(0))
    facts = rows.withColumn("p", F.greatest(F.lit(0.3), 1 - 0.004 * after))
    per_chunk = facts.groupBy("doc_id", "budget", "chunk_index").agg(F.count("*").alias("n"), F.sum("p").alias("p"))
    return per_chunk.groupBy("budget").agg(F.count("*").alias("chunks"), F.sum("n").alias("facts"), F.round(F.sum("p"), 3).alias("expected_recalled"))


