"""End-to-end jobs composed from the operators; each stage is a table."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspan import lexicons as lx
from larkspan.functions import pii, scoring
from larkspan.functions.text import numbers, sentences, tokens
from larkspan.operators import graphs
from larkspan.operators.chunking import PLAIN, chunk_recursive
from larkspan.operators.extractive import distinctive_terms
from larkspan.operators.search import hashed
from larkspan.operators.skew import top_n
from larkspan.operators.textindex import TextIndex, add_batch, search
from larkspan.operators.vectors import best_per_query
from larkspan.plans import sqltext as q
from larkspan.plans.evaluation import link_coverage
from larkspan.plans.graph import (
    found_mentions, local_ranking, local_rankings, map_reduce, name_id, report_store, routes, seed_node, tree_facts, tree_of, weighted_graph,
)
from larkspan.plans.retrieval import _BM25
from larkspan.plans.textual import aspect_sentiment, check_claims, triage, with_words
from larkspan.registry import query
from larkspan.storage import scratch, written

_ABUSE = list(lx.TOPIC_TERMS["abuse"])
_P, _N = q.pos_neg("w", lx.SAMPLE_SENTIMENT)


@query(
    f"""
WITH c AS (SELECT doc_id, lang, source, {q.redact('text')} AS clean, text FROM documents),
a AS (SELECT *, {q.toks('clean')} AS w FROM c WHERE {q.has(q.toks('clean'), _ABUSE)} OR clean <> text OR {q.has(q.toks('clean'), ['licensed', 'license'])}),
s AS (SELECT doc_id, lang, source, clean, w, {_P} AS p, {_N} AS n, {q.labels('w', lx.TOPIC_TERMS)}[1].label AS label FROM a),
k AS (SELECT source, count(*) AS source_rows FROM s GROUP BY 1)
SELECT doc_id, lang, source, coalesce(label, 'other') AS category, {q.sentiment('p', 'n')} AS sentiment, coalesce(nullif(regexp_extract(clean, '\\b(?:19|20)[0-9]{{2}}\\b'), ''), '') AS year_found,
  CAST(ceil(length(clean) / 4.0) AS BIGINT) AS tokens, source_rows FROM s JOIN k USING (source)"""
)
def job_customer_intelligence(t):
    """Redact, filter actionable, classify and score, extract, aggregate, view with cost."""
    clean = written(t.texts.select("doc_id", "lang", "source", pii.redact(F.col("text")).alias("text"), (pii.redact(F.col("text")) != F.col("text")).alias("masked")), "clean")
    w = F.col("words")
    flagged = scoring.has_cue(w, _ABUSE) | F.col("masked") | scoring.has_cue(w, ["licensed", "license"])
    actionable = with_words(clean, "doc_id", "lang", "source", "masked").where(flagged)
    pos, neg = scoring.polarity(w, lx.SAMPLE_SENTIMENT)
    scored = actionable.select(
        "doc_id", "lang", "source", F.coalesce(scoring.best_label(w, lx.TOPIC_TERMS), F.lit("other")).alias("category"), scoring.sentiment_label(pos, neg).alias("sentiment"),
        F.regexp_extract("text", r"\b(?:19|20)[0-9]{2}\b", 0).alias("year_found"), F.ceil(F.length("text") / 4).alias("tokens"),
    )
    scored = written(scored, "scored")
    per_source = scored.groupBy("source").agg(F.count("*").alias("source_rows"))
    return scored.join(per_source, "source").select("doc_id", "lang", "source", "category", "sentiment", "year_found", "tokens", "source_rows")


@query()
def job_support_pipeline(t):
    """Message to reply record: sentiment, retrieval, label, payout, claim check, escalate flag."""
    # messages are looked up by a number of their own and joined back by it, so any length of conversation will do
    msgs = written(t.conversations.where("role = 'user'").withColumn("item_id", F.monotonically_increasing_id()), "messages")
    context = best_per_query(
        t.benchmark.select("item_id", hashed(F.col("text")).alias("embedding")).withColumnRenamed("item_id", "kb_id"), "kb_id",
        msgs.select("item_id", hashed(F.col("text")).alias("embedding")).where(F.size("embedding") > 0), "item_id", 1,
    ).select("item_id", "kb_id", "similarity")
    rows = msgs.join(context, "item_id").join(t.benchmark.select(F.col("item_id").alias("kb_id"), F.col("text").alias("evidence")), "kb_id")
    rows = rows.withColumn("answer", F.get(sentences(F.col("evidence")), F.lit(0)))
    checked = check_claims(rows, "answer", "evidence").withColumn("words", tokens(F.col("text")))
    pos, neg = scoring.polarity(F.col("words"), lx.SAMPLE_SENTIMENT)
    score = scoring.squash(pos + neg)
    amount = F.coalesce(F.get(numbers(F.col("text")), F.lit(0)).cast("double"), F.lit(0.0))
    payout = F.least(F.lit(100000.0), 0.8 * F.greatest(amount - 5000, F.lit(0.0)))
    reply = F.struct(F.col("answer").alias("answer"), F.col("kb_id").alias("source"), F.col("supported").alias("supported"), payout.alias("payout"))
    return checked.select(
        "conv_id", "turn", F.size("words").alias("n_words"), scoring.sentiment_label(pos, neg).alias("sentiment"),
        F.coalesce(scoring.best_label(F.col("words"), lx.TOPIC_TERMS), F.lit("other")).alias("category"), F.to_json(reply).alias("reply"),
        ((score < lx.ESCALATE_BELOW) | ~F.col("supported")).alias("escalate"),
    )


@query()
def job_ask_documents(t):
    """Parse pages, chunk, classify by the first chunk, index, search with a filter, build prompts."""
    from larkspan.functions.html import html_to_text

    parsed = written(t.pages.select("page_id", html_to_text(F.col("html")).alias("text")), "parsed")
    chunks = written(chunk_recursive(parsed, "page_id", "text", 1512, 256, PLAIN), "chunks")
    label = F.coalesce(scoring.best_label(tokens(F.col("chunk")), lx.TOPIC_TERMS), F.lit("other"))
    category = chunks.where("chunk_index = 0").select("page_id", label.alias("category"))
    named = chunks.join(category, "page_id").withColumn("chunk_id", F.concat_ws("/", "page_id", "chunk_index"))
    index = TextIndex(t.spark, scratch(t.spark, "chunks"), "chunk_id STRING, page_id BIGINT, category STRING, text STRING")
    add_batch(index, named.select("chunk_id", "page_id", "category", F.col("chunk").alias("text")), 0)
    hits = search(index, t.benchmark, "item_id", 3, F.col("category") != "other", ("page_id", "category", "text"))
    line = F.concat(F.lit("["), F.col("page_id"), F.lit(" / "), F.col("category"), F.lit("] "), F.col("text"))
    ordered = F.array_sort(F.collect_list(F.struct("rank", line.alias("line"))))
    ctx = hits.groupBy("item_id").agg(F.array_join(F.transform(ordered, lambda r: r["line"]), "\n").alias("context"), F.array_join(F.array_sort(F.collect_set(F.col("page_id").cast("string"))), ",").alias("sources"))
    return ctx.join(t.benchmark, "item_id").select("item_id", F.concat(F.lit("Context:\n"), "context", F.lit("\nQuestion: "), "text").alias("prompt"), "sources")


@query()
def job_graph_rag(t):
    """Extract, build the graph, detect communities, write reports, route and search.

    Every question is routed by the entities and theme cues it names. Global search maps it over the reports of all
    levels and reduces their points; local search ranks texts by the two hops around its own entity; a question of
    both kinds gets both, and its entity's heaviest links as follow-ups. `seed` is the entity with most links."""
    found, (_, pairs), asked = found_mentions(t), weighted_graph(t), routes(t)
    rows = lambda df, mode, subject, result, rank: df.select(F.lit(mode).alias("mode"), F.col(subject).cast("string").alias("subject"), F.col(result).cast("string").alias("result"), F.col(rank).cast("bigint").alias("rank"))
    points = tree_facts(t).select(name_id(F.col("community")).alias("community"), "fact", "is_cause")
    answer = rows(map_reduce(asked.where("route <> 'local'"), report_store(t), points, 25, 33, 3), "global", "item_id", "point", "rank")
    seeds = asked.where("seed IS NOT NULL").select("item_id", "seed", "route").distinct()
    near = rows(local_rankings(found, pairs, seeds, 5).join(seeds, "seed"), "local", "item_id", "doc_id", "position")
    corpus = local_ranking(found, graphs.khop(pairs, seed_node(pairs), 2), 5).withColumn("subject", F.lit("seed"))
    links = seeds.where("route = 'hybrid'").join(pairs, F.col("seed") == F.col("a"))
    follow = rows(top_n(links, ["item_id"], [F.desc("weight"), F.col("b")], 5, "rank"), "follow_up", "item_id", "b", "rank")
    routed = rows(asked.withColumn("rank", F.lit(1)), "route", "item_id", "route", "rank")
    homes = tree_of(t).where("level = 0").agg(F.countDistinct("community").alias("n"))  # the detected communities
    size = homes.select(F.lit("summary").alias("mode"), F.lit("communities").alias("subject"), F.col("n").cast("string").alias("result"), F.lit(1).cast("bigint").alias("rank"))
    return answer.unionByName(near).unionByName(rows(corpus, "local", "subject", "doc_id", "position")).unionByName(follow).unionByName(routed).unionByName(size)


@query(
    f"""
WITH {_BM25}, x AS (SELECT b.item_id, len(list_distinct({q.toks('b.text')})) AS required,
  (SELECT max(len(list_intersect(list_distinct({q.toks('b.text')}), {q.toks('d.text')}))) FROM lex JOIN documents d USING (doc_id) WHERE lex.item_id = b.item_id AND rank = 1) AS hit FROM benchmark b)
SELECT item_id, required, coalesce(hit, 0) AS with_retrieval, 0 AS direct, CASE WHEN coalesce(hit, 0) > 0 THEN 'retrieval' ELSE 'tie' END AS winner FROM x WHERE required > 0"""
)
def job_rag_vs_direct(t):
    """The same questions with retrieved evidence and with none."""
    cov = link_coverage(t, 1)
    return cov.select(
        "item_id", "required", F.col("lexical").alias("with_retrieval"), F.lit(0).alias("direct"), F.when(F.col("lexical") > 0, "retrieval").otherwise("tie").alias("winner")
    )


@query()
def job_call_quality(t):
    """Per call: aspect sentiments of all turns, topic, distinctive terms as the coaching note."""
    aspects = aspect_sentiment(t.conversations, ["conv_id", "turn"], lx.ASPECTS, lx.SAMPLE_SENTIMENT)
    names = ["overall", *lx.ASPECTS]
    negative = [F.count_if((F.col("aspect") == a) & (F.col("sentiment") == "negative")).alias(f"negative_{a}") for a in names]
    per_call = aspects.groupBy("conv_id").agg(F.countDistinct("turn").alias("turns"), *negative)
    topics = triage(with_words(t.conversations, "conv_id")).groupBy("conv_id", F.col("triage.category").alias("topic")).agg(F.count("*").alias("n"))
    topic = topics.groupBy("conv_id").agg(F.min(F.struct((-F.col("n")).alias("neg"), "topic"))["topic"].alias("topic"))
    note = distinctive_terms(t.conversations, "conv_id", F.array_distinct(tokens(F.col("text"))), 3, 1)
    ordered = F.array_sort(F.collect_list(F.struct("rank", "term")))
    notes = note.groupBy("conv_id").agg(F.array_join(F.transform(ordered, lambda r: r["term"]), ", ").alias("note"))
    return per_call.join(topic, "conv_id").join(notes, "conv_id", "left").select("conv_id", "turns", *[f"negative_{a}" for a in names], "topic", F.coalesce("note", F.lit("none")).alias("note"))
