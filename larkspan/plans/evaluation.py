"""Evaluation of retrieval, answers, latency and routing."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspan import lexicons as lx
from larkspan.functions import scoring
from larkspan.functions.text import sentences, tokens
from larkspan.operators import textindex
from larkspan.operators.skew import exact_quantiles
from larkspan.operators.vectors import best_labels, best_per_query, label_centroids
from larkspan.plans import sqltext as q
from larkspan.plans.relational import CENTROIDS_SQL
from larkspan.plans.retrieval import _BM25, _TERMS, _VEC, coverage, hashed_top, lexical_top, with_documents
from larkspan.plans.textual import check_claims
from larkspan.registry import query

_RANKED = f"""
WITH {CENTROIDS_SQL},
s AS (SELECT c_label, vec_id, label, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), c_vec), 6) AS similarity FROM embeddings, cent),
r AS (SELECT *, row_number() OVER (PARTITION BY c_label ORDER BY similarity DESC, vec_id) AS n FROM s)"""


@query(
    f"""{_RANKED}, tot AS (SELECT label AS c_label, count(*) AS total FROM embeddings GROUP BY 1),
h AS (SELECT c_label, n, sum(CASE WHEN label = c_label THEN 1 ELSE 0 END) OVER (PARTITION BY c_label ORDER BY n) AS hits FROM r WHERE n <= 10)
SELECT c_label AS query_id, n, round(hits / n, 6) AS precision_at_n, round(hits / total, 6) AS recall_at_n FROM h JOIN tot USING (c_label)"""
)
def eval_precision_recall_at_n(t, depth: int = 10):
    """Label centroids as questions; a hit of the same label is relevant."""
    ranked = best_per_query(t.embeddings, "vec_id", label_centroids(t.embeddings), "label", depth).withColumnRenamed("label", "query_id")
    rows = ranked.join(t.embeddings.select("vec_id", "label"), "vec_id")
    w = Window.partitionBy("query_id").orderBy("rank")  # `depth` rows per question
    hits = F.sum(F.when(F.col("label") == F.col("query_id"), 1).otherwise(0)).over(w)
    total = t.embeddings.groupBy(F.col("label").alias("query_id")).agg(F.count("*").alias("total"))
    out = rows.withColumn("hits", hits).join(total, "query_id")
    return precision_recall(out)


def precision_recall(df):
    return df.select(
        F.col("query_id").cast("int").alias("query_id"), F.col("rank").alias("n"), F.round(F.col("hits") / F.col("rank"), 6).alias("precision_at_n"), F.round(F.col("hits") / F.col("total"), 6).alias("recall_at_n")
    )


@query(
    f"""
WITH {_BM25}, {_VEC},
x AS (SELECT b.item_id, min(d.doc_id) AS expected FROM benchmark b JOIN documents d ON contains(d.text, b.text) WHERE len({_TERMS('b.text')}) > 2 GROUP BY 1),
r AS (SELECT x.item_id, l.rank FROM x LEFT JOIN lex l ON l.item_id = x.item_id AND l.doc_id = x.expected AND l.rank <= 10)
SELECT count(*) AS questions, round(avg(CASE WHEN rank <= 1 THEN 1 ELSE 0 END), 6) AS hit_at_1, round(avg(CASE WHEN rank <= 3 THEN 1 ELSE 0 END), 6) AS hit_at_3, round(avg(coalesce(1.0::DOUBLE / rank, 0)), 6) AS mrr FROM r"""
)
def eval_hit_mrr(t):
    """The expected text is the first of all texts that hold the passage verbatim; candidates share its rarest inner word."""
    wide = textindex.holding(textindex.index_of(t), t.benchmark, "item_id")
    full = with_documents(t, wide, F.col("text").alias("dt")).join(t.benchmark.select("item_id", F.col("text").alias("bt")), "item_id")
    expected = full.where(F.col("dt").contains(F.col("bt"))).groupBy("item_id").agg(F.min("doc_id").alias("doc_id"))
    ranks = expected.join(lexical_top(t, 10), ["item_id", "doc_id"], "left")
    at = lambda k: F.round(F.avg(F.when(F.col("rank") <= k, 1).otherwise(0)), 6)
    return ranks.agg(F.count("*").alias("questions"), at(1).alias("hit_at_1"), at(3).alias("hit_at_3"), F.round(F.avg(F.coalesce(1.0 / F.col("rank"), F.lit(0.0))), 6).alias("mrr"))


@query(
    f"""
WITH p AS (SELECT u.turn, u.text AS question, a.text AS answer FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant'),
s AS (SELECT turn, len({q.toks('answer')}) < 5 AS abstained, len(list_intersect({q.toks('question')}, {q.toks('answer')})) > 0 AS correct FROM p)
SELECT turn, count(*) AS answers, round(avg(CASE WHEN correct THEN 1 ELSE 0 END), 6) AS accuracy, round(avg(CASE WHEN abstained THEN 1 ELSE 0 END), 6) AS abstention FROM s GROUP BY 1"""
)
def eval_answer_accuracy(t):
    """An answer is correct if it takes up a keyword of the question before it."""
    u = t.conversations.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    a = t.conversations.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    p = u.join(a, ["conv_id", "turn"])
    keys = tokens(F.col("question"))
    s = p.select("turn", (F.size(tokens(F.col("answer"))) < 5).alias("abstained"), F.arrays_overlap(keys, tokens(F.col("answer"))).alias("correct"))
    share = lambda c: F.round(F.avg(F.when(F.col(c), 1).otherwise(0)), 6)
    return s.groupBy("turn").agg(F.count("*").alias("answers"), share("correct").alias("accuracy"), share("abstained").alias("abstention"))


@query(
    """
WITH e AS (SELECT event_type, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 1 ELSE 2 END AS run, value FROM events),
g AS (SELECT event_type, run, quantile_cont(value, 0.5) AS p50, avg(value) AS mean, quantile_cont(value, 0.9) AS p90, max(value) AS slowest FROM e GROUP BY 1, 2)
SELECT a.event_type, round(a.p50, 6) AS p50_run1, round(b.p50, 6) AS p50_run2, round(a.mean, 6) AS mean_run1, round(b.mean, 6) AS mean_run2, round(a.p90, 6) AS p90_run1, round(b.p90, 6) AS p90_run2,
  a.slowest AS max_run1, b.slowest AS max_run2 FROM g a JOIN g b ON a.event_type = b.event_type AND a.run = 1 AND b.run = 2"""
)
def eval_latency_table(t):
    run = F.when(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"), 1).otherwise(2)
    e = t.events.select("event_type", run.alias("run"), "value")
    quant = exact_quantiles(e, ["event_type", "run"], "value", {"p50": 0.5, "p90": 0.9})
    rest = e.groupBy("event_type", "run").agg(F.avg("value").alias("mean"), F.max("value").alias("slowest"))
    g = quant.join(rest, ["event_type", "run"])
    pick = lambda c, r, n: F.round(F.max(F.when(F.col("run") == r, F.col(c))), 6).alias(n)
    cols = [pick(c, r, f"{n}_run{r}") for c, n in (("p50", "p50"), ("mean", "mean"), ("p90", "p90"), ("slowest", "max")) for r in (1, 2)]
    return g.groupBy("event_type").agg(*cols)


_PREFIX = lambda a, b: f"len(list_filter({a}, lambda w: len(list_filter({b}, lambda e: starts_with(e, left(w, 5)))) > 0)) / greatest(len({a}), 1)"


@query(
    f"""
WITH {_BM25}, an AS (SELECT doc_id, array_to_string({q.sents('text')}[1:2], ' ') AS answer FROM documents), x AS (SELECT item_id, {q.claim_words('b.text')} AS qw, list_distinct({q.claim_words('d.text')}) AS cw, list_distinct({q.claim_words('an.answer')}) AS aw, {q.claim_words('an.answer')} AS al,
  len(list_filter({q.numbers('an.answer')}, lambda n: NOT list_contains({q.numbers('d.text')}, n))) AS missing
  FROM lex JOIN benchmark b USING (item_id) JOIN documents d USING (doc_id) JOIN an USING (doc_id) WHERE rank = 1)
SELECT item_id, round({_PREFIX('qw', 'aw')}, 6) AS answer_relevance, round({_PREFIX('qw', 'cw')}, 6) AS context_relevance,
  CASE WHEN missing = 0 AND round({q.covered('al', 'cw')}, 6) >= 0.5 THEN 1 ELSE 0 END AS groundedness FROM x"""
)
def eval_rag_triad(t):
    """Answer = the first two sentences of the best text, context = the text itself."""
    best = lexical_top(t, 1).select("item_id", "doc_id")
    rows = with_documents(t, best.join(t.benchmark.select("item_id", F.col("text").alias("question")), "item_id"), F.col("text").alias("context"))
    rows = check_claims(rows.withColumn("answer", F.array_join(F.slice(sentences(F.col("context")), 1, 2), " ")), "answer", "context")
    words = lambda c: scoring.claim_words(F.col(c))
    return rows.select(
        "item_id",
        F.round(coverage(words("question"), F.array_distinct(words("answer"))), 6).alias("answer_relevance"),
        F.round(coverage(words("question"), F.array_distinct(words("context"))), 6).alias("context_relevance"),
        F.col("supported").cast("int").alias("groundedness"),
    )


_LINKS = f"""
WITH {_BM25}, {_VEC},
need AS (SELECT item_id, unnest(list_distinct({q.toks('text')})) AS fact FROM benchmark),
got AS (SELECT DISTINCT 'lexical' AS method, item_id, unnest(list_distinct({q.toks('text')})) AS fact FROM lex JOIN documents USING (doc_id) WHERE rank <= 3
  UNION SELECT DISTINCT 'vector', item_id, unnest(list_distinct({q.toks('text')})) FROM vec JOIN documents USING (doc_id) WHERE rank <= 3),
cov AS (SELECT n.item_id, count(DISTINCT n.fact) AS required, count(DISTINCT CASE WHEN method = 'lexical' THEN n.fact END) AS lexical, count(DISTINCT CASE WHEN method = 'vector' THEN n.fact END) AS vector
  FROM need n LEFT JOIN got g ON g.item_id = n.item_id AND g.fact = n.fact GROUP BY 1)"""


def link_coverage(t, k: int = 3):
    """(item_id, required, lexical, vector): required words found by each method."""
    need = t.benchmark.select("item_id", F.explode(F.array_distinct(tokens(F.col("text")))).alias("fact"))
    lists = {"lexical": lexical_top(t, k), "vector": hashed_top(t, k)}
    hits = None
    for name, ranked in lists.items():
        part = ranked.select("item_id", "doc_id", F.lit(name).alias("method"))
        hits = part if hits is None else hits.unionByName(part)
    words = with_documents(t, hits, "text").select("item_id", "method", F.explode(F.array_distinct(tokens(F.col("text")))).alias("fact")).distinct()
    joined = need.join(words, ["item_id", "fact"], "left")
    per_fact = joined.groupBy("item_id", "fact").agg(*[F.max(F.when(F.col("method") == m, 1).otherwise(0)).alias(m) for m in lists])
    return per_fact.groupBy("item_id").agg(F.count("*").alias("required"), *[F.sum(m).alias(m) for m in lists])


@query(f"{_LINKS} SELECT item_id, required, lexical, vector FROM cov")
def eval_link_coverage(t):
    return link_coverage(t)


@query(
    f"""{_LINKS}, w AS (SELECT CASE WHEN lexical > vector THEN 'lexical' WHEN vector > lexical THEN 'vector' ELSE 'tie' END AS winner FROM cov)
SELECT winner, count(*) AS items, round(100 * count(*) / (SELECT count(*) FROM w), 4) AS rate_pct FROM w GROUP BY 1"""
)
def eval_head_to_head(t):
    winner = F.when(F.col("lexical") > F.col("vector"), "lexical").when(F.col("vector") > F.col("lexical"), "vector").otherwise("tie")
    g = link_coverage(t).groupBy(winner.alias("winner")).agg(F.count("*").alias("items"))
    total = F.sum("items").over(Window.partitionBy())  # three rows at most
    return g.withColumn("rate_pct", F.round(100 * F.col("items") / total, 4))


@query(
    f"""{_RANKED.replace('PARTITION BY c_label ORDER BY similarity DESC, vec_id', 'PARTITION BY vec_id ORDER BY similarity DESC, c_label')}
SELECT label, count(*) AS requests, round(avg(CASE WHEN c_label = label THEN 1 ELSE 0 END), 6) AS accuracy FROM r WHERE n = 1 GROUP BY 1"""
)
def eval_router_accuracy(t):
    best = best_labels(t.embeddings, label_centroids(t.embeddings), 1).select("vec_id", F.col("label").alias("routed"))
    rows = best.join(t.embeddings.select("vec_id", "label"), "vec_id")
    return rows.groupBy("label").agg(F.count("*").alias("requests"), F.round(F.avg(F.when(F.col("routed") == F.col("label"), 1).otherwise(0)), 6).alias("accuracy"))


_LANGS = {k: {w: 1.0 for w in v} for k, v in lx.LANGUAGE_PROFILES.items()}


@query(
    f"""
WITH p AS (SELECT lang, {q.labels(q.toks('text'), _LANGS)}[1].label AS predicted FROM documents)
SELECT lang, count(*) AS processed, CAST(sum(CASE WHEN predicted IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS skipped, round(avg(CASE WHEN predicted = lang THEN 1 ELSE 0 END), 6) AS accuracy FROM p GROUP BY 1"""
)
def eval_fit_for_purpose(t):
    """Processed, skipped and rightly classified texts per language."""
    p = t.texts.select("lang", tokens(F.col("text")).alias("w")).select("lang", scoring.best_label(F.col("w"), _LANGS).alias("predicted"))
    return p.groupBy("lang").agg(
        F.count("*").alias("processed"), F.count_if(F.col("predicted").isNull()).alias("skipped"), F.round(F.avg(F.when(F.col("predicted") == F.col("lang"), 1).otherwise(0)), 6).alias("accuracy")
    )
