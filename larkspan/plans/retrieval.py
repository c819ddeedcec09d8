"""Retrieval, prompts and conversation context."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspan import lexicons as lx
from larkspan.functions import scoring
from larkspan.functions import vectors as v
from larkspan.functions.text import tokens
from larkspan.operators.lsh import approximate_top_k
from larkspan.operators import textindex
from larkspan.operators.search import B, DIMS, K1, embed_sparse, fuse, hashed
from larkspan.operators.skew import last_k_before, top_n
from larkspan.operators.vectors import best_labels, best_per_query, best_per_row, label_centroids
from larkspan.plans import sqltext as q
from larkspan.plans.relational import CENTROIDS_SQL
from larkspan.plans.windows import HISTORY_SQL
from larkspan.registry import query
from larkspan.storage import written
from larkspan.tables import EMBEDDING_DIMS


def _bucket(w: str) -> str:
    return f"(('0x' || substr(md5({w}), 1, 8))::BIGINT % {DIMS})"


def _sparse(name: str, table: str, key: str) -> str:
    return (
        f"{name}_c AS (SELECT {key}, {_bucket('tok')} AS dim, count(*) AS tf FROM (SELECT {key}, unnest({q.toks('text')}) AS tok FROM {table}) GROUP BY 1, 2),\n"
        f"{name} AS MATERIALIZED (SELECT {key}, dim, tf / sqrt(sum(tf * tf) OVER (PARTITION BY {key})) AS w FROM {name}_c)"
    )


@query(f"WITH {_sparse('d', 'documents', 'doc_id')} SELECT doc_id, CAST(dim AS INTEGER) AS dim, round(w, 6) AS weight FROM d")
def embed_hashing(t):
    return embed_sparse(t.texts, "doc_id", "text").withColumn("weight", F.round("weight", 6))


_SCORED = f"""
WITH {CENTROIDS_SQL},
s AS (SELECT c_label, vec_id, label, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), c_vec), 6) AS similarity FROM embeddings, cent)"""


@query(f"""{_SCORED}, r AS (SELECT *, row_number() OVER (PARTITION BY c_label ORDER BY similarity DESC, vec_id) AS rank FROM s)
SELECT c_label AS query_id, vec_id, similarity, rank FROM r WHERE rank <= 10""")
def search_vector_topk(t):
    best = best_per_query(t.embeddings, "vec_id", label_centroids(t.embeddings), "label", 10)
    return best.select(F.col("label").cast("int").alias("query_id"), "vec_id", "similarity", "rank")


@query(f"""{_SCORED}, r AS (SELECT *, row_number() OVER (PARTITION BY c_label ORDER BY similarity DESC, vec_id) AS rank FROM s WHERE label = 3)
SELECT c_label AS query_id, vec_id, similarity, rank FROM r WHERE rank <= 5""")
def search_filtered(t):
    """The attribute filter is applied in the scan, before any scoring."""
    corpus = t.embeddings.where(F.col("label") == 3)
    best = best_per_query(corpus, "vec_id", label_centroids(t.embeddings), "label", 5)
    return best.select(F.col("label").cast("int").alias("query_id"), "vec_id", "similarity", "rank")


_TERMS = q.toks
_BM25 = f"""
qt AS (SELECT item_id, unnest(list_distinct({_TERMS('text')})) AS term FROM benchmark),
body AS MATERIALIZED (SELECT doc_id, {_TERMS('text')} AS ws FROM documents),
st AS (SELECT count(*) AS n, avg(len(ws)) AS avg_len FROM body),
po AS MATERIALIZED (SELECT doc_id, len, term, count(*) AS tf FROM (SELECT doc_id, len(ws) AS len, unnest(ws) AS term FROM body) WHERE term IN (SELECT term FROM qt) GROUP BY 1, 2, 3),
dfs AS (SELECT term, count(*) AS df FROM po GROUP BY 1),
sc AS (SELECT item_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * {K1 + 1} / (tf + {K1} * (1 - {B} + {B} * len / avg_len))), 6) AS score
  FROM po JOIN dfs USING (term) JOIN qt USING (term), st GROUP BY 1, 2),
lex AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM sc)"""


@query(f"WITH {_BM25} SELECT item_id, doc_id, score, rank FROM lex WHERE rank <= 10")
def search_lexical_bm25(t):
    return lexical_top(t, 10)


def lexical_top(t, k: int, where=None, show=()):
    """The k best documents of each question, from the stored index."""
    return textindex.search(textindex.index_of(t), t.benchmark, "item_id", k, where, show)


def with_documents(t, hits, *columns):
    """Hits with columns of their documents. The hits are stored first, so that their size is known: few hits go to
    the documents, which are read in place and neither spread nor shuffled."""
    return written(hits, "hits").join(t.documents.select("doc_id", *columns), "doc_id")


def hashed_table(df, key: str):
    return df.select(key, hashed(F.col("text")).alias("embedding")).where(F.size("embedding") > 0)


def hashed_top(t, k: int, where=None):
    """The k nearest documents by hashed words, which the stored index holds."""
    stored = textindex.index_of(t).docs()
    stored = stored if where is None else stored.where(where)
    corpus = stored.select("doc_id", F.col("buckets").alias("embedding")).where(F.size("embedding") > 0)
    return best_per_query(corpus, "doc_id", hashed_table(t.benchmark, "item_id"), "item_id", k)


_VEC = f"""
{_sparse('d', 'documents', 'doc_id')}, {_sparse('b', 'benchmark', 'item_id')},
vs AS (SELECT item_id, doc_id, round(sum(d.w * b.w), 6) AS similarity FROM d JOIN b USING (dim) GROUP BY 1, 2),
vec AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY similarity DESC, doc_id) AS rank FROM vs)"""


@query(
    f"""
WITH {_BM25}, {_VEC},
u AS (SELECT item_id, doc_id, rank FROM lex WHERE rank <= 50 UNION ALL SELECT item_id, doc_id, rank FROM vec WHERE rank <= 50),
f AS (SELECT item_id, doc_id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS rrf, count(*) AS lists FROM u GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY rrf DESC, doc_id) AS rank FROM f)
SELECT * FROM r WHERE rank <= 10"""
)
def search_hybrid_rrf(t):
    return fuse([lexical_top(t, 50), hashed_top(t, 50)], "item_id", "doc_id", 10)


_SOURCES = ("src1", "src2", "src3")
_FILTER = f"lang = 'en' AND source IN {q.in_list(_SOURCES)}"


@query(
    f"""WITH {_BM25}, f AS (SELECT l.item_id, l.doc_id, l.score, d.lang, d.source, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM sc l JOIN documents d USING (doc_id) WHERE {_FILTER})
SELECT * FROM f WHERE rank <= 10"""
)
def search_lexical_filtered(t):
    """Lexical search among documents of some attributes, which are shown with the hits."""
    return lexical_top(t, 10, F.expr(_FILTER), ("lang", "source"))


@query(
    f"""WITH {_BM25}, {_VEC},
lf AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM sc JOIN documents USING (doc_id) WHERE {_FILTER}),
vf AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY similarity DESC, doc_id) AS rank FROM vs JOIN documents USING (doc_id) WHERE {_FILTER}),
u AS (SELECT * FROM lf WHERE rank <= 50 UNION ALL SELECT * FROM vf WHERE rank <= 50),
f AS (SELECT item_id, doc_id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS rrf, count(*) AS lists FROM u GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY rrf DESC, doc_id) AS rank FROM f)
SELECT item_id, doc_id, rrf, lists, rank, source FROM r JOIN documents USING (doc_id) WHERE rank <= 10"""
)
def search_hybrid_filtered(t):
    """Both legs of the hybrid search see only the documents that the filter lets through."""
    where = F.expr(_FILTER)
    hits = fuse([lexical_top(t, 50, where), hashed_top(t, 50, where)], "item_id", "doc_id", 10)
    return hits.join(textindex.index_of(t).docs().select("doc_id", "source"), "doc_id")


def coverage(query_words, text_words):
    """Share of query words whose 5-letter prefix starts a word of the text."""
    from larkspan.functions.text import let

    def share(x):
        hit = F.filter(x["q"], lambda w: F.array_contains(x["begun"], F.substring(w, 1, scoring.START)))
        return F.size(hit) / F.greatest(F.size(x["q"]), F.lit(1))

    return let(F.struct(query_words.alias("q"), scoring.begun(query_words, text_words).alias("begun")), share)


@query(
    f"""
WITH {_VEC},
w AS (SELECT item_id, doc_id, similarity, {q.claim_words('b.text')} AS qw, list_distinct({q.claim_words('x.text')}) AS dw
  FROM (SELECT * FROM vec WHERE rank <= 8) JOIN benchmark b USING (item_id) JOIN documents x USING (doc_id)),
c AS (SELECT item_id, doc_id, similarity, round(len(list_filter(qw, lambda w: len(list_filter(dw, lambda e: starts_with(e, left(w, 5)))) > 0)) / greatest(len(qw), 1), 6) AS coverage FROM w),
s AS (SELECT *, round(0.5 * similarity + 0.5 * coverage, 7) AS score FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s)
SELECT * FROM r WHERE rank <= 3"""
)
def search_rerank(t, wide: int = 8, keep: int = 3):
    """Retrieve wide by cosine, rescore the few survivors with term coverage."""
    first = hashed_top(t, wide).drop("rank")
    rows = with_documents(t, first.join(t.benchmark.select("item_id", F.col("text").alias("qt")), "item_id"), F.col("text").alias("dt"))
    cov = F.round(coverage(scoring.claim_words(F.col("qt")), F.array_distinct(scoring.claim_words(F.col("dt")))), 6)
    scored = rows.select("item_id", "doc_id", "similarity", cov.alias("coverage"))
    scored = scored.withColumn("score", F.round(0.5 * F.col("similarity") + 0.5 * F.col("coverage"), 7))  # half of six decimals: no ties
    out = top_n(scored, ["item_id"], [F.desc("score"), F.col("doc_id")], keep, "rank")
    return out.withColumn("rank", F.col("rank").cast("bigint"))


@query()
def search_lsh_ann(t, k: int = 10):
    """Bucketed search and, per hit, whether brute force would return it too."""
    cent = label_centroids(t.embeddings)
    found = approximate_top_k(t.embeddings, "vec_id", cent, "label", k, EMBEDDING_DIMS)
    exact = best_per_query(t.embeddings, "vec_id", cent, "label", k).select("label", "vec_id", F.lit(True).alias("in_exact"))
    joined = found.join(exact, ["label", "vec_id"], "left")
    return joined.select("label", "vec_id", "similarity", F.col("rank").cast("bigint").alias("rank"), F.coalesce("in_exact", F.lit(False)).alias("in_exact"))


@query(f"""{_SCORED}, r AS (SELECT *, row_number() OVER (PARTITION BY c_label ORDER BY similarity DESC, vec_id) AS rank FROM s)
SELECT c_label AS query_id, CAST(vec_id // 10 AS BIGINT) AS file_id, CAST(vec_id % 10 AS BIGINT) AS segment, CAST(vec_id % 10 * 30 AS BIGINT) AS start_second,
       CAST(vec_id % 10 * 30 + 30 AS BIGINT) AS end_second, similarity, rank FROM r WHERE rank <= 5""")
def search_multimodal_segments(t):
    """Segments (file, number, start, end) found by their vectors."""
    best = best_per_query(t.embeddings, "vec_id", label_centroids(t.embeddings), "label", 5)
    seg = F.col("vec_id") % 10
    return best.select(
        F.col("label").cast("int").alias("query_id"), F.floor(F.col("vec_id") / 10).alias("file_id"), seg.alias("segment"),
        (seg * 30).alias("start_second"), (seg * 30 + 30).alias("end_second"), "similarity", "rank",
    )


@query(f"""{_SCORED}, r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY similarity DESC, c_label) AS rn FROM s)
SELECT vec_id, c_label AS closest_theme, similarity FROM r WHERE rn = 1""")
def closest_theme(t):
    best = best_labels(t.embeddings, label_centroids(t.embeddings), 1)
    return best.select("vec_id", F.col("label").cast("int").alias("closest_theme"), "similarity")


@query(
    """
SELECT a.vec_id AS left_id, b.vec_id AS right_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS score
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"""
)
def pairwise_similarity(t):
    """Similarity of given pairs (here each vector and the next one), from stored vectors."""
    a = t.embeddings.select(F.col("vec_id").alias("left_id"), F.col("embedding").alias("x"), (F.col("vec_id") + 1).alias("right_id"))
    b = t.embeddings.select(F.col("vec_id").alias("right_id"), F.col("embedding").alias("y"))
    return a.join(b, "right_id").select("left_id", "right_id", F.round(v.cosine(F.col("x"), F.col("y")), 6).alias("score"))


@query(
    f"""{_SCORED},
ex AS (SELECT vec_id, label FROM (SELECT *, row_number() OVER (PARTITION BY c_label ORDER BY similarity DESC, vec_id) AS rn FROM s) WHERE rn <= 5 AND label = c_label),
x AS (SELECT DISTINCT e.vec_id, e.label, m.embedding FROM ex e JOIN embeddings m USING (vec_id)),
p AS (SELECT a.vec_id, a.label AS truth, x.vec_id AS example, x.label, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(x.embedding AS DOUBLE[])), 6) AS similarity
  FROM embeddings a JOIN x ON x.vec_id <> a.vec_id),
k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY similarity DESC, example) AS rn FROM p),
g AS (SELECT vec_id, truth, label, count(*) AS n, max(similarity) AS s FROM k WHERE rn <= 3 GROUP BY 1, 2, 3)
SELECT vec_id, CAST(arg_min(label, (-n, -s, label)) AS INTEGER) AS vote, CAST(max(n) AS BIGINT) AS votes, arg_min(label, (-n, -s, label)) = truth AS correct FROM g GROUP BY vec_id, truth"""
)
def fewshot_retrieval(t):
    """Three nearest examples per request, majority label, leave-one-out accuracy.

    The example bank holds the five vectors nearest to each label's centroid."""
    emb = t.embeddings
    near = best_per_query(emb, "vec_id", label_centroids(emb), "label", 5).select("vec_id", F.col("label").alias("theme"))
    bank = emb.join(near, "vec_id").where(F.col("theme") == F.col("label")).select(F.col("vec_id").alias("example"), "embedding", F.col("label").alias("vote")).dropDuplicates(["example"])
    best = best_per_row(emb, "vec_id", bank, "example", 4)  # one spare: a row may meet itself
    best = top_n(best.where(F.col("vec_id") != F.col("example")).drop("rank"), ["vec_id"], [F.desc("similarity"), F.col("example")], 3)
    votes = best.join(bank.select("example", "vote"), "example").groupBy("vec_id", "vote").agg(F.count("*").alias("n"), F.max("similarity").alias("s"))
    pick = votes.groupBy("vec_id").agg(F.min(F.struct((-F.col("n")).alias("n"), (-F.col("s")).alias("s"), "vote")).alias("p"))
    rows = pick.join(emb.select("vec_id", "label"), "vec_id")
    return rows.select("vec_id", F.col("p.vote").alias("vote"), (-F.col("p.n")).alias("votes"), (F.col("p.vote") == F.col("label")).alias("correct"))


def top_context(t, k: int = 3):
    return lexical_top(t, k)


@query(
    f"""
WITH {_BM25}, c AS (SELECT item_id, rank, '[' || doc_id || ' / ' || source || '] ' || text AS line FROM lex JOIN documents USING (doc_id) WHERE rank <= 3)
SELECT b.item_id, 'Context:' || chr(10) || string_agg(line, chr(10) ORDER BY rank) || chr(10) || 'Question: ' || any_value(b.text) AS prompt
FROM c JOIN benchmark b USING (item_id) GROUP BY 1"""
)
def prompt_assembly(t):
    """One prompt per question: ranked context lines, then the question."""
    line = F.concat(F.lit("["), F.col("doc_id"), F.lit(" / "), F.col("source"), F.lit("] "), F.col("text"))
    rows = with_documents(t, top_context(t), "source", "text").select("item_id", "rank", line.alias("line"))
    ordered = F.array_sort(F.collect_list(F.struct("rank", "line")))
    ctx = rows.groupBy("item_id").agg(F.array_join(F.transform(ordered, lambda r: r["line"]), "\n").alias("ctx"))
    full = ctx.join(t.benchmark, "item_id")
    return full.select("item_id", F.concat(F.lit("Context:\n"), "ctx", F.lit("\nQuestion: "), "text").alias("prompt"))


@query(
    f"""
WITH {_BM25} SELECT item_id, string_agg(DISTINCT source, ',' ORDER BY source) AS sources, string_agg(CAST(doc_id AS VARCHAR) || ':' || CAST(rank AS VARCHAR), ',' ORDER BY rank) AS cited
FROM lex JOIN documents USING (doc_id) WHERE rank <= 5 GROUP BY 1"""
)
def provenance_citations(t):
    rows = with_documents(t, top_context(t, 5), "source")
    cite = F.concat_ws(":", F.col("doc_id").cast("string"), F.col("rank").cast("string"))
    ordered = F.array_sort(F.collect_list(F.struct("rank", cite.alias("c"))))
    return rows.groupBy("item_id").agg(
        F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"), F.array_join(F.transform(ordered, lambda r: r["c"]), ",").alias("cited")
    )


@query(
    f"""
WITH h AS ({HISTORY_SQL}),
w AS (SELECT conv_id, turn, unnest({q.toks('history')}) AS term FROM h),
tf AS (SELECT conv_id, turn, term, count(*) AS tf FROM w GROUP BY 1, 2, 3),
dfs AS (SELECT term, count(*) AS df FROM (SELECT DISTINCT conv_id, turn, unnest({q.toks('text')}) AS term FROM conversations) GROUP BY 1),
n AS (SELECT count(*) AS n FROM conversations),
s AS (SELECT conv_id, turn, term, round(tf * ln(n / df), 6) AS score FROM tf JOIN dfs USING (term), n),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY score DESC, term) AS rn FROM s)
SELECT c.conv_id, c.turn, c.text || ' ' || string_agg(term, ' ' ORDER BY rn) AS standalone FROM r JOIN conversations c USING (conv_id, turn)
WHERE rn <= 3 AND c.role = 'user' GROUP BY 1, 2, c.text"""
)
def query_rewrite_history(t):
    """A follow-up question extended by the three strongest terms of the six messages before it."""
    term_list = tokens
    conv = t.conversations
    hist = last_k_before(conv, "conv_id", "turn", F.col("text"), 6, 100_000).where("role = 'user'")
    terms = hist.select("conv_id", "turn", F.explode(F.flatten(F.transform("history", term_list))).alias("term"))
    tf = terms.groupBy("conv_id", "turn", "term").agg(F.count("*").alias("tf"))
    dfs = conv.select(F.explode(F.array_distinct(term_list(F.col("text")))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    n = conv.agg(F.count("*").alias("n"))
    scored = tf.join(dfs, "term").join(F.broadcast(n)).withColumn("score", F.round(F.col("tf") * F.log(F.col("n") / F.col("df")), 6))
    best = top_n(scored, ["conv_id", "turn"], [F.desc("score"), F.col("term")], 3)
    ordered = F.array_sort(F.collect_list(F.struct("rn", "term")))
    extra = best.groupBy("conv_id", "turn").agg(F.array_join(F.transform(ordered, lambda r: r["term"]), " ").alias("extra"))
    return extra.join(conv, ["conv_id", "turn"]).select("conv_id", "turn", F.concat("text", F.lit(" "), "extra").alias("standalone"))


@query(
    """
SELECT conv_id, count(*) AS messages, CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) AS BIGINT) AS questions,
       round(avg(CASE WHEN role = 'assistant' THEN length(text) END), 4) AS mean_answer_chars, arg_max(text, CASE WHEN role = 'user' THEN turn END) AS last_question,
       count(DISTINCT role) AS roles FROM conversations GROUP BY 1"""
)
def chat_session_analytics(t):
    user, length = F.col("role") == "user", F.length("text")
    return t.conversations.groupBy("conv_id").agg(
        F.count("*").alias("messages"), F.count_if(user).alias("questions"),
        F.round(F.avg(F.when(F.col("role") == "assistant", length)), 4).alias("mean_answer_chars"),
        F.max_by("text", F.when(user, F.col("turn"))).alias("last_question"), F.size(F.collect_set("role")).cast("bigint").alias("roles"),
    )


_INTENT = " ".join(f"WHEN {q.has(q.toks('text'), terms)} THEN '{name}'" for _, name, terms in sorted(lx.INTENTS))


@query(
    f"""
SELECT conv_id, turn, CASE {_INTENT} ELSE 'help' END AS intent, {q.has(q.toks('text'), lx.INTENTS[3][2])} AS wants_local, {q.has(q.toks('text'), lx.INTENTS[2][2])} AS wants_global
FROM conversations WHERE role = 'user'"""
)
def intent_router(t):
    """Ordered rules, first match wins; two more flags choose local or global search."""
    rows = t.conversations.where("role = 'user'").select("conv_id", "turn", tokens(F.col("text")).alias("w"))
    intent = F.lit("help")
    for _, name, terms in sorted(lx.INTENTS, reverse=True):
        intent = F.when(scoring.has_cue(F.col("w"), terms), name).otherwise(intent)
    return rows.select(
        "conv_id", "turn", intent.alias("intent"), scoring.has_cue(F.col("w"), lx.INTENTS[3][2]).alias("wants_local"), scoring.has_cue(F.col("w"), lx.INTENTS[2][2]).alias("wants_global")
    )


@query(
    """
SELECT event_type, count(*) FILTER (ts <= TIMESTAMP '2024-01-15') AS at_cutoff, count(*) AS after_append,
       round(max(value) FILTER (ts <= TIMESTAMP '2024-01-15'), 2) AS best_at_cutoff, round(max(value), 2) AS best_after FROM events GROUP BY 1"""
)
def knowledge_cutoff(t, cutoff: str = "2024-01-15"):
    """The same question on the index at a cutoff and after later records arrive."""
    early = F.col("ts") <= F.lit(cutoff).cast("timestamp_ntz")
    return t.events.groupBy("event_type").agg(
        F.count_if(early).alias("at_cutoff"), F.count("*").alias("after_append"),
        F.round(F.max(F.when(early, F.col("value"))), 2).alias("best_at_cutoff"), F.round(F.max("value"), 2).alias("best_after"),
    )
