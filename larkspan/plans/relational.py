"""Joins, sorting, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspan.functions.text import distinct_tokens
from larkspan.operators.setjoin import at_least
from larkspan.operators.skew import top_n
from larkspan.operators.textindex import stored_sets
from larkspan.operators.vectors import best_labels, label_centroids, pair_scores
from larkspan.registry import query
from larkspan.storage import written


@query(
    """
SELECT p_type, p_brand, count(*) AS lines, round(sum(l_quantity), 2) AS quantity,
       round(sum(l_extendedprice), 2) AS gross
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2"""
)
def join_inner_using(t):
    """Pre-aggregate the fact side by key, then enrich: the join moves one row per part."""
    per_part = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("q"), F.sum("l_extendedprice").alias("g")
    )
    rows = per_part.join(t.part.select("p_partkey", "p_type", "p_brand"), "p_partkey")
    return rows.groupBy("p_type", "p_brand").agg(
        F.sum("n").alias("lines"), F.round(F.sum("q"), 2).alias("quantity"), F.round(F.sum("g"), 2).alias("gross")
    )


@query(
    """
SELECT o.o_orderkey, c.c_mktsegment, n.n_name, coalesce(l.lines, 0) AS lines,
       round(coalesce(l.net, 0), 4) AS net, coalesce(r.returned, 0) AS returned
FROM orders o
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN (SELECT l_orderkey, count(*) AS lines, sum(l_extendedprice * (1 - l_discount)) AS net FROM lineitem GROUP BY 1) l
  ON l.l_orderkey = o.o_orderkey
LEFT JOIN (SELECT l_orderkey, count(*) AS returned FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) r
  ON r.l_orderkey = o.o_orderkey"""
)
def join_left_chain(t):
    """Base table with four left branches; both line branches come from one aggregation."""
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("lines"),
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
    )
    customer = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    nation = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    rows = (
        t.orders.select("o_orderkey", "o_custkey")
        .join(lines, "o_orderkey", "left")
        .join(customer, "o_custkey", "left")
        .join(nation, "c_nationkey", "left")
    )
    return rows.select(
        "o_orderkey", "c_mktsegment", "n_name",
        F.coalesce("lines", F.lit(0)).alias("lines"),
        F.round(F.coalesce("net", F.lit(0.0)), 4).alias("net"),
        F.coalesce("returned", F.lit(0)).alias("returned"),
    )


@query(
    """
SELECT r_name, p_type, round(sum(l_extendedprice * (1 - l_discount)), 4) AS net, count(*) AS lines
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
JOIN part ON l_partkey = p_partkey GROUP BY 1, 2"""
)
def join_star_relationships(t):
    from larkspan.plans.semantic_model import SALES
    from larkspan.plans.semantics import star

    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    joined = star(t, SALES, "lines", ["orders", "customers", "nations", "regions", "parts"])
    return joined.groupBy("r_name", "p_type").agg(F.round(F.sum(net), 4).alias("net"), F.count("*").alias("lines"))


CENTROIDS_SQL = """
cent AS (SELECT label AS c_label, list(m ORDER BY d) AS c_vec FROM (
  SELECT label, d, avg(CAST(embedding[d] AS DOUBLE)) AS m
  FROM embeddings, range(1, 65) AS g(d) GROUP BY 1, 2) GROUP BY 1)"""


@query(
    f"""
WITH {CENTROIDS_SQL},
s AS (SELECT vec_id, c_label, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), c_vec), 6) AS similarity FROM embeddings, cent),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY similarity DESC, c_label) AS rank FROM s)
SELECT vec_id, c_label AS candidate, similarity, rank FROM r WHERE rank <= 3"""
)
def join_cross_scored(t):
    """Every vector against the catalogue of label centroids, best three kept.

    Scoring and selection happen inside the row, so no pair reaches a shuffle."""
    best = best_labels(t.embeddings, label_centroids(t.embeddings), 3)
    return best.select("vec_id", F.col("label").alias("candidate"), "similarity", "rank")


@query(
    f"""
WITH {CENTROIDS_SQL}
SELECT a.c_label AS label_a, b.c_label AS label_b, round(list_cosine_similarity(a.c_vec, b.c_vec), 6) AS similarity
FROM cent a JOIN cent b ON a.c_label < b.c_label"""
)
def join_self_pairs(t):
    """Unordered pairs a < b of group vectors (one row per label, read from the whole table)."""
    return pair_scores(label_centroids(t.embeddings))


@query(
    """
WITH d AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '[\\p{L}0-9]+')) AS toks FROM documents),
b AS (SELECT item_id, list_distinct(regexp_extract_all(lower(text), '[\\p{L}0-9]+')) AS toks FROM benchmark),
rare AS (SELECT item_id, unnest(toks) AS tok FROM b),
dt AS (SELECT doc_id, unnest(toks) AS tok FROM d),
hit AS (SELECT item_id, doc_id, count(*) AS shared FROM rare JOIN dt USING (tok) GROUP BY 1, 2)
SELECT item_id, doc_id, shared FROM hit JOIN b USING (item_id) WHERE shared * 5 >= len(toks) * 3"""
)
def join_semantic_theta(t, min_fifths: int = 3):
    """`ON texts_overlap(a, b)` as a set join over the stored index: only an item's rarest words are join keys.

    A pair overlaps if the text holds three fifths of the item's distinct words, whatever their length."""
    item = t.benchmark.select("item_id", distinct_tokens(F.col("text")).alias("words"))
    item = item.withColumn("need", F.ceil(F.size("words") * min_fifths / 5))
    return at_least(item, "item_id", *stored_sets(t))


@query("SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def join_semi_new_docs(t):
    return t.documents.select("doc_id", "source").join(t.labels.select("doc_id"), "doc_id", "left_semi")


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def join_anti_missing(t):
    return t.documents.select("doc_id", "source").join(t.labels.select("doc_id"), "doc_id", "left_anti")


@query(
    r"""
WITH x AS (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS links FROM pages)
SELECT page_id, CAST(i - 1 AS INTEGER) AS link_index, links[i] AS link
FROM (SELECT page_id, links, unnest(range(1, len(links) + 1)) AS i FROM x)"""
)
def join_lateral_flatten(t):
    t.pages.createOrReplaceTempView("flatten_pages")
    return t.spark.sql(
        r"""SELECT page_id, f.pos AS link_index, f.col AS link FROM flatten_pages,
            LATERAL posexplode(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS f"""
    )


@query(
    """
SELECT d.doc_id, d.lang, l.quality, CASE WHEN l.doc_id IS NULL THEN 'unlabelled' ELSE 'labelled' END AS state
FROM documents d LEFT JOIN labels l USING (doc_id)"""
)
def join_lookup_concat(t):
    rows = t.documents.select("doc_id", "lang").join(t.labels.withColumn("hit", F.lit(1)), "doc_id", "left")
    return rows.select("doc_id", "lang", "quality", F.when(F.col("hit").isNull(), "unlabelled").otherwise("labelled").alias("state"))


@query(
    """
WITH s AS (SELECT conv_id, min(turn) AS first_turn, count(*) AS turns FROM conversations GROUP BY 1 HAVING count(*) >= 4)
SELECT m.conv_id, m.turn, m.role, s.turns FROM conversations m JOIN s USING (conv_id) WHERE m.role = 'user'"""
)
def join_message_session(t):
    sessions = t.conversations.groupBy("conv_id").agg(F.count("*").alias("turns")).where(F.col("turns") >= 4)
    mine = t.conversations.where(F.col("role") == "user").select("conv_id", "turn", "role")
    return mine.join(sessions, "conv_id")


# ---- sort, limit, top-k


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def topk_global(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query(
    """
(SELECT 'top' AS side, p_partkey, revenue FROM (SELECT l_partkey AS p_partkey, round(sum(l_extendedprice), 2) AS revenue
  FROM lineitem GROUP BY 1) ORDER BY revenue DESC, p_partkey LIMIT 5)
UNION ALL
(SELECT 'bottom' AS side, p_partkey, revenue FROM (SELECT l_partkey AS p_partkey, round(sum(l_extendedprice), 2) AS revenue
  FROM lineitem GROUP BY 1) ORDER BY revenue, p_partkey LIMIT 5)"""
)
def topk_bottom(t):
    revenue = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.round(F.sum("l_extendedprice"), 2).alias("revenue"))
    top = revenue.orderBy(F.desc("revenue"), "p_partkey").limit(5).withColumn("side", F.lit("top"))
    bottom = revenue.orderBy("revenue", "p_partkey").limit(5).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom).select("side", "p_partkey", "revenue")


@query(
    """
SELECT c_mktsegment, c_nationkey, customers, row_number() OVER (ORDER BY customers DESC, c_mktsegment, c_nationkey DESC) AS position
FROM (SELECT c_mktsegment, c_nationkey, count(*) AS customers FROM customer GROUP BY 1, 2)"""
)
def sort_multi_key(t):
    """Mixed-direction order of a small grouped result, exposed as a position."""
    grouped = t.customer.groupBy("c_mktsegment", "c_nationkey").agg(F.count("*").alias("customers"))
    order = Window.orderBy(F.desc("customers"), "c_mktsegment", F.desc("c_nationkey"))
    return grouped.withColumn("position", F.row_number().over(order).cast("bigint"))


# ---- set operations


@query(
    """
SELECT 'customer' AS party, c_custkey AS party_key, c_name AS name, c_acctbal AS balance FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal FROM supplier"""
)
def set_union_all(t):
    customers = t.customer.select(F.lit("customer").alias("party"), F.col("c_custkey").alias("party_key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    suppliers = t.supplier.select(F.lit("supplier").alias("party"), F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return customers.unionByName(suppliers)


@query("SELECT DISTINCT source, lang FROM documents")
def set_distinct(t):
    return t.documents.select("source", "lang").distinct()


@query(
    """
(SELECT 'both' AS kind, l_partkey AS partkey FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT 'both', l_partkey FROM lineitem WHERE l_returnflag = 'A')
UNION ALL
(SELECT 'only_returned' AS kind, l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45
 EXCEPT SELECT 'only_returned', l_partkey FROM lineitem WHERE l_returnflag = 'A' AND l_quantity > 45)"""
)
def set_intersect_except(t):
    part = F.col("l_partkey").alias("partkey")
    returned, accepted = t.lineitem.where("l_returnflag = 'R'"), t.lineitem.where("l_returnflag = 'A'")
    both = returned.select(part).intersect(accepted.select(part)).select(F.lit("both").alias("kind"), "partkey")
    big = F.col("l_quantity") > 45
    only = returned.where(big).select(part).subtract(accepted.where(big).select(part))
    return both.unionByName(only.select(F.lit("only_returned").alias("kind"), "partkey"))


@query(
    """
SELECT doc_id, lang, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'existing' ELSE 'appended' END AS origin FROM documents"""
)
def set_append_dedupe(t):
    """An index of labelled documents plus the records it does not hold yet."""
    docs = t.documents.select("doc_id", "lang")
    index = docs.join(t.labels.select("doc_id"), "doc_id", "left_semi").withColumn("origin", F.lit("existing"))
    index = written(index, "index")
    fresh = docs.join(index.select("doc_id"), "doc_id", "left_anti").dropDuplicates(["doc_id"])
    return index.unionByName(fresh.withColumn("origin", F.lit("appended")))
