"""Grouped and global aggregations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspan.operators.skew import bounded_text_agg, exact_quantiles
from larkspan.operators.vectors import best_labels, label_centroids
from larkspan.plans.relational import CENTROIDS_SQL
from larkspan.registry import query


@query(
    """
SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS sum_qty,
       round(sum(l_extendedprice * (1 - l_discount)), 4) AS sum_net, round(avg(l_discount), 6) AS avg_discount,
       min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price
FROM lineitem GROUP BY 1, 2"""
)
def agg_group_basic(t):
    t.lineitem.createOrReplaceTempView("agg_lineitem")
    return t.spark.sql(
        """SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS sum_qty,
                  round(sum(l_extendedprice * (1 - l_discount)), 4) AS sum_net, round(avg(l_discount), 6) AS avg_discount,
                  min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price
           FROM agg_lineitem GROUP BY 1, 2"""
    )


@query(
    """
SELECT l_returnflag, count(*) AS lines, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_suppkey) AS suppliers
FROM lineitem GROUP BY 1"""
)
def agg_count_distinct(t):
    """Two exact distinct counts: each column is de-duplicated per key first (a
    partial aggregate), so a hot flag is spread over the values it holds."""
    flag = t.lineitem.groupBy("l_returnflag").agg(F.count("*").alias("lines"))

    def distinct(col: str, name: str):
        return t.lineitem.select("l_returnflag", col).distinct().groupBy("l_returnflag").agg(F.count(col).alias(name))

    return flag.join(distinct("l_orderkey", "orders"), "l_returnflag").join(distinct("l_suppkey", "suppliers"), "l_returnflag")


@query(
    """
SELECT o_custkey, round(sum(CASE WHEN o_orderstatus IN ('F', 'O') THEN o_totalprice ELSE 0 END), 2) AS used,
       round(sum(CASE WHEN o_orderstatus = 'P' THEN o_totalprice ELSE 0 END), 2) AS pending,
       round(greatest(0, 2000000 - sum(CASE WHEN o_orderstatus IN ('F', 'O') THEN o_totalprice ELSE 0 END)), 2) AS remaining
FROM orders GROUP BY 1"""
)
def agg_conditional(t):
    used = F.sum(F.when(F.col("o_orderstatus").isin("F", "O"), F.col("o_totalprice")).otherwise(0.0))
    pending = F.sum(F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice")).otherwise(0.0))
    return t.orders.groupBy("o_custkey").agg(
        F.round(used, 2).alias("used"),
        F.round(pending, 2).alias("pending"),
        F.round(F.greatest(F.lit(0.0), F.lit(2000000.0) - used), 2).alias("remaining"),
    )


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "SELECT user_id, "
    + ", ".join(f"max(CASE WHEN event_type = '{e}' THEN value END) AS {e}" for e in EVENT_TYPES)
    + " FROM events GROUP BY 1"
)
def agg_pivot_max_if(t):
    return t.events.groupBy("user_id").pivot("event_type", EVENT_TYPES).agg(F.max("value"))


@query(
    """
SELECT conv_id, left(string_agg(role || ': ' || text, chr(10) ORDER BY turn), 2000) AS transcript
FROM conversations GROUP BY 1"""
)
def agg_listagg_ordered(t):
    """Ordered LISTAGG cut to 2000 characters; only the turns that can show are gathered."""
    line = F.concat("role", F.lit(": "), "text")
    return bounded_text_agg(t.conversations, ["conv_id"], [F.col("turn")], line, "\n", 2000, "transcript")


@query(
    """
SELECT count(*) AS documents, count(DISTINCT lang) AS languages, CAST(sum(n_chars) AS BIGINT) AS chars,
       max(n_chars) AS longest, round(avg(n_chars), 4) AS mean_chars FROM documents"""
)
def agg_global(t):
    return t.documents.agg(
        F.count("*").alias("documents"), F.countDistinct("lang").alias("languages"), F.sum("n_chars").alias("chars"),
        F.max("n_chars").alias("longest"), F.round(F.avg("n_chars"), 4).alias("mean_chars"),
    )


@query(
    """
SELECT l_suppkey, round(avg(l_discount), 6) AS mean_discount,
       round(sum(l_quantity * l_discount) / sum(l_quantity), 6) AS weighted_discount FROM lineitem GROUP BY 1"""
)
def agg_weighted_mean(t):
    weighted = F.sum(F.col("l_quantity") * F.col("l_discount")) / F.sum("l_quantity")
    return t.lineitem.groupBy("l_suppkey").agg(F.round(F.avg("l_discount"), 6).alias("mean_discount"), F.round(weighted, 6).alias("weighted_discount"))


@query("SELECT event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2")
def agg_value_counts(t):
    return t.events.groupBy("event_type", "user_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "event_type", "user_id")


@query(
    """
SELECT source, count(*) AS documents, count(DISTINCT lang) AS languages, round(avg(n_chars), 4) AS mean_chars,
       CAST(sum(n_chars) AS BIGINT) AS total_chars, CAST(sum(CAST(ceil(n_chars / 1000.0) AS BIGINT)) AS BIGINT) AS chunks
FROM documents GROUP BY 1"""
)
def agg_kpi_panel(t):
    return t.documents.groupBy("source").agg(
        F.count("*").alias("documents"), F.countDistinct("lang").alias("languages"), F.round(F.avg("n_chars"), 4).alias("mean_chars"),
        F.sum("n_chars").alias("total_chars"), F.sum(F.ceil(F.col("n_chars") / 1000)).alias("chunks"),
    )


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS messages, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def agg_per_day(t):
    """Per user and day first: a hot day is spread over its users."""
    per_user = t.events.groupBy(F.to_date("ts").alias("d"), "user_id").agg(F.count("*").alias("n"))
    days = per_user.groupBy("d").agg(F.sum("n").alias("messages"), F.count("*").alias("users"))
    return days.select(F.date_format("d", "yyyy-MM-dd").alias("day"), "messages", "users")


@query(
    f"""
WITH {CENTROIDS_SQL},
s AS (SELECT vec_id, label, c_label, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), c_vec), 6) AS similarity FROM embeddings, cent),
b AS (SELECT vec_id, label, max(similarity) AS similarity FROM s GROUP BY 1, 2)
SELECT label, max(similarity) AS best_similarity, CAST(arg_min(vec_id, (-similarity, vec_id)) AS BIGINT) AS best_vec
FROM b GROUP BY 1"""
)
def agg_max_per_doc(t):
    """A label (document) is as good as its best vector (chunk)."""
    best = best_labels(t.embeddings, label_centroids(t.embeddings), 1).select("vec_id", "similarity")
    rows = best.join(t.embeddings.select("vec_id", "label"), "vec_id")
    pick = F.min(F.struct((-F.col("similarity")).alias("neg"), "vec_id"))
    return rows.groupBy("label").agg(pick.alias("p")).select(
        "label", (-F.col("p.neg")).alias("best_similarity"), F.col("p.vec_id").alias("best_vec")
    )


@query(
    f"""
WITH {CENTROIDS_SQL},
s AS (SELECT vec_id, label, c_label, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), c_vec), 6) AS similarity FROM embeddings, cent),
b AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY similarity DESC, c_label) AS rn FROM s),
g AS (SELECT c_label AS cluster, label, count(*) AS n FROM b WHERE rn = 1 GROUP BY 1, 2)
SELECT cluster, CAST(arg_min(label, (-n, label)) AS INTEGER) AS dominant, CAST(sum(n) AS BIGINT) AS size,
       round(max(n) / sum(n), 6) AS purity FROM g GROUP BY 1"""
)
def agg_mode_purity(t):
    """Dominant true label of each nearest-centroid group and its share."""
    best = best_labels(t.embeddings, label_centroids(t.embeddings), 1).select("vec_id", F.col("label").alias("cluster"))
    counts = best.join(t.embeddings.select("vec_id", "label"), "vec_id").groupBy("cluster", "label").agg(F.count("*").alias("n"))
    pick = F.min(F.struct((-F.col("n")).alias("neg"), "label"))
    return counts.groupBy("cluster").agg(pick.alias("p"), F.sum("n").alias("size")).select(
        "cluster", F.col("p.label").alias("dominant"), "size", F.round(-F.col("p.neg") / F.col("size"), 6).alias("purity")
    )


@query(
    """
SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.9), 6) AS p90,
       round(avg(value), 6) AS mean, max(value) AS max, round(avg(CASE WHEN value <= 10 THEN 1 ELSE 0 END), 6) AS share_fast
FROM events GROUP BY 1"""
)
def agg_percentiles(t):
    q = exact_quantiles(t.events, ["event_type"], "value", {"p50": 0.5, "p90": 0.9})
    rest = t.events.groupBy("event_type").agg(
        F.round(F.avg("value"), 6).alias("mean"), F.max("value").alias("max"),
        F.round(F.avg(F.when(F.col("value") <= 10, 1).otherwise(0)), 6).alias("share_fast"),
    )
    return q.join(rest, "event_type").select("event_type", F.round("p50", 6).alias("p50"), F.round("p90", 6).alias("p90"), "mean", "max", "share_fast")


@query(
    """
WITH price(event_type, credit) AS (VALUES ('click', 0.1), ('view', 0.05), ('purchase', 1.0), ('signup', 0.5), ('error', 0.0)),
b AS (SELECT max(ts) - INTERVAL 7 DAY AS lo FROM events)
SELECT e.event_type, e.user_id, count(*) AS calls, round(sum(CAST(e.value * p.credit AS DOUBLE)), 4) AS credits
FROM events e JOIN price p USING (event_type), b WHERE e.ts > b.lo GROUP BY 1, 2"""
)
def agg_usage_credits(t):
    """Calls and credits of the last seven days; rates join after the aggregation."""
    from larkspan.tables import values

    price = values(t.spark, "event_type STRING, credit DOUBLE", [("click", 0.1), ("view", 0.05), ("purchase", 1.0), ("signup", 0.5), ("error", 0.0)])
    bound = t.events.agg(F.expr("max(ts) - INTERVAL 7 DAYS").alias("lo"))
    recent = t.events.join(F.broadcast(bound)).where("ts > lo")
    usage = recent.groupBy("event_type", "user_id").agg(F.count("*").alias("calls"), F.sum("value").alias("v"))
    return usage.join(price, "event_type").select("event_type", "user_id", "calls", F.round(F.col("v") * F.col("credit"), 4).alias("credits"))


@query(
    """
SELECT o_orderpriority, o_orderstatus, count(*) AS orders, round(sum(o_totalprice), 2) AS revenue,
       CAST(grouping(o_orderpriority) * 2 + grouping(o_orderstatus) AS BIGINT) AS level
FROM orders GROUP BY ROLLUP (o_orderpriority, o_orderstatus)"""
)
def agg_rollup_dims(t):
    return t.orders.rollup("o_orderpriority", "o_orderstatus").agg(
        F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("revenue"), F.grouping_id().alias("level")
    )
