"""Window functions. Windows run over aggregated rows or over buckets of a key."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspan.operators.skew import last_k_before, prefix_sums, top_n
from larkspan.registry import query


@query(
    """
SELECT o_custkey, o_orderkey, o_totalprice, rn FROM (
  SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn
  FROM orders) WHERE rn <= 3"""
)
def win_topn_per_group(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    out = top_n(rows, ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3)
    return out.withColumn("rn", F.col("rn").cast("bigint"))


@query(
    """
SELECT event_id, event_type, value, rank() OVER (PARTITION BY event_type ORDER BY value DESC) AS rank,
       dense_rank() OVER (PARTITION BY event_type ORDER BY value DESC) AS dense_rank FROM events"""
)
def win_rank(t):
    """Ranks of all rows of a few large groups. Ties share a rank, so ranks are
    computed once per distinct value, from value counts, in bands of values."""
    counts = t.events.groupBy("event_type", "value").agg(F.count("*").alias("n"))
    band = -F.floor(F.log2(F.greatest(F.col("value"), F.lit(0.0)) + 1) * 64)
    ranked = prefix_sums(counts, ["event_type"], band, [F.desc("value")], {"upto": F.col("n"), "values": F.lit(1)})
    ranks = ranked.select(
        "event_type", "value", (F.col("upto") - F.col("n") + 1).alias("rank"), F.col("values").cast("bigint").alias("dense_rank")
    )
    return t.events.select("event_id", "event_type", "value").join(ranks, ["event_type", "value"])


HISTORY_SQL = """
SELECT conv_id, turn, string_agg(role || ': ' || text, chr(10) ORDER BY pos) AS history, count(*) AS n_history FROM (
  SELECT c.conv_id, c.turn, p.role, p.text, p.turn AS pos,
         row_number() OVER (PARTITION BY c.conv_id, c.turn ORDER BY p.turn DESC) AS rn
  FROM conversations c JOIN conversations p ON p.conv_id = c.conv_id AND p.turn < c.turn) WHERE rn <= 6 GROUP BY 1, 2"""


@query(HISTORY_SQL)
def win_last_k_messages(t, k: int = 6, span: int = 100_000):
    """The last k messages before each message, also when one chat is huge."""
    line = F.concat("role", F.lit(": "), "text")
    rows = last_k_before(t.conversations.select("conv_id", "turn", "role", "text"), "conv_id", "turn", line, k, span)
    out = rows.where(F.size("history") > 0)
    return out.select("conv_id", "turn", F.array_join("history", "\n").alias("history"), F.size("history").cast("bigint").alias("n_history"))


@query(
    """
WITH g AS (SELECT n_name, sum(c_acctbal) AS v FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY v DESC, n_name) AS rn, sum(v) OVER () AS total FROM g)
SELECT CASE WHEN rn <= 7 THEN n_name ELSE 'Other' END AS slice, round(sum(v), 2) AS amount,
       round(100 * sum(v) / max(total), 4) AS share_pct FROM r GROUP BY 1"""
)
def win_share_of_total(t):
    """Top seven nations and Other; the window runs over one row per nation."""
    by_key = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.sum("c_acctbal").alias("v"))
    g = by_key.join(t.nation, "n_nationkey").groupBy("n_name").agg(F.sum("v").alias("v"))
    ranked = g.select("n_name", "v", F.row_number().over(Window.orderBy(F.desc("v"), "n_name")).alias("rn"), F.sum("v").over(Window.partitionBy()).alias("total"))
    out = ranked.groupBy(F.when(F.col("rn") <= 7, F.col("n_name")).otherwise("Other").alias("slice"))
    return out.agg(F.round(F.sum("v"), 2).alias("amount"), F.round(100 * F.sum("v") / F.max("total"), 4).alias("share_pct"))


@query(
    """
WITH b AS (SELECT CAST(floor(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) / 7.0) AS INTEGER) AS week,
  o_orderstatus, sum(o_totalprice) AS revenue, count(*) AS orders FROM orders GROUP BY 1, 2)
SELECT week, o_orderstatus, round(revenue, 2) AS revenue, orders,
  round(100 * (revenue - lag(revenue) OVER w) / lag(revenue) OVER w, 4) AS change_pct
FROM b WINDOW w AS (PARTITION BY o_orderstatus ORDER BY week)"""
)
def win_period_over_period(t):
    week = F.floor(F.date_diff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date")) / 7).cast("int")
    b = t.orders.groupBy(week.alias("week"), "o_orderstatus").agg(F.sum("o_totalprice").alias("revenue"), F.count("*").alias("orders"))
    before = F.lag("revenue").over(Window.partitionBy("o_orderstatus").orderBy("week"))
    change = F.round(100 * (F.col("revenue") - before) / before, 4)
    return b.select("week", "o_orderstatus", F.round("revenue", 2).alias("revenue"), "orders", change.alias("change_pct"))


@query(
    """
SELECT o_orderkey, o_custkey, round(sum(o_totalprice) OVER w, 2) AS running_total, count(*) OVER w AS running_orders
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)"""
)
def win_cumulative(t):
    """Running total per customer, scanned per customer and month."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    month = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    out = prefix_sums(
        rows, ["o_custkey"], month, [F.col("o_orderdate"), F.col("o_orderkey")],
        {"running_total": F.col("o_totalprice"), "running_orders": F.lit(1)},
    )
    return out.select("o_orderkey", "o_custkey", F.round("running_total", 2).alias("running_total"), F.col("running_orders").cast("bigint").alias("running_orders"))


def nucleus(df, key: str, item: str, p: float):
    """Smallest set of items whose cumulative probability reaches p, renormalised.

    `df` holds one row per (key, item) with its probability `prob`."""
    w = Window.partitionBy(key).orderBy(F.desc("prob"), item)
    cum = F.sum("prob").over(w.rowsBetween(Window.unboundedPreceding, 0))
    kept = df.withColumn("cum", cum).where(F.round(F.col("cum") - F.col("prob"), 9) < p)
    return kept.withColumn("renormalised", F.col("prob") / F.sum("prob").over(Window.partitionBy(key)))


@query(
    """
WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2),
p AS (SELECT user_id, event_type, n / sum(n) OVER (PARTITION BY user_id) AS prob FROM c),
k AS (SELECT *, sum(prob) OVER (PARTITION BY user_id ORDER BY prob DESC, event_type ROWS UNBOUNDED PRECEDING) AS cum FROM p),
f AS (SELECT * FROM k WHERE round(cum - prob, 9) < 0.8)
SELECT user_id, event_type, round(prob, 6) AS prob, round(prob / sum(prob) OVER (PARTITION BY user_id), 6) AS renormalised FROM f"""
)
def win_nucleus_filter(t):
    """Event-type distribution per user; at most one row per (user, type) enters the window."""
    c = t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    p = c.withColumn("prob", F.col("n") / F.sum("n").over(Window.partitionBy("user_id")))
    out = nucleus(p, "user_id", "event_type", 0.8)
    return out.select("user_id", "event_type", F.round("prob", 6).alias("prob"), F.round("renormalised", 6).alias("renormalised"))


@query(
    """
WITH s AS (SELECT user_id, event_type, avg(value) / 20 AS z FROM events GROUP BY 1, 2),
e AS (SELECT *, exp(z - max(z) OVER (PARTITION BY user_id)) AS x FROM s)
SELECT user_id, event_type, round(x / sum(x) OVER (PARTITION BY user_id), 6) AS p FROM e"""
)
def win_softmax_group(t, temperature: float = 20.0):
    w = Window.partitionBy("user_id")
    s = t.events.groupBy("user_id", "event_type").agg((F.avg("value") / temperature).alias("z"))
    e = s.withColumn("x", F.exp(F.col("z") - F.max("z").over(w)))
    return e.select("user_id", "event_type", F.round(F.col("x") / F.sum("x").over(w), 6).alias("p"))
