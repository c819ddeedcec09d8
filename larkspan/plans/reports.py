"""Business reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspan.functions import formats
from larkspan.operators.skew import top_n
from larkspan.registry import query

# Report flags and chart limits.
RETURN_RATE_LIMIT, DELIVERY_DAYS_LIMIT = 0.10, 5.0
PIE_LIMIT, PIE_TOP, BAR_LIMIT = 8, 7, 20

_WEEKLY = """
WITH b AS (SELECT max(CAST(o_orderdate AS DATE)) AS d FROM orders),
o AS (SELECT orders.*, CASE WHEN CAST(o_orderdate AS DATE) >= d - 7 THEN 1 ELSE 0 END AS cur FROM orders, b WHERE CAST(o_orderdate AS DATE) < d AND CAST(o_orderdate AS DATE) >= d - 14),
l AS (SELECT o.cur, li.*, o.o_orderdate, o.o_custkey FROM lineitem li JOIN o ON l_orderkey = o_orderkey),
k AS (
 SELECT 'kpi' AS block, 'orders' AS name, CAST(count(*) FILTER (cur = 1) AS DOUBLE) AS c, CAST(count(*) FILTER (cur = 0) AS DOUBLE) AS p FROM o
 UNION ALL SELECT 'kpi', 'revenue', sum(o_totalprice) FILTER (cur = 1), sum(o_totalprice) FILTER (cur = 0) FROM o
 UNION ALL SELECT 'kpi', 'average order value', avg(o_totalprice) FILTER (cur = 1), avg(o_totalprice) FILTER (cur = 0) FROM o
 UNION ALL SELECT 'kpi', 'return rate', avg(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) FILTER (cur = 1), avg(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) FILTER (cur = 0) FROM l
 UNION ALL SELECT 'kpi', 'delivery days', avg(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) FILTER (cur = 1), avg(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) FILTER (cur = 0) FROM l
 UNION ALL SELECT 'status', o_orderstatus, CAST(count(*) FILTER (cur = 1) AS DOUBLE), CAST(count(*) FILTER (cur = 0) AS DOUBLE) FROM o GROUP BY 2
 UNION ALL (SELECT 'category', p_type, coalesce(sum(l_extendedprice) FILTER (cur = 1), 0), coalesce(sum(l_extendedprice) FILTER (cur = 0), 0) FROM l JOIN part ON l_partkey = p_partkey GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 5)
 UNION ALL (SELECT 'region', r_name, coalesce(sum(o_totalprice) FILTER (cur = 1), 0), coalesce(sum(o_totalprice) FILTER (cur = 0), 0) FROM o JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 5))
SELECT block, name, round(c, 4) AS current_week, round(p, 4) AS prior_week, round(100 * (c - p) / p, 4) AS change_pct,
  coalesce((name = 'return rate' AND c > 0.10) OR (name = 'delivery days' AND c > 5), false) AS flagged FROM k"""


@query(_WEEKLY)
def rpt_weekly_kpis(t):
    """Last complete seven days before the as-of date beside the week before."""
    o = t.orders.withColumn("day", F.to_date("o_orderdate"))
    bound = o.agg(F.max("day").alias("d"))
    o = o.join(F.broadcast(bound)).where("day < d AND day >= date_sub(d, 14)").withColumn("cur", F.when(F.expr("day >= date_sub(d, 7)"), 1).otherwise(0))
    o = o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "day", "cur")
    lines = t.lineitem.join(o, F.col("l_orderkey") == F.col("o_orderkey"))

    def two(agg, col):
        return agg(F.when(F.col("cur") == 1, col)).alias("c"), agg(F.when(F.col("cur") == 0, col)).alias("p")

    def block(name, df, label):
        return df.select(F.lit(name).alias("block"), label.alias("name"), F.col("c").cast("double").alias("c"), F.col("p").cast("double").alias("p"))

    zero = lambda df: df.fillna(0.0, ["c", "p"])
    returned = F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    days = F.date_diff(F.to_date("l_shipdate"), F.col("day"))
    nation = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    by_region = o.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    by_type = lines.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    best = lambda df, key: zero(df).orderBy(F.desc("c"), key).limit(5)
    price, lit = F.col("o_totalprice"), F.lit
    parts = [
        block("kpi", o.agg(*two(F.count, price)), lit("orders")),
        block("kpi", o.agg(*two(F.sum, price)), lit("revenue")),
        block("kpi", o.agg(*two(F.avg, price)), lit("average order value")),
        block("kpi", lines.agg(*two(F.avg, returned)), lit("return rate")),
        block("kpi", lines.agg(*two(F.avg, days)), lit("delivery days")),
        block("status", o.groupBy("o_orderstatus").agg(*two(F.count, price)), F.col("o_orderstatus")),
        block("category", best(by_type.groupBy("p_type").agg(*two(F.sum, F.col("l_extendedprice"))), "p_type"), F.col("p_type")),
        block("region", best(by_region.groupBy("r_name").agg(*two(F.sum, price)), "r_name"), F.col("r_name")),
    ]
    k = reduce(DataFrame.unionByName, parts)
    flag = ((F.col("name") == "return rate") & (F.col("c") > RETURN_RATE_LIMIT)) | ((F.col("name") == "delivery days") & (F.col("c") > DELIVERY_DAYS_LIMIT))
    return k.select(
        "block", "name", F.round("c", 4).alias("current_week"), F.round("p", 4).alias("prior_week"), F.round(100 * F.try_divide(F.col("c") - F.col("p"), F.col("p")), 4).alias("change_pct"),
        F.coalesce(flag, F.lit(False)).alias("flagged"),
    )


@query(
    """
WITH g AS (SELECT 'category share' AS result, p_type AS item, sum(l_extendedprice) AS amount, 'share' AS ask FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 2
 UNION ALL SELECT 'monthly revenue', strftime(o_orderdate, '%Y-%m'), sum(o_totalprice), 'trend' FROM orders GROUP BY 2
 UNION ALL SELECT 'nation ranking', n_name, sum(c_acctbal), 'ranking' FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 2
 UNION ALL SELECT 'total', 'all orders', sum(o_totalprice), 'value' FROM orders),
p AS (SELECT result, count(*) AS n FROM g GROUP BY 1),
c AS (SELECT g.*, CASE WHEN n = 1 THEN 'none' WHEN ask = 'trend' AND n >= 3 THEN 'line' WHEN ask = 'share' THEN 'pie' ELSE 'bar' END AS chart,
  row_number() OVER (PARTITION BY result ORDER BY amount DESC, item) AS rn, n FROM g JOIN p USING (result))
SELECT result, chart, CASE WHEN chart = 'pie' AND n > 8 AND rn > 7 THEN 'Other' ELSE item END AS item, round(sum(amount), 2) AS amount
FROM c WHERE NOT (chart = 'bar' AND rn > 20) GROUP BY 1, 2, 3"""
)
def rpt_chart_choice(t):
    """Shape each result for its chart: single value, line, pie with Other, or top-N bar."""
    month = F.date_format("o_orderdate", "yyyy-MM")
    per_part = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum("l_extendedprice").alias("v"))
    per_nation = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.sum("c_acctbal").alias("v"))
    results = [
        ("category share", "share", per_part.join(t.part, "p_partkey").groupBy(F.col("p_type").alias("item")).agg(F.sum("v").alias("amount"))),
        ("monthly revenue", "trend", t.orders.groupBy(month.alias("item")).agg(F.sum("o_totalprice").alias("amount"))),
        ("nation ranking", "ranking", per_nation.join(t.nation, "n_nationkey").groupBy(F.col("n_name").alias("item")).agg(F.sum("v").alias("amount"))),
        ("total", "value", t.orders.agg(F.sum("o_totalprice").alias("amount")).select(F.lit("all orders").alias("item"), "amount")),
    ]
    g = reduce(DataFrame.unionByName, [df.select(F.lit(n).alias("result"), F.lit(a).alias("ask"), "item", "amount") for n, a, df in results])
    w = Window.partitionBy("result")  # grouped results, a chart's worth of rows
    n = F.count("*").over(w)
    chart = F.when(n == 1, "none").when((F.col("ask") == "trend") & (n >= 3), "line").when(F.col("ask") == "share", "pie").otherwise("bar")
    c = g.select("result", "item", "amount", chart.alias("chart"), n.alias("n"), F.row_number().over(w.orderBy(F.desc("amount"), "item")).alias("rn"))
    item = F.when((F.col("chart") == "pie") & (F.col("n") > PIE_LIMIT) & (F.col("rn") > PIE_TOP), "Other").otherwise(F.col("item"))
    shaped = c.where(~((F.col("chart") == "bar") & (F.col("rn") > BAR_LIMIT)))
    return shaped.groupBy("result", "chart", item.alias("item")).agg(F.round(F.sum("amount"), 2).alias("amount"))


@query(
    """
WITH g AS (SELECT c_custkey, coalesce(sum(CASE WHEN o_orderstatus IN ('F', 'O') THEN o_totalprice END), 0) AS used, coalesce(sum(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END), 0) AS pending
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)
SELECT c_custkey, round(used, 2) AS used, round(pending, 2) AS pending, round(greatest(0, 2000000 - used), 2) AS balance,
  CASE WHEN greatest(0, 2000000 - used) >= 500000 THEN 'eligible' WHEN greatest(0, 2000000 - used) > 0 THEN 'partly' ELSE 'not eligible' END AS request FROM g"""
)
def rpt_leave_balance(t, entitlement: float = 2_000_000.0, request: float = 500_000.0):
    """Entitlement less used, pending total, and whether a request fits, for everybody at once."""
    amount = lambda *s: F.sum(F.when(F.col("o_orderstatus").isin(*s), F.col("o_totalprice")).otherwise(0.0))
    per = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(amount("F", "O").alias("used"), amount("P").alias("pending"))
    rows = t.customer.select("c_custkey").join(per, "c_custkey", "left").fillna(0.0)
    left = F.greatest(F.lit(0.0), F.lit(entitlement) - F.col("used"))
    verdict = F.when(left >= request, "eligible").when(left > 0, "partly").otherwise("not eligible")
    return rows.select("c_custkey", F.round("used", 2).alias("used"), F.round("pending", 2).alias("pending"), F.round(left, 2).alias("balance"), verdict.alias("request"))


@query(
    """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders),
h AS (SELECT o_custkey, string_agg(o_orderkey || ':' || o_orderstatus, ', ' ORDER BY rn) FILTER (rn <= 3) AS latest, count(*) AS orders, sum(o_totalprice) AS revenue FROM r GROUP BY 1),
e AS (SELECT user_id, count(*) AS events, max(event_type) AS last_type FROM events GROUP BY 1)
SELECT c_custkey, n_name, coalesce(orders, 0) AS orders, round(coalesce(revenue, 0), 2) AS revenue, coalesce(latest, 'none') AS latest_orders, coalesce(events, 0) AS events
FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN h ON o_custkey = c_custkey LEFT JOIN e ON user_id = c_custkey"""
)
def rpt_customer_360(t):
    """Order history (three latest), totals and feedback per customer, each branch aggregated first."""
    key = F.col("o_custkey").alias("c_custkey")
    total = t.orders.groupBy(key).agg(F.count("*").alias("orders"), F.sum("o_totalprice").alias("revenue"))
    recent = top_n(t.orders.select(key, "o_orderkey", "o_orderstatus", "o_orderdate"), ["c_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], 3)
    item = F.concat_ws(":", F.col("o_orderkey").cast("string"), "o_orderstatus")
    latest = recent.groupBy("c_custkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", item.alias("i")))), lambda r: r["i"]), ", ").alias("latest"))
    feedback = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(F.count("*").alias("events"))
    nation = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    rows = t.customer.join(nation, "c_nationkey").join(total, "c_custkey", "left").join(latest, "c_custkey", "left").join(feedback, "c_custkey", "left")
    return rows.select(
        "c_custkey", "n_name", F.coalesce("orders", F.lit(0)).alias("orders"), F.round(F.coalesce("revenue", F.lit(0.0)), 2).alias("revenue"),
        F.coalesce("latest", F.lit("none")).alias("latest_orders"), F.coalesce("events", F.lit(0)).alias("events"),
    )


@query(
    """
WITH f AS (SELECT l_partkey, l_returnflag, count(*) AS n, sum(l_quantity) AS qty, sum(l_discount) AS disc FROM lineitem GROUP BY 1, 2),
b AS (SELECT p_brand, l_returnflag, sum(n) AS n, sum(qty) AS qty, sum(disc) AS disc FROM f JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
SELECT p_brand, CAST(sum(n) AS BIGINT) AS lines, round(sum(disc) / sum(n), 6) AS mean_discount, round(sum(qty), 2) AS quantity,
  arg_min(l_returnflag, (-n, l_returnflag)) FILTER (l_returnflag <> 'N') AS top_problem FROM b GROUP BY 1"""
)
def rpt_product_insights(t):
    per = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey"), "l_returnflag").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"), F.sum("l_discount").alias("disc"))
    b = per.join(t.part.select("p_partkey", "p_brand"), "p_partkey").groupBy("p_brand", "l_returnflag").agg(*[F.sum(c).alias(c) for c in ("n", "qty", "disc")])
    problem = F.min(F.when(F.col("l_returnflag") != "N", F.struct((-F.col("n")).alias("neg"), "l_returnflag")))["l_returnflag"]
    return b.groupBy("p_brand").agg(
        F.sum("n").alias("lines"), F.round(F.sum("disc") / F.sum("n"), 6).alias("mean_discount"), F.round(F.sum("qty"), 2).alias("quantity"), problem.alias("top_problem")
    )


@query(
    """
SELECT c_custkey, '| ' || replace(c_name, '|', '\\|') || ' | ' || CASE WHEN c_acctbal < 0 THEN 'Not available' WHEN c_acctbal >= 1000 THEN '$' || printf('%.2f', round(c_acctbal / 1000, 2)) || 'K'
  ELSE '$' || printf('%.2f', c_acctbal) END || ' | ' || coalesce(c_mktsegment, 'Not available') || ' |' AS row_text FROM customer"""
)
def rpt_markdown_rows(t):
    """Table rows with formatted, escaped cells; a negative balance counts as not stated."""
    known = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))
    cells = [formats.cell(F.col("c_name")), formats.cell(formats.money(known)), formats.cell(F.col("c_mktsegment"))]
    return t.customer.select("c_custkey", F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("row_text"))
