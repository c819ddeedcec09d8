"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspan.functions.pii import PATTERNS
from larkspan.functions.text import snippet
from larkspan.registry import query
from larkspan.tables import values

# Terms that mark a message as off topic in the sample conversations.
WATCH_TERMS = ["token", "worthless", "nicht", "avec", "the and"]


@query(
    """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders
WHERE o_totalprice BETWEEN 100000 AND 300000 AND o_orderpriority IN ('1-URGENT', '2-HIGH')
  AND o_orderstatus <> 'P' AND o_custkey IS NOT NULL AND o_orderdate >= TIMESTAMP '1997-01-01'"""
)
def flt_basic(t):
    rows = t.orders.where(
        F.col("o_totalprice").between(100000, 300000)
        & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
        & (F.col("o_orderstatus") != "P")
        & F.col("o_custkey").isNotNull()
        & (F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    )
    return rows.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


@query(
    """
SELECT event_id, event_type, value FROM events
WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY
  AND ts < (SELECT max(ts) FROM events) - INTERVAL 2 HOUR"""
)
def flt_relative_dates(t, as_of: str | None = None):
    """Last seven days up to two hours ago, relative to an as-of time (default: the data's own end)."""
    if as_of is None:
        bound = t.events.agg(F.max("ts").alias("as_of"))  # one row by construction
        rows = t.events.join(F.broadcast(bound))
    else:
        rows = t.events.withColumn("as_of", F.lit(as_of).cast("timestamp_ntz"))
    lower, upper = F.expr("as_of - INTERVAL 7 DAYS"), F.expr("as_of - INTERVAL 2 HOURS")
    return rows.where((F.col("ts") >= lower) & (F.col("ts") < upper)).select("event_id", "event_type", "value")


@query(
    """
SELECT page_id, url, url ILIKE '%/EN/%' AS is_english FROM pages
WHERE url ILIKE '%.HTML' OR url ILIKE '%://M.%' OR url ILIKE '%#top'"""
)
def flt_ilike_any(t):
    t.pages.createOrReplaceTempView("flt_pages")
    return t.spark.sql(
        """SELECT page_id, url, url ILIKE '%/EN/%' AS is_english FROM flt_pages
           WHERE url ILIKE ANY ('%.HTML', '%://M.%', '%#top')"""
    )


@query("SELECT doc_id, lang, left(text, 80) || '...' AS preview, substring(text, 11, 20) AS middle FROM documents")
def prj_snippet(t):
    return t.documents.select("doc_id", "lang", snippet(F.col("text"), 80).alias("preview"), F.substring("text", 11, 20).alias("middle"))


@query(
    """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'open' END AS state,
       CASE WHEN o_totalprice >= 300000 THEN 'large' WHEN o_totalprice >= 100000 THEN 'medium' ELSE 'small' END AS size_band,
       coalesce(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END, 'unknown') AS status_or_default
FROM orders"""
)
def prj_conditional(t):
    price = F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey",
        F.expr("if(o_orderstatus = 'F', 'closed', 'open')").alias("state"),
        F.when(price >= 300000, "large").when(price >= 100000, "medium").otherwise("small").alias("size_band"),
        F.coalesce(F.nullif(F.col("o_orderstatus"), F.lit("P")), F.lit("unknown")).alias("status_or_default"),
    )


@query(
    """
SELECT o_orderpriority, o_orderstatus, orders,
       row_number() OVER (ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2
                          WHEN '3-MEDIUM' THEN 3 ELSE 4 END, orders DESC NULLS LAST, o_orderpriority, o_orderstatus) AS position
FROM (SELECT o_orderpriority, o_orderstatus, count(*) AS orders FROM orders GROUP BY 1, 2)"""
)
def prj_custom_sort(t):
    """Business order of a grouped result (bounded by priorities x statuses)."""
    grouped = t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("orders"))
    level = F.col("o_orderpriority")
    rank = F.when(level == "1-URGENT", 1).when(level == "2-HIGH", 2).when(level == "3-MEDIUM", 3).otherwise(4)
    w = Window.orderBy(rank, F.col("orders").desc_nulls_last(), "o_orderpriority", "o_orderstatus")
    return grouped.withColumn("position", F.row_number().over(w).cast("bigint"))


@query(
    """
SELECT event_id, CAST(event_id AS VARCHAR) AS id_text, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_int,
       value > 10 AS is_large, strftime(TRY_CAST(strftime(ts, '%Y-%m-%d') AS DATE), '%d/%m/%Y') AS day_text,
       TRY_CAST(event_type AS BIGINT) IS NULL AS type_is_text
FROM events"""
)
def prj_typed_cast(t):
    return t.events.select(
        "event_id",
        F.col("event_id").cast("string").alias("id_text"),
        F.get_json_object("props", "$.k").cast("int").alias("k_int"),
        (F.col("value") > 10).alias("is_large"),
        F.date_format(F.try_to_date(F.date_format("ts", "yyyy-MM-dd"), "yyyy-MM-dd"), "dd/MM/yyyy").alias("day_text"),
        F.col("event_type").try_cast("bigint").isNull().alias("type_is_text"),
    )


_TERMS_SQL = ", ".join(f"('{w}')" for w in WATCH_TERMS)


@query(
    f"""
SELECT c.conv_id, c.turn, string_agg(w.term, ',' ORDER BY w.term) AS hits, count(*) AS n_hits
FROM conversations c JOIN (VALUES {_TERMS_SQL}) AS w(term) ON contains(lower(c.text), w.term)
GROUP BY 1, 2"""
)
def flt_contains_list(t):
    """All list terms found in a text: the list is a literal, so the scan stays one pass."""
    low = F.lower("text")
    hits = F.array_compact(F.array(*[F.when(low.contains(w), F.lit(w)) for w in sorted(WATCH_TERMS)]))
    found = t.conversations.select("conv_id", "turn", hits.alias("h")).where(F.size("h") > 0)
    return found.select("conv_id", "turn", F.array_join("h", ",").alias("hits"), F.size("h").cast("bigint").alias("n_hits"))


@query(
    f"""
WITH found AS (SELECT doc_id, lower(trim(unnest(regexp_extract_all(text, '{PATTERNS["EMAIL"]}')))) AS email FROM documents)
SELECT doc_id, email, split_part(email, '@', 2) AS domain, ends_with(email, '@mail3.example.com') AS is_staff
FROM (SELECT DISTINCT doc_id, email FROM found)"""
)
def flt_email_domain(t):
    emails = F.regexp_extract_all("text", F.lit(PATTERNS["EMAIL"]), F.lit(0))
    found = t.documents.select("doc_id", F.explode(F.array_distinct(F.transform(emails, lambda e: F.lower(F.trim(e))))).alias("email"))
    return found.select(
        "doc_id", "email", F.substring_index("email", "@", -1).alias("domain"), F.col("email").endswith("@mail3.example.com").alias("is_staff")
    )


@query(
    """
SELECT event_type, count(*) AS calls, round(sum(value), 2) AS total FROM events
WHERE event_type = 'purchase' AND value >= 5.0 GROUP BY 1"""
)
def cfg_session_variable(t):
    """Query parameters are bound, never pasted into the text."""
    return t.spark.sql(
        """SELECT event_type, count(*) AS calls, round(sum(value), 2) AS total FROM {events}
           WHERE event_type = :kind AND value >= :floor GROUP BY event_type""",
        args={"kind": "purchase", "floor": 5.0},
        events=t.events,
    )
