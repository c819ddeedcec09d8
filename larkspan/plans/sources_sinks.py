"""Scans, sources, sinks and set-based changes to tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspan.functions.html import (
    MARKDOWN_STEPS,
    TEXT_STEPS,
    html_to_markdown,
    html_to_text,
    steps_as_sql,
)
from larkspan.registry import query
from larkspan.sources.files import CORRUPT, conform, content_type, extension, listing, read_csv, split_rejects
from larkspan.storage import scratch, written
from larkspan.tables import SCHEMAS, values

ORDERS_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
FROM orders"""


@query(ORDERS_SQL)
def src_csv_typed(t):
    """Orders written as CSV and loaded back through a declared schema."""
    path = scratch(t.spark, "orders_csv")
    stamp = "yyyy-MM-dd HH:mm:ss"
    t.orders.write.option("header", True).option("timestampNTZFormat", stamp).csv(path)
    loaded = written(read_csv(t.spark, path, SCHEMAS["orders"], timestampNTZFormat=stamp), "orders_loaded")
    good, rejects = split_rejects(loaded)
    rejects.write.parquet(scratch(t.spark, "orders_rejects"))
    return good.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query(
    """
SELECT c_custkey, c_name AS customer_name, c_nationkey, c_acctbal, c_mktsegment,
       CASE WHEN c_custkey % 2 = 1 THEN CASE WHEN c_acctbal > 5000 THEN 'gold' ELSE 'basic' END END AS loyalty_tier,
       c_custkey % 2 = 1 AS rejected_at_first FROM customer"""
)
def src_schema_drift(t):
    """A feed whose later files have one column more and another name: the old schema rejects their rows,
    which are loaded again by the new schema; both shapes end in one table."""
    old_shape = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    target = "c_custkey BIGINT, customer_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING, loyalty_tier STRING"
    feed, odd = scratch(t.spark, "drift"), F.col("c_custkey") % 2 == 1
    tier = F.when(F.col("c_acctbal") > 5000, "gold").otherwise("basic")
    t.customer.where(~odd).write.option("header", True).csv(f"{feed}/old")
    drifted = t.customer.where(odd).withColumn("loyalty_tier", tier).withColumnRenamed("c_name", "customer_name")
    drifted.write.option("header", True).csv(f"{feed}/new")
    tables = []
    for shape in ("old", "new"):
        good, rejects = split_rejects(written(read_csv(t.spark, f"{feed}/{shape}", old_shape), f"drift_{shape}"))
        tables.append(conform(good, target, {"c_name": "customer_name"}).withColumn("rejected_at_first", F.lit(False)))
        rejects.write.parquet(f"{feed}/rejects_{shape}")
        if not rejects.isEmpty():
            again = read_csv(t.spark, f"{feed}/{shape}", target)
            key = F.split_part(CORRUPT, F.lit(","), F.lit(1)).cast("bigint").alias("c_custkey")
            keys = t.spark.read.schema(f"{CORRUPT} STRING").parquet(f"{feed}/rejects_{shape}").select(key)
            tables.append(conform(split_rejects(written(again, "drift_again"))[0], target).join(keys, "c_custkey", "left_semi").withColumn("rejected_at_first", F.lit(True)))
    return reduce(DataFrame.unionByName, tables)


@query()
def src_directory_listing(t):
    return listing(t.spark, t.sf_dir, "*.parquet")


@query()
def src_file_metadata(t):
    files = listing(t.spark, t.sf_dir, "*.parquet")
    return files.select(
        "relative_path",
        extension(F.col("relative_path")).alias("file_type"),
        content_type(F.col("relative_path")).alias("content_type"),
        "size",
        F.element_at(F.split("file_url", "/"), -2).alias("stage"),
        "last_modified",
    )


@query(f"SELECT page_id, url, {steps_as_sql('html', TEXT_STEPS)} AS content FROM pages")
def src_html_pages(t):
    return t.pages.select("page_id", "url", html_to_text(F.col("html")).alias("content"))


@query(f"SELECT page_id, {steps_as_sql('html', MARKDOWN_STEPS)} AS markdown FROM pages")
def src_layout_markdown(t):
    return t.pages.select("page_id", html_to_markdown(F.col("html")).alias("markdown"))


def page_split(df: DataFrame, text: str, delimiter: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """One row per page with a 0-based index; an optional [start, end) range."""
    out = df.select(*[c for c in df.columns if c != text], F.posexplode(F.split(text, delimiter)).alias("page_index", "page_text"))
    if start is not None:
        out = out.where(F.col("page_index") >= start)
    return out if end is None else out.where(F.col("page_index") < end)


@query(
    """
WITH p AS (SELECT doc_id, string_split(text, chr(10)) AS pages FROM documents)
SELECT doc_id, CAST(i - 1 AS INTEGER) AS page_index, pages[i] AS page_text
FROM (SELECT doc_id, pages, unnest(range(1, len(pages) + 1)) AS i FROM p)
WHERE i - 1 >= 1 AND i - 1 < 4"""
)
def src_page_split(t):
    return page_split(t.documents.select("doc_id", "text"), "text", "\n", 1, 4)


@query(
    """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS value,
       CASE WHEN json_extract_string(props, '$.k') IS NULL THEN 'missing key'
            WHEN TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) > 50 THEN 'out of range'
       END AS error,
       CAST(length(props) AS INTEGER) AS input_chars
FROM events"""
)
def src_parse_error_details(t):
    """{value, error} envelope: a row that does not parse is kept with its reason."""
    raw = F.get_json_object("props", "$.k")
    value = raw.try_cast("bigint")
    error = F.when(raw.isNull(), "missing key").when(value.isNull(), "not a number").when(value > 50, "out of range")
    parsed = t.events.select("event_id", F.struct(value.alias("value"), error.alias("error")).alias("r"), F.length("props").alias("input_chars"))
    return parsed.select("event_id", "r.value", "r.error", "input_chars")


def _revenue_by_status(t) -> DataFrame:
    return t.orders.groupBy("o_orderstatus").agg(
        F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("revenue")
    )


REVENUE_SQL = """
SELECT o_orderstatus, count(*) AS orders, round(sum(o_totalprice), 2) AS revenue FROM orders GROUP BY 1"""


@query(REVENUE_SQL)
def sink_ctas(t):
    """Materialise a stage, replace it once more, read the result."""
    path = scratch(t.spark, "revenue_by_status")
    for _ in range(2):
        _revenue_by_status(t).write.mode("overwrite").parquet(path)
    return t.spark.read.parquet(path)


@query(
    """
SELECT conv_id, turn, role, CAST(length(text) AS INTEGER) AS chars FROM conversations
UNION ALL
SELECT conv_id, max(turn) + 1, 'feedback', CAST(0 AS INTEGER) FROM conversations GROUP BY conv_id"""
)
def sink_append(t):
    """A chat log, then one feedback row per chat appended to the same table."""
    path = scratch(t.spark, "chat_log")
    log = t.conversations.select("conv_id", "turn", "role", F.length("text").alias("chars"))
    log.write.mode("append").parquet(path)
    feedback = t.conversations.groupBy("conv_id").agg((F.max("turn") + 1).alias("turn"))
    feedback.select("conv_id", "turn", F.lit("feedback").alias("role"), F.lit(0).alias("chars")).write.mode("append").parquet(path)
    return t.spark.read.parquet(path)


@query(
    """
SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS calls,
       round(sum(value), 2) AS total FROM events GROUP BY 1, 2"""
)
def sink_csv_export(t):
    """Activity log exported as CSV, one folder per day."""
    path = scratch(t.spark, "activity_csv")
    log = t.events.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(
        F.count("*").alias("calls"), F.round(F.sum("value"), 2).alias("total")
    )
    log.repartition("day").write.partitionBy("day").option("header", True).csv(path)
    schema = "event_type STRING, calls BIGINT, total DOUBLE, day STRING"
    return t.spark.read.schema(schema).option("header", True).csv(path)


@query(
    """
SELECT n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1"""
)
def sink_views(t):
    t.customer.createOrReplaceTempView("v_customer")
    t.nation.createOrReplaceTempView("v_nation")
    t.spark.sql(
        """CREATE OR REPLACE TEMP VIEW v_nation_balance AS
           SELECT n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
           FROM v_customer JOIN v_nation ON c_nationkey = n_nationkey GROUP BY n_name"""
    )
    return t.spark.table("v_nation_balance")


def update_from(target: DataFrame, source: DataFrame, key: str, column: str) -> DataFrame:
    """UPDATE target SET column = source.column FROM source WHERE keys match."""
    fresh = source.select(key, F.col(column).alias("__new"))
    out = target.join(fresh, key, "left").withColumn(column, F.coalesce("__new", column))
    return out.select(*target.columns)


@query(
    """
SELECT d.doc_id, d.lang,
       CASE WHEN l.doc_id IS NULL THEN d.source
            WHEN l.toxic = 1 THEN 'restricted' WHEN l.quality = 1 THEN 'curated' ELSE 'review' END AS source
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
)
def dml_update_from(t):
    category = F.when(F.col("toxic") == 1, "restricted").when(F.col("quality") == 1, "curated").otherwise("review")
    changes = t.labels.select("doc_id", category.alias("source"))
    return written(update_from(t.documents.select("doc_id", "lang", "source"), changes, "doc_id", "source"), "updated")


@query(
    """
SELECT doc_id, lang, source, n_chars FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)"""
)
def dml_delete_using(t):
    gone = t.labels.where(F.col("toxic") == 1).select("doc_id")
    return written(t.documents.select("doc_id", "lang", "source", "n_chars").join(gone, "doc_id", "left_anti"), "kept")


@query(
    """
SELECT conv_id, turn, md5(CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR)) AS message_id
FROM conversations"""
)
def gen_surrogate_keys(t):
    """Ids derived from the natural key: the same after any retry or re-run."""
    natural = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return t.conversations.select("conv_id", "turn", F.md5(natural).alias("message_id"))


@query(
    """
SELECT doc_id, CAST(i AS INTEGER) AS slice_no, substring(text, CAST(i * 500 + 1 AS BIGINT), 500) AS slice
FROM (SELECT doc_id, text, unnest(range(0, CAST(ceil(length(text) / 500.0) AS BIGINT))) AS i FROM documents)"""
)
def gen_sequence_rows(t):
    """500-character slices; as many rows as the text needs."""
    last = (F.ceil(F.length("text") / 500) - 1).cast("int")
    rows = t.documents.where(F.length("text") > 0).select("doc_id", "text", F.explode(F.sequence(F.lit(0), last)).alias("slice_no"))
    return rows.select("doc_id", "slice_no", F.substring("text", F.col("slice_no") * 500 + 1, F.lit(500)).alias("slice"))


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in SCHEMAS))
def audit_row_counts(t):
    counts = [getattr(t, n).agg(F.lit(n).alias("table_name"), F.count("*").alias("row_count")) for n in SCHEMAS]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")


def _columns(table: str) -> list[str]:
    return [part.strip().split(" ")[0] for part in SCHEMAS[table].split(",")]


@query(
    "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls FROM {name}" for name in SCHEMAS for c in _columns(name)
    )
)
def cat_introspect(t):
    """Tables and columns with their rows and nulls: one aggregation per table, turned into a row per column."""
    parts = []
    for name in SCHEMAS:
        cols = _columns(name)
        counts = getattr(t, name).agg(F.count("*").alias("n_rows"), *[F.count(c).alias(c) for c in cols])
        each = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n")) for c in cols])
        rows = counts.select("n_rows", F.explode(each).alias("c"))
        parts.append(rows.select(F.lit(name).alias("table_name"), "c.column_name", "n_rows", (F.col("n_rows") - F.col("c.n")).alias("n_nulls")))
    return reduce(DataFrame.unionByName, parts)


@query(
    """
SELECT c_custkey, '***' || right(c_name, 4) AS c_name, n_name,
       CASE WHEN n_regionkey = 1 THEN c_acctbal END AS c_acctbal
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE n_regionkey IN (1, 2)"""
)
def gov_masked_view(t):
    """Row filter by a grant table, masked name, balance only for a granted region."""
    grants = values(t.spark, "role STRING, regionkey INT, sees_balance BOOLEAN", [("analyst", 1, True), ("analyst", 2, False)])
    mine = grants.where(F.col("role") == "analyst")
    nations = t.nation.join(mine, F.col("n_regionkey") == F.col("regionkey"))
    rows = t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select(
        "c_custkey",
        F.concat(F.lit("***"), F.right("c_name", F.lit(4))).alias("c_name"),
        "n_name",
        F.when(F.col("sees_balance"), F.col("c_acctbal")).alias("c_acctbal"),
    )
