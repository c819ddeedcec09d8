"""Scalar functions over strings, dates, numbers, JSON, arrays and vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspan.functions import formats, vectors
from larkspan.functions.text import NUMBER_PATTERN, STEM_SUFFIXES, STOPWORDS, numbers, sentences, terms
from larkspan.operators.setjoin import most_shared
from larkspan.operators.vectors import label_centroids
from larkspan.plans.relational import CENTROIDS_SQL
from larkspan.registry import query
from larkspan.storage import written

_STOP = ", ".join(f"'{w}'" for w in STOPWORDS)


def sql_stem(w: str) -> str:
    cases = " ".join(f"WHEN ends_with({w}, '{s}') AND length({w}) > {len(s) + 2} THEN left({w}, length({w}) - {len(s)})" for s in STEM_SUFFIXES)
    return f"CASE {cases} ELSE {w} END"


def sql_terms(text: str) -> str:
    words = f"list_filter(regexp_extract_all(lower({text}), '[a-z0-9#]+'), lambda w: w NOT IN ({_STOP}))"
    return f"list_distinct(list_transform({words}, lambda w: {sql_stem('w')}))"


@query(
    """
SELECT doc_id, upper(left(source, 3)) || '/' || lang AS tag, CAST(length(text) AS BIGINT) AS chars, lower(substring(text, 1, 12)) AS head,
       CAST(len(regexp_split_to_array(trim(text), ' ')) AS BIGINT) AS spaces_split, trim(lang, 'en') AS trimmed,
       replace(source, 'src', 'source ') AS source_name, 'Summarise ' || source || ' in ' || lang AS prompt
FROM documents"""
)
def fn_string(t):
    template = F.format_string("Summarise %1$s in %2$s", "source", "lang")
    return t.documents.select(
        "doc_id",
        F.concat(F.upper(F.left("source", F.lit(3))), F.lit("/"), F.col("lang")).alias("tag"),
        F.length("text").cast("bigint").alias("chars"),
        F.lower(F.substring("text", 1, 12)).alias("head"),
        F.size(F.split(F.trim("text"), " ")).cast("bigint").alias("spaces_split"),
        F.btrim("lang", F.lit("en")).alias("trimmed"),
        F.replace("source", F.lit("src"), F.lit("source ")).alias("source_name"),
        template.alias("prompt"),
    )


@query(
    f"""
SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(replace(text, ',', ''), '{NUMBER_PATTERN}'))), ' ') AS numbers,
       regexp_extract(text, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AS first_date,
       CAST(len(string_split(regexp_replace(trim(text), '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1))) AS BIGINT) AS sentences,
       regexp_replace(text, '[.,;:!?]', '', 'g') AS no_punctuation
FROM documents"""
)
def fn_regex(t):
    return t.documents.select(
        "doc_id",
        F.array_join(F.array_sort(numbers(F.col("text"))), " ").alias("numbers"),
        F.regexp_extract("text", "[0-9]{4}-[0-9]{2}-[0-9]{2}", 0).alias("first_date"),
        F.size(sentences(F.col("text"))).cast("bigint").alias("sentences"),
        F.regexp_replace("text", "[.,;:!?]", "").alias("no_punctuation"),
    )


@query(
    """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, concat(year(o_orderdate), '-Q', quarter(o_orderdate)) AS q,
       strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') AS due, strftime(o_orderdate, '%d-%m-%Y') AS day_first,
       strftime(strptime(strftime(o_orderdate, '%d-%m-%Y'), '%d-%m-%Y'), '%Y-%m-%d') AS parsed
FROM orders WHERE year(o_orderdate) >= 1997"""
)
def fn_date(t):
    d = F.to_date("o_orderdate")
    start = F.lit("1997-01-01").cast("timestamp_ntz")  # a range the scan can use, rather than year(col)
    day_first = F.date_format("o_orderdate", "dd-MM-yyyy")
    return t.orders.where(F.col("o_orderdate") >= start).select(
        "o_orderkey",
        F.year(d).alias("y"),
        F.concat(F.year(d), F.lit("-Q"), F.quarter(d)).alias("q"),
        F.date_format(F.date_add(d, 30), "yyyy-MM-dd").alias("due"),
        day_first.alias("day_first"),
        F.date_format(F.to_date(day_first, "dd-MM-yyyy"), "yyyy-MM-dd").alias("parsed"),
    )


@query(
    """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(ceil(l_quantity / 7) AS BIGINT) AS boxes, round(sqrt(l_extendedprice), 4) AS root,
       round(power(1 + l_discount, 2), 6) AS squared, greatest(least(l_quantity, 40.0), 10.0) AS clamped,
       round(least(50000.0, 0.8 * greatest(l_extendedprice - 5000, 0.0)), 4) AS payout
FROM lineitem"""
)
def fn_math(t):
    """Staged payout rule: least(cap, coverage * (amount - deductible, never below zero))."""
    payout = F.least(F.lit(50000.0), F.lit(0.8) * F.greatest(F.col("l_extendedprice") - 5000, F.lit(0.0)))
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.ceil(F.col("l_quantity") / 7).alias("boxes"),
        F.round(F.sqrt("l_extendedprice"), 4).alias("root"),
        F.round(F.pow(1 + F.col("l_discount"), 2), 6).alias("squared"),
        F.greatest(F.least(F.col("l_quantity"), F.lit(40.0)), F.lit(10.0)).alias("clamped"),
        F.round(payout, 4).alias("payout"),
    )


@query(f"SELECT doc_id, array_to_string(list_sort({sql_terms('text')}), ' ') AS terms FROM documents")
def fn_normalise_token(t):
    return t.documents.select("doc_id", F.array_join(F.array_sort(terms(F.col("text"))), " ").alias("terms"))


@query(
    f"""
WITH q AS (SELECT item_id, unnest({sql_terms('text')}) AS term FROM benchmark),
n AS (SELECT item_id, count(*) AS query_terms FROM q GROUP BY 1),
d AS (SELECT doc_id, unnest({sql_terms('text')}) AS term FROM documents),
h AS (SELECT item_id, doc_id, count(*) AS shared FROM q JOIN d USING (term) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY shared DESC, doc_id) AS rank FROM h),
s AS (SELECT item_id, list_sort({sql_terms('text')}) AS qt FROM benchmark)
SELECT r.item_id, r.doc_id, r.shared, round(r.shared / n.query_terms, 6) AS coverage, r.rank,
       array_to_string(list_filter(qt, lambda w: list_contains({sql_terms('x.text')}, w)), ' ') AS present,
       array_to_string(list_transform(qt, lambda w: CASE WHEN list_contains({sql_terms('x.text')}, w) THEN '1' ELSE '0' END), '') AS matrix
FROM r JOIN n USING (item_id) JOIN s USING (item_id) JOIN documents x USING (doc_id) WHERE r.rank <= 5"""
)
def txt_term_overlap(t, k: int = 5):
    """The texts that hold most terms of each query: shared terms, which ones, and a row of the presence matrix."""
    q = t.benchmark.select("item_id", terms(F.col("text")).alias("words"))
    d = written(t.texts.select("doc_id", terms(F.col("text")).alias("words")), "terms")
    best = most_shared(q, "item_id", d, "doc_id", k)
    rows = best.join(q.select("item_id", F.array_sort("words").alias("qt")), "item_id").join(d, "doc_id")
    rows = rows.withColumn("held", F.array_intersect("qt", "words"))
    matrix = F.array_join(F.transform("qt", lambda w: F.when(F.array_contains("held", w), "1").otherwise("0")), "")
    return rows.select(
        "item_id", "doc_id", "shared", F.round(F.col("shared") / F.size("qt"), 6).alias("coverage"), F.col("rank").cast("bigint").alias("rank"), F.array_join("held", " ").alias("present"), matrix.alias("matrix")
    )


@query(
    """
SELECT c_custkey,
  CASE WHEN c_acctbal < 0 THEN '-' ELSE '' END || '$' || CASE WHEN abs(c_acctbal) >= 1000 THEN printf('%.2f', round(abs(c_acctbal) / 1000, 2)) || 'K'
    ELSE printf('%.2f', abs(c_acctbal)) END AS balance,
  CASE WHEN m > 0 THEN '+' ELSE '' END || printf('%.2f', m) || '%' AS delta,
  format('{:,}', c_custkey) AS key_text, CASE WHEN c_acctbal < 0 THEN 'Not available' ELSE '01 Jan 1995' END AS since
FROM (SELECT *, round(c_acctbal / 100, 2) AS m FROM customer)"""
)
def fn_number_format(t):
    x = F.col("c_acctbal")
    since = F.when(x >= 0, F.lit("1995-01-01").cast("date"))
    return t.customer.select(
        "c_custkey", formats.money(x).alias("balance"), formats.percent_delta(F.round(x / 100, 2)).alias("delta"),
        formats.count_text(F.col("c_custkey")).alias("key_text"), formats.day_text(since).alias("since"),
    )


@query(
    """
WITH d AS (SELECT o_orderkey, CAST(CAST(round(o_totalprice * 100, 0) AS BIGINT) AS VARCHAR) AS s FROM orders)
SELECT o_orderkey, '₹' || CASE WHEN length(s) <= 3 THEN s ELSE
  ltrim(reverse(regexp_replace(reverse(left(s, length(s) - 3)), '(..)', '\\1,', 'g')), ',') || ',' || right(s, 3) END AS amount FROM d"""
)
def fn_inr_format(t):
    return t.orders.select("o_orderkey", formats.indian_rupees(F.col("o_totalprice") * 100).alias("amount"))


# ---- JSON, arrays, vectors


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS bucket FROM events")
def json_path(t):
    """Known shape: typed struct. `parse_json(...):k::bigint` serves open shapes."""
    parsed = t.events.select("event_id", F.from_json("props", "k BIGINT").alias("j"), F.parse_json("props").alias("v"))
    return parsed.select("event_id", F.col("j.k").alias("k"), (F.variant_get("v", "$.k", "bigint") % 10).alias("bucket"))


@query(
    """
WITH j AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
SELECT event_id, CAST(0 AS INTEGER) AS idx, 'k' AS name, CAST(k AS DOUBLE) AS score FROM j
UNION ALL SELECT event_id, CAST(1 AS INTEGER), 'half', k / 2 FROM j"""
)
def json_flatten(t):
    """An array of objects in JSON text becomes typed rows with their index."""
    k = F.get_json_object("props", "$.k")
    doc = F.format_string('[{"name": "k", "score": %1$s}, {"name": "half", "score": %2$s}]', k, (k.cast("double") / 2).cast("string"))
    rows = t.events.select("event_id", F.posexplode(F.from_json(doc, "ARRAY<STRUCT<name: STRING, score: DOUBLE>>")).alias("idx", "o"))
    return rows.select("event_id", "idx", "o.name", "o.score")


@query(
    """
WITH j AS (SELECT event_id, event_type, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
SELECT event_id, k IS NOT NULL AND k < 90 AND event_type IN ('click', 'purchase', 'view') AS valid,
  CASE WHEN k IS NULL THEN 'missing key k' WHEN k >= 90 THEN 'k out of range'
       WHEN event_type NOT IN ('click', 'purchase', 'view') THEN 'label not allowed' ELSE 'ok' END AS reason FROM j"""
)
def json_validate_enum(t):
    k = F.from_json("props", "k BIGINT")["k"]
    reason = (
        F.when(k.isNull(), "missing key k").when(k >= 90, "k out of range")
        .when(~F.col("event_type").isin("click", "purchase", "view"), "label not allowed").otherwise("ok")
    )
    return t.events.select("event_id", reason.alias("reason")).select("event_id", (F.col("reason") == "ok").alias("valid"), "reason")


@query("""SELECT event_id, '{"id":' || event_id || ',"type":"' || event_type || '","user":{"id":' || user_id || '}}' AS reply FROM events""")
def json_build(t):
    reply = F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"), F.struct(F.col("user_id").alias("id")).alias("user"))
    return t.events.select("event_id", F.to_json(reply).alias("reply"))


@query(
    """
WITH a AS (SELECT page_id, regexp_extract_all(url, '[a-z0-9]+') AS parts FROM pages)
SELECT page_id, CAST(len(parts) AS INTEGER) AS n, array_to_string(list_sort(list_distinct(parts)), '|') AS unique_parts,
       parts[1] AS first_part, parts[-1] AS last_part, list_contains(parts, 'en') AS has_en FROM a"""
)
def arr_ops(t):
    a = t.pages.select("page_id", F.regexp_extract_all("url", F.lit("[a-z0-9]+"), F.lit(0)).alias("p"))
    return a.select(
        "page_id", F.size("p").alias("n"), F.array_join(F.array_sort(F.array_distinct("p")), "|").alias("unique_parts"),
        F.element_at("p", 1).alias("first_part"), F.element_at("p", -1).alias("last_part"), F.array_contains("p", "en").alias("has_en"),
    )


def _with_centroid(t):
    cent = label_centroids(t.embeddings).withColumnRenamed("embedding", "c_vec")
    return t.embeddings.join(cent, "label")


_JOINED = f"WITH {CENTROIDS_SQL}, j AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v, c_vec FROM embeddings JOIN cent ON label = c_label)"


@query(f"{_JOINED} SELECT vec_id, label, round(list_cosine_similarity(v, c_vec), 6) AS similarity FROM j")
def vec_cosine(t):
    return _with_centroid(t).select("vec_id", "label", F.round(vectors.cosine(F.col("embedding"), F.col("c_vec")), 6).alias("similarity"))


@query(f"{_JOINED} SELECT vec_id, label, round(list_distance(v, c_vec), 6) AS distance FROM j")
def vec_l2_distance(t):
    return _with_centroid(t).select("vec_id", "label", F.round(vectors.l2_distance(F.col("embedding"), F.col("c_vec")), 6).alias("distance"))


@query(
    f"""{_JOINED}, u AS (SELECT vec_id, list_cosine_similarity(v, c_vec) AS c FROM j)
SELECT vec_id, round(c, 6) AS dot_unit, round(2 - 2 * c, 6) AS squared_distance, true AS identity_holds FROM u"""
)
def vec_dot_normalise(t):
    """For unit vectors dot = cosine and |a-b|^2 = 2 - 2 cos."""
    rows = _with_centroid(t).select("vec_id", vectors.normalised(F.col("embedding")).alias("a"), vectors.normalised(F.col("c_vec")).alias("b"))
    rows = rows.select("vec_id", vectors.dot(F.col("a"), F.col("b")).alias("d"), F.pow(vectors.l2_distance(F.col("a"), F.col("b")), 2).alias("s"))
    return rows.select(
        "vec_id", F.round("d", 6).alias("dot_unit"), F.round("s", 6).alias("squared_distance"),
        (F.abs(F.col("s") - (2 - 2 * F.col("d"))) < 1e-9).alias("identity_holds"),
    )


@query("SELECT CAST(len(embedding) AS INTEGER) AS dims, count(*) AS vectors, len(embedding) = 64 AS as_declared FROM embeddings GROUP BY len(embedding)")
def vec_dims(t):
    g = t.embeddings.groupBy(F.size("embedding").alias("dims")).agg(F.count("*").alias("vectors"))
    return g.withColumn("as_declared", F.col("dims") == 64)


@query(f"WITH {CENTROIDS_SQL} SELECT c_label AS label, CAST(d - 1 AS INTEGER) AS dim, round(c_vec[d], 8) AS mean FROM (SELECT c_label, c_vec, unnest(range(1, 65)) AS d FROM cent)")
def vec_centroid(t):
    c = label_centroids(t.embeddings)
    return c.select("label", F.posexplode("embedding").alias("dim", "m")).select("label", "dim", F.round("m", 8).alias("mean"))
