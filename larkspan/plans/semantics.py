"""Semantic layer: models as data, compiled to joins and grouped aggregates."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspan.plans.semantic_model import SALES
from larkspan.registry import query
from larkspan.tables import SCHEMAS, values

ROUNDING = 4


class ModelError(ValueError):
    pass


def validate_model(model: dict) -> dict:
    """Every reference in the model must resolve; returns the model."""
    tables = model["tables"]
    for rel in model["relationships"]:
        for side in ("from", "to"):
            if rel[side] not in tables:
                raise ModelError(f"relationship names unknown table {rel[side]}")
        if tables[rel["to"]]["primary_key"] != rel["key"]:
            raise ModelError(f"relationship to {rel['to']} must use its primary key")
    for kind in ("facts", "dimensions", "metrics"):
        for name, spec in model[kind].items():
            for table in [spec["table"], *spec.get("needs", [])]:
                if table not in tables:
                    raise ModelError(f"{kind} {name} names unknown table {table}")
    return model


def path_to(model: dict, start: str, goal: str) -> list[dict]:
    """Relationships that lead from one table to another along declared keys."""
    frontier, seen = [(start, [])], {start}
    while frontier:
        table, path = frontier.pop(0)
        if table == goal:
            return path
        for rel in model["relationships"]:
            if rel["from"] == table and rel["to"] not in seen:
                seen.add(rel["to"])
                frontier.append((rel["to"], [*path, rel]))
    raise ModelError(f"no declared path from {start} to {goal}")


def star(t, model: dict, base: str, needed: list[str]) -> DataFrame:
    """Base table joined to every needed table; many-to-one only, so no fan-out."""
    out = getattr(t, model["tables"][base]["source"])
    done = {base}
    for goal in needed:
        for rel in path_to(model, base, goal):
            if rel["to"] not in done:
                right = getattr(t, model["tables"][rel["to"]]["source"])
                out = out.join(right, F.col(rel["column"]) == F.col(rel["key"]), "left")
                done.add(rel["to"])
    return out


def with_facts(df: DataFrame, model: dict, table: str) -> DataFrame:
    for name, spec in model["facts"].items():
        if spec["table"] == table:
            df = df.withColumn(name, F.expr(spec["expr"]))
    return df


def semantic_query(t, model: dict, metrics: list[str], dimensions: list[str], where: str | None = None) -> DataFrame:
    """METRICS by DIMENSIONS. Each metric is aggregated at the grain of its own
    table and the results are joined on the dimensions, so nothing fans out."""
    by_table: dict[str, list[str]] = {}
    filtered = tables_of(model, where)
    for m in metrics:
        by_table.setdefault(model["metrics"][m]["table"], []).append(m)
    dims = {d: model["dimensions"][d] for d in dimensions}
    parts = []
    for table, names in by_table.items():
        needed = [d["table"] for d in dims.values() if d["table"] != table]
        for m in names:
            needed += [n for n in model["metrics"][m].get("needs", []) if n not in needed]
        needed += [n for n in filtered if n != table and n not in needed]
        rows = with_facts(star(t, model, table, needed), model, table)
        if where:
            rows = rows.where(where)
        grouped = rows.groupBy(*[F.expr(d["expr"]).alias(n) for n, d in dims.items()])
        parts.append(grouped.agg(*[F.expr(model["metrics"][m]["expr"]).alias(m) for m in names]))
    if len(parts) == 1:
        return parts[0].select(*dimensions, *metrics)
    # rows of one group meet by grouping, which takes NULL for a value like any other; a join would not
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return every.groupBy(*dimensions).agg(*[F.max(m).alias(m) for m in metrics])


def tables_of(model: dict, where: str | None) -> list[str]:
    """Tables of the model whose columns a filter names."""
    names = set(re.findall(r"[A-Za-z_]\w*", re.sub(r"'[^']*'", "", where or "")))
    columns = lambda spec: {c.strip().split(" ")[0] for c in SCHEMAS[spec["source"]].split(",")}
    return [n for n, spec in model["tables"].items() if columns(spec) & names]


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.round(c, ROUNDING).alias(c) if c in cols else F.col(c) for c in df.columns])


@query()
def sem_model_load(t):
    """Every fact, dimension and metric, with its expression resolved against the tables."""
    model = validate_model(SALES)
    parts = []
    for kind in ("facts", "dimensions", "metrics"):
        for name, spec in model[kind].items():
            df = star(t, model, spec["table"], spec.get("needs", []))
            df = with_facts(df, model, spec["table"])
            col = F.expr(spec["expr"])
            resolved = df.agg(col.alias("x")) if kind == "metrics" else df.select(col.alias("x"))
            parts.append((kind, name, spec["table"], spec["expr"], resolved.schema["x"].dataType.simpleString()))
    rows = values(t.spark, "kind STRING, name STRING, table_name STRING, expression STRING, data_type STRING", parts)
    sizes = [
        getattr(t, s["source"]).agg(F.count("*").alias("table_rows")).select(F.lit(n).alias("table_name"), "table_rows")
        for n, s in model["tables"].items()
    ]
    return rows.join(reduce(DataFrame.unionByName, sizes), "table_name")


@query(
    """
WITH net AS (SELECT r_name AS d_region, concat(year(o_orderdate), '-Q', quarter(o_orderdate)) AS d_quarter,
    sum(CASE WHEN o_orderstatus = 'F' AND c_mktsegment <> 'MACHINERY' THEN l_extendedprice - l_extendedprice * l_discount ELSE 0 END) AS n,
    sum(l_extendedprice) AS g
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2),
cnt AS (SELECT r_name AS d_region, concat(year(o_orderdate), '-Q', quarter(o_orderdate)) AS d_quarter, count(*) AS c
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2)
SELECT d_region, d_quarter, round(n, 4) AS m_net_revenue, round(g, 4) AS m_gross_revenue, c AS m_order_count
FROM net FULL JOIN cnt USING (d_region, d_quarter)"""
)
def sem_query(t):
    out = semantic_query(t, SALES, ["m_net_revenue", "m_gross_revenue", "m_order_count"], ["d_region", "d_quarter"])
    return rounded(out, "m_net_revenue", "m_gross_revenue")


@query(
    """
SELECT l_returnflag, round(sum(l_extendedprice), 4) AS gross, round(sum(l_extendedprice * l_discount), 4) AS discount,
       round(sum(l_extendedprice - l_extendedprice * l_discount), 4) AS net FROM lineitem GROUP BY 1"""
)
def sem_facts_derived(t):
    rows = with_facts(t.lineitem, SALES, "lines").groupBy("l_returnflag")
    out = rows.agg(F.sum("f_gross").alias("gross"), F.sum("f_discount").alias("discount"), F.sum("f_net").alias("net"))
    return rounded(out, "gross", "discount", "net")


@query(
    """
SELECT c_mktsegment AS d_segment, round(sum(CASE WHEN o_orderstatus = 'F' AND c_mktsegment <> 'MACHINERY'
       THEN l_extendedprice - l_extendedprice * l_discount ELSE 0 END), 4) AS m_net_revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1"""
)
def sem_metric_filtered(t):
    return rounded(semantic_query(t, SALES, ["m_net_revenue"], ["d_segment"]), "m_net_revenue")


@query(
    """
SELECT year(o_orderdate) AS d_year, concat(year(o_orderdate), '-Q', quarter(o_orderdate)) AS d_quarter,
       o_orderstatus AS d_status, count(*) AS m_order_count FROM orders GROUP BY 1, 2, 3"""
)
def sem_dims_derived(t):
    return semantic_query(t, SALES, ["m_order_count"], ["d_year", "d_quarter", "d_status"])


def _verified(t) -> dict[str, DataFrame]:
    """The eight stored questions, on the sample tables."""
    o, li, p = t.orders, t.lineitem, t.part
    key = lambda c: F.col(c).cast("string").alias("k")
    total = lambda c: F.round(F.sum(c), ROUNDING).alias("v1")
    n = lambda c: F.count(c).cast("double").alias("v2")
    lines = li.join(p, F.col("l_partkey") == F.col("p_partkey"))
    return {
        "billed_by_priority": o.groupBy(key("o_orderpriority")).agg(total("o_totalprice"), n("o_orderkey")),
        "billed_by_status": o.groupBy(key("o_orderstatus")).agg(total("o_totalprice"), n("o_orderkey")),
        "latest_orders": o.orderBy(F.desc("o_orderdate"), "o_orderkey").limit(5).select(
            key("o_orderkey"), F.col("o_totalprice").alias("v1"), F.year("o_orderdate").cast("double").alias("v2")),
        "mean_by_priority": o.groupBy(key("o_orderpriority")).agg(F.round(F.avg("o_totalprice"), ROUNDING).alias("v1"), n("o_orderkey")),
        "outstanding": t.customer.where("c_acctbal > 0").groupBy(key("c_mktsegment")).agg(total("c_acctbal"), n("c_custkey")),
        "distinct_items": lines.select("p_type", "l_partkey").groupBy(F.col("p_type").alias("k"), "l_partkey").agg(F.count("*").alias("c"))
            .groupBy("k").agg(F.count("*").cast("double").alias("v1"), F.sum("c").cast("double").alias("v2")),
        "most_common_items": li.groupBy(key("l_partkey")).agg(F.count("*").cast("double").alias("v1")).withColumn("v2", F.lit(0.0))
            .orderBy(F.desc("v1"), F.col("k").cast("bigint")).limit(10),
        "collected": li.groupBy(key("l_linestatus")).agg(total("l_extendedprice"), F.round(F.sum(F.col("l_extendedprice") * F.col("l_tax")), ROUNDING).alias("v2")),
    }


@query(
    """
SELECT 'billed_by_priority' AS question, o_orderpriority AS k, round(sum(o_totalprice), 4) AS v1, CAST(count(*) AS DOUBLE) AS v2 FROM orders GROUP BY 2
UNION ALL SELECT 'billed_by_status', o_orderstatus, round(sum(o_totalprice), 4), CAST(count(*) AS DOUBLE) FROM orders GROUP BY 2
UNION ALL (SELECT 'latest_orders', CAST(o_orderkey AS VARCHAR), o_totalprice, CAST(year(o_orderdate) AS DOUBLE) FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 5)
UNION ALL SELECT 'mean_by_priority', o_orderpriority, round(avg(o_totalprice), 4), CAST(count(*) AS DOUBLE) FROM orders GROUP BY 2
UNION ALL SELECT 'outstanding', c_mktsegment, round(sum(c_acctbal), 4), CAST(count(*) AS DOUBLE) FROM customer WHERE c_acctbal > 0 GROUP BY 2
UNION ALL SELECT 'distinct_items', p_type, CAST(count(DISTINCT l_partkey) AS DOUBLE), CAST(count(*) AS DOUBLE) FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 2
UNION ALL (SELECT 'most_common_items', CAST(l_partkey AS VARCHAR), CAST(count(*) AS DOUBLE), 0.0::DOUBLE FROM lineitem GROUP BY l_partkey ORDER BY count(*) DESC, l_partkey LIMIT 10)
UNION ALL SELECT 'collected', l_linestatus, round(sum(l_extendedprice), 4), round(sum(l_extendedprice * l_tax), 4) FROM lineitem GROUP BY 2"""
)
def sem_verified_queries(t):
    parts = [df.select(F.lit(name).alias("question"), "k", "v1", "v2") for name, df in _verified(t).items()]
    return reduce(DataFrame.unionByName, parts)


def synonym_table(t, model: dict) -> DataFrame:
    rows = []
    for kind in ("tables", "dimensions", "metrics"):
        for name, spec in model[kind].items():
            for word in {name, *spec.get("synonyms", [])}:
                rows.append((kind, name, word.lower()))
    return values(t.spark, "kind STRING, name STRING, synonym STRING", sorted(rows))


_SYN = [(k, n, w) for k in ("tables", "dimensions", "metrics") for n, s in SALES[k].items() for w in sorted({n, *s.get("synonyms", [])})]


@query(
    "WITH syn(kind, name, synonym) AS (VALUES " + ", ".join(f"('{k}', '{n}', '{w}')" for k, n, w in _SYN) + ")"
    """, words AS (SELECT lower(unnest([r_name, 'Revenue', 'Country', 'orders'])) AS word FROM region)
SELECT word, kind, name, count(*) AS uses FROM words JOIN syn ON word = synonym GROUP BY 1, 2, 3"""
)
def sem_synonym_lookup(t):
    """Words of a request resolved to model objects by an equality join."""
    words = t.region.select(F.explode(F.array("r_name", F.lit("Revenue"), F.lit("Country"), F.lit("orders"))).alias("w"))
    words = words.groupBy(F.lower("w").alias("word")).agg(F.count("*").alias("uses"))
    return words.join(synonym_table(t, SALES), F.col("word") == F.col("synonym")).select("word", "kind", "name", "uses")


@query(
    """
SELECT 'd_segment' AS dimension, c_mktsegment AS value, count(*) AS n FROM customer
WHERE c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD') GROUP BY 2
UNION ALL SELECT 'd_status', o_orderstatus, count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O', 'P') GROUP BY 2"""
)
def sem_enum_check(t):
    """Values outside the declared list, per enumerated dimension."""
    parts = []
    for name, spec in SALES["dimensions"].items():
        if "enum" in spec:
            source = getattr(t, SALES["tables"][spec["table"]]["source"])
            seen = source.groupBy(F.expr(spec["expr"]).alias("value")).agg(F.count("*").alias("n"))
            allowed = values(t.spark, "value STRING", [(v,) for v in spec["enum"]])
            parts.append(seen.join(allowed, "value", "left_anti").select(F.lit(name).alias("dimension"), "value", "n"))
    return reduce(DataFrame.unionByName, parts)


@query(
    """
SELECT 'pk_orders' AS check_name, (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)) AS violations
UNION ALL SELECT 'pk_customers', (SELECT count(*) FROM (SELECT c_custkey FROM customer GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'pk_nations', (SELECT count(*) FROM (SELECT n_nationkey FROM nation GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'pk_regions', (SELECT count(*) FROM (SELECT r_regionkey FROM region GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'pk_parts', (SELECT count(*) FROM (SELECT p_partkey FROM part GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'fk_lines_orders', (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))
UNION ALL SELECT 'fk_lines_parts', (SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part))
UNION ALL SELECT 'fk_orders_customers', (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))
UNION ALL SELECT 'fk_customers_nations', (SELECT count(*) FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation))
UNION ALL SELECT 'fk_nations_regions', (SELECT count(*) FROM nation WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region))"""
)
def sem_key_integrity(t):
    parts = []
    for name, spec in SALES["tables"].items():
        if spec["primary_key"]:
            dup = getattr(t, spec["source"]).groupBy(spec["primary_key"]).count().where("count > 1")
            parts.append(dup.agg(F.count("*").alias("violations")).select(F.lit(f"pk_{name}").alias("check_name"), "violations"))
    for rel in SALES["relationships"]:
        left = getattr(t, SALES["tables"][rel["from"]]["source"])
        right = getattr(t, SALES["tables"][rel["to"]]["source"]).select(rel["key"])
        orphans = left.join(right, F.col(rel["column"]) == F.col(rel["key"]), "left_anti")
        label = f"fk_{rel['from']}_{rel['to']}"
        parts.append(orphans.agg(F.count("*").alias("violations")).select(F.lit(label).alias("check_name"), "violations"))
    return reduce(DataFrame.unionByName, parts)
