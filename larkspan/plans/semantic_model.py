"""Governed semantic models over the sample tables, as data."""

from __future__ import annotations

SALES = {
    "name": "sales_performance",
    "tables": {
        "lines": {"source": "lineitem", "primary_key": None, "synonyms": ["order lines", "sales lines"]},
        "orders": {"source": "orders", "primary_key": "o_orderkey", "synonyms": ["sales orders", "orders"]},
        "customers": {"source": "customer", "primary_key": "c_custkey", "synonyms": ["accounts", "clients"]},
        "nations": {"source": "nation", "primary_key": "n_nationkey", "synonyms": ["countries"]},
        "regions": {"source": "region", "primary_key": "r_regionkey", "synonyms": ["areas"]},
        "parts": {"source": "part", "primary_key": "p_partkey", "synonyms": ["products", "items"]},
    },
    "relationships": [
        {"from": "lines", "column": "l_orderkey", "to": "orders", "key": "o_orderkey"},
        {"from": "lines", "column": "l_partkey", "to": "parts", "key": "p_partkey"},
        {"from": "orders", "column": "o_custkey", "to": "customers", "key": "c_custkey"},
        {"from": "customers", "column": "c_nationkey", "to": "nations", "key": "n_nationkey"},
        {"from": "nations", "column": "n_regionkey", "to": "regions", "key": "r_regionkey"},
    ],
    "facts": {
        "f_gross": {"table": "lines", "expr": "l_extendedprice"},
        "f_discount": {"table": "lines", "expr": "l_extendedprice * l_discount"},
        "f_net": {"table": "lines", "expr": "f_gross - f_discount"},
    },
    "dimensions": {
        "d_region": {"table": "regions", "expr": "r_name", "synonyms": ["sales region", "area"]},
        "d_nation": {"table": "nations", "expr": "n_name", "synonyms": ["country"]},
        "d_segment": {
            "table": "customers", "expr": "c_mktsegment", "synonyms": ["market segment"],
            "enum": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"],
        },
        "d_status": {"table": "orders", "expr": "o_orderstatus", "synonyms": ["order status"], "enum": ["F", "O", "P"]},
        "d_year": {"table": "orders", "expr": "year(o_orderdate)", "synonyms": ["order year"]},
        "d_quarter": {
            "table": "orders", "expr": "concat(year(o_orderdate), '-Q', quarter(o_orderdate))", "synonyms": ["order quarter"],
        },
        "d_category": {"table": "parts", "expr": "p_type", "synonyms": ["product category"]},
    },
    "metrics": {
        "m_gross_revenue": {"table": "lines", "expr": "sum(f_gross)", "synonyms": ["gross sales"]},
        "m_net_revenue": {
            "table": "lines",
            "expr": "sum(CASE WHEN o_orderstatus = 'F' AND c_mktsegment <> 'MACHINERY' THEN f_net ELSE 0 END)",
            "needs": ["orders", "customers"], "synonyms": ["revenue", "net sales"],
        },
        "m_order_count": {"table": "orders", "expr": "count(o_orderkey)", "synonyms": ["orders placed"]},
        "m_customer_count": {"table": "customers", "expr": "count(c_custkey)", "synonyms": ["number of customers"]},
    },
}
