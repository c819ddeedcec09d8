"""Every query with SQL compared with DuckDB on the smallest tables."""

import duckdb
import pytest

from check import compare
from larkspan.registry import load_all
from larkspan.tables import SCHEMAS

SF = "/root/testdata/sf0.001"
SECTIONS = {"predicates", "relational", "aggregates", "windows", "scalars", "semantics", "reports", "evaluation", "retrieval", "textual", "chunks", "sources_sinks", "udfs", "streams", "jobs", "graph"}
QUERIES = [n for n, q in load_all().items() if q.oracle and q.build.__module__.rsplit(".", 1)[1] in SECTIONS]


@pytest.fixture(scope="session")
def con():
    c = duckdb.connect()
    for t in SCHEMAS:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, con, name):
    state, note, _ = compare(spark, con, load_all()[name], SF)
    assert state == "ok", note


def test_entry_points():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(load_all()) <= set(e.queries())
