"""Declared schemas of the input tables and a small accessor.

Schemas are declared rather than inferred so that no job has to open file
footers to plan, and so that a drifting file fails loudly at read time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMAS: dict[str, str] = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}

EMBEDDING_DIMS = 64
SPREAD_BELOW_BYTES = 256 * 1024 * 1024


class Tables:
    """`t.orders` is the orders DataFrame of one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    @property
    def texts(self) -> DataFrame:
        """documents for text-heavy work. A small file often is a single row
        group, which one task would read and process alone; its rows are spread
        by key. A large input has enough splits and is left as it is."""
        df = self.documents
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        if size >= SPREAD_BELOW_BYTES:
            return df
        return df.repartition(self.spark.sparkContext.defaultParallelism, "doc_id")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        return self.spark.read.schema(SCHEMAS[name]).parquet(self.path(name))


def values(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A small constant table as a local relation of the plan."""

    def lit(v) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        if isinstance(v, bool):
            return "true" if v else "false"
        return f"{v!r}D" if isinstance(v, float) else repr(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    names = [part.strip().split(" ")[0] for part in schema.split(",")]
    types = [part.strip().split(" ")[1] for part in schema.split(",")]
    cols = ", ".join(f"CAST(c{i} AS {ty}) AS {name}" for i, (name, ty) in enumerate(zip(names, types)))
    alias = ", ".join(f"c{i}" for i in range(len(names)))
    return spark.sql(f"SELECT {cols} FROM VALUES {body} AS v({alias})")
