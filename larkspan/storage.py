"""Durable scratch space shared by all executors.

Iterative jobs cut their lineage by writing their state; sinks, streams and
caches write and read back too. All of it lies below one folder: the one named
in `spark.checkpoint.dir`, else one beside the tables of the warehouse.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current is not None:
        return current.rstrip("/")
    sc.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/larkspan-scratch")
    return sc.getCheckpointDir().rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unused folder for one run of one job."""
    return f"{shared_dir(spark)}/scratch/{uuid.uuid4().hex}/{name}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise the state of a loop and truncate its lineage.

    A table in the shared folder survives the loss of executors. Unlike
    `checkpoint()` it is computed once, and it does not carry the constraints
    of the old plan, which multiply with every self-join of a loop."""
    return written(df, "state")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a stage table and read it back, so later stages share one result; packed tightly, as most hold texts."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_DERIVED: dict[tuple[str, str, str], object] = {}


def derived(t, name: str, build):
    """What `build()` makes of a directory's documents, made once per state of their files in this application.

    It has to leave its tables in the shared store, so that later queries read them instead of the texts."""
    files = t.documents.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    n, state = files.agg(F.count("*"), F.bit_xor(F.xxhash64("file_path", "file_size", "file_modification_time"))).first()
    known = (t.spark.sparkContext.applicationId, f"{t.sf_dir}:{n}:{state}", name)
    if known not in _DERIVED:
        _DERIVED[known] = build()
    return _DERIVED[known]
