"""Approximate nearest neighbours: random-hyperplane buckets, exact rescoring."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspan.functions import vectors as v
from larkspan.operators.skew import top_n
from larkspan.operators.vectors import matrix_of

SEED = 20240101  # fixed value


def hyperplanes(dims: int, tables: int, bits: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((tables * bits, dims))


def bucket_keys(df: DataFrame, key: str, dims: int, tables: int, bits: int) -> DataFrame:
    """(key, bucket): one bucket id per hash table, as one signed bit per hyperplane."""
    planes = hyperplanes(dims, tables, bits)
    weights = 1 << np.arange(bits, dtype=np.int64)

    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            signs = (matrix_of(batch) @ planes.T > 0).reshape(batch.num_rows, tables, bits)
            codes = (signs * weights).sum(axis=2) + (np.arange(tables, dtype=np.int64) << bits)
            ids = batch.column(key).to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, tables)), pa.array(codes.ravel())], names=[key, "bucket"])

    return df.select(key, "embedding").mapInArrow(run, f"{key} BIGINT, bucket BIGINT")


def approximate_top_k(corpus: DataFrame, key: str, queries: DataFrame, qkey: str, k: int, dims: int, tables: int = 16, bits: int = 3) -> DataFrame:
    """(qkey, key, similarity, rank) among the rows that share a bucket with the query."""
    c = bucket_keys(corpus, key, dims, tables, bits)
    q = bucket_keys(queries, qkey, dims, tables, bits)
    pairs = c.join(q, "bucket").select(key, qkey).distinct()
    full = pairs.join(corpus.select(key, F.col("embedding").alias("cv")), key)
    full = full.join(queries.select(qkey, F.col("embedding").alias("qv")), qkey)
    scored = full.select(qkey, key, F.round(v.cosine(F.col("cv"), F.col("qv")), 6).alias("similarity"))
    return top_n(scored, [qkey], [F.desc("similarity"), F.col(key)], k, "rank")
