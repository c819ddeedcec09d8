"""Scoring a large vector table against a query set.

The query set is cut into blocks of at most BLOCK_ROWS vectors, so what a task
holds has a fixed bound however many queries there are. Corpus rows are never
paired through a shuffle: each Arrow batch is multiplied with the block and
only the best k survive the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspan.operators.search import DIMS as HASHED_DIMS
from larkspan.tables import EMBEDDING_DIMS

BLOCK_ROWS = 4096
DECIMALS = 6


def label_centroids(df: DataFrame, dims: int = EMBEDDING_DIMS) -> DataFrame:
    """Mean vector per label: one aggregation with a column per dimension."""
    v = F.col("embedding")
    means = df.groupBy("label").agg(*[F.avg(v[i].cast("double")).alias(f"m{i}") for i in range(dims)])
    return means.select("label", F.array(*[f"m{i}" for i in range(dims)]).alias("embedding"))


def query_blocks(queries: DataFrame, key: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, unit matrix) per block of the query set."""
    total = queries.count()
    blocks = -(-total // BLOCK_ROWS)
    for b in range(blocks):
        part = queries if blocks == 1 else queries.where(F.pmod(F.xxhash64(key), F.lit(blocks)) == b)
        rows = part.select(key, "embedding").orderBy(key).collect()
        if rows:
            ids = np.array([r[0] for r in rows], dtype=np.int64)
            if isinstance(queries.schema["embedding"].dataType.elementType, T.IntegerType):
                where = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
                flat = np.concatenate([np.array(r[1], dtype=np.int64) for r in rows])
                yield ids, unit(counts_matrix(where, flat, len(rows), HASHED_DIMS))
            else:
                yield ids, unit(np.array([r[1] for r in rows], dtype=np.float64))


def unit(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(n == 0.0, 1.0, n)


def counts_matrix(rows: np.ndarray, buckets: np.ndarray, n: int, dims: int) -> np.ndarray:
    """Dense term-frequency rows from (row, bucket) occurrences."""
    return np.bincount(rows * dims + buckets, minlength=n * dims).reshape(n, dims).astype(np.float64)


def matrix_of(batch: pa.RecordBatch) -> np.ndarray:
    col = batch.column("embedding")
    flat = col.flatten().to_numpy(zero_copy_only=False)
    if pa.types.is_integer(col.type.value_type):  # hashed text: bucket numbers with repeats
        lengths = pa.compute.list_value_length(col).to_numpy(zero_copy_only=False).astype(np.int64)
        return counts_matrix(np.repeat(np.arange(len(col)), lengths), flat.astype(np.int64), len(col), HASHED_DIMS)
    return flat.astype(np.float64).reshape(len(col), -1)


def best_per_row(corpus: DataFrame, row_key: str, queries: DataFrame, query_key: str, k: int | None, ordered_pairs: bool = False) -> DataFrame:
    """(row, query, similarity, rank): the k best queries of every corpus row.

    With `ordered_pairs` only queries with a greater key than the row count.
    """
    schema = f"{row_key} BIGINT, {query_key} BIGINT, similarity DOUBLE"
    if row_key == query_key:
        schema = f"{row_key}_a BIGINT, {query_key}_b BIGINT, similarity DOUBLE"
    slim = corpus.select(row_key, "embedding")
    parts = [slim.mapInArrow(_row_scorer(row_key, ids, m, k, ordered_pairs, schema), schema) for ids, m in query_blocks(queries, query_key)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if k is None:
        return out
    w = Window.partitionBy(row_key).orderBy(F.desc("similarity"), query_key)
    return out.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)


def _row_scorer(row_key: str, qids: np.ndarray, m: np.ndarray, k: int | None, ordered_pairs: bool, schema: str):
    names = [part.split(" ")[0] for part in schema.split(", ")]

    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            ids = batch.column(row_key).to_numpy(zero_copy_only=False).astype(np.int64)
            sims = np.round(unit(matrix_of(batch)) @ m.T, DECIMALS)
            if k is None or k >= len(qids):
                r, c = np.indices(sims.shape)
                r, c = r.ravel(), c.ravel()
            else:
                # ids ascend along the columns, so a stable sort breaks ties by id
                c = np.argsort(-sims, axis=1, kind="stable")[:, :k].ravel()
                r = np.repeat(np.arange(len(ids)), k)
            keep = ids[r] < qids[c] if ordered_pairs else np.ones(len(r), dtype=bool)
            r, c = r[keep], c[keep]
            yield pa.RecordBatch.from_arrays([pa.array(ids[r]), pa.array(qids[c]), pa.array(sims[r, c])], names=names)

    return run


def best_per_query(corpus: DataFrame, row_key: str, queries: DataFrame, query_key: str, k: int, exclude_same: bool = False) -> DataFrame:
    """(query, row, similarity, rank): the k best corpus rows of every query."""
    schema = f"{query_key} BIGINT, {row_key} BIGINT, similarity DOUBLE"
    slim = corpus.select(row_key, "embedding")
    parts = [slim.mapInArrow(_query_scorer(row_key, ids, m, k, exclude_same, schema), schema) for ids, m in query_blocks(queries, query_key)]
    out = parts[0] if parts else slim.sparkSession.createDataFrame([], schema)  # no questions
    for p in parts[1:]:
        out = out.unionByName(p)
    w = Window.partitionBy(query_key).orderBy(F.desc("similarity"), row_key)
    return out.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)


def _query_scorer(row_key: str, qids: np.ndarray, m: np.ndarray, k: int, exclude_same: bool, schema: str):
    names = [part.split(" ")[0] for part in schema.split(", ")]

    def run(batches):
        # running best k of the partition: at most k rows per query of the block
        best_q = np.empty(0, dtype=np.int64)
        best_id = np.empty(0, dtype=np.int64)
        best_s = np.empty(0, dtype=np.float64)
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            ids = batch.column(row_key).to_numpy(zero_copy_only=False).astype(np.int64)
            sims = np.round(m @ unit(matrix_of(batch)).T, DECIMALS)
            if exclude_same:
                sims[qids[:, None] == ids[None, :]] = -np.inf
            if n > k:
                floor = np.partition(sims, n - k, axis=1)[:, n - k]
                q, c = np.nonzero(sims >= floor[:, None])
            else:
                q, c = (x.ravel() for x in np.indices(sims.shape))
            s = sims[q, c]
            real = np.isfinite(s)
            best_q = np.concatenate([best_q, qids[q[real]]])
            best_id = np.concatenate([best_id, ids[c[real]]])
            best_s = np.concatenate([best_s, s[real]])
            order = np.lexsort((best_id, -best_s, best_q))
            best_q, best_id, best_s = best_q[order], best_id[order], best_s[order]
            first = np.searchsorted(best_q, best_q, side="left")
            keep = np.arange(len(best_q)) - first < k
            best_q, best_id, best_s = best_q[keep], best_id[keep], best_s[keep]
        yield pa.RecordBatch.from_arrays([pa.array(best_q), pa.array(best_id), pa.array(best_s)], names=names)

    return run


def best_labels(df: DataFrame, centroids: DataFrame, k: int) -> DataFrame:
    return best_per_row(df, "vec_id", centroids, "label", k)


def pair_scores(groups: DataFrame) -> DataFrame:
    """All unordered pairs of a table of group vectors (one row per group)."""
    return best_per_row(groups, "label", groups, "label", None, ordered_pairs=True)
