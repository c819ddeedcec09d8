"""Shared parts of lexical, vector and hybrid retrieval; the lexical index is in `textindex`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspan.functions.text import tokens
from larkspan.operators.skew import top_n

K1, B = 1.2, 0.75  # fixed values of BM25
RRF = 60  # fixed value of reciprocal rank fusion
DIMS = 256
DECIMALS = 6


def bucket(word: Column) -> Column:
    return (F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("bigint") % DIMS).cast("int")


def hashed(text: Column) -> Column:
    """Hashed bag of words as an array of bucket numbers with repeats."""
    return F.transform(tokens(text), bucket)


def embed_sparse(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, dim, weight): unit-length hashed term frequencies, one row per non-zero dim."""
    counted = df.select(key, F.explode(hashed(F.col(text))).alias("dim")).groupBy(key, "dim").agg(F.count("*").alias("tf"))
    norms = counted.groupBy(key).agg(F.sqrt(F.sum(F.col("tf") * F.col("tf"))).alias("norm"))
    return counted.join(norms, key).select(key, "dim", (F.col("tf") / F.col("norm")).alias("weight"))


def fuse(lists: list[DataFrame], qkey: str, dkey: str, k: int) -> DataFrame:
    """Reciprocal rank fusion of ranked lists (qkey, dkey, rank)."""
    parts = [r.select(qkey, dkey, (1.0 / (RRF + F.col("rank"))).alias("s")) for r in lists]
    all_rows = parts[0]
    for p in parts[1:]:
        all_rows = all_rows.unionByName(p)
    fused = all_rows.groupBy(qkey, dkey).agg(F.round(F.sum("s"), 9).alias("rrf"), F.count("*").alias("lists"))
    out = top_n(fused, [qkey], [F.desc("rrf"), F.col(dkey)], k, "rank")
    return out.withColumn("rank", F.col("rank").cast("bigint"))
