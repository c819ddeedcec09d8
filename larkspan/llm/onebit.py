"""Nearest neighbours by largest inner product over randomly rotated one-bit codes.

Every vector is stored as its distance from the mean of all, the signs of its
randomly rotated direction (one packed bit a dimension) and a correction: the
direction's inner product with its own signs. An inner product with a query is
estimated from bits and corrections, with a bound that the error keeps within
(EPSILON deviations). A block is searched by first ranking the best estimates
exactly; then every vector whose estimate plus bound reaches the k-th best found
so far is ranked exactly, the rest is passed over.

Queries and vectors meet in blocks: both are packed into rows of up to BLOCK
vectors; every query block meets the vector blocks of each of PARTS parts by an
equi-join on the part, and a task keeps the best k of one query block at a time.
So nothing is sent through the driver but the mean, and no pair is a row.

Equal vectors are stored once with their k + 1 smallest ids, more of which no
result can hold; a vector that a third of all rows share costs no more.

Defined results: vectors that are null, zero or hold null or non-finite
components take no part, as queries or candidates. Vectors of another length
than the query's are no candidates. Rows that repeat an id and its vector are
one row. Ties go to the smaller id. An empty table gives no rows. Other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspan.llm.vectors import by_dimension, matrix, usable
from larkspan.storage import written

BLOCK = 2048
PARTS = 8
EPSILON = 3.0
SEED = 7
_ARRAYS = ("ids", "counts", "vectors", "bits", "far", "own", "centre")


def rotation(dims: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def encode(v: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed signs, distance from the centre, correction) of each row."""
    rest = v - centre
    far = np.linalg.norm(rest, axis=1)
    turned = rest / np.where(far == 0, 1, far)[:, None] @ rotation(v.shape[1]).T
    return np.packbits(turned > 0, axis=1), far, np.abs(turned).sum(axis=1) / np.sqrt(v.shape[1])


def estimate(q: np.ndarray, bits: np.ndarray, far: np.ndarray, own: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(estimates, bounds) of all inner products of queries and coded vectors."""
    dims = q.shape[1]
    signs = np.unpackbits(bits, axis=1, count=dims).astype(np.float32) * 2 - 1
    own = np.maximum(own, 1e-6)
    along = (q @ rotation(dims).T).astype(np.float32) @ signs.T / np.sqrt(dims)
    found = (q @ centre)[:, None] + along * (far / own)[None, :]
    spread = np.sqrt(np.maximum(1 - own**2, 0)) / own * EPSILON / np.sqrt(max(dims - 1, 1))
    return found, np.linalg.norm(q, axis=1)[:, None] * (far * spread)[None, :] + 1e-4


class Best:
    """The best vectors so far of each query of a block: inner product, then the smallest id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), -np.inf)
        self.first = np.full((n, k), np.iinfo(np.int64).max)
        self.at = np.full((n, k), -1)  # numbers in `kept`
        self.kept: list[np.ndarray] = []  # ids of the vectors that were among the best

    def add(self, q: np.ndarray, score: np.ndarray, first: np.ndarray, ids: list) -> None:
        """Candidates by query number; `ids` has each candidate's ids."""
        for i in np.unique(q):
            of = np.flatnonzero(q == i)
            s, f = np.append(self.score[i], score[of]), np.append(self.first[i], first[of])
            order = np.lexsort((f, -s))[: self.k]
            at = np.append(self.at[i], -2 - of)[order]
            for j in np.flatnonzero(at <= -2):
                self.kept.append(ids[-2 - at[j]])
                at[j] = len(self.kept) - 1
            self.score[i], self.first[i], self.at[i] = s[order], f[order], at
        if len(self.kept) > 4 * self.at.size:  # let go of those that were overtaken
            live, place = np.unique(self.at[self.at >= 0], return_inverse=True)
            self.kept = [self.kept[j] for j in live]
            self.at[self.at >= 0] = place


def pack(vectors: DataFrame, shared) -> DataFrame:
    """Rows of up to BLOCK vectors: (block, dims, n, arrays...). `vectors` is (ids array, vector array)."""

    def run(batches):
        for batch in batches:
            for dims, part in by_dimension(batch, "vector"):
                for at in range(0, part.num_rows, BLOCK):
                    b = part.slice(at, BLOCK)
                    v, ids = matrix(b.column("vector")), b.column("ids")
                    flat = ids.flatten().to_numpy()
                    counts = pa.compute.list_value_length(ids).to_numpy(zero_copy_only=False)
                    centre = shared.value.get(dims, np.zeros(dims))
                    bits, far, own = encode(v, centre)
                    arrays = (flat.astype(np.int64), counts.astype(np.int32), v, bits, far, own, centre)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([flat[0]], pa.int64()), pa.array([dims], pa.int32()), pa.array([len(b)], pa.int32()), *(pa.array([np.ascontiguousarray(a).tobytes()], pa.binary()) for a in arrays)],
                        names=["block", "dims", "n", *_ARRAYS],
                    )

    return vectors.select("ids", "vector").mapInArrow(run, "block BIGINT, dims INT, n INT, " + ", ".join(f"{a} BINARY" for a in _ARRAYS))


def mean_by_dimension(vectors: DataFrame) -> dict[int, np.ndarray]:
    """The mean vector for each length; a row per task and length reaches the sum."""

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dims, part in by_dimension(batch, "vector"):
                v = matrix(part.column("vector"))
                sums[dims] = sums.get(dims, 0) + np.append(v.sum(axis=0), len(v))
        for dims, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([dims] * len(s), pa.int32()), pa.array(range(len(s)), pa.int32()), pa.array(s)], names=["dims", "i", "s"])

    sums = vectors.select("vector").mapInArrow(run, "dims INT, i INT, s DOUBLE").groupBy("dims", "i").agg(F.sum("s").alias("s")).collect()
    out: dict[int, np.ndarray] = {r.dims: np.zeros(r.dims + 1) for r in sums}
    for r in sums:
        out[r.dims][r.i] = r.s
    return {d: s[:-1] / s[-1] for d, s in out.items()}


def search(vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", parts: int = PARTS) -> DataFrame:
    """(query_id, rank, key, score): the k largest inner products of each query with any other row."""
    spark = vectors.sparkSession
    rows = vectors.where(usable(vector) & F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("vector"), is_query.alias("asks"))
    first = Window.partitionBy("vector").orderBy("id")
    few = rows.select("id", "vector").dropDuplicates(["vector", "id"]).withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
    distinct = few.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    distinct = written(distinct, "vectors")
    centre = spark.sparkContext.broadcast(mean_by_dimension(distinct))
    index = written(pack(distinct, centre).withColumn("part", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int")), "index")
    asked = rows.where("asks").select("id", "vector").distinct().repartition("id")
    blocks = written(pack(asked.select(F.array("id").alias("ids"), "vector"), centre).select("dims", F.col("block").alias("q_block"), F.col("n").alias("q_n"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors")), "queries")
    sent = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    met = sent.join(index, ["part", "dims"]).repartition("part", "q_block").sortWithinPartitions("part", "q_block")
    schema = "query_id BIGINT, score DOUBLE, ids ARRAY<BIGINT>"

    def out(q_ids, best):
        i, j = np.nonzero(best.at >= 0)
        ids = [best.kept[x] for x in best.at[i, j]]
        return pa.RecordBatch.from_arrays([pa.array(q_ids[i]), pa.array(best.score[i, j]), pa.array(ids, pa.list_(pa.int64()))], names=["query_id", "score", "ids"])

    def run(batches):
        now, best, q_ids = None, None, None
        for batch in batches:
            for r in batch.to_pylist():
                dims, n = r["dims"], r["n"]
                if now != (r["part"], r["q_block"]):
                    if best is not None:
                        yield out(q_ids, best)
                    now, q_ids = (r["part"], r["q_block"]), np.frombuffer(r["q_ids"], np.int64)
                    q, best = np.frombuffer(r["q_vectors"]).reshape(-1, dims), Best(r["q_n"], k + 1)
                v = np.frombuffer(r["vectors"]).reshape(n, dims)
                counts = np.frombuffer(r["counts"], np.int32)
                flat, starts = np.frombuffer(r["ids"], np.int64), np.cumsum(counts) - counts
                bits = np.frombuffer(r["bits"], np.uint8).reshape(n, -1)
                guess, bound = estimate(q, bits, np.frombuffer(r["far"]), np.frombuffer(r["own"]), np.frombuffer(r["centre"]))
                # exact values of the best estimates give the k-th best to beat
                top = np.argpartition(-guess, min(k, n - 1), axis=1)[:, : k + 1]
                exact = np.einsum("qd,qkd->qk", q, v[top])
                both = np.sort(np.concatenate([best.score, exact], axis=1), axis=1)[:, -(k + 1)]
                i, j = np.nonzero(guess + bound >= both[:, None])
                for at in range(0, len(i), 1 << 18):
                    a, b = i[at : at + (1 << 18)], j[at : at + (1 << 18)]
                    s = np.einsum("pd,pd->p", q[a], v[b])
                    good = s >= both[a]
                    a, b, s = a[good], b[good], s[good]
                    best.add(a, s, flat[starts[b]], [flat[starts[x] : starts[x] + counts[x]] for x in b])
        if best is not None:
            yield out(q_ids, best)

    found = met.mapInArrow(run, schema).select("query_id", "score", F.explode("ids").alias(key)).where(F.col(key) != F.col("query_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), key)
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", key, "score")
