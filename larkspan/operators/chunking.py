"""Cutting documents into chunks."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspan.functions.text import let, word_count

# Separators tried in order; the empty one cuts anywhere.
PLAIN = ("\n\n", "\n", " ", "")
MARKDOWN = ("\n# ", "\n## ", "\n### ", "\n\n", "\n", " ", "")
LINES = ("\n", "")


def cut_points(text: str, size: int, separators: Sequence[str]) -> list[int]:
    """Offsets at which a chunk may start or end; neighbours are at most `size` apart."""
    points = [0, len(text)]
    for sep in separators:
        wide = [(a, b) for a, b in zip(points, points[1:]) if b - a > size]
        if not wide:
            break
        for a, b in wide:
            if sep == "":
                points += range(a + size, b, size)
                continue
            at = text.find(sep, a, b)
            behind = 1 if sep.endswith("# ") else len(sep)  # a heading's marks open the chunk it begins
            while at != -1:
                points.append(at + behind)
                at = text.find(sep, at + len(sep), b)
        points = sorted(set(points))
    return points


def spans(text: str, size: int, overlap: int, separators: Sequence[str] = PLAIN) -> list[tuple[int, int]]:
    """Greedy packing: each span as long as fits, the next one starting in its tail."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below the size")
    if not text:
        return []
    points = cut_points(text, size, separators)
    out, i, last = [], 0, len(points) - 1
    while i < last:
        j = max(bisect_right(points, points[i] + size) - 1, i + 1)
        out.append((points[i], points[j]))
        if j == last:
            break
        # first cut point inside the tail that still leaves room for the next piece
        k = bisect_left(points, max(points[j] - overlap, points[j + 1] - size), i + 1, j)
        i = k
    return out


def chunk_recursive(df: DataFrame, key: str, text: str, size: int, overlap: int, separators: Sequence[str] = PLAIN) -> DataFrame:
    """(key, chunk_index, start_index, chunk) by separators in order of preference."""
    schema = T.StructType(
        [
            df.schema[key],
            T.StructField("chunk_index", T.IntegerType()),
            T.StructField("start_index", T.IntegerType()),
            T.StructField("chunk", T.StringType()),
        ]
    )

    def run(batches):
        for batch in batches:
            keys, index, starts, parts = [], [], [], []
            for k, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for n, (a, b) in enumerate(spans(body or "", size, overlap, separators)):
                    keys.append(k)
                    index.append(n)
                    starts.append(a)
                    parts.append(body[a:b])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, batch.schema.field(0).type), pa.array(index, pa.int32()), pa.array(starts, pa.int32()), pa.array(parts, pa.string())],
                names=schema.names,
            )

    return df.select(key, text).mapInArrow(run, schema)


FORMATS = {"plain": PLAIN, "markdown": MARKDOWN}
HEADING = re.compile(r"^(#{1,6}) +(.+?)[ \t]*$", re.MULTILINE)


def heading_paths(text: str) -> list[tuple[int, str]]:
    """(start, path) of every Markdown heading; the path names the headings it stands under."""
    open_, out = [], []
    for m in HEADING.finditer(text):
        depth = len(m[1])
        open_ = [(d, h) for d, h in open_ if d < depth] + [(depth, m[2])]
        out.append((m.start(), " > ".join(h for _, h in open_)))
    return out


def chunk_by_format(df: DataFrame, key: str, text: str, fmt: str, size: int, overlap: int) -> DataFrame:
    """(key, fmt, chunk_index, start_index, heading, chunk): each row split by the separators of its own format.

    Markdown chunks keep the path of headings they start under, other chunks an empty one. An unknown or null
    format is plain; null text gives no chunks."""
    schema = T.StructType([df.schema[key], T.StructField(fmt, T.StringType()), T.StructField("chunk_index", T.IntegerType()), T.StructField("start_index", T.IntegerType()), T.StructField("heading", T.StringType()), T.StructField("chunk", T.StringType())])

    def run(batches):
        for batch in batches:
            rows = []
            for k, kind, body in zip(*(batch.column(i).to_pylist() for i in range(3))):
                kind = kind if kind in FORMATS else "plain"
                paths = heading_paths(body or "") if kind == "markdown" else []
                for n, (a, b) in enumerate(spans(body or "", size, overlap, FORMATS[kind])):
                    under = [p for at, p in paths if at <= a]
                    rows.append((k, kind, n, a, under[-1] if under else "", body[a:b]))
            cols = list(zip(*rows)) or [[] for _ in schema.names]
            kinds = [batch.schema.field(0).type, pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, kinds)], names=schema.names)

    return df.select(key, fmt, text).mapInArrow(run, schema)


def chunk_fixed(df: DataFrame, key: str, text: str, size: int, overlap: int) -> DataFrame:
    """Sliding windows; ceil((L - overlap) / (size - overlap)) chunks, one at least."""
    step = size - overlap
    n = F.length(text)
    count = F.greatest(F.ceil((n - overlap) / step), F.lit(1)).cast("int")
    rows = df.where(n > 0).select(key, F.col(text).alias("__t"), F.explode(F.sequence(F.lit(0), count - 1)).alias("chunk_index"))
    start = F.col("chunk_index") * step
    return rows.select(key, "chunk_index", start.alias("start_index"), F.substring("__t", start + 1, F.lit(size)).alias("chunk"))


def budget_chunks(sizes: Column, budget: int | Column) -> Column:
    """Chunk number of each record when records are packed in order and never split."""
    limit = budget if isinstance(budget, Column) else F.lit(budget)
    start = F.struct(F.lit(0).alias("chunk"), F.lit(0).alias("used"), F.expr("cast(array() as array<int>)").alias("out"))

    def step(acc, n):
        full = (F.size(acc["out"]) > 0) & (acc["used"] + n > limit)
        chunk = acc["chunk"] + F.when(full, 1).otherwise(0)
        return F.struct(chunk.alias("chunk"), F.when(full, n).otherwise(acc["used"] + n).alias("used"), F.concat(acc["out"], F.array(chunk)).alias("out"))

    return F.aggregate(sizes, start, step, lambda acc: acc["out"])


def packed_lines(df: DataFrame, key: str, text: str, budgets: list[int]) -> DataFrame:
    """(key, budget, line, chunk_index, n_words): lines packed per budget."""
    lines = df.select(key, F.split(text, "\n").alias("ls"))
    words = F.transform("ls", lambda s: word_count(s))

    def packed(ws: Column) -> Column:
        per_budget = [F.struct(F.lit(b).alias("budget"), ws.alias("w"), budget_chunks(ws, b).alias("c")) for b in budgets]
        return F.array(*per_budget)

    rows = lines.select(key, F.explode(let(words, packed)).alias("p"))
    flat = rows.select(key, "p.budget", F.posexplode(F.arrays_zip("p.w", "p.c")).alias("line", "r"))
    return flat.select(key, "budget", "line", F.col("r.c").alias("chunk_index"), F.col("r.w").alias("n_words"))
