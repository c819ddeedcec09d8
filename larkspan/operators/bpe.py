"""Byte-pair merges learnt from a corpus: a bounded loop of distributed counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspan.functions.text import tokens
from larkspan.storage import cut

# Marks around a symbol, so that neighbouring matches do not share characters.
OPEN, CLOSE = "\u0001", "\u0002"
CUT_EVERY = 8


def word_symbols(df: DataFrame, text: str) -> DataFrame:
    """(symbols, n): each distinct word as marked letters, with its count."""
    words = df.select(F.explode(tokens(F.col(text))).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    return words.select(F.regexp_replace("w", "(.)", f"{OPEN}$1{CLOSE}").alias("symbols"), "n")


def pair_counts(words: DataFrame) -> DataFrame:
    parts = F.regexp_extract_all("symbols", F.lit(f"{OPEN}([^{CLOSE}]*){CLOSE}"), F.lit(1))
    rows = words.select(parts.alias("p"), "n").where(F.size("p") > 1)
    pairs = F.transform(F.sequence(F.lit(0), F.size("p") - 2), lambda i: F.struct(F.get("p", i).alias("left"), F.get("p", i + 1).alias("right")))
    return rows.select(F.explode(pairs).alias("q"), "n").groupBy("q.left", "q.right").agg(F.sum("n").alias("pair_count"))


def learn_merges(df: DataFrame, text: str, rounds: int) -> list[tuple[int, str, str, int]]:
    """(round, left, right, count) per merge; one row per round reaches the driver."""
    words = word_symbols(df, text).persist()
    merges = []
    try:
        for r in range(1, rounds + 1):
            best = pair_counts(words).orderBy(F.desc("pair_count"), "left", "right").limit(1).collect()
            if not best:
                break
            a, b, n = best[0]["left"], best[0]["right"], best[0]["pair_count"]
            merges.append((r, a, b, n))
            merged = F.replace("symbols", F.lit(f"{OPEN}{a}{CLOSE}{OPEN}{b}{CLOSE}"), F.lit(f"{OPEN}{a}{b}{CLOSE}"))
            fresh = words.withColumn("symbols", merged)
            fresh = cut(fresh) if r % CUT_EVERY == 0 else fresh.persist()
            fresh.count()
            words.unpersist()
            words = fresh
    finally:
        words.unpersist()
    return merges
