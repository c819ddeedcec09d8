"""Extractive summaries: sentences scored by the frequency of their words."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspan.functions.text import sentences, tokens
from larkspan.operators.skew import top_n

SHORT_TEXT = 110  # fixed value: texts up to this length are returned unchanged
DECIMALS = 9


def sentence_words(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, pos, sentence, tok): one row per word, documents kept together.

    The raw text is shuffled once by key; the windows and aggregations per key
    that follow reuse that partitioning instead of shuffling every word."""
    rows = df.repartition(*keys).select(*keys, F.posexplode(sentences(F.col(text))).alias("pos", "sentence"))
    return rows.select(*keys, "pos", "sentence", F.explode(tokens(F.col("sentence"))).alias("tok"))


def summarize_rows(df: DataFrame, key: str, text: str, n: int = 2) -> DataFrame:
    """(key, summary): the n sentences with the highest mean word frequency, in text order."""
    slim = df.select(key, text)
    short = slim.where(F.length(text) <= SHORT_TEXT).select(key, F.col(text).alias("summary"))
    words = sentence_words(slim.where(F.length(text) > SHORT_TEXT), [key], text)
    freq = words.withColumn("f", F.count("*").over(Window.partitionBy(key, "tok")))
    scored = freq.groupBy(key, "pos").agg(F.round(F.avg("f"), DECIMALS).alias("score"), F.first("sentence").alias("sentence"))
    best = top_n(scored, [key], [F.desc("score"), F.col("pos")], n)
    ordered = F.array_sort(F.collect_list(F.struct("pos", "sentence")))
    joined = F.array_join(F.transform(ordered, lambda r: r["sentence"]), " ")
    out = best.groupBy(key).agg(joined.alias("summary"))
    # texts without any word have no sentence to choose
    empty = slim.where((F.length(text) > SHORT_TEXT) & (F.size(tokens(F.col(text))) == 0)).select(key, F.lit("").alias("summary"))
    return short.unionByName(out).unionByName(empty)


def summarize_groups(df: DataFrame, group: str, key: str, text: str, n: int = 3) -> DataFrame:
    """(group, summary): the n best sentences of all texts of a group.

    Word counts per group are partial aggregates; the sentence scores are cut to
    n per task before the final ranking, so no task ever holds a group."""
    words = sentence_words(df.select(group, key, text), [group, key], text).drop("sentence")
    per_sentence = words.groupBy(group, key, "pos", "tok").agg(F.count("*").alias("c"))
    counts = words.groupBy(group, "tok").agg(F.count("*").alias("f"))
    scored = (
        per_sentence.join(counts, [group, "tok"])
        .groupBy(group, key, "pos")
        .agg(F.round(F.sum(F.col("f") * F.col("c")) / F.sum("c"), DECIMALS).alias("score"))
    )
    best = top_n(scored, [group], [F.desc("score"), F.col(key), F.col("pos")], n)
    body = df.select(key, text)
    chosen = best.join(body, key).select(group, "rn", F.get(sentences(F.col(text)), F.col("pos")).alias("sentence"))
    ordered = F.array_sort(F.collect_list(F.struct("rn", "sentence")))
    return chosen.groupBy(group).agg(F.array_join(F.transform(ordered, lambda r: r["sentence"]), " ").alias("summary"))


def distinctive_terms(df: DataFrame, group: str, words, k: int, min_docs: int = 2) -> DataFrame:
    """Top k terms per group by (documents holding it) x ln(groups / groups holding it).

    `words` is an array column of the distinct words of a row."""
    per_group = df.select(group, F.explode(words).alias("term")).groupBy(group, "term").agg(F.count("*").alias("docs"))
    groups = df.select(group).distinct().agg(F.count("*").alias("groups"))  # one row
    spread = per_group.groupBy("term").agg(F.count("*").alias("held_by"))
    scored = per_group.where(F.col("docs") >= min_docs).join(spread, "term").join(F.broadcast(groups))
    scored = scored.withColumn("score", F.round(F.col("docs") * F.log(F.col("groups") / F.col("held_by")), DECIMALS))
    best = top_n(scored.where("score > 0"), [group], [F.desc("score"), F.col("term")], k)
    return best.select(group, "term", "docs", F.round("score", 6).alias("score"), F.col("rn").cast("bigint").alias("rank"))
