"""The registered queries of the ten operators and of the pipeline, with their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspan.llm import bpe, chat, collocations, crosspolytope, langid, linededup, mixing, mixlm, onebit, ring, simhash, spelling, toxicity
from larkspan.tables import Tables

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(fn):
        _QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql:
            _SQL[fn.__name__] = sql
        return fn

    return register


@_query()
def op1_byte_bpe(t):
    return bpe.encode_documents(t.documents, RANKS, public_tokenizers.PATTERN)


@_query(linededup.oracle())
def op2_lines(t):
    left = linededup.dedup_lines(t.documents, counts="")
    return left.select("doc_id", "n_lines", "n_copies", "n_near", F.sha2("text", 256).alias("text_sha256"))


@_query()
def op3_simhash(t):
    return simhash.near_groups(t.documents)


@_query()
def op4_crosspolytope(t):
    return crosspolytope.near_vectors(t.embeddings)


@_query(mixing.oracle())
def op5_mix(t):
    return mixing.mix(t.documents).drop("at", "pick")


@_query()
def op6_language(t):
    return langid.identify(t.documents)


@_query()
def op7_onebit(t):
    return onebit.search(t.embeddings, F.col("vec_id") % 20 == 0, k=20)


@_query()
def op8_toxicity(t):
    return toxicity.toxicity(t.documents, t.labels)


@_query()
def op9_ring(t):
    placed = ring.place(t.documents, shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "moved")


@_query()
def op10_mixlm(t):
    return mixlm.score(t.documents)


@_query()
def op11_spelling(t):
    return spelling.group_variants(spelling.counted_words(spelling.with_typos(spelling.runs(t.documents))))


@_query(chat.oracle())
def op12_chat(t):
    return chat.digests(chat.format_chats(chat.with_forged(t.conversations)))


@_query()
def op13_phrases(t):
    return collocations.collocations(t.documents)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _QUERIES | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
