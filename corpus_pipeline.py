"""From raw documents to token ids: language, lines, near copies, mix, encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which `run`
writes as Parquet and reads again as the next stage's documents. All stages but
the last return the columns of documents. The mix returns a row for each round
that takes some of a document's words, so a doc_id can come twice after it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from larkspan.llm import bpe, langid, linededup, mixing, simhash
from larkspan.storage import written
from larkspan.tables import Tables

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text a learned language claims; texts without a letter or with nothing of any language go."""
    return langid.known_language(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines that an earlier one repeats within one edit; documents of which nothing is left go."""
    return linededup.without_repeats(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of about 0.8 or more."""
    return simhash.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of each source near its target, some of them twice."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the digests of ids and decoded bytes."""
    return bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN, keep=("lang", "source", "n_chars"), with_ids=True, remember=False)


STAGES = [("language", language), ("lines", lines), ("near_copies", near_copies), ("mix", mix), ("encode", encode)]
ORACLE_SQL = None  # tokens, fingerprints and the language model are beyond SQL; tests/llm compares with plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
