"""Phrase collocations against a plain count of every phrase."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspan.llm import collocations as co
from larkspan.llm import queries


def plain(docs, threshold, longest=5, top=2000):
    f, n = {}, Counter()
    low = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    for text, lang in docs:
        lang = "und" if lang is None else lang
        c = f.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(low)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                c.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = set()
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= threshold}
        gone = set()
        for p, a in cand.items():
            for k in range(2, len(p)):
                gone |= {p[i : i + k] for i in range(len(p) - k + 1) if 100 * a >= 100 * cand[p[i : i + k]]}
        rows = []
        for p, a in cand.items():
            if p not in gone:
                score, cut = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), c[p[:cut]], c[p[cut:]]))
        out |= {(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top])}
    return out


def corpus(seed, n, langs=("en", "de", None, "und")):
    rnd = random.Random(seed)
    bank = [f"w{i}" for i in range(30)] + ["É", "été", "A", "a", "x y", "\x1c", "🙂"]
    fixed = [" ".join(rnd.choices(bank, k=6)) for _ in range(6)]
    for i in range(n):
        words = [rnd.choice(bank) if rnd.random() < 0.6 else rnd.choice(fixed) for _ in range(rnd.randint(0, 12))]
        yield None if i % 37 == 0 else "".join(w + rnd.choice([" ", "  ", "\t", ". ", ",", "\n", " "]) for w in words), rnd.choice(langs)


def found(spark, docs, threshold, parts=6, **more):
    df = spark.createDataFrame(docs, "text string, lang string").withColumn("phrase", F.lit("x")).withColumn("h", F.lit(1)).repartition(parts)
    rows = [tuple(r) for r in co.collocations(df, threshold=threshold, **more).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("threshold,cells,shards,top", [(12, 1 << 16, 4, 2000), (5, 1 << 6, 3, 20), (30, 1 << 10, 1, 2000)])
def test_equals_counting_everything(spark, threshold, cells, shards, top):
    docs = list(corpus(threshold, 400))
    got = found(spark, docs, threshold, n_cells=cells, shards=shards, top=top)
    assert got == plain(docs, threshold, top=top) and len(got) > 10


def test_late_words_are_counted_for_a_full_cycle(spark):
    """Phrases that only turn up in the last shard, and one that lies in every document."""
    docs = [("p q r s t. " * 3, "en")] * 40 + [(f"x{i} y{i}", "en") for i in range(40)] + [("late comers do count too", "en")] * 25
    assert found(spark, docs, 20, parts=1) == plain(docs, 20)
    assert found(spark, docs, 20, parts=40) == plain(docs, 20)


def test_counts_of_the_cycles_equal_the_counts_by_text(spark):
    docs = spark.createDataFrame(list(corpus(9, 300, ("en",))), "text string, lang string").repartition(5)
    stored = co.slices(docs)
    known, cells = co.frequent(stored, threshold=10)
    counts = co.phrase_counts(stored, known, cells, threshold=10)
    assert sorted(r.f for r in counts.collect()) == sorted(r.total for r in known.collect()) and np.count_nonzero(cells)


def test_products_pass_64_bits(spark):
    big = 3_000_000_019
    counts = spark.createDataFrame([("en", "a", 1, 3 * big), ("en", "b", 1, 7), ("en", "a b", 2, 5 * big)], "lang string, phrase string, k int, f long")
    totals = spark.createDataFrame([("en", 9_000_000_000_000_001)], "lang string, n long")
    assert co.scored(counts, totals).first().score == 1000 * 5 * big * 9_000_000_000_000_001 // (3 * big * 7)


def test_long_text_ties_and_empty_tables(spark):
    docs = [("a b " * 200_000, "en"), ("", "fr"), (None, None), ("Ab ab aB", "x")]
    assert found(spark, docs, 100) == plain(docs, 100)
    assert co.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0


def test_query_on_the_smallest_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("text", "lang").collect()]
    got = queries.queries()["op13_phrases"](spark, sf)
    assert {t for c, t in got.dtypes if c not in ("lang", "phrase", "rank")} == {"bigint"}
    assert {tuple(r) for r in got.collect()} == plain(docs, 100)
