"""Apportionment and targets against step-by-step versions; the mix keeps its limits."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from larkspan.llm import mixing


def one_by_one(votes, seats):
    won = [0] * len(votes)
    for _ in range(seats if sum(votes) else 0):
        i = max((i for i in range(len(votes)) if votes[i]), key=lambda i: (Fraction(votes[i], 2 * won[i] + 1), -i))
        won[i] += 1
    return won


@pytest.mark.parametrize("seed", range(6))
def test_apportion_equals_seat_by_seat(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for g in range(4):
        votes = [rnd.choice([0, 1, 1, 2, rnd.randint(1, 10**rnd.randint(1, 6))]) for _ in range(rnd.randint(1, 9))]
        seats = rnd.choice([0, 1, 2, rnd.randint(0, 60), rnd.randint(0, 400)])
        rows += [(g, i, v, seats, q) for i, (v, q) in enumerate(zip(votes, one_by_one(votes, seats)))]
    df = spark.createDataFrame(rows, "g int, i int, votes bigint, seats bigint, want bigint")
    got = mixing.apportion(df, ["g"], ["i"], "votes", "seats")
    assert got.count() == len(rows)
    assert got.where("quota <> want").collect() == []


def poured(sizes, weights=(3, 1, 2)):
    """Shares by weight; whatever is above a limit goes to the others, until none is above."""
    left, out = Fraction(3 * sum(sizes), 2), {}
    open_ = set(range(len(sizes)))
    while open_:
        w = sum(weights[i % 3] for i in open_)
        above = {i for i in open_ if left * weights[i % 3] >= 2 * sizes[i] * w}
        if not above:
            return {**out, **{i: left * weights[i % 3] / w for i in open_}}
        for i in above:
            out[i] = Fraction(2 * sizes[i])
        left -= sum(out[i] for i in above)
        open_ -= above
    return out


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rnd = random.Random(seed)
    sizes = [rnd.choice([0, 1, rnd.randint(1, 1000), rnd.randint(1, 9)]) for _ in range(rnd.randint(1, 12))]
    df = spark.createDataFrame([(chr(97 + i), s) for i, s in enumerate(sizes)], "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    assert got == pytest.approx({chr(97 + i): float(t) for i, t in poured(sizes).items()})


def test_hot_source_nulls_and_repeats(spark):
    rnd = random.Random(5)
    docs = [(i, " ".join(["w"] * rnd.randint(0, 60)), rnd.choice(["a", "a", "a", "b", "C", None, "é"]), "x") for i in range(400)]
    docs += [(900, None, "a", "x"), (901, "", None, "x"), (902, " \t\n", "b", "x"), (None, "p q", "b", "x")] + [(903, "same words here", "b", "x")] * 5 + [(904, "w " * 5000, "é", "x")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string, taken string")
    got = mixing.mix(df, shard_words=500).collect()
    assert len(got) == len(docs)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    by = mixing.mix(df, shard_words=500, keep=["source"]).groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("g"), F.count_distinct("pick").alias("shards"))
    for r in by.collect():
        # a shard's quota is rounded by a block at most, and its short last block counts as a whole one up to twice
        assert abs(r.t - r.g) <= 3 * mixing.BLOCK_WORDS * r.shards + mixing.BLOCK_WORDS, r
    again = mixing.mix(df, shard_words=500).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mixed_documents_hold_the_taken_words(spark):
    rnd = random.Random(6)
    docs = [(i, "\n".join(" ".join(f"w{i}.{j}.{k}" for k in range(rnd.randint(1, 30))) for j in range(3)), "en", f"s{i % 4}", 0, "z") for i in range(120)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint, taken string")
    taken = {r.doc_id: r.taken for r in mixing.mix(df).collect()}
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    words, whole = {}, {d[0]: d[1] for d in docs}
    for r in out.collect():
        assert r.n_chars == len(r.text)
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
        assert set(r.text.split()) <= set(whole[r.doc_id].split())
        if len(r.text.split()) == len(whole[r.doc_id].split()):
            assert r.text == whole[r.doc_id]
    assert words == {k: v for k, v in taken.items() if v}


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert mixing.mix(df).count() == 0


def test_taken_texts_have_no_holes(spark):
    """Every row of the mix is one unbroken part of its document, and few documents of a shard are cut."""
    docs = spark.createDataFrame([(i, " ".join(f"d{i}w{j}" for j in range(i % 40)), f"s{i % 3}") for i in range(900)], "doc_id long, text string, source string")
    docs = docs.withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("bigint"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = mixing.mixed_documents(docs, shard_words=2000).collect()
    assert got and all(r.text in texts[r.doc_id] or r.text.strip() in texts[r.doc_id] for r in got)
    shards = mixing.mix(docs, shard_words=2000, keep=["source"]).select("source", "pick").distinct().count()
    assert sum(r.text.strip() != texts[r.doc_id].strip() for r in got) <= 2 * 2 * shards
