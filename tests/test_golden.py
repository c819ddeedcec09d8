"""Worked numbers with known results."""

import pytest
from pyspark.sql import functions as F

from larkspan.functions import formats, pii, scoring, vectors
from larkspan.functions.text import numbers, sentences, terms
from larkspan.operators.bpe import learn_merges
from larkspan.operators.chunking import MARKDOWN, PLAIN, chunk_fixed, spans
from larkspan.plans.textual import check_claims
from larkspan.plans.windows import nucleus
from larkspan.tables import values


def one(spark, col):
    return spark.range(1).select(col.alias("x")).collect()[0]["x"]


def test_fixed_chunks(spark):
    df = values(spark, "k INT", [(1,)]).withColumn("t", F.repeat(F.lit("x"), 133_000))
    rows = chunk_fixed(df, "k", "t", 1000, 100).orderBy("chunk_index").collect()
    assert len(rows) == 148
    assert [r["start_index"] for r in rows[:2]] == [0, 900]
    assert rows[-1]["start_index"] + len(rows[-1]["chunk"]) == 133_000


def test_cosine(spark):
    arr = lambda *v: F.array(*[F.lit(float(x)) for x in v])
    assert one(spark, vectors.cosine(arr(1, 2, 3), arr(2, 4, 6))) == pytest.approx(1.0)
    assert one(spark, vectors.cosine(arr(1, 2, 3), arr(-3, 0, 1))) == pytest.approx(0.0)


@pytest.mark.parametrize("x,text", [(466515.95, "$466.52K"), (1418572.65, "$1.42M"), (850.75, "$850.75"), (-12400.0, "-$12.40K"), (0.0, "$0.00"), (None, "Not available")])
def test_money(spark, x, text):
    assert one(spark, formats.money(F.lit(x).cast("double"))) == text


def test_rupees(spark):
    assert one(spark, formats.indian_rupees(F.lit(1234567.0))) == "₹12,34,567"
    assert one(spark, formats.indian_rupees(F.lit(999.0))) == "₹999"


def test_nucleus(spark):
    p = [0.42, 0.24, 0.13, 0.08, 0.05, 0.04, 0.025, 0.015]
    df = values(spark, "k INT, i INT, prob DOUBLE", [(1, n, x) for n, x in enumerate(p)])
    rows = nucleus(df, "k", "i", 0.9).collect()
    assert len(rows) == 5
    assert sum(r["renormalised"] for r in rows) == pytest.approx(1.0)


def test_sentiment_formula(spark):
    words = F.array(F.lit("late"), F.lit("and"), F.lit("damaged"))
    pos, neg = scoring.polarity(words, scoring.lx.SENTIMENT)
    assert one(spark, neg) == pytest.approx(-3.1)
    assert round(one(spark, scoring.squash(pos + neg)), 2) == -0.62


def test_negation_flips(spark):
    words = F.split(F.lit("this is not a great phone but great price"), " ")
    assert one(spark, scoring.signed_sum(words, {"great": 3.1}, ["not"])) == pytest.approx(0.0)


def test_aspect_limits():
    with pytest.raises(ValueError):
        scoring.check_aspects({f"a{i}": ["x"] for i in range(11)})
    with pytest.raises(ValueError):
        scoring.check_aspects({"a" * 31: ["x"]})


def test_claim(spark):
    df = values(spark, "c STRING, e STRING", [("The company allows 30-day returns.", "Refunds are allowed within 10 days."), ("Refunds are allowed only within 10 days.", "Refunds are allowed within 10 days.")])
    rows = {r["c"]: r for r in check_claims(df, "c", "e").collect()}
    bad, good = rows["The company allows 30-day returns."], rows["Refunds are allowed only within 10 days."]
    assert (bad["supported"], bad["missing"]) == (False, "30")
    assert good["supported"]


def test_bpe(spark):
    df = values(spark, "t STRING", [("low lower lowest",)])
    merges = learn_merges(df, "t", 2)
    assert [(a, b) for _, a, b, _ in merges] == [("l", "o"), ("lo", "w")]


def test_terms_and_sentences(spark):
    assert sorted(one(spark, terms(F.lit("The orders were delayed by shipping boxes")))) == ["box", "delay", "order", "shipp"]
    assert one(spark, sentences(F.lit("One. Two!  Three?"))) == ["One.", "Two!", "Three?"]
    assert one(spark, numbers(F.lit("1,200 and 3.5"))) == ["1200", "3.5"]


def test_pii(spark):
    text = "Mail a.b@x.example.com or +1 (555) 123-4567, SSN 123-45-6789, again a.b@x.example.com"
    spans_ = one(spark, pii.detect(F.lit(text)))
    assert [(s["category"], text[s["start"] : s["end"]]) for s in spans_] == [
        ("EMAIL", "a.b@x.example.com"), ("PHONE_NUMBER", "+1 (555) 123-4567"), ("NATIONAL_ID", "123-45-6789"), ("EMAIL", "a.b@x.example.com"),
    ]
    assert "[EMAIL]" in one(spark, pii.redact(F.lit(text), ["EMAIL"]))
    with pytest.raises(ValueError):
        pii.redact(F.lit(text), ["SHOE_SIZE"])


@pytest.mark.parametrize("size,overlap", [(40, 10), (25, 0), (7, 3)])
@pytest.mark.parametrize("text", ["", "short", "word " * 50, "a" * 100, "# T\n\npara one is here\n\npara two\nline\n" * 6])
def test_recursive_chunks(size, overlap, text):
    for seps in (PLAIN, MARKDOWN):
        got = spans(text, size, overlap, seps)
        assert all(0 < b - a <= size for a, b in got)
        if text:
            assert got[0][0] == 0 and got[-1][1] == len(text)
        for (a, b), (c, d) in zip(got, got[1:]):
            assert a < c <= b < d and b - c <= max(overlap, 0)
        if overlap == 0:
            assert "".join(text[a:b] for a, b in got) == text
