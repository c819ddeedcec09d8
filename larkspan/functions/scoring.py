"""Deterministic text scoring: labels, sentiment, cues. Row-local columns only.

Term tables are small and fixed, so they become literals of the plan: scoring
needs neither a join nor a shuffle and runs in the scan's own tasks.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larkspan import lexicons as lx
from larkspan.functions.text import STOPWORDS, let, sentences, tokens, weighted_sum

MAX_ASPECTS, MAX_ASPECT_CHARS = 10, 30


def label_scores(words: Column, topics: dict[str, dict[str, float]]) -> Column:
    """array<struct<neg_score, label>> sorted best first, zero scores left out."""
    rows = [F.struct((-weighted_sum(words, w)).alias("neg"), F.lit(name).alias("label")) for name, w in sorted(topics.items())]
    return F.array_sort(F.filter(F.array(*rows), lambda r: r["neg"] < 0))


def best_label(words: Column, topics: dict[str, dict[str, float]]) -> Column:
    return F.get(label_scores(words, topics), F.lit(0))["label"]


def described_terms(labels: dict[str, dict], description_weight: float = 1.0, example_weight: float = 2.0) -> dict[str, dict[str, float]]:
    """Term weights from label descriptions and few-shot examples."""
    import re

    out = {}
    for name, spec in labels.items():
        weights: dict[str, float] = {}
        for texts, weight in (([spec["description"]], description_weight), (spec["examples"], example_weight)):
            for word in {w for text in texts for w in re.findall(r"[a-z0-9]+", text.lower())}:
                if word not in STOPWORDS:
                    weights[word] = weights.get(word, 0.0) + weight
        out[name] = weights
    return out


def polarity(words: Column, lexicon: dict[str, float]) -> tuple[Column, Column]:
    pos = weighted_sum(words, {w: s for w, s in lexicon.items() if s > 0})
    neg = weighted_sum(words, {w: s for w, s in lexicon.items() if s < 0})
    return pos, neg


def squash(x: Column, alpha: float = lx.ALPHA) -> Column:
    return x / F.sqrt(x * x + alpha)


def sentiment_label(pos: Column, neg: Column) -> Column:
    s = squash(pos + neg)
    return (
        F.when((pos == 0) & (neg == 0), "unknown")
        .when((pos > 0) & (neg < 0), "mixed")
        .when(s >= lx.LABEL_BOUND, "positive")
        .when(s <= -lx.LABEL_BOUND, "negative")
        .otherwise("neutral")
    )


def check_aspects(aspects: dict[str, list[str]]) -> None:
    if len(aspects) > MAX_ASPECTS:
        raise ValueError(f"at most {MAX_ASPECTS} aspects")
    long = [a for a in aspects if len(a) > MAX_ASPECT_CHARS]
    if long:
        raise ValueError(f"aspects longer than {MAX_ASPECT_CHARS} characters: {long}")


def aspect_words(text: Column, cues: list[str]) -> Column:
    """Words of the sentences that mention a cue."""
    hit = F.filter(sentences(text), lambda s: F.exists(tokens(s), lambda w: w.isin(*cues)))
    return tokens(F.array_join(hit, " "))


def cue_level(words: Column, levels: dict[int, list[str]]) -> Column:
    """Highest level with a matching cue, else 0."""
    out = F.lit(0)
    for level, cues in sorted(levels.items()):
        out = F.when(F.exists(words, lambda w: w.isin(*cues)), F.lit(level)).otherwise(out)
    return out


def has_cue(words: Column, cues: list[str]) -> Column:
    return F.exists(words, lambda w: w.isin(*cues))


def signed_sum(words: Column, lexicon: dict[str, float], negations: list[str], reach: int = 2) -> Column:
    """Lexicon sum in which a negation within `reach` words before flips the sign."""
    by_weight: dict[float, list[str]] = {}
    for word, weight in lexicon.items():
        by_weight.setdefault(weight, []).append(word)

    def signs(ws: Column) -> Column:
        def negated(i: Column) -> Column:
            before = F.slice(ws, F.greatest(i - reach + 1, F.lit(1)), F.least(i, F.lit(reach)))
            return F.exists(before, lambda b: b.isin(*negations))

        marked = F.filter(F.transform(ws, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda r: r["w"].isin(*lexicon))
        return F.transform(marked, lambda r: F.struct(r["w"].alias("w"), F.when(negated(r["i"]), -1).otherwise(1).alias("sign")))

    def summed(hits: Column) -> Column:
        total = F.lit(0.0)
        for weight, vocabulary in sorted(by_weight.items()):
            mine = F.transform(F.filter(hits, lambda r: r["w"].isin(*vocabulary)), lambda r: r["sign"])
            total = total + F.lit(weight) * F.aggregate(mine, F.lit(0), lambda a, x: a + x)
        return total

    return let(let(words, signs), summed)


def claim_words(text: Column) -> Column:
    return F.filter(tokens(text), lambda w: ~w.isin(*STOPWORDS))


START = 5  # letters that two words must share at their start


def starts(words: Column, upto: int = START) -> Column:
    """Distinct beginnings of the words, of 1 to `upto` letters."""
    return F.array_distinct(F.flatten(F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.least(F.length(w), F.lit(upto))), lambda j: F.substring(w, F.lit(1), j)))))


def begun(asked: Column, words: Column) -> Column:
    """Those beginnings (of START letters, or whole shorter words) of the asked words with which some word starts."""
    return F.array_intersect(F.transform(asked, lambda w: F.substring(w, 1, START)), starts(words))


def covered_share(claim: Column, evidence: Column) -> Column:
    """Share of claim words whose 5-letter prefix fits an evidence word, or that start with a shorter evidence word.

    Both sides meet as sets of beginnings; no word is compared with every other."""

    def share(x: Column) -> Column:
        covered = F.filter(x["claim"], lambda w: F.array_contains(x["begun"], F.substring(w, 1, START)) | F.exists(x["short"], lambda e: w.startswith(e)))
        return F.size(covered) / F.greatest(F.size(x["claim"]), F.lit(1))

    def met(x: Column) -> Column:
        short = F.array_intersect(starts(x["claim"], START - 1), F.filter(x["evidence"], lambda e: F.length(e) < START))
        return let(F.struct(x["claim"].alias("claim"), begun(x["claim"], x["evidence"]).alias("begun"), short.alias("short")), share)

    return let(F.struct(claim.alias("claim"), evidence.alias("evidence")), met)
