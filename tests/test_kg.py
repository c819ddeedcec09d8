"""Names and mentions of the entity graph against a plain version, repeated and missing keys included."""

from __future__ import annotations

from collections import defaultdict

from larkspan.operators import kg


def plain(rows):
    words, texts = defaultdict(list), defaultdict(set)
    for doc, sent, ws in rows:
        for i, w in enumerate(ws):
            found = [(w, 1)] if len(w) >= kg.WORD_CHARS else []
            if i + 1 < len(ws) and len(w) >= kg.PAIR_CHARS and len(ws[i + 1]) >= kg.PAIR_CHARS:
                found.append((f"{w} {ws[i + 1]}", 2))
            for alias, n in found:
                words[doc, sent].append((-n, i, alias))
                texts[alias].add(doc)
    out = []
    for (doc, sent), found in words.items():
        kept = []
        for neg, pos, alias in sorted(f for f in found if len(texts[f[2]]) >= kg.MIN_DOCS):
            if not any(p < pos - neg and pos < p - n for n, p, _ in kept):
                kept.append((neg, pos, alias))
        out += [(doc, sent, pos, -neg, alias) for neg, pos, alias in kept]
    return sorted(out, key=repr)


def rows_of():
    vocabulary = ["harbour", "midnight", "telescope", "of", "granite", "by", "lanterns", "a", "umbrella"]
    long = [vocabulary[i * i % 9] if i % 7 else vocabulary[i % 5] for i in range(400)]
    rows = [(d, s, [vocabulary[(d * 5 + s * 3 + i * (d % 4 + 1)) % 9] for i in range(d % 11)]) for d in range(30) for s in range(3)]
    rows += [(d, s, ws[::-1]) for d, s, ws in rows[:12]] + [(None, 0, long[:9]), (None, 0, long[20:31]), (500, 0, long)]
    return rows + [(d % 4 + 1000, 9, ["quadrant"]) for d in range(12)] + [(d + 2000, 9, ["sextants"]) for d in range(kg.MIN_DOCS)]


def test_mentions_match_plain(spark):
    rows = rows_of()
    sents = spark.createDataFrame(rows, "doc_id bigint, sent int, words array<string>")
    found = kg.mentions(sents, kg.catalogue(sents))
    got = sorted([tuple(r) for r in found.select("doc_id", "sent", "pos", "n", "alias").collect()], key=repr)
    assert got == plain(rows)
    assert any(r[4] == "sextants" for r in got) and not any(r[4] == "quadrant" for r in got)


def test_catalogue_counts_texts_that_share_places(spark):
    """Few places, many uses: such names are counted by text."""
    docs = [r.id for r in spark.range(2000).where("pmod(xxhash64(id), 64) = 7").collect()]
    rows = [(d, 0, ["barometer"]) for d in docs[: kg.MIN_DOCS]] + [(d, s, ["astrolabe"]) for d in docs[: kg.MIN_DOCS - 1] for s in range(9)]
    sents = spark.createDataFrame(rows, "doc_id bigint, sent int, words array<string>")
    assert [tuple(r) for r in kg.catalogue(sents).collect()] == [("barometer", "barometer", "short")]


def test_no_row_or_group_holds_a_sentence(spark):
    sents = spark.createDataFrame(rows_of(), "doc_id bigint, sent int, words array<string>")
    plan = kg.mentions(sents, kg.catalogue(sents))._jdf.queryExecution().toString()
    assert "collect_list" not in plan and "aggregate(" not in plan
    mine = kg._candidates(sents, "doc_id")._jdf.queryExecution().optimizedPlan()
    kept = []
    while mine.children().size():
        if mine.nodeName() == "Generate":
            kept += [mine.requiredChildOutput().apply(i).name() for i in range(mine.requiredChildOutput().size())]
        mine = mine.children().apply(0)
    assert kept and "words" not in kept
