"""Language ID: the kernel against sets, the product form against the kernel, held-out accuracy."""

import random

import numpy as np

from larkspan.llm import langid

LANGS = {"aa": ["kala", "moro", "tiki", "sanu"], "bb": ["grünt", "schach", "bezit", "über"], "cc": ["nación", "verdad", "mañana", "olvido"]}


def text(rnd, lang, n):
    return " ".join("".join(rnd.sample(LANGS[lang], 2)) + rnd.choice(["", ".", ", "]) for _ in range(n))


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, score string")


def test_kernel_counts_common_grams():
    grams = langid.Grams()
    rnd = random.Random(1)
    sets = [grams(text(rnd, lang, 9)) for lang in "aa bb cc aa".split()]
    got = langid.kernel(sets, sets[:3])
    want = [[len(set(a) & set(b)) / np.sqrt(len(a) * len(b)) for b in sets[:3]] for a in sets]
    assert np.allclose(got, want, atol=1e-6)
    assert grams("A--b!") .tolist() == grams("  a B 12").tolist()
    assert all(len(grams(t)) == 0 for t in (None, "", " 12 %% \n"))


def test_held_out_accuracy_and_defined_results(spark):
    rnd = random.Random(2)
    rows = [(i, text(rnd, lang, rnd.randint(1, 30)), lang, "s", "x") for i, lang in enumerate(rnd.choices("aa bb cc".split(), k=600))]
    extra = [(1000, None, "aa", None, "x"), (1001, "12 %", "bb", "s", None), (1002, "", None, "s", "x"), (1003, text(rnd, "bb", 40000), None, "s", "x"), (None, text(rnd, "cc", 9), None, "s", "x")]
    df = table(spark, rows + extra + rows[:3])
    got = langid.identify(df).collect()
    assert len(got) == len(rows) + len(extra) + 3
    by = {r.doc_id: r for r in got}
    held = [(r.lang_pred, x[2]) for x in rows if (r := by[x[0]]).held_out]
    assert len(held) > 100 and np.mean([a == b for a, b in held]) > 0.97
    assert [by[i].lang_pred for i in (1000, 1001, 1002, 1003, None)] == ["und", "und", "und", "bb", "cc"]
    assert all(0 <= r.score <= 1 for r in got) and by[1000].score == 0
    kept = langid.known_language(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == set(by) - {1000, 1001, 1002}


def test_unseen_script_is_not_claimed(spark):
    rnd = random.Random(3)
    rows = [(i, text(rnd, lang, 20), lang, "s", "x") for i, lang in enumerate(rnd.choices("aa bb cc".split(), k=200))]
    df = table(spark, rows + [(900, "漢字のテキストです", None, "s", "x")])
    assert {r.doc_id for r in langid.known_language(df).collect()} == set(range(200))


def test_nothing_to_learn_from(spark):
    df = table(spark, [(1, "some text", None, "s", "x"), (2, None, "aa", "s", "x")])
    assert {(r.doc_id, r.lang_pred, r.score) for r in langid.identify(df).collect()} == {(1, "und", 0.0), (2, "und", 0.0)}
    assert [r.doc_id for r in langid.known_language(df).collect()] == [1]
    assert langid.identify(table(spark, [])).count() == 0
    assert langid.known_language(table(spark, [])).count() == 0
