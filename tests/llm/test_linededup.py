"""Line dedup against comparing every line with every earlier one."""

import random

import numpy as np
import pytest

from larkspan.llm import linededup as ld


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def brute(docs, min_chars):
    places = sorted({(d, n, line.strip(" \t\r\f\v")) for d, t in docs if t is not None for n, line in enumerate(t.split("\n")) if line.strip(" \t\r\f\v")}, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    first, gone = {}, {}
    for d, n, line in places:
        if line in first:
            gone.setdefault(d, set()).add(n)
            continue
        if len(line) >= min_chars and any(len(o) >= min_chars and within_one(line, o) for o in first):
            gone.setdefault(d, set()).add(n)
        first[line] = (d, n)
    out = []
    for d, t in docs:
        g = gone.get(d, set())
        out.append((d, t if not g else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in g)))
    return out


def edited(rnd, line):
    i = rnd.randrange(len(line))
    return rnd.choice([line[:i] + line[i + 1 :], line[:i] + rnd.choice("abé漢 ") + line[i:], line[:i] + rnd.choice("xyzü") + line[i + 1 :]])


def test_variants_of_equal_remainders_are_equal():
    (a, whole), _ = ld.variants("aabc")
    assert a[0] == a[1] == ld.variants("abc")[0][1] and whole == ld.variants("xaabc")[0][0][0]
    assert len({int(x) for x in a}) == 3 and np.uint64(whole) not in a


@pytest.mark.parametrize("seed", range(4))
def test_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    pool = ["".join(rnd.choice("ab cdé") for _ in range(rnd.randint(4, 24))) for _ in range(25)]
    for _ in range(150):
        pool.append(edited(rnd, rnd.choice(pool)) or "x")
    docs = [(i, "\n".join(rnd.choice(["", "  ", rnd.choice(pool), " " + rnd.choice(pool) + "\r"]) for _ in range(rnd.randint(1, 8)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "\n \n"), (103, pool[0] + "\n" + pool[0]), (None, pool[1] + "\n" + pool[2])]
    docs += [(104, "one very common line of text\n" + str(i)) for i in range(1)] + [(105 + i, "one very common line of text") for i in range(30)]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id bigint, text string, line string, n_lines int")
    assert ld.without_repeats(df).columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in ld.dedup_lines(df, min_chars=8).collect()), key=str)
    assert got == sorted(brute(docs, 8), key=str)


def test_many_lines_under_one_variant(spark):
    docs = [(i, f"an item of the long list, number {chr(0x4E00 + i)}") for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    left = ld.without_repeats(df).collect()
    assert [r.doc_id for r in left] == [0]


def test_repeated_rows_long_text_and_empty_table(spark):
    long = "word " * 20000
    df = spark.createDataFrame([(1, "a line that is kept here"), (1, "a line that is kept here"), (2, long), (3, long[:-2] + "s")], "doc_id bigint, text string")
    assert sorted((r.doc_id, r.text[:6]) for r in ld.without_repeats(df).collect()) == [(1, "a line"), (1, "a line"), (2, "word w")]
    assert ld.without_repeats(df.limit(0)).count() == 0


def test_only_the_judged_line_goes(spark):
    common, near = "one very common line of text", "one very common line of texts"
    docs = [(0, common), (5, common + "\nkept beside the copy"), (5, "unique in its own document\nand so is this"), (5, near + "\nkept beside the near copy")]
    docs += [(None, "shared by the nameless ones\nfirst of them"), (None, "shared by the nameless ones\nsecond one, unlike"), (None, "third, with nothing shared")]
    got = [r.text for r in ld.dedup_lines(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()]
    assert {"unique in its own document\nand so is this", "third, with nothing shared", "kept beside the copy", "kept beside the near copy"} <= set(got)
    assert "\n".join(got).split("\n").count("shared by the nameless ones") == 1
    assert {"first of them", "second one, unlike"} <= {line for t in got for line in t.split("\n")}
