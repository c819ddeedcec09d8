"""Spelling variants against all pairs of words and against a plain count of the documents."""

import random
import re
import zlib
from collections import Counter

import pytest

from larkspan.llm import queries, spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def plain_groups(counts, ratio=10):
    near = {w: [] for w in counts}
    words = sorted(counts)
    for i, a in enumerate(words):
        for b in words[i + 1 :]:
            if one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, ns in near.items():
        if ns:
            best = min(ns, key=lambda x: (-counts[x], x))
            if counts[best] >= ratio * counts[w]:
                form[w] = best
    out = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out.add((w, n, len(near[w]), f, counts.get(f), root))
    return out


def grouped(spark, counts):
    rows = spelling.group_variants(spark.createDataFrame(list(counts.items()), "word string, n bigint")).collect()
    assert len(rows) == len(counts)
    return {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}


@pytest.mark.parametrize("alphabet,low,high,n", [("ab", 7, 9, 300), ("aé", 1, 6, 60), ("abcdefgh", 7, 12, 400)])
def test_equals_all_pairs(spark, alphabet, low, high, n):
    rnd = random.Random(n)
    words = {"".join(rnd.choice(alphabet) for _ in range(rnd.randint(low, high))) for _ in range(n)}
    for w in list(words):
        i = rnd.randrange(len(w))
        words |= {w[:i] + rnd.choice(alphabet) + w[i:], w[:i] + rnd.choice(alphabet) + w[i + 1 :]}
    counts = {w: int(10 ** rnd.uniform(0, 5)) for w in words}
    assert grouped(spark, counts) == plain_groups(counts)


def test_long_words_runs_of_one_letter_and_chains(spark):
    long = "".join(random.Random(1).choice("abc") for _ in range(300))
    words = [long, long[:299], long[:150] + "z" + long[150:], long[1:], "q" * 30_000, "q" * 29_999, "a" * 7, "a" * 8, "a" * 9, "ba" * 5, "ab" * 5]
    counts = {w: 10 ** (i % 6) for i, w in enumerate(words)}
    assert grouped(spark, counts) == plain_groups(counts)


def plain_counts(docs):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            n[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 31 == 0 else w] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def counted(docs):
    return {r.word: r.n for r in spelling.counted_words(spelling.with_typos(spelling.runs(docs))).collect()}


def test_counts_with_nulls_long_texts_repeats_and_other_columns(spark):
    rnd = random.Random(3)
    bank = ["Märchens", "straßeÀ", "ÉTUDIANT", "Running", "runnings", "×÷abcdefg", "short", "abcdefgh"]
    rows = [(rnd.choice([None, 1, 2, i]), rnd.choice([None, "", " ".join(rnd.choices(bank, k=40)), "x1" + "y" * 9 + "2Running-running"]), "r", 0) for i in range(80)]
    rows += [(5, "Running " * 20_000, "r", 1), (6, "k" * 50_000, "r", 1), (6, "k" * 50_000, "r", 1)] + rows[:3]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, word string, n int")
    assert counted(docs) == plain_counts([r[:2] for r in rows])
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert spelling.group_variants(spelling.counted_words(spelling.runs(none))).count() == 0


def test_query_equals_plain_on_the_smallest_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = queries.queries()["op11_spelling"](spark, "/root/testdata/sf0.001")
    assert dict(got.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    rows = [(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in got.collect()]
    want = plain_groups(plain_counts(docs))
    assert len(rows) == len(want) and set(rows) == want
