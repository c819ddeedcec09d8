"""Toxicity: gradients by differences, windows cover texts, held-out accuracy, defined results."""

import random
import zlib

import numpy as np
import pytest

from larkspan.llm import toxicity as x


def test_windows_cover_every_word():
    sizes = np.array([0, 1, 15, 16, 17, 24, 25, 100])
    text, first = x.windows(sizes)
    for i, n in enumerate(sizes):
        starts = first[text == i].tolist()
        assert sorted({w for s in starts for w in range(s, min(s + x.WINDOW, n))}) == list(range(n))
        assert all(b - a == x.STRIDE for a, b in zip(starts, starts[1:])) and all(s < n for s in starts)


def test_gradients_equal_differences():
    rng = np.random.default_rng(3)
    p = {k: v.astype(np.float64) for k, v in x.new_weights(rng).items()}
    inputs = rng.standard_normal((6, 5, 2 * x.DIM))
    mask = (np.arange(6)[:, None] < np.array([6, 6, 4, 1, 3])[None, :]).astype(float)
    want = np.array([1.0, 0, 1, 0, 1])

    def loss():
        logit, _ = x.rate(p, inputs @ p["xf"] + p["bf"], inputs @ p["xb"] + p["bb"], mask)
        return np.mean(np.log1p(np.exp(logit)) - want * logit)

    g, d_x = x.gradients(p, inputs, mask, want)
    for k in g:
        at = tuple(rng.integers(0, s) for s in p[k].shape)
        was = p[k][at]
        p[k][at] = was + 1e-4
        up = loss()
        p[k][at] = was - 1e-4
        assert g[k][at] == pytest.approx((up - loss()) / 2e-4, rel=2e-2, abs=1e-5), k
        p[k][at] = was
    inputs[1, 2, 3] += 1e-4
    up = loss()
    inputs[1, 2, 3] -= 2e-4
    assert d_x[1, 2, 3] == pytest.approx((up - loss()) / 2e-4, rel=2e-2, abs=1e-5)


def corpus(rnd, n):
    base = ["".join(rnd.choice("bdfglmnprst") + rnd.choice("aeiou") for _ in range(rnd.randint(1, 4))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        words = [rnd.choice(base) for _ in range(rnd.randint(3, 120))]
        toxic = rnd.random() < 0.3
        for _ in range(rnd.randint(1, 3) if toxic else 0):
            words.insert(rnd.randint(0, len(words)), rnd.choice(["Vexxo!", "quzzar", rnd.choice(base) + "wyx"]))
        rows.append((i, " ".join(words), "en", "x"))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_defined_results(spark):
    rows, labels = corpus(random.Random(5), 900)
    extra = [(5000, None, "en", "x"), (5001, "", "en", "x"), (5002, " \n\t", "en", "x"), (5003, "bada " * 30000 + " quzzar " + "bada " * 5000, "en", "x"), (None, "quzzar", "en", "x")]
    docs = spark.createDataFrame(rows + extra + rows[:2], "doc_id bigint, text string, lang string, score string")
    known = spark.createDataFrame([*labels, (labels[0][0], labels[0][1]), (7000, None), (None, 1)], "doc_id bigint, toxic int")
    got = x.toxicity(docs, known).collect()
    assert len(got) == len(rows) + len(extra) + 2
    by = {r.doc_id: r for r in got}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    held = [(by[i].predicted, y) for i, y in labels if by[i].held_out]
    assert len(held) > 150 and np.mean([a == b for a, b in held]) > 0.9
    assert [by[i].score for i in (5000, 5001, 5002)] == [0, 0, 0]
    assert by[5003].predicted == 1 and 29980 <= by[5003].worst_at <= 30000 and by[None].predicted == 1


def test_words_without_end_are_read_whole(spark):
    word = b"start" + b"ab" * 500 + b"quzzar" + b"cd" * 500
    pieces, of = x.inputs_in((b"bada " + word + b" dada").decode())
    framed = b"<" + word + b">"
    assert pieces[0] == b"bada" and pieces[-1] == b"dada" and of.tolist() == [0, *[1] * (len(pieces) - 2), 2]
    assert all(any(framed[i : i + x.HOP] in p for p in pieces) for i in range(len(framed) - x.HOP + 1))
    assert b"".join(p[1 : 1 + x.HOP] for p in pieces[1:-2]) + pieces[-2][1:] == framed
    assert x.inputs_in("- " + "-" * 200)[1].max() == 1 and x.inputs_in("bada dada")[1] is None
    rows, labels = corpus(random.Random(7), 900)
    docs = spark.createDataFrame([(i, "head" * 16 + t.replace(" ", "_")) for i, t, *_ in rows], "doc_id bigint, text string")
    got = {r.doc_id: r for r in x.toxicity(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()}
    held = [(got[i].predicted, y) for i, y in labels if got[i].held_out]
    assert np.mean([a == b for a, b in held]) > 0.85 and {r.worst_at for r in got.values()} == {0}


def test_phrases_lie_whole_in_a_window():
    first = set(x.windows(np.array([200]))[1].tolist())
    assert all(any(s <= i and i + 9 <= s + x.WINDOW for s in first) for i in range(192))


def test_too_little_to_learn_from(spark):
    docs = spark.createDataFrame([(0, "some words"), (1, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(0, 1)], "doc_id bigint, toxic int")
    assert {(r.doc_id, r.score) for r in x.toxicity(docs, labels).collect()} == {(0, 1.0), (1, 0.0)}
    assert {r.score for r in x.toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert x.toxicity(docs.limit(0), labels).count() == 0
