"""The language model: base scores by hand, a code that is a probability, learning that helps."""

import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest

from larkspan.llm import mixlm as m


def small_code(rnd):
    texts = [[w.encode() for w in rnd.choices(["the", "cat", "sat", "on", "mat", "Ünder", "x" * 30], k=rnd.randint(1, 30))] for _ in range(60)]
    c = Counter(w for t in texts for w in t)
    words = c.most_common(4)
    spelled = np.zeros(256, np.int64)
    for w, n in c.items():
        if w not in dict(words):
            for b in w:
                spelled[b] += n
            spelled[32] += n
    return m.Code(spelled, int(spelled[32]), len(texts), words), texts


def test_codes_are_complete_and_symbols_spell_the_text():
    code, texts = small_code(random.Random(1))
    assert math.isclose(sum(0.5 ** code.length[:256]), 1) and math.isclose(sum(0.5 ** code.length[256:]), 1)
    data, starts, sizes = m.symbols(code, texts)
    back = {s: w for w, s in code.symbol.items()}
    for t, a, n in zip(texts, starts, sizes):
        out, rare = [], None
        for s in data[a : a + n].tolist():
            if s == m.ESCAPE:
                rare = b""
            elif rare is not None and s != 32:
                rare += bytes([s])
            elif rare is not None:
                out.append(rare)
                rare = None
            elif s != m.END:
                out.append(back[s])
        assert out == t


def test_one_decision_more_splits_a_probability():
    """Texts that differ in their last symbol share everything before it: their chances add up to that of the start."""
    code, _ = small_code(random.Random(2))
    rnd = np.random.default_rng(0)
    odds = [rnd.integers(-40, 40, 1 << b).astype(np.int8) for b in m.BITS]
    every = [[b"the", w] for w in code.symbol]
    logs, _ = m.text_log10(code, odds, m.flat_start(), every + [[b"the"]])
    assert (logs < 0).all()
    assert sum(10**x for x in logs[:-1]) < 1  # all of them, and the text that ends, are some of what can follow
    total = sum(10 ** m.text_log10(code, odds, m.flat_start(), [[w]])[0][0] for w in code.symbol) + 10 ** m.text_log10(code, odds, m.flat_start(), [[]])[0][0]
    assert total <= 1 + 1e-6


def test_batches_do_not_change_a_score():
    code, texts = small_code(random.Random(3))
    rnd = np.random.default_rng(1)
    odds = [rnd.integers(-40, 40, 1 << b).astype(np.int8) for b in m.BITS]
    texts = texts + [[], [b"cat"] * 3000]
    together, _ = m.text_log10(code, odds, m.flat_start(), texts)
    alone = [m.text_log10(code, odds, m.flat_start(), [t])[0][0] for t in texts]
    assert np.allclose(together, alone, rtol=1e-4)


def base_by_hand(docs, held):
    words = {i: (t or "").encode().lower().split() for i, t in docs}
    train = [i for i, _ in docs if not held(i)]
    c = Counter(w for i in train for w in words[i])
    c[None] = len(train)
    n, v = sum(c.values()), sum(x > 0 for x in c.values())
    return {i: (sum(math.log10((c[w] + 1) / (n + v + 1)) for w in [*ws, None]), len(ws) + 1, sum(c[w] > 0 for w in [*ws, None]), n) for i, ws in words.items()}


@pytest.fixture(scope="module")
def docs():
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choice("Alpha beta gamma delta eps Zeta ÉTA".split()) + rnd.choice(["", ".", str(rnd.randint(0, 40))]) for _ in range(rnd.randint(1, 60)))) for i in range(300)]
    return rows + [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "word " * 20000), (1004, "unseen-" * 20)]


def test_query_columns_equal_the_formula(spark, docs, monkeypatch):
    monkeypatch.setattr(m, "HOT", 5)  # so that most words go the way of the joined ones
    df = spark.createDataFrame([(i, t, "x", 1.0) for i, t in docs], "doc_id bigint, text string, n string, score double")
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    want = base_by_hand(docs, held)
    got = m.score(df).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][1:] and r.held_out == held(r.doc_id)
        assert r.base_score == pytest.approx(want[r.doc_id][0], rel=1e-9)
        assert r.score < 0
    assert sum(r.score for r in got if r.held_out) > sum(r.base_score for r in got if r.held_out)


def test_repeats_and_nothing_to_learn(spark):
    df = spark.createDataFrame([(4, "a b a"), (4, "a b a"), (None, "c")], "doc_id bigint, text string")
    got = m.score(df).collect()
    assert len(got) == 3 and len({str(r) for r in got if r.doc_id == 4}) == 1
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = m.score(spark.createDataFrame([(held, "a b")], "doc_id bigint, text string")).first()
    assert (r.n_known, r.train_tokens, r.base_score) == (0, 0, 0.0)
    assert m.score(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_start_weights_come_from_every_training_row(spark):
    code, texts = small_code(random.Random(6))
    rnd = np.random.default_rng(2)
    odds = [rnd.integers(-40, 40, 1 << b).astype(np.int8) for b in m.BITS]
    rows = [(i, " ".join(w.decode() for w in texts[i % len(texts)][: 1 + i % 7])) for i in range(400)]
    got = m.learned_start(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), "text", code, odds)
    data, starts, sizes = m.symbols(code, [m.words_of(t) for _, t in rows])
    d = m.Decisions(code, data, m.positions(starts, sizes))
    x = np.array([o[d.slots(h, b)] / 16 for o, h, b in zip(odds, m.contexts(code, data), m.BITS)])
    p = 1 / (1 + np.exp(-m.START * x.sum(axis=0)))
    for g in range(m.GATES):
        of = d.gate == g
        step = np.linalg.solve((x[:, of] * (p * (1 - p))[of]) @ x[:, of].T + np.eye(3), x[:, of] @ (d.bit - p)[of])
        assert np.allclose(got[g], np.clip(m.START + step, 0, 1), atol=1e-3)


def log10_by_hand(code, odds, start, words):
    """One decision after the other, a segment at a time."""
    data, starts, sizes = m.symbols(code, [words])
    hashes, total, f = m.contexts(code, data), 0.0, np.float32
    for begin in range(starts[0], starts[0] + sizes[0], m.SEGMENT):
        d = m.Decisions(code, data, np.arange(begin, min(begin + m.SEGMENT, starts[0] + sizes[0])))
        x = np.array([table[d.slots(h, b)] for table, h, b in zip(odds, hashes, m.BITS)], f) / f(16)
        weights = start.astype(f)
        seen = 1 / (1 + np.exp(-((np.arange(m.CELLS, dtype=f) + f(0.5)) / 2 - m.CELLS / 4)))
        for i, (gate, bit) in enumerate(zip(d.gate, d.bit)):
            dot = (weights[gate] * x[:, i]).sum(dtype=f)
            p = 1 / (1 + np.exp(-dot))
            weights[gate] += x[:, i] * (f(m.RATE) * (bit - p))
            cell = int(np.clip(dot * 2 + m.CELLS / 2, 0, m.CELLS - 1))
            chance = (2 * p + seen[cell]) / 3
            seen[cell] += (bit - seen[cell]) * f(m.MAP_RATE)
            total += math.log10(max(chance if bit else 1 - chance, 1e-7))
    return total


@pytest.mark.parametrize("held, near", [(m.HELD_DECISIONS, m.NEAR), (3000, 64)])
def test_scores_equal_those_of_one_decision_after_the_other(monkeypatch, held, near):
    monkeypatch.setattr(m, "HELD_DECISIONS", held)
    monkeypatch.setattr(m, "NEAR", near)
    code, texts = small_code(random.Random(7))
    rnd = np.random.default_rng(3)
    odds = [rnd.integers(-40, 40, 1 << b).astype(np.int8) for b in m.BITS]
    start = rnd.uniform(0.1, 0.6, m.flat_start().shape).astype(np.float32)
    texts = [*texts[:12], [], [b"cat"] * 700, [b"x" * 300, b"the"] * 4]
    got, _ = m.text_log10(code, odds, start, texts)
    assert np.allclose(got, [log10_by_hand(code, odds, start, t) for t in texts], rtol=1e-4)


def test_a_slice_of_rare_words_is_coded_in_bounded_memory():
    """Some 6 million decisions: byte by byte they are many more than those of as long a text of frequent words."""
    code, _ = small_code(random.Random(8))
    odds = [np.ones(1 << b, np.int8) for b in m.BITS]
    rnd = np.random.default_rng(4)
    texts = [bytes(rnd.integers(97, 123, 60_000, np.uint8)).replace(b"e", b" ").split() for _ in range(10)]
    tracemalloc.start()
    m.text_log10(code, odds, m.flat_start(), texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6
