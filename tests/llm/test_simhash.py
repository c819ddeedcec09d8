"""SimHash groups against comparing all pairs."""

import random
import re
from itertools import combinations

import pytest
import xxhash

from larkspan.llm import simhash


def plain(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64(g.encode(), 42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fps):
    label = {i: i for i in range(len(fps))}
    changed = True
    near = [(i, j) for i, j in combinations(range(len(fps)), 2) if (fps[i] ^ fps[j]).bit_count() <= 3]
    while changed:
        changed = False
        for i, j in near:
            m = min(label[i], label[j])
            if label[i] != m or label[j] != m:
                label[i] = label[j] = m
                changed = True
    return label


def test_five_positions_always_contain_a_block():
    assert len(simhash.BLOCKS) == 14
    assert all(any(set(b) <= set(five) for b in simhash.BLOCKS) for five in combinations(range(8), 5))
    masks = simhash.masks_under(simhash.masks_under(simhash.masks_under(0)[3])[5])
    assert all(m.bit_count() == 56 for m in masks)


def test_documents(spark):
    rnd = random.Random(4)
    base = [" ".join(rnd.choice("ab cd ef gh ij KL Mé ß".split()) + str(rnd.randint(0, 50)) for _ in range(rnd.randint(1, 80))) for _ in range(40)]
    texts = [None, "", " \t\n", "one", "one Two", "ONE two", "x\x1cy z\x85w", "w " * 30000] + base
    for b in base[:20]:
        w = b.split()
        for _ in range(4):
            v = list(w)
            v[rnd.randrange(len(v))] = "edit"
            texts.append("  ".join(v))
    texts += [base[0]] * 50
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, fp string, component_id int")
    fps = [plain(t) for t in texts]
    want = groups(fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_groups(df).collect()}
    assert got == {i: (f"{fps[i]:016x}", want[i]) for i in range(len(texts))}
    wide = [i for i, g in enumerate(wide_groups(texts)) if g == i]
    kept = {r.doc_id for r in simhash.one_of_each(df).collect()}
    assert set(wide) <= kept and len(kept) <= len(wide) + 3  # postings may miss a pair near the bound, never make one up


@pytest.mark.parametrize("limit", [4, 64])
def test_dense_postings_are_split_without_loss(spark, limit):
    rnd = random.Random(limit)
    centre = rnd.getrandbits(64)
    fps = {centre, 0, (1 << 64) - 1}
    while len(fps) < 400:
        x = rnd.choice([centre, rnd.choice(sorted(fps))])
        for b in rnd.sample(range(64 if rnd.random() < 0.3 else 20), rnd.randint(1, 5)):
            x ^= 1 << b
        fps.add(x)
    fps = sorted(fps)
    signed = [simhash._signed(f) for f in fps]
    edges = simhash.links(spark.createDataFrame([(s,) for s in signed], "fp bigint"), limit).collect()
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 3 for r in edges)
    label = {s: s for s in signed}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for r in edges:
        label[max(root(r.a), root(r.b))] = min(root(r.a), root(r.b))
    want = groups(fps)
    assert len({root(s) for s in signed}) == len(set(want.values()))
    assert all((root(signed[i]) == root(signed[j])) == (want[i] == want[j]) for i, j in combinations(range(len(fps)), 2))


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_groups(df).count() == 0


def test_one_row_of_each_group_with_repeats_and_without_ids(spark):
    a, b = "one two three four five six", "quite another text that has its own words here"
    rows = [(1, a), (5, a), (5, b), (7, b), (None, a), (None, a), (None, "a third text, alone in the world of texts"), (1, a)]
    docs = spark.createDataFrame([(i, t, "x", "y", 0) for i, t in rows], "doc_id bigint, text string, component_id string, fingerprint string, __kept int")
    got = simhash.one_of_each(docs.repartition(3))
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in got.collect()) == sorted([(1, a), (5, b), (0, rows[6][1])])


def shingles(text, k=5):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def plain_wide(text):
    """The long fingerprint bit by bit."""
    def mix(z):
        z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 % 2**64
        z = (z ^ z >> 27) * 0x94D049BB133111EB % 2**64
        return z ^ z >> 31

    own = [xxhash.xxh64(b" ".join(g), 42).intdigest() for g in shingles(text)]
    h = [b"".join(mix((x + i * 0x9E3779B97F4A7C15) % 2**64).to_bytes(8, "little") for i in range(1, 9)) for x in own]
    bits = [sum(x[b // 8] >> 7 - b % 8 & 1 for x in h) * 2 > len(h) for b in range(512)]
    return sum(1 << b for b, on in enumerate(bits) if on)


def wide_groups(texts, bits=simhash.WIDE_BITS):
    fps = [plain_wide(t) for t in texts]
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for i, j in combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= bits:
            a, b = root(i), root(j)
            label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def edited(rnd, words, rate):
    return " ".join(f"new{rnd.randrange(10**6)}" if rnd.random() < rate else w for w in words)


def corpus(seed, n=40):
    rnd = random.Random(seed)
    base = [[f"w{rnd.randrange(4000)}" for _ in range(rnd.randint(60, 400))] for _ in range(n)]
    return rnd, base, [" ".join(w) for w in base]


def test_wide_fingerprint_equals_plain():
    for t in [None, "", "a", "A b c d", "One two three four five six", " ".join(f"w{i % 7000}" for i in range(9000))]:
        fp = simhash.wide_fingerprint(t)
        assert sum(1 << b for b in range(512) if fp[b // 8] >> 7 - b % 8 & 1) == plain_wide(t)


def test_near_copies_at_five_words_and_similarity_of_four_fifths(spark):
    rnd, base, texts = corpus(7)
    for w in base:
        texts += [edited(rnd, w, rate) for rate in (0.004, 0.008, 0.012, 0.02, 0.1, 0.2)]
    got = {r.at: r.component_id for r in simhash.similar_groups(spark.createDataFrame(list(enumerate(texts)), "at bigint, text string"), "at").collect()}
    sets = [shingles(t) for t in texts]
    alike = {(i, j): len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i, j in combinations(range(len(texts)), 2)}
    near = [p for p, s in alike.items() if s >= 0.8]
    linked = sum(got[i] == got[j] for i, j in near)
    assert len(near) > 80 and linked >= 0.95 * len(near)
    far = [max(s for p, s in alike.items() if i in p) for i in range(len(texts))]
    members = [sum(c == got[i] for c in got.values()) for i in range(len(texts))]
    assert all(members[i] == 1 for i in got if far[i] < 0.55)
    want = wide_groups(texts)  # never coarser than all pairs of fingerprints, and hardly finer
    assert all(want[i] == want[got[i]] for i in got)
    assert len(set(got.values())) - len(set(want)) <= 2


@pytest.mark.parametrize("limit", [8, 40])
def test_large_families_keep_one_group(spark, limit):
    """Long postings are split, families of copies cut into blocks; groups stay those of all pairs."""
    rnd, base, texts = corpus(limit, 12)
    texts += [edited(rnd, base[0], 0.003) for _ in range(150)] + [edited(rnd, base[1], 0.003) for _ in range(60)] + [texts[2]] * 90
    docs = spark.createDataFrame(list(enumerate(texts)), "at bigint, text string").repartition(5)
    got = {r.at: r.component_id for r in simhash.similar_groups(docs, "at", limit=limit).collect()}
    want = wide_groups(texts)
    assert got == dict(enumerate(want))


def test_walk_equals_all_pairs():
    import numpy as np

    rnd = np.random.default_rng(3)
    centres = rnd.integers(0, 2**63, (30, 8), dtype=np.uint64)
    x = centres[rnd.integers(0, 30, 700)] ^ (np.uint64(1) << rnd.integers(0, 64, (700, 8)).astype(np.uint64))
    x = np.concatenate([x, rnd.integers(0, 2**63, (400, 8), dtype=np.uint64)])
    a, b = simhash._walk(x, 92)
    assert len(a) == 670 and simhash._close(x[a], x[b], 92).all()


def test_similar_groups_of_hard_rows(spark):
    rows = [(0, None), (1, ""), (2, " \n"), (3, "one"), (4, "ONE"), (5, "one two"), (6, "word " * 50000)]
    docs = spark.createDataFrame(rows, "at bigint, text string")
    assert {r.at: r.component_id for r in simhash.similar_groups(docs, "at").collect()} == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 5, 6: 6}
    assert simhash.similar_groups(docs.limit(0), "at").count() == 0


def test_a_long_posting_is_compared_whole(spark):
    """Two close fingerprints that share a long posting, but no third byte by which it is split, are linked."""
    import numpy as np

    rnd = np.random.default_rng(5)
    x = rnd.integers(0, 256, (30, 64), dtype=np.uint8)
    x[:, :2] = 7  # all in the posting of the first two bytes
    x[1] = x[0]
    apart = [p for p in range(64) if p not in (0, 1, 40, 42, 44, 46)]
    x[1, apart] ^= np.uint8(1) << rnd.integers(0, 8, len(apart)).astype(np.uint8)
    df = spark.createDataFrame([(i, bytearray(r.tobytes())) for i, r in enumerate(x)], "node bigint, fp binary")
    for limit in (8, 1024):
        assert [tuple(sorted(r)) for r in simhash.wide_links(df, limit=limit).collect()] == [(0, 1)]
