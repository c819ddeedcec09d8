"""The ring against a row-by-row walk, and its law."""

import hashlib
import random
import zlib
from collections import Counter

import pytest

from larkspan.llm import ring


def pos(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def walk(keys, shards, replicas):
    """Shard by key: own rows of each point first, then rows over its share, one by one, clockwise."""
    pts = sorted((pos(f"{s}:{r}") >> 16, s, r) for s in range(shards) for r in range(replicas))
    n = len(pts)
    own = [[] for _ in pts]
    for k in keys:
        cell = pos(k) >> 16
        i = next((i for i, p in enumerate(pts) if p[0] >= cell), 0)
        own[i].append((((cell - pts[-1][0] - 1) % ring.CELLS), pos(k), k))
    share = [0] * n
    for s in range(shards):
        mine = [i for i in range(n) if pts[i][1] == s]
        cap = len(keys) // shards + (s < len(keys) % shards)
        w = [len(own[i]) for i in mine]
        w = w if sum(w) else [1] * len(w)
        run = 0
        for i, x in zip(mine, w):
            share[i] = (run + x) * cap // sum(w) - run * cap // sum(w)
            run += x
    out, waiting, room = {}, [], [max(0, share[i] - len(own[i])) for i in range(n)]
    over = [sorted(o)[c:] for o, c in zip(own, share)]
    for i in range(n):
        out |= {k: pts[i][1] for _, _, k in sorted(own[i])[: share[i]]}
    for lap in range(2):  # first come, first served, round the ring
        for i in range(n):
            waiting += over[i] if lap == 0 else []
            for _, _, k in waiting[: room[i]]:
                out[k] = pts[i][1]
            took = min(room[i], len(waiting))
            waiting, room[i] = waiting[took:], room[i] - took
    assert not waiting
    return out, sum(map(len, over))


@pytest.mark.parametrize("shards,replicas,rows", [(4, 8, 203), (7, 3, 500), (40, 64, 1000), (5, 2, 3)])
def test_equals_a_walk(spark, shards, replicas, rows):
    rnd = random.Random(rows)
    keys = rnd.sample(range(10**9), rows)
    docs = spark.createDataFrame([(k, rnd.choice([None, "", "ab", "é" * 9])) for k in keys], "doc_id bigint, text string")
    got = ring.place(docs, shards, replicas).collect()
    want, over = walk([str(k) for k in keys], shards, replicas)
    per_shard = Counter(r.shard for r in got)
    assert len(got) == rows and sum(r.moved for r in got) == over
    assert Counter(want.values()) == per_shard
    assert max(per_shard.values()) - min(per_shard.get(s, 0) for s in range(shards)) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(per_shard.get(s, 0)))
    stayed = {str(r.doc_id): r.shard for r in got if not r.moved}
    assert all(want[k] == s for k, s in stayed.items())


def test_nulls_repeats_and_extra_columns(spark):
    rows = [(None, None, "a", 1), (None, "x", "b", 2), (1, "ä", "c", 3)] + [(7, "same", "d", 4)] * 50
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, shard string, slot int")
    got = ring.place(docs, 4, 4).collect()
    assert sorted(Counter(r.shard for r in got).values()) == [13, 13, 13, 14]
    assert {(r.doc_id, r.size, r.text_crc32) for r in got} == {(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _, _ in rows}


def test_empty(spark):
    assert ring.place(spark.createDataFrame([], "doc_id bigint, text string"), 4, 4).count() == 0
