"""Communities by contraction and their hierarchy against a plain version, and their invariants."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from larkspan.operators import graphs


def half(node, depth, sweep):
    return hashlib.md5(f"{node}{depth}:{sweep}".encode()).hexdigest()[0] < "8"


def split(links, label):
    """Connected parts of every label, named by their smallest node."""
    near = defaultdict(set)
    for (a, b), _ in links.items():
        if label[a] == label[b]:
            near[a].add(b)
    out = {}
    for n in sorted(label):
        if n not in out:
            todo = [n]
            while todo:
                x = todo.pop()
                if x not in out:
                    out[x] = n
                    todo += near[x]
    return out


def plain(links, sweeps=2):
    """{node: community} of one graph; `links` has both directions."""
    nodes = sorted({a for a, _ in links})
    member, depth = {n: n for n in nodes}, 0
    while True:
        k = Counter()
        for (a, _), w in links.items():
            k[a] += w
        m = sum(k.values())
        label = {n: n for n in k}
        for r in range(2 * sweeps):
            tot = Counter()
            for n in k:
                tot[label[n]] += k[n]
            fresh = dict(label)
            for n in k:
                near = Counter({label[n]: 0})
                for (a, b), w in links.items():
                    if a == n and b != n:
                        near[label[b]] += w
                gain = {c: w * m - k[n] * (tot[c] - (k[n] if c == label[n] else 0)) for c, w in near.items()}
                best = min(gain, key=lambda c: (-gain[c], c))
                if half(n, depth, r // 2) == (r % 2 == 0) and gain[best] > gain[label[n]]:
                    fresh[n] = best
            label = fresh
        label = split(links, label)
        if quality(links, label) <= quality(links, {n: n for n in k}):
            return member
        member = {n: label[c] for n, c in member.items()}
        up = Counter()
        for (a, b), w in links.items():
            up[label[a], label[b]] += w
        links, depth = dict(up), depth + 1


def quality(links, label):
    m, k, inside = sum(links.values()), Counter(), 0
    for (a, b), w in links.items():
        k[label[a]] += w
        inside += w if label[a] == label[b] else 0
    return inside * m - sum(x * x for x in k.values())


def tree_of(links):
    """{(node, level, community, parent)}."""
    label, out, level = plain(links), set(), 0
    out |= {(n, 0, f"L0.{c}", "root") for n, c in label.items()}
    while True:
        parts = {}
        for c in set(label.values()):
            own = {e: w for e, w in links.items() if label.get(e[0]) == c and label.get(e[1]) == c}
            if own:
                p = plain(own)
                if len(set(p.values())) > 1:
                    parts |= p
        if not parts:
            return out
        level += 1
        out |= {(n, level, f"L{level}.{p}", f"L{level - 1}.{label[n]}") for n, p in parts.items()}
        label = parts


def graph(seed, n, extra, cliques=0):
    rnd = random.Random(seed)
    links = Counter()
    for _ in range(extra):
        a, b = rnd.sample(range(n), 2)
        links[f"n{a:03}", f"n{b:03}"] += rnd.randint(1, 4)
    for c in range(cliques):
        for i in range(5):
            for j in range(i):
                links[f"c{c}{i}", f"c{c}{j}"] += 3
        links[f"c{c}0", f"c{(c + 1) % cliques}1"] += 1
    both = Counter()
    for (a, b), w in links.items():
        both[a, b] += w
        both[b, a] += w
    return dict(both)


def frame(spark, links):
    return spark.createDataFrame([(a, b, w) for (a, b), w in links.items()], "a string, b string, weight long")


@pytest.mark.parametrize("links", [graph(1, 30, 60), graph(2, 8, 9, 4)])
def test_equals_plain(spark, links):
    got = {r.node: r.community for r in graphs.communities(frame(spark, links)).collect()}
    assert got == plain(links)
    assert quality(links, got) > quality(links, {n: n for n in got}) and split(links, got) == got


def test_cliques_are_found(spark):
    got = {r.node: r.community for r in graphs.communities(frame(spark, graph(0, 2, 0, 6))).collect()}
    assert got == {f"c{c}{i}": f"c{c}0" for c in range(6) for i in range(5)}


def test_hierarchy_splits_until_none_splits(spark):
    links = graph(3, 24, 45)
    rows = graphs.hierarchy(frame(spark, links)).collect()
    assert {(r.node, r.level, r.community, r.parent) for r in rows} == tree_of(links)
    inner = {r.parent for r in rows}
    assert all(r.is_leaf == (r.community not in inner) for r in rows)
    nodes = {a for a, _ in links}
    for level in range(max(r.level for r in rows) + 1):
        part = [r.node for r in rows if r.level == level or (r.is_leaf and r.level < level)]
        assert sorted(part) == sorted(nodes)


def test_no_links(spark):
    assert graphs.communities(spark.createDataFrame([], "a string, b string, weight long")).count() == 0


VAIN = [(2, 8, 10), (3, 12, 20), (4, 40, 80)]  # graphs of which one moves in vain on a level


def level_of(links, depth, sweeps=2):
    """{node: community} of one level of one graph."""
    k = Counter()
    for (a, _), w in links.items():
        k[a] += w
    m, label = sum(k.values()), {n: n for n in k}
    for r in range(2 * sweeps):
        tot, fresh = Counter(), dict(label)
        near = {n: Counter({label[n]: 0}) for n in k}
        for n in k:
            tot[label[n]] += k[n]
        for (a, b), w in links.items():
            if a != b:
                near[a][label[b]] += w
        for n in k:
            gain = {c: w * m - k[n] * (tot[c] - (k[n] if c == label[n] else 0)) for c, w in near[n].items()}
            best = min(gain, key=lambda c: (-gain[c], c))
            if half(n, depth, r // 2) == (r % 2 == 0) and gain[best] > gain[label[n]]:
                fresh[n] = best
        label = fresh
    return split(links, label)


def plain_groups(parts):
    """({node: community}, levels that a group moved on in vain) of graphs that go on while any of them improves."""
    member, depth, vain = {a: a for links in parts for a, _ in links}, 0, 0
    while True:
        raised = False
        for i, links in enumerate(parts):
            label = level_of(links, depth)
            if quality(links, label) > quality(links, {n: n for n in label}):
                raised = True
                member = {n: label.get(c, c) for n, c in member.items()}
                up = Counter()
                for (a, b), w in links.items():
                    up[label[a], label[b]] += w
                parts[i] = dict(up)
            else:
                vain += label != {n: n for n in label}
        if not raised:
            return member, vain
        depth += 1


def test_groups_that_a_level_does_not_raise(spark):
    """They keep their links and are tried again, as long as another group improves."""
    parts = [{(f"{i}{a}", f"{i}{b}"): w for (a, b), w in graph(s, n, x).items()} for i, (s, n, x) in enumerate(VAIN)]
    every = {e: w for links in parts for e, w in links.items()}
    groups = spark.createDataFrame([(n, n[0]) for n in {a for a, _ in every}], "node string, g string")
    want, vain = plain_groups(parts)
    assert vain
    assert {r.node: r.community for r in graphs.communities(frame(spark, every), groups=groups).collect()} == want


def test_weights_beyond_long_products(spark):
    links = {e: w * 10**10 for e, w in graph(1, 12, 20).items()}
    got = {r.node: r.community for r in graphs.communities(frame(spark, links)).collect()}
    assert got == plain(links)


def test_rounds_move_numbers(spark, monkeypatch):
    """Of all stage tables only that of the numbered nodes holds names."""
    calls = []
    monkeypatch.setattr(graphs, "cut", lambda df, f=graphs.cut: calls.append(df.dtypes) or f(df))
    graphs.communities(frame(spark, graph(0, 2, 0, 6))).collect()
    named = [c for c in calls if "string" in dict(c).values()]
    assert len(named) == 1 and len(calls) > 10


def test_one_task_takes_a_small_graph(spark, monkeypatch):
    """A hierarchy that a task can hold takes a few tables, not some dozens a level."""
    links, calls = graph(3, 24, 45), []
    monkeypatch.setattr(graphs, "cut", lambda df, f=graphs.cut: calls.append(1) or f(df))
    rows = graphs.hierarchy(frame(spark, links)).collect()
    assert {(r.node, r.level, r.community, r.parent) for r in rows} == tree_of(links)
    assert len(calls) <= 5


def test_one_task_goes_on_below_the_first_rounds(spark, monkeypatch):
    """The first contraction by jobs, what is left of it and all further levels in one task each."""
    links, fits = graph(3, 24, 45), iter([False])
    monkeypatch.setattr(graphs, "_fits", lambda level, gamma: next(fits, True))
    rows = graphs.hierarchy(frame(spark, links)).collect()
    assert {(r.node, r.level, r.community, r.parent) for r in rows} == tree_of(links)
