"""Iterative graph jobs: bounded frontiers, components, communities.

Each round is a join and an aggregation; the state is written, so plans
stay short and a lost executor costs a round at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from larkspan.storage import cut

TASK_LINKS = 1 << 21  # links that one task may hold, about 300 MB


def khop(pairs: DataFrame, seeds: DataFrame, k: int) -> DataFrame:
    """(node, distance) for nodes within k hops. `pairs` is (a, b), `seeds` is (node)."""
    visited = cut(seeds.select("node", F.lit(0).alias("distance")))
    frontier = visited
    for hop in range(1, k + 1):
        reached = frontier.join(pairs, frontier["node"] == pairs["a"]).select(F.col("b").alias("node")).distinct()
        fresh = cut(reached.join(visited, "node", "left_anti").select("node", F.lit(hop).alias("distance")))
        if fresh.isEmpty():
            break
        visited = visited.unionByName(fresh)
        frontier = fresh
    return visited


def shortest_paths(pairs: DataFrame, seeds: DataFrame, k: int, sep: str = ">") -> DataFrame:
    """(node, hops, path): the first shortest path in text order."""
    visited = cut(seeds.select("node", F.lit(0).alias("hops"), F.col("node").alias("path")))
    frontier = visited
    for hop in range(1, k + 1):
        reached = frontier.join(pairs, frontier["node"] == pairs["a"])
        best = reached.select(F.col("b").alias("node"), F.concat_ws(sep, "path", "b").alias("path")).groupBy("node").agg(F.min("path").alias("path"))
        fresh = cut(best.join(visited.select("node"), "node", "left_anti").select("node", F.lit(hop).alias("hops"), "path"))
        if fresh.isEmpty():
            break
        visited = visited.unionByName(fresh)
        frontier = fresh
    return visited


def reachable(pairs: DataFrame, seeds: DataFrame) -> DataFrame:
    """(node) reachable along directed edges, seeds included; runs to the fixpoint.

    Shortcuts double as the search goes on: in each round the frontier takes one hop and, where a chain has no
    branches, its whole squared run, so a chain of n hops takes about log2(n) rounds. Shortcuts only exist for
    nodes with one edge out, so there is never more than one per node, and hubs are left to the hop."""
    edges = cut(pairs.select("a", "b").where("a <> b").distinct())
    alone = edges.groupBy("a").agg(F.count("*").alias("n"), F.min("b").alias("b")).where("n = 1").select("a", "b")
    frontier = visited = cut(seeds.select("node").distinct())
    ladder = [cut(alone)]
    while True:
        hop = frontier.join(edges, frontier["node"] == edges["a"]).select(F.col("b").alias("node"))
        for jump in ladder[1:]:
            hop = hop.unionByName(frontier.join(jump, frontier["node"] == jump["a"]).select(F.col("b").alias("node")))
        fresh = cut(hop.distinct().join(visited, "node", "left_anti"))
        if fresh.isEmpty():
            return visited
        visited = cut(visited.unionByName(fresh))
        frontier = visited if len(ladder) > 1 else fresh
        last = ladder[-1]
        further = last.select(F.col("a").alias("b"), F.col("b").alias("c"))
        twice = cut(last.join(further, "b").where("a <> c").select("a", F.col("c").alias("b")))
        if not twice.isEmpty():
            ladder.append(twice)


def components(pairs: DataFrame) -> DataFrame:
    """(node, component): component = smallest node of the weakly connected part.

    Neighbour minimum plus pointer jumping, so long chains need few rounds.
    `pairs` holds both directions."""
    labels = cut(pairs.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("component")))
    while True:
        around = pairs.join(labels, pairs["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("m"))
        step = labels.join(around, labels["node"] == around["a"]).select("node", F.least("component", "m").alias("component"), F.col("component").alias("old"))
        jump = labels.select(F.col("node").alias("via"), F.col("component").alias("far"))
        fresh = step.join(jump, step["component"] == jump["via"]).select("node", F.least("component", "far").alias("component"), "old")
        seen = Observation()
        labels = cut(fresh.observe(seen, F.count_if(F.col("component") != F.col("old")).alias("changed")).select("node", "component"))
        if not seen.get["changed"]:
            return labels


def chains(edges: DataFrame) -> DataFrame:
    """(node, head): nodes that hang in a row, each the only successor of its only predecessor, named by the
    first of the row; found by doubling. A row that closes to a ring has no first: its nodes have no head."""
    outs = edges.groupBy("a").agg(F.count("*").alias("n")).where("n = 1").select("a")
    ins = edges.groupBy("b").agg(F.count("*").alias("n")).where("n = 1").select("b")
    up = cut(edges.join(outs, "a", "left_semi").join(ins, "b", "left_semi").select(F.col("b").alias("node"), F.col("a").alias("head")))
    most, length = up.count(), 1
    while True:
        higher = up.select(F.col("node").alias("head"), F.col("head").alias("higher"))
        up = cut(up.join(higher, "head", "left").select("node", F.coalesce("higher", "head").alias("head"), F.col("higher").isNotNull().alias("moved")))
        length *= 2
        if length > 2 * most or up.where("moved").isEmpty():
            return up.select("node", F.when(~F.col("moved"), F.col("head")).alias("head"))
        up = up.drop("moved")


def peel(pairs: DataFrame) -> tuple[int, int]:
    """(nodes removed, nodes left) after removing nodes without incoming edges until none is left.

    Rows of nodes without branches are taken as one node first, so that a long row doesn't take a round per hop."""
    edges = cut(pairs.select("a", "b").distinct())
    row = chains(edges)
    ring = row.where("head is null").count()
    head = row.where("head is not null")
    sizes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().join(row.where("head is null"), "node", "left_anti")
    sizes = cut(sizes.join(head, "node", "left").groupBy(F.coalesce("head", "node").alias("node")).agg(F.count("*").alias("n")))
    total = (sizes.agg(F.sum("n")).first()[0] or 0) + ring
    inner = edges.join(row.select(F.col("node").alias("b")), "b", "left_anti").join(head.select(F.col("node").alias("a"), "head"), "a", "left")
    left = cut(inner.select(F.coalesce("head", "a").alias("a"), "b").distinct())
    before, after = -1, left.count()
    while after not in (0, before):
        targets = left.select(F.col("b").alias("t")).distinct()
        left = cut(left.join(targets, left["a"] == targets["t"], "left_semi"))
        before, after = after, left.count()
    # edges that never go away keep their end points (and what hangs below them); a loop never goes away
    stuck = left.select(F.col("a").alias("node")).union(left.select("b")).distinct().join(sizes, "node").agg(F.sum("n")).first()[0] if after else 0
    return total - (stuck or 0) - ring, (stuck or 0) + ring


def modularity(pairs: DataFrame, labels: DataFrame, gamma: float = 1.0) -> DataFrame:
    """One row: modularity of a partition. `pairs` holds both directions."""
    la = labels.select(F.col("node").alias("a"), F.col("community").alias("ca"))
    lb = labels.select(F.col("node").alias("b"), F.col("community").alias("cb"))
    joined = pairs.join(la, "a").join(lb, "b")
    inside = joined.agg(F.sum(F.when(F.col("ca") == F.col("cb"), F.col("weight")).otherwise(0)).alias("w_in"), F.sum("weight").alias("two_m"))
    per = joined.groupBy("ca").agg(F.sum("weight").alias("k")).agg(F.sum(F.col("k") * F.col("k")).alias("kk"))
    q = F.col("w_in") / F.col("two_m") - gamma * F.col("kk") / (F.col("two_m") * F.col("two_m"))
    return inside.join(F.broadcast(per)).select(q.alias("modularity"))


def early(node: Column, depth: int, sweep: int) -> Column:
    """Half of the nodes, another one in each sweep. In a round only one half may move, which keeps neighbours
    from swapping; halves that stayed the same would tie nodes of one half to each other for ever."""
    return F.substring(F.md5(F.concat(node, F.lit(f"{depth}:{sweep}"))), 1, 1) < "8"


def numbered(pairs: DataFrame) -> DataFrame:
    """(id, name) of the nodes; numbers are in the order of names, so that the smallest number has the smallest name."""
    names = pairs.select(F.col("a").alias("name")).distinct().where("name IS NOT NULL").orderBy("name")
    return cut(names.select(F.monotonically_increasing_id().alias("id"), "name"))


def _by_number(pairs: DataFrame, names: DataFrame) -> DataFrame:
    a, b = names.select(F.col("id").alias("ia"), F.col("name").alias("a")), names.select(F.col("id").alias("ib"), F.col("name").alias("b"))
    return pairs.join(a, "a").join(b, "b").select(F.col("ia").alias("a"), F.col("ib").alias("b"), "weight")


def _degrees(level: DataFrame, names: DataFrame, sizes: DataFrame, sweeps: int, depth: int) -> DataFrame:
    """(node, g, k, loop, two_m, turn): weights of a level's nodes; bit s of `turn` says that a node moves first in sweep s."""
    k = level.groupBy(F.col("a").alias("id")).agg(F.max("g").alias("g"), F.sum("weight").alias("k"), F.sum(F.when(F.col("a") == F.col("b"), F.col("weight")).otherwise(0)).alias("loop"))
    bits = [F.when(early(F.col("name"), depth, s), 1 << s).otherwise(0) for s in range(sweeps)]
    turn = sum(bits[1:], bits[0]) if bits else F.lit(0)
    return cut(k.join(names, "id").join(sizes, "g").select(F.col("id").alias("node"), "g", "k", "loop", "two_m", turn.alias("turn")))


def _moves(links: DataFrame, degree: DataFrame, gamma: tuple[int, int], sweeps: int, whole: str) -> DataFrame:
    """(node, community): each node with its best neighbour community by modularity gain, in rounds of one half each.

    Gains are whole numbers, so ties are exact; a node moves only to a better place, of equal ones to the smallest.
    A round reads only the links of the half that may move; they carry their node's weight, so no join fetches it."""
    mine = ["node", "k", "two_m", "turn"]
    labels = degree.select(*mine, F.col("node").alias("community"))
    for r in range(2 * sweeps):
        now = (F.col("turn").bitwiseAND(1 << r // 2) != 0) == F.lit(r % 2 == 0)
        totals = labels.groupBy("community").agg(F.sum("k").alias("tot"))
        near = links.where(now).join(labels.select(F.col("node").alias("b"), "community"), "b")
        near = near.select(F.col("a").alias("node"), "k", "two_m", "turn", "community", F.col("weight").alias("w"), F.lit(False).alias("own"))
        own = labels.where(now).select(*mine, "community", F.lit(0).cast("bigint").alias("w"), F.lit(True).alias("own"))
        options = near.unionByName(own).groupBy(*mine, "community").agg(F.sum("w").alias("w"), F.max("own").alias("own"))
        big = lambda x: F.col(x).cast(whole)
        x = options.join(totals, "community").withColumn("rest", F.col("tot") - F.when(F.col("own"), F.col("k")).otherwise(0))
        gain = big("w") * big("two_m") * gamma[1] - big("k") * big("rest") * gamma[0]
        x = x.withColumn("gain", gain if whole == "bigint" else gain.cast("decimal(38,0)"))
        best = x.groupBy(*mine).agg(
            F.min(F.struct((-F.col("gain")).alias("neg"), "community")).alias("p"), F.max(F.when(F.col("own"), F.col("gain"))).alias("stay"),
            F.max(F.when(F.col("own"), F.col("community"))).alias("current"),
        )
        moved = best.select(*mine, F.when(-F.col("p.neg") > F.col("stay"), F.col("p.community")).otherwise(F.col("current")).alias("community"))
        labels = cut(labels.where(~now).unionByName(moved))
    return labels.select("node", "community")


def _quality(degree: DataFrame, gamma: tuple[int, int]) -> DataFrame:
    """(g, n, q): nodes of each group and the modularity of them as communities, times the square of its weight, a whole number."""
    of = degree.groupBy("g", "two_m").agg(F.count("*").alias("n"), F.sum("loop").cast("decimal(19,0)").alias("w_in"), F.sum((F.col("k").cast("decimal(19,0)") * F.col("k").cast("decimal(19,0)")).cast("decimal(38,0)")).alias("squares"))
    q = F.col("w_in") * F.col("two_m").cast("decimal(19,0)") * gamma[1] - F.col("squares") * gamma[0]
    return of.select("g", "n", q.cast("decimal(38,0)").alias("q"))


def _contract(level: DataFrame, names: DataFrame, gamma: tuple[int, int], sweeps: int) -> DataFrame:
    """(node, community) by numbers, of `level` (g, a, b, weight): levels of contraction, see `communities`.

    The quality of a level's labels is that of the next level's nodes as communities of their own, so it is read
    off the weights which that level needs anyway. Groups that a level doesn't raise keep their links as they were.
    Once a task can hold a level's links, it takes that level and all that follow, see `_in_task`."""
    sizes = cut(level.groupBy("g").agg(F.sum("weight").alias("two_m")))
    most = sizes.agg(F.max("two_m")).first()[0] or 0
    whole = "bigint" if most * max(gamma) < 1 << 31 else "decimal(19,0)"  # gains are below the square of a group's weight
    nodes = level.select(F.col("a").alias("node")).distinct()
    steps, depth, degree = [], 0, _degrees(level, names, sizes, sweeps, 0)
    while True:
        links = cut(level.where("a <> b").join(degree.select(F.col("node").alias("a"), "k", "two_m", "turn"), "a").select("a", "b", "weight", "k", "two_m", "turn"))
        labels = cut(connected(links, _moves(links, degree, gamma, sweeps, whole)))
        la, lb = labels.select(F.col("node").alias("a"), F.col("community").alias("ca")), labels.select(F.col("node").alias("b"), F.col("community").alias("cb"))
        above = cut(level.join(la, "a").join(lb, "b").groupBy("g", F.col("ca").alias("a"), F.col("cb").alias("b")).agg(F.sum("weight").alias("weight")))
        after = _degrees(above, names, sizes, sweeps, depth + 1)
        compared = _quality(degree, gamma).join(_quality(after, gamma).select("g", F.col("n").alias("left"), F.col("q").alias("better")), "g")
        raised, undone = compared.agg(F.count_if(F.expr("better > q")), F.count_if(F.expr("better <= q AND left < n"))).first()
        if not raised:
            break
        if undone:
            kept = cut(compared.where("better > q").select("g"))
            above = cut(above.join(kept, "g", "left_semi").unionByName(level.join(kept, "g", "left_anti").select("g", "a", "b", "weight")))
            marked = labels.join(degree.select("node", "g"), "node").join(kept.withColumn("ok", F.lit(True)), "g", "left")
            labels = cut(marked.select("node", F.when(F.col("ok"), F.col("community")).otherwise(F.col("node")).alias("community")))
            after = _degrees(above, names, sizes, sweeps, depth + 1)
        steps.append(labels)
        level, degree, depth = above, after, depth + 1
        if _fits(level, gamma):
            steps.append(_in_task(level, names, gamma, sweeps, depth))
            break
    members = nodes.withColumn("community", F.col("node"))
    for step in steps:
        members = members.join(step.select(F.col("node").alias("community"), F.col("community").alias("upper")), "community").select("node", F.col("upper").alias("community"))
    return members


def _fits(level: DataFrame, gamma: tuple[int, int]) -> bool:
    """Whether one task can hold the links, and whole numbers of 64 bits their gains."""
    n, weight = level.agg(F.count("*"), F.sum("weight")).first()
    return n <= TASK_LINKS and (weight or 0) * max(gamma) < 1 << 31


def _in_task(level: DataFrame, names: DataFrame, gamma: tuple[int, int], sweeps: int, depth: int = 0, tree: int | None = None) -> DataFrame:
    """(node, community) of `level` (g, a, b, weight) from a depth on, by the rules of `_contract`; with `tree`, the
    (node, level, community, parent) of `hierarchy` from that level on, of links inside communities g.

    Levels of few links cost Spark a job a table; one task goes through all of them, with arrays of the links."""
    ends = level.select(F.col("a").alias("id")).distinct()
    own = names.join(ends, "id", "left_semi").select(F.lit(None).cast("bigint").alias("g"), F.col("id").alias("a"), F.lit(None).cast("bigint").alias("b"), F.lit(None).cast("bigint").alias("weight"), F.col("name").cast("binary").alias("name"))
    rows = level.select("g", "a", "b", F.col("weight").cast("bigint").alias("weight"), F.lit(None).cast("binary").alias("name")).unionByName(own)
    schema = "node bigint, community bigint" if tree is None else "node bigint, level int, community bigint, parent bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [b for b in batches if b.num_rows]
        if not kept:
            return
        table = pa.Table.from_batches(kept)
        is_name = pa.compute.is_valid(table["name"])
        of, links = table.filter(is_name), table.filter(pa.compute.invert(is_name))
        order = np.argsort(of["a"].to_numpy())
        ids, words = of["a"].to_numpy()[order], of["name"].take(pa.array(order)).to_pylist()
        g, a, b, w = (links[c].to_numpy() for c in ("g", "a", "b", "weight"))
        a, b = np.searchsorted(ids, a), np.searchsorted(ids, b)  # places in the order of numbers
        if tree is None:
            columns = [ids, ids[_contracted(words, g, a, b, w, gamma, sweeps, depth)]]
        else:
            columns = [np.concatenate(c) for c in zip(*_split_down(ids, words, g, a, b, w, gamma, sweeps, tree), strict=True)]
        kinds = [pa.int64(), pa.int64()] if tree is None else [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        arrays = [pa.array(np.where(c < 0, 0, c), k, mask=c < 0) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=[c.split(" ")[0] for c in schema.split(", ")])

    return cut(rows.repartition(1).mapInArrow(run, schema))


def _split_down(ids: np.ndarray, words: list[bytes], g: np.ndarray, a: np.ndarray, b: np.ndarray, w: np.ndarray, gamma: tuple[int, int], sweeps: int, level: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(nodes, level, communities, parents) per level, as numbers; -1 for no parent. Level 0 is there for all nodes."""
    while len(a):
        nodes = np.unique(a)
        place = np.full(len(ids), -1)
        place[nodes] = np.arange(len(nodes))
        part = nodes[_contracted([words[i] for i in nodes], g, place[a], place[b], w, gamma, sweeps, 0)]
        up = np.full(len(nodes), -1)
        up[place[a]] = g
        if level:
            groups, inverse = np.unique(up, return_inverse=True)
            least, most = np.full(len(groups), len(ids)), np.full(len(groups), -1)
            np.minimum.at(least, inverse, part)
            np.maximum.at(most, inverse, part)
            keep = (least < most)[inverse]
            nodes, part, up = nodes[keep], part[keep], up[keep]
        else:
            up = np.full(len(nodes), -1)
        if not len(nodes):
            return
        yield ids[nodes], np.full(len(nodes), level), ids[part], up
        lab = np.full(len(ids), -1)
        lab[nodes] = part
        inside = (lab[a] == lab[b]) & (lab[a] >= 0)
        a, b, w = a[inside], b[inside], w[inside]
        g, level = ids[lab[a]], level + 1


def _summed(keys: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of w of each."""
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, dtype=np.int64)
    return keys[starts], np.add.reduceat(w[order], starts) if len(keys) else w


def _contracted(words: list[bytes], g: np.ndarray, a: np.ndarray, b: np.ndarray, w: np.ndarray, gamma: tuple[int, int], sweeps: int, depth: int) -> np.ndarray:
    """The community of every node, by places in the order of nodes: `_contract` on arrays."""
    first, n = np.arange(len(words)), len(words)  # `first`: the node that names a node of the level
    member = np.arange(n)
    group = np.zeros(n, dtype=np.int64)
    group[a] = np.unique(g, return_inverse=True)[1]
    groups = int(group.max()) + 1 if n else 0
    two_m = np.zeros(groups, dtype=np.int64)
    np.add.at(two_m, group[a], w)

    def weights(a, b, w, n):
        k, loop = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        np.add.at(k, a, w)
        np.add.at(loop, a[a == b], w[a == b])
        return k, loop

    def quality(group, k, loop):
        count, inner, squares = np.bincount(group, minlength=groups), np.zeros(groups, dtype=np.int64), np.zeros(groups, dtype=np.int64)
        np.add.at(inner, group, loop)
        np.add.at(squares, group, k * k)
        return count, inner * two_m * gamma[1] - squares * gamma[0]

    k, loop = weights(a, b, w, n)
    while n:
        label = _moved([words[i] for i in first], group, two_m, k, a, b, w, gamma, sweeps, depth)
        label = _parts(label, a, b)
        heads, up = np.unique(label, return_inverse=True)
        (was, q), m = quality(group, k, loop), len(heads)
        keys, weight = _summed(up[a] * m + up[b], w)
        above = keys // m, keys % m, weight
        k_above, loop_above = weights(*above, m)
        left, better = quality(group[heads], k_above, loop_above)
        raised = better > q
        if not raised.any():
            break
        if ((better <= q) & (left < was)).any():
            label = np.where(raised[group], label, np.arange(n))
            heads, up = np.unique(label, return_inverse=True)
            m = len(heads)
            keys, weight = _summed(up[a] * m + up[b], w)
            above = keys // m, keys % m, weight
            k_above, loop_above = weights(*above, m)
        member, first, group = up[member], first[heads], group[heads]
        (a, b, w), n, k, loop, depth = above, m, k_above, loop_above, depth + 1
    return first[member]


def _moved(words: list[bytes], group: np.ndarray, two_m: np.ndarray, k: np.ndarray, a: np.ndarray, b: np.ndarray, w: np.ndarray, gamma: tuple[int, int], sweeps: int, depth: int) -> np.ndarray:
    """The label of every node after the rounds of `_moves`."""
    n = len(words)
    apart = a != b
    a, b, w = a[apart], b[apart], w[apart]
    label = np.arange(n)
    for r in range(2 * sweeps):
        if r % 2 == 0:
            mark = f"{depth}:{r // 2}".encode()
            early = np.fromiter((hashlib.md5(x + mark).digest()[0] < 128 for x in words), dtype=bool, count=n)
        now = early == (r % 2 == 0)
        tot = np.zeros(n, dtype=np.int64)
        np.add.at(tot, label, k)
        some, own = now[a], np.flatnonzero(now)
        keys, weight = _summed(np.concatenate([a[some] * n + label[b[some]], own * n + label[own]]), np.concatenate([w[some], np.zeros(len(own), dtype=np.int64)]))
        if not len(keys):
            continue
        node, community = keys // n, keys % n
        stays = community == label[node]
        gain = weight * two_m[group[node]] * gamma[1] - k[node] * (tot[community] - np.where(stays, k[node], 0)) * gamma[0]
        starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        best = np.repeat(np.maximum.reduceat(gain, starts), np.diff(np.append(starts, len(node))))
        stay = np.zeros(n, dtype=np.int64)
        stay[node[stays]] = gain[stays]
        better = np.flatnonzero((gain == best) & (best > stay[node]))[::-1]  # of equal ones the smallest is written last
        label[node[better]] = community[better]
    return label


def _parts(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels split into their connected parts, named by their smallest node."""
    inside = label[a] == label[b]
    a, b = a[inside], b[inside]
    part = np.arange(len(label))
    while True:
        least = part.copy()
        np.minimum.at(least, a, part[b])
        np.minimum.at(least, part, least.copy())
        least = least[least]
        if (least == part).all():
            return part
        part = least


def communities(pairs: DataFrame, gamma: tuple[int, int] = (1, 1), sweeps: int = 2, groups: DataFrame | None = None) -> DataFrame:
    """(node, community): communities of the weighted graph, each connected, named by their smallest node.

    Levels of contraction: nodes move, moves that fall apart are split into their connected parts, and every
    community becomes one node whose links carry the summed weights (those inside as a loop). It is repeated on
    the smaller graph until no level raises the modularity any more. `gamma` is a ratio of whole numbers.
    With `groups`, (node, g), each group is a graph of its own; links between groups must not be given.
    `pairs` holds both directions and whole weights; what a level costs falls with its links. Nodes are numbered in
    the order of their names, so that the rounds move numbers."""
    names = numbered(pairs)
    level = _by_number(pairs, names)
    if groups is None:
        level = level.select(F.lit(0).cast("bigint").alias("g"), "a", "b", "weight")
    else:
        level = level.join(groups.join(names, F.col("node") == F.col("name")).select(F.col("id").alias("a"), "g"), "a").select("g", "a", "b", "weight")
    members = _contract(cut(level), names, gamma, sweeps)
    own, head = names.select(F.col("id").alias("node"), "name"), names.select(F.col("id").alias("community"), F.col("name").alias("head"))
    return members.join(own, "node").join(head, "community").select(F.col("name").alias("node"), F.col("head").alias("community"))


def connected(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Split every community into its connected parts, named by their smallest node."""
    la = labels.select(F.col("node").alias("a"), F.col("community").alias("ca"))
    lb = labels.select(F.col("node").alias("b"), F.col("community").alias("cb"))
    inside = cut(pairs.select("a", "b").join(la, "a").join(lb, "b").where("ca = cb").select("a", "b"))
    parts = components(inside)
    lone = labels.join(parts.select("node"), "node", "left_anti").select("node", F.col("node").alias("component"))
    return parts.unionByName(lone).withColumnRenamed("component", "community")


def hierarchy(pairs: DataFrame, gamma: tuple[int, int] = (1, 1), sweeps: int = 2) -> DataFrame:
    """(node, level, community, parent, is_leaf): communities split again and again, until none splits.

    Level 0 partitions the graph; on each further level every community that splits, as a graph of its own,
    is replaced by its parts. Ids tell the level and the smallest node; a node's rows end with its leaf.
    A level reads only the links that lie inside the communities of the one before; when a task can hold them,
    it takes that level and all below."""
    names = numbered(pairs)
    inside = cut(_by_number(pairs, names).select(F.lit(0).cast("bigint").alias("g"), "a", "b", "weight"))
    if _fits(inside, gamma):
        return _named(_in_task(inside, names, gamma, sweeps, tree=0), names)
    lab = cut(_contract(inside, names, gamma, sweeps))
    tree = lab.select("node", F.lit(0).alias("level"), "community", F.lit(None).cast("bigint").alias("parent"))
    level = 0
    while True:
        ca, cb = lab.select(F.col("node").alias("a"), F.col("community").alias("ca")), lab.select(F.col("node").alias("b"), F.col("community").alias("cb"))
        inside = cut(inside.join(ca, "a").join(cb, "b").where("ca = cb").select(F.col("ca").alias("g"), "a", "b", "weight"))
        if _fits(inside, gamma):
            tree = tree.unionByName(_in_task(inside, names, gamma, sweeps, tree=level + 1))
            break
        parts = cut(_contract(inside, names, gamma, sweeps))
        both = parts.withColumnRenamed("community", "part").join(lab, "node")
        split = both.groupBy("community").agg(F.min("part").alias("least"), F.max("part").alias("most")).where("least < most").select("community")
        both = cut(both.join(split, "community", "left_semi"))
        if both.isEmpty():
            break
        level += 1
        tree = tree.unionByName(both.select("node", F.lit(level).alias("level"), F.col("part").alias("community"), F.col("community").alias("parent")))
        lab = both.select("node", F.col("part").alias("community"))
    return _named(tree, names)


def _named(tree: DataFrame, names: DataFrame) -> DataFrame:
    """The rows of `hierarchy` from (node, level, community, parent) by numbers."""
    inner = tree.where("parent IS NOT NULL").select((F.col("level") - 1).alias("level"), F.col("parent").alias("community"), F.lit(True).alias("inner")).distinct()
    tree = tree.join(inner, ["level", "community"], "left")
    for column in ("node", "community", "parent"):
        tree = tree.join(names.select(F.col("id").alias(column), F.col("name").alias(f"{column}_name")), column, "left")
    of = lambda up, column: F.concat(F.lit("L"), F.col("level") - up, F.lit("."), column)
    parent = F.when(F.col("parent").isNull(), "root").otherwise(of(1, "parent_name"))
    return tree.select(F.col("node_name").alias("node"), "level", of(0, "community_name").alias("community"), parent.alias("parent"), F.col("inner").isNull().alias("is_leaf"))


def at_level(tree: DataFrame, level: int) -> DataFrame:
    """(node, community): the partition of a level, with the leaves above it."""
    return tree.where((F.col("level") == level) | (F.col("is_leaf") & (F.col("level") < level))).select("node", "community")
