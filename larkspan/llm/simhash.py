"""SimHash near-dedup over an inverted index of byte positions.

Texts are lower-cased (A-Z), cut into words and three-word shingles, repeats
included. A fingerprint has a bit set if over half of the shingles' XXH64 values
have it. Fingerprints with at most three different bits are linked.

Three different bits touch at most three of the eight bytes, so a linked pair
shares at least five positional bytes (the guaranteed minimum). Postings of one
byte would hold 1/256 of everything; they are kept for four bytes at a time:
the 14 sets of four positions whose numbers xor to zero. Any five positions
contain one of them, so every linked pair meets in a posting. There the shared
bytes of each pair are tallied, pairs below five are left out and the others
verified by counting different bits.

A posting longer than LIMIT is split by the same rule one step finer: the free
32 bits as eight half bytes, then the free 16 bits as eight pairs of bits, after
which at most 256 fingerprints can remain. Nothing is capped. A posting sends on
only the links that join its fingerprints (a forest), never all its pairs;
copies count once. Groups are found by label spreading with pointer jumps.

`one_of_each` and `similar_groups` look for near copies instead: 512 bits over the
distinct five-word shingles, at most 92 of them different, which is a similarity of
about 0.8 or more. Their postings hold two positional bytes (see `wide_links`).

Defined results: null, empty and blank texts have fingerprint zero and are
linked like any other. Fewer than three words are one shingle. A null doc_id
gets its group's smallest doc_id. Rows that repeat a doc_id are one document.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspan.llm.worker import pieces_of
from larkspan.operators.graphs import components
from larkspan.storage import written

SHINGLE = 3
SEED = 42
MOST_BITS = 3
LEAST_SHARED = 8 - MOST_BITS
LIMIT = 1024
CHUNK = 1 << 16
BLOCKS = [c for c in combinations(range(8), 4) if c[0] ^ c[1] ^ c[2] ^ c[3] == 0]


def fingerprint(text: str | None) -> int:
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)))) if len(words) >= SHINGLE else iter([b" ".join(words)])
    n, votes = 0, np.zeros(64, np.int64)
    while len(h := np.fromiter(map(xxh64_intdigest, islice(shingles, CHUNK), repeat(SEED)), np.uint64)):
        n += len(h)
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp): the fingerprint's 64 bits as a signed number."""
    slim = docs.select(key, text)
    kind = slim.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in pieces_of(batch):
                fps = np.array([fingerprint(t) for t in part.column(text).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(key), pa.array(fps.view(np.int64))], names=[key, "fp"])

    return slim.mapInArrow(run, f"`{key}` {kind}, fp BIGINT")


def _spread(positions: tuple[int, ...], free: list[int]) -> int:
    """Mask of the bits at the chosen eighths of the free bits."""
    width = len(free) // 8
    return sum(1 << b for p in positions for b in free[p * width : (p + 1) * width])


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def masks_under(mask: int) -> list[int]:
    """The masks one step finer than a posting's mask (0: none yet)."""
    free = [b for b in range(64) if not mask >> b & 1]
    return [mask | _spread(c, free) for c in BLOCKS]


def _forests(groups: DataFrame) -> DataFrame:
    """(a, b): links that join the fingerprints of each posting; `groups` is (fps array<bigint>)."""

    def run(batches):
        for batch in batches:
            left, right = [], []
            for fps in batch.column("fps"):
                x = np.sort(fps.values.to_numpy().view(np.uint64))
                parent = np.arange(len(x))
                for step in range(0, len(x), 256):  # rows against all: bounded blocks
                    diff = x[step : step + 256, None] ^ x[None, :]
                    # tally the shared positional bytes, keep what reaches the minimum, verify the bits
                    shared = (diff.view(np.uint8).reshape(*diff.shape, 8) == 0).sum(axis=2)
                    i, j = np.nonzero((shared >= LEAST_SHARED) & (np.arange(len(x))[None, :] > np.arange(step, step + diff.shape[0])[:, None]))
                    near = np.bitwise_count(diff[i, j]) <= MOST_BITS
                    for i, j in zip((i[near] + step).tolist(), j[near].tolist()):
                        a, b = i, j
                        while parent[a] != a:
                            parent[a] = parent[parent[a]]
                            a = parent[a]
                        while parent[b] != b:
                            parent[b] = parent[parent[b]]
                            b = parent[b]
                        if a != b:
                            parent[max(a, b)] = min(a, b)
                            left.append(x[i])
                            right.append(x[j])
            yield pa.RecordBatch.from_arrays([pa.array(np.array(s, np.uint64).view(np.int64), pa.int64()) for s in (left, right)], names=["a", "b"])

    return groups.mapInArrow(run, "a BIGINT, b BIGINT")


def links(distinct: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(a, b): enough links between distinct fingerprints (fp) to join all that any link joins."""
    spark = distinct.sparkSession
    found, masks = None, masks_under(0)
    keyed = distinct.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("m"), F.col("fp").bitwiseAND(_signed(m)).alias("v")) for i, m in enumerate(masks)])).alias("k")).select("fp", "k.m", "k.v")
    for step in range(3):
        sizes = keyed.groupBy("m", "v").agg(F.count("*").alias("n")).where("n > 1")
        held = keyed.join(sizes, ["m", "v"])
        whole = held if step == 2 else held.where(F.col("n") <= limit)
        forest = _forests(whole.groupBy("m", "v").agg(F.collect_list("fp").alias("fps")).select("fps"))
        found = forest if found is None else found.unionByName(forest)
        if step == 2:
            break
        large = written(held.where(F.col("n") > limit).select("fp", "m", "v"), f"postings{step}")
        if large.isEmpty():
            break
        finer = [masks_under(m) for m in masks]
        rows = [(i, i * 14 + j, _signed(f)) for i, fs in enumerate(finer) for j, f in enumerate(fs)]
        table = spark.createDataFrame(rows, "m int, f int, mask bigint")  # 14 or 196 masks times 14
        keyed = large.join(F.broadcast(table), "m").select("fp", F.col("f").alias("m"), F.col("fp").bitwiseAND(F.col("mask")).alias("v"))
        masks = [f for fs in finer for f in fs]
    return written(found.distinct(), "links")


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """(key, fingerprint, component_id): component_id is the smallest key of the group."""
    fps = written(fingerprints(docs, key, text), "fingerprints")
    distinct = written(fps.groupBy("fp").agg(F.min(key).alias("first")), "distinct")
    edges = links(distinct.select("fp"), limit)
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = components(both).select(F.col("node").alias("fp"), "component")
    named = distinct.join(labels, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = written(named.join(smallest, "component").select("fp", "component_id"), "groups")
    return fps.join(named, "fp").select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# Near copies: long fingerprints for copies whose distinct five-word shingles are similar by 0.8 or more.
WIDE_SHINGLE = 5
WIDE = 64  # bytes of a long fingerprint
WIDE_BITS = 92  # different bits of 512; similarity 0.8 makes 78, 8 more or less; 0.6 makes 118
WIDE_SHARED = 6  # shared positional bytes a pair must have; similarity 0.8 makes 17, 4 more or less
PAIRS = [(p, p ^ 1) for p in range(0, 64, 2)] + [(p, p ^ 2) for p in range(64) if p & 2 == 0][:8]  # positions of a posting's two bytes
FURTHER = 8  # positions tried as a long posting's third byte
WHOLE = 256  # longer groups are walked, shorter ones compared as a square
FLAT = 16  # groups up to here are compared side by side


def wide_fingerprint(text: str | None, shingle: int = WIDE_SHINGLE) -> bytes:
    """512 bits, each set if over half of the distinct shingles' hashes have it (eight mixes of one XXH64)."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return bytes(WIDE)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else iter([b" ".join(words)])
    h = np.unique(np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64))
    votes = np.zeros(WIDE * 8, np.int64)
    for at in range(0, len(h), 1 << 12):
        m = h[at : at + (1 << 12), None] + np.arange(1, 9, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        m = (m ^ (m >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        m = (m ^ (m >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        votes += np.unpackbits((m ^ (m >> np.uint64(31))).view(np.uint8), axis=1).sum(axis=0, dtype=np.uint16)
    return np.packbits(votes * 2 > len(h)).tobytes()


def wide_fingerprints(docs: DataFrame, key: str, text: str = "text", shingle: int = WIDE_SHINGLE) -> DataFrame:
    """(key, fp binary)."""
    slim = docs.select(key, text)

    def run(batches):
        for batch in batches:
            for part in pieces_of(batch):
                yield pa.RecordBatch.from_arrays([part.column(key), pa.array([wide_fingerprint(t, shingle) for t in part.column(text).to_pylist()], pa.binary())], names=[key, "fp"])

    return slim.mapInArrow(run, f"`{key}` {slim.schema[key].dataType.simpleString()}, fp BINARY")


def _words(fps) -> np.ndarray:
    """Arrow fingerprints as rows of eight numbers."""
    return np.frombuffer(b"".join(fps.to_pylist()), np.uint64).reshape(-1, WIDE // 8)


def _close(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Which pairs share enough positional bytes (tallied) and differ in few enough bits (verified)."""
    diff = a ^ b
    near = (diff.view(np.uint8) == 0).sum(axis=-1, dtype=np.uint8) >= WIDE_SHARED
    near[near] = np.bitwise_count(diff[near]).sum(axis=-1, dtype=np.uint16) <= bits
    return near


def _walk(x: np.ndarray, bits: int) -> tuple[list[int], list[int]]:
    """A forest over the rows of x: every row found is compared with those not found yet, so copies leave at once."""
    found, rest, left, right = np.zeros(0, int), np.arange(len(x)), [], []
    while len(rest):
        if not len(found):
            if len(rest) <= WHOLE:  # nothing waits: go on only if any two of the rest are close
                near = _close(x[rest, None], x[None, rest], bits)
                np.fill_diagonal(near, False)
                rest = rest[near.any(axis=0)]
                if not len(rest):
                    break
            found, rest = rest[:1], rest[1:]
        rows, found = found[:64], found[64:]
        near = np.concatenate([_close(x[rows, None], x[None, rest[i : i + 512]], bits) for i in range(0, len(rest), 512)], axis=1) if len(rest) else np.zeros((len(rows), 0), bool)
        hit = near.any(axis=0)
        left += rows[near.argmax(axis=0)[hit]].tolist() if hit.any() else []
        right += rest[hit].tolist()
        found, rest = np.concatenate([found, rest[hit]]), rest[~hit]
    return left, right


def _wide_forests(groups: DataFrame, bits: int) -> DataFrame:
    """(a, b): links that join the close members of each group; `groups` is (of array<struct<node, fp>>)."""

    def run(batches):
        for batch in batches:
            lists = batch.column("of")
            at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            flat = lists.flatten()
            nodes, x, size = flat.field(0).to_numpy(), _words(flat.field(1)), np.diff(at)
            group = np.repeat(np.arange(len(size)), size)
            small = size[group] <= FLAT
            has = size > FLAT
            for lag in range(1, min(FLAT, size.max(initial=0))):
                i = np.nonzero(small[:-lag] & (group[:-lag] == group[lag:]))[0]
                has[group[i[_close(x[i], x[i + lag], bits)]]] = True
            left, right = [], []
            for g in np.nonzero(has)[0]:
                a, b = _walk(x[at[g] : at[g + 1]], bits)
                left += [at[g] + i for i in a]
                right += [at[g] + i for i in b]
            yield pa.RecordBatch.from_arrays([pa.array(nodes[np.array(s, int)]) for s in (left, right)], names=["a", "b"])

    return groups.mapInArrow(run, "a BIGINT, b BIGINT")


def _keyed(nodes: DataFrame, finer: bool) -> DataFrame:
    """(key, node, fp) per posting: two bytes at each of PAIRS, or for rows of long postings one byte more at each of FURTHER places."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                b = _words(part.column("fp")).view(np.uint8).astype(np.int64)
                if finer:
                    key = part.column("key").to_numpy()
                    first = np.array([p for p, _ in PAIRS])[key >> 16 & 63]
                    place = first[:, None] ^ (4 * np.arange(1, FURTHER + 1) + 1)[None, :]  # never one of the two before
                    keys = (np.arange(1, FURTHER + 1)[None, :] << 32 | key[:, None]) << 8 | np.take_along_axis(b, place, axis=1)
                else:
                    keys = np.stack([i << 16 | b[:, p] << 8 | b[:, q] for i, (p, q) in enumerate(PAIRS)], axis=1)
                rows = np.repeat(np.arange(part.num_rows), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), part.column("node").take(pa.array(rows)), part.column("fp").take(pa.array(rows))], names=["key", "node", "fp"])

    return nodes.mapInArrow(run, "key BIGINT, node BIGINT, fp BINARY")


def _apart(split: DataFrame, found: DataFrame, bits: int, limit: int) -> DataFrame:
    """(a, b): the links of long postings that `found` does not imply; `split` is (key, node, fp, n).

    In each posting all rows outside its largest group so far are compared with all of its rows, a block of either at a
    time. Two rows of one group are joined already, so no link between groups is missed."""
    one = F.struct("node", "fp").alias("one")
    labels = components(found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    rows = split.join(labels, "node", "left").withColumn("part", F.coalesce("component", "node"))
    sizes = rows.groupBy("key", "part").agg(F.count("*").alias("size"))
    main = sizes.groupBy("key").agg(F.max_by("part", F.struct("size", "part")).alias("main"), F.sum("size").alias("all"), F.max("size").alias("most"))
    main = written(main.where(F.col("all") > F.col("most")), "apart")
    rows = rows.join(main, "key").withColumn("cuts", F.ceil(F.col("all") / limit)).withColumn("others", F.ceil((F.col("all") - F.col("most")) / limit))
    place = lambda n: F.pmod(F.xxhash64("node"), n)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))
    whole = rows.select("key", one, place(F.col("cuts")).alias("block"), every(F.col("others")).alias("other"))
    rest = rows.where("part <> main").select("key", one, place(F.col("others")).alias("other"), every(F.col("cuts")).alias("block"))
    pairs = whole.unionByName(rest).groupBy("key", "block", "other").agg(F.collect_set("one").alias("of")).where(F.size("of") > 1)
    return _wide_forests(pairs.select("of"), bits).where("a <> b")


def wide_links(distinct: DataFrame, bits: int = WIDE_BITS, limit: int = LIMIT) -> DataFrame:
    """(a, b): links that join close long fingerprints; `distinct` is (node, fp).

    At this distance no count of shared bytes is guaranteed: postings of two positional bytes are
    kept for 40 pairs of positions, of which a pair at similarity 0.8 meets in one or more with 95 %.
    A posting longer than `limit` is split by a third byte, for eight places. What is still longer are
    families of copies: they are cut into blocks, and one fingerprint of each block stands in all of them.
    What these steps leave apart in a long posting is compared in full (`_apart`), so every posting is whole."""
    one = F.struct("node", "fp").alias("one")
    keyed, found, split = _keyed(distinct, False), None, None
    for finer in (False, True):
        large = written(keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > limit), "long")
        whole = keyed.join(large, "key", "left_anti").groupBy("key").agg(F.collect_list(one).alias("of")).where(F.size("of") > 1)
        links = _wide_forests(whole.select("of"), bits)
        found = links if found is None else found.unionByName(links)
        if large.isEmpty():
            break
        held = keyed.join(large, "key")
        if not finer:
            split = written(held.select("key", "node", "fp"), "split")
            keyed = _keyed(split, True)
    else:
        cut = F.ceil(F.col("n") / limit)
        blocks = held.withColumn("block", F.pmod(F.xxhash64("node"), cut))
        stands = blocks.groupBy("key", "n", "block").agg(F.min_by(one, "node").alias("one")).select("key", "one", F.explode(F.sequence(F.lit(0), cut - 1)).alias("block"))
        filled = blocks.select("key", "block", one).unionByName(stands.select("key", "block", "one"))
        found = found.unionByName(_wide_forests(filled.groupBy("key", "block").agg(F.collect_list("one").alias("of")).select("of"), bits).where("a <> b"))
    found = written(found.distinct(), "links")
    return found if split is None else written(found.unionByName(_apart(split, found, bits, limit)).distinct(), "links")


def similar_groups(docs: DataFrame, key: str, text: str = "text", shingle: int = WIDE_SHINGLE, bits: int = WIDE_BITS, limit: int = LIMIT) -> DataFrame:
    """(key, component_id) for a whole-number key without nulls or repeats: the smallest key of each group of near copies."""
    fps = written(wide_fingerprints(docs, key, text, shingle), "wide")
    distinct = written(fps.groupBy("fp").agg(F.min(key).alias("node")), "distinct")
    edges = wide_links(distinct.select("node", "fp"), bits, limit)
    labels = components(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    named = distinct.join(labels.select("node", "component"), "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return fps.join(named, "fp").select(key, "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each group of near copies (five-word shingles, similarity of about 0.8 or more): that of the smallest doc_id (rows without one last), then by the hash of the text.

    Rows are told apart by a number of their own, so rows that repeat a doc_id or have none are documents like any other."""
    row = "__row"
    while row in docs.columns:
        row += "_"
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    slim = rows.select(F.col(row).alias("at"), "doc_id", "text")
    groups = similar_groups(slim, "at").select(F.col("at").alias("r"), "component_id")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64("text").alias("hash"), "at")
    kept = slim.select("at", place.alias("place")).join(groups, F.col("at") == F.col("r")).groupBy("component_id").agg(F.min("place")["at"].alias("kept"))
    return rows.join(kept, rows[row] == kept["kept"], "left_semi").select(*docs.columns)
